"""Rollups of the log as a stream of files, with a watermark and late rows.

Two queries share the work, each with its checkpoint. The first reads new log
files and deals each micro-batch by its watermark, the latest minute of all
batches before less the delay: rows behind it are late, the others become
partial aggregates. The second holds the open minutes in Spark's state store,
under the same watermark, and gives out those it has passed.

An hour whose minutes have all been given out is published from them. The
hours and buckets of late rows are never published from the stream; once their
hour is past they are rolled up from the stored log, as the batch jobs do with
late rows, so nothing is dropped however late it comes. Every sink replaces
what an earlier attempt of the same batch wrote.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.operators.normalize import normalize_bid_log, time_buckets
from bidweave.operators.reports import bucket_from_group
from bidweave.plans.base import aggregate_records, merge_records, split_records
from bidweave.plans.jobs import finest, reroll, rollup_datasets
from bidweave.plans.late import OWN, add_notes, elsewhere, matched, own_key, staged_keys, with_time
from bidweave.schema import PARTITION_COLUMNS, Grain, grain_of
from bidweave.session import delete_path, exists, scratch_path, small_splits, subfolders
from bidweave.sinks.rollups import write_rollups
from bidweave.sources.bid_log import read_bid_log

#: Times in microseconds.
BATCHES = "batch bigint, watermark bigint, latest bigint, log_rows bigint, late_rows bigint"
LATE = "own_dt date, own_hh int, own_mod int"
HOURS = "dt date, hh int"
#: Partition columns of the log under other names, next to those of a row's own time.
STORED = [f"stored_{c}" for c in PARTITION_COLUMNS]
HANDLED = "dt date, hh int, cgid_mod int, batch bigint"


def start_of(g: Grain) -> Column:
    """Time at which a row's hour or minute starts, from its key columns."""
    minute = F.col("min") if "min" in g.keys else F.lit(0)
    day = F.col("dt").cast("date")
    return F.make_timestamp(F.year(day), F.month(day), F.day(day), F.col("hh"), minute, F.lit(0))


class StreamedRollups:
    """The state of one stream of rollups, kept below ``work`` (a folder next to the datasets)."""

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        target: str,
        grains: str | Iterable[str] = ("minute",),
        delay: str = "2 hours",
        work: str | None = None,
        schema: T.StructType | None = None,
    ):
        self.spark, self.source, self.target = spark, source.rstrip("/"), target.rstrip("/")
        self.grains = [grains] if isinstance(grains, str) else list(grains)
        self.grain, self.delay, self.schema = finest(self.grains), delay, schema
        self.work = (work or f"{self.target}/_stream").rstrip("/")

    # Reading what the sinks keep

    def _read(self, name: str, schema: str | T.StructType, key: str = "") -> DataFrame:
        """The table ``name`` with the schema and the partition column ``key``."""
        full = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(schema.fields)
        if key:
            full = full.add(key, T.LongType())
        path = f"{self.work}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(path)

    def batches(self) -> DataFrame:
        """A row for each micro-batch that has been dealt."""
        return self._read("batches", BATCHES)

    def watermark(self, before: int | None = None) -> int:
        """The watermark of a batch, or of the next one, in microseconds; a stream starts with 0."""
        rows = self.batches()
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        latest = F.timestamp_micros(F.max("latest"))
        found = rows.agg(F.unix_micros(latest - F.expr(f"INTERVAL {self.delay}")).alias("w")).first().w
        return max(found or 0, 0)

    # First query: dealing the rows of new files

    def route(self, rows: DataFrame, batch: int) -> None:
        """Deals the log rows of one micro-batch; a batch that has been dealt is left alone."""
        if not self.batches().where(F.col("batch") == batch).isEmpty():
            return
        g, passed = grain_of(self.grain), self.watermark(batch)
        timed = with_time(rows)
        # Narrow: time and group are all that these columns need, and they are read once.
        kept = {s: F.col(c) for s, c in zip(STORED, PARTITION_COLUMNS, strict=True)}
        placed = time_buckets(timed.withColumns(kept)).withColumns(own_key()).withColumn("start", start_of(g))
        late = F.col("start") <= F.timestamp_micros(F.lit(passed))
        places = placed.groupBy(*OWN, *STORED, late.alias("is_late")).agg(
            F.max("start").alias("latest"), F.count("*").alias("n")
        )
        with scratch_path(self.spark, "routed") as path:
            schema = places.schema
            places.write.parquet(f"{path}/places")
            places = self.spark.read.schema(schema).parquet(f"{path}/places")
            n_late = F.coalesce(F.sum(F.when(F.col("is_late"), F.col("n"))), F.lit(0))
            totals = places.agg(
                F.unix_micros(F.max("latest")).alias("latest"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                n_late.alias("n_late"),
            ).first()
            names = [F.col(s).alias(c) for s, c in zip(STORED, PARTITION_COLUMNS, strict=True)]
            moved = staged_keys(places.where(elsewhere(STORED)).select(*OWN, *names).distinct(), f"{path}/moved")
            if moved is not None:
                add_notes(self.spark, self.target, moved)
            if totals.n_late:
                keys = places.where("is_late").select(*OWN).distinct()
                keys.write.mode("overwrite").parquet(f"{self.work}/late/batch={batch}")
        fresh = normalize_bid_log(timed).where(start_of(g) > F.timestamp_micros(F.lit(passed)))
        opened = aggregate_records(fresh, g).withColumn("start", start_of(g))
        opened.write.mode("overwrite").parquet(f"{self.work}/open/batch={batch}")
        done = [(batch, passed, totals.latest, totals.n, totals.n_late)]
        self.spark.createDataFrame(done, BATCHES).coalesce(1).write.mode("append").parquet(f"{self.work}/batches")

    def deal(self, max_files: int | None = None) -> None:
        full = read_bid_log(self.spark, self.source, schema=self.schema).schema
        stream = self.spark.readStream.schema(full).option("basePath", self.source)
        if max_files:
            stream = stream.option("maxFilesPerTrigger", max_files)
        # A task sorts all records of its split; a stream takes the settings it starts with.
        with small_splits(self.spark):
            self._run(stream.parquet(self.source).writeStream.foreachBatch(lambda r, n: self.route(r, n)), "route")

    # Second query: open minutes in the state store

    def open_schema(self) -> T.StructType:
        log = read_bid_log(self.spark, self.source, schema=self.schema)
        g = grain_of(self.grain)
        return aggregate_records(normalize_bid_log(log), g).withColumn("start", start_of(g)).schema

    def keep(self, rows: DataFrame, batch: int) -> None:
        """Keeps what the state store gave out in one micro-batch."""
        rows.drop("start").write.mode("overwrite").partitionBy("dt", "hh").parquet(f"{self.work}/closed/batch={batch}")

    def close(self) -> None:
        if not exists(self.spark, f"{self.work}/open"):
            return
        g, taken = grain_of(self.grain), subfolders(self.spark, f"{self.work}/open")
        stream = self.spark.readStream.schema(self.open_schema()).parquet(f"{self.work}/open")
        whole = merge_records(stream.withWatermark("start", self.delay), g, keys=["start"])
        self._run(whole.writeStream.outputMode("append").foreachBatch(lambda r, n: self.keep(r, n)), "close")
        # All of it is in the state store or given out.
        for folder in taken:
            delete_path(self.spark, folder)

    def _run(self, writer, name: str) -> None:
        query = writer.option("checkpointLocation", f"{self.work}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    # Publishing

    def publish(self) -> dict[str, str]:
        """Writes the hours that the watermark has passed, and those of late rows from the log."""
        passed = F.timestamp_micros(F.lit(self.watermark()))
        names = {g: grain_of(g) for g in self.grains}
        stems = ("campaign_group", "campaign", "terms")
        paths = [n.dataset(stem) for n in names.values() for stem in stems]
        fields = [f for f in self.open_schema() if f.name != "start"]
        closed = self._read("closed", T.StructType(fields), "batch")
        # The last minute of the hour has been given out.
        last = F.lit(59) if "min" in grain_of(self.grain).keys else F.lit(0)
        over = F.make_timestamp(F.year("dt"), F.month("dt"), F.day("dt"), F.col("hh"), last, F.lit(0)) <= passed
        with scratch_path(self.spark, "publish") as path:
            past = closed.select("dt", "hh").distinct().where(over)
            hours = staged_keys(past.exceptAll(self._read("published", HOURS).distinct()), f"{path}/hours")
            late = self._read("late", LATE, "batch").select(
                *[F.col(o).alias(p) for o, p in zip(OWN, PARTITION_COLUMNS, strict=True)], "batch"
            )
            every = staged_keys(late.select(*PARTITION_COLUMNS).distinct(), f"{path}/every")
            if hours is not None:
                rows = closed.drop("batch").join(hours, ["dt", "hh"], "left_semi")
                if every is not None:
                    keyed = rows.withColumn("cgid_mod", own_key()["own_mod"])
                    rows = matched(keyed, every, PARTITION_COLUMNS, "left_anti", PARTITION_COLUMNS).drop("cgid_mod")
                base = split_records(rows, self.grain)
                frames = {}
                for g in self.grains:
                    for name, frame in rollup_datasets(base, g).items():
                        frames[name] = bucket_from_group(frame)
                write_rollups(frames, self.target, "overwrite")
                hours.write.mode("append").parquet(f"{self.work}/published")
                self._drop_published(closed)
            known = [*PARTITION_COLUMNS, "batch"]
            handled = self._read("handled", HANDLED)
            due = staged_keys(
                matched(late.where(over).distinct(), handled, known, "left_anti", known), f"{path}/due"
            )
            if due is not None:
                reroll(self.spark, self.source, self.target, due, self.grains, schema=self.schema)
                due.write.mode("append").parquet(f"{self.work}/handled")
        return {name: f"{self.target}/{name}" for name in paths}

    def _drop_published(self, closed: DataFrame) -> None:
        """Removes what was given out in batches all of whose hours are published."""
        held = closed.select("batch", "dt", "hh").distinct()
        done = self._read("published", HOURS).distinct().withColumn("is_done", F.lit(True))
        waits = F.count_if(F.col("is_done").isNull())
        over = held.join(done, ["dt", "hh"], "left").groupBy("batch").agg(waits.alias("n")).where("n = 0")
        for row in over.toLocalIterator():
            delete_path(self.spark, f"{self.work}/closed/batch={row.batch}")


def stream_rollups(
    spark: SparkSession,
    source: str,
    target: str,
    grains: str | Iterable[str] = ("minute",),
    delay: str = "2 hours",
    max_files: int | None = None,
    work: str | None = None,
    schema: T.StructType | None = None,
) -> dict[str, str]:
    """Brings the datasets up to date with the log files that are there now.

    Reads the files that earlier calls have not, in micro-batches of at most
    ``max_files``, and publishes the hours that lie behind the watermark:
    ``delay`` before the latest row. Rows that come later than that are counted
    too, see above. Hours still open appear with a later call. Returns the path
    of each dataset. A call that fails goes on where it stopped.

    Call it as often as results are wanted; one call at a time.
    """
    stream = StreamedRollups(spark, source, target, grains, delay, work, schema)
    stream.deal(max_files)
    stream.close()
    return stream.publish()
