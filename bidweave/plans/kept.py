"""Rollups kept up to date from partial aggregates, without reading old log rows again.

Each batch of log rows is aggregated once to the finest keys, by the hours the
rows belong to, and stored as a run of partials. A manifest names the batches
that count. Sums of sums and maxima of maxima are the same in any order, so
hours are published by aggregating the partials of all batches that have rows
in them; a row may arrive as late as it likes. Runs of one level are merged
into one of the next, so few runs are read however many batches there were.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.operators.normalize import normalize_bid_log
from bidweave.operators.reports import bucket_from_group
from bidweave.plans.base import aggregate_records, merge_records, split_records
from bidweave.plans.jobs import rollup_datasets
from bidweave.plans.late import with_time
from bidweave.schema import PARTITION_COLUMNS, PARTITION_FIELDS, grain_of
from bidweave.session import delete_path, exists, hadoop_path, small_splits
from bidweave.sinks.rollups import write_rollups
from bidweave.sources.bid_log import read_bid_log

HOUR = ["dt", "hh"]
MANIFEST = "batch string, run string, level int, log_rows bigint, replaces array<string>"
PUBLISHED = "run string"
#: Runs of one level that are merged into one of the next.
FANOUT = 8


class KeptBase:
    """Partial aggregates of a log's batches below ``root``, at the keys of ``grain``.

    One writer at a time. A batch becomes part of the base by one small file
    of the manifest; whatever a failed attempt left is not read, and the batch
    can be applied again.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str = "minute", numeric_max: bool = False):
        self.spark, self.root, self.grain, self.numeric_max = spark, root.rstrip("/"), grain, numeric_max

    # The manifest has a row for each batch and merge: few, so the driver may hold them.

    def _rows(self, name: str, schema: str) -> list:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path).collect() if exists(self.spark, path) else []

    def _commit(self, name: str, schema: str, rows: list[tuple]) -> None:
        frame = self.spark.createDataFrame(rows, schema).coalesce(1)
        frame.write.mode("append").parquet(f"{self.root}/{name}")

    def batches(self) -> dict[str, int]:
        """Log rows of each applied batch."""
        return {r.batch: r.log_rows for r in self._rows("manifest", MANIFEST) if r.batch is not None}

    def live(self) -> dict[str, int]:
        """Level of each run that counts: those not yet merged into another."""
        rows = self._rows("manifest", MANIFEST)
        gone = {name for r in rows for name in r.replaces or ()}
        return {r.run: r.level for r in rows if r.run not in gone}

    def apply(self, rows: DataFrame, batch: str) -> bool:
        """Adds a batch of log rows; one that is part of the base already changes nothing.

        ``rows`` are raw log rows. Those without ``epoch`` count at the start of
        the hour they are stored in if the partition columns are there.
        """
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch's name has letters, digits and _.- only, got {batch!r}")
        if batch in self.batches():
            return False
        seen = Observation()
        timed = with_time(rows) if set(HOUR) <= set(rows.columns) else rows
        counted = timed.observe(seen, F.count(F.lit(1)).alias("n"))
        partials = aggregate_records(normalize_bid_log(counted), self.grain, self.numeric_max)
        run = f"{batch}-{uuid.uuid4().hex}"
        # A task sorts all records of its split.
        with small_splits(self.spark):
            self._write(partials, run)
        self._commit("manifest", MANIFEST, [(batch, run, 0, seen.get["n"], None)])
        return True

    def _write(self, partials: DataFrame, run: str) -> None:
        balanced = partials.hint("rebalance", *HOUR)
        balanced.write.partitionBy(*HOUR).parquet(f"{self.root}/runs/run={run}")

    def partials(self, runs: Iterable[str]) -> DataFrame | None:
        """Partial aggregates of some runs, told apart by ``run``."""
        paths = [f"{self.root}/runs/run={run}" for run in runs]
        paths = [path for path in paths if self._has_rows(path)]
        if not paths:
            return None
        stored = self.spark.read.option("basePath", f"{self.root}/runs").parquet(*paths)
        types = {f.name: f.dataType for f in PARTITION_FIELDS} | {"run": T.StringType()}
        return stored.withColumns({n: F.col(n).cast(t) for n, t in types.items() if n in stored.columns})

    def _has_rows(self, path: str) -> bool:
        folder = hadoop_path(self.spark, path)
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return any(s.getPath().getName().startswith("dt=") for s in system.listStatus(folder))

    def publish(
        self, target: str, grains: str | Iterable[str] = ("hour",), null_safe: bool = False
    ) -> dict[str, str]:
        """Writes the hours that batches since the last call have rows in, from all of their partials.

        Returns the path of each dataset. Hours without new rows are neither
        read nor written.
        """
        wanted = [grains] if isinstance(grains, str) else list(grains)
        for g in wanted:
            if not set(grain_of(g).keys) <= set(grain_of(self.grain).keys):
                raise ValueError(f"the base is kept by {self.grain}, it has no {g}")
        live = self.live()
        done = {r.run for r in self._rows("published", PUBLISHED)}
        fresh = self.partials(run for run in live if run not in done)
        names = {g: grain_of(g) for g in wanted}
        paths = {
            names[g].dataset(stem): f"{target.rstrip('/')}/{names[g].dataset(stem)}"
            for g in wanted
            for stem in ("campaign_group", "campaign", "terms")
        }
        if fresh is not None:
            # Partition columns alone: the hours come from the file listing.
            hours = fresh.select(*HOUR).distinct()
            touched = self.partials(live).join(hours, HOUR, "left_semi")
            base = split_records(touched, self.grain)
            frames = {}
            for g in wanted:
                for name, frame in rollup_datasets(base, g, null_safe, self.numeric_max).items():
                    frames[name] = bucket_from_group(frame)
            write_rollups(frames, target, "overwrite")
        if set(live) - done:
            self._commit("published", PUBLISHED, [(run,) for run in live if run not in done])
        self.merge()
        return paths

    def merge(self, fanout: int = FANOUT) -> None:
        """Merges published runs: as soon as a level has ``fanout``, they become one of the next."""
        done = {r.run for r in self._rows("published", PUBLISHED)}
        level = 0
        while True:
            live = self.live()
            if not any(at >= level for at in live.values()):
                return
            runs = [run for run, at in live.items() if at == level and run in done]
            if len(runs) >= fanout:
                run = f"merged-{level + 1}-{uuid.uuid4().hex}"
                stored = self.partials(runs)
                if stored is not None:
                    self._write(merge_records(stored, self.grain, self.numeric_max), run)
                    self._commit("published", PUBLISHED, [(run,)])
                    self._commit("manifest", MANIFEST, [(None, run, level + 1, 0, runs)])
                    for old in runs:
                        delete_path(self.spark, f"{self.root}/runs/run={old}")
            level += 1


def apply_files(base: KeptBase, rows: DataFrame, n: int) -> None:
    base.apply(rows, f"files-{n}")


def incremental_job(
    spark: SparkSession,
    source: str,
    target: str,
    grains: str | Iterable[str] = ("hour",),
    kept: str | None = None,
    max_files: int | None = None,
    schema: T.StructType | None = None,
) -> dict[str, str]:
    """Brings the datasets up to date with the files that came to the log since the last call.

    The log is a stream of files that ends with what is there now; each
    micro-batch of at most ``max_files`` files is applied to the kept base
    below ``kept`` (a folder next to the datasets), then the hours that got
    rows are published. A call that fails goes on where it stopped: a batch
    whose rows are part of the base is not counted again. Files must not change.
    """
    target = target.rstrip("/")
    root = kept or f"{target}/_kept"
    wanted = [grains] if isinstance(grains, str) else list(grains)
    base = KeptBase(spark, root, max(wanted, key=lambda g: len(grain_of(g).keys)))
    full = read_bid_log(spark, source, schema=schema).schema
    stream = spark.readStream.schema(full).option("basePath", source)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    writer = (
        stream.parquet(source)
        .writeStream.foreachBatch(lambda rows, n: apply_files(base, rows, n))
        .option("checkpointLocation", f"{root}/files")
        .trigger(availableNow=True)
    )
    # A stream takes the settings it starts with.
    with small_splits(spark):
        writer.start().awaitTermination()
    return base.publish(target, wanted)
