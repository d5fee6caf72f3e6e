"""Line deduplication over levelled sorted runs of line hashes.

A *run* is a table of (h1, h2, n_docs, keeper), bucketed and sorted by hash.
Each batch of documents is merge-anti-joined with the runs so far: keys not
seen before enter with the batch's largest doc_id as their keeper, keys seen
before have one already and only add to the number of documents. The batch's
rows become a run of level 0; once a level holds ``fanout`` runs they are
compacted to one run of the next level. A manifest names the runs that count,
so another session can go on where one ended. Everything is DataFrame
operations; for a batch's anti-joins the runs are not shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.llm.common import ascii_lower, staged, tasks
from bidweave.session import delete_path, exists, new_shared_path

KEY = ["h1", "h2"]
BLANKS = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """Lines of a whole text; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def text_id(text: Column) -> Column:
    """Tells rows that repeat a doc_id with another text apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def document_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_id, pos, h1, h2) of every line whose key is long enough to count.

    The key is hashed to 128 bits, so that no two keys of a large corpus meet.
    """
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", text_id(F.col("text")).alias("text_id"), F.posexplode(lines_of(F.col("text")))
    )
    keyed = lines.select("doc_id", "text_id", "pos", line_key(F.col("col")).alias("key"))
    return keyed.where(F.char_length("key") >= min_chars).select(
        "doc_id",
        "text_id",
        "pos",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(7), "key").alias("h2"),
    )


def per_key(keys: DataFrame) -> DataFrame:
    """Number of documents and largest doc_id of each key.

    The first step spreads a frequent key over its documents, the second one
    combines before its exchange: no key lands in one task row by row.
    """
    once = keys.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one"))
    return once.groupBy(*KEY).agg(
        F.count("one").alias("n_docs"), F.max("doc_id").alias("keeper")
    )


RUN_SCHEMA = "h1 bigint, h2 bigint, n_docs bigint, keeper bigint"
MANIFEST = "batch string, run string, level int, buckets int, replaces array<string>"


def compacted(runs: list[DataFrame]) -> DataFrame:
    """One row for each key; at most one run has its keeper, the others only count."""
    whole = reduce(DataFrame.unionAll, runs)
    return whole.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.min("keeper").alias("keeper"))


def without_known(batch: DataFrame, runs: list[DataFrame]) -> DataFrame:
    """The batch's keys that no run has, by a merge join with each; only the batch is shuffled."""
    return reduce(lambda rows, run: rows.join(run.select(*KEY).hint("merge"), KEY, "left_anti"), runs, batch)


class LineRuns:
    """Levelled sorted runs below ``path``, a folder in shared storage.

    Opening the folder again goes on with the runs it holds. Of batches the
    first to bring a key has its keeper. One writer at a time; what a failed
    attempt left is not in the manifest and not read.
    """

    def __init__(self, spark: SparkSession, path: str, fanout: int = 3):
        self.spark, self.path, self.fanout = spark, path.rstrip("/"), fanout

    def _rows(self) -> list:
        # A row for each batch and compaction.
        if not exists(self.spark, f"{self.path}/manifest"):
            return []
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest").collect()

    def levels(self) -> dict[str, int]:
        """Level of each run that counts."""
        rows = self._rows()
        gone = {name for r in rows for name in r.replaces or ()}
        return {r.run: r.level for r in rows if r.run not in gone}

    def runs(self) -> list[DataFrame]:
        return [self._open(run) for run in self.levels()]

    def _buckets(self) -> int:
        rows = self._rows()
        return rows[0].buckets if rows else tasks(self.spark)

    def _open(self, run: str) -> DataFrame:
        """A run as a bucketed table: joins by key read each bucket as it lies."""
        if not self.spark.catalog.tableExists(run):
            self.spark.sql(
                f"CREATE TABLE {run} ({RUN_SCHEMA}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) "
                f"INTO {self._buckets()} BUCKETS LOCATION '{self.path}/{run}'"
            )
        return self.spark.table(run)

    def close(self) -> None:
        """Forgets the tables in this session; the files stay."""
        for run in {r.run for r in self._rows()}:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def add(self, keys: DataFrame, batch: str) -> bool:
        """Adds one batch of (h1, h2, doc_id); a batch that was added before changes nothing."""
        if batch in {r.batch for r in self._rows()}:
            return False
        found = per_key(keys)
        seen = self.runs()
        if seen:
            found = staged(found, "line-batch")
            fresh = staged(without_known(found, seen), "line-fresh")
            known = found.join(fresh.select(*KEY), KEY, "left_anti")
            found = fresh.unionAll(known.select(*KEY, "n_docs", F.lit(None).cast("bigint")))
        self._enter(found, 0, batch, [])
        level = 0
        while len(full := [run for run, at in self.levels().items() if at == level]) >= self.fanout:
            level += 1
            self._enter(compacted(self._files(full)), level, None, full)
            for run in full:
                self.spark.sql(f"DROP TABLE IF EXISTS {run}")
                delete_path(self.spark, f"{self.path}/{run}")
        return True

    def _enter(self, rows: DataFrame, level: int, batch: str | None, replaces: list[str]) -> None:
        n, run = self._buckets(), f"line_run_{level}_{uuid.uuid4().hex}"
        typed = rows.selectExpr(*[f"CAST({c.split()[0]} AS BIGINT) AS {c.split()[0]}" for c in RUN_SCHEMA.split(", ")])
        # Dealt as the buckets are, so that each is written by one task as one file.
        dealt = typed.repartition(n, *KEY).write.bucketBy(n, *KEY).sortBy(*KEY).format("parquet")
        dealt.option("path", f"{self.path}/{run}").saveAsTable(run)
        names = F.array(*[F.lit(name) for name in replaces]).cast("array<string>")
        values = F.lit(batch).cast("string"), F.lit(run), F.lit(level), F.lit(n), names
        titles = [c.split()[0] for c in MANIFEST.split(", ")]
        entry = self.spark.range(1).coalesce(1).select(*[v.alias(t) for v, t in zip(values, titles, strict=True)])
        entry.write.mode("append").parquet(f"{self.path}/manifest")

    def counted(self) -> DataFrame:
        """(h1, h2, n_docs, keeper) over all batches."""
        return compacted(self._files(self.levels()))

    def _files(self, runs: Iterable[str]) -> list[DataFrame]:
        """Runs as plain files, to be put together by key; stacked buckets of tables are no buckets."""
        return [self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.path}/{run}") for run in runs]


def batch_bounds(docs: DataFrame, batches: int) -> list[tuple[Column, ...]]:
    """Predicates that cut the documents into batches of descending doc_id."""
    shares = [i / batches for i in range(1, batches)]
    cuts = sorted(set(docs.approxQuantile("doc_id", shares, 0.01))) if shares else []
    edges = [None, *cuts, None]
    doc_id = F.col("doc_id")
    found = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        found.append(
            (F.lit(True) if low is None else doc_id > low)
            & (F.lit(True) if high is None else doc_id <= high)
        )
    return found[::-1]


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4, fanout: int = 3
) -> DataFrame:
    """``docs`` with the columns ``kept_text``, ``n_lines`` and ``n_dropped`` added.

    A line's key is the line stripped of ASCII blanks, A-Z lower-cased. Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines but those of the largest doc_id. Rows that repeat a
    doc_id are one document; rows without a doc_id keep all their lines and
    count for nobody. A null or empty text is one empty line. An empty table
    gives no rows. All columns of ``docs`` are kept; the names above are
    replaced if present.
    """
    lines = staged(document_lines(docs.select("doc_id", "text"), min_chars), "lines")
    runs = LineRuns(docs.sparkSession, new_shared_path(docs.sparkSession, "line-runs"), fanout)
    # The batch of the largest doc_ids comes first, so the first to bring a key is the one that keeps it.
    for n, inside in enumerate(batch_bounds(docs.select(F.col("doc_id").cast("double")), batches)):
        runs.add(lines.where(inside).select(*KEY, "doc_id"), f"batch-{n}")
    # Staged, so Spark knows its size: broadcast if small, else a join whose hot keys can be split.
    frequent = staged(runs.counted().where(F.col("n_docs") >= min_docs), "frequent-lines")
    runs.close()
    dropped = (
        lines.join(frequent, KEY)
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy(F.col("doc_id").alias("__doc"), F.col("text_id").alias("__text"))
        .agg(F.collect_set("pos").alias("__drop"))
    )
    split = lines_of(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__drop"))
    joined = docs.drop("kept_text", "n_lines", "n_dropped").join(
        dropped,
        (F.col("doc_id") == F.col("__doc")) & (text_id(F.col("text")) == F.col("__text")),
        "left",
    )
    # The outer transform splits the text once, not once for each line kept.
    rest = F.transform(
        F.array(split), lambda s: F.array_join(F.transform(kept, lambda i: F.get(s, i)), "\n")
    )[0]
    text = F.when(F.col("__drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(rest)
    return joined.withColumns(
        {
            "kept_text": text,
            "n_lines": F.size(split).cast("long"),
            "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
        }
    ).drop("__doc", "__text", "__drop")
