"""Comparison of two runs' datasets by fingerprints of their partitions.

A fingerprint is a count and two sums of row hashes: it does not depend on the
order of rows and adds up over files. Each file's fingerprint is kept next to
its dataset and taken once, since files never change; a partition's is the sum
over the files it has now. Partitions that agree are not read. The others are
compared row by row, with multiplicities.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.schema import PARTITION_COLUMNS, PARTITION_FIELDS
from bidweave.session import exists
from bidweave.sources.bid_log import partition_files

STORE = "_fingerprints"
FINGERPRINTS = "file string, n bigint, first decimal(38,0), second decimal(38,0)"
SUMS = ["n", "first", "second"]
COPIES = ["left_copies", "right_copies"]


def file_name(path: Column) -> Column:
    """Partition folders and name of a file; names hold a unique id of the job that wrote them."""
    return F.regexp_extract(path, "(dt=[^/]*/hh=[^/]*/cgid_mod=[^/]*/[^/]*)$", 1)


def row_hash(columns: list[str], seed: int) -> Column:
    """Hash of a row. NULLs leave a hash as it is, so each column comes with whether it is one."""
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(file, dt, hh, cgid_mod) of a dataset's files, from the listing."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), *PARTITION_FIELDS]))
    found = partition_files(spark, [path])
    return found.withColumn("file", file_name(F.col("file"))).where(F.col("file") != "")


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A dataset with the types of its partition columns."""
    stored = spark.read.parquet(path)
    return stored.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in PARTITION_FIELDS})


def on_days_of(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the days among ``keys``: a limit on the folders that are listed and read."""
    days = [r.dt for r in keys.select("dt").distinct().collect()]
    return rows.where(F.col("dt").isin([d for d in days if d is not None]) | F.col("dt").isNull())


def take_fingerprints(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """(file, n, first, second) of each file of a dataset; reads the files it has not read before.

    ``columns`` are all but the partition columns unless given, in an order
    that both runs share.
    """
    store = f"{path.rstrip('/')}/{STORE}"
    if exists(spark, store):
        known = spark.read.schema(FINGERPRINTS).parquet(store)
    else:
        known = spark.createDataFrame([], FINGERPRINTS)
    files = listed(spark, path)
    fresh = files.join(known.select("file"), "file", "left_anti")
    if fresh.isEmpty():
        return known
    stored = on_days_of(read_partitions(spark, path), fresh)
    wanted = columns or sorted(c for c in stored.columns if c not in PARTITION_COLUMNS)
    own = file_name(F.col("_metadata.file_path"))
    rows = stored.withColumn("file", own).join(fresh, "file", "left_semi")
    taken = rows.groupBy("file").agg(
        F.count("*").alias("n"),
        F.sum(row_hash(wanted, 1)).cast("decimal(38,0)").alias("first"),
        F.sum(row_hash(wanted, 2)).cast("decimal(38,0)").alias("second"),
    )
    taken.coalesce(1).write.mode("append").parquet(store)
    return spark.read.schema(FINGERPRINTS).parquet(store)


def partition_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(dt, hh, cgid_mod, n, first, second) of each partition of a dataset."""
    known = take_fingerprints(spark, path).dropDuplicates(["file"])
    sums = [F.sum(c).cast("decimal(38,0)" if c != "n" else "bigint").alias(c) for c in SUMS]
    return listed(spark, path).join(known, "file").groupBy(*PARTITION_COLUMNS).agg(*sums)


def same_key(names: list[str]) -> Column:
    return reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names])


def differing_partitions(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(dt, hh, cgid_mod) whose fingerprints differ, or that one side lacks."""
    a, b = partition_fingerprints(spark, left).alias("a"), partition_fingerprints(spark, right).alias("b")
    both = a.join(b, same_key(PARTITION_COLUMNS), "full")
    equal = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in SUMS])
    # A side without the partition has a NULL count, which no fingerprint has.
    keys = [F.when(F.col("a.n").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in PARTITION_COLUMNS]
    return both.where(~equal).select(*keys)


def diff_datasets(spark: SparkSession, left: str, right: str, staged: str) -> DataFrame | None:
    """Rows of which two datasets have different numbers, with ``left_copies`` and ``right_copies``.

    Both have the same columns. Only partitions whose fingerprints differ are
    read; their keys are staged at ``staged``. None if all partitions agree.
    Equal fingerprints of different rows are as unlikely as a collision of 128
    bits.
    """
    keys = differing_partitions(spark, left, right)
    keys.write.parquet(staged)
    keys = spark.read.schema(T.StructType(PARTITION_FIELDS)).parquet(staged)
    if keys.isEmpty():
        return None
    sides = []
    for path, own in ((left, COPIES[0]), (right, COPIES[1])):
        if not listed(spark, path).isEmpty():
            stored = on_days_of(read_partitions(spark, path), keys).alias("a")
            rows = stored.join(keys.alias("b"), same_key(PARTITION_COLUMNS), "left_semi")
            sides.append(rows.withColumns({c: F.lit(int(c == own)) for c in COPIES}))
    rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    columns = [c for c in rows.columns if c not in COPIES]
    counted = rows.groupBy(*columns).agg(*[F.sum(c).alias(c) for c in COPIES])
    return counted.where(F.col(COPIES[0]) != F.col(COPIES[1]))


def diff_rollups(spark: SparkSession, left: str, right: str, names: list[str], staged: str) -> DataFrame | None:
    """Differences of the datasets ``names`` of two runs, told apart by ``dataset``; None if there are none.

    Intermediate tables are staged below ``staged``, which must last as long as
    the result is read.
    """
    found = None
    for name in names:
        rows = diff_datasets(spark, f"{left.rstrip('/')}/{name}", f"{right.rstrip('/')}/{name}", f"{staged}/{name}")
        if rows is not None:
            rows = rows.withColumn("dataset", F.lit(name))
            found = rows if found is None else found.unionByName(rows, allowMissingColumns=True)
    return found
