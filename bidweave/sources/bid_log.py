"""Scan of the bid log and check of its partitions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.schema import BID_LOG_SCHEMA, PARTITION_FIELDS
from bidweave.sources.windows import Window, in_mods, parse_mods


def day_paths(spark: SparkSession, root: str, days: Iterable[date] | None) -> list[str]:
    """Paths to list: the root, or the day folders that exist.

    The log spans years; naming the days keeps the file listing to the window.
    """
    if days is None:
        return [root]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for day in sorted(days):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/dt={day.isoformat()}")
        if path.getFileSystem(conf).exists(path):
            found.append(path.toString())
    return found


def read_bid_log(
    spark: SparkSession,
    root: str,
    days: Iterable[date] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Bid log below ``root``, limited to day folders.

    Without ``schema`` the types are those of the files. Columns that the
    rollups need must be there; a log without any file is empty.
    """
    root = root.rstrip("/")
    paths = day_paths(spark, root, days)
    if not paths:
        return spark.createDataFrame([], T.StructType([*(schema or BID_LOG_SCHEMA), *PARTITION_FIELDS]))
    found = schema
    if found is None:
        own = spark.read.option("basePath", root).parquet(*paths).schema
        parts = {f.name for f in PARTITION_FIELDS}
        found = T.StructType([f for f in own if f.name not in parts])
        missing = [n for n in BID_LOG_SCHEMA.fieldNames() if n not in found.fieldNames()]
        if missing:
            raise ValueError(f"the log at {root} has no column {', '.join(missing)}")
    full = T.StructType([*found.fields, *PARTITION_FIELDS])
    return spark.read.schema(full).option("basePath", root).parquet(*paths)


def scan_bid_log(
    spark: SparkSession,
    root: str,
    window: Window | None = None,
    mods: str | Iterable[int] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Bid log below ``root``, limited to a window and to buckets.

    The limits are predicates on the partition columns ``dt``, ``hh`` and
    ``cgid_mod``. A window without any partition gives an empty frame.
    """
    log = read_bid_log(spark, root, None if window is None else window.hours_by_day(), schema)
    if window is not None:
        log = log.where(window.on_partitions())
    chosen = parse_mods(mods)
    return log if chosen is None else log.where(in_mods(F.col("cgid_mod"), chosen))


def partition_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, dt, hh, cgid_mod) of the Parquet files below some paths of partitioned tables.

    Read from the file listing, one row per file; no file is opened. Partition
    values are taken from the path, so the paths need no common root, and
    folders without any file are no error.
    """
    fields = [
        F.regexp_extract("path", f"/{f.name}=([^/]*)/", 1).try_cast(f.dataType).alias(f.name)
        for f in PARTITION_FIELDS
    ]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = files.option("pathGlobFilter", "*.parquet").load(paths).select(F.col("path").alias("file"), *fields)
    # The source makes a task of each large file, though no byte of it is read.
    return listed.coalesce(spark.sparkContext.defaultParallelism)


def present_partitions(spark: SparkSession, root: str, window: Window) -> DataFrame:
    """Partitions of the window that hold files."""
    root = root.rstrip("/")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PARTITION_FIELDS)
    paths = day_paths(spark, root, window.hours_by_day())
    if not paths:
        return spark.createDataFrame([], fields)
    listed = partition_files(spark, paths).drop("file")
    return listed.where(window.on_partitions()).distinct()


def expected_partitions(
    spark: SparkSession, window: Window, mods: list[int] | None
) -> DataFrame:
    """Hours of the window crossed with the buckets asked for."""
    first = F.lit(window.start.isoformat(sep=" ")).cast("timestamp_ntz")
    last = F.lit((window.end).isoformat(sep=" ")).cast("timestamp_ntz")
    hours = spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 hour"))).alias("at")
    )
    buckets = F.array(*[F.lit(m) for m in mods]) if mods else F.array(F.lit(None).cast("int"))
    return hours.where(F.col("at") < last).select(
        F.to_date("at").alias("dt"),
        F.hour("at").alias("hh"),
        F.explode(buckets).alias("cgid_mod"),
    )


def missing_partitions(
    spark: SparkSession,
    root: str,
    window: Window,
    mods: str | Iterable[int] | None = None,
) -> DataFrame:
    """Partitions of the window that the log does not have.

    With a bucket list, one row per missing hour and bucket; without, one row
    per hour that has no bucket at all (``cgid_mod`` is then NULL).
    """
    chosen = parse_mods(mods)
    expected = expected_partitions(spark, window, chosen)
    present = present_partitions(spark, root, window)
    keys = ["dt", "hh"] if chosen is None else ["dt", "hh", "cgid_mod"]
    return expected.join(present.select(*keys).distinct(), keys, "left_anti").select(
        "dt", "hh", "cgid_mod"
    )
