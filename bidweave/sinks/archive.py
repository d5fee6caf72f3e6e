"""Moving aged log files to an archive.

Files keep their path relative to the root, so copying one twice gives the same
archive and a lost task can simply run again. Sources are deleted by a second
job, and only those whose copy has the full length. Listing, copying and
deleting are done in tasks, all with pyarrow's credentials.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.session import new_shared_path, scratch_path
from bidweave.sinks.files import copy_batches, delete_batches, list_batches, subfolders


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file listing spells it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(target).toString()


def aged_files(
    spark: SparkSession, root: str, days: int = 7, now: datetime | None = None
) -> DataFrame:
    """Files last modified strictly more than ``days`` days before ``now``.

    (path, modified, length); hidden files are left out. The driver lists the
    day folders, tasks list what is in them.
    """
    cutoff = (now or datetime.now(timezone.utc)) - timedelta(days=days)
    root = qualified(spark, root)
    folders = [(root, False), *((folder, True) for folder in subfolders(root))]
    listing = spark.createDataFrame(folders, "folder string, deep boolean").repartition(
        min(len(folders), MOST_LISTING_TASKS)
    )
    files = listing.mapInPandas(list_batches, "path string, micros bigint, length bigint")
    old = files.where(F.col("micros") < int(cutoff.timestamp() * 1_000_000))
    return old.select("path", F.timestamp_micros("micros").alias("modified"), "length")


#: More day folders share tasks.
MOST_LISTING_TASKS = 1000
REPORT = "path string, target string, length bigint, error string"


def archive_aged_partitions(
    spark: SparkSession,
    root: str,
    archive_root: str,
    days: int = 7,
    now: datetime | None = None,
    report_path: str | None = None,
) -> DataFrame:
    """Moves files older than ``days`` from ``root`` to ``archive_root``.

    Returns the report kept at ``report_path``: one row per file with its new
    place, and the error of a file that could not be moved and stays behind.
    Without a path the report lasts until the driver program ends. The archive
    must be outside the log, and the log outside the archive.
    """
    source, target = qualified(spark, root), qualified(spark, archive_root)
    if f"{target}/".startswith(f"{source}/") or f"{source}/".startswith(f"{target}/"):
        raise ValueError(f"{target} and {source} must not contain each other")
    report_path = report_path or new_shared_path(spark, "archive-report")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = aged_files(spark, root, days, now).select(
        "path",
        F.concat(F.lit(target), F.substr("path", F.lit(len(source) + 1))).alias("target"),
        "length",
        F.lit(None).cast("string").alias("error"),
    )
    with scratch_path(spark, "archive-copies") as copies:
        # A day's files are listed in one task and copied in many.
        files.repartition(tasks, "path").mapInPandas(copy_batches, REPORT).write.parquet(copies)
        copied = spark.read.schema(REPORT).parquet(copies)
        copied.mapInPandas(delete_batches, REPORT).write.parquet(report_path)
    return spark.read.schema(REPORT).parquet(report_path)
