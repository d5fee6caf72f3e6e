"""Partitioned Parquet output of the rollup datasets."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.schema import PARTITION_COLUMNS
from bidweave.session import delete_path, scratch_path
from bidweave.sources.bid_log import day_paths, partition_files

MODES = ("overwrite", "append")


def write_rollup(frame: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Writes one frame at ``path``, partitioned by day, hour and bucket.

    Rows are rebalanced by partition first: that keeps the number of files per
    partition low, while adaptive execution splits a partition that is far
    larger than the others over several tasks and files.
    """
    (
        frame.hint("rebalance", *PARTITION_COLUMNS)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )
    return path


def files_of_days(spark: SparkSession, paths: list[str], days: set[date]) -> DataFrame | None:
    """(file, dt, hh, cgid_mod) of the datasets' partitions of these days, or None without any."""
    folders = [folder for path in paths for folder in day_paths(spark, path, days)]
    return partition_files(spark, folders) if folders else None


def remove_left(spark: SparkSession, before: DataFrame, paths: list[str], days: set[date]) -> None:
    """Removes partitions that still have a file of ``before``; there are few of them."""
    after = files_of_days(spark, paths, days)
    if after is None:
        return
    left = before.join(after.select("file"), "file", "left_semi")
    folders = left.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
    for row in folders.toLocalIterator():
        delete_path(spark, row.folder)


def write_rollups(
    frames: dict[str, DataFrame],
    root: str,
    mode: str = "overwrite",
    days: set[date] | None = None,
    replaced: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, str]:
    """Writes each frame to its own folder below ``root``; returns the paths.

    "append" adds to what is there. "overwrite" replaces the partitions that
    get rows and, given the ``days`` of a run and which partitions of a listing
    are ``replaced`` by it, removes those of the run that get none: they still
    have a file from before. The datasets do not depend on each other, so their
    jobs are submitted side by side and one fills the cores that another's last
    tasks leave idle.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if not frames:
        return {}
    paths = {name: f"{root.rstrip('/')}/{name}" for name in frames}
    spark = next(iter(frames.values())).sparkSession
    before = None
    if mode == "overwrite" and replaced is not None:
        before = files_of_days(spark, list(paths.values()), days or set())
    if before is None:
        _write_all(frames, paths, mode)
        return paths
    with scratch_path(spark, "replaced") as staged:
        schema = before.schema
        replaced(before).write.parquet(staged)
        _write_all(frames, paths, mode)
        remove_left(spark, spark.read.schema(schema).parquet(staged), list(paths.values()), days or set())
    return paths


def _write_all(frames: dict[str, DataFrame], paths: dict[str, str], mode: str) -> None:
    with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
        jobs = [
            pool.submit(inheritable_thread_target(frame.sparkSession)(write_rollup), frame, paths[name], mode)
            for name, frame in frames.items()
        ]
        for job in jobs:
            job.result()
