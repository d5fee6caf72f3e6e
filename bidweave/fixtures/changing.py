"""Queries about logs that grow and datasets that change: streams, kept bases, differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.fixtures.log import dealt_lineitem_log, lineitem_log
from bidweave.fixtures.queries import DAY, Query, stacked, stored_log
from bidweave.functions.columns import bucket_of, event_day, event_hour
from bidweave.operators.normalize import publish
from bidweave.plans.jobs import run_rollups
from bidweave.plans.kept import KeptBase, incremental_job
from bidweave.plans.reconcile import diff_rollups
from bidweave.schema import PARTITION_COLUMNS
from bidweave.session import new_shared_path
from bidweave.sinks.log import append_keyed
from bidweave.sources.windows import Window
from bidweave.streaming.rollups import stream_rollups

#: Files of one micro-batch: the stored log makes several.
FEW_FILES = 30


def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches applied out of order, one of them twice, some after a first publication."""
    root, target = new_shared_path(spark, "kept"), new_shared_path(spark, "kept-out")
    log, base = lineitem_log(spark, sf_dir), KeptBase(spark, root)
    part = F.pmod(F.xxhash64("epoch", "campaign_id", "auction_id"), F.lit(4))
    for step, n in enumerate((2, 0, 2, 3, 1)):
        base.apply(log.where(part == n), f"batch-{n}")
        if step in (1, 4):
            written = base.publish(target, ["hour", "minute"])
    return stacked(spark, written)


def q_incremental_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log's files in micro-batches, then a call that finds nothing new."""
    target, log = new_shared_path(spark, "files-out"), stored_log(spark, sf_dir)
    incremental_job(spark, log, target, "minute", max_files=FEW_FILES)
    return stacked(spark, incremental_job(spark, log, target, "minute", max_files=FEW_FILES))


def trailing(rows: DataFrame) -> DataFrame:
    """Rows of the six hours around midnight."""
    before = (F.col("dt") == "2023-12-31") & (F.col("hh") >= 21)
    return rows.where(before | ((F.col("dt") == DAY) & (F.col("hh") < 3)))


def q_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored log as a stream of files, and a second call on it."""
    target, log = new_shared_path(spark, "stream-out"), stored_log(spark, sf_dir)
    for _ in range(2):
        written = stream_rollups(spark, log, target, "minute", "1 hour", FEW_FILES)
    return trailing(stacked(spark, written))


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose later files hold rows of hours that are published already."""
    log, target = new_shared_path(spark, "stream-log"), new_shared_path(spark, "late-out")
    rows, epoch = dealt_lineitem_log(spark, sf_dir), F.col("epoch")
    part = F.pmod(F.xxhash64("epoch", "campaign_id", "auction_id"), F.lit(10))
    append_keyed(rows.where(part > 1), log)
    stream_rollups(spark, log, target, ["hour", "minute"], "30 minutes")
    append_keyed(rows.where(part == 0), log)
    # Stored a day and a half behind their time.
    stored = F.timestamp_millis(epoch + 36 * 3_600_000)
    moved = rows.where(part == 1).withColumns(
        {
            "dt": F.date_format(stored, "yyyy-MM-dd"),
            "hh": F.date_format(stored, "HH"),
            "cgid_mod": bucket_of(F.col("campaign_group_id")),
        }
    )
    moved.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(log)
    return trailing(stacked(spark, stream_rollups(spark, log, target, ["hour", "minute"], "30 minutes")))


def q_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs differ in, the second on a log without one advertiser's last hour."""
    left, right, changed = (new_shared_path(spark, n) for n in ("diff-left", "diff-right", "diff-log"))
    epoch = F.col("epoch")
    log = dealt_lineitem_log(spark, sf_dir).where(event_day(epoch) == DAY)
    append_keyed(log.where(~((event_hour(epoch) == 1) & (F.col("advertiser_id") == 0))), changed)
    written = run_rollups(spark, stored_log(spark, sf_dir), left, Window.day(DAY), ["hour", "minute"])
    run_rollups(spark, changed, right, Window.day(DAY), ["hour", "minute"])
    found = diff_rollups(spark, left, right, list(written), new_shared_path(spark, "diff"))
    return publish(found.withColumn("cgid_mod", F.col("cgid_mod").cast("bigint")))


def build() -> dict[str, Query]:
    return {
        "incremental_rollups": q_incremental,
        "incremental_job": q_incremental_job,
        "stream_rollups": q_stream,
        "stream_late_rows": q_stream_late,
        "diff_rollups": q_diff,
    }
