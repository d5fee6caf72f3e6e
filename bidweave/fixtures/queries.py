"""Every operator as a query over the driver's tables.

Single operators run on the log derived from ``events``. Queries about stored
partitions run on the denser log derived from ``lineitem``, written once per
session to the shared folder and read back through the partitioned scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.fixtures.log import dealt_lineitem_log, events_log
from bidweave.functions.columns import bucket_of, event_day, event_hour, flag
from bidweave.operators import rollups as R
from bidweave.operators.normalize import normalize_bid_log, parse_pacing, publish, time_buckets
from bidweave.operators.reports import (
    campaign_group_report,
    campaign_report,
    groups_with_null_key,
)
from bidweave.plans.base import stage_base
from bidweave.plans.jobs import daily_job, intraday_job, rollup_datasets, run_rollups
from bidweave.schema import (
    CAMPAIGN_COUNTERS,
    CAMPAIGN_GROUP_COUNTERS,
    GRAINS,
    PARTITION_COLUMNS,
    TERM_PAYLOAD_FIELDS,
)
from bidweave.session import new_shared_path, scratch_path
from bidweave.sinks.archive import archive_aged_partitions
from bidweave.sinks.log import append_keyed, append_log
from bidweave.sinks.rollups import write_rollups
from bidweave.sources.bid_log import missing_partitions, scan_bid_log
from bidweave.sources.windows import Window

Query = Callable[[SparkSession, str], DataFrame]

DAY = "2024-01-01"
#: All hours of the stored log, for benchmarks.
WHOLE_LOG = Window.trailing("2024-01-03T02:00:00", 52)


def bid_source(log: DataFrame, counters: list[str]) -> DataFrame:
    return R.bid_rows(normalize_bid_log(log, counters))


def term_source(log: DataFrame) -> DataFrame:
    return R.term_rows(R.flatten_terms(normalize_bid_log(log, TERM_PAYLOAD_FIELDS)))


def group_rollup(log: DataFrame, grain: str) -> DataFrame:
    return R.campaign_group_rollup(bid_source(log, CAMPAIGN_GROUP_COUNTERS), grain)


def single_rollup(log: DataFrame, grain: str) -> DataFrame:
    return R.campaign_rollup(bid_source(log, CAMPAIGN_COUNTERS), grain)


def group_reasons(log: DataFrame, grain: str) -> DataFrame:
    return R.campaign_group_failure_reasons(bid_source(log, []), grain)


def single_reasons(log: DataFrame, grain: str) -> DataFrame:
    return R.campaign_failure_reasons(bid_source(log, []), grain)


def terms_of(log: DataFrame, grain: str) -> DataFrame:
    return R.term_rollup(term_source(log), grain)


def group_report(log: DataFrame, grain: str) -> DataFrame:
    lone = groups_with_null_key(bid_source(log, []), grain)
    return campaign_group_report(
        group_rollup(log, grain), group_reasons(log, grain), lone, grain
    )


def single_report(log: DataFrame, grain: str) -> DataFrame:
    return campaign_report(single_rollup(log, grain), single_reasons(log, grain), grain)


def _term_count(df: DataFrame) -> DataFrame:
    counted = F.when(F.col("terms").isNotNull(), F.size("terms")).alias("n_terms")
    return df.select(*[c for c in df.columns if c != "terms"], counted)


def q_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _term_count(publish(normalize_bid_log(events_log(spark, sf_dir))))


def q_time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(time_buckets(events_log(spark, sf_dir).select("epoch")))


def q_parse_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_pacing(events_log(spark, sf_dir))
    return _term_count(parsed.drop("has_price", "price", R.REASONS))


def q_flatten_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = normalize_bid_log(events_log(spark, sf_dir), TERM_PAYLOAD_FIELDS)
    return publish(R.flatten_terms(log))


def q_operator(
    operator: Callable[[DataFrame, str], DataFrame], grain: str, spark: SparkSession, sf_dir: str
) -> DataFrame:
    return publish(operator(events_log(spark, sf_dir), grain))


# Stored log


def write_log(log: DataFrame, path: str) -> str:
    return append_log(log, path)


_stored: dict[tuple[str, str], str] = {}


def stored_log(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = append_keyed(dealt_lineitem_log(spark, sf_dir), new_shared_path(spark, "log"))
    return _stored[key]


def _rows(log: DataFrame) -> DataFrame:
    typed = log.withColumn("has_price", flag(F.col("has_price")))
    return publish(typed.drop("pacing_debug_data"))


def q_scan(
    window: Window | None, mods: str | None, spark: SparkSession, sf_dir: str
) -> DataFrame:
    return _rows(scan_bid_log(spark, stored_log(spark, sf_dir), window, mods))


def q_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = stored_log(spark, sf_dir)
    return missing_partitions(spark, log, Window.day(DAY), "98 99 0 1 2")


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(path)
    return publish(stored.withColumn("cgid_mod", F.col("cgid_mod").cast("bigint")))


def q_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scan_bid_log(spark, stored_log(spark, sf_dir))
    target = new_shared_path(spark, "rollups")
    with scratch_path(spark, "base") as path:
        base = stage_base(spark, raw, "minute", path)
        written = write_rollups(rollup_datasets(base, "minute"), target, "append")
    return stacked(spark, written)


def stacked(spark: SparkSession, written: dict[str, str]) -> DataFrame:
    """All written datasets in one frame, told apart by ``dataset``."""
    frames = [
        read_dataset(spark, path).withColumn("dataset", F.lit(name))
        for name, path in written.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def q_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_shared_path(spark, "run")
    log = stored_log(spark, sf_dir)
    return stacked(spark, run_rollups(spark, log, target, Window.day(DAY), ["hour", "minute"]))


def q_daily(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_shared_path(spark, "daily")
    return stacked(spark, daily_job(spark, stored_log(spark, sf_dir), target, grain, day=DAY))


def q_intraday(grain: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_shared_path(spark, "intraday")
    log = stored_log(spark, sf_dir)
    return stacked(spark, intraday_job(spark, log, target, f"{DAY}T03:00:00", grain))


def q_run_window(
    hour: str | None, mods: str | None, grain: str, mode: str, spark: SparkSession, sf_dir: str
) -> DataFrame:
    """A daily run that leaves most of the stored log out."""
    target, log = new_shared_path(spark, "part"), stored_log(spark, sf_dir)
    written = daily_job(spark, log, target, grain, day=DAY, hour=hour, mods=mods, mode=mode)
    return stacked(spark, written)


def q_run_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intraday run that starts and ends between stored hours."""
    target, log = new_shared_path(spark, "cut"), stored_log(spark, sf_dir)
    return stacked(spark, intraday_job(spark, log, target, f"{DAY}T05:00:00", "minute"))


def q_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive after their hour was run: hours later, the next day, in another
    bucket, or without a time."""
    epoch = F.col("epoch")
    log = dealt_lineitem_log(spark, sf_dir).where(event_day(epoch) == DAY)
    path, target = new_shared_path(spark, "late-log"), new_shared_path(spark, "late-run")
    delay = F.pmod(F.xxhash64("epoch", "campaign_id", "auction_id"), F.lit(20))
    append_keyed(log.where(delay >= 5), path)
    run_rollups(spark, path, target, Window.day(DAY))
    hours = F.when(delay == 0, 1).when(delay == 1, 5).when(delay == 2, 24).otherwise(0)
    stored = F.timestamp_millis(epoch + hours * 3_600_000)
    moved = log.where(delay < 5).withColumns(
        {
            "dt": F.date_format(stored, "yyyy-MM-dd"),
            "hh": F.date_format(stored, "HH"),
            "cgid_mod": F.when(delay == 3, 7).otherwise(bucket_of(F.col("campaign_group_id"))),
            "epoch": F.when(delay != 4, epoch),
        }
    )
    moved.write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(path)
    run_rollups(spark, path, target, Window.trailing(f"{DAY}T11:00:00", 11))
    run_rollups(spark, path, target, Window.trailing("2024-01-02T00:00:00", 2))
    return stacked(spark, run_rollups(spark, path, target, Window.day("2024-01-02")))


def q_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run repeated after an hour and a bucket have gone from the log."""
    target, path = new_shared_path(spark, "rerun"), new_shared_path(spark, "rerun-log")
    run_rollups(spark, stored_log(spark, sf_dir), target, Window.day(DAY))
    bucket = bucket_of(F.col("campaign_group_id"))
    append_keyed(dealt_lineitem_log(spark, sf_dir).where((event_hour(F.col("epoch")) != 1) & (bucket != 98)), path)
    return stacked(spark, run_rollups(spark, path, target, Window.day(DAY)))


def q_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is archived of a log whose later days are written after the age limit."""
    log, old = dealt_lineitem_log(spark, sf_dir), event_day(F.col("epoch")) <= DAY
    root, archive = new_shared_path(spark, "aged"), new_shared_path(spark, "archive")
    append_keyed(log.where(old), root)
    limit = datetime.now(timezone.utc)
    append_keyed(log.where(~old), root)
    archive_aged_partitions(spark, root, archive, days=7, now=limit + timedelta(days=7))
    places = [
        scan_bid_log(spark, path).withColumn("place", F.lit(place))
        for place, path in (("archive", archive), ("log", root))
    ]
    return publish(
        places[0]
        .unionByName(places[1])
        .groupBy("place", *PARTITION_COLUMNS)
        .agg(
            F.count("*").alias("log_rows"),
            F.count("auction_id").alias("auctions"),
            F.sum("price").alias("price"),
        )
    )


def build() -> dict[str, Query]:
    found: dict[str, Query] = {
        "normalize_bid_log": q_normalize,
        "time_buckets": q_time_buckets,
        "parse_pacing": q_parse_pacing,
        "flatten_terms": q_flatten_terms,
    }
    operators = {
        "campaign_group_rollup": group_rollup,
        "campaign_rollup": single_rollup,
        "term_rollup": terms_of,
        "campaign_group_failure_reasons": group_reasons,
        "campaign_failure_reasons": single_reasons,
        "campaign_group_report": group_report,
        "campaign_report": single_report,
    }
    for grain in GRAINS:
        for name, operator in operators.items():
            found[f"{name}_{grain}"] = partial(q_operator, operator, grain)
    found |= {
        "scan_bid_log": partial(q_scan, None, None),
        "window_day": partial(q_scan, Window.day(DAY), None),
        "window_hour": partial(q_scan, Window.hour(DAY, "1"), None),
        "window_mods": partial(q_scan, Window.day(DAY), "98 0 98"),
        "window_all_buckets": partial(q_scan, Window.day(DAY), "98 999"),
        "window_default_date": partial(q_scan, Window.day(None, date(2024, 1, 2)), None),
        "window_trailing_6h": partial(q_scan, Window.trailing(f"{DAY}T05:00:00"), None),
        "missing_partitions": q_missing,
        "write_rollups": q_write,
        "archive_aged_partitions": q_archive,
        "run_rollups": q_run,
        "run_daily_one_hour": partial(q_run_window, "22", None, "hour", "overwrite"),
        "run_daily_buckets": partial(q_run_window, None, "98 0", "hour", "overwrite"),
        "run_daily_hour_and_buckets": partial(q_run_window, "1", "99 -98", "minute", "overwrite"),
        "run_daily_all_buckets": partial(q_run_window, "1", "98 999", "hour", "overwrite"),
        "run_daily_append": partial(q_run_window, None, None, "hour", "append"),
        "run_intraday_cut": q_run_cut,
        "run_late_rows": q_late,
        "rerun_rollups": q_rerun,
    }
    for grain in GRAINS:
        found[f"run_daily_{grain}"] = partial(q_daily, grain)
        found[f"run_intraday_{grain}"] = partial(q_intraday, grain)
    return found
