"""The jobs a user calls: daily and intraday runs at either grain."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.operators import rollups as R
from bidweave.operators.reports import (
    bucket_from_group,
    campaign_group_report,
    campaign_report,
    groups_with_null_key,
)
from bidweave.plans.base import Base, stage_base
from bidweave.plans.late import Scope, scope_log, scope_of, scope_of_keys
from bidweave.schema import GRAINS, PARTITION_COLUMNS, Grain, grain_of
from bidweave.session import scratch_path
from bidweave.sinks.rollups import MODES, write_rollups
from bidweave.sources.bid_log import scan_bid_log
from bidweave.sources.windows import Window, parse_mods


def rollup_datasets(
    base: Base, grain: str | Grain, null_safe: bool = False, numeric_max: bool = False
) -> dict[str, DataFrame]:
    """The three result datasets of one grain, by name."""
    g = grain_of(grain)
    group_report = campaign_group_report(
        R.campaign_group_rollup(base.bids, g, numeric_max),
        R.campaign_group_failure_reasons(base.bids, g),
        groups_with_null_key(base.bids, g),
        g,
        null_safe,
    )
    report = campaign_report(
        R.campaign_rollup(base.bids, g, numeric_max), R.campaign_failure_reasons(base.bids, g), g
    )
    return {
        g.dataset("campaign_group"): group_report,
        g.dataset("campaign"): report,
        g.dataset("terms"): R.term_rollup(base.terms, g, numeric_max),
    }


def finest(grains: Iterable[str]) -> str:
    return max(grains, key=lambda g: len(GRAINS[g].keys))


def run_rollups(
    spark: SparkSession,
    source: str,
    target: str,
    window: Window,
    grains: str | Iterable[str] = ("hour",),
    mods: str | Iterable[int] | None = None,
    mode: str = "overwrite",
    null_safe: bool = False,
    numeric_max: bool = False,
    schema: T.StructType | None = None,
) -> dict[str, str]:
    """Rolls a window of the log up and writes the datasets below ``target``.

    One pass over the log serves all datasets of all ``grains``. Returns the
    path of each dataset.

    "append" adds the rows stored in the window's partitions. "overwrite"
    replaces the window's hours and buckets, and all others that have rows
    stored in them (see ``bidweave.plans.late``), with all of their rows;
    rows without ``epoch`` count at the start of the hour they are stored in.
    """
    wanted = [grains] if isinstance(grains, str) else list(grains)
    for g in wanted:
        grain_of(g)
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    chosen, target = parse_mods(mods), target.rstrip("/")
    with scratch_path(spark, "run") as path:
        scope = None
        if mode == "append":
            raw = scan_bid_log(spark, source, window, chosen, schema)
        else:
            scope = scope_of(spark, source, target, window, chosen, f"{path}/scope", schema)
            raw = scope_log(spark, source, scope, schema)
        return _roll_up(raw, target, wanted, scope, f"{path}/base", null_safe, numeric_max)


def reroll(
    spark: SparkSession,
    source: str,
    target: str,
    keys: DataFrame,
    grains: str | Iterable[str] = ("hour",),
    null_safe: bool = False,
    numeric_max: bool = False,
    schema: T.StructType | None = None,
) -> dict[str, str]:
    """Rolls single hours and buckets up again, each with all of its rows.

    ``keys`` are (dt, hh, cgid_mod). The rows are those stored in the very
    partitions and in the ones that the notes of earlier runs name.
    """
    wanted, target = [grains] if isinstance(grains, str) else list(grains), target.rstrip("/")
    with scratch_path(spark, "run") as path:
        scope = scope_of_keys(spark, target, keys, f"{path}/scope")
        raw = scope_log(spark, source, scope, schema)
        return _roll_up(raw, target, wanted, scope, f"{path}/base", null_safe, numeric_max)


def _roll_up(
    raw: DataFrame,
    target: str,
    grains: list[str],
    scope: Scope | None,
    path: str,
    null_safe: bool,
    numeric_max: bool,
) -> dict[str, str]:
    base = stage_base(raw.sparkSession, raw, finest(grains), path, numeric_max)
    frames: dict[str, DataFrame] = {}
    for g in grains:
        for name, frame in rollup_datasets(base, g, null_safe, numeric_max).items():
            # Runs over different buckets must not share one NULL bucket.
            frames[name] = bucket_from_group(frame) if scope else frame
    if scope is None:
        return write_rollups(frames, target, "append")
    replaced = partial(scope.replaced, names=PARTITION_COLUMNS)
    return write_rollups(frames, target, "overwrite", scope.days(), replaced)


def daily_job(
    spark: SparkSession,
    source: str,
    target: str,
    grain: str = "hour",
    day: str | date | None = None,
    hour: int | str | None = None,
    mods: str | Iterable[int] | None = None,
    **options,
) -> dict[str, str]:
    """Rollups of one day (yesterday by default) or of one of its hours."""
    whole = hour in (None, "", "None")
    today = spark.range(1).select(F.current_date()).first()[0]
    window = Window.day(day, today) if whole else Window.hour(day, hour, today)
    return run_rollups(spark, source, target, window, grain, mods, **options)


def intraday_job(
    spark: SparkSession,
    source: str,
    target: str,
    executed_at: str | datetime,
    grain: str = "hour",
    mods: str | Iterable[int] | None = None,
    **options,
) -> dict[str, str]:
    """Rollups of the six hours before the execution time."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    window = Window.trailing(executed_at, zone=zone)
    return run_rollups(spark, source, target, window, grain, mods, **options)
