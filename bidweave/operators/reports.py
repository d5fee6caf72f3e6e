"""Rollups joined with their failure reasons.

A rollup row repeats once per failure reason, so measures of a report must not
be summed again; sum the unjoined rollups instead.

All inputs of a report are aggregates of the same log rows and hence small next
to the log. The failure reasons are the side that can grow long for one key, so
they are the streamed (left) side of the join, which adaptive execution can
split; the rollup side holds only a key's advertisers or flights.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.functions.columns import bucket_of
from bidweave.schema import Grain, grain_of


def group_report_keys(grain: str | Grain) -> list[str]:
    return [*grain_of(grain).keys, "campaign_group_id", "flight_id"]


def any_null(keys: list[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def groups_with_null_key(rows: DataFrame, grain: str | Grain) -> DataFrame:
    """Ids of the rollup rows that have a NULL among the report's keys.

    Needs no payload and no measure, so on a log it is a narrow scan.
    """
    keys = group_report_keys(grain)
    return rows.where(any_null(keys)).select(*keys, "advertiser_id").distinct()


def _attached(
    left: DataFrame, rollup: DataFrame, keys: list[str], extra: list[str]
) -> DataFrame:
    """``left`` with the rollup columns of equal keys, NULL equal to NULL."""
    a, b = left.alias("a"), rollup.alias("b")
    same = reduce(and_, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    side = {c: "a" if c in keys else "b" for c in rollup.columns}
    return a.join(b, same, "left").select(
        *[F.col(f"{side[c]}.{c}") for c in rollup.columns], *[F.col(f"a.{c}") for c in extra]
    )


def campaign_group_report(
    rollup: DataFrame,
    reasons: DataFrame,
    lone: DataFrame,
    grain: str | Grain,
    null_safe: bool = False,
) -> DataFrame:
    """Full outer join of campaign-group rollup and failure reasons.

    All inputs stem from the same rows, so a key without NULLs is present on
    both sides and a key with a NULL never matches: its rollup rows and its
    reason rows stay, half empty. The rollup rows that stay are known
    beforehand (``lone``, from ``groups_with_null_key``). They join the reasons
    on the left side under their own advertiser, which turns the full outer
    join into a left join that reads the rollup once.

    With ``null_safe`` NULL keys match each other and nothing stays half empty.
    """
    keys = group_report_keys(grain)
    extra = [c for c in reasons.columns if c not in keys]
    if null_safe:
        return _attached(reasons, rollup, keys, extra)
    owner = F.when(any_null(keys), F.col("advertiser_id"))
    marked = rollup.withColumns({"is_lone": any_null(keys), "owner": owner})
    left = reasons.withColumns({"is_lone": F.lit(False)}).unionByName(
        lone.withColumnRenamed("advertiser_id", "owner").withColumn("is_lone", F.lit(True)),
        allowMissingColumns=True,
    )
    return _attached(left, marked, [*keys, "is_lone", "owner"], extra).drop("is_lone", "owner")


def campaign_report(rollup: DataFrame, reasons: DataFrame, grain: str | Grain) -> DataFrame:
    """Inner join of campaign rollup and failure reasons; NULL keys drop out."""
    keys = [*grain_of(grain).keys, "campaign_group_id", "campaign_id"]
    extra = [c for c in reasons.columns if c not in keys]
    return reasons.join(rollup, keys, "inner").select(*rollup.columns, *extra)


def bucket_from_group(report: DataFrame) -> DataFrame:
    """Fills the bucket of half-empty rows from their campaign group id."""
    return report.withColumn("cgid_mod", bucket_of(F.col("campaign_group_id")))
