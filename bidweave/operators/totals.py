"""Totals over several levels of the ids at once, and the greatest ones with ties."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidweave.operators.rollups import VOLUMES, price_sum, sums
from bidweave.schema import Grain, grain_of

#: From the whole to single campaigns; a row of a level sums up the rows of the next.
LEVELS = ["advertiser_id", "campaign_group_id", "campaign_id"]


def totals_by_level(rows: DataFrame, grain: str | Grain) -> DataFrame:
    """Volumes and price of every campaign, campaign group and advertiser, and of all.

    ``rows`` are bid rows or their staged base, before any join with failure
    reasons, so nothing is counted twice. ``level`` is the number of ids that a
    row is about (3 to 0); the ids below are NULL, and so are missing ids, which
    ``level`` tells apart. A group's campaigns are told apart by advertiser, as
    its rows are. The rows are expanded once, aggregated before the exchange.
    """
    g = grain_of(grain)
    time = [F.col(k) for k in g.keys]
    sets = [[*time, *[F.col(c) for c in LEVELS[:n]]] for n in range(len(LEVELS), -1, -1)]
    grouped = rows.groupingSets(sets, *time, *[F.col(c) for c in LEVELS])
    # The bits of the ids that a set leaves out, the last one lowest.
    left_out = sum((F.grouping(c).cast("int") for c in LEVELS), F.lit(0))
    return grouped.agg(
        (F.lit(len(LEVELS)) - left_out).cast("int").alias("level"), *sums(VOLUMES), price_sum(rows, g.price)
    ).select(*g.keys, *LEVELS, "level", *VOLUMES, g.price)


def _same(names: list[str]) -> Column:
    return reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names])


def top_with_ties(rows: DataFrame, within: list[str], by: str, k: int, salts: int = 32) -> DataFrame:
    """The rows whose rank by falling ``by`` is at most ``k`` in their group, with ``rank``.

    All rows that tie with the ``k``-th are kept; rows with a NULL ``by`` have
    no rank and are left out. A group is first searched in parts: the ``k``
    greatest values of each part contain those of the group. Rows below the
    ``k``-th of these go before anything is ordered, and ranks come from the
    few distinct values left, so no task gets a whole group or all of its ties.
    """
    known = rows.where(F.col(by).isNotNull())
    salted = known.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    parts = Window.partitionBy(*within, "__salt").orderBy(F.desc(by))
    best = salted.select(*within, "__salt", by, F.row_number().over(parts).alias("__n")).where(F.col("__n") <= k)
    whole = Window.partitionBy(*within).orderBy(F.desc(by))
    limit = best.select(*within, by, F.row_number().over(whole).alias("__n")).where(F.col("__n") <= k)
    limit = limit.groupBy(*within).agg(F.min(by).alias("__least"))
    kept = known.alias("a").join(limit.alias("b"), _same(within)).where(F.col(f"a.{by}") >= F.col("b.__least"))
    kept = kept.select("a.*")
    # At most k distinct values of a group.
    values = kept.groupBy(*within, by).agg(F.count("*").alias("__rows"))
    above = whole.rowsBetween(Window.unboundedPreceding, -1)
    ranks = values.withColumn("rank", (F.coalesce(F.sum("__rows").over(above), F.lit(0)) + 1).cast("int"))
    joined = kept.alias("a").join(ranks.alias("b"), _same([*within, by]))
    return joined.select("a.*", "b.rank")
