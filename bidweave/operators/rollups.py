"""Rollups of the bid log.

Every measure is first written as a per-row column (0/1 counts, price, counter
texts). Sums of sums and maxima of maxima give the same result as one pass, so
each rollup below works unchanged on log rows and on an already aggregated
base (``bidweave.plans.base``).

Keys are listed with the most selective id first: text maxima make Spark plan a
sort-based aggregate, and its sort compares keys from left to right. The bucket
follows from the campaign group id and is added after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.functions.columns import bucket_of, max_text, text_flag
from bidweave.schema import CAMPAIGN_COUNTERS, CAMPAIGN_GROUP_COUNTERS, Grain, grain_of

REASONS = "threshold_failure_reasons"
VOLUMES = ["total_bid_requests", "total_bids", "total_204_bids"]
TERM_COUNTS = ["total_spend_capped", "total_rate_limited"]
TERM_TEXTS = ["term_spend", "term_spend_cap", "throttling_percentage", "bid_volume_percentage"]

BID_KEYS = ["campaign_id", "campaign_group_id", "flight_id", "advertiser_id", REASONS]
TERM_KEYS = [
    "campaign_id",
    "campaign_group_id",
    "flight_id",
    "advertiser_id",
    "eligible_term_id",
    "picked_term_id",
    "term_id",
]


def one_if(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def volume_columns() -> list[Column]:
    return [
        one_if(F.col("auction_id").isNotNull()).alias("total_bid_requests"),
        one_if(F.col("has_price")).alias("total_bids"),
        one_if(~F.col("has_price")).alias("total_204_bids"),
    ]


def bid_rows(log: DataFrame) -> DataFrame:
    """Log rows with their bid measures; keeps the counters that were parsed."""
    used = {"epoch", "auction_id", "has_price", "terms", "picked_term_id", "eligible_term_id"}
    return log.select(*[c for c in log.columns if c not in used], *volume_columns())


def flatten_terms(log: DataFrame) -> DataFrame:
    """One row per pacing term; rows with a NULL or empty term list yield none."""
    one = log.select(
        "dt",
        "hh",
        "min",
        "cgid_mod",
        "advertiser_id",
        "flight_id",
        "campaign_group_id",
        "campaign_id",
        "threshold_failure_reasons",
        "auction_id",
        "eligible_term_id",
        "picked_term_id",
        "has_price",
        F.explode("terms").alias("term"),
    )
    return one.select(*[c for c in one.columns if c != "term"], *term_columns(F.col("term")))


def term_columns(term: Column) -> list[Column]:
    """Members of one term map; an absent key gives NULL."""
    names = {"id": "term_id", "spend": "term_spend", "spend_cap": "term_spend_cap"}
    plain = ["spend_capped", "rate_limited", "throttling_percentage", "bid_volume_percentage"]
    return [term.getItem(key).alias(name) for key, name in names.items()] + [
        term.getItem(key).alias(key) for key in plain
    ]


def term_rows(terms: DataFrame) -> DataFrame:
    """Flattened terms with their measures."""
    used = {"auction_id", "has_price", "spend_capped", "rate_limited", REASONS}
    return terms.select(
        *[c for c in terms.columns if c not in used],
        *volume_columns(),
        one_if(text_flag(F.col("spend_capped"))).alias("total_spend_capped"),
        one_if(text_flag(F.col("rate_limited"))).alias("total_rate_limited"),
    )


def sums(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def price_sum(rows: DataFrame, name: str) -> Column:
    """Sum of prices; re-summing keeps the type of the first sum."""
    if "price_sum" in rows.columns:
        return F.sum("price_sum").cast(rows.schema["price_sum"].dataType).alias(name)
    return F.sum("price").alias(name)


def with_bucket(rollup: DataFrame, after: str) -> DataFrame:
    """Adds ``cgid_mod`` behind the column ``after``."""
    place = rollup.columns.index(after) + 1
    names = rollup.columns
    bucket = bucket_of(F.col("campaign_group_id")).alias("cgid_mod")
    return rollup.select(*names[:place], bucket, *names[place:])


def campaign_group_rollup(
    rows: DataFrame, grain: str | Grain, numeric_max: bool = False
) -> DataFrame:
    """Volumes, price and counter maxima per campaign group and flight."""
    g = grain_of(grain)
    ids = ["campaign_group_id", "flight_id", "advertiser_id"]
    totals = rows.groupBy(*ids, *reversed(g.keys)).agg(
        *sums(VOLUMES),
        price_sum(rows, g.price),
        *[max_text(F.col(c), numeric_max).alias(f"max_{c}") for c in CAMPAIGN_GROUP_COUNTERS],
    )
    ordered = totals.select(*g.keys, *ids, *totals.columns[len(ids) + len(g.keys) :])
    return with_bucket(ordered, "advertiser_id")


def campaign_rollup(rows: DataFrame, grain: str | Grain, numeric_max: bool = False) -> DataFrame:
    """Volumes, price and counter maxima per campaign and flight."""
    g = grain_of(grain)
    ids = ["campaign_id", "campaign_group_id", "flight_id", "advertiser_id"]
    totals = rows.groupBy(*ids, *reversed(g.keys)).agg(
        *sums(VOLUMES),
        price_sum(rows, g.price),
        *[max_text(F.col(c), numeric_max).alias(f"max_{c}") for c in CAMPAIGN_COUNTERS],
    )
    shown = ["campaign_group_id", "campaign_id", "advertiser_id", "flight_id"]
    ordered = totals.select(*g.keys, *shown, *totals.columns[len(ids) + len(g.keys) :])
    return with_bucket(ordered, "flight_id")


def term_rollup(rows: DataFrame, grain: str | Grain, numeric_max: bool = False) -> DataFrame:
    """Volumes, limits and maxima per pacing term.

    The spend maximum is taken on the text and only then read as a decimal.
    """
    g = grain_of(grain)
    maxima = {t: max_text(F.col(t), numeric_max) for t in TERM_TEXTS}
    totals = rows.groupBy(*TERM_KEYS, *reversed(g.keys)).agg(
        *sums(VOLUMES + TERM_COUNTS),
        maxima["term_spend"].try_cast("decimal(10,2)").alias("max_term_spend"),
        maxima["term_spend_cap"].alias("max_term_spend_cap"),
        maxima["throttling_percentage"].alias("throttling_percentage"),
        maxima["bid_volume_percentage"].alias("bid_volume_percentage"),
    )
    return totals.select(
        *g.keys,
        bucket_of(F.col("campaign_group_id")).alias("cgid_mod"),
        "advertiser_id",
        "flight_id",
        "campaign_group_id",
        "campaign_id",
        "eligible_term_id",
        "picked_term_id",
        "term_id",
        *totals.columns[len(TERM_KEYS) + len(g.keys) :],
    )


def campaign_group_failure_reasons(rows: DataFrame, grain: str | Grain) -> DataFrame:
    """Requests per campaign group, flight and failure reason."""
    g = grain_of(grain)
    return rows.groupBy(
        *g.keys,
        "flight_id",
        "campaign_group_id",
        F.col(REASONS).alias("cg_threshold_failure_reasons"),
    ).agg(F.sum("total_bid_requests").alias("fail_count_cg_id"))


def campaign_failure_reasons(rows: DataFrame, grain: str | Grain) -> DataFrame:
    """Requests per campaign and failure reason, over all its flights."""
    g = grain_of(grain)
    return rows.groupBy(
        *g.keys,
        "campaign_group_id",
        "campaign_id",
        F.col(REASONS).alias("campaign_threshold_failure_reasons"),
    ).agg(F.sum("total_bid_requests").alias("fail_count_campaign_id"))
