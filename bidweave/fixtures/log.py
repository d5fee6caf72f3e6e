"""Bid logs derived from the driver's ``events`` and ``lineitem`` tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.schema import PARTITION_COLUMNS
from bidweave.sinks.log import log_keys

# Modulus of the event id that gives each payload counter its value.
COUNTER_MODULUS = {
    "flight_campaign_spend_cap": 700,
    "flight_campaign_group_spend_cap": 1200,
    "flight_campaign_impression": 40,
    "flight_campaign_impression_cap": 90,
    "flight_campaign_group_impression": 130,
    "flight_campaign_group_impression_cap": 1100,
    "daily_campaign_group_spend_cap": 300,
    "daily_campaign_spend_cap": 310,
    "daily_campaign_impression": 21,
    "daily_campaign_impression_cap": 110,
    "daily_campaign_group_impression": 33,
    "daily_campaign_group_impression_cap": 210,
}
SPEND_COUNTERS = [
    "flight_campaign_spend",
    "flight_campaign_group_spend",
    "daily_campaign_group_spend",
    "daily_campaign_spend",
]
EVENT_TYPES = ["view", "signup", "purchase", "error", "click"]


def _group() -> Column:
    return 98 + F.col("user_id") % 4


def event_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per event: 30 days, about one row per minute key."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("epoch"),
        _group().alias("campaign_group_id"),
    )


def lineitem_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per line item: many rows per minute key, in the hours 22, 23, 0 and 1
    around three midnights, so that every window leaves rows out on both sides. Some
    groups are NULL or negative."""
    second = (F.col("l_orderkey") * 97 + F.col("l_linenumber") * 13) % 14400
    second = second - 7200 + F.col("l_orderkey") % 3 * 86400
    kind = F.element_at(
        F.array(*[F.lit(t) for t in EVENT_TYPES]), (F.col("l_linenumber") % 5 + 1).cast("int")
    )
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.col("l_suppkey").alias("user_id"),
        kind.alias("event_type"),
        F.col("l_extendedprice").alias("value"),
        (F.lit(1704067200000) + second * 1000).cast("bigint").alias("epoch"),
    ).withColumn(
        "campaign_group_id",
        F.when(F.col("event_id") % 19 == 0, None)
        .when(F.col("event_id") % 23 == 0, -_group())
        .otherwise(_group()),
    )


def _term(i: int, spend: Column) -> Column:
    event_id = F.col("event_id")
    limited = F.when(event_id % 7 == 0, "maybe").when(event_id % 7 < 3, "true").otherwise("false")
    entries = {
        "id": (event_id % 5 + i).cast("string"),
        "spend": spend,
        "spend_cap": (event_id % 500).cast("string"),
        "spend_capped": F.when(event_id % 2 == 0, "true").otherwise("false"),
        "rate_limited": limited,
        "throttling_percentage": (event_id % 100).cast("string"),
    }
    if i == 0:
        entries["bid_volume_percentage"] = (event_id * 3 % 100).cast("string")
    return F.create_map(*[part for k, v in entries.items() for part in (F.lit(k), v)])


def derive_bid_log(inputs: DataFrame, kept: Sequence[str] = ()) -> DataFrame:
    """Raw bid log rows, JSON payload included, from the inputs above; ``kept`` are more of their columns."""
    event_id, user_id, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    priced = kind.isin("purchase", "click")
    spend = F.col("value").cast("decimal(12,2)").cast("string")
    counters = [spend.alias(c) for c in SPEND_COUNTERS] + [
        (event_id % m).cast("string").alias(c) for c, m in COUNTER_MODULUS.items()
    ]
    eligible = F.when(event_id % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(3)))
    terms = F.slice(F.array(_term(0, spend), _term(1, spend)), 1, (event_id % 3).cast("int"))
    payload = F.to_json(
        F.struct(
            *counters,
            (event_id % 5).cast("string").alias("picked_term_id"),
            eligible.alias("eligible_term_ids"),
            terms.alias("terms"),
        )
    )
    return inputs.select(
        "epoch",
        (user_id % 2).alias("advertiser_id"),
        "campaign_group_id",
        (_group() * 10 + user_id % 3).alias("campaign_id"),
        F.when(event_id % 11 != 0, 500 + user_id % 2).alias("flight_id"),
        F.when(event_id % 17 != 0, event_id.cast("string")).alias("auction_id"),
        F.when(priced, "true").when(kind != "error", "false").alias("has_price"),
        F.when(priced, F.col("value").cast("decimal(12,4)")).alias("price"),
        F.when(kind == "error", "budget")
        .when(kind == "view", "floor")
        .when(kind != "signup", "")
        .alias("threshold_failure_reasons"),
        F.when(event_id % 13 == 0, "{bad").otherwise(payload).alias("pacing_debug_data"),
        *kept,
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_bid_log(event_inputs(spark, sf_dir))


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_bid_log(lineitem_inputs(spark, sf_dir))


def dealt_lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log above with its partition columns, dealt out and ordered by them.

    The inputs are dealt and ordered before the payload is made, which is many
    times as long; written by partition, the rows are not sorted again.
    """
    keyed = lineitem_inputs(spark, sf_dir).withColumns(log_keys())
    # A column that cannot be NULL keeps its order in a partitioned write; empty text is stored as NULL is.
    keyed = keyed.withColumn("hh", F.coalesce("hh", F.lit("")))
    dealt = keyed.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS)
    return derive_bid_log(dealt, PARTITION_COLUMNS)
