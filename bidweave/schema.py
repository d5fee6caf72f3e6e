"""Column names and types of the bid log, its JSON payload and the rollups."""

from __future__ import annotations

from pyspark.sql import types as T

# Names of the counters carried by the pacing payload (all text).
PAYLOAD_COUNTERS = [
    "flight_campaign_spend",
    "flight_campaign_spend_cap",
    "flight_campaign_group_spend",
    "flight_campaign_group_spend_cap",
    "flight_campaign_impression",
    "flight_campaign_impression_cap",
    "flight_campaign_group_impression",
    "flight_campaign_group_impression_cap",
    "daily_campaign_group_spend",
    "daily_campaign_group_spend_cap",
    "daily_campaign_spend",
    "daily_campaign_spend_cap",
    "daily_campaign_impression",
    "daily_campaign_impression_cap",
    "daily_campaign_group_impression",
    "daily_campaign_group_impression_cap",
]

# Counters whose maximum each rollup reports, in output order.
CAMPAIGN_GROUP_COUNTERS = [
    "flight_campaign_group_spend",
    "flight_campaign_group_spend_cap",
    "flight_campaign_impression",
    "flight_campaign_impression_cap",
    "flight_campaign_group_impression",
    "flight_campaign_group_impression_cap",
    "daily_campaign_group_spend",
    "daily_campaign_group_spend_cap",
    "daily_campaign_group_impression",
    "daily_campaign_group_impression_cap",
]
CAMPAIGN_COUNTERS = [
    "flight_campaign_spend",
    "flight_campaign_spend_cap",
    "daily_campaign_spend",
    "daily_campaign_spend_cap",
    "flight_campaign_impression",
    "flight_campaign_impression_cap",
    "daily_campaign_impression",
    "daily_campaign_impression_cap",
]

# Number of buckets a campaign group id is spread over, and the
# bucket argument that stands for "all buckets".
BUCKETS = 100
ALL_BUCKETS = 999

PARTITION_COLUMNS = ["dt", "hh", "cgid_mod"]

TERMS_TYPE = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

TERM_PAYLOAD_FIELDS = ["picked_term_id", "eligible_term_ids", "terms"]
ALL_PAYLOAD_FIELDS = PAYLOAD_COUNTERS + TERM_PAYLOAD_FIELDS

BID_LOG_SCHEMA = T.StructType(
    [
        T.StructField("epoch", T.LongType()),
        T.StructField("advertiser_id", T.LongType()),
        T.StructField("campaign_group_id", T.LongType()),
        T.StructField("campaign_id", T.LongType()),
        T.StructField("flight_id", T.LongType()),
        T.StructField("auction_id", T.StringType()),
        T.StructField("has_price", T.StringType()),
        T.StructField("price", T.DecimalType(12, 4)),
        T.StructField("threshold_failure_reasons", T.StringType()),
        T.StructField("pacing_debug_data", T.StringType()),
    ]
)

PARTITION_FIELDS = [
    T.StructField("dt", T.DateType()),
    T.StructField("hh", T.IntegerType()),
    T.StructField("cgid_mod", T.IntegerType()),
]


def payload_schema(fields: list[str] | None = None) -> T.StructType:
    """JSON schema of the pacing payload, limited to ``fields`` when given."""
    wanted = ALL_PAYLOAD_FIELDS if fields is None else fields
    return T.StructType(
        [T.StructField(f, TERMS_TYPE if f == "terms" else T.StringType()) for f in wanted]
    )


class Grain:
    """Time grain of a rollup: its key columns and the names derived from it."""

    def __init__(self, name: str, keys: list[str], short: str, price: str) -> None:
        self.name = name
        self.keys = keys
        self.short = short
        self.price = price

    def dataset(self, stem: str) -> str:
        return f"{stem}_log_agg_{self.short}"


GRAINS = {
    "hour": Grain("hour", ["dt", "hh"], "hr", "bid_price_per_hour"),
    "minute": Grain("minute", ["dt", "hh", "min"], "min", "bid_price_per_min"),
}


def grain_of(grain: str | Grain) -> Grain:
    if isinstance(grain, Grain):
        return grain
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {sorted(GRAINS)}, got {grain!r}")
    return GRAINS[grain]
