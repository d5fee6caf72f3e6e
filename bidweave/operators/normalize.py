"""Bid log rows made ready for aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidweave.functions.columns import (
    bucket_of,
    day_text,
    event_day,
    event_hour,
    event_minute,
    flag,
)
from bidweave.schema import payload_schema

BASE_COLUMNS = [
    "epoch",
    "advertiser_id",
    "campaign_group_id",
    "campaign_id",
    "flight_id",
    "auction_id",
]


def time_buckets(log: DataFrame) -> DataFrame:
    """``dt`` (DATE), ``hh`` and ``min`` computed from ``epoch``.

    They replace the partition columns of the same name: a late row counts
    for the hour it happened in, not for the folder it was stored in.
    """
    epoch = F.col("epoch")
    return log.withColumns(
        {"dt": event_day(epoch), "hh": event_hour(epoch), "min": event_minute(epoch)}
    )


def parse_pacing(log: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Adds the payload fields as columns, parsing each JSON text once.

    ``fields`` limits the parse to what the caller needs, so that unwanted
    members are skipped by the JSON reader rather than built and dropped.
    """
    schema = payload_schema(fields)
    columns = [c for c in log.columns if c != "pacing_debug_data"]
    parsed = log.select(*columns, F.from_json("pacing_debug_data", schema).alias("pacing"))
    # The payload's list of eligible terms serves as one key in its JSON text form.
    names = {"eligible_term_ids": "eligible_term_id"}
    return parsed.select(
        *columns,
        *[F.col("pacing").getField(f).alias(names.get(f, f)) for f in schema.fieldNames()],
    )


def normalize_bid_log(log: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Typed log rows with bucket, time columns and the payload ``fields``.

    An empty list leaves the payload unread, and its column out of the scan.
    """
    typed = log.select(
        *BASE_COLUMNS,
        flag(F.col("has_price")).alias("has_price"),
        "price",
        "threshold_failure_reasons",
        "pacing_debug_data",
        bucket_of(F.col("campaign_group_id")).alias("cgid_mod"),
    )
    timed = time_buckets(typed)
    if fields is not None and not fields:
        return timed.drop("pacing_debug_data")
    return parse_pacing(timed, fields)


def publish(df: DataFrame) -> DataFrame:
    """Result form of a frame: ``dt`` as text."""
    return df.withColumn("dt", day_text(F.col("dt")))
