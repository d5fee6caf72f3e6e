"""Finest-grain aggregate that all rollups of a run are derived from.

One run produces campaign-group, campaign and term rollups, the first two with
failure reasons. Reading and parsing the log for each would cost five scans.
Here every log row turns into one bid record plus one record per pacing term,
and a single aggregation brings both kinds to their finest keys: one scan, one
JSON parse, one shuffle of partially aggregated records.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidweave.functions.columns import max_text, text_flag
from bidweave.operators.normalize import normalize_bid_log
from bidweave.operators.rollups import (
    BID_KEYS,
    REASONS,
    TERM_COUNTS,
    TERM_KEYS,
    TERM_TEXTS,
    VOLUMES,
    one_if,
    price_sum,
    sums,
    term_columns,
    volume_columns,
)
from bidweave.schema import PAYLOAD_COUNTERS, Grain, grain_of
from bidweave.session import small_splits


class Base(NamedTuple):
    """Aggregated bid rows and term rows of one window."""

    bids: DataFrame
    terms: DataFrame


def records(log: DataFrame) -> DataFrame:
    """Bid records and term records of normalized log rows, in one frame.

    Position 0 of the exploded list is the bid record, the others are the
    terms. Columns of the other kind are NULL, so they add no groups.
    """
    term_type = log.schema["terms"].dataType
    no_terms = F.array().cast(term_type)
    bid_slot = F.array(F.lit(None).cast(term_type.elementType))
    slots = F.concat(bid_slot, F.coalesce(F.col("terms"), no_terms))
    kept = [c for c in log.columns if c != "terms"]
    rows = log.select(*kept, F.posexplode(slots).alias("slot", "term"))
    is_bid = F.col("slot") == 0
    members = rows.select("*", *term_columns(F.col("term")))
    shared = [k for k in TERM_KEYS if k in BID_KEYS]
    return members.select(
        is_bid.alias("is_bid"),
        "dt",
        "hh",
        "min",
        *shared,
        F.when(is_bid, F.col(REASONS)).alias(REASONS),
        F.when(~is_bid, F.col("eligible_term_id")).alias("eligible_term_id"),
        F.when(~is_bid, F.col("picked_term_id")).alias("picked_term_id"),
        "term_id",
        *volume_columns(),
        F.when(is_bid, F.col("price")).alias("price"),
        *[F.when(is_bid, F.col(c)).alias(c) for c in PAYLOAD_COUNTERS],
        one_if(text_flag(F.col("spend_capped"))).alias("total_spend_capped"),
        one_if(text_flag(F.col("rate_limited"))).alias("total_rate_limited"),
        *TERM_TEXTS,
    )


def aggregate_records(log: DataFrame, grain: str | Grain, numeric_max: bool = False) -> DataFrame:
    """Bid and term records of ``log`` aggregated at the finest keys."""
    return merge_records(records(log), grain, numeric_max)


def merge_records(
    rows: DataFrame, grain: str | Grain, numeric_max: bool = False, keys: Iterable[str] = ()
) -> DataFrame:
    """Aggregated records of all rows, from single records or from those of several batches.

    ``keys`` are kept besides those of the records.
    """
    g = grain_of(grain)
    ids = [*BID_KEYS, *[k for k in TERM_KEYS if k not in BID_KEYS], "is_bid"]
    return rows.groupBy(*ids, *reversed(g.keys), *keys).agg(
        *sums(VOLUMES + TERM_COUNTS),
        price_sum(rows, "price_sum"),
        *[max_text(F.col(c), numeric_max).alias(c) for c in PAYLOAD_COUNTERS + TERM_TEXTS],
    )


def split_records(aggregated: DataFrame, grain: str | Grain) -> Base:
    g = grain_of(grain)
    bids = aggregated.where(F.col("is_bid"))
    terms = aggregated.where(~F.col("is_bid"))
    return Base(
        bids.select(*g.keys, *BID_KEYS, *VOLUMES, "price_sum", *PAYLOAD_COUNTERS),
        terms.select(*g.keys, *TERM_KEYS, *VOLUMES, *TERM_COUNTS, *TERM_TEXTS),
    )


def stage_base(
    spark: SparkSession,
    raw: DataFrame,
    grain: str | Grain,
    path: str,
    numeric_max: bool = False,
) -> Base:
    """Aggregates the raw log once and keeps the result as a table at ``path``.

    ``path`` is in the folder all executors share. The rollups read the table,
    so a lost executor costs them no second pass over the log, and each reads
    only its own kind of record and its own columns. The log is read in small
    splits: a task sorts all records of its split, which fit in memory then.
    """
    aggregated = aggregate_records(normalize_bid_log(raw), grain, numeric_max)
    with small_splits(spark):
        aggregated.write.partitionBy("is_bid").parquet(path)
    names = [f for f in aggregated.schema.fields if f.name != "is_bid"]
    schema = T.StructType([*names, T.StructField("is_bid", T.BooleanType())])
    return split_records(spark.read.schema(schema).parquet(path), grain)
