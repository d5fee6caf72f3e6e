"""Column expressions: time buckets, flags, counters and text maxima."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidweave.schema import BUCKETS


def event_time(epoch: Column) -> Column:
    """Milliseconds since 1970 as a timestamp."""
    return F.timestamp_millis(epoch)


def event_day(epoch: Column) -> Column:
    """Calendar day in the session time zone, as a DATE.

    Rollups group on the four-byte DATE and only the few result rows are
    turned into text, see ``day_text``.
    """
    return F.to_date(event_time(epoch))


def day_text(day: Column) -> Column:
    return day.cast("string")


def event_hour(epoch: Column) -> Column:
    return F.hour(event_time(epoch))


def event_minute(epoch: Column) -> Column:
    return F.minute(event_time(epoch))


def bucket_of(campaign_group_id: Column) -> Column:
    """Bucket of a campaign group; the sign follows the id."""
    return campaign_group_id % F.lit(BUCKETS).cast("bigint")


def flag(value: Column) -> Column:
    """Boolean reading of a text flag; NULL when it is not a boolean."""
    return value.try_cast("boolean")


def text_flag(value: Column) -> Column:
    """``flag`` of a text; one that is plainly no boolean costs no error that is raised and caught."""
    lower = F.lower(value)
    plain = F.when(value.rlike("^[!-~]*$"), F.lit(None).cast("boolean")).otherwise(flag(value))
    return F.when(lower.isin("true", "t", "yes", "y", "1"), True).when(
        lower.isin("false", "f", "no", "n", "0"), False
    ).otherwise(plain)


def max_text(value: Column, numeric: bool = False) -> Column:
    """Largest text of a group.

    Compared as text by default ("9" above "10"). With ``numeric`` the text of
    the largest number is returned; texts that are no number rank lowest.
    """
    if not numeric:
        return F.max(value)
    ranked = F.struct(value.try_cast("decimal(38,6)").alias("number"), value.alias("text"))
    return F.max(F.when(value.isNotNull(), ranked)).getField("text")
