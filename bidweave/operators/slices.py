"""Ordered computations over time in two levels, so that one busy key is not one task.

A key's rows are cut into slices of time. What a row needs from its own slice
is a window over key and slice; what it needs from earlier slices is carried
over from a table with one row for each key and slice. Only that table is
ordered by key alone.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidweave.session import staged

SLICE = "__slice"
#: Rows of the busiest key that a slice should hold.
SLICE_ROWS = 200_000
#: Width of a slice of a table without rows, and the least width.
LEAST_WIDTH = 1_000
HOUR = 3_600_000


def slice_width(rows: DataFrame, keys: list[str], time: str, slice_rows: int = SLICE_ROWS) -> int:
    """Width of slices in the unit of ``time``, from the busiest hour of any key."""
    hours = rows.where(F.col(time).isNotNull()).groupBy(*keys, F.expr(f"{time} div {HOUR}").alias("h")).count()
    busiest = hours.agg(F.max("count")).first()[0]
    if not busiest:
        return HOUR
    return max(LEAST_WIDTH, HOUR // -(-busiest // slice_rows))


def sliced(rows: DataFrame, time: str, width: int) -> DataFrame:
    """Rows with the slice of their time."""
    return rows.withColumn(SLICE, F.floor(F.col(time) / F.lit(width)).cast("bigint"))


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(and_, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])


def with_carry(rows: DataFrame, carried: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Rows with the columns ``names`` of their key's and slice's row in ``carried``.

    Both are partitioned by key and slice, as the windows before and after are,
    so the rows are shuffled once for all of them.
    """
    a, b = rows.alias("a"), carried.select(*keys, SLICE, *names).alias("b")
    return a.join(b, _same("a", "b", [*keys, SLICE]), "left").select("a.*", *[f"b.{n}" for n in names])


def as_of_join(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, columns: list[str], width: int | None = None
) -> DataFrame:
    """``left`` with the ``columns`` of the last row of ``right`` at or before its ``time``.

    ``right`` is the state of each key from a time on; of rows with one key and
    time the greatest ``columns`` count. Rows of ``left`` without an earlier
    state, without a key or time, have NULLs. Rows that repeat all stay. Names
    in ``columns`` must not be in ``left``.

    The tables are stacked and cut into slices of ``width`` (by default from
    the data); each slice hands its last state on to those after it.
    """
    width = width or slice_width(left.select(*keys, time).unionAll(right.select(*keys, time)), keys, time)
    whole = reduce(and_, [F.col(c).isNotNull() for c in [*keys, time]])
    states = right.where(whole).groupBy(*keys, time).agg(F.max(F.struct(*columns)).alias("__state"))
    bids = left.where(whole).withColumn("__row", F.struct(*[F.col(c) for c in left.columns]))
    both = sliced(
        bids.select(*keys, time, "__row").unionByName(states, allowMissingColumns=True), time, width
    )
    # A state counts for rows of its own time: the range frame takes all rows of one time together.
    inside = Window.partitionBy(*keys, SLICE).orderBy(time).rangeBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__own", F.last("__state", ignorenulls=True).over(inside))
    last = states.transform(lambda s: sliced(s, time, width)).groupBy(*keys, SLICE).agg(
        F.max_by("__state", time).alias("__last")
    )
    # Slices of left rows without a state of their own need one, too.
    slices = sliced(bids.select(*keys, time), time, width).select(*keys, SLICE).distinct()
    order = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last.unionByName(slices, allowMissingColumns=True)
        .groupBy(*keys, SLICE)
        .agg(F.first("__last", ignorenulls=True).alias("__last"))
        .withColumn("__carry", F.last("__last", ignorenulls=True).over(order))
    )
    found = with_carry(seen.where(F.col("__row").isNotNull()), carried, keys, ["__carry"])
    state = F.coalesce("__own", "__carry")
    joined = found.select("__row.*", *[state[c].alias(c) for c in columns])
    lost = left.where(F.coalesce(~whole, F.lit(True)))
    return joined.unionByName(lost, allowMissingColumns=True)


def running_total(
    rows: DataFrame, keys: list[str], time: str, value: str, name: str, width: int | None = None
) -> DataFrame:
    """Rows with the sum of ``value`` over all rows of their key up to and at their time.

    NULL values add nothing; without any value so far the sum is NULL. Rows
    without a time have NULL. NULL keys are a key.
    """
    width = width or slice_width(rows, keys, time)
    timed = sliced(rows.where(F.col(time).isNotNull()), time, width)
    inside = Window.partitionBy(*keys, SLICE).orderBy(time).rangeBetween(Window.unboundedPreceding, 0)
    kind = rows.schema[value].dataType
    own = timed.withColumn("__own", F.sum(value).over(inside))
    total = own.schema["__own"].dataType
    order = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = timed.groupBy(*keys, SLICE).agg(F.sum(F.col(value).cast(kind)).alias("__sum")).withColumn(
        "__carry", F.sum("__sum").over(order).cast(total)
    )
    found = with_carry(own, carried, keys, ["__carry"])
    both = F.coalesce(F.col("__own") + F.col("__carry"), F.col("__own"), F.col("__carry")).cast(total)
    done = found.withColumn(name, both).select(*rows.columns, name)
    return done.unionByName(rows.where(F.col(time).isNull()), allowMissingColumns=True)


def trailing_total(
    rows: DataFrame, keys: list[str], time: str, value: str, name: str, span: int, width: int | None = None
) -> DataFrame:
    """Rows with the sum of ``value`` over their key's rows within ``span`` before and at their time.

    It is the running total less the one of the time just before the span, an
    as-of join of the running totals with themselves; no frame is scanned.
    NULL values count as nothing, rows without a key or time have NULL.
    """
    width = width or slice_width(rows, keys, time)
    filled = rows.withColumn("__value", F.coalesce(F.col(value), F.lit(0).cast(rows.schema[value].dataType)))
    # Read several times below.
    totals = staged(running_total(filled, keys, time, "__value", "__now", width), "totals")
    past = totals.groupBy(*keys, time).agg(F.first("__now").alias("__before"))
    # A total counts for rows of later times than the span's end.
    shifted = past.withColumn(time, F.col(time) + F.lit(span + 1))
    found = as_of_join(totals, shifted, keys, time, ["__before"], width)
    kind = totals.schema["__now"].dataType
    gone = F.coalesce(F.col("__before"), F.lit(0).cast(kind))
    return found.withColumn(name, (F.col("__now") - gone).cast(kind)).select(*rows.columns, name)


def gap_sessions(
    rows: DataFrame, keys: list[str], time: str, gap: int, measures: list[Column], width: int | None = None
) -> DataFrame:
    """(keys, session, started, ended, idle_before, measures) of each key's sessions.

    A session ends where the next row of the key is more than ``gap`` later;
    they are numbered from 1 by time, ``idle_before`` is the time since the one
    before. Rows without a time are left out. NULL keys are a key. ``measures``
    are aggregates.
    """
    width = width or slice_width(rows, keys, time)
    timed = sliced(rows.where(F.col(time).isNotNull()), time, width)
    inside = Window.partitionBy(*keys, SLICE).orderBy(time)
    order = Window.partitionBy(*keys).orderBy(SLICE)
    ends = timed.groupBy(*keys, SLICE).agg(F.max(time).alias("__last"))
    carried = ends.withColumn("__carry", F.lag("__last").over(order))
    linked = with_carry(timed.withColumn("__before", F.lag(time).over(inside)), carried, keys, ["__carry"])
    idle = F.col(time) - F.coalesce("__before", "__carry")
    # Of rows with one time only the first can start a session.
    marked = linked.withColumn("__idle", idle).withColumn(
        "__starts", F.when(F.col("__idle").isNull() | (F.col("__idle") > gap), 1).otherwise(0).cast("bigint")
    )
    numbered = running_total(marked.drop(SLICE, "__carry", "__before"), keys, time, "__starts", "session", width)
    return numbered.groupBy(*keys, "session").agg(
        F.min(time).alias("started"),
        F.max(time).alias("ended"),
        F.max(F.when(F.col("__starts") == 1, F.col("__idle"))).alias("idle_before"),
        *measures,
    )
