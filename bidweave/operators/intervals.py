"""Joins of points in time with intervals, by bins of fitting width.

Intervals are sorted into levels by their length. The bins of a level are about
as wide as its intervals, so each interval lies in a few bins of its own level
and each point in one bin of every level. Bins are joined by hash, and the
interval's bounds are checked exactly afterwards.

Totals over the points of each interval need no pairs: points are summed up in
cells whose widths double from level to level, an interval is made of at most
two cells of each level, and only its ends are joined with points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.session import staged

#: Each level's bins are this many times as wide as those of the level below.
FACTOR = 8
LEVEL, BIN = "__level", "__bin"
#: Times of the busiest hour that a narrowest cell should hold.
CELL_TIMES = 8
HOUR = 3_600_000
#: A measure's aggregate over points, and the one that merges two of its results.
Measure = tuple[Column, Callable[[str], Column]]


def base_width(intervals: DataFrame, start: str, end: str) -> int:
    """Width of the narrowest bins: a low quantile of the intervals' lengths."""
    lengths = intervals.select((F.col(end) - F.col(start) + 1).cast("double").alias("n")).where("n > 0")
    found = lengths.approxQuantile("n", [0.1], 0.02)
    return max(1, int(found[0])) if found else 1


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    time: str,
    start: str,
    end: str,
    keys: list[str] | None = None,
    width: int | None = None,
) -> DataFrame:
    """Pairs of rows with ``start <= time <= end`` and equal ``keys``, all columns of both.

    A NULL ``start`` or ``end`` leaves the interval open on that side. Points
    without a time, rows with a NULL key and intervals that end before they
    start match nothing. ``keys`` appear once; other names must not clash.
    ``width`` of the narrowest bins comes from the data by default.
    """
    keys = keys or []
    timed = points.where(F.col(time).isNotNull())
    bounds = timed.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    low, high = (bounds.low, bounds.high) if bounds.low is not None else (0, 0)
    # Open ends reach as far as the points do; the exact check needs no more.
    closed = intervals.withColumns(
        {
            "__start": F.greatest(F.coalesce(F.col(start), F.lit(low)), F.lit(low)),
            "__end": F.least(F.coalesce(F.col(end), F.lit(high)), F.lit(high)),
        }
    ).where(F.col("__start") <= F.col("__end"))
    narrow = width or base_width(closed, "__start", "__end")
    top, levels = narrow, 1
    while top <= high - low:
        top, levels = top * FACTOR, levels + 1
    widths = [narrow * FACTOR**n for n in range(levels)]
    length = F.col("__end") - F.col("__start") + 1
    level = F.lit(levels - 1)
    for n in reversed(range(levels - 1)):
        level = F.when(length <= widths[n], F.lit(n)).otherwise(level)
    span = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in widths]), F.col(LEVEL) + 1)
    place = lambda c: F.floor((F.col(c) - low) / span).cast("bigint")
    binned = closed.withColumn(LEVEL, level).withColumn(BIN, F.explode(F.sequence(place("__start"), place("__end"))))
    # Points need a place on the levels that have intervals: a handful.
    used = sorted(r[0] for r in binned.select(LEVEL).distinct().collect())
    if not used:
        used = [0]
    spots = F.array(
        *[
            F.struct(F.lit(n).alias(LEVEL), F.floor((F.col(time) - low) / widths[n]).cast("bigint").alias(BIN))
            for n in used
        ]
    )
    placed = timed.select("*", F.inline(spots))
    found = placed.join(binned, [*keys, LEVEL, BIN])
    exact = (F.col(time) >= F.col("__start")) & (F.col(time) <= F.col("__end"))
    return found.where(exact).drop(LEVEL, BIN, "__start", "__end")


def cell_width(points: DataFrame, time: str, keys: list[str]) -> int:
    """Width of the narrowest cells, from the busiest hour of any key."""
    hours = points.groupBy(*keys, F.expr(f"{time} div {HOUR}").alias("h")).count()
    busiest = hours.agg(F.max("count")).first()[0]
    return max(1, HOUR * CELL_TIMES // busiest) if busiest else HOUR


def _cells_between(first: Column, behind: Column, levels: int) -> Column:
    """The fewest cells (level, bin) that make up the bins from ``first`` to before ``behind``."""
    found = []
    for n in range(levels):
        left, right = F.shiftright(first + F.lit(2**n - 1), n), F.shiftright(behind, n)
        for odd, place in ((left, left), (right, right - 1)):
            cell = F.struct(F.lit(n).alias(LEVEL), place.alias(BIN))
            found.append(F.when((left < right) & (odd % 2 != 0), cell))
    return F.array_compact(F.array(*found))


def range_totals(
    points: DataFrame,
    intervals: DataFrame,
    time: str,
    start: str,
    end: str,
    keys: list[str],
    by: list[str],
    measures: dict[str, Measure],
    width: int | None = None,
) -> DataFrame:
    """(columns of ``intervals``, ``by``, measures) over the points that ``range_join`` pairs with them.

    The same as grouping the pairs by all columns of the interval and by the
    points' ``by``, yet an interval costs some rows for each group and level
    instead of one for each of its points. ``width`` of the narrowest cells
    comes from the data by default.
    """
    timed = points.where(F.col(time).isNotNull())
    merge = lambda rows, cols: rows.groupBy(*cols).agg(
        *[again(n).cast(kinds[n]).alias(n) for n, (_, again) in measures.items()]
    )
    # All points of one time count together, and are read once.
    found = timed.groupBy(*keys, *by, time).agg(*[first.alias(n) for n, (first, _) in measures.items()])
    kinds = {n: found.schema[n].dataType for n in measures}
    summed = staged(found, "range-points")
    bounds = summed.agg(F.min(time).alias("low"), F.max(time).alias("high")).first()
    low, high = (bounds.low, bounds.high) if bounds.low is not None else (0, 0)
    width = width or cell_width(summed, time, keys)
    levels = max(1, ((high - low) // width + 1).bit_length())
    place = lambda c: F.floor((c - low) / F.lit(width)).cast("bigint")
    cells = merge(summed.withColumn(BIN, place(F.col(time))), [*keys, *by, BIN])
    levelled = F.array(*[F.struct(F.lit(n).alias(LEVEL), F.shiftright(BIN, n).alias(BIN)) for n in range(levels)])
    cells = merge(cells.select(*keys, *by, *measures, F.inline(levelled)), [*keys, *by, LEVEL, BIN])
    closed = intervals.withColumns(
        {
            "__from": F.greatest(F.coalesce(F.col(start), F.lit(low)), F.lit(low)),
            "__to": F.least(F.coalesce(F.col(end), F.lit(high)), F.lit(high)),
        }
    ).where(F.col("__from") <= F.col("__to"))
    first, last = place(F.col("__from")), place(F.col("__to"))
    whole = closed.select(*intervals.columns, F.inline(_cells_between(first + 1, last, levels)))
    inner = whole.join(cells, [*keys, LEVEL, BIN]).drop(LEVEL, BIN)
    piece = lambda a, b: F.struct(a.alias("__from"), b.alias("__to"))
    ends = F.when(first == last, F.array(piece(F.col("__from"), F.col("__to")))).otherwise(
        F.array(
            piece(F.col("__from"), F.lit(low) + (first + 1) * width - 1),
            piece(F.lit(low) + last * width, F.col("__to")),
        )
    )
    edges = closed.select(*intervals.columns, F.inline(ends))
    outer = range_join(summed, edges, time, "__from", "__to", keys, width).drop("__from", "__to", time)
    return merge(inner.unionByName(outer), [*intervals.columns, *by])
