"""As-of joins, running and trailing totals, sessions: against plain loops, ties and hot keys included."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bidweave.operators.slices import as_of_join, gap_sessions, running_total, slice_width, trailing_total

SCHEMA = "k string, g int, t bigint, v bigint, n int"


def rows_of(seed, n, span):
    """One key holds a third of the rows; some keys, times and values are NULL; times tie."""
    rng = random.Random(seed)
    found = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        time = None if rng.random() < 0.05 else rng.randrange(-span, span)
        found.append((key, rng.choice([1, 1, None]), time, rng.choice([None, 0, 1, 5, -2]), i))
    return found


WIDTHS = [7, 100, 10**9, None]


@pytest.mark.parametrize("width", WIDTHS)
def test_as_of_join(spark, width):
    left, right = rows_of(1, 400, 300), rows_of(2, 150, 300)
    a = spark.createDataFrame(left + left[:5], SCHEMA).repartition(5)
    b = spark.createDataFrame(right, SCHEMA).selectExpr("k", "g", "t", "v AS state", "n AS source")
    found = as_of_join(a, b, ["k", "g"], "t", ["state", "source"], width).collect()
    states = defaultdict(dict)
    for k, g, t, v, n in right:
        if None not in (k, g, t):
            key = (v is not None, v or 0, n)
            states[k, g][t] = max(states[k, g].get(t, key), key)
    want = []
    for row in left + left[:5]:
        k, g, t = row[:3]
        before = [s for s in states.get((k, g), ()) if t is not None and s <= t]
        last = states[k, g][max(before)] if before else None
        want.append((*row, None, None) if last is None else (*row, last[1] if last[0] else None, last[2]))
    assert Counter(map(tuple, found)) == Counter(want)
    assert sum(w[-1] is not None for w in want) > 100


def test_as_of_join_with_no_rows_on_a_side(spark):
    a = spark.createDataFrame(rows_of(1, 20, 50), SCHEMA)
    b = a.selectExpr("k", "g", "t", "v AS state")
    assert as_of_join(a.limit(0), b, ["k"], "t", ["state"]).count() == 0
    found = as_of_join(a, b.limit(0), ["k"], "t", ["state"])
    assert found.count() == 20 and found.where("state IS NOT NULL").count() == 0


@pytest.mark.parametrize("width", WIDTHS)
def test_running_and_trailing_totals(spark, width):
    rows = rows_of(3, 300, 200)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    frame = running_total(frame, ["k"], "t", "v", "total", width)
    found = trailing_total(frame, ["k"], "t", "v", "recent", 30, width).collect()
    assert len(found) == len(rows)
    for r in found:
        past = [v for k, _, t, v, _ in rows if k == r.k and None not in (t, r.t) and t <= r.t]
        values = [v for v in past if v is not None]
        assert r.total == (sum(values) if values and r.t is not None else None)
        if r.t is not None and r.k is not None:
            recent = [v or 0 for k, _, t, v, _ in rows if k == r.k and t is not None and r.t - 30 <= t <= r.t]
            assert r.recent == sum(recent)


@pytest.mark.parametrize("width", WIDTHS)
def test_gap_sessions(spark, width):
    rows = rows_of(4, 250, 2000)
    measures = [F.count("*").alias("rows"), F.sum("v").alias("v")]
    found = gap_sessions(spark.createDataFrame(rows, SCHEMA).repartition(4), ["k", "g"], "t", 60, measures, width)
    got = {(r.k, r.g, r.session): (r.started, r.ended, r.idle_before, r.rows, r.v) for r in found.collect()}
    want, by_key = {}, defaultdict(list)
    for k, g, t, v, _ in rows:
        if t is not None:
            by_key[k, g].append((t, v))
    for key, points in by_key.items():
        points.sort(key=lambda p: p[0])
        session, start, last, part = 0, None, None, []
        for t, v in [*points, (None, None)]:
            if t is None or last is None or t - last > 60:
                if part:
                    values = [x for _, x in part if x is not None]
                    total = sum(values) if values else None
                    want[(*key, session)] = (part[0][0], last, start, len(part), total)
                session, start, part = session + 1, None if last is None or t is None else t - last, []
            part.append((t, v))
            last = t
    assert got == want and len(got) > 20


def test_slices_bound_what_a_hot_key_puts_into_a_task(spark):
    hot = spark.range(120_000).select(
        F.lit("hot").alias("k"), (F.col("id") * 30).alias("t"), F.lit(1).cast("bigint").alias("v")
    )
    width = slice_width(hot, ["k"], "t", 10_000)
    assert hot.groupBy(F.floor(F.col("t") / width)).count().agg(F.max("count")).first()[0] <= 10_000
    found = running_total(hot, ["k"], "t", "v", "total", width)
    assert found.where("total <> t / 30 + 1").isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # By key alone only the table of slices is ordered.
    assert sum("__slice" not in w.split("], [")[1] for w in windows) <= 1
