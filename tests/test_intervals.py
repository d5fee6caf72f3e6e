"""Range joins against all pairs."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bidweave.operators.intervals import range_join, range_totals

POINTS = "p int, k string, t bigint"
INTERVALS = "i int, k string, s bigint, e bigint"


def tables(seed, low=-3000, high=3000):
    rng = random.Random(seed)
    at = lambda: rng.randrange(low, high)
    points = [(n, rng.choice(["a", "b", "b", None]), rng.choice([at(), at(), at(), None])) for n in range(250)]
    intervals = []
    for n in range(120):
        start = at()
        length = rng.choice([-5, 0, 1, 3, 20, 20, 20, 300, 5000])
        intervals.append(
            (n, rng.choice(["a", "b", None]), rng.choice([start] * 6 + [None]), rng.choice([start + length] * 6 + [None]))
        )
    return points, intervals


def pairs(points, intervals, keyed):
    return Counter(
        (p[0], i[0])
        for p in points
        for i in intervals
        if p[2] is not None and (i[2] is None or i[2] <= p[2]) and (i[3] is None or p[2] <= i[3])
        if not keyed or (p[1] is not None and p[1] == i[1])
    )


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("width", [None, 1, 50, 10**7])
def test_equals_all_pairs(spark, keyed, width):
    points, intervals = tables(1)
    a = spark.createDataFrame(points + points[:3], POINTS).repartition(4)
    b = spark.createDataFrame(intervals + intervals[:3], INTERVALS)
    if not keyed:
        b = b.withColumnRenamed("k", "other")
    found = range_join(a, b, "t", "s", "e", ["k"] if keyed else None, width)
    got = Counter((r.p, r.i) for r in found.select("p", "i").collect())
    assert got == pairs(points + points[:3], intervals + intervals[:3], keyed) and got
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_long_and_open_intervals(spark):
    points = spark.range(1000).selectExpr("CAST(id AS INT) AS p", "id * 10 AS t")
    intervals = spark.createDataFrame([(1, None, None), (2, 5, None), (3, None, 42), (4, 0, 10**12)], "i int, s bigint, e bigint")
    found = range_join(points, intervals, "t", "s", "e").groupBy("i").count().collect()
    assert {r.i: r["count"] for r in found} == {1: 1000, 2: 999, 3: 5, 4: 1000}


def test_empty_tables(spark):
    points, intervals = tables(2)
    a, b = spark.createDataFrame(points, POINTS), spark.createDataFrame(intervals, INTERVALS)
    for x, y in ((a.limit(0), b), (a, b.limit(0)), (a.withColumn("t", F.lit(None).cast("bigint")), b)):
        assert range_join(x, y, "t", "s", "e", ["k"]).count() == 0


def test_each_interval_has_few_bins(spark):
    lengths = [(n, 0, 10**n) for n in range(10)] * 20
    intervals = spark.createDataFrame(lengths, "i int, s bigint, e bigint")
    points = spark.createDataFrame([(1, 0), (2, 10**9)], "p int, t bigint")
    found = range_join(points, intervals, "t", "s", "e", width=10)
    assert found.count() == 20 * 10 + 20


def measures():
    return {"n": (F.count("*"), F.sum), "total": (F.sum("p"), F.sum), "last": (F.max("t"), F.max)}


@pytest.mark.parametrize("width", [None, 1, 7, 10**7])
def test_totals_equal_those_of_the_pairs(spark, width):
    points, intervals = tables(3)
    a = spark.createDataFrame(points + points[:3], POINTS).repartition(4).withColumn("g", F.when(F.col("p") % 5 > 0, F.col("p") % 5))
    b = spark.createDataFrame(intervals + intervals[:3], INTERVALS)
    pairs = range_join(a, b, "t", "s", "e", ["k"]).groupBy("i", "k", "s", "e", "g")
    wanted = pairs.agg(*[first.alias(n) for n, (first, _) in measures().items()])
    found = range_totals(a, b, "t", "s", "e", ["k"], ["g"], measures(), width)
    assert found.columns == wanted.columns and dict(found.dtypes) == dict(wanted.dtypes)
    assert Counter(found.collect()) == Counter(wanted.collect()) and wanted.count() > 100
    empty = range_totals(a.limit(0), b, "t", "s", "e", ["k"], ["g"], measures(), width)
    assert empty.count() == 0 == range_totals(a, b.limit(0), "t", "s", "e", ["k"], ["g"], measures(), width).count()


def test_totals_cost_no_row_for_each_pair(spark):
    points = spark.range(20_000).selectExpr("1 AS k", "id % 2 AS g", "CAST(id AS INT) AS p", "id * 3 AS t")
    intervals = spark.range(200).selectExpr("id AS i", "1 AS k", "id * 7 AS s", "60000 - id * 11 AS e")
    found = range_totals(points, intervals, "t", "s", "e", ["k"], ["g"], measures())
    assert found.agg(F.sum("n")).first()[0] > 3_000_000
    plan = found._jdf.queryExecution().executedPlan()
    nodes, made = [plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan], []
    assert "Join" in plan.toString()
    while nodes:
        node = nodes.pop()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if "Join" in node.nodeName():
            made.append(node.metrics().apply("numOutputRows").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert len(made) >= 2 and sum(made) < 100_000
