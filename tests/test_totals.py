"""Totals over several levels, the greatest with ties, distinct auctions."""

import random
from collections import Counter

import pytest
from helpers import log_of, row
from pyspark.sql import functions as F

from bidweave.fixtures.queries import bid_source
from bidweave.operators.distinct import ERROR, estimated, exact_distinct, merged, sketches
from bidweave.operators.totals import top_with_ties, totals_by_level
from bidweave.plans.base import stage_base


def log(spark):
    return log_of(
        spark,
        row("2024-01-01 05:10:00", advertiser_id=1, campaign_group_id=10, campaign_id=100),
        row("2024-01-01 05:10:00", advertiser_id=1, campaign_group_id=10, campaign_id=101, threshold_failure_reasons="x"),
        row("2024-01-01 05:20:00", advertiser_id=1, campaign_group_id=None, campaign_id=100, auction_id=None),
        row("2024-01-01 05:20:00", advertiser_id=None, campaign_group_id=10, campaign_id=None, flight_id=None),
        row("2024-01-01 06:20:00", advertiser_id=2, campaign_group_id=20, campaign_id=200, has_price=None),
    )


@pytest.mark.parametrize("grain", ["hour", "minute"])
def test_levels_add_up_and_missing_ids_are_no_totals(spark, tmp_path, grain):
    raw = log(spark)
    base = stage_base(spark, raw, "minute", str(tmp_path / "base"))
    found = totals_by_level(base.bids, grain)
    rows = [r.asDict() for r in found.collect()]
    direct = totals_by_level(bid_source(raw, []), grain)
    assert sorted(map(str, found.collect())) == sorted(map(str, direct.collect()))
    time = ["dt", "hh"] + ["min"] * (grain == "minute")
    ids = ["advertiser_id", "campaign_group_id", "campaign_id"]
    for level in (0, 1, 2):
        sums = Counter()
        for r in rows:
            if r["level"] == level + 1:
                sums[tuple(r[k] for k in [*time, *ids[:level]])] += r["total_bid_requests"]
        own = {tuple(r[k] for k in [*time, *ids[:level]]): r["total_bid_requests"] for r in rows if r["level"] == level}
        assert own == sums
    hour5 = [r for r in rows if r["hh"] == 5 and grain == "hour"]
    assert grain == "minute" or sorted(r["level"] for r in hour5) == [0, 1, 1, 2, 2, 2, 3, 3, 3, 3]


def test_levels_scan_the_base_once(spark, tmp_path):
    base = stage_base(spark, log(spark), "minute", str(tmp_path / "base"))
    plan = totals_by_level(base.bids, "hour")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


@pytest.mark.parametrize("k, salts", [(1, 3), (3, 1), (3, 8), (100, 4)])
def test_top_keeps_all_ties(spark, k, salts):
    rng = random.Random(k)
    rows = [(rng.choice(["x", "x", "y", None]), rng.choice([0, 1, 1, 2, 5, 9, 9, None]), i % 50) for i in range(400)]
    rows += [("lone", 1, 1), ("tied", 4, 1), ("tied", 4, 1), ("none", None, 1)]
    frame = spark.createDataFrame(rows, "g string, v int, n int").repartition(4)
    got = Counter(tuple(r) for r in top_with_ties(frame, ["g"], "v", k, salts).collect())
    want = Counter()
    for g, v, n in rows:
        if v is not None:
            rank = 1 + sum(1 for h, w, _ in rows if h == g and w is not None and w > v)
            if rank <= k:
                want[g, v, n, rank] += 1
    assert got == want


def test_top_orders_no_group_as_a_whole(spark):
    frame = spark.range(200_000).selectExpr("'hot' AS g", "id % 3 AS v", "id")
    found = top_with_ties(frame, ["g"], "v", 2)
    assert found.count() == 66_666
    plan = found._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("__salt" in line and "Partial" in line for line in limits)


def test_top_of_nothing(spark):
    frame = spark.createDataFrame([], "g string, v int")
    assert top_with_ties(frame, ["g"], "v", 3).count() == 0


def test_sketches_merge_without_log_rows_and_keep_their_error(spark, tmp_path):
    raw = spark.range(300_000).selectExpr(
        "id % 60 AS minute", "id % 2 AS hour", "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 90000 AS STRING) END AS auction_id"
    )
    sketches(raw, ["hour", "minute"]).write.parquet(str(tmp_path / "s"))
    base = spark.read.parquet(str(tmp_path / "s"))
    whole = estimated(merged(merged(base, ["hour"]).withColumn("day", F.lit(1)), ["day"])).first().auctions
    exact = exact_distinct(raw, []).first().auctions
    assert exact == 90_000 and abs(whole - exact) <= ERROR * exact
    for r in estimated(merged(base, ["hour"])).collect():
        n = exact_distinct(raw.where(F.col("hour") == r.hour), []).first().auctions
        assert abs(r.auctions - n) <= ERROR * n
    # Merging in another order gives the same.
    assert estimated(merged(base.withColumn("day", F.lit(1)), ["day"])).first().auctions == whole


def test_sketches_of_no_auctions(spark):
    raw = spark.createDataFrame([(1, None), (2, "a"), (2, "a"), (3, None)], "k int, auction_id string")
    got = {r.k: r.auctions for r in estimated(sketches(raw, ["k"])).collect()}
    assert got == {1: 0, 2: 1, 3: 0} == {r.k: r.auctions for r in exact_distinct(raw, ["k"]).collect()}
    assert estimated(merged(sketches(raw, ["k"]).withColumn("all", F.lit(1)), ["all"])).first().auctions == 1
    assert estimated(sketches(raw.limit(0), ["k"])).count() == 0
