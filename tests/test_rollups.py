from decimal import Decimal

import pytest
from helpers import dicts, log_of, row
from pyspark.sql import functions as F

from bidweave.fixtures import queries as Q
from bidweave.fixtures.log import lineitem_log
from bidweave.operators import rollups as R
from bidweave.operators.normalize import normalize_bid_log, publish
from bidweave.operators.reports import (
    campaign_group_report,
    campaign_report,
    groups_with_null_key,
)
from bidweave.plans.base import aggregate_records, split_records, stage_base
from bidweave.plans.jobs import rollup_datasets
from bidweave.session import new_shared_path


def bids(spark, *rows):
    return R.bid_rows(normalize_bid_log(log_of(spark, *rows)))


def terms(spark, *rows):
    return R.term_rows(R.flatten_terms(normalize_bid_log(log_of(spark, *rows))))


def test_volumes_skip_null_auctions_and_unknown_prices(spark):
    rows = bids(
        spark,
        row(auction_id=None),
        row(has_price="false", price=None),
        row(has_price=None, price=None),
        row(has_price="abc", price=None),
    )
    found = dicts(R.campaign_group_rollup(rows, "hour"))[0]
    assert found["total_bid_requests"] == 3
    assert (found["total_bids"], found["total_204_bids"]) == (1, 1)
    assert found["bid_price_per_hour"] == Decimal("1.5000")


def test_group_without_prices_has_null_sum_and_zero_counts(spark):
    rows = bids(spark, row(has_price=None, price=None))
    found = dicts(R.campaign_rollup(rows, "minute"))[0]
    assert found["bid_price_per_min"] is None
    assert (found["total_bids"], found["total_204_bids"]) == (0, 0)
    assert found["min"] == 10


def test_maxima_compare_text_unless_numeric(spark):
    rows = bids(
        spark,
        row(payload={"daily_campaign_spend": "9"}),
        row(payload={"daily_campaign_spend": "10"}),
        row(payload={"daily_campaign_spend": "n/a"}),
    )
    as_text = dicts(R.campaign_rollup(rows, "hour"))[0]
    as_number = dicts(R.campaign_rollup(rows, "hour", numeric_max=True))[0]
    assert as_text["max_daily_campaign_spend"] == "n/a"
    assert as_number["max_daily_campaign_spend"] == "10"


@pytest.mark.parametrize(
    "spends, expected",
    [
        (["9", "10"], "9.00"),
        (["1.005"], "1.01"),
        (["-1.005"], "-1.01"),
        (["123456789012.345"], None),
        (["oops", "5"], None),
    ],
)
def test_term_spend_is_cast_after_the_text_maximum(spark, spends, expected):
    rows = terms(spark, row(payload={"terms": [{"id": "1", "spend": s} for s in spends]}))
    found = dicts(R.term_rollup(rows, "hour"))
    assert [f["max_term_spend"] for f in found] == [expected and Decimal(expected)]


def test_term_flags(spark):
    flags = ["true", "false", "maybe", None]
    rows = terms(
        spark,
        row(payload={"terms": [{"id": "1", "spend_capped": f, "rate_limited": f} for f in flags]}),
    )
    found = dicts(R.term_rollup(rows, "hour"))[0]
    assert (found["total_spend_capped"], found["total_rate_limited"]) == (1, 1)
    assert found["total_bid_requests"] == 4


def group_report(spark, *rows, **options):
    base = bids(spark, *rows)
    return campaign_group_report(
        R.campaign_group_rollup(base, "hour"),
        R.campaign_group_failure_reasons(base, "hour"),
        groups_with_null_key(base, "hour"),
        "hour",
        **options,
    )


def test_report_repeats_a_rollup_row_per_reason(spark):
    found = dicts(group_report(spark, row(), row(threshold_failure_reasons="budget")))
    assert sorted(f["cg_threshold_failure_reasons"] for f in found) == ["budget", "floor"]
    assert [f["total_bid_requests"] for f in found] == [2, 2]
    assert [f["fail_count_cg_id"] for f in found] == [1, 1]


def test_null_flight_leaves_two_half_empty_rows(spark):
    found = dicts(group_report(spark, row(flight_id=None)))
    assert len(found) == 2
    halves = sorted(found, key=lambda f: f["total_bid_requests"] is None)
    assert halves[0]["fail_count_cg_id"] is None and halves[0]["cgid_mod"] == 5
    assert halves[1]["fail_count_cg_id"] == 1 and halves[1]["cgid_mod"] is None
    assert halves[1]["campaign_group_id"] == 105


def test_lone_rows_keep_their_own_advertiser(spark):
    found = dicts(
        group_report(
            spark,
            row(flight_id=None, advertiser_id=1),
            row(flight_id=None, advertiser_id=None),
            row(flight_id=None, campaign_group_id=None),
            row(at=None),
        )
    )
    rollups = [f for f in found if f["total_bid_requests"] is not None]
    assert len(rollups) == 4 and all(f["fail_count_cg_id"] is None for f in rollups)
    assert all(f["total_bid_requests"] == 1 for f in rollups)
    halves = [f for f in found if f["total_bid_requests"] is None]
    assert sorted(f["fail_count_cg_id"] for f in halves) == [1, 1, 2]
    assert all(f["advertiser_id"] is None for f in halves)


def test_null_safe_report_matches_null_keys(spark):
    found = dicts(group_report(spark, row(flight_id=None), row(), null_safe=True))
    assert len(found) == 2
    assert all(f["fail_count_cg_id"] == 1 and f["total_bid_requests"] == 1 for f in found)


def test_group_report_equals_a_full_outer_join(spark):
    log = lineitem_log(spark, "/root/testdata/sf0.001")
    log = log.withColumn(
        "campaign_group_id", F.expr("CASE WHEN epoch % 7000 <> 0 THEN campaign_group_id END")
    )
    base = R.bid_rows(normalize_bid_log(log))
    rollup = R.campaign_group_rollup(base, "minute")
    reasons = R.campaign_group_failure_reasons(base, "minute")
    keys = ["dt", "hh", "min", "campaign_group_id", "flight_id"]
    outer = rollup.join(reasons, keys, "outer")
    lone = groups_with_null_key(base, "minute")
    report = campaign_group_report(rollup, reasons, lone, "minute").select(*outer.columns)
    assert report.count() == outer.count() > 0
    assert report.exceptAll(outer).isEmpty() and outer.exceptAll(report).isEmpty()


def test_reason_counts_span_advertisers_and_flights(spark):
    rows = bids(spark, row(advertiser_id=1, flight_id=1), row(advertiser_id=2, flight_id=2))
    report = campaign_report(
        R.campaign_rollup(rows, "hour"), R.campaign_failure_reasons(rows, "hour"), "hour"
    )
    assert [f["fail_count_campaign_id"] for f in dicts(report)] == [2, 2]


def test_campaign_report_drops_null_keys(spark):
    rows = bids(spark, row(campaign_id=None), row(campaign_group_id=None), row())
    report = campaign_report(
        R.campaign_rollup(rows, "hour"), R.campaign_failure_reasons(rows, "hour"), "hour"
    )
    assert [f["campaign_id"] for f in dicts(report)] == [1050]


OUTPUT_COLUMNS = {
    "campaign_group_log_agg_min": """dt hh min campaign_group_id flight_id advertiser_id cgid_mod
        total_bid_requests total_bids total_204_bids bid_price_per_min
        max_flight_campaign_group_spend max_flight_campaign_group_spend_cap
        max_flight_campaign_impression max_flight_campaign_impression_cap
        max_flight_campaign_group_impression max_flight_campaign_group_impression_cap
        max_daily_campaign_group_spend max_daily_campaign_group_spend_cap
        max_daily_campaign_group_impression max_daily_campaign_group_impression_cap
        cg_threshold_failure_reasons fail_count_cg_id""",
    "campaign_log_agg_min": """dt hh min campaign_group_id campaign_id advertiser_id flight_id
        cgid_mod total_bid_requests total_bids total_204_bids bid_price_per_min
        max_flight_campaign_spend max_flight_campaign_spend_cap
        max_daily_campaign_spend max_daily_campaign_spend_cap
        max_flight_campaign_impression max_flight_campaign_impression_cap
        max_daily_campaign_impression max_daily_campaign_impression_cap
        campaign_threshold_failure_reasons fail_count_campaign_id""",
    "terms_log_agg_min": """dt hh min cgid_mod advertiser_id flight_id campaign_group_id
        campaign_id eligible_term_id picked_term_id term_id total_bid_requests total_bids
        total_204_bids total_spend_capped total_rate_limited max_term_spend max_term_spend_cap
        throttling_percentage bid_volume_percentage""",
}


def test_dataset_columns_and_types(spark):
    log = normalize_bid_log(log_of(spark, row()))
    for grain, change in (("minute", lambda n: n), ("hour", hour_name)):
        base = split_records(aggregate_records(log, grain), grain)
        frames = rollup_datasets(base, grain)
        for name, columns in OUTPUT_COLUMNS.items():
            wanted = [c for c in map(change, columns.split()) if c]
            assert frames[change(name)].columns == wanted
    group = publish(frames["campaign_group_log_agg_hr"])
    types = dict(group.dtypes)
    assert types["dt"] == "string" and types["hh"] == "int" and types["cgid_mod"] == "bigint"
    assert types["bid_price_per_hour"] == "decimal(22,4)"
    assert types["total_bids"] == "bigint" and types["fail_count_cg_id"] == "bigint"
    assert dict(frames["terms_log_agg_hr"].dtypes)["max_term_spend"] == "decimal(10,2)"


def hour_name(name):
    names = {"min": None, "bid_price_per_min": "bid_price_per_hour"}
    return names[name] if name in names else name.replace("_agg_min", "_agg_hr")


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("numeric_max", [False, True])
def test_base_gives_the_same_rollups_as_the_log(spark, numeric_max):
    log = lineitem_log(spark, "/root/testdata/sf0.001")
    base = stage_base(spark, log, "minute", new_shared_path(spark, "base"), numeric_max)
    rows = R.bid_rows(normalize_bid_log(log))
    flat = R.term_rows(R.flatten_terms(normalize_bid_log(log)))
    for grain in ("hour", "minute"):
        for rollup, of_log, of_base in (
            (R.campaign_group_rollup, rows, base.bids),
            (R.campaign_rollup, rows, base.bids),
            (R.term_rollup, flat, base.terms),
        ):
            direct = rollup(of_log, grain, numeric_max)
            derived = rollup(of_base, grain, numeric_max)
            assert direct.dtypes == derived.dtypes
            assert same(direct, derived)
        for reasons in (R.campaign_group_failure_reasons, R.campaign_failure_reasons):
            assert same(reasons(rows, grain), reasons(base.bids, grain))


def test_null_terms_count_as_terms(spark):
    log = normalize_bid_log(log_of(spark, row(payload='{"terms": [null, {"id": "1"}]}')))
    base = split_records(aggregate_records(log, "hour"), "hour")
    direct = R.term_rollup(R.term_rows(R.flatten_terms(log)), "hour")
    assert direct.count() == 2
    assert same(direct, R.term_rollup(base.terms, "hour"))
    assert base.bids.count() == 1


def test_invariants(spark):
    log = lineitem_log(spark, "/root/testdata/sf0.001")
    rows = R.bid_rows(normalize_bid_log(log))

    def total(df, column):
        return df.agg(F.sum(column)).first()[0]

    hour, minute = (R.campaign_group_rollup(rows, g) for g in ("hour", "minute"))
    for column in R.VOLUMES:
        assert total(hour, column) == total(minute, column)
    priced = log.where("has_price IS NOT NULL").count()
    assert total(hour, "total_bids") + total(hour, "total_204_bids") == priced
    requests = total(hour, "total_bid_requests")
    assert total(R.campaign_group_failure_reasons(rows, "hour"), "fail_count_cg_id") == requests
    assert total(R.campaign_failure_reasons(rows, "hour"), "fail_count_campaign_id") == requests
    assert total(hour, "bid_price_per_hour") == total(minute, "bid_price_per_min")


def test_validated_row_counts(spark):
    """Row counts stated for the log derived from ``events`` at sf0.01."""
    counts = {
        "campaign_group_rollup": (3621, 9786),
        "campaign_rollup": (6561, 9937),
        "campaign_group_failure_reasons": (7035, 9933),
        "campaign_failure_reasons": (8535, 9968),
        "campaign_group_report": (7896, 10843),
        "campaign_report": (9783, 10004),
        "term_rollup": (9171, 9230),
    }
    found = Q.build()
    for name, expected in counts.items():
        got = tuple(
            found[f"{name}_{g}"](spark, "/root/testdata/sf0.01").count() for g in ("hour", "minute")
        )
        assert got == expected, name
