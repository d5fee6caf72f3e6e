from datetime import date, datetime, timedelta

import pytest
from helpers import dicts, log_of, row
from hypothesis import given
from hypothesis import strategies as st

from bidweave.fixtures.queries import write_log
from bidweave.sources.bid_log import missing_partitions, scan_bid_log
from bidweave.sources.windows import Window, parse_mods


def hours(window):
    return {d.isoformat(): h for d, h in window.hours_by_day().items()}


@pytest.mark.parametrize(
    "at, expected",
    [
        ("2024-01-02T12:00:00", {"2024-01-02": [6, 7, 8, 9, 10, 11]}),
        ("2024-01-02T12:41:07", {"2024-01-02": [6, 7, 8, 9, 10, 11]}),
        ("2024-01-02T00:00:00", {"2024-01-01": [18, 19, 20, 21, 22, 23]}),
        ("2024-01-02T03:00:00", {"2024-01-01": [21, 22, 23], "2024-01-02": [0, 1, 2]}),
        ("2024-01-02T06:00:00+00:00", {"2024-01-02": [0, 1, 2, 3, 4, 5]}),
    ],
)
def test_trailing_window(at, expected):
    assert hours(Window.trailing(at)) == expected
    assert hours(Window.trailing(datetime.fromisoformat(at))) == expected


@given(st.datetimes(datetime(2000, 1, 1), datetime(2100, 1, 1)), st.integers(1, 50))
def test_trailing_windows_hold_the_hours_before(at, length):
    window = Window.trailing(at, length)
    found = [
        datetime(d.year, d.month, d.day, h) for d, hs in window.hours_by_day().items() for h in hs
    ]
    full = at.replace(minute=0, second=0, microsecond=0)
    assert found == [full - timedelta(hours=n) for n in range(length, 0, -1)]
    assert window.end == full


def test_a_time_with_an_offset_is_converted_to_the_zone():
    at = "2024-11-03T06:30:00+00:00"
    assert Window.trailing(at, zone="America/New_York").end == datetime(2024, 11, 3, 1)
    assert Window.trailing(at, zone="UTC").end == datetime(2024, 11, 3, 6)
    assert Window.trailing("2024-11-03T06:30:00", zone="Asia/Tokyo").end == datetime(2024, 11, 3, 6)


def test_an_empty_bucket_list_is_an_error():
    with pytest.raises(ValueError, match="empty"):
        parse_mods([])


def test_day_window_and_default_day():
    assert hours(Window.day("2024-02-29")) == {"2024-02-29": list(range(24))}
    for missing in (None, "None", ""):
        assert hours(Window.day(missing, today=date(2024, 3, 1))) == hours(Window.day("2024-02-29"))
    assert Window.day().start.date() == date.today() - timedelta(days=1)


@pytest.mark.parametrize("hour", [5, "5", "05"])
def test_hour_window_ignores_padding(hour):
    assert hours(Window.hour("2024-01-01", hour)) == {"2024-01-01": [5]}


@pytest.mark.parametrize("hour", ["24", -1, "x"])
def test_bad_hour(hour):
    with pytest.raises(ValueError):
        Window.hour("2024-01-01", hour)


@pytest.mark.parametrize(
    "mods, expected",
    [
        (None, None),
        ("None", None),
        ("", None),
        ("999", None),
        ([4, 999], None),
        ("15 44 18 44", [15, 18, 44]),
        ([3], [3]),
        (7, [7]),
    ],
)
def test_bucket_lists(mods, expected):
    assert parse_mods(mods) == expected


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    log = log_of(
        spark,
        *[
            row(f"2024-01-01 {h:02d}:30:00", campaign_group_id=g)
            for h in range(22)
            for g in (15, 7)
        ],
        row("2024-01-02 00:30:00", campaign_group_id=15),
        row("2024-01-02 01:30:00", campaign_group_id=None),
    )
    return write_log(log, str(tmp_path_factory.mktemp("stored") / "log"))


def test_scan_reads_partition_columns(spark, stored):
    log = scan_bid_log(spark, stored)
    assert log.count() == 46
    types = dict(log.dtypes)
    assert (types["dt"], types["hh"], types["cgid_mod"]) == ("date", "int", "int")
    assert log.where("cgid_mod IS NULL").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_prune_partitions(spark, stored):
    log = scan_bid_log(spark, stored, Window.hour("2024-01-01", "05"), "15 999")
    assert {(r.hh, r.cgid_mod) for r in log.collect()} == {(5, 15), (5, 7)}
    log = scan_bid_log(spark, stored, Window.trailing("2024-01-02T01:00:00"), "15")
    assert sorted((str(r.dt), r.hh) for r in log.collect()) == [
        ("2024-01-01", 19),
        ("2024-01-01", 20),
        ("2024-01-01", 21),
        ("2024-01-02", 0),
    ]
    plan = plan_of(log)
    filters = plan[plan.index("PartitionFilters") :]
    assert all(c in filters.split("PushedFilters")[0] for c in ("dt", "hh", "cgid_mod"))


def test_only_the_days_of_a_window_are_listed(spark, stored):
    assert len(scan_bid_log(spark, stored).inputFiles()) == 46
    assert len(scan_bid_log(spark, stored, Window.hour("2024-01-02", 1)).inputFiles()) == 2


def test_window_without_partitions_is_empty(spark, stored):
    log = scan_bid_log(spark, stored, Window.day("2023-05-05"))
    assert log.count() == 0
    assert log.columns == scan_bid_log(spark, stored).columns


def test_missing_hours_and_buckets(spark, stored):
    day = Window.day("2024-01-01")
    found = dicts(missing_partitions(spark, stored, day))
    assert [(f["hh"], f["cgid_mod"]) for f in sorted(found, key=lambda f: f["hh"])] == [
        (22, None),
        (23, None),
    ]
    found = dicts(missing_partitions(spark, stored, day, "15 1"))
    assert {(f["hh"], f["cgid_mod"]) for f in found} == {(22, 15), (23, 15)} | {
        (h, 1) for h in range(24)
    }
    assert missing_partitions(spark, stored, Window.day("2023-05-05")).count() == 24


def test_partition_check_opens_no_log_file(spark, stored):
    plan = plan_of(missing_partitions(spark, stored, Window.day("2024-01-01")))
    assert "binaryFile" in plan and "parquet" not in plan.lower().split("location")[0]
