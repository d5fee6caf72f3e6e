import os
import subprocess
import sys
from datetime import datetime, timedelta, timezone

import pytest
from helpers import dicts, log_of, row
from pyspark import cloudpickle
from pyspark.sql import functions as F

from bidweave.fixtures.log import lineitem_log
from bidweave.fixtures.queries import read_dataset, terms_of, write_log
from bidweave.operators.normalize import publish
from bidweave.plans.jobs import daily_job, intraday_job, run_rollups
from bidweave.session import shared_dir
from bidweave.sinks import files
from bidweave.sinks.archive import aged_files, archive_aged_partitions
from bidweave.sources.bid_log import scan_bid_log
from bidweave.sources.windows import Window

DAY = Window.day("2024-01-01")


def write_partition(spark, root, dt, hh, bucket, *rows):
    """Stores rows in a given partition, whatever their own hour and bucket."""
    keyed = log_of(spark, *rows).withColumns(
        {"dt": F.lit(dt), "hh": F.lit(f"{hh:02d}"), "cgid_mod": F.lit(bucket)}
    )
    keyed.write.mode("append").partitionBy("dt", "hh", "cgid_mod").parquet(root)


def counts(spark, written):
    return {name: spark.read.parquet(path).count() for name, path in written.items()}


@pytest.fixture
def source(spark, tmp_path):
    payload = {"terms": [{"id": "1", "spend": "2"}]}
    log = log_of(
        spark,
        row("2024-01-01 05:10:00", payload=payload),
        row("2024-01-01 05:20:00", payload=payload, threshold_failure_reasons=None),
        row("2024-01-01 06:10:00", payload=payload, campaign_group_id=107, campaign_id=1070),
        row("2024-01-01 06:11:00", payload=payload, flight_id=None),
        row("2024-01-01 06:11:00", campaign_group_id=107, flight_id=None),
    )
    return write_log(log, str(tmp_path / "log"))


def test_rerun_keeps_overwritten_rows_and_doubles_appended_ones(spark, source, tmp_path):
    once = counts(spark, run_rollups(spark, source, str(tmp_path / "o"), DAY))
    again = counts(spark, run_rollups(spark, source, str(tmp_path / "o"), DAY))
    assert once == again and min(once.values()) > 0
    once = counts(spark, run_rollups(spark, source, str(tmp_path / "a"), DAY, mode="append"))
    again = counts(spark, run_rollups(spark, source, str(tmp_path / "a"), DAY, mode="append"))
    assert again == {name: 2 * n for name, n in once.items()}


def test_appended_half_rows_keep_the_null_bucket(spark, source, tmp_path):
    written = run_rollups(spark, source, str(tmp_path / "o"), DAY, mode="append")
    report = spark.read.parquet(written["campaign_group_log_agg_hr"])
    assert report.where("cgid_mod IS NULL").count() == 2
    written = run_rollups(spark, source, str(tmp_path / "p"), DAY)
    report = spark.read.parquet(written["campaign_group_log_agg_hr"])
    assert report.where("cgid_mod IS NULL").count() == 0


def test_bucket_runs_do_not_replace_each_other(spark, source, tmp_path):
    split, whole = str(tmp_path / "split"), str(tmp_path / "whole")
    for mods in ("5", "7"):
        written = run_rollups(spark, source, split, DAY, mods=mods)
    expected = run_rollups(spark, source, whole, DAY)
    for name in expected:
        a, b = (read_dataset(spark, w[name]) for w in (written, expected))
        assert a.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hour_runs_add_up_to_the_day(spark, source, tmp_path):
    split, whole = str(tmp_path / "split"), str(tmp_path / "whole")
    for hour in ("5", "06"):
        written = daily_job(spark, source, split, "minute", day="2024-01-01", hour=hour)
    expected = daily_job(spark, source, whole, "minute", day="2024-01-01")
    for name in expected:
        a, b = (read_dataset(spark, w[name]) for w in (written, expected))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_intraday_job_covers_the_six_hours_before(spark, source, tmp_path):
    written = intraday_job(spark, source, str(tmp_path / "o"), "2024-01-01T12:00:00")
    assert {r.hh for r in spark.read.parquet(written["terms_log_agg_hr"]).collect()} == {6}
    written = intraday_job(spark, source, str(tmp_path / "p"), "2024-01-01T06:00:00", "minute")
    assert {r.hh for r in spark.read.parquet(written["terms_log_agg_min"]).collect()} == {5}


@pytest.mark.parametrize("zone, ansi", [("Asia/Kolkata", "true"), ("America/New_York", "false")])
def test_a_day_is_a_day_of_the_session_time_zone(spark, tmp_path, zone, ansi):
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        log = lineitem_log(spark, "/root/testdata/sf0.001")
        stored = write_log(log, str(tmp_path / "zoned"))
        days = sorted({str(r.dt) for r in scan_bid_log(spark, stored).select("dt").distinct().collect()})
        day = days[len(days) // 2]
        written = daily_job(spark, stored, str(tmp_path / "o"), day=day)
        got = read_dataset(spark, written["terms_log_agg_hr"])
        expected = publish(terms_of(log, "hour")).where(F.col("dt") == day).select(*got.columns)
        assert 0 < got.count() < terms_of(log, "hour").count()
        assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.unset("spark.sql.ansi.enabled")


LATE = [
    ("2024-01-01", 6, 5, row("2024-01-01 05:59:59")),
    ("2024-01-01", 10, 5, row("2024-01-01 05:10:00")),
    ("2024-01-02", 3, 5, row("2024-01-01 06:30:00")),
    ("2024-01-01", 6, 9, row("2024-01-01 05:20:00")),
    ("2024-01-01", 6, 5, row(None)),
]


def requests_by_hour(spark, written):
    stored = spark.read.parquet(written["campaign_group_log_agg_hr"])
    own = [c for c in stored.columns if not c.startswith(("cg_", "fail_"))]
    rows = stored.select(*own).distinct().groupBy("hh").sum("total_bid_requests").collect()
    return {r[0]: r[1] for r in rows}


@pytest.mark.parametrize("first", range(3))
def test_late_rows_count_whenever_they_arrive(spark, source, tmp_path, first):
    target = str(tmp_path / "o")
    for hour in (5, 6)[: first + 1]:
        daily_job(spark, source, target, day="2024-01-01", hour=hour)
    for late in LATE:
        write_partition(spark, source, *late)
    order = [("2024-01-01", 10), ("2024-01-02", 3), ("2024-01-01", 6)]
    for day, hour in order[first:] + order[:first]:
        written = daily_job(spark, source, target, day=day, hour=hour)
    whole = str(tmp_path / "w")
    for day in ("2024-01-02", "2024-01-01"):
        expected = run_rollups(spark, source, whole, Window.day(day))
    written = daily_job(spark, source, target, day="2024-01-01", hour=5)
    for name in written:
        a = spark.read.parquet(written[name]).where("dt = '2024-01-01' AND hh IN (5, 6)")
        b = spark.read.parquet(expected[name]).where("dt = '2024-01-01' AND hh IN (5, 6)")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    counted = requests_by_hour(spark, written)
    log = scan_bid_log(spark, source).where("auction_id IS NOT NULL")
    hours = log.selectExpr("hour(timestamp_millis(coalesce(epoch, 1704067200000 + 21600000))) AS h")
    assert counted[5] == hours.where("h = 5").count()


def test_overwriting_removes_what_has_no_rows_any_more(spark, tmp_path):
    target = str(tmp_path / "o")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    term = {"terms": [{"id": "1"}]}
    for folder in (old, new):
        write_partition(spark, folder, "2024-01-01", 5, 5, row("2024-01-01 05:01:00", payload=term if folder == old else None))
    write_partition(spark, old, "2024-01-01", 6, 5, row("2024-01-01 06:01:00", payload=term))
    run_rollups(spark, old, target, DAY)
    other = str(tmp_path / "next")
    write_partition(spark, other, "2024-01-02", 6, 5, row("2024-01-02 06:01:00", payload=term))
    run_rollups(spark, other, target, Window.day("2024-01-02"))
    written = run_rollups(spark, new, target, DAY)
    left = {n: {(str(r.dt), r.hh) for r in spark.read.parquet(p).collect()} for n, p in written.items()}
    assert left["campaign_log_agg_hr"] == {("2024-01-01", 5), ("2024-01-02", 6)}
    assert left["terms_log_agg_hr"] == {("2024-01-02", 6)}
    run_rollups(spark, str(tmp_path / "none"), target, DAY)
    assert {str(r.dt) for r in spark.read.parquet(written["campaign_log_agg_hr"]).collect()} == {"2024-01-02"}


def test_types_of_the_files(spark, tmp_path):
    log = lineitem_log(spark, "/root/testdata/sf0.001")
    typed = log.withColumns(
        {"has_price": F.col("has_price").cast("boolean"), "price": F.col("price").cast("double"), "campaign_id": F.col("campaign_id").cast("int")}
    )
    stored = write_log(typed, str(tmp_path / "typed"))
    written = daily_job(spark, stored, str(tmp_path / "o"), day="2024-01-01")
    plain = daily_job(spark, write_log(log, str(tmp_path / "plain")), str(tmp_path / "p"), day="2024-01-01")
    for name in written:
        a, b = spark.read.parquet(written[name]), spark.read.parquet(plain[name])
        cols = [c for c in b.columns if "price" not in c]
        assert a.select(cols).exceptAll(b.select(cols)).isEmpty() and a.count() == b.count()
    lacking = write_log(log.drop("price"), str(tmp_path / "lacking"))
    with pytest.raises(ValueError, match="no column price"):
        scan_bid_log(spark, lacking)


def test_window_without_rows_writes_empty_datasets(spark, source, tmp_path):
    written = run_rollups(spark, source, str(tmp_path / "o"), Window.day("2023-01-01"))
    assert set(written) == {"campaign_group_log_agg_hr", "campaign_log_agg_hr", "terms_log_agg_hr"}


def test_staged_tables_are_removed(spark, source, tmp_path):
    folder = f"{shared_dir(spark)}/bidweave"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    run_rollups(spark, source, str(tmp_path / "o"), DAY)
    assert set(os.listdir(folder)) == before


def test_one_run_for_both_grains(spark, source, tmp_path):
    both = run_rollups(spark, source, str(tmp_path / "o"), DAY, ["hour", "minute"])
    assert len(both) == 6
    for grain in ("hour", "minute"):
        single = run_rollups(spark, source, str(tmp_path / "p"), DAY, grain)
        for name, path in single.items():
            a, b = read_dataset(spark, path), read_dataset(spark, both[name])
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("options", [{"mode": "replace"}, {"grains": "day"}])
def test_bad_options(spark, source, tmp_path, options):
    with pytest.raises(ValueError):
        run_rollups(spark, source, str(tmp_path / "o"), DAY, **options)


# Archive

NOW = datetime(2024, 3, 10, 12, 0, tzinfo=timezone.utc)


def files_below(root):
    return sorted(
        os.path.relpath(os.path.join(folder, name), root)
        for folder, _, names in os.walk(root)
        for name in names
        if not name.startswith((".", "_"))
    )


def touch(path, at):
    os.utime(path, (at.timestamp(), at.timestamp()))


def test_only_strictly_older_files_are_aged(spark, tmp_path):
    cutoff = NOW - timedelta(days=7)
    second = timedelta(seconds=1)
    for name, at in {"below": cutoff - second, "at": cutoff, "above": cutoff + second}.items():
        (tmp_path / name).write_text(name)
        touch(tmp_path / name, at)
    found = dicts(aged_files(spark, str(tmp_path), now=NOW))
    assert [os.path.basename(f["path"]) for f in found] == ["below"]


def test_archive_moves_aged_files_only(spark, source, tmp_path):
    before = scan_bid_log(spark, source).collect()
    names = files_below(source)
    for n, name in enumerate(names):
        touch(f"{source}/{name}", NOW - timedelta(days=30 if n % 2 else 1))
    archive = str(tmp_path / "archive")
    report = dicts(archive_aged_partitions(spark, source, archive, now=NOW))
    aged = [name for n, name in enumerate(names) if n % 2]
    assert files_below(archive) == aged
    assert files_below(source) == [name for n, name in enumerate(names) if n % 2 == 0]
    assert len(report) == len(aged) and all(r["error"] is None for r in report)
    after = scan_bid_log(spark, source).union(scan_bid_log(spark, archive)).collect()
    assert sorted(map(str, after)) == sorted(map(str, before))
    assert archive_aged_partitions(spark, source, archive, now=NOW).count() == 0


def test_archive_can_be_repeated_after_an_interruption(spark, source, tmp_path):
    names = files_below(source)
    for name in names:
        touch(f"{source}/{name}", NOW - timedelta(days=30))
    archive = tmp_path / "archive"
    stale = archive / names[0]
    stale.parent.mkdir(parents=True)
    stale.write_text("half a copy")
    archive_aged_partitions(spark, source, str(archive), now=NOW)
    assert files_below(str(archive)) == names and files_below(source) == []
    assert scan_bid_log(spark, str(archive)).count() == 5


def test_archive_reports_a_failed_file_and_moves_the_rest(spark, source, tmp_path):
    names = files_below(source)
    for name in names:
        touch(f"{source}/{name}", NOW - timedelta(days=30))
    archive = tmp_path / "archive"
    (archive / names[0]).mkdir(parents=True)
    (archive / names[0] / "blocker").write_text("x")
    report = dicts(archive_aged_partitions(spark, source, str(archive), now=NOW))
    failed = [r for r in report if r["error"] is not None]
    assert len(failed) == 1 and failed[0]["path"].endswith(names[0])
    assert files_below(source) == [names[0]]


@pytest.mark.parametrize("inside", [True, False])
def test_archive_and_log_must_not_contain_each_other(spark, source, inside):
    other = f"{source}/archive" if inside else os.path.dirname(source)
    with pytest.raises(ValueError, match="must not contain"):
        archive_aged_partitions(spark, source, other, now=NOW)


def test_listing_is_done_in_tasks(spark, source, monkeypatch):
    for name in files_below(source):
        touch(f"{source}/{name}", NOW - timedelta(days=30))
    seen = []
    entries = files._entries
    monkeypatch.setattr(files, "_entries", lambda *a: seen.append(a) or entries(*a))
    found = aged_files(spark, source, now=NOW)
    assert "MapInPandas" in found._jdf.queryExecution().executedPlan().toString() and seen == [(f"file:{source}", False)]
    assert {f["path"] for f in dicts(found)} == {f"file:{source}/{n}" for n in files_below(source)}


def test_hidden_files_stay(spark, tmp_path):
    for name in (".part", "_SUCCESS", "_temporary/x", "dt=1/.crc", "dt=1/data"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
        touch(tmp_path / name, NOW - timedelta(days=30))
    found = dicts(aged_files(spark, str(tmp_path), now=NOW))
    assert [os.path.basename(f["path"]) for f in found] == ["data"]


@pytest.mark.parametrize("limit", [files.ONE_REQUEST, 0])
def test_a_copy_leaves_no_partial_file(tmp_path, monkeypatch, limit):
    monkeypatch.setattr(files, "ONE_REQUEST", limit)
    source, target = tmp_path / "a b#c", tmp_path / "deep" / "copy"
    source.write_bytes(b"x" * 1000)
    with pytest.raises(OSError, match="incomplete"):
        files.copy_file(f"file:{source}", str(target), 999)
    assert files_below(str(tmp_path)) == ["a b#c"] and os.listdir(target.parent) == []
    files.copy_file(f"file:{source}", str(target), 1000)
    assert target.read_bytes() == source.read_bytes() and os.listdir(target.parent) == ["copy"]


def test_task_functions_need_no_package_on_the_executors(tmp_path):
    pickled = tmp_path / "functions"
    pickled.write_bytes(cloudpickle.dumps([files.list_batches, files.copy_batches, files.delete_batches]))
    load = (
        f"import importlib.util, pickle; pickle.load(open({str(pickled)!r}, 'rb'));"
        "print(importlib.util.find_spec('bidweave'))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = [sys.executable, "-c", load]
    done = subprocess.run(run, cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.strip() == "None", done.stderr
