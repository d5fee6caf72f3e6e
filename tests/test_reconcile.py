"""Differences of two runs by fingerprints."""

from collections import Counter

import pytest
from helpers import log_of, row

from bidweave.fixtures.queries import write_log
from bidweave.plans import reconcile
from bidweave.plans.jobs import run_rollups
from bidweave.plans.reconcile import (
    diff_datasets,
    diff_rollups,
    differing_partitions,
    partition_fingerprints,
    read_partitions,
    take_fingerprints,
)
from bidweave.sources.windows import Window

DAY = Window.day("2024-01-01")
NAME = "campaign_log_agg_hr"


def run(spark, folder, *rows):
    log = write_log(log_of(spark, *rows), f"{folder}/log")
    return run_rollups(spark, log, f"{folder}/o", DAY), f"{folder}/o"


ROWS = [
    row("2024-01-01 05:10:00"),
    row("2024-01-01 05:20:00", flight_id=None),
    row("2024-01-01 06:10:00", campaign_group_id=107, campaign_id=1070),
    row("2024-01-01 07:10:00", campaign_group_id=None),
]


def bag(frame, columns):
    return Counter(tuple(r) for r in frame.select(columns).collect())


def test_equal_runs_read_no_wide_column(spark, tmp_path, monkeypatch):
    a, left = run(spark, tmp_path / "a", *ROWS)
    b, right = run(spark, tmp_path / "b", *reversed(ROWS))
    for written in (a, b):
        for path in written.values():
            take_fingerprints(spark, path)
    # From now on no dataset is read.
    monkeypatch.setattr(reconcile, "read_partitions", None)
    assert diff_rollups(spark, left, right, list(a), str(tmp_path / "staged")) is None
    plan = differing_partitions(spark, a[NAME], b[NAME])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4 and "total_bid_requests" not in plan
    assert plan.count("FileScan binaryFile [path#") == 2 and plan.count("FileScan parquet [file#") == 2


def test_differences_equal_except_all(spark, tmp_path):
    a, left = run(spark, tmp_path / "a", *ROWS)
    changed = [ROWS[0], ROWS[0], ROWS[1], row("2024-01-01 09:10:00", campaign_group_id=-5)]
    b, right = run(spark, tmp_path / "b", *changed)
    for name in a:
        found = diff_datasets(spark, a[name], b[name], str(tmp_path / f"s-{name}"))
        x, y = (read_partitions(spark, w[name]) if any_file(w[name]) else None for w in (a, b))
        columns = [c for c in (x or y).columns] if (x or y) is not None else []
        p, q = (bag(f, columns) if f is not None else Counter() for f in (x, y))
        if found is None:
            assert p == q
            continue
        got = {tuple(r[c] for c in columns): (r.left_copies, r.right_copies) for r in found.collect()}
        assert got == {k: (p[k], q[k]) for k in (p | q) if p[k] != q[k]}
    both = diff_rollups(spark, left, right, list(a), str(tmp_path / "all"))
    assert {r.dataset for r in both.select("dataset").distinct().collect()} >= {NAME}


def any_file(path):
    from pathlib import Path

    return any(Path(path).rglob("*.parquet"))


def test_copies_of_a_row_count(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, None, "x")], "n int, a string, b string")
    keys = "date'2024-01-01' AS dt", "5 AS hh", "CAST(NULL AS INT) AS cgid_mod"
    for name, rows in {"l": frame, "r": frame.distinct(), "s": frame.selectExpr("n", "b AS a", "a AS b")}.items():
        rows.selectExpr("*", *keys).write.partitionBy("dt", "hh", "cgid_mod").parquet(f"{tmp_path}/{name}")
    found = diff_datasets(spark, f"{tmp_path}/l", f"{tmp_path}/r", f"{tmp_path}/1").collect()
    assert [(r.n, r.left_copies, r.right_copies) for r in found] == [(1, 2, 1)]
    # Values that change places with NULLs make other rows.
    found = diff_datasets(spark, f"{tmp_path}/l", f"{tmp_path}/s", f"{tmp_path}/2").collect()
    assert sorted((r.n, r.left_copies, r.right_copies) for r in found) == [(1, 0, 2), (1, 2, 0), (2, 0, 1), (2, 1, 0)]
    missing = diff_datasets(spark, f"{tmp_path}/l", f"{tmp_path}/none", f"{tmp_path}/3").collect()
    assert sorted((r.n, r.left_copies, r.right_copies) for r in missing) == [(1, 2, 0), (2, 1, 0)]


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    written, _ = run(spark, tmp_path, *ROWS)
    first = {tuple(r) for r in partition_fingerprints(spark, written[NAME]).collect()}
    seen = []
    on_days = reconcile.on_days_of
    monkeypatch.setattr(reconcile, "on_days_of", lambda r, k: seen.append(k.count()) or on_days(r, k))
    assert {tuple(r) for r in partition_fingerprints(spark, written[NAME]).collect()} == first and seen == []
    log = write_log(log_of(spark, row("2024-01-01 05:40:00")), f"{tmp_path}/log")
    run_rollups(spark, log, f"{tmp_path}/o", Window.hour("2024-01-01", 5))
    again = {tuple(r) for r in partition_fingerprints(spark, written[NAME]).collect()}
    assert seen == [1] and len(again) == len(first) and again != first


@pytest.mark.parametrize("other", ["", "dt=2024-01-01"])
def test_datasets_without_files_agree(spark, tmp_path, other):
    (tmp_path / "x" / other).mkdir(parents=True)
    assert diff_datasets(spark, f"{tmp_path}/x", f"{tmp_path}/y", f"{tmp_path}/s") is None
