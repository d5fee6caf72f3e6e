"""Rollups kept up to date from partial aggregates of batches."""

import itertools
import os

import pytest
from helpers import log_of, row
from pyspark.sql import functions as F

from bidweave.fixtures.log import lineitem_log
from bidweave.fixtures.queries import read_dataset, stacked, write_log
from bidweave.plans.jobs import run_rollups
from bidweave.plans.kept import KeptBase, incremental_job
from bidweave.sources.windows import Window

SF_DIR = "/root/testdata/sf0.001"
WHOLE = Window.trailing("2024-01-03T02:00:00", 52)


def same(spark, written, expected):
    assert set(written) == set(expected)
    for name, path in written.items():
        a, b = read_dataset(spark, path), read_dataset(spark, expected[name])
        assert a.count() > 0
        assert a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty(), name


@pytest.fixture(scope="module")
def parts(spark):
    log = lineitem_log(spark, SF_DIR).where("epoch % 5 = 0 OR campaign_group_id IS NULL OR true").persist()
    part = F.pmod(F.xxhash64("epoch", "campaign_id", "auction_id"), F.lit(3))
    return [log.where(part == n) for n in range(3)]


@pytest.fixture(scope="module")
def expected(spark, parts, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    log = write_log(parts[0].unionByName(parts[1]).unionByName(parts[2]), str(folder / "log"))
    return run_rollups(spark, log, str(folder / "o"), WHOLE, ["hour"])


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_batches_equals_the_full_run(spark, parts, expected, tmp_path, order):
    base = KeptBase(spark, str(tmp_path / "kept"), "hour")
    for n in order:
        assert base.apply(parts[n], f"b{n}")
    same(spark, base.publish(str(tmp_path / "o")), expected)


def test_a_batch_counts_once_and_publications_add_up(spark, parts, expected, tmp_path):
    root = str(tmp_path / "kept")
    for n in (1, 1, 0):
        # Each time a new session would do: all state is in files.
        KeptBase(spark, root, "hour").apply(parts[n], f"b{n}")
    assert not KeptBase(spark, root, "hour").apply(parts[0], "b0")
    KeptBase(spark, root, "hour").publish(str(tmp_path / "o"))
    base = KeptBase(spark, root, "hour")
    base.apply(parts[2], "b2")
    same(spark, base.publish(str(tmp_path / "o")), expected)
    assert sum(base.batches().values()) == sum(p.count() for p in parts)


def test_what_a_failed_attempt_left_is_not_read(spark, parts, expected, tmp_path, monkeypatch):
    base = KeptBase(spark, str(tmp_path / "kept"), "hour")
    base.apply(parts[0], "b0")
    with monkeypatch.context() as broken:
        broken.setattr(base, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            base.apply(parts[1], "b1")
    assert len(os.listdir(tmp_path / "kept" / "runs")) == 2 and set(base.batches()) == {"b0"}
    for n in (1, 2):
        assert base.apply(parts[n], f"b{n}")
    same(spark, base.publish(str(tmp_path / "o")), expected)


def test_runs_are_merged_by_levels(spark, tmp_path):
    base = KeptBase(spark, str(tmp_path / "kept"), "minute")
    rows = []
    for n in range(7):
        new = [row(f"2024-01-01 0{n % 3}:10:00", payload={"terms": [{"id": "1", "spend": "2"}]}) for _ in range(n + 1)]
        rows += new
        base.apply(log_of(spark, *new), f"b{n}")
        written = base.publish(str(tmp_path / "o"), ["hour", "minute"])
        base.merge(fanout=2)
    assert max(base.live().values()) >= 2 and len(base.live()) <= 3
    assert len(os.listdir(tmp_path / "kept" / "runs")) == len(base.live())
    log = write_log(log_of(spark, *rows), str(tmp_path / "log"))
    same(spark, written, run_rollups(spark, log, str(tmp_path / "w"), WHOLE, ["hour", "minute"]))
    assert len(base.batches()) == 7 and not base.apply(log_of(spark, row()), "b3")


def test_publishing_reads_only_hours_with_new_rows(spark, parts, tmp_path):
    base = KeptBase(spark, str(tmp_path / "kept"), "hour")
    for n in (0, 1):
        base.apply(parts[n], f"b{n}")
    base.publish(str(tmp_path / "o"))
    before = {f: os.path.getmtime(f) for f in _files(tmp_path / "o")}
    base.apply(log_of(spark, row("2024-01-01 22:10:00")), "late")
    written = base.publish(str(tmp_path / "o"))
    changed = {f for f in _files(tmp_path / "o") if before.get(f) != os.path.getmtime(f)}
    assert changed and all("dt=2024-01-01/hh=22" in f for f in changed)
    assert base.publish(str(tmp_path / "o")) == written


def _files(root):
    return [os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")]


def test_job_reads_new_files_only(spark, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "o")
    payload = {"terms": [{"id": "1", "spend": "2"}]}
    write_log(log_of(spark, row("2024-01-01 05:10:00", payload=payload), row("2024-01-01 06:10:00", payload=payload)), log)
    incremental_job(spark, log, target, ["hour", "minute"])
    assert sum(KeptBase(spark, f"{target}/_kept").batches().values()) == 2
    write_log(log_of(spark, row("2024-01-01 05:20:00", payload=payload), row(None), row("2024-01-01 07:10:00")), log.rstrip("/"))
    written = incremental_job(spark, log, target, ["hour", "minute"])
    assert sum(KeptBase(spark, f"{target}/_kept").batches().values()) == 5
    hours = stacked(spark, written).where("dataset = 'campaign_log_agg_hr'")
    assert {(r.hh, r.total_bid_requests) for r in hours.where("hh IN (5, 6, 7)").collect()} == {(5, 2), (6, 1), (7, 1)}


def test_empty_batches_and_bad_names(spark, tmp_path):
    base = KeptBase(spark, str(tmp_path / "kept"), "hour")
    assert base.apply(log_of(spark, row()).where("false"), "none")
    written = base.publish(str(tmp_path / "o"))
    assert set(written) == {"campaign_group_log_agg_hr", "campaign_log_agg_hr", "terms_log_agg_hr"}
    for name in ("a/b", "", "x y"):
        with pytest.raises(ValueError):
            base.apply(log_of(spark, row()), name)
    with pytest.raises(ValueError, match="kept by hour"):
        base.publish(str(tmp_path / "o"), "minute")
