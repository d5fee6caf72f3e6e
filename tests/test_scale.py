"""Plans that must hold when one key carries a third of all rows."""

from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import log_of, row
from pyspark.sql import functions as F

from bidweave.fixtures import queries as Q
from bidweave.fixtures.analysis import q_velocity
from bidweave.fixtures.log import dealt_lineitem_log, lineitem_log
from bidweave.functions.columns import flag, text_flag
from bidweave.operators import rollups as R
from bidweave.operators.normalize import normalize_bid_log
from bidweave.operators.reports import (
    campaign_group_report,
    campaign_report,
    groups_with_null_key,
)
from bidweave.plans.base import aggregate_records, stage_base
from bidweave.plans.late import moved_rows
from bidweave.schema import PAYLOAD_COUNTERS
from bidweave.sources.bid_log import scan_bid_log
from bidweave.session import SPLIT_BYTES, shared_dir, small_splits
from bidweave.sinks.archive import aged_files
from bidweave.sinks.log import append_keyed, append_log
from bidweave.sinks.rollups import write_rollup
from bidweave.sources.windows import Window

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan_of(df)


def test_base_aggregates_before_its_only_shuffle(spark):
    base = aggregate_records(normalize_bid_log(log_of(spark, row())), "minute")
    plan = plan_of(base)
    assert plan.count("Exchange") == 1
    assert plan.count("from_json") == 1
    below = plan[plan.index("Exchange") :]
    assert "partial_max" in below and "partial_sum" in below


def hot_reasons(spark):
    """One campaign group in one hour whose failure reasons are all different."""
    hot = (F.col("epoch") % 3000 == 0) | F.col("campaign_id").between(980, 989)
    log = lineitem_log(spark, SF_DIR).withColumns(
        {
            "epoch": F.lit(1704067200000) + F.col("epoch") % 3600000,
            "campaign_group_id": F.when(hot, 7).otherwise(F.col("epoch") % 5000),
            "campaign_id": F.when(hot, 70).otherwise(F.col("epoch") % 5000),
            "flight_id": F.lit(1),
            "threshold_failure_reasons": F.concat(F.lit("r"), F.col("auction_id")),
        }
    )
    return R.bid_rows(normalize_bid_log(log))


@pytest.mark.parametrize("kind", ["group", "single"])
def test_a_hot_key_is_split_over_tasks(spark, kind):
    rows = hot_reasons(spark)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        if kind == "group":
            rollup = R.campaign_group_rollup(rows, "hour")
            reasons = R.campaign_group_failure_reasons(rows, "hour")
            lone = groups_with_null_key(rows, "hour")
            report = campaign_group_report(rollup, reasons, lone, "hour")
        else:
            rollup = R.campaign_rollup(rows, "hour")
            reasons = R.campaign_failure_reasons(rows, "hour")
            report = campaign_report(rollup, reasons, "hour")
        assert "skew=true" in final_plan(report)


def test_a_hot_bucket_is_written_by_several_tasks(spark, tmp_path):
    bucket = F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id") % 5)
    frame = spark.range(0, 300_000, 1, 8).select(
        F.lit("2024-01-01").alias("dt"), F.lit(5).alias("hh"), bucket.alias("cgid_mod"), "id"
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200k"):
        path = write_rollup(frame, str(tmp_path / "out"))
    assert spark.read.parquet(path).count() == 300_000
    hot = [f for f in spark.read.parquet(path).inputFiles() if "cgid_mod=7/" in f]
    assert len(hot) > 2


def test_a_report_reads_the_payload_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log_of(spark, row()).write.parquet(path)
    log = spark.read.parquet(path)
    for report in (Q.group_report, Q.single_report):
        plan = plan_of(report(log, "hour"))
        assert plan.count("from_json") == 1
        scans = [part.split("]")[0] for part in plan.split("FileScan parquet [")[1:]]
        assert sum("pacing_debug_data" in scan for scan in scans) == 1


def test_search_for_moved_rows_reads_only_what_it_needs(spark, tmp_path):
    keyed = log_of(spark, row()).withColumns(
        {"dt": F.lit("2024-01-01"), "hh": F.lit("05"), "cgid_mod": F.lit(5)}
    )
    path = str(tmp_path / "log")
    keyed.write.partitionBy("dt", "hh", "cgid_mod").parquet(path)
    moved = moved_rows(scan_bid_log(spark, path, Window.day("2024-01-01")))
    assert moved.count() == 0
    assert "ReadSchema: struct<epoch:bigint,campaign_group_id:bigint>" in plan_of(moved)


def test_archive_listing_reads_no_content(spark, tmp_path):
    size = 1 << 42
    with (tmp_path / "file").open("wb") as sparse:
        sparse.truncate(size)  # far more than a task could read
    later = datetime.now(timezone.utc) + timedelta(days=30)
    assert [r.length for r in aged_files(spark, str(tmp_path), now=later).collect()] == [size]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
    assert shared_dir(spark) == shared_dir(spark)


def test_a_cluster_must_name_its_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"
            applicationId = "app"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)


def test_the_stored_log_is_dealt_out_before_its_payload_is_made(spark, tmp_path):
    log = dealt_lineitem_log(spark, SF_DIR)
    plan = plan_of(log)
    assert plan.count("Exchange") == 1 and "pacing_debug_data" not in plan[plan.index("Exchange") :]
    assert "pacing_debug_data" in plan and log.schema["hh"].nullable is False
    plain = lineitem_log(spark, SF_DIR)
    found = scan_bid_log(spark, append_keyed(log, str(tmp_path / "dealt")))
    wanted = scan_bid_log(spark, append_log(plain, str(tmp_path / "plain"))).select(*found.columns)
    assert found.exceptAll(wanted).isEmpty() and found.count() == wanted.count() == plain.count()


def test_the_log_is_stored_small_with_few_rows_a_task(spark, tmp_path):
    payload = {c: f"{n}.25" for n, c in enumerate(PAYLOAD_COUNTERS)}
    made = F.to_json(F.struct(*[F.concat(F.xxhash64("id", F.lit(c)).cast("string"), F.lit(v)).alias(c) for c, v in payload.items()]))
    rows = spark.range(0, 60_000, 1, 1).crossJoin(log_of(spark, row()).drop("pacing_debug_data"))
    log = rows.select(*[c for c in rows.columns if c != "id"], made.alias("pacing_debug_data"))
    path = append_log(log, str(tmp_path / "log"))
    log.coalesce(1).write.option("compression", "snappy").parquet(str(tmp_path / "plain"))
    groups = [g for file in Path(path).rglob("*.parquet") for g in row_groups(file)]
    plain = [g for file in (tmp_path / "plain").glob("*.parquet") for g in row_groups(file)]
    assert {g.column(0).compression for g in groups} == {"ZSTD"}
    assert sum(map(stored_bytes, groups)) < 0.8 * sum(map(stored_bytes, plain))
    assert len(groups) > 1 and max(map(stored_bytes, groups)) <= 1.1 * SPLIT_BYTES
    found = scan_bid_log(spark, path).select(*log.columns)
    assert found.exceptAll(log).isEmpty() and found.count() == 60_000


def row_groups(file):
    metadata = pq.ParquetFile(file).metadata
    return [metadata.row_group(n) for n in range(metadata.num_row_groups)]


def stored_bytes(group):
    return sum(group.column(n).total_compressed_size for n in range(group.num_columns))


def test_the_base_reads_the_log_in_small_splits(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.files.maxPartitionBytes", []

    class Watched(type(spark.range(1).write)):
        def parquet(self, path, *args, **kwargs):
            seen.append(int(spark.conf.get(name)))
            super().parquet(path, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: Watched(df)))
    with settings(spark, spark__sql__files__maxPartitionBytes="1g"):
        stage_base(spark, log_of(spark, row()), "minute", str(tmp_path / "base"))
        assert seen == [SPLIT_BYTES] and spark.conf.get(name) == "1g"
    with settings(spark, spark__sql__files__maxPartitionBytes="1m"), small_splits(spark):
        assert spark.conf.get(name) == "1m"


def test_a_text_flag_reads_as_the_cast_does(spark):
    texts = [None, "", "true", "TRUE", " t ", "Yes", "y", "1", "false", "F", "no\t", "N", "0", "maybe", "01", " true", "truе", "\x7ft"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", text_flag(F.col("t")).alias("a"), flag(F.col("t")).alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found] and {r.a for r in found} == {None, True, False}


def test_spend_velocity_parses_the_payload_once(spark):
    plan = plan_of(q_velocity(spark, SF_DIR))
    assert "from_json" not in plan and "lineitem" not in plan
