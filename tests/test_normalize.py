import pytest
from helpers import dicts, log_of, row
from pyspark.sql import functions as F

from bidweave.functions.columns import bucket_of, flag
from bidweave.operators import rollups as R
from bidweave.operators.normalize import normalize_bid_log, parse_pacing, publish
from bidweave.schema import ALL_PAYLOAD_FIELDS, PAYLOAD_COUNTERS, payload_schema


def parsed(spark, payload):
    return dicts(parse_pacing(log_of(spark, row(payload=payload))))[0]


@pytest.mark.parametrize("payload", ["{bad", "", None, "[]", "null"])
def test_unreadable_payload_gives_nulls_and_no_terms(spark, payload):
    log = normalize_bid_log(log_of(spark, row(payload=payload)))
    found = dicts(log)[0]
    assert all(found[c] is None for c in PAYLOAD_COUNTERS + ["picked_term_id", "terms"])
    assert R.flatten_terms(log).count() == 0


def test_wrong_shape_only_voids_its_own_field(spark):
    found = parsed(spark, '{"terms": "oops", "flight_campaign_spend": 5, "picked_term_id": "x"}')
    assert found["terms"] is None
    assert found["flight_campaign_spend"] == "5"
    assert found["picked_term_id"] == "x"


@pytest.mark.parametrize(
    "text, shown", [("12.50", "12.5"), ("1e3", "1000.0"), ('"12.50"', "12.50")]
)
def test_numbers_become_text(spark, text, shown):
    assert parsed(spark, '{"daily_campaign_spend": %s}' % text)["daily_campaign_spend"] == shown


def test_eligible_terms_keep_their_json_text(spark):
    assert parsed(spark, '{"eligible_term_ids": [1, 2]}')["eligible_term_id"] == "[1,2]"


def test_empty_terms_drop_the_row_and_missing_keys_are_null(spark):
    log = log_of(
        spark, row(payload={"terms": []}), row(payload={"terms": [{"id": "4"}, {"spend": "2"}]})
    )
    terms = dicts(R.flatten_terms(normalize_bid_log(log)))
    assert [(t["term_id"], t["term_spend"]) for t in terms] == [("4", None), (None, "2")]


def test_parsing_fewer_fields_gives_the_same_values(spark):
    payload = {"daily_campaign_spend": "3", "terms": [{"id": "1"}], "picked_term_id": "9"}
    for text in [payload, "{bad", '{"daily_campaign_spend": "3", "terms": [', '{"terms": 1}']:
        log = log_of(spark, row(payload=text))
        full = dicts(parse_pacing(log))[0]
        part = dicts(parse_pacing(log, ["daily_campaign_spend"]))[0]
        assert part["daily_campaign_spend"] == full["daily_campaign_spend"]


@pytest.mark.parametrize(
    "text, value", [("true", True), ("1", True), ("yes", True), ("0", False), ("abc", None)]
)
def test_flags(spark, text, value):
    assert spark.range(1).select(flag(F.lit(text))).first()[0] is value


def test_bucket_follows_the_sign_of_the_group(spark):
    found = spark.range(1).select(bucket_of(F.lit(-105)), bucket_of(F.lit(205))).first()
    assert tuple(found) == (-5, 5)


def test_time_columns(spark):
    log = publish(normalize_bid_log(log_of(spark, row("2024-02-29 23:59:59")), []))
    found = dicts(log)[0]
    assert (found["dt"], found["hh"], found["min"]) == ("2024-02-29", 23, 59)
    assert log.schema["dt"].dataType.simpleString() == "string"
    assert log.schema["hh"].dataType.simpleString() == "int"


def test_time_columns_follow_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        found = dicts(publish(normalize_bid_log(log_of(spark, row("2024-01-01 20:10:00")), [])))[0]
        assert (found["dt"], found["hh"], found["min"]) == ("2024-01-02", 1, 40)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_is_parsed_once(spark):
    assert plan_of(normalize_bid_log(log_of(spark, row()))).count("from_json") == 1


def test_unused_payload_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    log_of(spark, row()).write.parquet(path)
    plan = plan_of(R.bid_rows(normalize_bid_log(spark.read.parquet(path), [])))
    assert "pacing_debug_data" not in plan


def test_payload_schema_lists_every_field():
    assert payload_schema().fieldNames() == ALL_PAYLOAD_FIELDS
    assert len(ALL_PAYLOAD_FIELDS) == 19
