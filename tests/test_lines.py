"""Logs as text lines: good and rejected lines make up the input."""

import json
from collections import Counter

import pytest

from bidweave.schema import BID_LOG_SCHEMA
from bidweave.sources.bid_log import scan_bid_log
from bidweave.sources.lines import KEPT_CHARS, good_rows, ingest_lines, parsed_lines, read_lines, rejected_lines

GOOD = {"epoch": 1704085800000, "campaign_group_id": 105, "campaign_id": 1, "auction_id": "a", "price": 1.5, "has_price": True}
JSON = {
    json.dumps(GOOD): None,
    json.dumps({**GOOD, "price": "2.25", "other": [1, {"x": 2}]}): None,
    json.dumps({"epoch": "1704085800000", "pacing_debug_data": '{"terms": []}'}): None,
    "  " + json.dumps({**GOOD, "auction_id": 'quo"ted\n and é 日本'}) + " ": None,
    json.dumps(GOOD)[:40]: "broken line",
    json.dumps(GOOD) + json.dumps(GOOD)[:30]: "broken line",
    json.dumps(GOOD)[:-1] + ", ": "broken line",
    "null": "broken line",
    "[1, 2]": "broken line",
    '"text"': "broken line",
    "not json at all": "broken line",
    "   ": "broken line",
    json.dumps({**GOOD, "epoch": "noon"}): "bad epoch",
    json.dumps({**GOOD, "price": "1,5"}): "bad price",
    json.dumps({**GOOD, "campaign_id": 10**30}): "bad campaign_id",
    json.dumps({k: v for k, v in GOOD.items() if k != "epoch"}): "no epoch",
    json.dumps({**GOOD, "epoch": None}): "no epoch",
    json.dumps({**GOOD, "auction_id": "x" * 5000}): "line too long",
    "y" * 5001: "line too long",
}
FIELDS = ["1704085800000", "1", "105", "1050", "", "a b", "true", "1.5", "floor", '{"x": "|"}']
CSV = {
    "|".join(FIELDS[:-1] + ["{}"]): None,
    "|".join(["1704085800000", *[""] * 9]): None,
    "|".join(FIELDS): "wrong number of fields",
    "|".join(FIELDS[:4]): "wrong number of fields",
    "||||||||||": "wrong number of fields",
    "|||||||||": "no epoch",
    "|".join(["x", *FIELDS[1:-1], ""]): "bad epoch",
    "|".join([*FIELDS[:7], "nan.1", "", ""]): "bad price",
    "z" * 5000: "line too long",
}


def written(tmp_path, lines):
    (tmp_path / "in" / "a").mkdir(parents=True)
    names = list(lines) + list(lines)[:2]
    (tmp_path / "in" / "one.txt").write_text("\n".join(names[::2]) + "\n\n")
    (tmp_path / "in" / "a" / "two.txt").write_text("\r\n".join(names[1::2]))
    return str(tmp_path / "in"), Counter(names)


@pytest.mark.parametrize("kind, lines", [("json", JSON), ("csv", CSV)])
def test_good_and_rejected_lines_make_up_the_input(spark, tmp_path, kind, lines):
    path, given = written(tmp_path, lines)
    parsed = parsed_lines(read_lines(spark, path), kind, separator="|", most_chars=4000)
    got = Counter({(r.line, r.reason): r["count"] for r in parsed.groupBy("line", "reason").count().collect()})
    assert got == Counter({(line, lines[line]): n for line, n in given.items()})
    good = good_rows(parsed)
    assert good.schema == BID_LOG_SCHEMA
    n_good = sum(n for line, n in given.items() if lines[line] is None)
    assert good.count() == n_good and rejected_lines(parsed).count() == sum(given.values()) - n_good
    assert good.where("epoch IS NULL").isEmpty()
    kept = rejected_lines(parsed).where("reason = 'line too long'").first()
    assert len(kept.line) == KEPT_CHARS < kept.chars and kept.file.endswith(".txt")


def test_values_are_typed(spark, tmp_path):
    path, _ = written(tmp_path, JSON)
    rows = good_rows(parsed_lines(read_lines(spark, path), most_chars=4000)).collect()
    assert {str(r.price) for r in rows} == {"1.5000", "2.2500", "None"}
    assert 'quo"ted\n and é 日本' in {r.auction_id for r in rows}
    assert {r.has_price for r in rows} == {"true", None}
    assert '{"terms": []}' in {r.pacing_debug_data for r in rows}


def test_ingested_lines_are_in_the_log_or_in_quarantine(spark, tmp_path):
    path, given = written(tmp_path, JSON)
    log, quarantine = str(tmp_path / "log"), str(tmp_path / "bad")
    counts = ingest_lines(spark, path, log, quarantine, most_chars=4000)
    told = {r.reason: r.lines for r in counts.collect()}
    assert sum(told.values()) == sum(given.values())
    assert scan_bid_log(spark, log).count() == told[None]
    bad = spark.read.parquet(quarantine).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in bad} == {k: n for k, n in told.items() if k is not None}


def test_no_lines_and_unknown_formats(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("\n\n")
    parsed = parsed_lines(read_lines(spark, str(tmp_path)))
    assert good_rows(parsed).count() == 0 and rejected_lines(parsed).count() == 0
    with pytest.raises(ValueError):
        parsed_lines(read_lines(spark, str(tmp_path)), "xml")


@pytest.mark.parametrize("kind, call", [("json", "from_json"), ("csv", "split(")])
def test_a_line_is_cut_once(spark, tmp_path, kind, call):
    path, _ = written(tmp_path, JSON)
    parsed = parsed_lines(read_lines(spark, path), kind)
    for found in (good_rows(parsed), rejected_lines(parsed)):
        assert found._jdf.queryExecution().executedPlan().toString().count(call) == 1
