"""URL rules against a plain version, trees by held-out accuracy."""

import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from bidweave.llm.queries import URL_RULES
from bidweave.llm.url_filter import host_and_path, judge, labelled_by_rules, lexical, parse_rules, train

TABLES = "/root/testdata/sf0.1"

SCHEMA = "page_id bigint, url string, host string, rule string, label string, features string"


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in parse_rules(URL_RULES):
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.name) > len(best.name):
                best = rule
    return host, path, best and best.name, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://org/", "https://A.B.ORG/x?y#z", "x://org?/a",
    "http://example.org/es/1", "http://www.example.org/es", "http://badexample.org/es/1",
    "http://example.org/en/12/3", "http://example.org/en/2", "http://m.com/fr/", "http://m.com/de/1#a",
    "http://m.com/DE/1", "http://a.net/en?u=http://b.org/", "http://é.org/ü", "http://u:p@h.com:80/fr/x",
    "ftp://x.com/" + "a/" * 3000,
]


def test_rules(spark):
    rows = [(i, u, "h", "r", "l", "f") for i, u in enumerate(URLS)] + [(None, URLS[5], "", "", "", "")]
    frame = spark.createDataFrame([*rows, rows[6]], SCHEMA)
    rules = parse_rules(URL_RULES)
    model = train(labelled_by_rules(frame, rules), rounds=2)
    found = judge(frame, rules, model).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        url = URLS[5] if r.page_id is None else URLS[r.page_id]
        host, path, rule, verdict = plain(url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_trees_learn(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        bad = rng.random() < 0.4
        name = "".join(rng.choices("abcdefg", k=8))
        tail = "".join(rng.choices("0123456789", k=9)) if bad else "news/today"
        rows.append((f"http://{name}.{'biz' if bad and i % 2 else 'net'}/{tail}", float(bad)))
    frame = spark.createDataFrame(rows, "url string, label double")
    model = train(frame.limit(1000), rounds=5)
    test = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[1000:])], "page_id int, url string")
    verdicts = {r.page_id: r.verdict for r in judge(test, [], model).collect()}
    right = sum((verdicts[i] == "block") == bool(bad) for i, (_, bad) in enumerate(rows[1000:]))
    assert right >= 0.97 * len(verdicts)


def test_verdicts_for_hosts_that_were_not_labelled(spark):
    """Accuracy on labelled hosts that the trees have not seen, and on those of one suffix."""
    if not os.path.isdir(TABLES):
        pytest.skip("no table")
    urls = spark.read.parquet(f"{TABLES}/pages.parquet").select("page_id", "url")
    rules = parse_rules(URL_RULES)
    labelled = labelled_by_rules(urls, rules).withColumn("host", host_and_path(F.col("url"))[0])
    out = F.pmod(F.xxhash64("host"), F.lit(4)) == 0
    model = train(labelled.where(~out))
    test = labelled.where(out).withColumn("page_id", F.monotonically_increasing_id()).persist()
    found = judge(test, [], model).join(test.select("page_id", "label"), "page_id")
    right = found.agg(F.avg(((F.col("verdict") == "block") == (F.col("label") == 1)).cast("int"))).first()[0]
    most = max(test.agg(F.avg("label")).first()[0], 1 - test.agg(F.avg("label")).first()[0])
    assert test.count() > 50 and right >= 0.8 and right >= most


def test_own_labels_are_not_among_a_urls_statistics(spark):
    # Each host has one url, so nothing but its own label could tell its verdict.
    rng = random.Random(6)
    rows = [(f"http://{''.join(rng.choices('abcdefgh', k=9))}.org/x", float(i % 2)) for i in range(600)]
    model = train(spark.createDataFrame(rows, "url string, label double"), rounds=5)
    test = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id int, url string")
    scores = [r.block_score for r in judge(test, [], model).collect()]
    assert sum(0.2 < s < 0.8 for s in scores) > 0.5 * len(scores)


def test_entropy_and_counts(spark):
    frame = spark.createDataFrame([("http://a-b.c.d/e//f/?x=1&y=2#z", "a-b.c.d", "/e//f/")], "url string, host string, path string")
    r = lexical(frame).first()
    assert (r.depth, r.parameters, r.labels, r.hyphens, r.fragment, r.secure) == (2, 2, 3, 1, 1, 0)
    assert (r.suffix, r.domain) == ("d", "c.d") and 3 < r.entropy < 5


def test_no_labels(spark):
    frame = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    rules = parse_rules(URL_RULES)
    model = train(labelled_by_rules(frame, rules))
    assert judge(frame, rules, model).first().verdict == "allow"
    assert judge(frame.limit(0), rules, model).count() == 0


def test_all_labelled_urls_are_learned_from(spark):
    # More urls than a bound of 20,000 would leave; each suffix's rows are counted whole.
    urls = spark.range(30_000).selectExpr(
        "concat('http://h', id, if(id % 3 = 0, '.biz/', '.net/'), id) AS url", "CAST(id % 3 = 0 AS DOUBLE) AS label"
    )
    model = train(urls.unionAll(urls), rounds=1, depth=1)
    counted = {r.suffix: round(math.expm1(r.suffix_rows)) for r in model.statistics["suffix"].collect()}
    assert counted == {"biz": 10_000, "net": 20_000} and model.rate == pytest.approx(1 / 3)
