"""Toxicity scores: folding, matching, learning, held-out accuracy."""

import os
import random
import re
import zlib

import pytest

from bidweave.llm.toxicity import (
    Model,
    features,
    fold,
    held_out,
    train,
    weight_of,
    with_toxicity,
)
from pyspark.sql import functions as F

LEXICON = {"idiot$": 5.0, "scum$": 3.0, "iowei": 2.0}


def slow_weight(text, model):
    folded, hidden, total = fold(text), set(), 0.0
    for phrase in model.exceptions:
        for m in re.finditer(rf"(?<![^\W\d_]){fold(phrase)}(?![^\W\d_])", folded):
            hidden.update(range(m.start(), m.end()))
    for term, weight in model.lexicon.items():
        tail = r"(?![^\W\d_])" if term.endswith("$") else ""
        for m in re.finditer(rf"(?<![^\W\d_]){term.rstrip('$')}{tail}", folded):
            total += weight * (m.start() not in hidden)
    return total


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "You IDIOT, you 1d10t; idiots and idiotic",
        "іdiot ѕcum scumbag",
        "ｉｄｉｏｔ pond scum is scum",
        "loweichen Loweix xlowei",
        "word " * 5000 + "scum",
    ],
)
def test_matching(text):
    model = Model(LEXICON, exceptions=("pond scum",))
    assert weight_of(fold(text), model.key()) == slow_weight(text, model)


def test_length_counts():
    key = Model(LEXICON).key()
    assert features("idiot", key)[1] > features("idiot " + "word " * 500, key)[1] > 0


DOCS = "doc_id bigint, text string, score string, toxic string, source string"


def corpus(n):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("alo", "emu", "ira", "opa")]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randint(5, 80))
        if bad := i % 4 == 0:
            text[rng.randrange(len(text))] = rng.choice(["Stvpid", "m0ron", "loser!", "zzkaa", "zzkab"])
        rows.append((i, " ".join(text), "s", "t", "src"))
        labels.append((i, int(bad), int(bad)))
    return rows, labels


def test_learns_from_labels_that_are_not_held_out(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame(rows + [(None, "moron", "s", "t", "x"), (700, None, "", "", ""), rows[0]], DOCS)
    known = spark.createDataFrame(labels + [labels[4], (None, 1, 1), (9999, 1, None)], "doc_id bigint, quality int, toxic int")
    model = train(docs, known)
    assert {"moron$", "ioser$"} <= set(model.lexicon)
    assert any(t.startswith("zzka") for t in model.lexicon)
    found = with_toxicity(docs, model).collect()
    assert len(found) == len(rows) + 3
    truth = {i: bad for i, _, bad in labels}
    wrong = [r.doc_id for r in found if r.doc_id in truth and (r.score >= 0.5) != truth[r.doc_id]]
    assert len(wrong) <= 6
    assert {r.doc_id: r.score for r in found}[700] < 0.5
    # Labels of held-out rows change nothing.
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = train(docs, spark.createDataFrame(turned, "doc_id bigint, quality int, toxic int"))
    assert again == train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_held_out(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)
    none = spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(held_out(F.col("id")).alias("out"))
    assert none.first().out is False


def test_rare_markers_are_learned_on_a_large_sample(spark):
    """150 marker words, each in about 21 of 3,200 toxic documents and in no clean one."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(3000)]
    markers = ["".join(rng.choices("qrstuvwxyz", k=8)) for _ in range(150)]
    rows, labels = [], []
    for i in range(12_000):
        text = rng.choices(words, k=12)
        if bad := i % 3 == 0:
            text[rng.randrange(12)] = markers[rng.randrange(150)]
        rows.append((i, " ".join(text), "s", "t", "src"))
        labels.append((i, 0, int(bad)))
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    model = train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    found = with_toxicity(docs, model).select("doc_id", (F.col("score") >= 0.5).alias("bad")).collect()
    caught = sum(r.bad for r in found if r.doc_id % 3 == 0)
    assert caught >= 0.99 * 4000 and sum(r.bad for r in found if r.doc_id % 3) <= 0.01 * 8000


def test_harmless_phrases_are_learned_from_clean_documents(spark):
    rng = random.Random(12)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("alo", "emu", "ira", "opa")]
    rows, labels = [], []
    for i in range(3000):
        text = " ".join(rng.choices(words, k=20))
        if i % 3 == 0:
            text += " zzgrub" + rng.choice(words)[:0]
        elif i % 200 == 1:
            text += " garden zzgrub"
        rows.append((i, text, "s", "t", "src"))
        labels.append((i, 0, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    model = train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert any("garden zzgrub" == p for p in map(fold, model.exceptions))
    probe = spark.createDataFrame([(1, "balo zzgrub", "", "", ""), (2, "balo garden zzgrub", "", "", "")], DOCS)
    bad = {r.doc_id: r.score >= 0.5 for r in with_toxicity(probe, model).collect()}
    assert bad == {1: True, 2: False}


def test_the_sample_is_joined_without_a_shuffle_of_texts(spark, monkeypatch):
    from bidweave.llm import toxicity

    seen = []
    keep = toxicity.staged
    monkeypatch.setattr(toxicity, "staged", lambda df, label: seen.append(df) or keep(df, label))
    rows, labels = corpus(200)
    train(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    plan = seen[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "idiot", "", "", "")], DOCS)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = train(docs, none)
    assert model.lexicon == {}
    assert with_toxicity(docs, model).first().score < 0.5
    assert with_toxicity(docs.limit(0), model).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no table")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = train(docs, labels)
    out = docs.join(labels, "doc_id").where(held_out(F.col("doc_id")))
    r = with_toxicity(out, model).agg(
        F.avg(((F.col("score") >= 0.5).cast("int") == F.col("toxic")).cast("int")).alias("right")
    )
    assert r.first().right >= 0.93
