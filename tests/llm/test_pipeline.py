"""The corpus pipeline against plain code on planted documents."""

import random

import public_tokenizers

import corpus_pipeline
from bidweave.llm.sentencepiece_codec import encode_documents
from bidweave.llm.simhash import fingerprint

SHARED = "All rights reserved under the terms of the common licence"
ITEM = "how many red apples does the old farmer carry from the barn to the market when every basket is full"


def planted():
    """(documents, ids of toxic ones, ids of those with the benchmark item)."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeghkmnoprtuvz", k=rng.randint(4, 8))) for _ in range(800)]
    texts = {i: " ".join(rng.choices(words, k=60)) for i in range(1, 121)}
    toxic, leaked = set(range(1, 41)), {60, 61}
    for i in toxic:
        texts[i] = texts[i][:100] + " you scumbag " + texts[i][100:]
    for i in range(50, 57):
        texts[i] += "\n " + SHARED.upper() + "\t\nend " + words[i]
    for i in leaked:
        texts[i] += " " + ITEM
    for i in range(70, 80):
        texts[100 + i] = texts[i]
    texts |= {300: None, 301: ""}
    return texts, toxic, leaked


def plain(texts, toxic, leaked):
    kept = {i: t for i, t in texts.items() if i not in toxic}
    holders = {}
    for i, text in kept.items():
        for line in (text or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").lower()
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    for i, text in kept.items():
        lines = (text or "").split("\n")
        left = [x for x in lines if keeper.get(x.strip(" \t\n\x0b\x0c\r").lower(), i) == i]
        kept[i] = text if len(left) == len(lines) else "\n".join(left)
    first, fps = [], {}
    for i in sorted(kept):
        fp = fingerprint(kept[i], 3)
        if not any((fp ^ other).bit_count() <= 3 for other in fps.values()):
            first.append(i)
        fps[i] = fp
    return {i: kept[i] for i in first if i not in leaked}


def test_pipeline_equals_plain_code(spark, tmp_path):
    texts, toxic, leaked = planted()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in texts if i < 300]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    want = plain(texts, toxic, leaked)
    assert 60 < len(want) < 80
    assert found.keys() == want.keys()
    assert all(r.round_trip for r in found.values())
    texts = spark.createDataFrame(list(want.items()), "doc_id bigint, text string")
    coded = encode_documents(texts, public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.ids for r in coded.collect()} == {i: r.ids for i, r in found.items()}
