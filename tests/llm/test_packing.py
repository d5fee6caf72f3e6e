"""Packing: the tournament tree against a plain first fit, whole pieces, few gaps."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bidweave.llm.packing import first_fit, pack, pack_documents, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, key int, start int, length string, ids int, group int"


def plain_first_fit(lengths, capacity):
    room, found = [], []
    for length in lengths:
        at = next((i for i, r in enumerate(room) if r >= length), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= length
        found.append(at)
    return found


def test_tree_finds_the_first_fit():
    rng = random.Random(2)
    for n in [0, 1, 2, 3, 17, 200]:
        for capacity in (10, 64):
            lengths = sorted((rng.randint(1, capacity) for _ in range(n)), reverse=True)
            assert first_fit(lengths, capacity) == plain_first_fit(lengths, capacity)
            rng.shuffle(lengths)
            assert first_fit(lengths, capacity) == plain_first_fit(lengths, capacity)


@pytest.mark.parametrize("lengths", [[64], [40] * 30, [64] * 5 + [33] * 9 + [1] * 7, list(range(64, 0, -1)), [1]])
@pytest.mark.parametrize("least", [1, 8, 64])
def test_every_item_is_whole_and_gaps_are_filled(lengths, least):
    found = pack(np.array(lengths), 64, least)
    covered, used = {}, {}
    for item, start, length, sequence, offset in sorted(found, key=lambda f: (f[3], f[4])):
        assert offset == used.get(sequence, 0) and length > 0
        used[sequence] = offset + length
        covered.setdefault(item, []).append((start, length))
    for item, length in enumerate(lengths):
        at = 0
        for start, n in sorted(covered[item]):
            assert start == at
            at += n
        assert at == length
    assert sorted(used) == list(range(len(used))) and max(used.values()) <= 64
    # At most one sequence keeps a gap that is worth a cut.
    assert sum(64 - u >= least for u in used.values()) <= 1


def documents():
    rng = random.Random(4)
    words = ["the", "of", "é", "日本", "12", "\n", "x" * 30, "don't"]
    rows = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.8) * 5) % 6000))) for i in range(300)]
    rows += [(500, None), (501, ""), (None, "nobody"), (None, None), (7, "again"), rows[11], (600, "word " * 60_000)]
    rows += [(700, "same text of one document")] * 150
    return rows


def test_documents(spark):
    rows = documents()
    docs = spark.createDataFrame([(*r, 1, 2, "x", 3, 4) for r in rows], SCHEMA).repartition(5)
    packed = pack_documents(docs, PATH, 1, group_pieces=60).persist()
    found = packed.collect()
    known = Tokenizer.from_file(PATH)
    want = {}
    for doc_id, text in rows:
        ids = known.encode(text or "", add_special_tokens=False).ids + [1]
        want.setdefault((doc_id, len(ids)), []).append(ids)
    # Pieces of one document: rows that repeat make as many documents as there are.
    pieces = {}
    for r in found:
        assert len(r.ids) == 4 * r.length and r.length <= 2048
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert set(pieces) == set(want)
    for key, texts in want.items():
        copies = len(texts)
        for ids in texts:
            assert all(ids[s : s + len(p)] == p for s, p in pieces[key]) or copies > 1
        assert sum(len(p) for _, p in pieces[key]) == copies * key[1]
        if copies == 1:
            whole = [i for _, p in sorted(pieces[key]) for i in p]
            assert whole == texts[0]
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids))
    for held in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len({s >> 32 for s in by_sequence}) > 3
    total = sum(r.length for r in found)
    assert len(by_sequence) <= -(-total // 2048) + len({s >> 32 for s in by_sequence}) + total // 2048 // 50
    joined = {r.sequence_id: r for r in sequences(packed).collect()}
    assert set(joined) == set(by_sequence)
    for sequence, held in by_sequence.items():
        ids = np.frombuffer(b"".join(raw for _, _, raw in sorted(held)), "<u4").tolist()
        assert joined[sequence].ids == ids and joined[sequence].n_tokens == len(ids)
    crc = {r.c for r in packed.select(F.crc32("ids").alias("c")).collect()}
    assert crc == {zlib.crc32(r.ids) for r in found}
    packed.unpersist()


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH, 1).count() == 0
