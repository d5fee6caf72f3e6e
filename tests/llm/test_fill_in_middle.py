"""Fill-in-the-middle against plain string code, and exact round trips."""

import hashlib
import random
import re

import pytest

from bidweave.llm.fill_in_middle import MARKS, SENTINELS, TEXT, Piece, cut, fill_in_middle, restored, stream

SCHEMA = "doc_id bigint, text string, n int, form string, pieces string"


def plain(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or doc_id is None or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def given():
    rng = random.Random(8)
    parts = ["one", "\n", "\n\n", "é", "日本\n", " ", "<", "<P", "S>", ">", "<P>", "\U0001f600", "\r\n", "\0", " "]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(-50, 400)]
    rows += [(1000, None), (1001, ""), (1002, "\n"), (1003, "no line end"), (None, "a\nb\n"), (None, None)]
    rows += [(2000, "line of words\n" * 100_000), (2001, "x" * 2_000_000), (2002, "<S" * 1000 + "\n" * 1000), rows[3]]
    rows += [(3000 + i, "a\nb\nc\nd") for i in range(60)]
    return rows


@pytest.mark.parametrize("options", [{}, {"seed": 3, "rate": 60, "spm": 20}])
def test_matches_plain_code(spark, options):
    rows = given()
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(4)
    found = fill_in_middle(docs, **options).collect()
    want = sorted([(i, *plain(i, t, **options), t or "") for i, t in rows], key=str)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found]
    assert sorted(got, key=str) == sorted([w[:6] for w in want], key=str)
    text_of = {(w[0], w[5]): w[6] for w in want}
    for r in found:
        text = text_of[r.doc_id, r.output]
        assert r.output_sha256 == sha(r.output) and r.restored_sha256 == sha(text)
        pieces = [Piece(*p) for p in r.pieces]
        assert b"".join(stream(pieces, text.encode())).decode() == r.output
        assert {r.form} == {"plain"} or len([p for p in pieces if p.buffer == MARKS]) == 3
    forms = {r.form for r in found}
    assert forms == {"plain", "psm", "spm"}


def test_without_texts(spark):
    docs = spark.createDataFrame([(1, "a\nb", 0, "", ""), (2, None, 0, "", "")], SCHEMA)
    lean = fill_in_middle(docs, texts=False)
    assert "output" not in lean.columns
    full = fill_in_middle(docs).drop("output")
    assert sorted(lean.collect()) == sorted(full.collect())


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cut_splits_descriptors():
    pieces = [Piece(TEXT, 0, 4), Piece(MARKS, 3, 3), Piece(TEXT, 10, 5)]
    for places in ([0, 0], [2, 6], [4, 7], [5, 12], [12, 12]):
        parts = cut(pieces, places)
        text = bytes(range(65, 90))
        whole = b"".join(stream(pieces, text))
        edges = [0, *places, len(whole)]
        assert [b"".join(stream(p, text)) for p in parts] == [whole[a:b] for a, b in zip(edges, edges[1:])]
    assert b"".join(stream([Piece(MARKS, 0, 9)], b"")) == SENTINELS


def test_restored_finds_sentinels_beside_their_beginnings():


    first = b"<P>a<<S>b<<M>c"
    assert b"".join(stream(restored(first, "psm"), first)) == b"a<cb<"
