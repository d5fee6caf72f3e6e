"""SimHash near-duplicates against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from bidweave.llm.simhash import block_links, components, fingerprint, links, near_duplicates

SCHEMA = "doc_id bigint, text string, fp string, component_id int, n int"


def slow_fingerprint(text, words=3):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        found = found.replace(blank, " ")
    found = [w for w in found.split(" ") if w]
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(fps, bits=3):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= bits:
                parent[root(b)] = root(a)
    return {f: root(f) for f in fps}


def clustered(n, seed):
    rng = random.Random(seed)
    found = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(6 * n):
        near = rng.choice(found)
        for _ in range(rng.randint(1, 4)):
            near ^= 1 << rng.randrange(64)
        found.append(near)
    return sorted(set(found))


@pytest.mark.parametrize(
    "text", [None, "", " \t", "one", "One two", "a b c", "Ä a b c A b c " * 40, "x\x1cy z w"]
)
def test_fingerprint(text):
    assert fingerprint(text, 3) == slow_fingerprint(text)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


@pytest.mark.parametrize("block_rows", [3, 1024])
def test_links_connect_what_all_pairs_connect(spark, block_rows):
    fps = clustered(60, 5)
    # One tight group that shares its first segments, larger than a block.
    fps = sorted({*fps, *(0xABCD << 48 | 1 << i | 1 << j for i in range(12) for j in range(12))})
    rows = spark.createDataFrame([(signed(f),) for f in fps] * 2, "fp bigint")
    found = {(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in links(rows, 3, block_rows).collect()}
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in found)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in found:
        parent[root(a)] = root(b)
    want = slow_classes(fps)
    assert len({(root(f), want[f]) for f in fps}) == len({root(f) for f in fps})
    assert len({root(f) for f in fps}) == len(set(want.values()))


def test_links_stay_few_in_a_tight_group():
    group = np.array(sorted({1 << i | 1 << j for i in range(32, 64) for j in range(32, 64)}), np.uint64)
    pairs = sum(len(a) for a, _ in block_links(group, group, 3))
    assert components(group, 3)[0].max() == 0
    assert pairs <= 3 * len(group)


def test_classes_of_documents(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(20)]
    texts = [None, "", "  ", "one", "ONE", *base, *base]
    for t in base:
        w = t.split()
        w[7] = "changed"
        texts.append(" ".join(w))
    rows = [(i, t, "x", 9, 1) for i, t in enumerate(texts)] + [(3, "one", "x", 9, 1), (None, "one", "x", 9, 1)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    fps = sorted({slow_fingerprint(r[1]) for r in rows})
    cls = slow_classes(fps)
    least = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            c = cls[slow_fingerprint(text)]
            least[c] = min(doc_id, least.get(c, doc_id))
    text_of = {r[0]: r[1] for r in rows}
    for r in found:
        f = slow_fingerprint(text_of[r.doc_id])
        assert (r.fp & (1 << 64) - 1, r.component_id) == (f, least[cls[f]])


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
