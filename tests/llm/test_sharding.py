"""Shards against a search over all groups."""

import random
import zlib
from collections import defaultdict

import pytest

from bidweave.llm import sharding
from bidweave.llm.sharding import minimax_cuts, shard_documents

SCHEMA = "doc_id bigint, text string, shard int, size int"


def best_capacity(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        need, room = 1, middle
        for s in sizes:
            if s > room:
                need, room = need + 1, middle
            room -= s
        low, high = (low, middle) if need <= n else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed,n,hot", [(0, 24, 0), (1, 5, 400_000), (2, 24, 90_000), (3, 3, 0)])
def test_cuts_reach_the_smallest_capacity(spark, monkeypatch, seed, n, hot):
    monkeypatch.setattr(sharding, "FIRST_BITS", 4)
    monkeypatch.setattr(sharding, "MORE_BITS", 3)
    rng = random.Random(seed)
    keys = sorted({rng.randint(-(2**63), 2**63 - 1) for _ in range(700)} | {5, 6, 7})
    sizes = {k: rng.randint(8, 900) for k in keys}
    sizes[keys[333]] += hot
    rows = [(k, 1) for k in keys] + [(k, s - 1) for k, s in sizes.items()]
    starts, homes = minimax_cuts(spark.createDataFrame(rows, "key bigint, size bigint"), n)
    light = [k for k in keys if k not in homes]
    assert list(homes) == ([keys[333]] if hot else [])
    shards = {i: 0 for i in range(n)} | {shard: sizes[k] for k, shard in homes.items()}
    for k in light:
        shards[[shard for start, shard in starts if k >= start][-1]] += sizes[k]
    if not hot or hot > sum(sizes[k] for k in light):
        assert max(shards[i] for i in shards if i not in homes.values()) == best_capacity(
            [sizes[k] for k in light], n - len(homes)
        )
    others = [s for i, s in shards.items() if i not in homes.values()]
    assert max(others) - min(others) <= 900 and max(shards.values()) <= max(hot + 900, max(others))


@pytest.mark.parametrize("hot", [[0.33], [0.9], [0.3, 0.3], [0.04] * 5, [0.2, 0.05, 0.05]])
def test_beside_heavy_groups_the_others_are_near_equal(spark, hot):
    rng = random.Random(len(hot))
    sizes = [rng.randint(8, 400) for _ in range(3000)]
    total = sum(sizes) / (1 - sum(hot))
    sizes += [int(total * h) for h in hot]
    texts = [f"{i:08d}" + "x" * (s - 16) for i, s in enumerate(sizes)]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    shards = defaultdict(int)
    heaviest = defaultdict(int)
    for r in shard_documents(docs, 24).collect():
        shards[r.shard] += r.size
        heaviest[r.shard] = max(heaviest[r.shard], r.size)
    assert set(shards) == set(range(24))
    share = sum(shards.values()) / 24
    others = [s for n, s in shards.items() if heaviest[n] <= share]
    # The groups that no even share can hold are alone; the others are one small group apart.
    assert len(others) == 24 - sum(h > 1 / 24 for h in hot) and max(others) - min(others) <= 400
    assert all(s == heaviest[n] for n, s in shards.items() if heaviest[n] > share)


def test_few_large_groups_use_all_shards(spark):
    rows = [(i, str(i) * 500, 0, 0) for i in range(10, 50)]
    found = shard_documents(spark.createDataFrame(rows, SCHEMA), 24).collect()
    counts = defaultdict(int)
    for r in found:
        counts[r.shard] += 1
    assert set(counts) == set(range(24)) and max(counts.values()) == 2


def test_rows_slots_and_groups(spark):
    rng = random.Random(4)
    texts = [None, "", "é" * 9000, *(["same"] * 80), *(f"t{rng.randint(0, 60)}" for _ in range(200))]
    rows = [(i, t, 7, 7) for i, t in enumerate(texts)] + [(1, "", 7, 7), (None, "x", 7, 7)]
    found = shard_documents(spark.createDataFrame(rows, SCHEMA), 6, slot_rows=5).collect()
    assert len(found) == len(rows)
    text_of = {r[0]: r[1] for r in rows}
    slots, homes = defaultdict(list), defaultdict(set)
    for r in found:
        raw = (text_of[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
        slots[r.shard].append(r.slot)
        homes[text_of[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(6))
    assert all(len(h) == 1 for h in homes.values())


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA), 24).count() == 0
