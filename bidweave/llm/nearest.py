"""Exact nearest neighbours by a block matrix join with int8 tiles.

Vectors are packed into blocks. Every query block meets every block of
candidates once; their tile product is taken on int8 values, which gives each
inner product up to a proven bound. Pairs that the bound cannot rule out are
computed again in double precision, and heaps merge the blocks' results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "dim int, block int, n int, ids binary, vectors binary, codes binary, scales binary, errors binary"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the scale of each row, and the length of what rounding took away."""
    top = np.abs(vectors).max(axis=1)
    scale = np.where(top > 0, top / 127.0, 1.0)
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(vectors - codes * scale[:, None], axis=1)
    return codes, scale, error


def tile(
    a: tuple[np.ndarray, np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of two blocks from their codes, and how far off they can be.

    With x = x' + e and y = y' + f, the product differs from that of x' and y'
    by at most |x'| |f| + |e| |y'| + |e| |f|. Sums of int8 products stay below
    2^24 for up to 1,040 dimensions, so 32-bit arithmetic takes them exactly;
    wider vectors are taken in 64 bits.
    """
    (p, s, e), (q, t, f) = a, b
    kind = np.float32 if p.shape[1] <= 1040 else np.float64
    product = (p.astype(kind) @ q.astype(kind).T).astype(np.float64)
    product *= s[:, None]
    product *= t[None, :]
    long_p = np.linalg.norm(p.astype(np.float64), axis=1) * s
    long_q = np.linalg.norm(q.astype(np.float64), axis=1) * t
    bound = long_p[:, None] * f[None, :] + e[:, None] * (long_q + f)[None, :]
    # Rounding of the bound itself and of the double-precision score.
    bound += 1e-12 * (long_p + e)[:, None] * (long_q + f)[None, :] * max(1, p.shape[1] // 64)
    return product, bound


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components and not all zero."""
    bad = F.exists(
        vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf"))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def packed(vectors: DataFrame, blocks: int, copies: int) -> DataFrame:
    """``blocks`` blocks of (vec_id, embedding) rows for each dimension.

    Rows that repeat a vec_id and its vector count once. Of equal vectors in a
    block the ``copies`` with the smallest vec_id are kept: no more of them can
    be among the nearest of any query.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.size("embedding").alias("dim"), "vec_id", F.col("embedding").cast("array<double>")
    )
    keyed = rows.select(
        "dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "embedding"
    )

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["vec_id"].to_numpy(np.int64)
        matrix = np.vstack(frame["embedding"].to_numpy()).astype(np.float64) + 0.0
        order = np.argsort(ids, kind="stable")
        ids, matrix = ids[order], matrix[order]
        seen: dict[bytes, list[int]] = {}
        keep = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            held = seen.setdefault(matrix[i].tobytes(), [])
            if len(held) < copies and (not held or held[-1] != ids[i]):
                held.append(ids[i])
                keep[i] = True
        ids, matrix = ids[keep], matrix[keep]
        codes, scales, errors = quantised(matrix)
        parts = [x.tobytes() for x in (ids, matrix, codes, scales, errors)]
        row = [int(frame["dim"].iloc[0]), int(frame["block"].iloc[0]), len(ids), *parts]
        return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])

    return keyed.groupBy("dim", "block").applyInPandas(pack, BLOCK)


def unpacked(row, side: str) -> tuple:
    n, dim = getattr(row, f"{side}_n"), row.dim
    read = lambda name, kind: np.frombuffer(getattr(row, f"{side}_{name}"), kind)
    return (
        read("ids", np.int64),
        read("vectors", np.float64).reshape(n, dim),
        (read("codes", np.int8).reshape(n, dim), read("scales", np.float64), read("errors", np.float64)),
    )


def tile_nearest(row, k: int) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """The k nearest candidates of one block, for each query of another."""
    ids, x, coded = unpacked(row, "q")
    other, y, candidates = unpacked(row, "c")
    product, bound = tile(coded, candidates)
    low, high = product - bound, product + bound
    own = ids[:, None] == other[None, :]
    low[own] = high[own] = -np.inf
    if len(other) > k:
        # At least k candidates reach this much, so none below it can be among the k nearest.
        least = np.partition(low, len(other) - k, axis=1)[:, len(other) - k]
    else:
        least = np.full(len(ids), -np.inf)
    near = (high >= least[:, None]) & ~own
    at, to = np.nonzero(near)
    score = exact(x[at], y[to])
    starts = np.searchsorted(at, np.arange(len(ids) + 1))
    for i in range(len(ids)):
        part = slice(starts[i], starts[i + 1])
        found = zip(score[part].tolist(), (-other[to[part]]).tolist(), strict=True)
        yield int(ids[i]), heapq.nlargest(k, found)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    block_rows: int = 4096,
    query_rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors of largest inner product.

    Both tables have (vec_id, embedding). A query is not its own candidate; of
    equal scores the smaller vec_id is nearer. Null, zero and non-finite
    vectors and rows without vec_id take no part; vectors of different
    dimensions are not compared. Rows that repeat an id with the same vector
    count once. The result is exact, recall is 1. Empty tables give no rows.
    Other columns are ignored.
    """
    named = {c.split()[0]: c.split()[0] for c in BLOCK.split(", ")[2:]}
    blocks = max(1, -(-vectors.count() // block_rows))
    left = packed(queries, max(1, -(-queries.count() // query_rows)), 1 << 30).withColumnsRenamed(
        {c: f"q_{c}" for c in named} | {"block": "q_block"}
    )
    right = packed(vectors, blocks, k + 1).withColumnsRenamed({c: f"c_{c}" for c in named})
    # Each query block goes to every candidate block of its dimension.
    places = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    aimed = left.select("*", places)
    pairs = aimed.join(right, ["dim", "block"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                out = [
                    (query, -vec, score)
                    for query, found in tile_nearest(row, k)
                    for score, vec in found
                ]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    merged = pairs.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    return merged.selectExpr(
        "query_id",
        "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank",
        "vec_id",
        "score",
    ).where(F.col("rank") <= k)
