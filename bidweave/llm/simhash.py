"""SimHash near-duplicates, candidates pruned by pigeonring chains.

A fingerprint has four segments of 16 bits in a ring. If two fingerprints
differ in at most three bits, some segment starts a chain whose running
differences stay within the proportional budgets floor(3 l / 4): none in the
first segment, at most one in the first two, two in the first three, three in
all. The first two steps make the join key: every fingerprint is at home under
(segment, next segment) and visits the keys whose next segment lacks one of its
bits. The last two steps prune what met under a key, before the full check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.llm.common import staged, tasks

SEGMENTS, WIDTH = 4, 16
SEED = 42
_MASK = np.uint64(0xFFFF)
_CHUNK = 1 << 18


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a text's word shingles; 0 without words.

    >>> fingerprint(None, 3)
    0
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    size = min(words, len(found))
    whole = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(found) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    hashed = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(starts)
    for at in range(0, total, _CHUNK):
        part = np.fromiter(
            (hashed(whole[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK])),
            np.dtype("<u8"),
            min(_CHUNK, total - at),
        )
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(value.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp long) of every row; the bits of fp are those of the unsigned value."""
    dtype = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter(
                (fingerprint(t, words) for t in batch.column(1).to_pylist()),
                np.uint64,
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            )

    schema = f"doc_id {dtype.simpleString()}, fp bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def ring(fp: np.ndarray, start: int) -> np.ndarray:
    """The fingerprint turned so that segment ``start`` comes first (lowest bits)."""
    shift = np.uint64(WIDTH * start)
    if not start:
        return fp
    return (fp >> shift) | (fp << np.uint64(64 - WIDTH * start))


def chained(home: np.ndarray, other: np.ndarray, bits: int) -> np.ndarray:
    """Pairs whose chain from the first segment keeps its budgets and whose distance is small."""
    diff = home ^ other
    total = np.zeros(diff.shape, np.uint8)
    fits = np.ones(diff.shape, bool)
    for step in range(SEGMENTS):
        total = total + np.bitwise_count((diff >> np.uint64(WIDTH * step)) & _MASK)
        fits &= total <= bits * (step + 1) // SEGMENTS
    return fits


def components(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Component number and search-tree parent of each fingerprint of one block.

    A found fingerprint is compared with those not found yet only, so a tight
    group costs about one pass.
    """
    number, parent = np.full(len(fps), -1), np.arange(len(fps))
    left = np.arange(len(fps))
    count = 0
    while len(left):
        queue = [left[0]]
        number[left[0]] = count
        left = left[1:]
        while queue and len(left):
            at = queue.pop()
            near = chained(fps[at], fps[left], bits)
            found = left[near]
            number[found], parent[found] = count, at
            queue.extend(found.tolist())
            left = left[~near]
        count += 1
    return number, parent


def block_links(homes: np.ndarray, guests: np.ndarray, bits: int) -> Iterator[tuple]:
    """Links that join the guests to the homes' components, few for each guest.

    A guest gets one link to every component of the homes that it touches; a
    component's own members are linked along their search tree.
    """
    number, parent = components(homes, bits)
    inner = parent != np.arange(len(homes))
    yield homes[inner], homes[parent[inner]]
    for c in range(number.max() + 1):
        left = guests
        for home in homes[number == c]:
            if not len(left):
                break
            near = chained(home, left, bits)
            hits = left[near & (left != home)]
            yield hits, np.full(len(hits), home)
            left = left[~near]


def links(fps: DataFrame, bits: int = 3, block_rows: int = 1024) -> DataFrame:
    """(a, b) links between distinct fingerprints at ``bits`` or fewer differing bits.

    Not every pair is listed, but the links connect what all pairs would
    connect. Keys with more than ``block_rows`` fingerprints at home are split
    into blocks, each with all visitors, so no task holds a key whole.
    """
    if bits >= SEGMENTS:
        raise ValueError("a chain of four segments starts with an equal one for up to 3 bits")
    spark = fps.sparkSession
    distinct = fps.select("fp").distinct()
    turned = F.explode(F.array(*[F.lit(i) for i in range(SEGMENTS)])).alias("turn")
    rung = distinct.select("fp", turned).withColumn(
        "ring",
        F.expr(
            "CASE WHEN turn = 0 THEN fp ELSE shiftrightunsigned(fp, 16 * turn)"
            " | shiftleft(fp, 64 - 16 * turn) END"
        ),
    )
    key = F.expr("(ring & 4294967295L) * 4 + turn").alias("key")
    homes = staged(rung.select(key, "ring", "turn"), "simhash-homes")
    near = F.explode(F.array(*[F.lit(1 << b) for b in range(WIDTH)])).alias("bit")
    # Of two neighbours one bit apart, the one that has the bit visits the other.
    visits = (
        homes.select("ring", "turn", near)
        .withColumn("bit", F.expr("CAST(bit AS BIGINT) << 16"))
        .where("ring & bit != 0")
        .selectExpr("((ring ^ bit) & 4294967295L) * 4 + turn AS key", "ring")
    )
    held = homes.groupBy("key").agg(F.count("*").alias("n"))
    met = visits.join(held, "key").select("key", "ring", F.lit(False).alias("home"), "n")
    own = homes.join(held, "key").select("key", "ring", F.lit(True).alias("home"), "n")
    guests = met.unionAll(own.where(F.col("n") > block_rows).withColumn("home", F.lit(False)))
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    spread = guests.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    settled = own.withColumn("block", F.pmod(F.xxhash64("ring"), blocks).cast("int"))
    rows = spread.unionByName(settled).select("key", "block", "home", "ring")
    dealt = rows.repartition(tasks(spark), "key", "block").sortWithinPartitions(
        "key", "block", F.desc("home")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, held_homes = None, []
        for frame in batches:
            keys, block = frame["key"].to_numpy(), frame["block"].to_numpy()
            ringed = frame["ring"].to_numpy().view(np.uint64)
            home = frame["home"].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (block[1:] != block[:-1])) + 1
            bounds = np.concatenate(([0], cuts, [len(keys)]))
            # A group of one row matters only if it goes on in another batch.
            several = np.flatnonzero(np.diff(bounds) > 1)
            found = []
            for g in np.unique(np.concatenate(([0], several, [len(bounds) - 2]))):
                low, high = bounds[g], bounds[g + 1]
                if (keys[low], block[low]) != current:
                    current, held_homes = (keys[low], block[low]), []
                here = home[low:high]
                held_homes.append(ringed[low:high][here])
                homes, guests = np.concatenate(held_homes), ringed[low:high][~here]
                if len(homes) and len(homes) + len(guests) > 1:
                    back = (SEGMENTS - int(keys[low] & 3)) % SEGMENTS
                    pairs = block_links(homes, guests, bits)
                    found += [(ring(a, back), ring(b, back)) for a, b in pairs]
            if found:
                a, b = (np.concatenate(side) for side in zip(*found, strict=True))
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.mapInPandas(run, "a bigint, b bigint")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) edges; component is the smallest node.

    Alternates the large-star and small-star steps: every node's neighbours are
    linked to its smallest one. Each step is written to the shared folder, and
    the number of steps grows with the logarithm of the longest path.
    """
    now, seen = staged(_both(edges).where("a > b").distinct(), "edges"), None
    while (mark := _mark(now)) != seen:
        seen = mark
        both = _both(now)
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a AS u", "least(a, m) AS m")
        large = both.where("b > a").join(least, F.col("a") == F.col("u"))
        large = staged(large.selectExpr("b AS a", "m AS b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, F.col("a") == F.col("u")).selectExpr("b AS a", "m AS b")
        small = small.where("a != b").unionAll(least.selectExpr("u AS a", "m AS b"))
        now = staged(small.distinct(), "small-star")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.selectExpr("a AS node", "b AS component").unionAll(roots)


def _mark(edges: DataFrame) -> tuple:
    """Tells edge sets apart."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.selectExpr("b AS a", "a AS b"))


def near_duplicates(
    docs: DataFrame, words: int = 3, bits: int = 3, block_rows: int = 1024
) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    Texts are lower-cased (A-Z) and split at ASCII blanks; a text shorter than
    ``words`` words is one shingle, one without words has fingerprint 0 and is
    linked like any other. component_id is the smallest doc_id reachable over
    links of at most ``bits`` bits. Repeated rows stay, each with its class. A
    row without doc_id stays and takes no part in naming a class unless all its
    members are such rows; then component_id is null. Other columns are ignored.
    An empty table gives no rows.
    """
    printed = staged(fingerprints(docs, words), "simhash")
    classes = connected(links(printed, bits, block_rows))
    named = (
        printed.groupBy("fp")
        .agg(F.min("doc_id").alias("least"))
        .join(classes.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    named = staged(named, "simhash-classes")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(least, "component").select("fp", "component_id")
    return printed.join(names, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
