"""Minimax contiguous sharding of atomic groups.

Groups (rows with equal texts) are ordered by a 64-bit key. The smallest shard
capacity for which greedy packing needs at most ``n_shards`` shards is found by
binary search, and the shards are cut there: shard sizes are as near equal as
contiguous atomic groups allow. Groups of a quarter of an even share or more
would leave gaps wherever they stand in that order, so they are placed first,
the heaviest to the least loaded shard, and the capacity counts them in.

The search never holds all groups. It runs on *cells*, ranges of keys with
their total size, and opens only the cells in which a cut may lie. A cell that
is still closed bounds the answer from both sides: it packs at best like a
fluid and at worst as one block.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidweave.llm.common import staged

KEY_BITS = 64
FIRST_BITS = 14
MORE_BITS = 10


@dataclass(frozen=True)
class Cell:
    """Keys that agree above their last ``bits`` bits: first and last one found, their size."""

    bits: int
    low: int
    high: int
    size: int

    @property
    def single(self) -> bool:
        return self.low == self.high

    @property
    def number(self) -> int:
        return self.low >> self.bits


class Packing:
    """Greedy packing of ordered cells into shards that hold some load already."""

    def __init__(self, cells: list[Cell], heaviest: int, loads: list[int]):
        """``heaviest`` is the largest group in the cells: no capacity beside the least load is below it."""
        self.cells, self.heaviest, self.loads = cells, heaviest, loads
        self.ends = []
        total = 0
        for cell in cells:
            total += cell.size
            self.ends.append(total)
        self.total = total

    def cut(self, start: int, room: int, fluid: bool) -> int:
        """Largest reachable end of a shard from ``start``; ``start`` if nothing fits."""
        end = start + max(0, room)
        if end >= self.total:
            return self.total
        i = bisect_right(self.ends, end)
        closed = self.ends[i - 1] if i else 0
        if fluid and not self.cells[i].single:
            return end
        return max(closed, start)

    def cuts(self, capacity: int, fluid: bool, start: int = 0, first: int = 0) -> list[int]:
        """Ends of the shards from ``first`` on, packed from ``start``."""
        found, at = [], start
        for load in self.loads[first:]:
            at = self.cut(at, capacity - load, fluid)
            found.append(at)
        return found

    def smallest(self, fluid: bool) -> int:
        whole = self.total + sum(self.loads)
        low = max(*self.loads, self.heaviest + min(self.loads), -(-whole // len(self.loads)), 0)
        high = max(low, self.total + max(self.loads))
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, fluid)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int) -> list[int]:
        """Cuts near even shares of what is left, as far as the rest still fits the capacity.

        Greedy packing fills the first shards and leaves what is missing to the
        last ones; here each shard aims at an equal share, and falls back to
        the greedy cut if the rest needs it.
        """
        found, at = [], 0
        for n, load in enumerate(self.loads):
            share = (self.total - at + sum(self.loads[n:])) / (len(self.loads) - n)
            most, aim = self.cut(at, capacity - load, False), at + max(0, share - load)
            i = bisect_right(self.ends, aim)
            ends = [at, *(self.ends[j] for j in (i - 1, i) if 0 <= j < len(self.ends))]
            ends = sorted((e for e in ends if at <= e <= most), key=lambda e: abs(e - aim))
            fits = (e for e in ends if n + 1 < len(self.loads) and self.cuts(capacity, False, e, n + 1)[-1] >= self.total)
            at = next(fits, most)
            found.append(at)
        return found

    def open_cells(self) -> list[int]:
        """Cells of several keys that a cut of the best packing may fall into."""
        least, most = self.smallest(True), self.smallest(False)
        lows = self.cuts(least, False)
        highs = self.cuts(most, True)
        found: set[int] = set()
        for low, high in zip(lows, highs, strict=True):
            if low >= self.total:
                break
            first = bisect_right(self.ends, low)
            last = min(bisect_left(self.ends, high), len(self.cells) - 1)
            found.update(i for i in range(first, last + 1) if not self.cells[i].single)
        return sorted(found)


def _cells(groups: DataFrame, bits: int) -> list[Cell]:
    rows = (
        groups.groupBy(F.shiftright("key", bits).alias("cell"))
        .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
        .collect()
    )
    return [Cell(bits, r.low, r.high, int(r.size)) for r in rows]


def _parts(groups: DataFrame, opened: list[Cell]) -> list[Cell]:
    """The opened cells in smaller cells."""
    found = []
    for bits in {c.bits for c in opened}:
        # One number for each opened cell: bounded like the cells themselves.
        numbers = groups.sparkSession.createDataFrame(
            [(c.number,) for c in opened if c.bits == bits], "cell bigint"
        )
        inside = groups.join(
            F.broadcast(numbers), F.shiftright("key", bits) == F.col("cell"), "left_semi"
        )
        found += _cells(inside, max(0, bits - MORE_BITS))
    return found


#: Groups of at least this part of an even share are placed on their own.
LARGE_PART = 4


def large_groups(groups: DataFrame, n_shards: int) -> tuple[dict[int, int], list[int], int]:
    """Shard of each large group by its key, load of each shard, and the heaviest of the other groups.

    The heaviest goes first, each to the shard with the least load. There are
    no more than ``LARGE_PART`` for each shard.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    largest = groups.orderBy(F.desc("size"), "key").limit(LARGE_PART * n_shards + 1).collect()
    homes, loads = {}, [0] * n_shards
    for row in largest:
        if row["size"] * n_shards * LARGE_PART < total:
            break
        shard = min(range(n_shards), key=loads.__getitem__)
        homes[row["key"]] = shard
        loads[shard] += int(row["size"])
    rest = largest[len(homes) :]
    return homes, loads, int(rest[0]["size"]) if rest else 0


def open_shards(loads: list[int], light: int) -> list[int]:
    """The shards that take part of the ordered groups: those below an even share of what they all hold."""
    found = sorted(range(len(loads)), key=loads.__getitem__)
    while len(found) > 1 and loads[found[-1]] * len(found) >= light + sum(loads[s] for s in found):
        found.pop()
    return sorted(found)


def minimax_cuts(sizes: DataFrame, n_shards: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """First key and number of the shards that share the ordered groups, and the shards of the large ones.

    ``sizes`` is a table of (key long, size long). The capacity is the smallest
    with which the groups beside the large ones fit in order into the room
    that those leave. What reaches the driver is bounded whatever the table
    holds: four rows for each shard, 2^14 cells at first, then 2^10 for each
    cell that a cut may fall into.
    """
    groups = staged(sizes.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    homes, loads, heaviest = large_groups(groups, n_shards)
    light = groups.where(~F.col("key").isin(list(homes))) if homes else groups
    if not heaviest:
        return [], homes
    opened_to = open_shards(loads, light.agg(F.sum("size")).first()[0])
    room = [loads[s] for s in opened_to]
    cells = sorted(_cells(light, KEY_BITS - FIRST_BITS), key=lambda c: c.low)
    while places := (packing := Packing(cells, heaviest, room)).open_cells():
        opened = [cells[i] for i in places]
        kept = set(cells).difference(opened)
        cells = sorted([*kept, *_parts(light, opened)], key=lambda c: c.low)
    starts, before = [], 0
    for shard, at in zip(opened_to, packing.even_cuts(packing.smallest(False)), strict=True):
        if at > before:
            starts.append((cells[bisect_right(packing.ends, before)].low, shard))
        before = at
    return starts, homes


def shard_documents(docs: DataFrame, n_shards: int, slot_rows: int = 50_000) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id, text).

    Size is the text's UTF-8 bytes plus 8. Rows with equal texts share a shard;
    a null text counts as no bytes, and all null texts are one group. Beside a
    group above an even share the other shards are near equal. Slots run
    from 0 without gaps in each shard, by a hash of doc_id: rows are numbered
    in buckets of about ``slot_rows`` rows, so no shard is ever one task's work.
    Repeated rows each get a slot. An empty table gives no rows. Other columns
    are ignored.
    """
    measured = staged(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8).alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("key"),
        ),
        "shard-sizes",
    )
    starts, homes = minimax_cuts(measured.select("key", "size"), n_shards)
    shard = F.lit(0)
    for start, number in starts:
        shard = F.when(F.col("key") >= F.lit(start), F.lit(number)).otherwise(shard)
    for key, number in homes.items():
        shard = F.when(F.col("key") == F.lit(key), F.lit(number)).otherwise(shard)
    buckets = max(1, -(-measured.count() // (slot_rows * n_shards)))
    placed = measured.select(
        "doc_id",
        "size",
        "text_crc32",
        shard.alias("shard"),
        F.pmod(F.xxhash64("doc_id", "key"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    counted = placed.groupBy("shard", "bucket").agg(F.count("*").alias("rows"))
    # Buckets of one shard: a table of one row for each 50,000 documents.
    before = counted.selectExpr(
        "shard",
        "bucket",
        "sum(rows) OVER (PARTITION BY shard ORDER BY bucket) - rows AS before",
    )
    numbered = placed.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY shard, bucket ORDER BY doc_id, text_crc32) - 1 AS nth",
    )
    return numbered.join(before, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("before") + F.col("nth")).cast("long").alias("slot"),
    )
