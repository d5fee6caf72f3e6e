"""Packing of documents into sequences of fixed length: first-fit decreasing by a tournament tree.

Documents are encoded and cut into pieces of at most one sequence. The pieces
are dealt into randomised groups of about equally many, and each group is
packed on its own: longest piece first, into the first sequence with room for
it. A tournament tree over the room left in each sequence leads there in as
many steps as it has levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidweave.llm.byte_encoder import byte_encoder, closed

LENGTH = 2048
#: Pieces of a group, on average.
GROUP_PIECES = 2048
#: Room left in a sequence from which on a piece is cut to fill it.
LEAST_CUT = 32

PIECES = "key bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint"


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """The sequence of each length, taken in the order given; sequences are numbered from 0."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    # room[i] is the most room below node i; the leaves are sequences, unopened ones have all of it.
    room = [capacity] * (2 * leaves)
    found = []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        found.append(node - leaves)
        room[node] -= length
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return found


def pack(lengths: np.ndarray, capacity: int, least_cut: int) -> list[tuple[int, int, int, int, int]]:
    """(item, from, length, sequence, offset) of pieces that hold every item, few gaps left.

    ``lengths`` are in descending order. After first-fit decreasing, the
    emptiest sequences are given up one by one, and what they hold is cut to
    fill the gaps of at least ``least_cut`` in the others.
    """
    places = first_fit(lengths.tolist(), capacity)
    held: list[list[tuple[int, int, int]]] = [[] for _ in range(max(places, default=-1) + 1)]
    for item, (place, length) in enumerate(zip(places, lengths.tolist(), strict=True)):
        held[place].append((item, 0, length))
    used = np.bincount(places, lengths, len(held)).astype(np.int64).tolist()
    order = sorted(range(len(held)), key=lambda s: (used[s], s))
    gaps = [s for s in reversed(order) if capacity - used[s] >= least_cut]
    donors = iter(order)
    given: set[int] = set()
    spare: list[tuple[int, int, int]] = []
    donor = None
    for gap in gaps:
        if gap in given:
            break
        while capacity - used[gap] >= least_cut:
            if not spare:
                donor = next(donors, None)
                if donor is None or donor == gap:
                    break
                given.add(donor)
                spare, held[donor] = held[donor], []
            item, start, length = spare.pop()
            taken = min(length, capacity - used[gap])
            held[gap].append((item, start, taken))
            used[gap] += taken
            if taken < length:
                spare.append((item, start + taken, length - taken))
        if donor == gap:
            break
    if spare:
        held[donor] = spare
    found = []
    sequence = 0
    for pieces in held:
        offset = 0
        for item, start, length in pieces:
            found.append((item, start, length, sequence, offset))
            offset += length
        sequence += bool(pieces)
    return found


def pieces_of(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = LENGTH
) -> DataFrame:
    """Pieces of the encoded texts, ``end_id`` behind each, at most ``capacity`` ids long.

    (key, doc_id, start, length, doc_tokens, ids): ``key`` is one for each row
    of ``docs``, ``ids`` hold two or four bytes for each. Null texts are empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer_path)
        for batch in batches:
            ids, counts = closed(*encoder.encode(batch.column(2)), end_id)
            n = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = nth * capacity
            length = np.minimum(capacity, counts[row] - start)
            kind = np.dtype("<u4" if ids.max(initial=0) >= 1 << 16 else "<u2")
            raw = pa.py_buffer(ids.astype(kind))
            offsets = kind.itemsize * np.concatenate(([0], np.cumsum(length)))
            code = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), raw])
            plain = [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))]
            plain += [pa.array(a) for a in (start, length, counts[row])]
            for low in range(0, len(length), 1000):
                cells = [c.slice(low, 1000) for c in (*plain, code)]
                cells[5] = cells[5].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(cells, ["key", "doc_id", "start", "length", "doc_tokens", "ids"])

    named = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return named.mapInArrow(run, f"{PIECES}, ids binary")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = LENGTH,
    seed: int = 13,
    group_pieces: int = GROUP_PIECES,
    least_cut: int = LEAST_CUT,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``capacity`` ids.

    (doc_id, start, length, doc_tokens, sequence_id, offset, ids): ``start``
    counts the document's ids before the piece, ``ids`` are its ids as 32-bit
    little-endian integers. Each document ends with ``end_id``; null texts are
    empty. Every row of ``docs`` is a document, also without doc_id and also if
    it repeats another. A sequence holds pieces of one group only; its number
    is the group's times 2^32 plus its number there. Other columns are ignored.

    Pieces are dealt by a hash of their row's place in the input, which must
    come in the same order each time, as files do: a doc_id, a text or a long
    document that holds many of the pieces is spread over all groups.
    """
    size = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col("text").cast("string"))).alias("b")).first()
    # No text has more ids than bytes, so there are no more pieces than this.
    groups = max(1, (size.n + (size.b or 0) // (2 * capacity)) // group_pieces)
    pieces = pieces_of(docs, tokenizer_path, end_id, capacity)
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "key", "start"), F.lit(groups)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        key, start, length = (table.column(c).to_numpy() for c in ("key", "start", "length"))
        order = np.lexsort((start, key, -length))
        group = table.column("group")[0].as_py()
        found = np.array(pack(length[order], capacity, least_cut), np.int64)
        at = pa.array(order[found[:, 0]])
        begun, size, sequence, offset = found[:, 1], found[:, 2], found[:, 3], found[:, 4]
        rows = table.select(["doc_id", "doc_tokens"]).take(at)
        codes = table.column("ids").take(at)
        cells = [
            rows.column("doc_id"),
            pa.array(table.column("start").to_numpy()[order[found[:, 0]]] + begun),
            pa.array(size),
            rows.column("doc_tokens"),
            pa.array((group << 32) + sequence),
            pa.array(offset),
            sliced(codes, length[order[found[:, 0]]], begun, size),
        ]
        return pa.Table.from_arrays(cells, names=[c.split()[0] for c in PACKED.split(", ")])

    return dealt.groupBy("group").applyInArrow(run, PACKED)


PACKED = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


def sliced(codes: pa.ChunkedArray, held: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Of rows with ``held`` ids, those from ``start`` on, four bytes each."""
    found = []
    for code, all_ids, a, n in zip(codes, held.tolist(), start.tolist(), length.tolist(), strict=True):
        raw = code.as_buffer()
        ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * all_ids else "<u4")
        found.append(ids[a : a + n].astype("<u4").tobytes())
    return pa.array(found, pa.binary())


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of packed pieces, put together in the order of their offsets."""
    whole = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("pieces")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [
                np.frombuffer(b"".join(p["ids"] for p in row), "<u4").astype(np.int32)
                for row in batch.column(2).to_pylist()
            ]
            cells = [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cells, ["sequence_id", "n_tokens", "ids"])

    return whole.mapInArrow(run, "sequence_id bigint, n_tokens bigint, ids array<int>")
