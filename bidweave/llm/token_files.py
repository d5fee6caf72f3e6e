"""Token ids in directly addressable codes, stored as blocks in Parquet.

An id is cut into chunks of eight bits, the lowest first. Level 0 holds the
first chunk of every id; a bitmap marks the ids that go on, and level 1 holds
the next chunk of those only, and so on. A rank directory counts the marks
before every 512th id, so the place of any id on the next level is found
without decoding anything else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidweave.llm.byte_encoder import byte_encoder, closed
from bidweave.llm.common import tasks

CHUNK_BITS, RANK_STEP = 8, 512
BLOCK_TOKENS = 1 << 20
SCHEMA = (
    "part int, block int, first bigint, doc_ids array<bigint>, counts array<bigint>, n_tokens bigint, "
    "levels array<binary>, marks array<binary>, ranks array<binary>"
)


def pack_ids(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, bitmaps and rank directories of a block of ids."""
    levels, marks, ranks = [], [], []
    rest = ids.astype(np.uint32)
    while True:
        levels.append((rest & 0xFF).astype(np.uint8).tobytes())
        rest = rest >> CHUNK_BITS
        more = rest > 0
        marks.append(np.packbits(more, bitorder="little").tobytes())
        steps = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP)) if len(more) else more
        ranks.append(np.concatenate(([0], np.cumsum(steps)[:-1])).astype("<u4").tobytes() if len(more) else b"")
        if not more.any():
            return levels, marks, ranks
        rest = rest[more]


def unpack_ids(levels: list[bytes], marks: list[bytes]) -> np.ndarray:
    """All ids of a block."""
    found = np.zeros(len(levels[0]), np.uint32)
    at = np.arange(len(found))
    for level, (chunk, mark) in enumerate(zip(levels, marks, strict=True)):
        found[at] |= np.frombuffer(chunk, np.uint8).astype(np.uint32) << np.uint32(CHUNK_BITS * level)
        bits = np.unpackbits(np.frombuffer(mark, np.uint8), count=len(at), bitorder="little")
        at = at[bits.astype(bool)]
    return found


def id_at(levels: list[bytes], marks: list[bytes], ranks: list[bytes], place: int) -> int:
    """The id at one place, from a few bytes of each level."""
    found = 0
    for level, chunk in enumerate(levels):
        found |= chunk[place] << (CHUNK_BITS * level)
        mark = marks[level]
        if not mark[place >> 3] >> (place & 7) & 1:
            break
        step = place // RANK_STEP
        first = step * RANK_STEP
        before = int.from_bytes(mark[first >> 3 : (place >> 3) + 1], "little")
        before &= (1 << (place - first)) - 1
        rank = int.from_bytes(ranks[level][4 * step : 4 * step + 4], "little")
        place = rank + before.bit_count()
    return found


def part_bounds(docs: DataFrame, parts: int) -> np.ndarray:
    """Greatest doc_id of each part but the last, for parts of about equally many rows.

    Read from the ids alone; no more numbers than parts.
    """
    shares = [i / parts for i in range(1, parts)]
    found = docs.approxQuantile("doc_id", shares, 1 / (4 * parts)) if shares else []
    return np.sort(np.array([int(b) for b in found], np.int64))


def parts_of(ids: pa.Array, places: np.ndarray, bounds: np.ndarray, parts: int) -> np.ndarray:
    """The part of each row, in the order of doc_id; rows without one come first, in negative parts.

    Rows whose doc_id fills whole parts are spread over these by their place.
    """
    known = ids.fill_null(0).to_numpy(zero_copy_only=False)
    first = np.searchsorted(bounds, known, "left")
    last = np.searchsorted(bounds, known, "right")
    found = first + places % (last - first + 1)
    none = ids.is_null().to_numpy(zero_copy_only=False)
    return np.where(none, -1 - places % parts, found).astype(np.int32)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, bounds: np.ndarray, parts: int) -> DataFrame:
    """(part, doc_id, n, ids) of all whole texts, ``end_id`` after each; ids in two or four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = byte_encoder(tokenizer_path), 0
        for batch in batches:
            names = batch.column(0)
            ids, counts = closed(*encoder.encode(batch.column(1)), end_id)
            places = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            kind = np.dtype("<u4" if len(ids) and ids.max() >= 1 << 16 else "<u2")
            offsets = np.concatenate(([0], np.cumsum(counts))) * kind.itemsize
            raw = pa.py_buffer(ids.astype(kind))
            code = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), raw])
            part = pa.array(parts_of(names, places, bounds, parts))
            # Few rows at a time: an Arrow batch of plain binaries holds 2 GB at most.
            for low in range(0, len(counts), 1000):
                cells = [part, names, pa.array(counts), code]
                cells = [c.slice(low, 1000) for c in cells]
                cells[3] = cells[3].cast(pa.binary())
                yield pa.RecordBatch.from_arrays(cells, ["part", "doc_id", "n", "ids"])

    return docs.mapInArrow(run, "part int, doc_id bigint, n bigint, ids binary")


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int, block_tokens: int = BLOCK_TOKENS
) -> None:
    """Writes the ids of all whole texts, ``end_id`` after each, in ascending doc_id order.

    The ids are those of the library without special tokens added; an added
    token that stands in a text is taken as that token. Null texts are empty
    ones. Rows are dealt by ranges of doc_id, rows without one first; part and
    block number the blocks in that order, ``first`` counts the ids of the part
    before a block. Rows that repeat a doc_id all stay, in any order. A block
    holds whole documents, about ``block_tokens`` ids or one longer document.
    Texts are encoded where they are read, so ids and not texts are shuffled.
    Rows without doc_id, and those of a doc_id that fills whole parts, are
    dealt by their place in the input, which must come in the same order each
    time, as files do.
    """
    n = tasks(docs.sparkSession)
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = encoded(named, tokenizer_path, end_id, part_bounds(named, n), n)
    ordered = coded.repartitionById(n, F.pmod("part", F.lit(n)).cast("int")).sortWithinPartitions("part", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first, held = None, 0, 0, 0
        names: list[int | None] = []
        counts: list[int] = []
        codes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            values = np.concatenate(codes)
            levels, marks, ranks = pack_ids(values)
            row = [part, block, first, names, counts, len(values), levels, marks, ranks]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]
            kinds += [pa.list_(pa.binary())] * 3
            titles = [c.split()[0] for c in SCHEMA.split(", ")]
            cells = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(cells, titles)

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for own, name, n_ids, raw in zip(*columns, batch.column(3), strict=True):
                if names and (own != part or held + n_ids > block_tokens):
                    yield flush()
                    block, first = (block + 1, first + held) if own == part else (0, 0)
                    names, counts, codes, held = [], [], [], 0
                part = own
                names.append(name)
                counts.append(n_ids)
                code = raw.as_buffer()
                codes.append(np.frombuffer(code, "<u2" if len(code) == 2 * n_ids else "<u4").astype(np.uint32))
                held += n_ids
        if names:
            yield flush()

    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, place, id) for the (doc_id, place) rows of ``wanted``: single ids out of the files.

    The places, counted from 0 in each document, are joined with the documents
    of the blocks; then every block is met by its own places, and the rank
    directories lead to each id without decoding the block. Places that repeat
    give one row; places that a document does not have, and null ones, give
    none. Each document of a repeated doc_id answers on its own.
    """
    stored = spark.read.schema(SCHEMA).parquet(path)

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each document's first place in its block."""
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["block"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(counts),
                        pa.array(np.cumsum(counts) - counts),
                    ],
                    ["part", "block", "doc_id", "n", "begun"],
                )

    documents = stored.select("part", "block", "doc_ids", "counts").mapInArrow(
        begun, "part int, block int, doc_id bigint, n bigint, begun bigint"
    )
    places = wanted.select(F.col("doc_id").cast("bigint"), F.col("place").cast("bigint")).distinct()
    found = places.join(documents, "doc_id").where("place >= 0 AND place < n")
    # A place and its block's codes; many places of one block are packed into few rows.
    lists = found.groupBy("part", "block", F.pmod(F.xxhash64("doc_id", "place"), F.lit(16)).alias("salt")).agg(
        F.collect_list(F.struct("doc_id", "place", (F.col("begun") + F.col("place")).alias("at"))).alias("places")
    )
    met = lists.join(stored.select("part", "block", "levels", "marks", "ranks"), ["part", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["places", "levels", "marks", "ranks"]).to_pylist():
                places = row["places"]
                ids = [id_at(row["levels"], row["marks"], row["ranks"], p["at"]) for p in places]
                cells = [[p["doc_id"] for p in places], [p["place"] for p in places], ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cells], ["doc_id", "place", "id"])

    return met.mapInArrow(run, "doc_id bigint, place bigint, id bigint")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, decoded from the files."""
    stored = spark.read.schema(SCHEMA).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).selectExpr(
        "part", "sum(n) OVER (ORDER BY part) - n AS part_start"
    )
    # A row for each task of the writing job, of which there are spark.sql.shuffle.partitions.
    located = stored.join(F.broadcast(parts), "part").select(
        "doc_ids",
        "counts",
        "levels",
        "marks",
        (F.col("part_start") + F.col("first")).cast("bigint").alias("first"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = unpack_ids(row["levels"], row["marks"])
                counts = np.array(row["counts"], np.int64)
                edges = np.concatenate(([0], np.cumsum(counts)))
                raw = values.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1], edges[1:])]
                ids = pa.ListArray.from_arrays(
                    pa.array(edges.astype(np.int32)), pa.array(values.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(edges[:-1] + row["first"]),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                        ids,
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids array<int>"
    return located.mapInArrow(run, schema)
