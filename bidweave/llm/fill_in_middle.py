"""Fill-in-the-middle rearrangement of documents with piece tables.

A document is a list of pieces: (buffer, start, length) descriptors over two
buffers that never change, the bytes of its text and those of the sentinels.
Cutting splits a descriptor, arranging permutes descriptors and sets sentinels
between them, and hashing reads them one after the other. Going back, the
output is the text buffer: it is cut around its sentinels, these are left out,
and the inverse permutation puts the rest in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARKS = 0, 1

#: Sections of a text, in its order, as each form has them.
SECTIONS = (PREFIX, MIDDLE, SUFFIX)
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLAIN = "plain"


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def cut(pieces: list[Piece], places: Iterable[int]) -> list[list[Piece]]:
    """Pieces before, between and after ascending places of the text they make up."""
    found, at, rest = [], 0, list(pieces)
    for place in places:
        part = []
        while rest and at < place:
            buffer, start, length = rest.pop(0)
            taken = min(length, place - at)
            part.append(Piece(buffer, start, taken))
            if taken < length:
                rest.insert(0, Piece(buffer, start + taken, length - taken))
            at += taken
        found.append(part)
    return [*found, rest]


def arranged(sections: list[list[Piece]], form: str) -> list[Piece]:
    """The three sections in the form's order, each behind its sentinel."""
    found = []
    for mark in FORMS[form]:
        found.append(Piece(MARKS, SENTINELS.index(mark), len(mark)))
        found += sections[SECTIONS.index(mark)]
    return found


def restored(output: memoryview | bytes, form: str) -> list[Piece]:
    """Pieces over an output that make up the text it was made of.

    No sentinel is in the text, and none can arise where a sentinel and text
    meet, so each is found where it was set.
    """
    if form == PLAIN:
        return [Piece(TEXT, 0, len(output))]
    raw, order, ends = bytes(output), FORMS[form], []
    for mark in order:
        at = raw.index(mark, ends[-1] if ends else 0)
        ends += [at, at + len(mark)]
    parts = cut([Piece(TEXT, 0, len(raw))], ends)
    sections = dict(zip(order, parts[2::2], strict=True))
    return [piece for mark in SECTIONS for piece in sections[mark]]


def stream(pieces: Iterable[Piece], text: memoryview | bytes) -> Iterator[memoryview]:
    """The bytes that descriptors stand for, piece by piece and without a copy."""
    buffers = memoryview(text), memoryview(SENTINELS)
    for buffer, start, length in pieces:
        yield buffers[buffer][start : start + length]


def sha256_of(parts: Iterable[memoryview]) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def draws(doc_id: int, seed: int) -> list[int]:
    """Four numbers that follow from the id."""
    found = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(found[i : i + 8], 16) for i in range(0, 32, 8)]


def characters(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def rearranged(text: memoryview, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, pieces) of one text."""
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(data == 10) + 1
    if len(data) and (not len(ends) or ends[-1] < len(data)):
        ends = np.append(ends, len(data))
    n = len(ends)
    whole = [Piece(TEXT, 0, len(data))]
    raw = bytes(text)
    if not raw or doc_id is None or any(mark in raw for mark in SECTIONS):
        return n, PLAIN, None, None, whole
    h = draws(doc_id, seed)
    if h[2] % 100 >= rate:
        return n, PLAIN, None, None, whole
    form = "spm" if h[3] % 100 < spm else "psm"
    edges = np.concatenate(([0], ends))
    first, second = (int(edges[u]) for u in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    sections = cut(whole, [first, second])
    return n, form, characters(data[:first]), characters(data[first:second]), arranged(sections, form)


FIXED = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "pieces array<struct<buffer:int,start:bigint,length:bigint>>, output_sha256 string, restored_sha256 string"
)
#: Bytes of texts that go out in one batch.
BATCH_BYTES = 32 << 20


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, texts: bool = True
) -> DataFrame:
    """Every whole text of (doc_id, text), cut at line ends and rearranged.

    (doc_id, n, form, prefix_chars, middle_chars, pieces, output_sha256,
    restored_sha256, output): ``n`` lines, the form "psm", "spm" or "plain", the
    code points of prefix and middle (null if plain), the descriptors of the
    output, its hash, the hash of the text rebuilt from output and form, and
    the output itself unless ``texts`` is off. Cuts and form follow from
    ``seed`` and doc_id alone: ``rate`` of 100 texts are rearranged, ``spm`` of
    100 of these have the suffix first.

    Texts that are null (taken as empty), empty, hold a sentinel, or lack a
    doc_id stay plain. Rows that repeat stay as they are. Other columns are
    ignored. One pass without a shuffle; a task holds one batch.
    """
    schema = FIXED + ", output binary" * texts
    titles = [c.split()[0] for c in FIXED.split(", ")] + ["output"] * texts
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    kinds += [pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))]
    kinds += [pa.string(), pa.string()] + [pa.binary()] * texts

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cells = [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(cells, titles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = memoryview(value.as_buffer() or b"")
                n, form, prefix, middle, pieces = rearranged(text, name, seed, rate, spm)
                output = b"".join(stream(pieces, text))
                digest = sha256_of(stream(pieces, text))
                back = sha256_of(stream(restored(output, form), output))
                rows.append((name, n, form, prefix, middle, [p._asdict() for p in pieces], digest, back))
                if texts:
                    rows[-1] += (output,)
                    held += len(output)
                if held > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = named.mapInArrow(run, schema)
    return found.withColumn("output", F.col("output").cast("string")) if texts else found
