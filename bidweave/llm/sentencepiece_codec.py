"""SentencePiece encoding and decoding by batched numpy Viterbi.

The pieces and scores of a model file span a unigram lattice: the segmentation
with the largest total score wins, of equals the one with the longest last
piece. Distinct pre-tokens of a batch are grouped by length and advance
together, a column at a time: hashes of all substrings that end there probe the
sorted piece keys, and vectorised maxima store the backpointers. Characters
without a piece fall back to their bytes. Long runs without a space are cut
where no piece reaches across, and what is still long goes by overlapping
chunks of one length, which advance together like words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bidweave.llm.pieces import (
    LONG,
    SPACE,
    Vocabulary,
    by_bytes,
    chunked,
    codes,
    hits,
    power,
    pretokens,
    rolling,
    segments,
    vocabulary,
)

#: Pre-tokens that a worker keeps encoded, and cells of one Viterbi matrix.
KEPT, CELLS = 300_000, 1_000_000


class Lattice(NamedTuple):
    """Best scores, sizes of last pieces and their ids, for each end and each of equally long words."""

    best: np.ndarray
    back: np.ndarray
    piece: np.ndarray


def lattice(points: np.ndarray, vocab: Vocabulary, before: np.ndarray | None = None) -> Lattice:
    """Scores all ends of equally long words, given as a row of code points each, column by column.

    ``before`` are the scores of the first ends, if they are known; one row for
    each of these ends.
    """
    n, length = points.shape
    hashed = np.ascontiguousarray(rolling(points).T)
    # For each size: the ends and rows at which a piece ends, in the order of the ends.
    found = {}
    for size in range(1, min(vocab.longest, length) + 1):
        flat = (hashed[size:] - hashed[:-size] * power(size)).ravel()
        at, ids = hits(vocab, size, flat)
        ends, rows = np.divmod(at, n)
        spans = np.searchsorted(ends, np.arange(length - size + 2)).tolist()
        found[size] = rows, ids, vocab.scores[ids], spans
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0.0
    back = np.ones((length + 1, n), np.int32)
    piece = np.full((length + 1, n), -1, np.int32)
    first = 1
    if before is not None:
        best[: len(before)], first = before, len(before)
    for end in range(first, length + 1):
        row = best[end]
        for size in range(min(vocab.longest, end), 0, -1):
            rows, ids, scores, spans = found[size]
            low, high = spans[end - size], spans[end - size + 1]
            if size == 1:
                # A character without a piece stands for itself.
                lone = np.ones(n, bool)
                lone[rows[low:high]] = False
                total = best[end - 1] + vocab.unknown
                wins = lone & (total > row)
                row[wins], back[end, wins], piece[end, wins] = total[wins], 1, -1
            if low == high:
                continue
            at, total = rows[low:high], best[end - size][rows[low:high]] + scores[low:high]
            wins = total > row[at]
            at = at[wins]
            row[at], back[end, at], piece[end, at] = total[wins], size, ids[low:high][wins]
    return Lattice(best, back, piece)


def viterbi(words: list[str], length: int, vocab: Vocabulary) -> Iterator[bytes]:
    """Ids, as little-endian 32-bit integers, of equally long words."""
    n = len(words)
    _, back, piece = lattice(codes(words, length), vocab)
    # Pieces from the last to the first, to the right end of each row.
    path = np.empty((n, length), np.int32)
    at, filled, rows = np.full(n, length), np.full(n, length), np.arange(n)
    while len(rows):
        here = at[rows]
        filled[rows] -= 1
        path[rows, filled[rows]] = piece[here, rows]
        at[rows] = here - back[here, rows]
        rows = rows[at[rows] > 0]
    lost = (path < 0) & (np.arange(length) >= filled[:, None])
    odd = lost.any(axis=1)
    for i in range(n):
        ids = path[i, filled[i] :]
        yield _with_bytes(words[i], ids, vocab) if odd[i] else ids.tobytes()


def _with_bytes(word: str, ids: np.ndarray, vocab: Vocabulary) -> bytes:
    found, at = [], 0
    for i in ids.tolist():
        if i < 0:
            found += vocab.byte_ids[list(word[at].encode("utf-8", "surrogatepass"))].tolist()
            at += 1
        else:
            found.append(i)
            at += len(vocab.pieces[i])
    return np.array(found, np.int32).tobytes()


def long_segment(segment: str, vocab: Vocabulary) -> bytes:
    """Ids of a segment of any length, from chunks that are scored side by side.

    A chunk that does not go on as the one before it is scored again from the
    scores that one leaves.
    """
    chunks = chunked(segment, vocab)
    texts, step, lead, reach = *chunks, vocab.longest
    scored: list[tuple[int, Lattice]] = [(0, None)] * len(texts)
    for length, members in _by_length(texts).items():
        for low in range(0, len(members), max(1, CELLS // (length + 1))):
            part = members[low : low + max(1, CELLS // (length + 1))]
            whole = lattice(codes([texts[c] for c in part], length), vocab)
            for i, c in enumerate(part):
                scored[c] = max(0, c * step - lead), Lattice(*(a[:, i] for a in whole))
    for c in range(1, len(texts)):
        start, own = scored[c]
        before, last = scored[c - 1]
        at, old = c * step - start, c * step - before
        mine, want = own.best[at - reach + 1 : at + 1], last.best[old - reach + 1 : old + 1]
        if not np.array_equal(mine - mine[-1], want - want[-1]):
            first = c * step - reach + 1
            text = segment[first : (c + 1) * step]
            again = lattice(codes([text], len(text)), vocab, (want - want[-1])[:, None])
            scored[c] = first, Lattice(*(a[:, 0] for a in again))
    ids, at, c = [], len(segment), len(texts) - 1
    backs = [(start, found.back.tolist(), found.piece.tolist()) for start, found in scored]
    while at:
        while c and at <= c * step:
            c -= 1
        start, back, piece = backs[c]
        ids.append(piece[at - start])
        at -= back[at - start]
    return _with_bytes(segment, np.array(ids[::-1], np.int32), vocab)


def _by_length(words: Iterable[str]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        found.setdefault(len(word), []).append(i)
    return found


def encode_words(words: set[str], vocab: Vocabulary) -> dict[str, bytes]:
    """Ids of distinct pre-tokens.

    Long ones, as of scripts without spaces or of encoded data, are cut where
    no piece reaches across, so their segments join the words of that length.
    """
    cut = {word: segments(word, vocab) for word in words if len(word) > LONG}
    parts = {w for w in words if len(w) <= LONG} | {s for found in cut.values() for s in found}
    found = {part: long_segment(part, vocab) for part in parts if len(part) > LONG}
    short = [part for part in parts if len(part) <= LONG]
    for length, members in _by_length(short).items():
        step = max(1, CELLS // (length + 1))
        for i in range(0, len(members), step):
            part = [short[m] for m in members[i : i + step]]
            found.update(zip(part, viterbi(part, length, vocab), strict=True))
    return found | {word: b"".join(map(found.__getitem__, parts)) for word, parts in cut.items()}


class Encoder:
    """Encodes batches of texts; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        split = [pretokens(t) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known = {}
        new = {w for words in split for w in words if w not in self.known}
        found = encode_words(new, self.vocab)
        # Long words rarely come again.
        self.known.update((w, ids) for w, ids in found.items() if len(w) <= LONG)
        known, get = self.known, found.get
        return [b"".join([known[w] if w in known else get(w) for w in words]) for words in split]


def decode(ids: np.ndarray, vocab: Vocabulary) -> str:
    """Text of ids; the space in front that encoding added is taken away again."""
    raw = b"".join(map(vocab.raw.__getitem__, ids.tolist()))
    return raw.decode("utf-8", "replace").removeprefix(" ")


def encode_documents(docs: DataFrame, model_path: str, verify: bool = True) -> DataFrame:
    """``docs`` with ``ids`` array<int>, ``n_tokens``, ``ids_crc32`` and ``round_trip`` added.

    ``round_trip`` tells whether the ids decode to the very text again; only a
    text that holds U+2581 itself does not. Null and empty texts have no ids
    and round-trip (a null one to an empty text). All rows and columns stay;
    columns of these names are replaced. Whole texts are encoded.
    """
    names = ["ids", "n_tokens", "ids_crc32", "round_trip"]
    kept = docs.drop(*names)
    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    columns = [*kept.columns, *names]
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path)
        for batch in batches:
            done = 0
            for texts in by_bytes(batch.column(place).to_pylist()):
                rows = batch.slice(done, len(texts))
                done += len(texts)
                coded = encoder(texts)
                counts = np.array([len(c) // 4 for c in coded], np.int64)
                values = np.frombuffer(b"".join(coded), np.int32)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                same = [
                    not verify or decode(np.frombuffer(c, np.int32), encoder.vocab) == (t or "")
                    for c, t in zip(coded, texts, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns,
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                        pa.array(counts),
                        pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                        pa.array(same),
                    ],
                    columns,
                )

    return kept.mapInArrow(run, schema)


def decode_documents(coded: DataFrame, model_path: str, name: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ``ids`` in column ``name``; null ids give an empty text."""
    kept = coded.drop(name)
    columns = [*kept.columns, name]
    place = columns.index("ids")
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for batch in batches:
            texts = [decode(np.array(i or [], np.int32), vocab) for i in batch.column(place).to_pylist()]
            found = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], columns)

    return kept.mapInArrow(run, schema)


__all__ = ["SPACE", "Encoder", "decode", "decode_documents", "encode_documents", "encode_words"]
