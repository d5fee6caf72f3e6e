"""Token counts by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch form a trie. Its nodes are walked depth by
depth, all nodes of one depth together: the best unigram score of a node's
prefix comes from its ancestors' scores and the piece between, so a prefix that
many words share is scored once. A word's count stands at its terminal node.
Long runs without a space are cut where no piece reaches across; what is still
long enters the trie as overlapping chunks, whose counts add up if each chunk
goes on as the one before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidweave.llm.pieces import (
    BASE,
    LONG,
    Vocabulary,
    by_bytes,
    chunked,
    hits,
    power,
    pretokens,
    segments,
    vocabulary,
)
from bidweave.llm.sentencepiece_codec import long_segment

KEPT = 500_000


def _utf8_length(points: np.ndarray) -> np.ndarray:
    return 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)


class Ends(NamedTuple):
    """Scores and counts at the last ends up to a depth, a row for each word."""

    scores: np.ndarray
    counts: np.ndarray

    def set(self, rows: np.ndarray, left: np.ndarray, level: tuple, node: np.ndarray) -> None:
        """Takes over the words that are ``left`` characters away from the depth."""
        near = (left >= 0) & (left < self.scores.shape[1])
        at = rows[near], self.scores.shape[1] - 1 - left[near]
        self.scores[at], self.counts[at] = level[1][node[near]], level[2][node[near]]


def terminal_counts(words: list[str], vocab: Vocabulary) -> list[int]:
    """Tokens of the best segmentation of each word, in the order given.

    Of equal scores the longest last piece wins; a character without a piece
    counts its bytes.
    """
    return trie_counts(words, vocab)[0].tolist()


def trie_counts(
    words: list[str], vocab: Vocabulary, depths: np.ndarray | None = None
) -> tuple[np.ndarray, Ends | None, Ends | None]:
    """Counts of each word, and if asked for what stands at the ends up to ``depths`` and up to its last."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    terminal = np.zeros(len(words), np.int64)
    rows, node = np.arange(len(words)), np.zeros(len(words), np.int64)
    entry = leave = None
    if depths is not None:
        shape = len(words), vocab.longest
        entry, leave = (Ends(np.zeros(shape), np.zeros(shape, np.int64)) for _ in range(2))
    # One entry for each depth that a piece can reach back to: hash, score, count of its nodes.
    levels = [(np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64))]
    parents: list[np.ndarray] = []
    while True:
        depth = len(parents)
        if depths is not None:
            entry.set(rows, depths[rows] - depth, levels[depth], node)
            leave.set(rows, lengths[rows] - depth, levels[depth], node)
        ends = lengths[rows] == depth
        terminal[rows[ends]] = levels[depth][2][node[ends]]
        rows, node = rows[~ends], node[~ends]
        if not len(rows):
            return terminal, entry, leave
        char = points[starts[rows] + depth].astype(np.int64)
        edges, node = np.unique(node << 21 | char, return_inverse=True)
        parent, char = edges >> 21, (edges & 0x1FFFFF).astype(np.uint64)
        hashed = levels[depth][0][parent] * BASE + char + np.uint64(1)
        above = [parent]
        for back in range(1, min(vocab.longest, depth + 1)):
            above.append(parents[depth - back][above[-1]])
        best = np.full(len(edges), -np.inf)
        count = np.zeros(len(edges), np.int64)
        for size in range(len(above), 0, -1):
            at = above[size - 1]
            old_hash, old_best, old_count = levels[depth + 1 - size]
            places, ids = hits(vocab, size, hashed - old_hash[at] * power(size))
            if size == 1:
                lone = np.ones(len(edges), bool)
                lone[places] = False
                total = old_best[at] + vocab.unknown
                wins = lone & (total > best)
                best[wins] = total[wins]
                count[wins] = old_count[at[wins]] + _utf8_length(char[wins])
            total = old_best[at[places]] + vocab.scores[ids]
            wins = total > best[places]
            better = places[wins]
            best[better] = total[wins]
            count[better] = old_count[at[better]] + 1
        parents.append(parent)
        levels.append((hashed, best, count))
        if depth + 1 - vocab.longest >= 0:
            levels[depth + 1 - vocab.longest] = None


def long_counts(parts: list[str], vocab: Vocabulary) -> list[int]:
    """Tokens of segments of any length, all their chunks in one trie."""
    cut = [chunked(part, vocab) for part in parts]
    texts = [text for chunks in cut for text in chunks.texts]
    depths = [min(c * chunks.step, chunks.lead) for chunks in cut for c in range(len(chunks.texts))]
    counts, entry, leave = trie_counts(texts, vocab, np.array(depths, np.int64))
    found, at = [], 0
    for part, chunks in zip(parts, cut, strict=True):
        last = at + len(chunks.texts)
        total = int(counts[at])
        for i in range(at + 1, last):
            # Scores and counts of the ends that the chunk builds on, up to a constant.
            pairs = ((entry.scores[i], leave.scores[i - 1]), (entry.counts[i], leave.counts[i - 1]))
            if not all(np.array_equal(a - a[-1], b - b[-1]) for a, b in pairs):
                total = len(long_segment(part, vocab)) // 4
                break
            total += int(counts[i] - entry.counts[i, -1])
        found.append(total)
        at = last
    return found


def word_counts(words: set[str], vocab: Vocabulary) -> dict[str, int]:
    """Tokens of distinct pre-tokens."""
    cut = {word: segments(word, vocab) for word in words if len(word) > LONG}
    parts = {w for w in words if len(w) <= LONG} | {s for found in cut.values() for s in found}
    short, long = [p for p in parts if len(p) <= LONG], [p for p in parts if len(p) > LONG]
    found = dict(zip(short, terminal_counts(short, vocab), strict=True)) if short else {}
    if long:
        found.update(zip(long, long_counts(long, vocab), strict=True))
    return found | {word: sum(map(found.__getitem__, parts)) for word, parts in cut.items()}


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every row of ``docs`` (doc_id, text).

    Whole texts count; null and empty ones have no token. Repeated rows and
    rows without doc_id stay as they are; other columns are ignored. A few
    megabytes of text are taken at a time, or one longer text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(model_path), {}
        for batch in batches:
            done = 0
            for texts in by_bytes(batch.column(1).to_pylist()):
                names = batch.column(0).slice(done, len(texts))
                done += len(texts)
                split = [pretokens(t) if t else [] for t in texts]
                if len(known) > KEPT:
                    known = {}
                found = word_counts({w for words in split for w in words if w not in known}, vocab)
                known.update((w, n) for w, n in found.items() if len(w) <= LONG)
                totals = [sum([known[w] if w in known else found[w] for w in words]) for words in split]
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array([len(w) for w in split], pa.int64()), pa.array(totals, pa.int64())],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )

    schema = f"doc_id {kind}, n_pretokens bigint, n_tokens bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def token_totals(docs: DataFrame, model_path: str, by: list[str]) -> DataFrame:
    """Tokens and documents for each value of the columns ``by`` of ``docs``."""
    key = F.struct(*by).alias("doc_id")
    counted = count_tokens(docs.select(key, "text"), model_path)
    return counted.groupBy("doc_id").agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    ).select("doc_id.*", "n_docs", "n_tokens")
