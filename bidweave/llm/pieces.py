"""The piece vocabulary of a SentencePiece model file, and lookups by substring hash."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np

SPACE = "▁"
#: An odd multiplier for hashes of character sequences, modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Upper bits of a hash that a sieve tells apart.
SIEVE_BITS = 18
#: Longer pre-tokens are cut into segments, and longer segments into chunks.
LONG = 64


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray
    raw: list[bytes]
    """What each id stands for, once decoded; empty for control pieces."""
    keys: dict[int, tuple[np.ndarray, np.ndarray]]
    """For each piece length: sorted hashes and the ids in that order."""
    longest: int
    unknown: float
    """Score of a character that no piece holds."""
    sieves: dict[int, np.ndarray]
    """For each piece length: whether a piece's hash has these upper bits."""
    pairs: np.ndarray
    """Neighbouring characters of some piece, as sorted numbers."""


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    scores = np.array([model.get_score(i) for i in range(size)])
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(size)]
    byte_ids, raw = np.zeros(256, np.int32), []
    lengths: dict[int, list[int]] = {}
    for i, piece in enumerate(pieces):
        if model.is_byte(i):
            value = int(piece[3:-1], 16)
            byte_ids[value] = i
            raw.append(bytes([value]))
        elif special[i]:
            raw.append(b"")
        else:
            raw.append(piece.replace(SPACE, " ").encode())
            lengths.setdefault(len(piece), []).append(i)
    keys, sieves, pairs = {}, {}, [np.empty(0, np.uint64)]
    for n, ids in lengths.items():
        hashes = rolling(codes([pieces[i] for i in ids], n))[:, -1]
        order = np.argsort(hashes)
        keys[n] = hashes[order], np.array(ids, np.int32)[order]
        sieves[n] = np.zeros(1 << SIEVE_BITS, bool)
        sieves[n][hashes >> np.uint64(64 - SIEVE_BITS)] = True
        points = codes([pieces[i] for i in ids], n).astype(np.uint64)
        pairs.append((points[:, :-1] << np.uint64(21) | points[:, 1:]).ravel())
    normal = scores[[i for i in range(size) if not special[i]]]
    return Vocabulary(
        pieces,
        scores,
        byte_ids,
        raw,
        keys,
        max(keys),
        float(normal.min()) - 10.0,
        sieves,
        np.unique(np.concatenate(pairs)),
    )


def codes(words: list[str], length: int) -> np.ndarray:
    """Code points of equally long words, a row for each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), length)


def rolling(points: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes, from the empty one."""
    found = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        found[:, i + 1] = found[:, i] * BASE + points[:, i] + np.uint64(1)
    return found


@lru_cache(maxsize=64)
def power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def hits(vocab: Vocabulary, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes, in one dimension, that belong to pieces, and the pieces' ids.

    The sieve leaves few hashes to be searched among the sorted keys.
    """
    if length not in vocab.keys:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    places = np.flatnonzero(vocab.sieves[length][hashes >> np.uint64(64 - SIEVE_BITS)])
    known, ids = vocab.keys[length]
    some = hashes[places]
    at = np.minimum(np.searchsorted(known, some), len(known) - 1)
    same = known[at] == some
    return places[same], ids[at[same]]


def segments(word: str, vocab: Vocabulary) -> list[str]:
    """A long pre-token cut wherever no piece can reach across.

    That is between characters that are no neighbours in any piece, so the
    best segmentation of the word is made of those of its segments.
    """
    points = codes([word], len(word))[0].astype(np.uint64)
    pairs = points[:-1] << np.uint64(21) | points[1:]
    at = np.minimum(np.searchsorted(vocab.pairs, pairs), len(vocab.pairs) - 1)
    cuts = np.flatnonzero(vocab.pairs[at] != pairs) + 1
    edges = [0, *cuts.tolist(), len(word)]
    return [word[a:b] for a, b in zip(edges[:-1], edges[1:])]


class Chunks(NamedTuple):
    """A long segment as overlapping chunks that can be scored side by side.

    Chunk ``c`` answers for the characters from ``c * step`` on and starts
    ``lead`` characters earlier. Scores behind a point depend only on the last
    ``longest`` scores before it, up to a constant: if a chunk's are those of
    the chunk before, up to that constant, it goes on as the whole segment would.
    """

    texts: list[str]
    step: int
    lead: int


def chunked(segment: str, vocab: Vocabulary, step: int = 384, lead: int = 128) -> Chunks:
    lead = max(lead, 2 * vocab.longest)
    texts = [segment[max(0, a - lead) : a + step] for a in range(0, len(segment), step)]
    return Chunks(texts, step, lead)


def pretokens(text: str) -> list[str]:
    """Spaces with the word behind them; no piece reaches from one into the next.

    The text gets a space in front, and spaces turn into the model's mark.
    """
    words = text.split(" ")
    if "" not in words and SPACE not in text:
        return [SPACE + w for w in words]
    found, lead = [], ""
    for word in text.replace(SPACE, " ").split(" "):
        lead += SPACE
        if word:
            found.append(lead + word)
            lead = ""
    if lead:
        found.append(lead)
    return found


def by_bytes(texts: list[str | None], most: int = 4 << 20) -> Iterator[list[str | None]]:
    """Lists of texts of about ``most`` characters, or of one longer text."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part
