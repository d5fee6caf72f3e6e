"""Byte-level BPE over whole Arrow columns of texts.

The tokenizers library encodes each distinct piece of text once; the texts are
put together again from those ids with numpy. A byte-level tokenizer first cuts
a text into words, runs of digits, of other characters and of white space, and
never joins two of them. Where such a cut can be told from single bytes, the
text is cut here:

- before a run of white space, before its last character if the run has a word
  behind it, and behind that character unless it is a space;
- between ASCII letters, ASCII digits and other ASCII characters, but not
  behind an apostrophe.

Nothing is cut beside other bytes. A text in which white space outside of ASCII
lies next to other white space, or that holds an added token, is one piece.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Distinct pieces that a worker remembers, and their ids.
KEPT, KEPT_IDS = 800_000, 8_000_000
#: Distinct pieces encoded in one call.
CALL = 1_000
#: Bytes of text that are encoded together; a longer text is on its own.
CHUNK = 8 << 20

OTHER, LETTER, DIGIT, BLANK, SPACE, HIGH, APOSTROPHE, UNSURE = range(8)


def _kind(byte: int) -> int:
    char = chr(byte)
    if byte in (0xC2, 0xE1, 0xE2, 0xE3):
        return UNSURE  # may begin white space
    if byte >= 0x80:
        return HIGH
    if 0x1C <= byte <= 0x1F:
        return UNSURE
    if char.isalpha():
        return LETTER
    if char.isdigit():
        return DIGIT
    return {" ": SPACE, "'": APOSTROPHE}.get(char, BLANK if char.isspace() else OTHER)


KINDS = np.array([_kind(b) for b in range(256)], np.uint8)
#: For kinds a and b of two neighbours, at 8 a + b: they belong to different pieces.
PARTED = np.array(
    [
        a in (LETTER, DIGIT, OTHER) and (OTHER if b == APOSTROPHE else b) in {LETTER, DIGIT, OTHER} - {a}
        for a in range(8)
        for b in range(8)
    ]
)
#: Characters outside of ASCII that may count as white space.
WIDE = "\x85\xa0 ᠎" + "".join(map(chr, range(0x2000, 0x200C))) + "    　"


def cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """For each byte of the texts, whether a piece begins there."""
    kind = KINDS[data]
    blank = (kind == BLANK) | (kind == SPACE)
    cut = np.zeros(len(data) + 1, bool)
    a, b = kind[:-1], kind[1:]
    cut[1:-1] = PARTED[(a << 3) | b]
    word = np.append(~blank, False)
    starts = edges[:-1][edges[:-1] < edges[1:]]
    last = edges[1:][edges[:-1] < edges[1:]] - 1
    follows = word[1:].copy()
    follows[last] = False  # nothing follows within the text
    cut[1:-1] |= blank[1:] & word[:-2]
    cut[:-1] |= blank & follows
    cut[1:-1] |= (a == BLANK) & word[1:-1]
    cut[starts] = True
    return cut[:-1]


def _wide_places(data: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the characters that may be white space but are not ASCII blanks."""
    at = np.flatnonzero(kind == UNSURE)
    low = data[at] < 0x80
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32)
    first, second, third = padded[at], padded[at + 1], padded[at + 2]
    two = first == 0xC2
    code = np.where(two, (first & 0x1F) << 6 | second & 0x3F, (first & 0xF) << 12 | (second & 0x3F) << 6 | third & 0x3F)
    held = low | np.isin(code, np.array([ord(c) for c in WIDE], np.uint32))
    at, size = at[held], np.where(low, 1, np.where(two, 2, 3))[held]
    return at, at + size


def unsafe_texts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Texts with uncommon white space next to other white space."""
    kind = KINDS[data]
    if not (kind == UNSURE).any():
        return np.empty(0, np.int64)
    start, end = _wide_places(data, kind)
    white = np.zeros(len(data) + 1, bool)
    white[:-1] = (kind == BLANK) | (kind == SPACE)
    white[start] = True
    behind = white[end]
    tail = np.zeros(len(data) + 1, bool)
    tail[1:] = (kind == BLANK) | (kind == SPACE)
    tail[end] = True
    near = start[behind | tail[start]]
    return np.unique(np.searchsorted(edges, near, "right") - 1)


@lru_cache(maxsize=1)
def byte_encoder(path: str) -> ByteEncoder:
    """One for all tasks of a worker."""
    return ByteEncoder(path)


class ByteEncoder:
    """Ids of texts by a byte-level tokenizer file, as the library gives them without special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        split = state["pre_tokenizer"] or {}
        self.plain = (
            split.get("type") != "ByteLevel"
            or split.get("add_prefix_space", True)
            or not split.get("use_regex", True)
            or state["normalizer"] is not None
        )
        self.added = [t["content"].encode() for t in state["added_tokens"]]
        line_break = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.plain = self.plain or len(line_break) != 1
        self.line_break = None if self.plain else line_break[0]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.first, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _remember(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.known)
        if n + len(words) > len(self.first):
            more = np.zeros(max(len(self.first), len(words)), np.int64)
            self.first, self.size = np.append(self.first, more), np.append(self.size, more)
        if self.used + len(ids) > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32))
        self.ids[self.used : self.used + len(ids)] = ids
        self.size[n : n + len(words)] = sizes
        self.first[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def _learn(self, words: list[bytes]) -> None:
        """Encodes new pieces: those without white space many in a call, with line breaks between."""
        joined, alone = [], []
        for word in words:
            text = word.decode()
            bare = text[1:] if text[:1] == " " else text
            fine = bare and bare == bare.strip() and "\n" not in bare and len(word) < 256
            (joined if fine and not self.plain else alone).append((word, text))
        for low in range(0, len(joined), CALL):
            part = joined[low : low + CALL]
            whole = self.tokenizer.encode_batch_fast(["\n".join(t for _, t in part)], add_special_tokens=False)[0]
            ids = np.array(whole.ids, np.uint32)
            breaks = ids == self.line_break
            ends = np.flatnonzero(breaks)
            sizes = np.diff(np.concatenate(([-1], ends, [len(ids)]))) - 1
            self._remember([w for w, _ in part], ids[~breaks], sizes)
        for word, text in alone:
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            self._remember([word], np.array(ids, np.uint32), np.array([len(ids)]))

    def _whole(self, data: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Texts that are not to be cut."""
        if self.plain:
            return np.arange(len(edges) - 1)
        found = [unsafe_texts(data, edges)]
        raw = data.tobytes() if self.added else b""
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                found.append(np.searchsorted(edges, [at], "right") - 1)
                at = raw.find(token, at + 1)
        return np.unique(np.concatenate(found))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts in one array, and the number of ids of each; null is empty."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
        low = 0
        while low < len(texts):
            high = int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1
            high = min(max(high, low + 1), len(texts))
            edges = offsets[low : high + 1] - offsets[low]
            one = self._chunk(data[offsets[low] : offsets[high]], edges)
            ids.append(one[0])
            counts.append(one[1])
            low = high
        return np.concatenate(ids), np.concatenate(counts)

    def _chunk(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(edges) - 1, np.int64)
        if len(self.known) > KEPT or self.used > KEPT_IDS:
            self._forget()
        cut = cuts(data, edges)
        for whole in self._whole(data, edges).tolist():
            cut[edges[whole] + 1 : edges[whole + 1]] = False
        at = np.flatnonzero(cut)
        offsets = np.append(at, len(data)).astype(np.int64)
        parts = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), parts).dictionary_encode()
        words = pieces.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.known])
        place = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        place = place[pieces.indices.to_numpy()]
        sizes = self.size[place]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.first[place] - ends + sizes, sizes) + np.arange(ends[-1])]
        before = np.concatenate(([0], ends))[np.searchsorted(at, edges)]
        return ids, np.diff(before)


def closed(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts with ``end_id`` behind each text."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1
