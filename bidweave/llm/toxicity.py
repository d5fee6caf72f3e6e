"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: compatibility forms, homoglyphs and digit substitutions
become plain letters. The lexicon's words and word beginnings, each with a
weight, are learned from labelled documents; phrases of an exception list, in
part learned from the clean ones, hide the entries inside them. The weights found are set against the text's length
and turned into a probability by a logistic curve fitted to the same labels.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.llm.common import smallest_hashes, staged

#: Characters that stand in for Latin letters.
CYRILLIC = dict(zip("авекмнорстухіѕјԁ", "abekmhopctyxisjd", strict=True))
GREEK = dict(zip("αβεικνορτυχ", "abeikvoptux", strict=True))
DIGITS = dict(zip("013457@$", "oieastas", strict=True))
#: l, i and 1 are one letter, since 1 stands for both.
_FOLD = str.maketrans({**CYRILLIC, **GREEK, **DIGITS, "l": "i", "ı": "i"})
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
#: Toxic documents of the sample that must hold an entry, however large the sample is.
SUPPORT = 5
#: Odds, as a logarithm, and clean documents for each toxic one that an entry must reach.
ODDS, CLEAN_SHARE = 3.0, 0.02
#: Phrases known to be harmless; others are learned.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "stupid simple")


def fold(text: str | None) -> str:
    """Lower-case text without compatibility forms, homoglyphs and digit substitutions.

    >>> fold("1D10T") == fold("idiot")
    True
    """
    if not text:
        return ""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(_FOLD)


def terms(folded: str) -> set[str]:
    """Distinct words, as ``word$``, and word beginnings."""
    words = set(_WORD.findall(folded))
    found = {w + "$" for w in words}
    for n in PREFIXES:
        found.update(w[:n] for w in words if len(w) >= n)
    return found


@dataclass(frozen=True)
class Model:
    """``lexicon``: weight of each term as ``terms`` writes it; ``curve``: logistic coefficients."""

    lexicon: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-20.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS

    def key(self) -> tuple:
        return tuple(sorted(self.lexicon.items())), self.exceptions


@lru_cache(maxsize=4)
def automaton(key: tuple) -> ahocorasick.Automaton:
    lexicon, exceptions = key
    found: dict[str, list] = {}
    for term, weight in lexicon:
        found.setdefault(term.rstrip("$"), []).append((term.endswith("$"), weight))
    for phrase in exceptions:
        found.setdefault(fold(phrase), []).append((True, None))
    built = ahocorasick.Automaton()
    for text, entries in found.items():
        built.add_word(text, (len(text), tuple(entries)))
    built.make_automaton()
    return built


def weight_of(folded: str, key: tuple) -> float:
    """Total weight of the lexicon entries in a folded text."""
    if not any(key):
        return 0.0
    hits, hidden, size = [], [], len(folded)
    for last, (length, entries) in automaton(key).iter(folded):
        start, stop = last - length + 1, last + 1
        if start and folded[start - 1].isalpha():
            continue
        ends = stop == size or not folded[stop].isalpha()
        for whole, weight in entries:
            if whole and not ends:
                continue
            if weight is None:
                hidden.append((start, stop))
            else:
                hits.append((start, weight))
    if not hidden:
        return sum(w for _, w in hits)
    starts = np.array([a for a, _ in hidden])
    stops = np.array([b for _, b in hidden])
    return sum(w for at, w in hits if not ((starts <= at) & (at < stops)).any())


def features(text: str | None, key: tuple) -> tuple[float, float]:
    """Weight found, damped, and weight against the text's length."""
    folded = fold(text)
    weight = weight_of(folded, key)
    return float(np.log1p(weight)), float(weight / np.sqrt(1 + folded.count(" ")))


def logistic(x: np.ndarray, curve: tuple[float, ...]) -> np.ndarray:
    z = curve[0] + x @ np.array(curve[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, ...]:
    """Logistic regression by Newton's method."""
    if not len(y) or not y.any():
        return Model.curve
    wide = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(wide.shape[1])
    keep = ridge * np.diag([0.01, 1, 1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(wide @ beta, -30, 30)))
        slope = wide.T @ (y - p) - keep @ beta
        bend = (wide * (p * (1 - p))[:, None]).T @ wide + keep
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def pick_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Terms that mark toxic documents, the most specific one of each family.

    ``counts`` has (term, toxic documents, clean documents).
    """
    scored = []
    for term, a, b in counts:
        odds = np.log((a + 0.5) / (toxic - a + 0.5)) - np.log((b + 0.5) / (clean - b + 0.5))
        if odds >= ODDS and b <= CLEAN_SHARE * a:
            scored.append((a, term, float(odds)))
    # Most documents first; of equals the longest, so that a beginning is no wider than need be.
    scored.sort(key=lambda s: (-s[0], -len(s[1]), s[1]))
    kept: dict[str, tuple[int, float]] = {}
    for a, term, odds in scored:
        bare = term.rstrip("$")
        inside = any(bare[:n] in kept for n in PREFIXES if n <= len(bare))
        wider = not term.endswith("$") and any(
            k.startswith(bare) and a <= 1.05 * n for k, (n, _) in kept.items()
        )
        if not inside and not wider:
            kept[term] = (a, odds)
    return {term: odds for term, (_, odds) in kept.items()}


def covering(lexicon: dict[str, float], found: list[list[str]]) -> dict[str, float]:
    """The entries that reveal toxic documents of their own.

    ``found`` has the entries of each toxic document. Entries are taken by the
    number of documents not revealed by the ones before; words that only keep
    company with toxic ones, as in near copies, add none and go.
    """
    holders: dict[str, set[int]] = {}
    for i, entries in enumerate(found):
        for term in entries:
            holders.setdefault(term, set()).add(i)
    order = sorted(holders, key=lambda t: (-len(holders[t]), -len(t), t))
    kept, seen = {}, set()
    for term in order:
        new = len(holders[term] - seen)
        if new >= 2:
            kept[term] = lexicon[term]
            seen |= holders[term]
    return kept


def phrases(folded: str, lexicon: dict[str, float]) -> set[str]:
    """Pairs of neighbouring words of which one is an entry."""
    words = _WORD.findall(folded)
    marked = [bool(lexicon.keys() & ({w + "$"} | {w[:n] for n in PREFIXES if len(w) >= n})) for w in words]
    pairs = zip(words, words[1:], marked, marked[1:])
    return {f"{a} {b}" for a, b, x, y in pairs if x or y}


def pick_exceptions(clean: list[list[str]], toxic: list[list[str]]) -> list[str]:
    """Phrases around entries that at least ``SUPPORT`` clean documents have and no toxic one."""
    seen = Counter(p for found in clean for p in found)
    seen_toxic = {p for found in toxic for p in found}
    return sorted(p for p, n in seen.items() if n >= SUPPORT and p not in seen_toxic)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from; those without doc_id have none and are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = 5_000,
    clean_rows: int = 10_000,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    """Model of the ``toxic`` labels of documents that are not held out.

    Learns from the ``toxic_rows`` and ``clean_rows`` labelled documents with
    the smallest hashes of their id, a bound that keeps training small on any
    corpus. Several labels of one document count as toxic if any does; null
    labels and texts are left out. An entry needs ``SUPPORT`` toxic documents,
    however many there are, odds and a small share of clean ones. Without a
    toxic label the model scores all texts near 0.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    toxic = smallest_hashes(known.where("toxic = 1"), ["id"], toxic_rows)
    clean = smallest_hashes(known.where("toxic = 0"), ["id"], clean_rows)
    # Staged, so that Spark sees how small it is and broadcasts it: the texts are not shuffled.
    ids = staged(toxic.unionAll(clean), "toxicity-ids")
    picked = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("id"))
    picked = picked.where(F.col("text").isNotNull()).select("text", "toxic").distinct()
    sample = staged(picked, "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(label)].update(terms(fold(text)))
            for label, found in seen.items():
                yield pd.DataFrame({"term": list(found), "toxic": label, "n": list(found.values())})

    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (n_toxic - a + 0.5)) - F.log((b + 0.5) / (n_clean - b + 0.5))
    counted = (
        sample.mapInPandas(count, "term string, toxic int, n bigint")
        .groupBy("term")
        .agg(
            F.sum(F.expr("IF(toxic = 1, n, 0)")).alias("a"),
            F.sum(F.expr("IF(toxic = 0, n, 0)")).alias("b"),
        )
        .where((a >= SUPPORT) & (b <= CLEAN_SHARE * a))
        .where(odds >= ODDS - 1e-6)
    )
    # Bounded by the sample, and by tests that words of chance do not pass.
    lexicon = pick_lexicon([tuple(r) for r in counted.collect()], n_toxic, n_clean)

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(terms(fold(t)) & lexicon.keys()) for t in batch["text"]]
            yield pd.DataFrame({"found": found})

    rows = sample.where("toxic = 1").mapInPandas(look_up, "found array<string>").collect()
    lexicon = covering(lexicon, [r.found for r in rows])

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(phrases(fold(t), lexicon)) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "found": found})

    rows = sample.mapInPandas(around, "toxic int, found array<string>").where(F.size("found") > 0).collect()
    learned = pick_exceptions([r.found for r in rows if not r.toxic], [r.found for r in rows if r.toxic])
    exceptions = (*exceptions, *(p for p in learned if p not in exceptions))
    key = Model(lexicon, exceptions=exceptions).key()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t, key) for t in batch["text"]]
            yield pd.DataFrame(found, columns=["x1", "x2"]).assign(y=batch["toxic"].to_numpy())

    # The sample is bounded, so its order for the fit is made here.
    rows = sorted(sample.mapInPandas(measure, "x1 double, x2 double, y int").collect())
    x = np.array([[r.x1, r.x2] for r in rows]).reshape(-1, 2)
    return Model(lexicon, fit_curve(x, np.array([r.y for r in rows], float)), exceptions)


def with_toxicity(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the toxicity of the whole text, 0 to 1, in column ``name``.

    A null or empty text gets the score of a text in which nothing was found.
    All rows and columns stay; a column of that name is replaced.
    """
    key, curve = model.key(), model.curve

    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t, key) for t in texts]).reshape(-1, 2)
        return pd.Series(logistic(x, curve))

    return docs.withColumn(name, F.pandas_udf(score, "double")("text"))
