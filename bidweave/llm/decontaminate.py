"""Benchmark decontamination by canonical templates.

Texts become token templates: numbers, names and units turn into typed
placeholders, all other words are lower-cased. Windows of template tokens are
hash-joined with those of the benchmark, and aligned windows count if they fill
the placeholders consistently: one benchmark value, one value in the document. So a
question is found again with other numbers or names in it.

Beside each window with names stands a plain one that takes them as lower-cased
words, so a copy in other letters is found as well. Windows with too few words
for a template are joined literally, numbers and all, and so are items shorter
than a window. Scripts without spaces are read character by character.
DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidweave.llm.common import staged

NAME, UNIT = "\u0001", "\u0002"
#: Units of measure that count as placeholders after a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb lbs oz ml cl dl l ms s sec min h hr hrs day days week "
    "weeks month months year years hz khz mhz ghz b kb mb gb tb v w kw mw a ma k c f kmh mph percent "
    "dollars euros cents meters metres kilometers kilometres miles hours minutes seconds grams "
    "kilograms liters litres degrees"
).split()
_NAMES = r"(?<=[\p{Ll}\p{N},;:)])[\s\p{Z}]+(?=\p{Lu}\p{L})"
_UNITS = r"(?i)(?<=\d)[\s\p{Z}]*(?=(?:" + "|".join(UNITS) + r")(?![\p{L}\p{N}]))"
#: Blocks of scripts that are written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han).
_DENSE = (
    r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"
)
_TOKENS = rf"[{NAME}{UNIT}]?\p{{L}}[\p{{L}}\p{{M}}]*|\d+(?:[.,:/]\d+)*"
#: Items of fewer tokens say too little to be looked for inside of a text.
LEAST_TOKENS = 4

ITEM = "item_id"
RUN = ["doc_id", "text_id", ITEM, "shift"]


def tokens(text: Column) -> Column:
    """Words and numbers in order; names and units carry a mark in front."""
    text = F.coalesce(text, F.lit(""))
    dense = (F.octet_length(text) > F.char_length(text)) & text.rlike(_DENSE)
    spaced = F.when(dense, F.regexp_replace(text, f"({_DENSE})", " $1 ")).otherwise(text)
    # Units first: behind a number a capital letter does not make one a name.
    marked = F.regexp_replace(spaced, _UNITS, " " + UNIT)
    marked = F.regexp_replace(marked, _NAMES, " " + NAME)
    return F.regexp_extract_all(marked, F.lit(_TOKENS), F.lit(0))


def _is_number(token: Column) -> Column:
    return (token >= F.lit("0")) & (token < F.lit(":"))


def _is_slot(token: Column) -> Column:
    """Numbers, names and units; the marks are below all other characters."""
    return (token < F.lit("\u0003")) | _is_number(token)


def _bare(token: Column) -> Column:
    return F.xxhash64(F.lower(F.ltrim(token, F.lit(NAME + UNIT))))


def _template(token: Column) -> Column:
    """64-bit code of a template token: 1, 2, 3 for name, unit and number."""
    return (
        F.when(token.startswith(NAME), F.lit(1))
        .when(token.startswith(UNIT), F.lit(2))
        .when(_is_number(token), F.lit(3))
        .otherwise(F.xxhash64(F.lower(token)))
        .cast("long")
    )


def _plain(token: Column) -> Column:
    """Like a template token, but a name is its lower-cased word."""
    return F.when(token.startswith(NAME), _bare(token)).otherwise(_template(token))


TYPED, PLAIN, LITERAL = 0, 1, 2
_WINDOW = "array<struct<kind:int,pos:int,window:bigint,slots:array<string>,heads:array<bigint>>>"


def _around(condition, width: int) -> Column:
    """Places of the windows that hold a token for which ``condition`` is true."""
    last = F.size("tokens") - width
    at = F.filter(F.sequence(F.lit(0), F.size("tokens") - 1), lambda i: condition(F.get("tokens", i)))
    spans = F.transform(at, lambda i: F.sequence(F.greatest(i - (width - 1), F.lit(0)), F.least(i, last)))
    none = F.array().cast("array<int>")
    return F.when(last >= 0, F.array_distinct(F.flatten(spans))).otherwise(none)


def _heads(width: int) -> list[int]:
    """Places in a window whose tokens a sieve looks at."""
    return sorted({0, width // 2, width - 1})


def _windows(kind: int, width: int, places: Column, codes: Column, values: Column, heads: bool) -> Column:
    def window(i: Column) -> Column:
        first = F.array(*[F.get(codes, i + h) for h in _heads(width)]) if heads else F.lit(None).cast("array<bigint>")
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("pos"),
            F.xxhash64(F.slice(codes, i + 1, width)).alias("window"),
            F.slice(values, i + 1, width).alias("slots"),
            first.alias("heads"),
        )

    return F.transform(places, window)


#: Words of 64 bits in the sieve for each place, one for each value of a code's upper 11 bits.
SIEVE_WORDS = 1 << 11


def _word_and_bit(code: Column) -> tuple[Column, Column]:
    """Where a token's code stands in the sieve: by its upper 11 and its lower 6 bits."""
    return F.shiftrightunsigned(code, 53).cast("int"), code.bitwiseAND(F.lit(63)).cast("int")


def sieve_of(wanted: DataFrame, width: int) -> list[list[int]]:
    """For each of the places that a sieve looks at, the codes that windows have there, as bits.

    Of one size whatever the benchmark is: ``SIEVE_WORDS`` numbers a place. A
    large benchmark fills the sieve and it lets more through.
    """
    found = [[0] * SIEVE_WORDS for _ in _heads(width)]
    codes = wanted.where(F.col("item_kind") != LITERAL).select(F.posexplode("heads").alias("place", "code"))
    word, bit = _word_and_bit(F.col("code"))
    bits = F.expr("bit_or(shiftleft(1L, bit))").alias("bits")
    for row in codes.select("place", word.alias("word"), bit.alias("bit")).groupBy("place", "word").agg(bits).collect():
        found[row.place][row.word] = row.bits
    return found


def _passing(sieve: list[list[int]], codes: str, width: int, places: Column) -> Column:
    """Places of windows that the sieve lets through."""

    def passes(i: Column) -> Column:
        held = F.lit(True)
        for head, words in zip(_heads(width), sieve, strict=True):
            bits = F.expr("array(" + ", ".join(f"{w}L" if w > -(1 << 63) else "shiftleft(1L, 63)" for w in words) + ")")
            word, bit = _word_and_bit(F.get(codes, i + head))
            held = held & (F.getbit(F.get(bits, word), bit) == 1)
        return held

    return F.filter(places, passes)


def template_windows(
    texts: DataFrame,
    keys: list[str],
    width: int,
    min_words: int,
    literal: bool,
    sieve: list[list[int]] | None = None,
) -> DataFrame:
    """(keys, kind, pos, window, slots, heads) of the windows of ``width`` tokens.

    A typed window stands at every place, a plain one beside it where there are
    names, and with ``literal`` a literal one where numbers and units leave
    fewer than ``min_words`` other words. ``slots`` holds the placeholder values
    by their place in the window, and is null for a text without any. With a
    ``sieve`` only the typed and plain windows that it lets through are made,
    without ``heads``, the codes that a sieve is made of.
    """
    split = texts.select(*keys, tokens(F.col("text")).alias("tokens"))
    slot = F.exists("tokens", _is_slot)
    name = F.exists("tokens", lambda t: t.startswith(NAME))
    of = lambda code: F.transform("tokens", code)
    typed = split.select(
        *keys,
        "tokens",
        of(_template).alias("codes"),
        F.when(slot, of(lambda t: F.when(_is_slot(t), t))).alias("values"),
        F.when(name, of(_plain)).alias("plain"),
        F.when(name, of(lambda t: F.when(_is_slot(t) & ~t.startswith(NAME), t))).alias("plain_values"),
    )
    none, heads = F.array().cast(_WINDOW), sieve is None
    # A filter on the number of tokens would read the text once more.
    wide = F.size("tokens") >= width
    every = F.when(wide, F.sequence(F.lit(0), F.size("tokens") - width)).otherwise(F.array().cast("array<int>"))
    named = _around(lambda t: t.startswith(NAME), width)
    if sieve is not None:
        every, named = _passing(sieve, "codes", width, every), _passing(sieve, "plain", width, named)
    parts = [
        _windows(TYPED, width, every, F.col("codes"), F.col("values"), heads),
        F.when(
            F.col("plain").isNotNull(), _windows(PLAIN, width, named, F.col("plain"), F.col("plain_values"), heads)
        ).otherwise(none),
    ]
    if literal:
        most = width - min_words
        number = lambda t: _is_slot(t) & ~t.startswith(NAME)
        many = F.size(F.filter("tokens", number)) > most
        dense = F.filter(
            _around(number, width), lambda i: F.size(F.filter(F.slice("tokens", i + 1, width), number)) > most
        )
        nothing = F.lit(None).cast("array<string>")
        parts.append(F.when(many, _windows(LITERAL, width, dense, of(_bare), nothing, heads)).otherwise(none))
    return typed.select(*keys, F.inline(F.concat(*parts)))


def benchmark_windows(benchmark: DataFrame, width: int, min_words: int) -> DataFrame:
    """Windows of the items of at least ``width`` tokens, with the number of places of each.

    Typed and plain windows count if they hold at least ``min_words`` words
    beside the placeholders. A window of a document that equals one of these
    has as many. ``item_windows`` counts the places with a template,
    ``item_places`` all.
    """
    items = benchmark.where(F.col(ITEM).isNotNull()).select(ITEM, "text").distinct()
    windows = template_windows(items, [ITEM], width, min_words, True).withColumnRenamed("slots", "item_slots")
    filled = F.size(F.filter("item_slots", lambda v: v.isNotNull()))
    windows = windows.where(F.coalesce(filled, F.lit(0)) <= width - min_words)
    totals = windows.groupBy(ITEM).agg(
        F.count_distinct(F.when(F.col("kind") != LITERAL, F.col("pos"))).alias("item_windows"),
        F.count_distinct("pos").alias("item_places"),
    )
    return windows.withColumnsRenamed({"pos": "item_pos", "kind": "item_kind"}).join(totals, ITEM)


def short_items(benchmark: DataFrame, width: int) -> DataFrame:
    """(item_id, n, whole): items of fewer than ``width`` tokens, as the hash of their literal sequence."""
    items = benchmark.where(F.col(ITEM).isNotNull()).select(ITEM, tokens(F.col("text")).alias("tokens"))
    short = items.where(F.size("tokens").between(1, width - 1)).distinct()
    return short.select(
        ITEM, F.size("tokens").alias("n"), F.xxhash64(F.transform("tokens", _bare)).alias("whole")
    )


def _sequence_hash(n: int) -> Callable[[Column], Column]:
    return lambda i: F.xxhash64(F.slice("codes", i + 1, n))


def short_leaks(named: DataFrame, short: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, share) of documents that hold a short item.

    Items of at least ``LEAST_TOKENS`` tokens are held wherever their literal
    sequence stands; shorter ones by texts that are nothing else.
    """
    # As many numbers as a window has tokens, at most.
    lengths = sorted(r.n for r in short.select("n").distinct().collect())
    split = named.select("doc_id", F.transform(tokens(F.col("text")), _bare).alias("codes"))
    size, parts = F.size("codes"), []
    for n in lengths:
        if n < LEAST_TOKENS:
            parts.append(F.when(size == n, F.array(F.xxhash64("codes"))))
        else:
            places = F.sequence(F.lit(0), size - n)
            parts.append(F.when(size >= n, F.transform(places, _sequence_hash(n))))
    none = F.array().cast("array<bigint>")
    sequences = F.array_distinct(F.concat(none, *[F.coalesce(p, none) for p in parts]))
    met = split.select("doc_id", F.explode(sequences).alias("whole")).join(short, "whole")
    return met.select("doc_id", ITEM, F.lit(1).cast("bigint").alias("n_windows"), F.lit(1.0).alias("share")).distinct()


def _consistent(met: DataFrame) -> DataFrame:
    """The windows met, without those whose placeholders conflict.

    Of several document values for one item value in a run the one at most
    places counts, of equals the item's own. Windows with the item's own values
    always stay.
    """
    pairs = met.select(*RUN, "item_pos", "item_kind", F.explode("pairs").alias("p")).select(
        *RUN, "item_pos", "item_kind", "p.*"
    )
    votes = pairs.select(*RUN, "item", "doc", "place").distinct().groupBy(*RUN, "item", "doc").agg(
        F.count("*").alias("places")
    )
    best = F.max(F.struct("places", (F.col("item") == F.col("doc")).alias("own"), "doc"))
    kept = votes.groupBy(*RUN, "item").agg(best["doc"].alias("kept"))
    other = F.max((F.col("doc") != F.col("kept")).cast("int"))
    edited = F.max((F.col("doc") != F.col("item")).cast("int"))
    judged = pairs.join(kept, [*RUN, "item"]).groupBy(*RUN, "item_pos", "item_kind")
    conflict = judged.agg((other * edited).alias("bad")).where("bad = 1").drop("bad")
    return met.join(conflict, [*RUN, "item_pos", "item_kind"], "left_anti")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 8,
    min_words: int = 5,
    min_share: float = 0.5,
    min_windows: int = 13,
) -> DataFrame:
    """(doc_id, item_id, n_windows, share) of documents that hold a benchmark item.

    An item counts as held if at least ``min_share`` of its places, or of those
    with a template, or at least ``min_windows`` places are in the document
    with consistent placeholders; only the windows in conflict are left out.
    Items of fewer than ``width`` tokens are held if their literal sequence is
    found (below ``LEAST_TOKENS`` tokens: as the whole text). Items without
    any token are held by nobody. Null and empty texts hold nothing; rows
    without an id are left out; repeated rows are reported once. Texts that
    share a doc_id are looked at each on its own, and their places counted
    together. Other columns are ignored.
    """
    wanted = staged(benchmark_windows(benchmark, width, min_words), "benchmark-windows")
    short = staged(short_items(benchmark, width), "benchmark-short")
    named = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_id"), "text"
    )
    # The benchmark is staged, so Spark knows its size and broadcasts it only if small.
    literal = not wanted.where(F.col("item_kind") == LITERAL).isEmpty()
    made = template_windows(named, ["doc_id", "text_id"], width, min_words, literal, sieve_of(wanted, width))
    met = made.drop("heads").join(wanted.drop("heads"), "window")
    both = F.transform(
        F.arrays_zip(F.col("item_slots").alias("item"), F.col("slots").alias("doc")),
        lambda p, i: F.struct(
            p["item"].alias("item"), p["doc"].alias("doc"), (F.col("item_pos") + i).alias("place")
        ),
    )
    pairs = F.filter(both, lambda p: p["item"].isNotNull() & p["doc"].isNotNull())
    met = met.select(
        "doc_id",
        "text_id",
        ITEM,
        (F.col("pos") - F.col("item_pos")).alias("shift"),
        "item_pos",
        "item_kind",
        "item_windows",
        "item_places",
        F.coalesce(pairs, F.array()).alias("pairs"),
    )
    met = staged(met, "windows-met")
    item = ["doc_id", ITEM, "item_windows", "item_places"]
    template = (F.col("item_kind") != LITERAL).cast("int")
    places = _consistent(met).groupBy(*item, "item_pos").agg(F.max(template).alias("template"))
    found = places.groupBy(*item).agg(F.count("*").alias("n_windows"), F.sum("template").alias("n_templates"))
    shares = [
        F.col("n_windows") / F.col("item_places"),
        F.when(F.col("item_windows") > 0, F.col("n_templates") / F.col("item_windows")),
    ]
    held = (
        found.withColumn("share", F.greatest(*shares))
        .where((F.col("share") >= min_share) | (F.col("n_windows") >= min_windows))
        .select("doc_id", ITEM, "n_windows", "share")
    )
    if short.isEmpty():
        return held
    return held.unionAll(short_leaks(named, short))


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_ids, n_windows) of each document that holds a benchmark item."""
    return (
        leaks(docs, benchmark, **options)
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("item_ids"),
            F.sum("n_windows").alias("n_windows"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    # Staged, so that a short list is seen to be short and broadcast: the texts are not shuffled.
    found = staged(leaks(docs, benchmark, **options).select(F.col("doc_id").alias("__leak")).distinct(), "leaks")
    return docs.join(found, F.col("doc_id") == F.col("__leak"), "left_anti")
