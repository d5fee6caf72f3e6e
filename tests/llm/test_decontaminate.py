"""Decontamination against a plain version of the same rules."""

import random
import re
from collections import Counter, defaultdict

import pytest

from bidweave.llm.decontaminate import NAME, UNIT, UNITS, contaminated, leaks, without_leaks

DOCS = "doc_id bigint, text string, item_id string, window string, pos string"
ITEMS = "item_id bigint, text string, doc_id string"
DENSE = "\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e7f"


def plain_tokens(text):
    text = re.sub(r"\s+", " ", text or "")
    text = re.sub(
        r"(?i)(\d) ?((?:" + "|".join(UNITS) + r")(?![^\W_]))", r"\1 " + UNIT + r"\2", text
    )
    text = re.sub(r"(?<=[a-zà-ÿ0-9,;:)] )([A-ZÀ-Þ][^\W\d_]+)", NAME + r"\1", text)
    return re.findall(rf"[{DENSE}]|[{NAME}{UNIT}]?(?:(?![{DENSE}])[^\W\d_])+|\d+(?:[.,:/]\d+)*", text)


def bare(t):
    return t.lstrip(NAME + UNIT).lower()


def kind(t):
    return 1 if t[0] == NAME else 2 if t[0] == UNIT else 3 if t[0].isdigit() else t.lower()


def windows(text, width, min_words):
    """(template or plain or literal, place, window, slots)"""
    t = plain_tokens(text)
    for i in range(len(t) - width + 1):
        part = t[i : i + width]
        slots = [x if isinstance(kind(x), int) else None for x in part]
        numbers = [None if x and x[0] == NAME else x for x in slots]
        if sum(s is None for s in slots) >= min_words:
            yield True, i, tuple(map(kind, part)), slots
        if sum(s is None for s in numbers) < min_words:
            yield False, i, ("literal", *map(bare, part)), [None] * width
        elif numbers != slots:
            yield True, i, tuple(bare(x) if x[0] == NAME else kind(x) for x in part), numbers


def plain_leaks(docs, items, width=8, min_words=5, min_share=0.5, min_windows=13):
    index, total, short = defaultdict(list), defaultdict(lambda: (set(), set())), []
    for item_id, text in sorted(set(items), key=str):
        if item_id is None:
            continue
        words = [bare(t) for t in plain_tokens(text)]
        if 0 < len(words) < width:
            short.append((item_id, words))
        for template, pos, window, slots in windows(text, width, min_words):
            index[window].append((item_id, pos, slots, template))
            total[item_id][0].add(pos)
            if template:
                total[item_id][1].add(pos)
    found = {}
    hits = defaultdict(lambda: (set(), set()))
    for doc_id, text in {(d, t) for d, t in docs if d is not None}:
        runs = defaultdict(list)
        for _, pos, window, slots in windows(text, width, min_words):
            for item_id, at, wanted, template in index.get(window, ()):
                pairs = tuple((w, s, at + i) for i, (w, s) in enumerate(zip(wanted, slots)) if w and s)
                runs[item_id, pos - at].append((at, template, pairs))
        for (item_id, _), met in runs.items():
            places = defaultdict(set)
            for _, _, pairs in met:
                for w, s, place in pairs:
                    places[w, s].add(place)
            best = defaultdict(tuple)
            for (w, s), at in places.items():
                best[w] = max(best[w], (len(at), w == s, s))
            for at, template, pairs in met:
                if all(w == s for w, s, _ in pairs) or all(best[w][2] == s for w, s, _ in pairs):
                    hits[doc_id, item_id][0].add(at)
                    if template:
                        hits[doc_id, item_id][1].add(at)
        words = [bare(t) for t in plain_tokens(text)]
        for item_id, wanted in short:
            inside = any(words[i : i + len(wanted)] == wanted for i in range(len(words)))
            if words == wanted or len(wanted) >= 4 and inside:
                found[doc_id, item_id] = 1
    for (doc_id, item_id), (places, templates) in hits.items():
        every, typed = total[item_id]
        share = max(len(places) / len(every), len(templates) / len(typed) if typed else 0)
        if len(places) >= min_windows or share >= min_share:
            found[doc_id, item_id] = len(places)
    return {(d, i, n) for (d, i), n in found.items()}


QUESTION = (
    "If train leaves at noon and Alice buys 12 apples for 3.50 dollars while Bob takes 12 pears "
    "then how many apples does Alice hold after 7 days"
)
OTHER = QUESTION.replace("Alice", "Carla").replace("12", "30").replace("7 days", "9 weeks")
UNFIT = QUESTION.replace("12 pears", "13 pears").replace("Alice hold", "Dora hold")


def tables(spark):
    rng = random.Random(2)
    words = [f"w{chr(97 + i)}x" for i in range(26)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    items = [(1, QUESTION), (2, prose(40)), (3, "too short"), (4, None), (5, prose(15)), (2, None)]
    items += [items[1], (None, prose(20)), (6, "1 2 3 4 5 6 7 8 9 10")]
    docs = [
        (10, f"{prose(30)}. {QUESTION}. {prose(9)}"),
        (11, f"{prose(30)} {OTHER} {prose(9)}"),
        (12, f"{prose(3)} {UNFIT}"),
        (13, prose(4000)),
        (14, f"{prose(50)} {items[1][1].upper()}"),
        (15, " ".join(items[1][1].split()[:25])),
        (16, " ".join(items[1][1].split()[:12])),
        (17, f"{items[4][1]} {prose(3)} {items[4][1]}"),
        (18, None),
        (19, ""),
        (None, QUESTION),
        (10, f"{prose(3)} {QUESTION}"),
        (20, (QUESTION + " ") * 200),
        (21, "1 2 3 4 5 6 7 8 9 10 11"),
    ]
    frame = spark.createDataFrame([(*d, "a", "b", "c") for d in docs], DOCS)
    return docs, items, frame, spark.createDataFrame([(*i, "d") for i in items], ITEMS)


def test_matches_plain_version(spark):
    docs, items, frame, bench = tables(spark)
    want = plain_leaks(docs, items)
    found = {(r.doc_id, r.item_id, r.n_windows) for r in leaks(frame, bench).collect()}
    assert found == want
    assert {d for d, _, _ in found} == {10, 11, 14, 15, 17, 20, 21}


def test_documents(spark):
    docs, _, frame, bench = tables(spark)
    assert {tuple(r.item_ids) for r in contaminated(frame, bench).where("doc_id = 11").collect()} == {(1,)}
    left = without_leaks(frame, bench)
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {12, 13, 16, 18, 19, None}


def test_empty_tables(spark):
    _, _, frame, bench = tables(spark)
    assert leaks(frame.limit(0), bench).count() == 0
    assert without_leaks(frame, bench.limit(0)).count() == frame.count()


def found_in(spark, docs, items, **options):
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r.n_windows for r in leaks(frame, bench, **options).collect()}


def test_one_edited_value_rejects_its_own_windows_only(spark):
    words = lambda a, n: " ".join(f"w{a}{chr(97 + i)}" for i in range(n))
    words = lambda a, n, w=words: w(a, n).replace("0", "x").replace("1", "y").replace("2", "z")
    item = f"{words(0, 20)} 12 {words(1, 20)} 12 {words(2, 20)}"
    edited = item[::-1].replace("21 ", "31 ", 1)[::-1]
    changed = item.replace(" 12 ", " 30 ", 1).replace(" 12 ", " 45 ", 1)
    # 62 tokens: 55 windows, 8 of them over each number.
    assert found_in(spark, [item, edited, changed], [item]) == {(0, 0): 55, (1, 0): 47, (2, 0): 47}


NAMED = "the shop in which Berta Keller met Anton sold 7 kg of flour while Conrad Meyer and Dora waited outside for long"


@pytest.mark.parametrize(
    "item, copy",
    [
        (NAMED, NAMED.lower()),
        (NAMED, NAMED.title()),
        (NAMED.lower(), NAMED.title()),
        (NAMED, "\n ".join(NAMED.split(" "))),
        (NAMED, NAMED.replace(" ", "  ").replace("  met", "\u00a0met")),
        ("Who wrote the Song of Wuv", "He asked: who wrote the song of wuv? Nobody knew."),
        ("12 + 30 / 7 = 4.5 and 8 * 9 - 2 = 70", "so 12 + 30 / 7 = 4.5 and 8 * 9 - 2 = 70."),
        ("3 5 8 13 21 34 55", "The row 3 5 8 13 21 34 55 goes on"),
        ("列車は正午に出発し三時間後に到着しますか", "問い：列車は正午に出発し三時間後に到着しますか。"),
        ("何時に着く", "では何時に着くのか"),
        ("Yes, it is", "yes it is"),
    ],
)
def test_copies_are_found(spark, item, copy):
    docs = [f"some words before it. {copy} and some behind", copy, "some words before it and some behind"]
    short = len(plain_tokens(item)) < 4
    found = found_in(spark, docs, [item])
    assert {d for d, _ in found} == ({1} if short else {0, 1})
    assert plain_leaks(list(enumerate(docs)), [(0, item)]) == {(d, i, n) for (d, i), n in found.items()}


def test_other_numbers_in_dense_items_are_other_items(spark):
    item = "12 + 30 / 7 = 4.5 and 8 * 9 - 2 = 70"
    assert found_in(spark, [item.replace("30", "31").replace("9", "8"), "1 2 3"], [item, "1 2 4"]) == {}


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_match_the_plain_version(spark, seed):
    rng = random.Random(seed)
    parts = ["alpha", "beta", "gamma", "delta", "Karl", "Lena", "12", "7", "3.5", "5 km", "9 days", "of", "Of", "中", "文"]

    def text(n):
        return rng.choice([" ", " ", "  ", "\n"]).join(rng.choices(parts, k=n))

    def edited(value):
        words = value.split(" ")
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(parts)
        return rng.choice([str, str.lower, str.title, str.upper])(rng.choice([" ", "  "]).join(words))

    items = [(i, text(rng.choice([2, 3, 5, 7, 9, 12, 30, 60]))) for i in range(25)]
    docs = [(i, " ".join([text(5), edited(rng.choice(items)[1]), text(4)])) for i in range(120)]
    docs += [(200 + i, edited(t)) for i, t in items] + [(3, items[0][1]), (3, items[1][1])]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = Counter((r.doc_id, r.item_id, r.n_windows) for r in leaks(frame, bench).collect())
    assert set(found) == plain_leaks(docs, items) and set(found.values()) == {1} and len(found) > 40


def test_values_of_other_texts_with_the_same_id_do_not_conflict(spark):
    item = "if you buy 12 apples and 30 pears for the whole class then who pays the bill in the end"
    docs = [(1, item), (1, item.replace("12", "40")), (1, item.replace("12", "50"))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    n = len(plain_tokens(item)) - 7
    assert [(r.doc_id, r.n_windows) for r in leaks(frame, bench).collect()] == [(1, n)]


def test_texts_are_not_shuffled(spark, monkeypatch):
    _, _, frame, bench = tables(spark)
    plan = without_leaks(frame, bench)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
