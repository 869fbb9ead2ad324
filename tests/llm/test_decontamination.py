"""Benchmark passages against a search of every window in every document."""

import random
import unicodedata

import numpy as np

from quern.llm import decontamination as dec


def words(rng, n):
    return " ".join("".join(rng.choice(["th", "on", "er", "an", "é", "x"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "z"])
    return "".join(chars)


def distance(window, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[-1] + 1))
    return min(row)


def brute(docs, items):
    found = {}
    for item, text in items:
        index = dec.build_index([(item, text)])
        for doc, content in docs:
            data = dec.normal(content)
            for window, budget in zip(index.texts, index.edits) if index else ():
                edits = distance(window, data)
                if edits <= budget:
                    found[doc, item] = min(edits, found.get((doc, item), 99))
    return found


def test_matches_search_of_all_windows(spark):
    rng = random.Random(6)
    items = [(i, words(rng, rng.randrange(6, 40))) for i in range(8)] + [(8, "too short"), (9, None), (10, "")]
    docs = []
    for i in range(60):
        parts = [words(rng, rng.randrange(30))]
        if i % 2:
            text = items[rng.randrange(8)][1]
            parts.append(edited(rng, text.upper() if i % 3 else text, rng.randrange(len(text) // 12 + 2)).replace(" ", "\n "))
        docs.append((i, " ".join([*parts, words(rng, rng.randrange(30))])))
    docs += [(60, None), (61, ""), (62, "th" * 400)]
    want = brute(docs, items)
    assert len(want) > 10
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS `end`")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS doc_id")
    got = {(r.doc_id, r.item_id): r.edits for r in dec.contamination(frame.repartition(3), bench).collect()}
    assert got == want
    clean = dec.without_contamination(frame, bench)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, words(rng, 30)) for i in range(30)]
    docs = spark.createDataFrame(
        [(i, words(rng, 20) + " " + items[i % 30][1]) for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dec.contamination(docs, bench).collect()))
    monkeypatch.setattr(dec, "PASS_BYTES", 600)
    monkeypatch.setattr(dec, "GROUP_BYTES", 500)
    assert sorted(map(tuple, dec.contamination(docs, bench).collect())) == whole
    assert dec.without_contamination(docs, bench).count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.contamination(docs, none).count() == 0
    assert dec.without_contamination(docs, none).count() == 1
    bench = spark.createDataFrame([(1, "some words of an item")], "item_id long, text string")
    assert dec.contamination(docs.filter("false"), bench).count() == 0


def test_qgram_codes_tell_grams_apart():
    data = b"abcdefghijklmnopabcdefghijklXnop"
    codes = dec.qgrams(np.frombuffer(data, np.uint8))
    grams = [data[i : i + dec.Q] for i in range(len(data) - dec.Q + 1)]
    assert len(codes) == len(grams) and len(set(codes.tolist())) == len(set(grams))


def test_case_of_all_letters_is_folded(spark):
    item = "Élève à l'école où la forêt brûlée règne : déjà près du chêne, l'été créa çà et là des lièvres gênés, straße"
    forms = [item.upper(), unicodedata.normalize("NFD", item.upper()), item.title(), item]
    docs = spark.createDataFrame([(i, f"x1 y2 {t} z3") for i, t in enumerate(forms)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, item.upper())], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits) for r in dec.contamination(docs, bench).collect())
    assert got == [(d, i, 0) for d in range(4) for i in (7, 8)]
    assert dec.without_contamination(docs, bench).count() == 0


def test_excerpts_of_longer_items_are_found(spark):
    """Excerpts of 104 bytes and more hold a whole window wherever they begin."""
    rng = random.Random(13)
    items = [(i, words(rng, 120)) for i in range(10)]
    docs = []
    for i in range(80):
        text = items[i % 10][1]
        at = rng.randrange(len(text) - 110)
        docs.append((i, words(rng, 12) + " " + text[at : at + 104 + i % 5] + " " + words(rng, 12)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dec.contamination(frame, bench).collect()}
    assert found >= {(i, i % 10) for i in range(80)}
