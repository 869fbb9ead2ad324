"""Near-duplicates against all pairs on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import graph, near_duplicates


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    width = min(5, len(words))
    return frozenset((width, *words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows):
    sets = [(d, shingle_set(t)) for d, t in rows]
    label = {d: d for d, _ in rows}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (d, x) in enumerate(sets):
        for e, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((root(d), root(e)))
                label[b] = a
    return sorted((d, len(x), root(d), d == root(d)) for d, x in sets)


def edited(rng, words, share):
    return [w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words]


def rows_of_groups(seed=1):
    rng = random.Random(seed)
    rows = []
    for size in (1, 1, 2, 7, 60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 300))]
        rows += [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.05, 0.1]))) for _ in range(size)]
    # A chain: each is like the next, the ends are unlike.
    base = [f"c{i}" for i in range(120)]
    rows += [" ".join(base[9 * k : 9 * k + 60]) for k in range(7)]
    rows += ["", " \n\t", "one", "ONE", "one two", "a b c d e", "a b c d e f", None, "É a b c d", "é a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_matches_all_pairs(spark):
    rows = rows_of_groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS key", "1 AS n", "doc_id AS id")
    got = near_duplicates.near_duplicates(docs.repartition(4))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, _, _, k in brute(rows) if k]


def test_alike_but_not_enough_is_tiled(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK_BYTES", 8 * 400)
    monkeypatch.setattr(near_duplicates, "HUB_ROUNDS", 1)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(160)]
    rows = list(enumerate(" ".join(edited(rng, base, rng.choice([0.01, 0.04, 0.07]))) for _ in range(90)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert 10 < len({c for _, _, c, _ in want}) < 85
    assert sorted(tuple(r) for r in near_duplicates.near_duplicates(docs).collect()) == want


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in near_duplicates.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 3, 1, True)] * 2 + [(None, 3, None, True), (2, 3, 1, False), (3, 0, 3, True)], key=repr)
    assert sorted(repr(r.doc_id) for r in near_duplicates.one_of_each(docs).collect()) == ["1", "3", "None"]


def test_unlike_texts_of_one_id_stay(spark):
    rows = [(1, "a b c d e f g", 5), (1, "quite another text of this id", 6), (1, "a b c d e f g", 7), (2, "a b c d e f g", 8),
            (None, "x", 1), (None, "x", 2), (3, None, 3), (3, "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank long").withColumn("own_id", F.lit(0))
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(1, rows[0][1]), (1, rows[1][1]), (None, "x"), (None, "x"), (3, None), (3, "")], key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_sketch_fills_every_place_and_estimates():
    rng = np.random.default_rng(3)
    for size in (1, 2, 10, 128, 5000):
        items = rng.integers(0, 2**63, size, dtype=np.uint64)
        assert (near_duplicates.sketch(items) != np.iinfo(np.uint64).max).all()
        assert (near_duplicates.sketch(rng.permutation(items)) == near_duplicates.sketch(items)).all()
    found = []
    for _ in range(200):
        items = rng.integers(0, 2**63, 250, dtype=np.uint64)
        a, b = near_duplicates.sketch(items[:200]), near_duplicates.sketch(items[50:])
        found.append((a == b).mean())
    assert abs(np.mean(found) - 0.6) < 0.02


@pytest.mark.parametrize("links", [[(1, 2)], [(i, i + 1) for i in range(40)], [(5, 9), (9, 7), (3, 4), (0, i := 8)]])
def test_components(spark, links):
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {n: n for pair in links for n in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
