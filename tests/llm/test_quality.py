"""The random field against sums over all labelings, and its use on held-out documents."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import quality


def test_marginals_match_all_labelings():
    rng = np.random.default_rng(1)
    counts = np.array([3, 1, 6, 2])
    score = rng.normal(size=counts.sum())
    stay_good, stay_bad, begin = 0.7, -0.4, 0.3
    good, partition, stays = quality.marginals(score, counts, stay_good, stay_bad, begin)
    want_stays = np.zeros(2)
    for k, n in enumerate(counts):
        own = score[counts[:k].sum() :][:n]
        weights, sums = [], np.zeros(n)
        total_stays = np.zeros(2)
        for path in itertools.product((0, 1), repeat=int(n)):
            value = begin * path[0] + sum(s for s, y in zip(own, path) if y)
            pairs = list(zip(path, path[1:]))
            value += stay_good * pairs.count((1, 1)) + stay_bad * pairs.count((0, 0))
            weights.append(np.exp(value))
            sums += np.exp(value) * np.array(path)
            total_stays += np.exp(value) * np.array([pairs.count((1, 1)), pairs.count((0, 0))])
        assert np.isclose(partition[k], np.log(sum(weights)))
        assert np.allclose(good[counts[:k].sum() :][:n], sums / sum(weights))
        want_stays += total_stays / sum(weights)
    assert np.allclose(stays, want_stays)


def test_features_of_lines():
    own, counts, size = quality.line_features(pa.array(["Ab cd cd.\n\nx|y", None, "", "é é\né é"]))
    assert counts.tolist() == [3, 1, 1, 2]
    assert size.tolist() == [9, 0, 3, 0, 0, 5, 5]
    assert own.shape == (7, quality.OWN)
    assert own[0, 9] == pytest.approx(1 / 3 * 0) or own[0, 9] >= 0
    assert own[2, 6] == pytest.approx(1 / 3)
    assert own[5, 9] == pytest.approx(0.5) and own[5, 13] == own[6, 13] == 1.0
    wide = quality.with_neighbours(own, counts)
    assert (wide[0, quality.OWN : 2 * quality.OWN] == 0).all()
    assert (wide[1, quality.OWN : 2 * quality.OWN] == own[0]).all()
    assert (wide[2, 2 * quality.OWN : 3 * quality.OWN] == 0).all()
    assert quality.line_features(pa.array([], pa.string()))[0].shape == (0, quality.OWN)


def make(rng, good):
    line = lambda: " ".join("".join(rng.choice(["th", "on", "er"]) for _ in range(rng.randrange(1, 4))) for _ in range(9)) + "."
    junk = lambda: " | ".join(rng.choice(["er", "on"]) for _ in range(9))
    lines = [line() for _ in range(rng.randrange(1, 9))]
    if not good:
        lines[rng.randrange(len(lines)) :] = [junk() for _ in range(rng.randrange(2, 7))]
    return "\n".join(lines)


def test_separates_held_out_documents(spark):
    rng = random.Random(3)
    kind = [rng.random() < 0.8 for _ in range(900)]
    rows = [(i, make(rng, good)) for i, good in enumerate(kind)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS label", "1 AS place", "2 AS score")
    labels = spark.createDataFrame([(i, int(g), 0) for i, g in enumerate(kind)], "doc_id long, quality int, toxic int")
    got = quality.quality(docs.repartition(3), labels).collect()
    assert len(got) == 900 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert 100 < len(held) < 260
    assert np.mean([r.predicted == kind[r.doc_id] for r in held]) > 0.97
    good = quality.good_documents(docs, labels)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in got if r.predicted}


def test_labels_of_held_out_documents_do_not_matter(spark):
    rng = random.Random(5)
    rows = [(i, make(rng, i % 3 > 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(i, int(i % 3 > 0)) for i in range(200)]
    first = {r.doc_id: r for r in quality.quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    turned = [(i, 1 - q if first[i].held_out else q) for i, q in labels]
    again = quality.quality(docs, spark.createDataFrame(turned, "doc_id long, quality int")).collect()
    assert all(r.score == first[r.doc_id].score for r in again)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, make(rng, i % 2 == 0)) for i in range(60)]
    rows += [(100, None), (101, ""), (101, "\n\n"), (None, "no id"), (102, "x" * 200_000), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(60)] + [(100, 1), (101, None), (None, 1), (3, 0)], "doc_id long, quality int")
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    none = labels.filter("false")
    assert {r.score for r in quality.quality(docs, none).collect()} == {1.0}
    assert quality.quality(docs.filter("false"), labels).count() == 0
