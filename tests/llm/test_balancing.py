"""The mix against its constraints, and its parts against direct computation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quern.llm import balancing


def shared_out(sizes):
    """Targets by sharing again and again until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full.update((s, 3.0 * sizes[s]) for s in over)


def rows_of_sources(seed, sources):
    rng = random.Random(seed)
    rows = []
    for source, docs in sources.items():
        rows += [(len(rows) + k, "w " * int(rng.lognormvariate(3, 1.2)), source) for k in range(docs)]
    return rows


@pytest.mark.parametrize("sources", [
    {"a": 200, "b": 20, "c": 30, None: 40, "é": 3, "Z": 1},
    {"only": 50},
    {"big": 500, "tiny": 1, "small": 4},
])
def test_mix_meets_targets(spark, sources):
    rows = rows_of_sources(4, sources)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS key")
    got = balancing.mixed(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d, len(t.split())) for d, t, _ in rows)
    sizes = {s: sum(r.size for r in got if r.source == s) for s in sources}
    want = shared_out(sizes)
    for source in sources:
        own = [r for r in got if r.source == source]
        assert {r.source_size for r in own} == {sizes[source]}
        assert all(math.isclose(r.target, want[source], rel_tol=1e-9) for r in own)
        assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in own)
        least = min((r.size for r in own if r.size), default=0)
        assert abs(sum(r.taken for r in own) - want[source]) <= max(least, 1)
    again = balancing.mixed(docs.repartition(2)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, got), key=repr)


def test_rates_are_the_tilted_prior(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(1, 900), rng.choice([0.2, 1.0, 2.5]), i % 2) for i in range(400)]
    cells = spark.createDataFrame(rows, "id int, size long, prior double, s int").selectExpr(
        "cast(s AS string) AS key", "size", "prior").groupBy("key", "size", "prior").agg(F.count("*").alias("n"))
    totals = {s: sum(r[1] for r in rows if r[3] == s) for s in (0, 1)}
    targets = spark.createDataFrame(
        [("0", totals[0], 0.3 * totals[0]), ("1", totals[1], 2.2 * totals[1])], "key string, source_size long, target double")
    for r in balancing.multipliers(cells, targets).collect():
        taken = sum(size * min(3, prior * math.exp(r.multiplier)) for _, size, prior, s in rows if str(s) == r.key)
        assert math.isclose(taken, r.target, rel_tol=1e-6)


def test_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c d e", None), (2, None, "x"), (3, "", None), (4, " \x0b ", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = balancing.mixed(docs).collect()
    assert len(got) == 6
    assert {r.taken for r in got if r.size == 0} == {0}
    mixed = balancing.repeated(docs)
    assert mixed.columns == docs.columns
    assert sorted((repr(r.doc_id), r.text) for r in mixed.collect()) == sorted(
        (repr(r.doc_id), next(t for d, t, _ in rows if d == r.doc_id)) for r in got for _ in range(r.copies))
    assert balancing.mixed(docs.filter("false")).count() == 0
    assert balancing.mixed(docs.filter("size(split(coalesce(text, ''), '[a-e]')) = 1")).agg(F.sum("taken")).first()[0] == 0


def test_a_null_prior_counts_as_one_and_names_may_clash(spark):
    rows = [(i, " ".join(["w"] * (3 + i % 4)), "ab"[i % 2], None if i % 3 else 1.0, i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, prior double, own_id long")
    got = balancing.mixed(docs, prior="prior").collect()
    assert len(got) == len(rows)
    plain = {r.doc_id: r.taken for r in balancing.mixed(docs).collect()}
    assert {r.doc_id: r.taken for r in got} == plain
    again = balancing.repeated(docs.withColumnRenamed("prior", "rank"))
    assert again.columns == ["doc_id", "text", "source", "rank", "own_id"]
    assert again.count() == sum(r.copies for r in got)
