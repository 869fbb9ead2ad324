"""The length histogram and its answers against direct computation."""

import random

from tokenizers import Tokenizer

from quern.llm import lengths
from quern.llm.queries import vocabulary


def test_curve_and_limits(spark, monkeypatch):
    monkeypatch.setattr(lengths, "BUCKET", 8)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "tion", "überall", "x"]) for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    texts += [None, "", texts[0], "a" * 30_000]
    docs = spark.createDataFrame([(t, 1, 2) for t in texts], "text string, n_tokens int, n_docs int")
    tokenizer = Tokenizer.from_file(vocabulary())
    sizes = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts]
    curve = lengths.curve(lengths.histogram(docs.repartition(3), vocabulary(), added=1)).cache()
    got = {r.n_tokens: r for r in curve.collect()}
    assert set(got) == set(sizes)
    for limit, r in got.items():
        longer = [s for s in sizes if s > limit]
        assert (r.n_docs, r.docs_longer, r.tokens_longer) == (sizes.count(limit), len(longer), sum(longer))
        assert (r.total_docs, r.total_tokens) == (len(sizes), sum(sizes))
        assert r.truncated_tokens == sum(min(s, limit) for s in sizes)
        assert r.fitting_share == (len(sizes) - len(longer)) / len(sizes)
    limits = [0, 1, 17, 10**6]
    for r in lengths.at_limits(curve, limits).collect():
        assert r.truncated_tokens == sum(min(s, r.limit) for s in sizes)
    assert lengths.quantile(curve, 0.5).first().n_tokens == sorted(sizes)[(len(sizes) + 1) // 2 - 1]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    curve = lengths.curve(lengths.histogram(empty, vocabulary()))
    assert curve.count() == 0
    assert lengths.at_limits(curve, [5]).first().truncated_tokens == 0
