"""The source audit against counting and summing term by term."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quern.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, p long"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, least=30, top=50):
    counts, holds, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(terms(text))
        holds[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in holds[lang].items() if n >= least]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def freq(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, p = freq(whole), {s: freq(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            above = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(above)[:top], 1)]
    return sorted(out)


def result(spark, docs, **options):
    rows = [(i, t, lang, s, 1, "x", 2) for i, (t, lang, s) in enumerate(docs)]
    return sorted(tuple(r) for r in divergence.divergence(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect())


def some_docs(seed, count, words=300, sources=6):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdéſßЖ", k=rng.randrange(1, 4))) for _ in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = []
    for _ in range(count):
        picked = rng.choices(vocabulary, weights, k=rng.randrange(60))
        text = rng.choice([" ", "-", "1", "_\x00"]).join(w.upper() if rng.random() < 0.2 else w for w in picked)
        docs.append((text, rng.choice(["en", "en", "de", None, ""]), rng.choice([f"s{i}" for i in range(sources)] + [None])))
    return docs


def test_matches_counting(spark):
    docs = some_docs(3, 400)
    assert any(r[2] == "term" for r in brute(docs))
    assert result(spark, docs) == brute(docs)
    assert result(spark, docs, least_docs=2, top=5) == brute(docs, 2, 5)


def test_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "BLOCK_WORDS", 1)
    docs = some_docs(4, 300, sources=9)
    assert result(spark, docs, least_docs=1) == brute(docs, 1)


def test_groups_without_terms_nulls_and_long_texts(spark):
    docs = [(None, "en", "a"), ("", "en", "b"), ("12 34", None, None), ("one two", "fr", "a"), ("same " * 300_000, "en", "c")]
    assert result(spark, docs) == brute(docs)
    assert result(spark, docs + [("same word", "en", "d")] * 40) == brute(docs + [("same word", "en", "d")] * 40)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_held_rows_are_bounded(monkeypatch, spark):
    monkeypatch.setattr(divergence, "HELD_ROWS", 10)
    docs = some_docs(6, 120)
    assert result(spark, docs, least_docs=3) == brute(docs, 3)


def test_folding_keeps_slices():
    texts = pa.array(["XX", "Straße-ÄÖ_1", None, "", "a\x00B"])[1:]
    assert divergence.folded(texts).to_pylist() == ["straße ÄÖ  ", "", "", "a b"]


def test_joint_cells_of_one_word():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 4, (3, 50))
    p = counts * 7 + 1
    rows = [(s, 0, 1, None, 0) for s in range(3)]
    for s in range(3):
        for n in (1, 2, 3):
            bits = sum(1 << int(t) for t in np.flatnonzero(counts[s] == n))
            rows.append((s, 0, 1 + 7 * n, 0, bits))
    table = pa.table({
        "lang": ["x"] * len(rows), "block": pa.array([0] * len(rows), pa.int64()), "left": [0] * len(rows),
        "right": [0] * len(rows), "source": [f"s{r[0]}" for r in rows], "tile": pa.array([r[1] for r in rows]),
        "terms": pa.array([50] * len(rows)), "p": pa.array([r[2] for r in rows]),
        "chunk": pa.array([r[3] for r in rows], pa.int64()),
        "bits": pa.array([r[4] - (1 << 64) if r[4] >> 63 else r[4] for r in rows], pa.int64())})
    got = {(r["source"], r["item"]): r["value"] for r in divergence.joint_sums(table, 64).to_pylist()}
    assert got == {(f"s{a}", f"s{b}"): int(np.abs(p[a] - p[b]).sum()) for a in range(3) for b in range(3) if a != b}
