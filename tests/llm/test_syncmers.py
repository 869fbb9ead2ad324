"""Fingerprints against a plain reading of closed syncmers."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quern.llm import syncmers
from quern.llm.queries import QUERIES
from quern.llm.syncmers import INNER, KEPT, K, S


def texts_of_kinds():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["th", "on", "er", "é", "日本", "🙂", "a"]) for _ in range(rng.randrange(1, 5)))
    texts = [" ".join(word() for _ in range(n)) for n in (1, 3, 5, 20, 60, 400, 30_000)]
    return [*texts, texts[3], "", None, "x", "a" * 300, "abcdefghijklmnop", "abcdefghijklmnopq"]


def plain(spark, texts):
    """Anchor hashes per text, each place looked at by itself; only the hash is Spark's."""
    grams = {t[i : i + n] for t in texts for n in (K, S) for i in range(len(t) - n + 1)} | set(texts)
    rows = spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.hash("g")).collect()
    code = {g: h for g, h in rows}
    found = []
    for text in texts:
        anchors = set()
        for i in range(len(text) - K + 1):
            inner = [code[text[i + j : i + j + S]] for j in range(INNER)]
            if min(inner) in (inner[0], inner[-1]):
                anchors.add(code[text[i : i + K]])
        if text and not anchors:
            anchors = {code[text]}
        found.append(sorted(anchors)[:KEPT])
    return found


def like(a, b):
    union = sorted({*a, *b})[:KEPT]
    return sum(h in a and h in b for h in union) / len(union) if union else 1.0


def test_matches_plain_reading(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "SEGMENT", 1000)
    rows = list(enumerate(texts_of_kinds()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_chars", "'z' AS head")
    got = sorted(tuple(r) for r in syncmers.fingerprints(docs.repartition(3)).collect())
    texts = [t or "" for _, t in rows]
    edited = []
    for i, text in enumerate(texts):
        q = len(text) // 4
        edited.append(text[: len(text) - q] + texts[(i + 1) % len(texts)][:q])
    own, changed = plain(spark, texts), plain(spark, edited)
    shown = lambda hashes: "".join(f"{h & 0xFFFFFFFF:08x}" for h in hashes)
    want = [
        (i, len(t), hashlib.sha256(e.encode()).hexdigest(), shown(o).upper(), shown(c).upper(), like(o, c),
         like(o, own[(i + 1) % len(texts)]))
        for i, (t, e, o, c) in enumerate(zip(texts, edited, own, changed))]
    for g, w in zip(got, want, strict=True):
        assert (*g[:3], g[3].upper(), g[4].upper(), *g[5:]) == w


def test_anchors_follow_their_passage(spark):
    rng = random.Random(7)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
    docs = spark.createDataFrame([(1, passage), (2, "something before " + passage)], "doc_id long, text string")
    found = {d: {(r.place, r.anchor) for r in syncmers.anchors(docs).collect() if r.doc_id == d} for d in (1, 2)}
    assert len(found[1]) > 10
    assert {(p + 17, a) for p, a in found[1]} <= found[2]


def test_odd_rows(spark):
    rows = [(1, "one text that is long enough to have anchors " * 3), (1, "another one"), (None, "no id, no neighbour"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = syncmers.fingerprints(docs).collect()
    assert len(got) == 4 and sorted(r.n_chars for r in got) == [0, 11, 19, 135]
    alone = next(r for r in got if r.doc_id is None)
    assert alone.near_next == 0.0 and alone.edited_sha256 == hashlib.sha256(b"no id, no neigh").hexdigest()
    only = syncmers.fingerprints(docs.filter("doc_id = 2")).collect()
    assert [(r.near_edited, r.near_next, r.fingerprint) for r in only] == [(1.0, 1.0, "")]
    assert syncmers.fingerprints(docs.filter("false")).count() == 0


def test_ranges_follow_the_bytes_of_text(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "RANGE_BYTES", 20_000)
    sizes = [100] * 3000 + [5000] * 100
    docs = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], "doc_id long, text string")
    starts = syncmers.range_starts(docs)
    assert starts[0] == 0 and starts == sorted(set(starts))
    held = [sum(sizes[a:b]) for a, b in zip(starts, [*starts[1:], len(sizes)])]
    assert 40 <= len(held) <= 160 and max(held) <= 30_000
    assert syncmers.range_starts(docs.filter("doc_id < 0")) == []


def test_likeness_of_all_anchors_in_the_query(spark, tmp_path):
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    shared = prose(600)
    texts = [prose(15_000) + shared + prose(15_000), prose(14_000) + shared + prose(16_000), prose(40_000) + shared]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op9_syncmer_fingerprints"](spark, str(tmp_path)).collect())
    edited = [t[: len(t) - len(t) // 4] + texts[(i + 1) % 3][: len(t) // 4] for i, t in enumerate(texts)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setitem(globals(), "KEPT", None)
        own, changed = plain(spark, texts), plain(spark, edited)
        for i, row in enumerate(got):
            assert row[5:] == (like(own[i], changed[i]), like(own[i], own[(i + 1) % 3])) and row[6] > 0
    assert [len(r[3]) for r in got] == [8 * KEPT] * 3
