"""The unigram columns against plain counting; the model as a distribution and on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quern.llm import mixing, running, scoring


def tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*lowered.encode().split(), b"\n"]


def remainder(doc_id):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % 5


def corpus(rng, n):
    stems = ["th", "on", "er", "tion", "é", "an", "re"]
    word = lambda: "".join(rng.choices(stems, [8, 6, 5, 4, 2, 1, 1], k=rng.randrange(1, 5)))
    return [(i, " ".join(rng.choice([str.title, str, str])(word()) for _ in range(rng.randrange(1, 90)))) for i in range(n)]


@pytest.mark.parametrize("piece", [2000, 2 << 20])
def test_columns_match_plain_counting(spark, monkeypatch, piece):
    monkeypatch.setattr(scoring, "PIECE_BYTES", piece)
    monkeypatch.setattr(scoring, "BUCKET_BYTES", 2 * piece)
    rng = random.Random(2)
    rows = corpus(rng, 300) + [(900, None), (901, ""), (902, " \x0b\n"), (None, "no id here"), (3, "again three"), (903, "z" * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS piece", "2 AS n_tokens")
    got = scoring.scores(docs.repartition(3)).collect()
    counts = Counter(t for d, x in rows if remainder(d) != 1 for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (repr(d), remainder(d) == 1, len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), total,
         sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens(x)))
        for d, x in rows)
    have = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    for g, w in zip(have, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.score for r in held) > 1.1 * sum(r.base_score for r in held)


def test_bits_add_up_to_a_distribution():
    rng = random.Random(3)
    words = [t for _, x in corpus(rng, 60) for t in tokens(x)[:-1]]
    counted = Counter(words)
    known, weights = list(counted), np.array(list(counted.values()), float)
    classes = np.arange(len(known)) % 3
    counts = np.zeros(2 * mixing.SLOTS, np.float32)
    mixing.count(known, classes, weights, counts)
    assert counts.sum() == pytest.approx(sum((len(w) + 1) * 8 * c for w, c in counted.items()) * len(mixing.CONTEXTS))
    mixer = mixing.Mixer(counts)
    mixer.learn(known, classes, weights)
    mixer.learn(known, classes, weights)
    seen = np.zeros_like(mixer.refined)
    mixer.watch(known, classes, weights, seen)
    mixer.refined = seen
    assert seen.sum() == pytest.approx(sum((len(w) + 1) * 8 * c for w, c in counted.items()), rel=1e-5)
    assert np.isfinite(mixer.log10(known, classes)).all()
    # After "th", the next byte's 256 probabilities sum to one.
    heads = [b"th" + bytes([b]) for b in range(256) if b != 32]
    odds = []
    for word in [*heads, b"th"]:
        e = mixing.events([word], np.array([1]))
        mixed_odds = mixer.mix(*mixer.inputs(e))
        entry, part = mixer._levels(e, mixed_odds)
        levels = np.tile(np.linspace(-8, 8, mixing.REFINE_LEVELS), mixing.REFINE_CONTEXTS)
        ones = (mixer.refined[:, 1] + mixing.REFINE_PRIOR / (1 + np.exp(-levels))) / (mixer.refined.sum(1) + mixing.REFINE_PRIOR)
        p = (1 / (1 + np.exp(-mixed_odds)) + (1 - part) * ones[entry] + part * ones[entry + 1]) / 2
        odds.append(np.where(e.bit == 1, p, 1 - p)[2].prod())
    assert sum(odds) == pytest.approx(1.0, abs=1e-6)


def test_words_do_not_depend_on_their_neighbours():
    counts = np.zeros(2 * mixing.SLOTS, np.float32)
    words = [b"the", b"other", b"t", "été".encode(), b"x" * 500]
    classes = np.array([0, 1, 0, 2, 1])
    mixing.count(words, classes, np.ones(5), counts)
    mixer = mixing.Mixer(counts)
    alone = np.array([mixer.log10([w], classes[[i]])[0] for i, w in enumerate(words)])
    assert np.allclose(mixer.log10(words, classes), alone)
    assert np.allclose(mixer.log10(words[::-1], classes[::-1]), alone[::-1])


def test_adapted_is_the_sequential_mixture():
    rng = random.Random(5)
    texts = [[rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(6)]
    p = [0.4, 0.3, 0.05, 0.001]
    logs, counts, starts = [], [], []
    for text in texts:
        starts.append(len(logs))
        for w in sorted(set(text)):
            logs.append(math.log10(p[w]))
            counts.append(text.count(w))
    got = scoring.adapted(np.array(logs), np.array(counts), np.array(starts))
    for text, value in zip(texts, got):
        total = 0.0
        for a in scoring.STRENGTHS:
            product, seen = 1.0, Counter()
            for n, w in enumerate(text):
                product *= (seen[w] + a * p[w]) / (n + a)
                seen[w] += 1
            total += product / len(scoring.STRENGTHS)
        assert value == pytest.approx(math.log10(total))


def test_words_of_a_class_add_up_to_less_than_one():
    counts, classes = np.array([5, 1, 3, 0, 2]), np.array([0, 0, 0, 1, 1])
    spelled = np.log10([0.1, 0.2, 0.3, 0.05, 0.9])
    tokens, words = np.array([9, 2, 0]), np.array([3, 1, 0])
    p = 10 ** scoring.word_log10(counts, classes, spelled, tokens, words)
    assert p[:3].sum() == pytest.approx((9 - 3 * 0.75) / 9 + 3 * 0.75 / 9 * 0.6)
    assert p[3:].sum() == pytest.approx((2 - 0.75) / 2 + 0.75 / 2 * 0.95)
    none = scoring.word_log10(np.array([0]), np.array([2]), np.array([-3.0]), tokens, words)
    assert none[0] == pytest.approx(-3.0)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scoring.scores(empty).count() == 0
    one = scoring.scores(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].n_tokens == 1


def test_running_text_is_mixed_step_by_step():
    rng = np.random.default_rng(4)
    words, sizes = rng.integers(0, 7, 60).astype("<u2"), np.array([1, 30, 4, 25])
    classes = np.repeat([0, 1, 1, 0], sizes)
    model = running.Model(running.code_of([5, 9, 1, 1, 4, 2, 30]), 2, running.LEAST_BITS)
    counts = np.zeros(2 * model.slots, np.uint32)
    running.count(model, words, classes, sizes, counts)
    assert counts.sum() == model.code.lengths[words].sum() * (1 + len(running.BACK))
    mixer = running.Mixer(model, running.packed(counts, int(model.offsets[1])))
    mixer.learn(words, classes, sizes)
    mixer.watch(words, classes, sizes, mixer.refined)
    got = mixer.log10(words, classes, sizes)
    # One text cut before each of its words, with each number in its place: they add up to one.
    begin = np.cumsum(sizes) - sizes
    for text, place in ((1, 0), (1, 17), (3, 24)):
        head = words[begin[text] : begin[text] + place]
        each = [mixer.log10(np.append(head, n).astype("<u2"), np.full(place + 1, classes[begin[text]]), np.array([place + 1]))[-1]
                for n in range(7)]
        assert sum(10.0**x for x in each) == pytest.approx(1, abs=1e-4)
        assert got[begin[text] + place] == pytest.approx(each[words[begin[text] + place]], abs=1e-5)


def test_along_adapts_to_the_words_before():
    logs, keys, sizes = np.log10([0.2, 0.1, 0.3, 0.2, 0.05]), np.array([3, 3, 4, 3, 9]), [4, 1]
    again = scoring.occurrences(keys)
    assert again.tolist() == [0, 1, 0, 2, 0]
    want = [np.mean([np.prod([(again[i] + a * 10 ** logs[i]) / (n + a) for n, i in enumerate(those)]) for a in scoring.STRENGTHS])
            for those in ([0, 1, 2, 3], [4])]
    assert scoring.along(logs, again, np.array(sizes)) == pytest.approx(np.log10(want))


def test_score_heeds_the_order_of_words(spark):
    rng = random.Random(6)
    chain = {w: rng.sample("red green blue one two three four five".split(), 2) for w in "red green blue one two three four five".split()}

    def text():
        words = [rng.choice(list(chain))]
        while len(words) < 40:
            words.append(rng.choice(chain[words[-1]]))
        return words

    rows = [(i, text()) for i in range(300)]
    for i, words in rows[:60]:
        rows.append((1000 + i, rng.sample(words, len(words))))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    score = {r.doc_id: r.score for r in scoring.scores(docs).collect()}
    assert sum(score[i] for i in range(60)) > 0.8 * sum(score[1000 + i] for i in range(60))


@pytest.mark.parametrize("most", [2, 3, 65_534])
def test_commonest_words_get_numbers(spark, monkeypatch, most):
    monkeypatch.setattr(running, "MOST_WORDS", most)
    texts = ["the the the", "a the a", "of a " + "x" * 90, "x" * 90 + " once"]
    docs = spark.createDataFrame([(i, t) for i, t in zip((0, 1, 2, 4), texts)], "doc_id long, text string")
    assert not any(remainder(i) == scoring.HELD_OUT for i in (0, 1, 2, 4))
    cuts = scoring.cut(docs, 3, np.zeros((1, len(scoring.LETTERS))))
    buckets = cuts.filter("bucket >= 0").select("bucket", "piece", "first", "words", "learned", "aside").groupBy(
        "bucket").applyInArrow(scoring._gather, scoring.BUCKETS)
    words, counts, classes = scoring.numbered_words(buckets)
    assert dict(zip(words, counts.tolist())) == {"the": 4, "\n": 4} | ({"a": 3} if most > 2 else {})
    assert classes[:, 0].tolist() == counts.tolist()
