"""The filter audit against running every order over a list of documents."""

import random
import re
from itertools import permutations

from quern.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, id long, good string"
LABELS = "doc_id long, quality int, toxic int, A int"


def fails(text, doc_id, smallest):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": doc_id is not None and doc_id > smallest.get(text, doc_id),
    }


def brute(docs, labels):
    smallest = {}
    for d, t, *_ in docs:
        if d is not None:
            smallest[t or ""] = min(d, smallest.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = {}
    for part in {s or "" for _, _, s in docs}:
        own = [(d, fails(t or "", d, smallest)) for d, t, s in docs if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                failing = sum(x[1][f] for x in own)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone),
                    sum(x[1][f] and sum(x[1].values()) == 1 for x in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                shapley[f] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def result(spark, docs, labels):
    rows = spark.createDataFrame([(*d, "x", 7, "y") for d in docs], DOCS)
    known = spark.createDataFrame([(*x, 0) for x in labels], LABELS)
    return sorted(tuple(r) for r in filter_audit.filter_audit(rows, known).collect())


def test_matches_every_order(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["#tag", "É", "ABCDEFGHIJKLMNOP", "a\tb", " "]
    texts = [" ".join(rng.choices(words[: rng.choice([9, 40, 64])], k=rng.randrange(80))) for _ in range(60)]
    docs = [(i, rng.choice(texts), rng.choice(["s", "s", "t", None, ""])) for i in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 170, 2)]
    assert result(spark, docs, labels) == brute(docs, labels)


def test_nulls_repeats_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = [
        (None, None, None), (None, "", "s"), (3, None, "s"), (2, "", "s"), (2, "", "s"), (2, "other", "s"),
        (9, long, "s"), (-4, long, "t"), (9, long, None), (0, "", "t"), (None, long, "t"), (5, "|" * 100_000, "t")]
    labels = [(2, 1, 0), (2, 0, 1), (None, 1, 1), (9, None, None), (9, 1, 1)]
    assert result(spark, docs, labels) == brute(docs, labels)


def test_one_text_for_all(spark):
    docs = [(i, "same text", "s") for i in range(500)]
    assert result(spark, docs, []) == brute(docs, [])


def test_empty_tables(spark):
    assert result(spark, [], []) == []
    assert result(spark, [], [(1, 1, 1)]) == []


def test_every_pair_once():
    assert len(filter_audit.orders()) == 600
    assert len({(p, f) for _, _, p, f, _ in filter_audit.orders()}) == 80
    assert sum(w for p, f, w in {(p, f, w) for _, _, p, f, w in filter_audit.orders()}) == 600
