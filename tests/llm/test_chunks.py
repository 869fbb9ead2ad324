"""Chunks against their definition, and repeated passages on planted copies."""

import random

import numpy as np

from quern.llm import chunks


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def plain_cuts(data):
    ends, last = [], 0
    for i in range(len(data)):
        h = 0
        for byte in data[max(0, i - 15) : i + 1]:
            h = ((h << 1) + int(chunks.GEAR[byte])) & 0xFFFF
        size = i + 1 - last
        if size == chunks.LONGEST or (h >> (16 - chunks.CUT_BITS) == 0 and size >= chunks.SHORTEST) or i + 1 == len(data):
            ends.append(i + 1)
            last = i + 1
    return ends


def test_cuts_match_definition():
    rng = random.Random(2)
    for data in (b"", b"a", words(rng, 400).encode(), b"a" * 3000, bytes(rng.randrange(256) for _ in range(5000)), b"ab " * 999):
        assert chunks.cuts(data) == plain_cuts(data) if data else True
    shifted = words(rng, 300).encode()
    own, moved = set(chunks.cuts(shifted)), {c - 5 for c in chunks.cuts(b"12345" + shifted)}
    assert len(own & moved) > 0.8 * len(own)
    assert chunks.gear_hashes(np.frombuffer(b"x", np.uint8)).tolist() == [int(chunks.GEAR[120])]


def test_finds_planted_passages(spark):
    rng = random.Random(3)
    passages = [words(rng, 55) for _ in range(40)]
    rows, planted, clean = [], set(), set()
    for i in range(300):
        text = words(rng, 120)
        if i % 3 == 0:
            passage = rng.randrange(40)
            text = words(rng, rng.randrange(60)) + " " + passages[passage] + " " + text
            planted.add((i, passage))
        else:
            clean.add(i)
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS digest")
    got = chunks.repeated_passages(docs.repartition(5)).collect()
    first = {}
    for i, p in sorted(planted):
        first.setdefault(p, i)
    again = {(i, p) for i, p in planted if first[p] != i}
    found = {r.doc_id for r in got}
    assert not found & clean
    assert len({i for i, _ in again} - found) <= 0.02 * len(again)
    text = dict(rows)
    for r in got:
        passage = text[r.doc_id].encode()[r.start : r.start + r.size]
        assert passage[:24] in text[r.first_doc_id].encode() and r.first_doc_id < r.doc_id
    cut = {r.doc_id: r.text for r in chunks.without_repeats(docs).collect()}
    assert all(cut[i] == text[i] for i in clean)
    assert all(len(cut[r.doc_id]) < len(text[r.doc_id]) for r in got)


def test_copies_and_odd_rows(spark):
    rng = random.Random(4)
    text = words(rng, 90)
    rows = [(5, text), (2, text), (2, text), (None, text), (7, None), (8, ""), (9, "short"), (10, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.start, r.size, r.first_doc_id) for r in chunks.repeated_passages(docs).collect()]
    assert got == [(5, 0, len(text.encode()), 2)]
    assert chunks.repeated_passages(docs.filter("false")).count() == 0
    assert chunks.without_repeats(docs).count() == len(rows)
