"""Every stage of the pipeline against its operator's plain check, and the whole on a small table."""

import zlib

import compare
import numpy as np
import pytest
from test_decontamination import brute as brute_benchmark
from test_near_duplicates import brute as brute_groups

import corpus_pipeline
from quern.llm import decontamination
from quern.llm.queries import vocabulary

SF = "0.001"

pytestmark = pytest.mark.skipif(not compare.has_data(SF), reason="test tables not present")


def test_stages_in_turn(spark):
    from tokenizers import Tokenizer

    sf_dir = compare.data_dir(SF)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    good, single, clean, mix, last = (f for _, f in corpus_pipeline.STAGES)

    kept = good(spark, docs, sf_dir).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns
    assert np.mean([(d in ids) == bool(q) for d, q in labels.items()]) > 0.9

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    alone = single(spark, kept, sf_dir).cache()
    assert alone.columns == columns
    assert sorted(r.doc_id for r in alone.collect()) == sorted(d for d, _, _, k in brute_groups(rows) if k)

    free = clean(spark, alone, sf_dir).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {d for d, _ in exact(alone, items)}
    assert free.columns == columns
    left = {r.doc_id for r in free.collect()}
    assert not left & hit and left <= {r.doc_id for r in alone.collect()}

    mixed = mix(spark, free, sf_dir).cache()
    taken = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == columns and set(taken) <= left
    assert max(map(taken.count, set(taken))) <= 3

    tokenizer = Tokenizer.from_file(vocabulary())
    want = []
    for r in sorted(mixed.collect(), key=lambda r: r.doc_id):
        encoded = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, len(encoded), zlib.crc32(encoded.tobytes())))
    got = [tuple(r) for r in last(spark, mixed, sf_dir).orderBy("start").collect()]
    assert [(g[0], g[2], g[3]) for g in got] == want


def exact(docs, items):
    """Documents that hold an item's whole normal text."""
    texts = [(i, decontamination.normal(t)) for i, t in items]
    return {(r.doc_id, i) for r in docs.collect() for i, t in texts if t and t in decontamination.normal(r.text)}


def test_run(spark):
    got = corpus_pipeline.run(spark, compare.data_dir(SF)).collect()
    assert got and {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(got[0].asDict())
    assert brute_benchmark([], []) == {}
