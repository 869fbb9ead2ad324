"""Stored tables, views, backfills, the streaming cycle, and file sources."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import images as image_fn
from quern.functions import text as text_fn
from quern.functions.frames import Feature
from quern.functions.inference import detector
from quern.operators import episodes as ep
from quern.operators import backfill, dedup, evaluate, fills, filters, health, neighbors, search, views
from quern.schema import missing_columns
from quern.sources import images as image_io
from quern.sources import text as text_io
from quern.sources.store import TableStore
from quern.streaming.cycle import file_stream, run_cycle

EVEN = Feature(("id",), T.BooleanType(), lambda c: F.pmod(c, F.lit(2)) == 0)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path / "store"))
    made.create("rows", spark.range(10).withColumn("text", F.col("id").cast("string")), "id")
    return made


def test_old_versions_stay_readable(spark, store):
    store.append("rows", spark.range(10, 15).withColumn("text", F.lit("x")))
    store.add_columns("rows", store.read_base("rows").select("id", F.lit(1).alias("one")))
    store.delete_where("rows", "id < 3")
    assert [store.read("rows", v).count() for v in (1, 2, 3, 4)] == [10, 15, 15, 12]
    assert store.read("rows", 2).columns == ["id", "text"]
    other = TableStore(spark, store.root)
    assert other.version("rows") == 4 and other.read("rows").count() == 12


def test_append_checks_columns_and_batches(spark, store):
    with pytest.raises(ValueError):
        store.append("rows", spark.range(3))
    more = spark.range(10, 12).withColumn("text", F.lit("x"))
    assert store.append("rows", more, batch="b1") is not None
    assert store.append("rows", more, batch="b1") is None
    assert store.read("rows").count() == 12
    with pytest.raises(KeyError):
        store.read("absent")


def test_backfill_fills_only_what_is_missing(spark, store):
    registry = {"even": EVEN}
    first = backfill.backfill(store, "rows", ["even", "unknown"], registry).collect()
    assert sorted(tuple(r) for r in first) == [("even", "DONE", 10), ("unknown", "SKIP", 0)]
    store.append("rows", spark.range(10, 14).withColumn("text", F.lit("x")))
    assert store.read("rows").where("even IS NULL").count() == 4
    assert backfill.backfill(store, "rows", ["even"], registry, task_rows=2).first()["rows"] == 4
    incremental = sorted(store.read("rows").collect())
    backfill.backfill(store, "rows", ["even"], registry, overwrite=True)
    assert sorted(store.read("rows").collect()) == incremental


def test_null_results_count_as_computed(spark, store):
    calls = Feature(("id",), T.BooleanType(), lambda c: F.when(c < 6, True))
    assert backfill.backfill(store, "rows", ["flag"], {"flag": calls}).first()["rows"] == 10
    version = store.version("rows")
    assert backfill.backfill(store, "rows", ["flag"], {"flag": calls}).first()["rows"] == 0
    assert store.version("rows") == version  # nothing to do adds no commit
    store.append("rows", spark.range(10, 13).withColumn("text", F.lit("x")))
    assert backfill.pending(store, "rows", ["flag"], ["id"]).count() == 3
    assert backfill.backfill(store, "rows", ["flag"], {"flag": calls}).first()["rows"] == 3
    assert store.read("rows").where("flag").count() == 6


def test_the_latest_of_several_values_counts(spark, store):
    for value in (1, 2, 3):
        store.add_columns("rows", spark.range(value, 10).select("id", F.lit(value).alias("v")))
    got = {r["id"]: r["v"] for r in store.read("rows").collect()}
    assert got == {0: None, 1: 1, 2: 2, **{i: 3 for i in range(3, 10)}}


def test_refresh_follows_values_that_come_later(spark, store):
    store.add_columns("rows", spark.range(10).select("id", F.lit(False).alias("is_duplicate")))
    views.create_view(store, "low_train", "rows", "id < 90")
    store.append("rows", spark.range(10, 14).withColumn("text", F.lit("x")))
    assert views.refresh_view(store, "low_train") == (10, 14)
    store.add_columns("rows", spark.range(10, 14).select("id", (F.col("id") > 11).alias("is_duplicate")))
    assert views.refresh_view(store, "low_train") == (14, 12)
    condition = store._live("low_train")[0].filter
    assert sorted(store.read("low_train").collect()) == sorted(store.read("rows").where(condition).collect())
    store.add_columns("rows", store.read_base("rows").select("id", F.lit(1).alias("later")))
    views.refresh_view(store, "low_train")
    assert "later" in store.read("low_train").columns


def test_a_batch_reads_only_its_own_rows(spark, store):
    registry = {"even": EVEN}
    backfill.backfill(store, "rows", ["even"], registry)
    views.create_view(store, "evens", "rows", "even = true")
    for start in (10, 14, 18):
        store.append("rows", spark.range(start, start + 4).withColumn("text", F.lit("x")))
        assert backfill.pending(store, "rows", ["even"], ["id"]).count() == 4
        assert store.read("rows", since=store.version("rows") - 1).count() == 4
        backfill.backfill(store, "rows", ["even"], registry)
        before, after = views.refresh_view(store, "evens")
        assert after - before == 2
    full = store.read("rows").where("even = true")
    assert sorted(store.read("evens").collect()) == sorted(full.collect())


def test_vector_ids_of_any_type_and_wrong_widths(spark):
    rows = spark.createDataFrame(
        [(f"frame_{i}", [float(i), 1.0, 0.5], f"s{i}") for i in range(30)], "image_id string, v array<double>, scene string")
    hits = search.vector_search(rows, "image_id", "v", [1.0, 1.0, 0.5], 3, columns=("scene",)).collect()
    assert [(h["id"], h["scene"]) for h in sorted(hits, key=lambda h: -h["score"])][0] == ("frame_1", "s1")
    near = search.neighbors_of(rows, "image_id", "v", 1).collect()
    assert len(near) == 30 and all(n["query_id"] != n["id"] for n in near)
    ragged = rows.unionByName(spark.createDataFrame([("odd", [1.0], "x")], rows.schema))
    with pytest.raises(Exception, match="has not 3 numbers"):
        search.vector_search(ragged, "image_id", "v", [1.0, 1.0, 0.5], 3).collect()


def test_neighbors_of_more_rows_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(130, 6))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    got = {r["query_id"]: r["id"] for r in search.near_neighbors(rows, "id", "v", 0.9, asked="id % 2 = 0").collect()}
    assert got == {i: int(scores[i].argmax()) for i in range(0, 130, 2)}


def test_neighbors_pass_no_vectors_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 25)
    vectors = np.random.default_rng(6).normal(size=(120, 5))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    sent = []
    collect = type(rows).collect

    def watched(self):
        sent.extend(f.name for f in self.schema if f.dataType.typeName() == "array")
        return collect(self)

    monkeypatch.setattr(type(rows), "collect", watched)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append("broadcast"))
    found = search.neighbors_of(rows, "id", "v", 3)
    monkeypatch.undo()
    assert not sent
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    got = {(r["query_id"], r["id"]) for r in found.collect()}
    assert got == {(i, int(j)) for i in range(120) for j in np.argsort(-scores[i])[:3]}
    assert search.neighbors_of(rows, "id", "v", 3, "id < 0").count() == 0


def plain_neighbors(vectors, k):
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(length == 0, 1, length)
    scores = np.round(unit @ unit.T, 12)
    np.fill_diagonal(scores, -2)
    return {(i, int(j)) for i in range(len(vectors)) for j in np.argsort(-scores[i], kind="stable")[:k]}


def test_neighbors_in_groups_with_copies_ties_and_zero_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbors, "ASKED_AT_ONCE", 24)
    monkeypatch.setattr(neighbors, "SHELF_ROWS", 50)
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(9, 5))
    vectors = np.concatenate([c + 0.02 * rng.normal(size=(20, 5)) for c in centers] + [np.tile(centers[0], (40, 1)), np.zeros((3, 5))])
    vectors = vectors[rng.permutation(len(vectors))]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    rows = rows.withColumn("asked", F.lit(1)).unionByName(spark.createDataFrame([(900, None)], "id bigint, v array<double>"), True)
    for k in (1, 3):
        found = search.neighbors_of(rows, "id", "v", k).collect()
        assert {(r["query_id"], r["id"]) for r in found} == plain_neighbors(vectors, k)
    near = {(r["query_id"], r["id"]) for r in search.neighbors_of(rows, "id", "v", 500, within=0.99).collect()}
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
    scores = np.round(unit @ unit.T, 12)
    assert near == {(int(i), int(j)) for i, j in zip(*np.nonzero(scores >= 0.99)) if i != j}


def test_the_angle_bound_leaves_cells_unvisited(spark, monkeypatch):
    """Groups far apart: a question is sent to few of the blocks."""
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(9)
    vectors = np.concatenate([c + 0.01 * rng.normal(size=(50, 24)) for c in rng.normal(size=(20, 24))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    sizes = []
    keep = neighbors.checkpointed
    monkeypatch.setattr(neighbors, "checkpointed", lambda df: sizes.append(keep(df)) or sizes[-1])
    found = search.neighbors_of(rows, "id", "v", 2)
    assert {(r["query_id"], r["id"]) for r in found.collect()} == plain_neighbors(vectors, 2)
    sent = sizes[-1].where("kind = 1").agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    assert sent < 0.4 * len(vectors) * 20


def test_odd_vectors_are_errors_and_ids_may_repeat(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], "id bigint, v array<double>")
    assert {(r["query_id"], r["id"]) for r in search.neighbors_of(rows, "id", "v", 2).collect()} == {(1, 2), (2, 1)}
    for bad in ([1.0], [1.0, None], [1.0, float("nan")]):
        with pytest.raises(ValueError):
            search.neighbors_of(rows.unionByName(spark.createDataFrame([(3, bad)], rows.schema)), "id", "v", 1)
    zero = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "id bigint, v array<double>")
    assert [r["score"] for r in search.nearest(zero, "id", "v", [(2, [0.0, 0.0])], 1, exclude_self=True).collect()] == [0.0]


def test_view_names_may_hold_any_character(spark, store):
    names = {"a:b%": "id < 4", "with space/slash": "id >= 4", "none=0": "id < 0"}
    views.create_views(store, "rows", names)
    assert [store.read(n).count() for n in names] == [4, 6, 0]
    store.append("rows", spark.range(100, 103).withColumn("text", F.lit("x")))
    assert views.refresh_view(store, "with space/slash") == (6, 9)
    assert views.refresh_view(store, "a:b%") == (4, 4)


def test_batched_index_search(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "PROBED_ROWS", 40)
    monkeypatch.setattr(search, "QUERIES_PER_PASS", 15)
    rng = np.random.default_rng(21)
    data = np.concatenate([c + 0.4 * rng.normal(size=(60, 16)) for c in rng.normal(size=(8, 16))])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id bigint, v array<double>")
    queries = rows.where("id % 5 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("vector"))
    path = str(tmp_path / "index")
    search.build_vector_index(rows, "id", "v", path, cells=6, subspaces=4, codes=16)
    exact = search.indexed_search_many(spark, path, queries, 5, nprobe=6, exclude_self=True)
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    scores = unit @ unit.T
    np.fill_diagonal(scores, -2)
    want = {(i, int(j)) for i in range(0, 480, 5) for j in np.argsort(-scores[i], kind="stable")[:5]}
    assert {(r["query_id"], r["id"]) for r in exact.collect()} == want
    found = search.indexed_search_many(spark, path, queries, 5, nprobe=3, refine=8, exclude_self=True)
    told = search.index_recall(found, exact).first()
    assert told["queries"] == 96 and told["wanted"] == 480 and told["recall"] >= 0.9
    near = search.indexed_search_many(spark, path, queries, 1, nprobe=6, metric="l2").collect()
    assert all(r["query_id"] == r["id"] for r in near)


def test_take_reads_only_the_files_asked_for(spark, tmp_path):
    root = str(tmp_path / "with space & 5%")
    for n in range(6):
        spark.range(n * 100, n * 100 + 40 + n).coalesce(1).write.mode("append").parquet(root)
    rows = spark.read.parquet(root)
    every = [r["id"] for r in text_io.with_global_index(rows).orderBy("position").collect()]
    layout = text_io.file_layout(rows).orderBy("_file").collect()
    some = [layout[1]["_offset"], layout[4]["_offset"] + 3, layout[1]["_offset"] + 5, layout[1]["_offset"], -1, 10_000]
    requests = spark.createDataFrame(list(enumerate(some)), "request_order long, position long")
    taken = text_io.take_rows(rows, requests)
    assert [(r["request_order"], r["id"]) for r in taken.collect()] == [(i, every[p]) for i, p in enumerate(some[:4])]
    assert len(taken.inputFiles()) == 2
    assert text_io.take_rows(rows, requests.where("position < 0")).collect() == []


def test_windows_by_uneven_time(spark):
    rng = np.random.default_rng(12)
    rows = [(i, int(rng.integers(0, 4)), int(rng.integers(0, 400)) * 10, float(i)) for i in range(300)]
    rows += [(1000 + i, 7, 50, 0.5) for i in range(60)] + [(2000, None, 5, 1.0), (2001, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, g long, t long, v double")
    offsets, tolerance = [-95, 0, 30, 2000], 40
    got = {r["id"]: r["values"] for r in ep.time_windows(df, "g", "t", "id", "v", offsets, tolerance, chunk=100).collect()}
    for i, g, t, _ in rows:
        want = []
        for o in offsets:
            near = [(abs(u - t - o), u, j, v) for j, h, u, v in rows
                    if t is not None and g is not None and h == g and u is not None and abs(u - t - o) <= tolerance]
            want.append(min(near)[3] if near else None)
        assert got[i] == want
    assert ep.time_windows(df.limit(0), "g", "t", "id", "v", offsets, tolerance).count() == 0


def test_a_stopped_fill_goes_on_with_the_rest(spark, tmp_path):
    """A run dies in the middle; the next one computes only what is missing, on the same ranges."""
    store = TableStore(spark, str(tmp_path / "fills"))
    store.create("rows", spark.range(1000).withColumn("n", F.col("id") * 2), "id")
    sound = {"double": Feature(("n",), T.LongType(), lambda c: c * 2)}
    dying = {"double": Feature(("n",), T.LongType(), lambda c: F.when(c > 1100, F.raise_error(F.lit("lost"))).otherwise(c * 2).cast("long"))}
    with pytest.raises(Exception, match="lost"):
        backfill.backfill(store, "rows", ["double"], dying, checkpoint_rows=100, task_rows=30)
    begun = fills.open_fill(store, "rows", ["double"])
    assert 0 < len(begun.done) < len(begun.ranges) and "double" not in store.read("rows").columns
    kept = sum(begun.done.values())
    # Rows that come meanwhile are no part of the fill, and a new handle finds the ledger.
    store.append("rows", spark.range(1000, 1100).withColumn("n", F.col("id") * 2))
    store = TableStore(spark, str(tmp_path / "fills"))
    report = backfill.backfill(store, "rows", ["double"], sound, checkpoint_rows=100).first()
    assert (report["status"], report["rows"]) == ("DONE", 1000 - kept)
    assert fills.open_fill(store, "rows", ["double"]) is None
    assert store.read("rows").where("double = 4 * id").count() == 1000
    assert backfill.backfill(store, "rows", ["double"], sound, checkpoint_rows=70, most_ranges=1).first()["status"] == "OPEN"
    assert 0 < backfill.backfill(store, "rows", ["double"], sound, checkpoint_rows=70).first()["rows"] < 100
    assert store.read("rows").where("double = 4 * id").count() == 1100
    assert backfill.backfill(store, "rows", ["double"], sound, checkpoint_rows=70).first()["rows"] == 0
    assert sum(c.kind == "columns" for c in store._commits("rows")) == 2


def test_fills_with_text_keys_and_no_rows(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "fills"))
    rows = spark.createDataFrame([(f"k{i % 37:02}-{i}", i) for i in range(200)], "id string, n long")
    store.create("rows", rows, "id")
    one = {"one": Feature(("n",), T.LongType(), lambda c: c + 1)}
    while backfill.backfill(store, "rows", ["one"], one, checkpoint_rows=23, most_ranges=2).first()["status"] == "OPEN":
        pass
    assert store.read("rows").where("one = n + 1").count() == 200
    store.create("none", rows.limit(0), "id")
    assert backfill.backfill(store, "none", ["one"], one, checkpoint_rows=5).first()["rows"] == 0


def test_duplicate_backfill_keeps_old_flags_unless_overwritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "dups"))
    rows = spark.createDataFrame([(1, 7), (2, -1)], "id bigint, bits bigint")
    store.create("rows", rows, "id")
    backfill.backfill_near_duplicates(store, "rows", "bits", threshold=3)
    store.append("rows", spark.createDataFrame([(3, 7)], "id bigint, bits bigint"))
    backfill.backfill_near_duplicates(store, "rows", "bits", threshold=3)

    def flags():
        return {r["id"]: r["is_duplicate"] for r in store.read("rows").collect()}

    assert flags() == {1: False, 2: False, 3: True}
    backfill.backfill_near_duplicates(store, "rows", "bits", threshold=3, overwrite=True)
    assert flags() == {1: True, 2: False, 3: True}


def test_view_refresh_appends_or_rewrites(spark, store):
    backfill.backfill(store, "rows", ["even"], {"even": EVEN})
    views.create_views(store, "rows", {"evens": "even = true", "none": "id > 99"})
    assert store.views() == ["evens", "none"]
    store.append("rows", spark.range(10, 14).withColumn("text", F.lit("x")))
    backfill.backfill(store, "rows", ["even"], {"even": EVEN})
    delta = {r["name"]: r["delta"] for r in views.refresh_views(store).collect()}
    assert delta == {"evens": 2, "none": 0}
    assert views.refresh_view(store, "evens") == (7, 7)
    store.delete_where("rows", "id < 4")
    assert views.refresh_view(store, "evens") == (7, 5)
    assert sorted(views.drop_views(store)) == ["evens", "none"] and store.views() == []
    assert store.tables() == ["rows"]


def test_train_views_leave_out_copies(spark, store):
    flags = spark.range(10).select("id", F.when(F.col("id") < 8, F.col("id") < 2).alias("is_duplicate"))
    store.add_columns("rows", flags)
    views.create_view(store, "low_train", "rows", "id < 9")
    views.create_view(store, "low_val", "rows", "id < 9")
    assert store.read("low_train").count() == 7 and store.read("low_val").count() == 9


def test_stream_cycle_is_idempotent(spark, store, tmp_path):
    drops = str(tmp_path / "drops")
    backfill.backfill(store, "rows", ["even"], {"even": EVEN})
    views.create_view(store, "evens", "rows", "even = true")
    schema = "id bigint, text string"

    def drain():
        stream = file_stream(spark, drops, schema, files_per_batch=1)
        run_cycle(
            store, stream, "rows", ["even"], {"even": EVEN}, ["evens"], str(tmp_path / "offsets")
        ).awaitTermination()

    spark.range(8, 14).withColumn("text", F.lit("x")).repartition(2).write.parquet(drops)
    drain()
    assert (store.read("rows").count(), store.read("evens").count()) == (14, 7)
    drain()
    assert (store.read("rows").count(), store.read("evens").count()) == (14, 7)
    spark.range(14, 16).withColumn("text", F.lit("x")).write.mode("append").parquet(drops)
    drain()
    assert (store.read("rows").count(), store.read("evens").count()) == (16, 8)
    assert store.read("rows").where("even IS NULL").count() == 0


# --- files -------------------------------------------------------------------


def ppm(width, height, pixels):
    return f"P6\n{width} {height}\n255\n".encode() + bytes(pixels)


def test_image_and_label_files(spark, tmp_path):
    images, labels = tmp_path / "images" / "train", tmp_path / "labels" / "train"
    images.mkdir(parents=True)
    labels.mkdir(parents=True)
    for stem in ("a-1", "b-2", "c-3", "d-4", "e-5"):
        (images / f"{stem}.jpg").write_bytes(ppm(4, 2, range(24)))
    (images / "skip.txt").write_text("no image")
    box = {"x1": 1, "y1": 2, "x2": 3, "y2": 4}
    attrs = {"occluded": True, "truncated": False, "trafficLightColor": "green"}
    exact = {
        "attributes": {"weather": "clear", "scene": "highway", "timeofday": "night"},
        "frames": [{"timestamp": 10, "objects": [{"category": "car", "box2d": box, "attributes": attrs}]}],
    }
    (labels / "a-1.json").write_text(json.dumps(exact, indent=1))
    (labels / "b.json").write_text(
        json.dumps({"frames": [{"objects": [{"category": "bus", "bbox": {"xmin": 1, "ymin": 0}}]}]})
    )
    (labels / "d-4.json").write_text(json.dumps({"frames": [{"timestamp": 5, "objects": [{"category": "x"}]}]}))
    (labels / "e-5.json").write_text(json.dumps({"frames": []}))
    frames = image_io.scan_images_labels(
        image_io.read_image_files(spark, str(tmp_path / "images"), "train"),
        image_io.read_label_files(spark, str(tmp_path / "labels"), "train"),
    )
    rows = {r["image_id"]: r for r in frames.collect()}
    assert sorted(rows) == ["a-1", "b-2", "c-3", "d-4", "e-5"]
    a, b, c, d = (rows[k] for k in ("a-1", "b-2", "c-3", "d-4"))
    assert (a["weather"], a["timeofday"], a["timestamp"], a["width"], a["height"]) == ("clear", "night", 10, 4, 2)
    assert a["ann_bboxes"] == [[1, 2, 3, 4]] and a["ann_occluded"] == [True]
    assert a["ann_traffic_light_colors"] == ["green"]
    assert b["ann_categories"] == ["bus"] and b["ann_bboxes"] == [[1, 0, 4, 2]]
    assert b["weather"] == "undefined" and b["timestamp"] == 0
    assert c["num_annotations"] == 0 and c["ann_bboxes"] == []
    assert d["timestamp"] == 5 and d["num_annotations"] == 0
    first = image_io.scan_images_labels(
        image_io.read_image_files(spark, str(tmp_path / "images"), "train"),
        image_io.read_label_files(spark, str(tmp_path / "labels"), "train"), limit=2,
    )
    assert [r["image_id"] for r in first.orderBy("image_id").collect()] == ["a-1", "b-2"]


def test_object_listing(spark, tmp_path):
    for name in ("b/2.PNG", "a/1.jpg", "c/3.jpeg", "d/readme.md"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
    got = image_io.list_objects(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r["path"][-6:], r["label"]) for r in got] == [("/1.jpg", 0), ("/2.PNG", 1), ("3.jpeg", 2)]


def test_image_sizes():
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR" + (7).to_bytes(4, "big") + (5).to_bytes(4, "big")
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x05\x00\x07\x03"
    assert image_fn.read_size(png) == image_fn.read_size(jpeg) == (7, 5)
    assert image_fn.read_size(ppm(7, 5, [32] * 105)) == (7, 5)
    assert image_fn.read_size(b"text") is None


def test_pixels_survive_white_space_in_the_data():
    pixels = image_fn.decode_rgb(ppm(2, 1, [10, 32, 9, 32, 10, 13]))
    assert pixels.tolist() == [[[10, 32, 9], [32, 10, 13]]]


def test_difference_bits_match_a_direct_resize():
    rng = np.random.default_rng(0)
    pixels = rng.integers(0, 256, (13, 31, 3), dtype=np.uint8)
    gray = pixels @ np.array([0.299, 0.587, 0.114])

    def sample(y, x):
        def tap(at, size):
            at = max(at, 0.0)
            low = min(int(at), size - 1)
            return low, min(low + 1, size - 1), at - low

        (r0, r1, rw), (c0, c1, cw) = tap(y, 13), tap(x, 31)
        top = gray[r0, c0] * (1 - cw) + gray[r0, c1] * cw
        low = gray[r1, c0] * (1 - cw) + gray[r1, c1] * cw
        return top * (1 - rw) + low * rw

    small = [[sample((i + 0.5) * 13 / 8 - 0.5, (j + 0.5) * 31 / 9 - 0.5) for j in range(9)] for i in range(8)]
    want = [float(a > b) for row in small for a, b in zip(row, row[1:])]
    assert image_fn.difference_bits(pixels).tolist() == want


def test_text_shards_and_positions(spark, tmp_path):
    root = str(tmp_path / "shards")
    rows = spark.range(30).select(F.concat(F.lit("t"), "id").alias("text"), (F.col("id") / 10).alias("score"))
    rows.repartitionByRange(3, "score").sortWithinPartitions("score").write.parquet(root)
    paths = text_io.list_files(spark, root, "*.parquet")
    assert len(paths) == 3 and paths == sorted(paths)
    assert text_io.list_files(spark, root, "*.parquet", first=2) == paths[:2]
    corpus = text_io.scan_parquet_shards(spark, paths, "web").orderBy("id").collect()
    assert [(r["id"], r["text"]) for r in corpus] == [(i, f"t{i}") for i in range(30)]
    assert [r["n_chars"] for r in corpus[8:11]] == [2, 2, 3]
    assert text_io.scan_parquet_shards(spark, paths, "web", rows=7).count() == 7
    layout = text_io.file_layout(spark.read.parquet(root))
    wanted = spark.range(30).select(F.col("id").alias("position"))
    found = text_io.locate(layout, wanted).collect()
    sizes = {r["_file"]: r["_rows"] for r in layout.collect()}
    starts = dict(zip(sorted(sizes), np.cumsum([0] + [sizes[f] for f in sorted(sizes)]).tolist()))
    for r in found:
        assert starts[r["file"]] + r["offset"] == r["position"]


def test_json_records(spark, tmp_path):
    root = str(tmp_path / "json")
    spark.range(20).select(F.col("id").cast("string").alias("text")).coalesce(1).write.json(root)
    rows = text_io.scan_json_records(spark, root, "web", rows=12).orderBy("id").collect()
    assert [(r["id"], r["text"], r["score"]) for r in rows] == [(i, str(i), 0.0) for i in range(12)]


# --- functions ---------------------------------------------------------------


def test_byte_tokens_of_nulls_slices_and_unicode():
    texts = ["", "aé", None, "zz"]
    column = pa.array(["skip", *texts])[1:]
    got = text_fn.byte_tokens.func(column).to_pylist()
    assert got == [None if t is None else [256, *t.encode(), 257] for t in texts]


def test_white_space_equals_python_split(spark):
    odd = "".join(chr(c) for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8202, 8232, 8233, 8239, 8287, 12288])
    texts = [f"{odd}a{odd}b c{odd}", "zero​width", "", odd]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(text_fn.normalize_space(F.col("t"))).collect()]
    assert got == [" ".join(t.split()) for t in texts]


def test_repeat_flags_keep_the_first_and_null(spark):
    rows = [(1, "a b"), (2, "a  b"), (3, None), (4, "c"), (5, " a\nb ")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    assert dict(dedup.repeat_flags(df).collect()) == {1: False, 2: True, 3: None, 4: False, 5: True}


def test_detector_column(spark):
    def make_predict():
        return lambda batch: [([[0.0, 0.0, float(len(b)), 1.0]], [1], [0.9]) for b in batch]

    rows = spark.createDataFrame([(bytearray(b"abc"),)], "image binary")
    got = rows.select(detector(make_predict)("image").alias("d")).first()["d"]
    assert got["boxes"] == [[0.0, 0.0, 3.0, 1.0]] and got["labels"] == [1]


def test_unknown_filter_and_missing_columns(spark):
    with pytest.raises(ValueError):
        filters.spec_filter("nope")
    assert missing_columns(spark.range(1), ["id", "b", "a"]) == ["a", "b"]


def test_model_health(spark, tmp_path):
    metrics = {
        "baseline": {"map_50": 0.4, "precision": 0.5, "recall": 0.6}, "epochs": 3, "val_table": "v",
        "finetuned": {"map_50": 0.5, "precision": 0.5, "recall": 0.7},
    }
    for model, files in {"good": ["m.pt", "metrics.json"], "bare": ["m.pt"], "none": ["metrics.json"]}.items():
        (tmp_path / model).mkdir()
        for name in files:
            (tmp_path / model / name).write_text(json.dumps(metrics) if name.endswith("json") else "weights")
    compared = evaluate.compare_metrics(health.read_model_metrics(spark, str(tmp_path)))
    status = {r["model"]: r["status"] for r in compared.collect()}
    assert status == {"good": "PASS", "bare": "WARN", "none": "SKIP"}
    assert {r["status"]: r["n"] for r in health.summarize(health.model_checks(compared)).collect()} == {
        "PASS": 1, "WARN": 1, "SKIP": 1,
    }


def test_index_recall_and_many_queries(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(400, 16)).astype("float32")
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id bigint, v array<float>")
    queries = [(i, data[i].tolist()) for i in range(0, 50, 5)]
    monkeypatch.setattr(search, "QUERIES_PER_PASS", 3)
    got = search.nearest(rows, "id", "v", queries, 4, exclude_self=True).collect()
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    for i, _ in queries:
        scores = unit @ unit[i]
        scores[i] = -2
        want = set(np.argsort(-scores)[:4].tolist())
        assert {r["id"] for r in got if r["query_id"] == i} == want
    path = str(tmp_path / "index")
    search.build_vector_index(rows, "id", "v", path, cells=6, subspaces=4, codes=32)
    exact = {r["id"] for r in search.vector_search(rows, "id", "v", queries[1][1], 10).collect()}
    full = search.indexed_vector_search(spark, path, queries[1][1], 10, nprobe=6).collect()
    assert {r["id"] for r in full} == exact
    rough = search.indexed_vector_search(spark, path, queries[1][1], 10, nprobe=4, refine=12).collect()
    assert len({r["id"] for r in rough} & exact) >= 6


def test_index_places_rows_and_codes_in_one_python_step(spark, tmp_path, monkeypatch):
    data = np.random.default_rng(4).normal(size=(200, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "id bigint, v array<double>")
    steps, kept = [], type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, *a: steps.append(1) or kept(self, *a))
    path = str(tmp_path / "index")
    search.build_vector_index(rows, "id", "v", path, cells=3, metric="l2", subspaces=4, codes=8)
    monkeypatch.undo()
    assert len(steps) == 1
    centers = np.array([r["center"] for r in spark.read.parquet(f"{path}/centers").orderBy("cell").collect()])
    book = spark.read.parquet(f"{path}/codebook").orderBy("subspace", "code").collect()
    books = [np.array([r["center"] for r in book if r["subspace"] == s]) for s in range(4)]
    stored = {r["id"]: r for r in spark.read.parquet(f"{path}/vectors").collect()}
    assert len(stored) == 200
    for i, v in enumerate(data):
        assert stored[i]["cell"] == ((centers - v) ** 2).sum(axis=1).argmin()
        assert stored[i]["code"] == [int(((b - p) ** 2).sum(axis=1).argmin()) for b, p in zip(books, np.split(v, 4))]


def test_a_question_is_sent_once_to_a_shelf_whatever_its_open_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 20)
    monkeypatch.setattr(neighbors, "SHELF_ROWS", 100)
    monkeypatch.setattr(neighbors, "ASKED_AT_ONCE", 60)
    vectors = np.random.default_rng(12).normal(size=(300, 12))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    sizes, keep = [], neighbors.checkpointed
    monkeypatch.setattr(neighbors, "checkpointed", lambda df: sizes.append(keep(df)) or sizes[-1])
    found = search.neighbors_of(rows, "id", "v", 2)
    assert {(r["query_id"], r["id"]) for r in found.collect()} == plain_neighbors(vectors, 2)
    blocks = sizes[-1].where("kind = 0").count()
    sent = sizes[-1].where("kind = 1").agg(F.sum(F.size("ids"))).first()[0]
    assert sent <= len(vectors) * -(-blocks // 5)


def test_text_index_shuffles_its_postings_once(spark, tmp_path):
    rows = [(1, "b a b"), (2, None), (3, "..."), (4, "A c"), (4, "A c"), (4, "c c c"), (None, "a"), (None, "a")]
    docs = spark.createDataFrame(rows, "id bigint, text string")
    once = search.postings(docs.where("id < 4"), "id", "text", 2)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan
    assert sorted(map(tuple, once.select("term", "id", "length", "tf").collect())) == [("a", 1, 3, 1), ("b", 1, 3, 2)]
    # Rows that share id and length count as one document.
    search.write_text_index(docs, "id", "text", str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index" / "postings"))
    found = {(r.term, r.id, r.length): r.tf for r in stored.collect()}
    assert stored.count() == len(found) and found == {
        ("a", 1, 3): 1, ("b", 1, 3): 2, ("a", 4, 2): 2, ("c", 4, 2): 2, ("c", 4, 3): 3, ("a", None, 1): 2}
    assert spark.read.parquet(str(tmp_path / "index" / "stats")).first()["docs"] == 7


def test_shelves_and_parts_grow_with_the_rows(spark, monkeypatch):
    for name, value in (("BLOCK_ROWS", 5), ("SHELF_ROWS", 20), ("ASKED_AT_ONCE", 30)):
        monkeypatch.setattr(neighbors, name, value)
    vectors = np.random.default_rng(13).normal(size=(300, 12))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<double>")
    sizes, keep = [], neighbors.checkpointed
    monkeypatch.setattr(neighbors, "checkpointed", lambda df: sizes.append(keep(df)) or sizes[-1])
    found = search.neighbors_of(rows, "id", "v", 2)
    assert {(r["query_id"], r["id"]) for r in found.collect()} == plain_neighbors(vectors, 2)
    # An eighth of the rows, 38, are seven blocks on a shelf, not the least of four.
    blocks = sizes[-1].where("kind = 0").count()
    sent = sizes[-1].where("kind = 1").agg(F.sum(F.size("ids"))).first()[0]
    assert sent <= len(vectors) * -(-blocks // 7)
    assert neighbors.held_rows(3_000_000, 8, 20, 256) == 131_072
    assert neighbors.held_rows(3_000_000, 8, 20, 1 << 30) == 20
