"""The paths for hot keys give the same rows as the plain paths or brute force."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import dedup, evaluate, ordering
from quern.operators.episodes import episode_windows


def hamming_fixture(spark, seed):
    """Hashes with copies, near copies, and many that share their lowest band."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(60)]
    base += [(rng.getrandbits(48) << 16) | 0xBEEF for _ in range(60)]
    hashes = list(base)
    for h in base[::3]:
        flips = rng.randint(0, 13)
        for bit in rng.sample(range(64), flips):
            h ^= 1 << bit
        hashes.append(h)
    signed = [h - (1 << 64) if h >= 1 << 63 else h for h in hashes]
    rows = [(i, h) for i, h in enumerate(signed)] + [(len(signed), None)]
    return rows, spark.createDataFrame(rows, "id bigint, h bigint")


def brute_force_nearest(rows, threshold):
    known = [(i, h) for i, h in rows if h is not None]
    found = {}
    for i, a in known:
        gaps = [(bin((a ^ b) & (2**64 - 1)).count("1"), j) for j, b in known if j != i]
        distance, near = min(gaps)
        found[i] = (distance, near) if distance <= threshold else (None, None)
    return found


@pytest.mark.parametrize("hot_rows", [100_000, 8])
@pytest.mark.parametrize("threshold", [10, 3])
def test_hamming_neighbors_match_brute_force(spark, hot_rows, threshold):
    rows, df = hamming_fixture(spark, threshold)
    near = dedup.hamming_neighbors(df, "id", "h", threshold, hot_band_rows=hot_rows)
    got = {r["id"]: (r["distance"], r["near_id"]) for r in near.collect()}
    assert got == brute_force_nearest(rows, threshold)


def test_probes_are_not_broadcast(spark):
    hashes = spark.range(100).selectExpr("xxhash64(id) AS h", "id AS keep_id")
    near = dedup.nearest_distinct(hashes, hashes.select("h"), 10)
    plan = near._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_flags_have_three_states_and_keep_first(spark):
    rows = [(1, 5), (2, 5), (3, 5), (4, -1), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, h bigint")
    flags = dict(dedup.flag_near_duplicates(df, "id", "h", threshold=2).collect())
    assert flags == {1: True, 2: True, 3: True, 4: False, 5: None}
    kept = dict(dedup.flag_near_duplicates(df, "id", "h", threshold=2, keep_first=True).collect())
    assert kept == {1: False, 2: True, 3: True, 4: False, 5: None}


def test_salted_lookup_equals_join(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_KEY_ROWS", 10)
    rows = spark.range(300).select("id", F.when(F.col("id") < 150, 1).otherwise(F.col("id")).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("k <> 299")
    salted = dedup.salted_lookup(rows, table, "k", "id", "n")
    plain = rows.join(table, "k", "left")
    assert sorted(salted.select("id", "k", "n", "low").collect()) == sorted(
        plain.select("id", "k", "n", "low").collect()
    )


@pytest.mark.parametrize("group", [["g"], []])
def test_running_totals_by_ranges_equal_window(spark, group):
    rows = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        (F.col("id") * 7919 % 50).alias("score"),
    )
    order = [F.col("score").desc(), F.col("id").asc()]
    sums = {"rank": F.lit(1).cast("bigint"), "total": F.col("score")}
    plain = ordering.running_totals(rows, group, order, sums)
    ranged = ordering.running_totals(rows, group, order, sums, max_group_rows=10)
    assert sorted(plain.collect()) == sorted(ranged.select(*plain.columns).collect())


def crowded_boxes(spark, n, seed=1):
    rng = random.Random(seed)
    truths, preds = [], []
    for i in range(n):
        x, y = rng.randint(0, 120), rng.randint(0, 120)
        w, h = rng.choice([3, 8, 20, 60]), rng.choice([3, 8, 20, 60])
        box = [float(v) for v in (x, y, x + w, y + h)]
        truths.append((1, i, "car", *box))
        moved = [v + rng.randint(-2, 2) for v in box]
        preds.append((1, i, "car", *moved, rng.randint(0, 20) / 20))
        if i % 3 == 0:
            truths.append((1, n + i, "car", *box))
            preds.append((1, n + i, "car", *moved, rng.randint(0, 20) / 20))
    edges = "x1 double, y1 double, x2 double, y2 double"
    return (
        truths,
        preds,
        spark.createDataFrame(truths, f"frame_key bigint, box_id bigint, category string, {edges}"),
        spark.createDataFrame(
            preds, f"frame_key bigint, pred_id bigint, category string, {edges}, score double"
        ),
    )


def greedy_reference(truths, preds, threshold):
    """Predictions by falling score take their best truth if it is free."""

    def overlap(a, b):
        w = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
        h = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
        union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
        return w * h / max(union, 1e-6)

    taken, tp = set(), {}
    for p in sorted((p for p in preds if p[7] >= 0.3), key=lambda p: (-p[7], p[1])):
        best, truth = max((overlap(p[3:7], t[3:7]), -t[1]) for t in truths)
        tp[p[1]] = int(best >= threshold and truth not in taken)
        if tp[p[1]]:
            taken.add(truth)
    return tp


@pytest.mark.parametrize("grid_boxes", [10_000, 5])
def test_greedy_match_with_and_without_grid(spark, grid_boxes):
    truths, preds, t, p = crowded_boxes(spark, 150)
    matches = evaluate.match_predictions(
        evaluate.labelled_truths(t), evaluate.confident(p), grid_boxes=grid_boxes
    )
    got = {r["pred_id"]: r["tp"] for r in matches.collect()}
    assert got == greedy_reference(truths, preds, 0.5)


def test_metrics_by_ranges_equal_window(spark):
    _, _, t, p = crowded_boxes(spark, 80)
    plain = evaluate.detection_metrics(t, p).first()
    ranged = evaluate.detection_metrics(t, p, grid_boxes=5, max_group_rows=10).first()
    assert [round(v, 12) for v in plain] == [round(v, 12) for v in ranged]


def test_first_point_of_the_curve_is_not_counted(spark):
    edges = (0.0, 0.0, 10.0, 10.0)
    schema = "x1 double, y1 double, x2 double, y2 double"
    t = spark.createDataFrame(
        [(1, 1, "car", *edges)], f"frame_key bigint, box_id bigint, category string, {schema}"
    )
    p = spark.createDataFrame(
        [(1, 1, "car", *edges, 0.9)],
        f"frame_key bigint, pred_id bigint, category string, {schema}, score double",
    )
    assert tuple(evaluate.detection_metrics(t, p).first()) == (0.0, 1.0, 1.0)


def test_windows_do_not_depend_on_chunks(spark):
    rows = spark.range(100).select(
        F.col("id").alias("idx"),
        F.when(F.col("id") < 90, 0).otherwise(90).cast("bigint").alias("ep_start"),
        F.when(F.col("id") < 90, 90).otherwise(100).cast("bigint").alias("ep_end"),
        (F.col("id") * 10).cast("double").alias("action"),
    )
    got = {r["idx"]: r for r in episode_windows(rows, chunk_rows=16).collect()}
    assert len(got) == 100
    for i, r in got.items():
        low, high = (0, 89) if i < 90 else (90, 99)
        want = [min(max(i + s, low), high) * 10.0 for s in range(-1, 15)]
        assert r["actions"] == want
        assert r["observations"] == [max(i - 1, low) * 10.0, i * 10.0]
        assert r["action_is_pad"] == [not low <= i + s <= high for s in range(-1, 15)]


def test_frames_without_crowds_shuffle_each_side_once(spark):
    edges = "x1 double, y1 double, x2 double, y2 double"
    box, far = (0.0, 0.0, 10.0, 10.0), (1.0, 0.0, 11.0, 10.0)
    truths = [(1, 1, 2, *box), (1, 2, 2, *far), (1, 1, 2, *box), (1, 3, 1, *box), (2, 5, 2, *box), (None, 6, 2, *box)]
    preds = [
        (1, 1, 2, 0.9, *box), (1, 1, 2, 0.9, *box), (1, 1, 2, 0.5, *far), (1, 1, 1, 0.4, *box), (1, 2, 1, 0.9, *far),
        (1, None, 2, 0.95, *far), (2, 7, 3, 0.9, *box), (2, 8, 2, 0.7, *box), (2, 8, 2, 0.7, *box), (2, 9, 2, 0.7, *box),
        (3, 1, 2, 0.9, *box), (None, 1, 2, 0.9, *box)]
    t = spark.createDataFrame(truths, f"frame_key bigint, box_id bigint, label int, {edges}")
    p = spark.createDataFrame(preds, f"frame_key bigint, pred_id bigint, label int, score double, {edges}")
    plain = evaluate.match_predictions(t, p)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2

    def rows(df):
        return sorted(map(str, df.select("frame_key", "label", "pred_id", "score", "tp").collect()))

    # One frame is crowded, or all are: the same matches, rows that repeat a frame and id included.
    assert rows(plain) == rows(evaluate.match_predictions(t, p, grid_boxes=4))
    assert rows(plain) == rows(evaluate.match_predictions(t, p, grid_boxes=0))
    with pytest.raises(ValueError):
        evaluate.match_predictions(t, p, threshold=1.0)
