"""Scoring detections against ground truth."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.boxes import category_class, iou
from quern.operators.ordering import running_totals
from quern.schema import IOU_THRESHOLD, SCORE_THRESHOLD
from quern.session import checkpointed

BOX = ["x1", "y1", "x2", "y2"]
GROUP = ["frame_key", "label"]

# Distinct boxes of one class in one frame, truths or predictions, beyond which
# pairs are found through a spatial grid. A frame with no more boxes in all is matched in one piece.
GRID_BOXES = 256


def labelled_truths(boxes: DataFrame) -> DataFrame:
    """(frame_key, box_id, label, x1..y2) of boxes with a class and a positive extent."""
    kept = boxes.withColumn("label", category_class(F.col("category"))).where(
        F.col("label").isNotNull() & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    )
    return kept.select("frame_key", "box_id", "label", *BOX)


def confident(predictions: DataFrame, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """(frame_key, pred_id, label, score, x1..y2) with a class and enough score."""
    labelled = predictions.withColumn("label", category_class(F.col("category")))
    kept = labelled.where(F.col("label").isNotNull() & (F.col("score") >= threshold))
    return kept.select("frame_key", "pred_id", "label", "score", *BOX)


def frame_classes(truths: DataFrame) -> DataFrame:
    return truths.select(*GROUP).distinct()


def _extent(prefix: str, axis: str) -> Column:
    return F.col(f"{prefix}{axis}2") - F.col(f"{prefix}{axis}1")


def _level(length: Column) -> Column:
    return F.floor(F.log2(length)).cast("int")


def _truth_cell(axis: str, reach: float) -> Column:
    """Size level of the truth along an axis and the cell of its lower edge."""
    level = _level(_extent("t_", axis))
    side = F.pow(F.lit(2.0), level + 2) * reach
    return F.struct(level.alias("l"), F.floor(F.col(f"t_{axis}1") / side).alias("c"))


def _probe_cells(axis: str, threshold: float, reach: float) -> Column:
    """Every (level, cell) a truth with enough overlap can have along an axis."""
    size = _extent("p_", axis)
    levels = F.sequence(_level(size * (threshold * (1 - 1e-9))), _level(size / threshold * (1 + 1e-9)))

    def cells(level: Column) -> Column:
        side = F.pow(F.lit(2.0), level + 2) * reach
        low = F.floor((F.col(f"p_{axis}1") - side / 2) / side)
        high = F.floor((F.col(f"p_{axis}1") + side / 2) / side)
        return F.transform(F.sequence(low, high), lambda c: F.struct(level.alias("l"), c.alias("c")))

    return F.flatten(F.transform(levels, cells))


def _reach(threshold: float) -> float:
    reach = 1 / threshold - 1 if 0 < threshold < 1 else 0
    if not math.isfinite(reach) or reach <= 0:
        raise ValueError("the threshold must lie between 0 and 1")
    return reach


def overlap_pairs(
    predictions: DataFrame,
    truths: DataFrame,
    threshold: float = IOU_THRESHOLD,
    grid_boxes: int = GRID_BOXES,
) -> DataFrame:
    """Same-class pairs of a frame with IoU of at least ``threshold``, column ``iou``.

    The threshold lies strictly between 0 and 1. Inputs carry ``p_``/``t_`` box columns. Ordinary frames are an equi-join on
    (frame, class). A crowded (frame, class) also joins on a grid cell per axis:
    an overlap of t bounds the ratio of the extents by t and the gap between the
    lower edges by (1/t - 1) extents, so only nearby boxes of similar size meet.
    """
    reach = _reach(threshold)
    matched = iou("p_", "t_")
    # Either side may crowd a frame: a few truths meet a million predictions as well.
    sides = truths.select(*GROUP, F.lit(0).alias("p"), F.lit(1).alias("t")).unionByName(
        predictions.select(*GROUP, F.lit(1).alias("p"), F.lit(0).alias("t"))
    )
    sizes = sides.groupBy(*GROUP).agg(F.sum("p").alias("p"), F.sum("t").alias("t"))
    most = F.greatest("p", "t")
    crowded = sizes.where((most > grid_boxes) & (F.least("p", "t") > 0)).select(
        *GROUP, F.lit(True).alias("crowded")
    )
    if crowded.isEmpty():
        joined = predictions.join(truths, GROUP)
        return joined.withColumn("iou", matched).where(F.col("iou") >= threshold)

    usable = predictions.where((_extent("p_", "x") > 0) & (_extent("p_", "y") > 0))
    marked_t = truths.join(crowded, GROUP, "left")
    marked_p = usable.join(crowded, GROUP, "left")
    plain = marked_p.where("crowded IS NULL").join(marked_t.where("crowded IS NULL"), GROUP)
    gridded_t = marked_t.where("crowded").withColumns(
        {"cx": _truth_cell("x", reach), "cy": _truth_cell("y", reach)}
    )
    gridded_p = (
        marked_p.where("crowded")
        .withColumn("cx", F.explode(_probe_cells("x", threshold, reach)))
        .withColumn("cy", F.explode(_probe_cells("y", threshold, reach)))
    )
    near = gridded_p.join(gridded_t, [*GROUP, "cx", "cy"]).drop("cx", "cy")
    both = plain.drop("crowded").unionByName(near.drop("crowded"))
    return both.withColumn("iou", matched).where(F.col("iou") >= threshold)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in BOX})


def match_predictions(
    truths: DataFrame,
    predictions: DataFrame,
    threshold: float = IOU_THRESHOLD,
    grid_boxes: int = GRID_BOXES,
) -> DataFrame:
    """Predictions of classes present in the frame's truth, with ``tp`` 0/1.

    A prediction is right if its best truth overlaps enough and no higher-scored
    prediction has the same best truth. Score ties go to the lowest prediction
    id, overlap ties to the lowest truth id. Each side is shuffled once, by frame;
    only frames with more than ``grid_boxes`` boxes on a side are joined box by box.
    """
    _reach(threshold)
    sides = truths.select("frame_key", F.lit(0).alias("p"), F.lit(1).alias("t")).unionByName(
        predictions.select("frame_key", F.lit(1).alias("p"), F.lit(0).alias("t"))
    )
    sizes = sides.groupBy("frame_key").agg(F.sum("p").alias("p"), F.sum("t").alias("t"))
    crowded = checkpointed(sizes.where(F.greatest("p", "t") > grid_boxes).select("frame_key"))
    if crowded.isEmpty():
        return _matched_by_frame(truths, predictions, threshold)
    plain = _matched_by_frame(
        truths.join(crowded, "frame_key", "left_anti"), predictions.join(crowded, "frame_key", "left_anti"), threshold
    )
    return plain.unionByName(
        _matched_by_box(
            truths.join(crowded, "frame_key", "left_semi"),
            predictions.join(crowded, "frame_key", "left_semi"),
            threshold,
            grid_boxes,
        )
    )


def _matched_by_frame(truths: DataFrame, predictions: DataFrame, threshold: float) -> DataFrame:
    """The matches of frames whose truths fit in one row."""
    of_frame = truths.groupBy("frame_key").agg(F.collect_list(F.struct("label", "box_id", *BOX)).alias("truths"))
    own = F.filter("truths", lambda t: t["label"] == F.col("label"))
    overlaps = F.transform(own, lambda t: F.struct(iou("", t).alias("iou"), (-t["box_id"]).alias("order")))
    ranked = F.struct(F.col("score"), (-F.col("pred_id")).alias("order"))
    best = predictions.join(of_frame, "frame_key").select(
        *GROUP, "pred_id", "score", ranked.alias("ranked"), F.array_max(overlaps).alias("best")
    ).where("best IS NOT NULL")
    near = F.coalesce(F.col("best.iou") >= threshold, F.lit(False))
    placed = best.select(*GROUP, "pred_id", "score", "ranked", near.alias("near"), F.col("best.order").alias("truth"))
    of_truth = Window.partitionBy(*GROUP, "near", "truth")
    won = F.col("near") & F.col("pred_id").isNotNull() & (F.col("ranked") == F.max("ranked").over(of_truth))
    # A prediction is known by its frame and id. Rows that share these are right together, once for each truth won.
    of_id = Window.partitionBy("frame_key", "pred_id")
    wins = F.collect_set(F.when(F.col("won"), F.struct("label", "truth"))).over(of_id)
    judged = placed.withColumn("won", won).select(*GROUP, "pred_id", "score", F.size(wins).alias("wins"))
    tp = F.least("wins", F.lit(1))
    return judged.select(*GROUP, "pred_id", "score", F.explode(F.array_repeat(tp, F.greatest("wins", F.lit(1)))).alias("tp"))


def _matched_by_box(truths: DataFrame, predictions: DataFrame, threshold: float, grid_boxes: int) -> DataFrame:
    """The matches of crowded frames, by pairs of boxes.

    Identical boxes collapse before the join: of equal truths only the lowest id can be best, and
    of equal predictions only the best-scored can win.
    """
    # Written once: the crowd check, the classes of a frame and the join all read it.
    distinct_t = checkpointed(truths.groupBy(*GROUP, *BOX).agg(F.min("box_id").alias("box_id")))
    counted = predictions.join(frame_classes(distinct_t), GROUP, "left_semi")
    ranked = F.struct(F.col("score"), (-F.col("pred_id")).alias("order"))
    distinct_p = predictions.groupBy(*GROUP, *BOX).agg(F.max(ranked).alias("top"))
    pairs = overlap_pairs(
        _prefixed(distinct_p, "p_"), _prefixed(distinct_t, "t_"), threshold, grid_boxes
    )
    p_box = [f"p_{c}" for c in BOX]
    best = pairs.groupBy(*GROUP, *p_box).agg(
        F.max(F.struct(F.col("iou"), (-F.col("box_id")).alias("order"))).alias("best"),
        F.max("top").alias("top"),
    )
    winners = best.groupBy(*GROUP, F.col("best.order").alias("truth")).agg(F.max("top").alias("top"))
    right = winners.select("frame_key", (-F.col("top.order")).alias("pred_id"), F.lit(1).alias("tp"))
    return (
        counted.select(*GROUP, "pred_id", "score")
        .join(right, ["frame_key", "pred_id"], "left")
        .withColumn("tp", F.coalesce(F.col("tp"), F.lit(0)))
    )


def precision_recall(
    truths: DataFrame, matches: DataFrame, max_group_rows: int = 2_000_000
) -> DataFrame:
    """Cumulative precision and recall per class by falling score; ``step`` from 0.

    The matches are narrow rows behind several joins and are used more than once,
    so they are written to the shared folder first.
    """
    order = [F.col("score").desc(), F.col("frame_key").asc(), F.col("pred_id").asc()]
    curve = running_totals(
        checkpointed(matches),
        ["label"],
        order,
        {"rank": F.lit(1).cast("bigint"), "tp_cum": F.col("tp").cast("bigint")},
        max_group_rows,
    )
    n_gt = truths.groupBy("label").agg(F.count("*").alias("n_gt"))  # one row per class
    return curve.join(F.broadcast(n_gt), "label").select(
        *GROUP,
        "pred_id",
        "score",
        "tp",
        (F.col("rank") - 1).alias("step"),
        (F.col("tp_cum") / F.col("rank")).alias("precision"),
        (F.col("tp_cum") / F.col("n_gt")).alias("recall"),
    )


def class_metrics(
    truths: DataFrame, matches: DataFrame, max_group_rows: int = 2_000_000
) -> DataFrame:
    """(label, n_gt, tp, fp, ap) for every class with truth.

    AP adds each rise of the recall times the precision there. The first point of
    the curve has no rise before it and is not counted.
    """
    n_gt = truths.groupBy("label").agg(F.count("*").alias("n_gt"))
    curve = precision_recall(truths, matches, max_group_rows)
    rise = F.when((F.col("step") > 0) & (F.col("tp") == 1), F.col("precision"))
    sums = curve.groupBy("label").agg(
        F.sum("tp").cast("bigint").alias("tp"),
        F.sum(1 - F.col("tp")).cast("bigint").alias("fp"),
        F.coalesce(F.sum(rise), F.lit(0.0)).alias("_area"),
    )
    joined = n_gt.join(sums, "label", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "label",
        "n_gt",
        F.coalesce("tp", zero).alias("tp"),
        F.coalesce("fp", zero).alias("fp"),
        (F.coalesce(F.col("_area"), F.lit(0.0)) / F.col("n_gt")).alias("ap"),
    )


def detection_metrics(
    boxes: DataFrame,
    predictions: DataFrame,
    score_threshold: float = SCORE_THRESHOLD,
    threshold: float = IOU_THRESHOLD,
    grid_boxes: int = GRID_BOXES,
    max_group_rows: int = 2_000_000,
) -> DataFrame:
    """One row: macro AP, micro precision and micro recall."""
    truths = labelled_truths(boxes)
    matches = match_predictions(
        truths, confident(predictions, score_threshold), threshold, grid_boxes
    )
    per_class = class_metrics(truths, matches, max_group_rows)
    ratio = {
        "map_50": F.avg("ap"),
        "precision": F.try_divide(F.sum("tp"), F.sum(F.col("tp") + F.col("fp"))),
        "recall": F.try_divide(F.sum("tp"), F.sum("n_gt")),
    }
    return per_class.agg(*[F.coalesce(c, F.lit(0.0)).alias(n) for n, c in ratio.items()])


def compare_metrics(metrics: DataFrame) -> DataFrame:
    """Deltas of (model, baseline, finetuned) rows; PASS when the macro AP rises.

    Rows read from metric files: a model without a checkpoint is SKIP, one without
    metrics WARN.
    """
    delta = {
        f"{m}_delta": F.col(f"finetuned.{m}") - F.col(f"baseline.{m}")
        for m in ("map_50", "precision", "recall")
    }
    has_checkpoint = (
        F.col("has_checkpoint") if "has_checkpoint" in metrics.columns else F.lit(True)
    )
    status = (
        F.when(~has_checkpoint, "SKIP")
        .when(F.col("baseline").isNull() | F.col("finetuned").isNull(), "WARN")
        .when(F.col("map_50_delta") > 0, "PASS")
        .otherwise("FAIL")
    )
    return (
        metrics.withColumns(delta).withColumn("status", status).select("model", *delta, "status")
    )
