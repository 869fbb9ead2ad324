"""Detection scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.boxes import iou
from quern.operators import evaluate
from quern.plans.inputs import boxes, predictions, with_sql
from quern.plans.registry import query

CLASSES = """classes(category, label) as (values ('person',1),('rider',1),('bicycle',2),('car',3),('motorcycle',4),
  ('bus',6),('train',7),('truck',8),('traffic light',10))"""

STEPS = f""", {CLASSES},
truths as (select frame_key, box_id, label, x1, y1, x2, y2 from boxes join classes using (category) where x2>x1 and y2>y1),
preds as (select frame_key, pred_id, label, score, x1, y1, x2, y2 from predictions join classes using (category) where score >= 0.3),
pairs as (select p.frame_key, p.label, p.pred_id, p.score, t.box_id,
    greatest(least(p.x2,t.x2)-greatest(p.x1,t.x1),0)*greatest(least(p.y2,t.y2)-greatest(p.y1,t.y1),0) as inter,
    (p.x2-p.x1)*(p.y2-p.y1)+(t.x2-t.x1)*(t.y2-t.y1) as areas
  from preds p join truths t on p.frame_key=t.frame_key and p.label=t.label),
scored as (select *, inter/greatest(areas-inter, 1e-6) as iou from pairs),
best as (select * from (select *, row_number() over (partition by frame_key, pred_id order by iou desc, box_id) as r from scored) where r=1 and iou>=0.5),
winners as (select * from (select *, row_number() over (partition by frame_key, label, box_id order by score desc, pred_id) as w from best) where w=1),
matches as (select p.frame_key, p.label, p.pred_id, p.score, cast(case when w.pred_id is null then 0 else 1 end as int) as tp
  from preds p semi join truths t on p.frame_key=t.frame_key and p.label=t.label
  left join winners w on w.frame_key=p.frame_key and w.pred_id=p.pred_id),
n_gt as (select label, count(*) as n_gt from truths group by label),
curve as (select m.*, row_number() over o - 1 as step, sum(tp) over o as tp_cum, n_gt
  from matches m join n_gt using (label) window o as (partition by label order by score desc, frame_key, pred_id)),
per_class as (select g.label, g.n_gt, cast(coalesce(sum(tp),0) as bigint) as tp, cast(coalesce(sum(1-tp),0) as bigint) as fp,
    coalesce(sum(case when step>0 and tp=1 then cast(tp_cum as double)/(step+1) end), 0)/g.n_gt as ap
  from n_gt g left join curve c on c.label=g.label group by g.label, g.n_gt)
"""
MATCHED = with_sql("boxes", "predictions") + STEPS


def truths_of(spark, d):
    return evaluate.labelled_truths(boxes(spark, d))


def matches_of(spark, d):
    return evaluate.match_predictions(truths_of(spark, d), evaluate.confident(predictions(spark, d)))


@query("score_cutoff", MATCHED + "select frame_key, pred_id, label, score from preds")
def score_cutoff(spark, d):
    return evaluate.confident(predictions(spark, d)).select("frame_key", "pred_id", "label", "score")


@query(
    "iou",
    with_sql("boxes", "predictions")
    + """select p.frame_key, p.pred_id, round(greatest(least(p.x2,t.x2)-greatest(p.x1,t.x1),0)*greatest(least(p.y2,t.y2)-greatest(p.y1,t.y1),0)
      / greatest((p.x2-p.x1)*(p.y2-p.y1)+(t.x2-t.x1)*(t.y2-t.y1)-greatest(least(p.x2,t.x2)-greatest(p.x1,t.x1),0)*greatest(least(p.y2,t.y2)-greatest(p.y1,t.y1),0), 1e-6), 6) as iou
      from predictions p join boxes t on p.frame_key=t.frame_key and p.pred_id=t.box_id""",
)
def iou_of_own_box(spark, d):
    left = predictions(spark, d).withColumnsRenamed({c: f"p_{c}" for c in evaluate.BOX})
    right = boxes(spark, d).withColumnsRenamed({c: f"t_{c}" for c in evaluate.BOX})
    right = right.withColumnRenamed("box_id", "pred_id").drop("category")
    joined = left.join(right, ["frame_key", "pred_id"])
    return joined.select("frame_key", "pred_id", F.round(iou("p_", "t_"), 6).alias("iou"))


@query(
    "iou_theta_join",
    MATCHED + "select frame_key, label, pred_id, box_id, round(iou, 6) as iou from scored where iou >= 0.5",
)
def iou_theta_join(spark, d):
    left = evaluate.confident(predictions(spark, d))
    left = left.withColumnsRenamed({c: f"p_{c}" for c in evaluate.BOX})
    right = truths_of(spark, d).withColumnsRenamed({c: f"t_{c}" for c in evaluate.BOX})
    pairs = evaluate.overlap_pairs(left, right)
    return pairs.select("frame_key", "label", "pred_id", "box_id", F.round("iou", 6).alias("iou"))


@query("distinct_classes", MATCHED + "select distinct frame_key, label from truths")
def distinct_classes(spark, d):
    return evaluate.frame_classes(truths_of(spark, d))


@query(
    "score_sort",
    MATCHED + "select frame_key, pred_id, label, score, step from curve",
)
def score_sort(spark, d):
    curve = evaluate.precision_recall(truths_of(spark, d), matches_of(spark, d))
    return curve.select("frame_key", "pred_id", "label", "score", "step")


@query("greedy_match", MATCHED + "select frame_key, label, pred_id, score, tp from matches")
def greedy_match(spark, d):
    return matches_of(spark, d).select("frame_key", "label", "pred_id", "score", "tp")


@query(
    "pr_curve",
    MATCHED
    + """select frame_key, label, pred_id, step, round(cast(tp_cum as double)/(step+1), 9) as precision,
      round(cast(tp_cum as double)/n_gt, 9) as recall from curve""",
)
def pr_curve(spark, d):
    curve = evaluate.precision_recall(truths_of(spark, d), matches_of(spark, d))
    return curve.select(
        "frame_key", "label", "pred_id", "step",
        F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"),
    )


@query("average_precision", MATCHED + "select label, n_gt, tp, fp, round(ap, 9) as ap from per_class")
def average_precision(spark, d):
    rows = evaluate.class_metrics(truths_of(spark, d), matches_of(spark, d))
    return rows.withColumn("ap", F.round("ap", 9))


METRICS = """round(avg(ap), 9) as map_50, round(sum(tp)/cast(sum(tp+fp) as double), 9) as precision,
  round(sum(tp)/cast(sum(n_gt) as double), 9) as recall from per_class"""


@query("detection_metrics", MATCHED + "select " + METRICS)
def detection_metrics(spark, d):
    row = evaluate.detection_metrics(boxes(spark, d), predictions(spark, d))
    return row.withColumns({m: F.round(m, 9) for m in ("map_50", "precision", "recall")})


def metrics_pair(spark, d):
    """Baseline: predictions that drift twice as far. Fine-tuned: the usual ones."""
    truth = boxes(spark, d)
    rows = {
        name: evaluate.detection_metrics(truth, predictions(spark, d, drift)).select(
            F.struct("map_50", "precision", "recall").alias(name)
        )
        for name, drift in (("baseline", 2), ("finetuned", 1))
    }
    model = F.lit("Rider").alias("model")
    both = rows["baseline"].withColumn("model", model).join(
        rows["finetuned"].withColumn("model", model), "model"
    )
    return both


# The same steps for predictions that drift twice as far, in a subquery of their own.
DRIFTED = """(with far as (select * replace (
    x1 + ((frame_key % 31) - 15) as x1, x2 + ((frame_key % 31) - 15) as x2,
    y1 + ((pred_id % 25) - 12) as y1, y2 + ((pred_id % 25) - 12) as y2) from predictions)""" + STEPS.replace(
    "from predictions join", "from far join") + """select avg(ap) as map_50, sum(tp)/cast(sum(tp+fp) as double) as precision,
  sum(tp)/cast(sum(n_gt) as double) as recall from per_class)"""


@query(
    "metrics_compare",
    MATCHED
    + """, f as (select avg(ap) as map_50, sum(tp)/cast(sum(tp+fp) as double) as precision,
        sum(tp)/cast(sum(n_gt) as double) as recall from per_class), b as """
    + DRIFTED
    + """select 'Rider' as model, round(f.map_50 - b.map_50, 9) as map_50_delta, round(f.precision - b.precision, 9) as precision_delta,
      round(f.recall - b.recall, 9) as recall_delta, case when f.map_50 > b.map_50 then 'PASS' else 'FAIL' end as status from f, b""",
)
def metrics_compare(spark, d):
    told = evaluate.compare_metrics(metrics_pair(spark, d))
    return told.withColumns({f"{m}_delta": F.round(f"{m}_delta", 9) for m in ("map_50", "precision", "recall")})
