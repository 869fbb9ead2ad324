"""Bounding boxes [x1, y1, x2, y2]."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.schema import CLASS_IDS, PERSON_CLASS, SCORE_THRESHOLD


def category_class(category: Column) -> Column:
    """Detector class id of a category, NULL when it has none."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in CLASS_IDS.items())
    return F.create_map(*pairs)[category]


def clipped_area(box: Column) -> Column:
    width = F.greatest(F.lit(0.0), F.get(box, 2).cast("double") - F.get(box, 0))
    height = F.greatest(F.lit(0.0), F.get(box, 3).cast("double") - F.get(box, 1))
    return width * height


def largest_person_area(categories: Column, boxes: Column) -> Column:
    """Area of the largest annotated person, 0 when there is none."""
    zipped = F.arrays_zip(categories.alias("c"), boxes.alias("b"))
    persons = F.filter(zipped, lambda z: z["c"] == "person")
    return F.coalesce(F.array_max(F.transform(persons, lambda z: clipped_area(z["b"]))), F.lit(0.0))


def person_area_percent(categories: Column, boxes: Column, width: Column, height: Column) -> Column:
    """Largest annotated person as a percentage of the frame."""
    frame = width.cast("double") * height
    area = largest_person_area(categories, boxes)
    return F.when(frame > 0, area / frame * 100).otherwise(0.0).cast("float")


def largest_detection(
    boxes: Column, labels: Column, scores: Column, threshold: float = SCORE_THRESHOLD
) -> Column:
    """Largest person box among confident detections (the first on a tie), else zeros."""
    zeros = F.array(*[F.lit(0.0).cast("float")] * 4)
    zipped = F.arrays_zip(boxes.alias("b"), labels.alias("l"), scores.alias("s"))
    ranked = F.transform(
        zipped,
        lambda z, i: F.struct(
            ((F.get(z["b"], 2) - F.get(z["b"], 0)) * (F.get(z["b"], 3) - F.get(z["b"], 1)))
            .cast("double")
            .alias("area"),
            (-i).alias("first"),
            z["b"].alias("box"),
            ((z["s"] >= threshold) & (z["l"] == PERSON_CLASS)).alias("keep"),
        ),
    )
    best = F.array_max(F.filter(ranked, lambda r: r["keep"]))
    return F.coalesce(best["box"], zeros)


def valid_targets(categories: Column, boxes: Column) -> Column:
    """Array of (label, box) for mapped categories with a positive extent."""
    categories = F.coalesce(categories, F.array().cast("array<string>"))
    boxes = F.coalesce(boxes, F.array().cast("array<array<float>>"))
    zipped = F.arrays_zip(categories.alias("c"), boxes.alias("b"))
    labelled = F.transform(
        zipped, lambda z: F.struct(category_class(z["c"]).alias("label"), z["b"].alias("box"))
    )
    return F.filter(
        labelled,
        lambda t: t["label"].isNotNull()
        & (F.get(t["box"], 2) > F.get(t["box"], 0))
        & (F.get(t["box"], 3) > F.get(t["box"], 1)),
    )


def iou(a: str | Column, b: str | Column) -> Column:
    """Intersection over union of two boxes: columns ``{a}x1..{a}y2``, or the fields of a struct."""

    def edge(box: str | Column, name: str) -> Column:
        return F.col(f"{box}{name}") if isinstance(box, str) else box[name]

    wide = F.least(edge(a, "x2"), edge(b, "x2")) - F.greatest(edge(a, "x1"), edge(b, "x1"))
    high = F.least(edge(a, "y2"), edge(b, "y2")) - F.greatest(edge(a, "y1"), edge(b, "y1"))
    inter = F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))
    areas = sum(
        (edge(p, "x2") - edge(p, "x1")) * (edge(p, "y2") - edge(p, "y1")) for p in (a, b)
    )
    return inter / F.greatest(areas - inter, F.lit(1e-6))
