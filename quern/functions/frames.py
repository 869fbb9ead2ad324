"""Frame features and the registry that names them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import boxes, images
from quern.schema import require_columns


def has_category(categories: Column, name: str) -> Column:
    """True when any annotation has the category; false without annotations."""
    return F.coalesce(F.array_contains(categories, name), F.lit(False))


def scene_mentions(scene: Column, *words: str) -> Column:
    lowered = F.lower(scene)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return F.when(scene.isNotNull(), hit)


def scene_description(weather: Column, scene: Column, timeofday: Column) -> Column:
    return F.concat(timeofday, F.lit(" "), weather, F.lit(" scene on a "), scene)


@dataclass(frozen=True)
class Feature:
    """A derived column: its inputs, its type and the expression over the inputs."""

    inputs: tuple[str, ...]
    dtype: T.DataType
    build: Callable[..., Column]

    def column(self) -> Column:
        return self.build(*[F.col(c) for c in self.inputs]).cast(self.dtype)


ANNOTATION_FEATURES: dict[str, Feature] = {
    "has_person": Feature(
        ("ann_categories",), T.BooleanType(), lambda c: has_category(c, "person")
    ),
    "has_rider": Feature(("ann_categories",), T.BooleanType(), lambda c: has_category(c, "rider")),
    "scene_has_crossroad": Feature(
        ("scene",), T.BooleanType(), lambda s: scene_mentions(s, "street", "intersection")
    ),
    "scene_has_mountain": Feature(
        ("scene",), T.BooleanType(), lambda s: scene_mentions(s, "mountain", "rural")
    ),
    "scene_description": Feature(
        ("weather", "scene", "timeofday"), T.StringType(), scene_description
    ),
    "person_bbox_area_pct": Feature(
        ("ann_categories", "ann_bboxes", "width", "height"),
        T.FloatType(),
        boxes.person_area_percent,
    ),
}

PIXEL_FEATURES: dict[str, Feature] = {
    "white_balance": Feature(("image_bytes",), T.FloatType(), images.white_balance),
    "dhash": Feature(("image_bytes",), T.ArrayType(T.FloatType()), images.dhash),
}


def feature_registry(pixel_features: bool = False, **overrides: Feature) -> dict[str, Feature]:
    """Column name to feature; ``overrides`` swap in another variant of a column."""
    registry = dict(ANNOTATION_FEATURES)
    if pixel_features:
        registry.update(PIXEL_FEATURES)
    registry.update(overrides)
    return registry


def add_features(df: DataFrame, names=None, registry: dict[str, Feature] | None = None) -> DataFrame:
    """Add the named features in one projection; unregistered names are skipped."""
    registry = ANNOTATION_FEATURES if registry is None else registry
    chosen = [n for n in (names or registry) if n in registry]
    for name in chosen:
        require_columns(df, registry[name].inputs)
    return df.withColumns({n: registry[n].column() for n in chosen})
