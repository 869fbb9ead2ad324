"""Named filters, holdout split, previews and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.schema import HEAVY_COLUMNS

# The named filters. ``bbox_pct`` is the only parameter.
SPEC_FILTERS = {
    "nighttime_person": "timeofday = 'night' AND has_person = true",
    "rider": "has_rider = true",
    "nighttime_rider": "timeofday = 'night' AND has_rider = true",
    "daytime_clear": "timeofday = 'daytime' AND weather = 'clear'",
    "distant_person": "has_person = true AND person_bbox_area_pct < {bbox_pct}",
    "nighttime_distant_person": (
        "timeofday = 'night' AND has_person = true AND person_bbox_area_pct < {bbox_pct}"
    ),
}
DEFAULT_BBOX_PCT = 5.0
SUMMARY_BBOX_PCT = 30.0

HOLDOUT_MODULUS = 100


def spec_filter(name: str, bbox_pct: float = DEFAULT_BBOX_PCT) -> str:
    """SQL text of a named filter."""
    if name not in SPEC_FILTERS:
        raise ValueError(f"unknown filter {name!r}; choose from {sorted(SPEC_FILTERS)}")
    return SPEC_FILTERS[name].format(bbox_pct=bbox_pct)


def spec_columns(name: str) -> set[str]:
    """Derived columns a named filter reads."""
    derived = ("has_person", "has_rider", "person_bbox_area_pct", "timeofday", "weather")
    return {c for c in derived if c in SPEC_FILTERS[name]}


def is_holdout(id_col: str = "id") -> Column:
    """Validation rows: a function of the id alone, so inserts never move a row."""
    return F.pmod(F.col(id_col), F.lit(HOLDOUT_MODULUS)) == 0


def train_filter(min_score: float, holdout: bool = False) -> Column:
    """Clean rows above a quality score, on one side of the holdout."""
    side = is_holdout() if holdout else ~is_holdout()
    return ~F.col("is_dup") & (F.col("score") >= min_score) & side


def dedup_clause(df: DataFrame, view_name: str) -> str:
    """SQL that drops flagged copies: only for train views, only if the flag exists."""
    if view_name.endswith("_train") and "is_duplicate" in df.columns:
        return " AND (is_duplicate IS NULL OR is_duplicate = false)"
    return ""


def count_where(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """One row ``n``: rows that satisfy a condition, or all."""
    kept = df if condition is None else df.where(condition)
    return kept.agg(F.count("*").alias("n"))


def preview(df: DataFrame, condition: str | Column, key: str, limit: int = 20) -> DataFrame:
    """First rows by key under a filter, without the heavy columns."""
    shown = [c for c in df.columns if c not in HEAVY_COLUMNS]
    return df.where(condition).select(*shown).orderBy(key).limit(limit)
