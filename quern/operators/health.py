"""Health reports: rows (status, check, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.counts import count_as_rows
from quern.operators.views import EXPECTED_VIEWS

PASS, WARN, FAIL, SKIP = "PASS", "WARN", "FAIL", "SKIP"

# Derived columns a finished table has, in display order.
EXPECTED_COLUMNS = [
    "has_person", "has_rider", "white_balance", "scene_description", "scene_has_crossroad",
    "scene_has_mountain", "person_bbox_area_pct", "dhash", "is_duplicate",
]


def percent_text(part: Column, whole: Column) -> Column:
    """Share as text with one decimal, a dash for an empty whole."""
    share = F.format_string("%.1f%%", part * 100.0 / F.nullif(whole, F.lit(0)))
    return F.when(whole == 0, "—").otherwise(share)


def column_coverage(df: DataFrame, columns: list[str] = EXPECTED_COLUMNS) -> DataFrame:
    """(column_name, filled, nulls, total, status) in one pass over the columns.

    PASS without NULLs, WARN with some, FAIL when all are NULL or it is missing.
    """
    present = [c for c in columns if c in df.columns]
    counters = {c: F.count(c) if c in present else F.lit(-1) for c in columns}
    counters[""] = F.count("*")
    counted = count_as_rows(df.select(*present) if present else df, counters, "column_name", "filled")
    total = counted.where("column_name = ''").select(F.col("filled").alias("total"))
    rows = counted.where("column_name <> ''").join(F.broadcast(total))
    missing = F.col("filled") < 0
    status = (
        F.when(missing, FAIL)
        .when(F.col("filled") == F.col("total"), PASS)
        .when(F.col("filled") == 0, FAIL)
        .otherwise(WARN)
    )
    return rows.select(
        "column_name",
        F.when(~missing, F.col("filled")).alias("filled"),
        F.when(~missing, F.col("total") - F.col("filled")).alias("nulls"),
        "total",
        status.alias("status"),
    )


def _checks(rows: DataFrame, check: Column, detail: Column) -> DataFrame:
    return rows.select("status", check.alias("check"), detail.alias("detail"))


def source_checks(df: DataFrame, columns: list[str] = EXPECTED_COLUMNS) -> DataFrame:
    """Row count of the source and the coverage of its derived columns."""
    coverage = column_coverage(df, columns)
    detail = F.when(F.col("filled").isNull(), "missing").otherwise(
        F.concat(
            F.col("filled").cast("string"),
            F.lit(" / "),
            F.col("total").cast("string"),
            F.lit(" filled ("),
            percent_text(F.col("filled"), F.col("total")),
            F.lit(")"),
        )
    )
    total = df.agg(F.count("*").alias("n")).select(
        F.lit(PASS).alias("status"),
        F.lit("rows").alias("check"),
        F.concat(F.col("n").cast("string"), F.lit(" rows")).alias("detail"),
    )
    named = F.concat(F.lit("values of "), F.col("column_name"))
    return total.unionByName(_checks(coverage, named, detail))


def dedup_check(df: DataFrame) -> DataFrame:
    """Share of flagged rows, or SKIP without the flag."""
    if "is_duplicate" not in df.columns:
        row = [(SKIP, "copies", "no such column")]
        return df.sparkSession.createDataFrame(row, "status string, check string, detail string")
    row = df.agg(F.count("*").alias("total"), F.count_if("is_duplicate").alias("dups"))
    detail = F.concat(
        F.col("dups").cast("string"),
        F.lit(" copies ("),
        percent_text(F.col("dups"), F.col("total")),
        F.lit(")"),
    )
    return _checks(row.withColumn("status", F.lit(PASS)), F.lit("copies"), detail)


def view_health(status: DataFrame, expected: list[str] = EXPECTED_VIEWS) -> DataFrame:
    """(name, rows, status): does each expected view exist, and how large is it."""
    wanted = status.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    found = wanted.join(status.select("name", "rows"), "name", "left")
    return found.withColumn("status", F.when(F.col("rows").isNull(), FAIL).otherwise(PASS))


def model_checks(compared: DataFrame) -> DataFrame:
    """Rows of ``compare_metrics`` as checks."""
    detail = F.coalesce(
        F.format_string("mAP %+.4f, recall %+.4f", F.col("map_50_delta"), F.col("recall_delta")),
        F.lit("no metrics"),
    )
    return _checks(compared, F.concat(F.lit("model "), F.col("model")), detail)


def read_model_metrics(spark: SparkSession, root: str) -> DataFrame:
    """(model, has_checkpoint, baseline, finetuned) from ``root/<model>/`` folders
    holding a checkpoint file and ``metrics.json``."""
    sums = "struct<map_50:double,precision:double,recall:double>"
    model = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    checkpoints = files.where(F.col("path").endswith(".pt")).select(model.alias("model")).distinct()
    metrics = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "metrics.json")
        .option("multiLine", "true")
        .schema(f"baseline {sums}, finetuned {sums}, epochs int, val_table string")
        .json(root)
        .withColumn("path", F.col("_metadata.file_path"))
        .select(model.alias("model"), "baseline", "finetuned")
    )
    marked = checkpoints.withColumn("has_checkpoint", F.lit(True))
    return (
        metrics.join(marked, "model", "full")
        .withColumn("has_checkpoint", F.coalesce("has_checkpoint", F.lit(False)))
        .select("model", "has_checkpoint", "baseline", "finetuned")
    )


def summarize(*checks: DataFrame) -> DataFrame:
    """Number of checks per status."""
    rows = reduce(DataFrame.unionByName, checks)
    return rows.groupBy("status").agg(F.count("*").alias("n"))
