"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.session import fresh_path

#: A word, as all operators count it: a run of anything but space, tab and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text (0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str,
                  out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the group, this one included.

    Two levels, so that no task holds a whole group: totals per (group, ``bucket``) are summed
    over the few buckets, then rows are summed inside their bucket. ``bucket`` must be monotone
    in ``order``.
    """
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__total"))
    before = totals.withColumn(
        "__before",
        F.coalesce(F.sum("__total").over(
            Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)),
    ).drop("__total")
    names = [*group, bucket]
    before = before.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], "__before")
    same = [F.col(c).eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(names)]
    joined = df.join(before, reduce(and_, same), "left").select(*df.columns, "__before")
    inside = F.sum(value).over(
        Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return joined.withColumn(out, F.col("__before") + inside).drop("__before")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Jobs run inside send at most ``rows`` rows to Python at once; for rows of many kilobytes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, safe to lose tasks."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
