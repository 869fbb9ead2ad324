"""Corpus and frame statistics, each in one pass over the columns it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.filters import SPEC_FILTERS, SUMMARY_BBOX_PCT, spec_columns, spec_filter
from quern.schema import BLOCK_LEN


def count_as_rows(df: DataFrame, counters: dict[str, Column], name: str, value: str) -> DataFrame:
    """Many counts in one scan, returned as (name, value) rows."""
    aliases = {f"_c{i}": (label, c) for i, (label, c) in enumerate(counters.items())}
    totals = df.agg(*[c.alias(a) for a, (_, c) in aliases.items()])
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias(name), F.col(a).cast("bigint").alias(value))
            for a, (label, _) in aliases.items()
        ]
    )
    return totals.select(F.inline(pairs))


def spec_counts(df: DataFrame, bbox_pct: float = SUMMARY_BBOX_PCT) -> DataFrame:
    """Rows per named filter; -1 where a column it needs does not exist yet."""
    counters = {}
    for spec in SPEC_FILTERS:
        ready = spec_columns(spec) <= set(df.columns)
        hits = F.count_if(F.expr(spec_filter(spec, bbox_pct))) if ready else F.lit(-1)
        counters[spec] = hits
    return count_as_rows(df, counters, "spec", "n")


def score_histogram(df: DataFrame, score: str = "score") -> DataFrame:
    """Rows and share per unit band [0,1) .. [4,5)."""
    total = F.count("*")
    bands = [
        F.struct(
            F.lit(low).alias("band"),
            F.count_if((F.col(score) >= low) & (F.col(score) < low + 1)).alias("n"),
        )
        for low in range(5)
    ]
    row = df.agg(total.alias("total"), F.array(*bands).alias("bands"))
    exploded = row.select("total", F.inline("bands"))
    share = F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0))
    return exploded.select("band", "n", share.alias("share"))


def token_budget(
    df: DataFrame, num_splits: int, block_len: int = BLOCK_LEN, tokens: str = "n_tokens"
) -> DataFrame:
    """Blocks an epoch can fill: tokens plus one end mark per document, cut to a
    multiple of the splits."""
    total = F.coalesce(F.sum(F.col(tokens).cast("bigint")), F.lit(0)) + F.count("*")
    row = df.agg(F.count("*").alias("docs"), total.alias("total_tokens"))
    blocks = F.expr(f"total_tokens div {block_len}")
    return row.withColumn("blocks", blocks - F.pmod(blocks, F.lit(num_splits)))


def step_budget(
    df: DataFrame,
    num_splits: int,
    global_batch: int,
    grad_accum: int = 1,
    block_len: int = BLOCK_LEN,
) -> DataFrame:
    """Optimizer steps per epoch, for packed blocks and for one row per document."""
    budget = token_budget(df, num_splits, block_len)
    packed = F.expr(f"total_tokens div {block_len} div {global_batch} div {grad_accum}")
    unpacked = F.expr(f"docs div {num_splits} div {grad_accum}")
    return budget.select(
        "docs",
        "total_tokens",
        F.greatest(packed, F.lit(1)).alias("packed_steps"),
        F.greatest(unpacked, F.lit(1)).alias("unpacked_steps"),
    )


def null_sample(df: DataFrame, columns: list[str], key: str, rows: int = 100) -> DataFrame:
    """NULLs per column in the first rows by key."""
    head = df.orderBy(key).select(*columns).limit(rows)
    counters = {c: F.count_if(F.col(c).isNull()) for c in columns}
    return count_as_rows(head, counters, "column_name", "nulls")


def split_counts(df: DataFrame, column: str = "split") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, NULL for an empty whole."""
    return F.try_divide(part * 100.0, whole)


def ingest_receipt(df: DataFrame) -> DataFrame:
    """Row count and the first 8 hex digits of its md5."""
    row = df.agg(F.count("*").alias("n"))
    return row.select("n", F.substring(F.md5(F.col("n").cast("string")), 1, 8).alias("checksum"))
