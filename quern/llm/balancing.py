"""Mixing sources to target weights by entropy balancing, with built-in functions only.

Each document starts at a prior rate (1 unless a column gives another). Wanted are the rates of
least relative entropy to these, weighted by words, that meet a word target per source and stay
within ``REPEATS``. Their form is ``min(REPEATS, prior * exp(multiplier of the source))``; the
multipliers solve the convex dual, by Newton steps kept inside a bracket. Every step is one
aggregation over cells (source, size, prior), so a hot source shrinks before it is shuffled.

Rates become whole copies per cell by carrying the rounding error along the sizes, largest
first; what is then left of a source's target is settled with cells of fitting size. Inside a
cell the documents with the smallest hashes get the extra copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import WORD, running_total, stored

REPEATS = 3
#: Relative error of a source's words at which the Newton steps end, and their number at most.
TOLERANCE = 1e-9
STEPS = 80
#: Settling passes at most; each leaves less than the size it settled with.
PASSES = 12


def sized(docs: DataFrame, prior: str | None = None) -> DataFrame:
    """Narrow rows: doc_id, source, key (source, null apart), size in words, prior, tie."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("key"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (F.coalesce(F.col(prior).cast("double"), F.lit(1.0)) if prior else F.lit(1.0)).alias("prior"),
        F.xxhash64("text").alias("tie"))


def source_targets(rows: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(key, source_size, target): sources by code point, null last, weigh 1, 2, 3 and so on.

    The targets share all words by weight; none exceeds ``repeats`` times its source, and what is
    over is shared among the others. With the sources in order of the level at which they are
    full, the common level follows from running sums. The table has one row per source.
    """
    totals = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    totals = totals.withColumn("weight", (F.row_number().over(ordered) - 1) % 3 + 1).withColumn(
        "most", repeats * F.col("source_size")).withColumn("full_at", F.col("most") / F.col("weight"))
    by_level = Window.orderBy("full_at", "key")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = totals.withColumn(
        "level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        / F.sum("weight").over(after))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "key", "level"))).over(whole)
    return levels.withColumn("common", level["level"]).select(
        "key", "source_size",
        F.least(F.col("most").cast("double"), F.col("weight") * F.col("common")).alias("target"))


def multipliers(cells: DataFrame, targets: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(key, source_size, target, multiplier) solving the dual; cells have key, size, prior, n."""
    state = stored(targets.select(
        "key", "source_size", "target", F.lit(0.0).alias("multiplier"), F.lit(-60.0).alias("low"),
        F.lit(60.0).alias("high"), F.lit(False).alias("met")), "dual")
    words = F.col("n") * F.col("size")
    for _ in range(STEPS):
        rate = F.least(F.lit(float(repeats)), F.col("prior") * F.exp("multiplier"))
        sums = cells.join(state.select("key", "multiplier"), "key").withColumn("rate", rate).groupBy("key").agg(
            F.sum(words * F.col("rate")).alias("taken"),
            F.sum(F.when(F.col("rate") < repeats, words * F.col("rate")).otherwise(0.0)).alias("slope"))
        moved = state.join(sums, "key").withColumn("over", F.col("taken") - F.col("target"))
        moved = moved.withColumn("met", F.abs("over") <= TOLERANCE * F.greatest("target", F.lit(1.0)))
        moved = moved.withColumn(
            "high", F.when(F.col("over") > 0, F.col("multiplier")).otherwise(F.col("high"))).withColumn(
            "low", F.when(F.col("over") < 0, F.col("multiplier")).otherwise(F.col("low")))
        step = F.col("multiplier") - F.col("over") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (step > F.col("low")) & (step < F.col("high"))
        state = stored(moved.select(
            "key", "source_size", "target",
            F.when(F.col("met"), F.col("multiplier")).when(inside, step)
            .otherwise((F.col("low") + F.col("high")) / 2).alias("multiplier"),
            "low", "high", "met"), "dual")
        if state.filter("NOT met AND high - low > 1e-12").isEmpty():
            break
    return state.select("key", "source_size", "target", "multiplier")


def cell_copies(cells: DataFrame, dual: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Cells with source_size, target and ``copies``, the whole number of copies of all their rows."""
    rate = F.least(F.lit(float(repeats)), F.col("prior") * F.exp("multiplier"))
    rated = cells.join(dual, "key").withColumn("rate", F.when(F.col("target") > 0, rate).otherwise(0.0))
    rated = rated.withColumn("wanted", F.col("n") * F.col("rate")).withColumn(
        "down", -F.floor(F.log2(F.col("size") + 1)).cast("int"))
    rated = running_total(rated, ["key"], "down", [F.col("size").desc(), F.col("prior")], "wanted", "carried")
    copies = F.floor(F.col("carried") + 0.5) - F.floor(F.col("carried") - F.col("wanted") + 0.5)
    most = (F.col("n") * repeats).cast("long")
    rated = stored(rated.select(
        "key", "size", "prior", "n", "source_size", "target",
        F.greatest(F.lit(0), F.least(most, copies.cast("long"))).alias("copies")), "cells")
    for _ in range(PASSES):
        left = rated.groupBy("key").agg(
            (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("left"))
        room = F.when(F.col("left") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        fitting = rated.join(left, "key").withColumn("room", room).filter(
            (F.col("room") > 0) & (F.col("size") > 0) & (F.col("size") <= F.abs("left") + 0.5))
        chosen = fitting.groupBy("key").agg(F.max(F.struct("size", "prior", "room", "left")).alias("at")).select(
            F.col("key").alias("in"), F.col("at.size").alias("at_size"), F.col("at.prior").alias("at_prior"),
            (F.signum("at.left") * F.least(
                F.col("at.room").cast("double"), F.floor((F.abs("at.left") + 0.5) / F.col("at.size")).cast("double"))
             ).cast("long").alias("more"))
        chosen = stored(chosen, "settled")
        if chosen.isEmpty():
            break
        same = (rated.key == chosen["in"]) & (rated["size"] == chosen.at_size) & (rated.prior == chosen.at_prior)
        rated = stored(rated.join(chosen, same, "left").withColumn(
            "copies", F.col("copies") + F.coalesce("more", F.lit(0))).select(*rated.columns), "cells")
    return rated


def mixed(docs: DataFrame, prior: str | None = None, repeats: int = REPEATS) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, copies (and source, tie).

    ``taken`` is ``copies * size`` with at most ``repeats`` copies. Null and empty texts have size
    0 and no copy. Rows that repeat an id are documents of their own; a null id is like any
    other value, a null prior counts as 1. Equal input gives equal results: hashes decide, not the order of rows. Other
    columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    rows = stored(sized(docs, prior), "sizes")
    cells = stored(rows.groupBy("key", "size", "prior").agg(F.count("*").alias("n")), "cells")
    dual = multipliers(cells, source_targets(rows, repeats), repeats)
    planned = cell_copies(cells, dual, repeats)
    order = rows.withColumn("order", F.xxhash64("doc_id", "tie")).withColumn(
        "bucket", F.shiftright("order", 56)).withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(
        order, ["key", "size", "prior"], "bucket", ["order", "doc_id", "tie"], "one", "rank")
    share = F.floor(F.col("copies") / F.col("n")).cast("long")
    extra = (F.col("rank") <= F.col("copies") % F.col("n")).cast("long")
    return ranked.join(planned, ["key", "size", "prior"]).withColumn(
        "each", F.when(F.col("size") > 0, share + extra).otherwise(F.lit(0)).cast("long")).select(
        "doc_id", "size", "source_size", "target", (F.col("each") * F.col("size")).alias("taken"),
        F.col("each").alias("copies"), "source", "tie")


def _named(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept.

    Rows with the same id and text count as one document with the copies of all of them.
    """
    plan = mixed(docs, **options).filter("copies > 0").groupBy(
        _named(F.col("doc_id")).alias("id"), "tie").agg(F.sum("copies").cast("int").alias("copies"))
    # The columns stay together in one, so none can clash with those of the plan.
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), _named(docs["doc_id"].cast("long")).alias("own_id"),
        F.xxhash64(docs["text"]).alias("own_tie"))
    rank = F.row_number().over(Window.partitionBy("own_id", "own_tie").orderBy("own_id"))
    one = rows.withColumn("rank", rank).filter("rank = 1")
    taken = one.join(plan, (one.own_id == plan["id"]) & (one.own_tie == plan["tie"]))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
