"""Connected components of a list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of a link the smallest node it is connected with.

    In each round every node takes the smallest node next to it, and that one's smallest in turn;
    then links are redrawn between the nodes taken, and those within one node vanish. The
    links left shrink fast, so the rounds together cost little more than the first. Only tables
    of node pairs are shuffled.
    """
    edges = stored(
        links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).filter("u < v").distinct(), "links")
    labels = None
    while True:
        both = edges.union(edges.select("v", "u"))
        nearest = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("next"))
        after = nearest.select(F.col("node").alias("at"), F.col("next").alias("then"))
        hooks = stored(
            nearest.join(after, nearest.next == after["at"]).select("node", F.least("next", "then").alias("to")),
            "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("to").alias("component"))
        else:
            moved = hooks.select(F.col("node").alias("at"), "to")
            labels = stored(
                labels.join(moved, labels.component == moved["at"], "left").select(
                    "node", F.coalesce("to", "component").alias("component")), "labels")
        to_u = hooks.select(F.col("node").alias("u"), F.col("to").alias("cu"))
        to_v = hooks.select(F.col("node").alias("v"), F.col("to").alias("cv"))
        edges = stored(
            edges.join(to_u, "u").join(to_v, "v").filter("cu != cv").select(
                F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct(), "links")
        if edges.isEmpty():
            return labels
