"""Exact histogram of encoded lengths, and what follows from it for every context limit.

Documents are encoded once and reduced to (length, documents). Suffix sums over the distinct
lengths then answer, for any limit, how many documents are longer, how many tokens they hold, how
many tokens remain if each document is cut at the limit, and which share of documents fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import running_total, stored
from quern.llm.encoding import encoder
from quern.llm.words import pieces

#: Lengths that share a bucket of the two-level sums.
BUCKET = 4096


def histogram(docs: DataFrame, tokenizer: str, added: int = 0) -> DataFrame:
    """(n_tokens, n_docs) over all documents; ``added`` ids are counted to each, as for an end mark.

    Null and empty texts have ``added`` tokens. Ids and other columns do not matter, repeated rows
    count each. An empty table gives an empty histogram.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for piece in pieces(batch):
                lengths, docs = np.unique(encode.ids(piece["text"])[1] + added, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array(docs)], names=["n_tokens", "n_docs"])

    return docs.select("text").mapInArrow(count, "n_tokens long, n_docs long").groupBy("n_tokens").agg(
        F.sum("n_docs").alias("n_docs"))


def curve(counts: DataFrame) -> DataFrame:
    """Per distinct length, taken as the context limit:

    n_tokens, n_docs (of this length), docs_longer, tokens_longer (all tokens of those),
    total_docs, total_tokens, truncated_tokens (each document cut at the limit), fitting_share.
    """
    counts = stored(
        counts.withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
        .withColumn("down", -F.floor(F.col("n_tokens") / BUCKET)).withColumn("all", F.lit(0)), "histogram")
    longest_first = [F.col("n_tokens").desc()]
    sums = running_total(counts, ["all"], "down", longest_first, "n_docs", "docs_from")
    sums = running_total(sums, ["all"], "down", longest_first, "tokens", "tokens_from")
    totals = counts.groupBy("all").agg(F.sum("n_docs").alias("total_docs"), F.sum("tokens").alias("total_tokens"))
    longer = F.col("docs_from") - F.col("n_docs")
    tokens_longer = F.col("tokens_from") - F.col("tokens")
    return sums.join(totals, "all").select(
        "n_tokens", "n_docs", longer.alias("docs_longer"), tokens_longer.alias("tokens_longer"),
        "total_docs", "total_tokens",
        (F.col("total_tokens") - tokens_longer + F.col("n_tokens") * longer).alias("truncated_tokens"),
        ((F.col("total_docs") - longer) / F.col("total_docs")).alias("fitting_share"))


def at_limits(curve_rows: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_longer, tokens_longer, truncated_tokens) for any limits, also between lengths."""
    answers = None
    for limit in limits:
        over = F.col("n_tokens") > limit
        docs = F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0))
        tokens = F.coalesce(F.sum(F.when(over, F.col("n_tokens") * F.col("n_docs"))), F.lit(0))
        row = curve_rows.agg(
            F.lit(limit).cast("long").alias("limit"), docs.alias("docs_longer"), tokens.alias("tokens_longer"),
            (F.coalesce(F.max("total_tokens"), F.lit(0)) - tokens + limit * docs).alias("truncated_tokens"))
        answers = row if answers is None else answers.union(row)
    return answers


def quantile(curve_rows: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed."""
    return curve_rows.filter(F.col("fitting_share") >= share).agg(F.min("n_tokens").alias("n_tokens"))
