"""Document fingerprints from closed syncmers, with built-in functions only.

A k-mer (``K`` characters) is a closed syncmer if the smallest hash among its inner substrings of
``S`` characters lies at its first or last place. The choice depends on the k-mer alone, so equal
passages give equal anchors wherever they stand, and any ``2K - S - 1`` characters hold one. A
fingerprint is the ``KEPT`` smallest distinct hashes of all anchors of the whole text. Likeness is
the Jaccard similarity of all anchors, or else that read from a number of smallest hashes.

Texts are cut to segments and these to blocks before positions are looked at, because a
character's place in UTF-8 is found by counting from the start.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import stored

K = 16
S = 6
#: Inner substrings of a k-mer.
INNER = K - S + 1
KEPT = 96
BLOCK = 64
SEGMENT = 1 << 12
#: Text of neighbouring documents that one task puts in order together, and parts it is measured in.
RANGE_BYTES = 16 << 20
RANGE_PARTS = 4


def segments(text: Column) -> Column:
    """Pieces of at most ``SEGMENT`` start places; neighbours share K - 1 characters."""
    last = F.floor((F.greatest(F.char_length(text) - K + 1, F.lit(1)) - 1) / SEGMENT).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(text, i * SEGMENT + 1, F.lit(SEGMENT + K - 1)))


def closed_syncmers(segment: Column, keep) -> Column:
    """Array of ``keep(kmer, place)`` over the closed syncmers of a segment; places count from 0."""
    last = F.floor((F.char_length(segment) - K) / BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last),
        lambda b: F.struct(
            (b * BLOCK).alias("at"),
            F.substring(segment, b * BLOCK + 1, F.lit(BLOCK + K - 1)).alias("chars")))
    hashed = F.transform(
        blocks,
        lambda b: F.struct(
            b["at"].alias("at"), b["chars"].alias("chars"),
            F.transform(
                F.sequence(F.lit(1), F.char_length(b["chars"]) - S + 1),
                lambda i: F.hash(F.substring(b["chars"], i, F.lit(S)))).alias("inner")))

    def with_low(b: Column, low: Column) -> Column:
        return F.struct(b["at"].alias("at"), b["chars"].alias("chars"), b["inner"].alias("inner"), low.alias("low"))

    def doubled(run: int):
        return lambda b: with_low(b, F.zip_with(b["low"], F.slice(b["low"], run + 1, BLOCK + K), lambda x, y: F.least(x, y)))

    # ``low``: the least of ``run`` neighbours, from two runs of half as many; two runs that overlap make INNER - 2.
    lows, run = F.transform(hashed, lambda b: with_low(b, b["inner"])), 1
    while 2 * run <= INNER - 2:
        lows, run = F.transform(lows, doubled(run)), 2 * run

    def chosen(b: Column) -> Column:
        def is_closed(i: Column) -> Column:
            end = F.least(b["inner"][i - 1], b["inner"][i + (INNER - 2)])
            return (end <= b["low"][i]) & (end <= b["low"][i + (INNER - 2 - run)])

        closed = F.filter(F.sequence(F.lit(1), F.size(b["inner"]) - INNER + 1), is_closed)
        return F.transform(closed, lambda i: keep(F.substring(b["chars"], i, F.lit(K)), b["at"] + i - 1))

    found = F.flatten(F.transform(lows, chosen))
    return F.when(F.char_length(segment) >= K, found)


def smallest(hashes: Column, kept: int = KEPT) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, kept)


def likeness(a: Column, b: Column, kept: int | None = None) -> Column:
    """0 to 1 from all hashes, or from the ``kept`` smallest of the union of as many each.

    Two empty sets are alike, an empty one is unlike any other. The hashes of a set are distinct.
    """
    if kept is None:
        both = F.size(F.array_intersect(a, b))
        union = F.size(a) + F.size(b) - both
    else:
        all_kept = smallest(F.concat(a, b), kept)
        both, union = F.size(F.array_intersect(F.array_intersect(a, b), all_kept)), F.size(all_kept)
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def anchor_hashes(text: Column) -> Column:
    """Hashes of all anchors of a text, with repeats."""
    nothing = F.array().cast("array<int>")
    return F.flatten(F.transform(
        segments(text), lambda c: F.coalesce(closed_syncmers(c, lambda kmer, at: F.hash(kmer)), nothing)))


def shown(hashes: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits per anchor."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, place, anchor) of every closed syncmer, for positional matching.

    Null, empty and shorter texts have none.
    """
    cut = docs.select("doc_id", F.posexplode(segments(F.col("text"))).alias("segment", "chars"))
    found = closed_syncmers(
        F.col("chars"), lambda kmer, at: F.struct(at.alias("at"), F.xxhash64(kmer).alias("anchor")))
    return cut.select("doc_id", "segment", F.explode(found).alias("found")).select(
        "doc_id", (F.col("segment").cast("long") * SEGMENT + F.col("found.at")).alias("place"), "found.anchor")


def range_starts(rows: DataFrame) -> list[int]:
    """First ids of ranges that hold about ``RANGE_BYTES`` of text each, or one id with more.

    The number of narrow ranges follows from the measured bytes; a given number is not merged by
    adaptive execution. An id counts once and once more for each mean length in its text, so a range
    of long texts holds at most twice the mean bytes. Neighbouring ranges are joined up to the size.
    """
    sizes = stored(rows.select("doc_id", F.octet_length("text").cast("long").alias("bytes")), "text-sizes")
    count, total = sizes.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    parts = max(1, -(-total * RANGE_PARTS // RANGE_BYTES))
    times = F.floor(F.col("bytes") / (max(total, 1) / max(count, 1))).cast("int")
    weighed = sizes.select("doc_id", "bytes", F.explode(F.sequence(F.lit(0), times)).alias("time"))
    dealt = weighed.repartitionByRange(parts, "doc_id").withColumn("range", F.spark_partition_id())
    firsts = dealt.groupBy("range").agg(
        F.min("doc_id").alias("first"), F.sum(F.when(F.col("time") == 0, F.col("bytes")).otherwise(0)).alias("bytes")).collect()
    starts, held = [], 0
    for first, size in sorted((r["first"], r["bytes"]) for r in firsts):
        if not starts or held + size > RANGE_BYTES:
            starts.append(first)
            held = 0
        held += size
    return starts


def block_of(doc_id: Column, starts: list[int]) -> Column:
    """Number of the range an id lies in, found in two steps over the starts."""
    step = max(1, math.isqrt(len(starts)))
    coarse, fine = F.array(*map(F.lit, starts[::step])), F.array(*map(F.lit, starts))
    part = F.size(F.filter(coarse, lambda s: s <= doc_id)) - 1
    inside = F.filter(F.slice(fine, part * step + 1, step), lambda s: s <= doc_id)
    return part * step + F.size(inside) - 1


def fingerprints(docs: DataFrame, compared: int | None = KEPT) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and their likeness.

    The edited text has the last quarter (floor of n_chars / 4 code points) replaced by the first
    as many, or all, of the next document in ascending doc_id order. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The likeness is that of the
    ``compared`` smallest anchors, or exactly that of all anchors if this is None. Texts without an
    anchor have the hash of the whole text as their only one; null and empty texts have an empty
    fingerprint. Rows that repeat a doc_id follow one another by their text's hash; a row without
    doc_id has no place in the order and an empty neighbour. Other columns are ignored. An empty
    table gives an empty result.
    """
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    rows = every.filter("doc_id IS NOT NULL")
    nothing = F.array().cast("array<int>")
    alone = _both_fingerprints(every.filter("doc_id IS NULL").select(
        F.lit(0).alias("block"), F.lit(False).alias("copy"), "doc_id", "tie", "text", F.lit("").alias("following")),
        compared).withColumn("next_own", nothing)
    starts = range_starts(rows)
    paired = alone
    if starts:
        # A block ends in a copy of the next one's first row, so a window over a block sees
        # all neighbours and texts are shuffled once. Anchors of the next row come from a second
        # window in the same order, which needs no shuffle.
        block = block_of(F.col("doc_id"), starts)
        least = F.row_number().over(Window.partitionBy("doc_id").orderBy("tie"))
        ends = rows.filter(F.col("doc_id").isin(starts)).withColumn("least", least).filter("least = 1").select(
            F.pmod(block - 1, F.lit(len(starts))).alias("block"), F.lit(True).alias("copy"), "doc_id", "tie", "text")
        blocked = rows.select(block.alias("block"), F.lit(False).alias("copy"), "doc_id", "tie", "text").union(ends)
        by_block = Window.partitionBy("block").orderBy("copy", "doc_id", "tie")
        in_order = blocked.withColumn("following", F.coalesce(F.lead("text").over(by_block), F.lit("")))
        per_row = _both_fingerprints(in_order, compared).withColumn("next_own", F.lead("own").over(by_block))
        paired = per_row.filter("NOT copy").union(alone)
    return paired.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        likeness(F.col("own"), F.coalesce("next_own", nothing), compared).alias("near_next"))


def _both_fingerprints(rows: DataFrame, compared: int | None) -> DataFrame:
    """For rows (block, copy, doc_id, tie, text, following): what is told of a row, and its ``own`` anchors."""
    joined = (
        rows.withColumn("n_chars", F.char_length("text"))
        .withColumn("cut", (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
        .withColumn("new", F.coalesce(F.expr("substring(following, 1, n_chars - cut)"), F.lit("")))
        .withColumn("edited", F.concat(F.expr("substring(text, 1, cut)"), "new")))
    # Anchors are free of context, so both texts share those that lie in what they share.
    seam = F.expr(f"greatest(cut - {K - 1}, 0)").cast("int")
    found = joined.select(
        "block", "copy", "doc_id", "tie", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.hash("text").alias("whole"), F.hash("edited").alias("edited_whole"),
        (F.char_length("edited") > 0).alias("some"),
        anchor_hashes(F.expr("substring(text, 1, cut)")).alias("both"),
        anchor_hashes(F.substring(F.col("text"), seam + 1, F.col("n_chars"))).alias("tail"),
        anchor_hashes(F.substring(F.col("edited"), seam + 1, F.char_length("edited"))).alias("new_tail"))

    def of(tail: str, alone: str, there: Column) -> Column:
        hashes = F.array_distinct(F.concat("both", tail))
        return F.when((F.size("both") == 0) & (F.size(tail) == 0) & there, F.array(alone)).otherwise(hashes)

    told = found.select(
        "block", "copy", "doc_id", "tie", "n_chars", "edited_sha256",
        of("tail", "whole", F.col("n_chars") > 0).alias("own"),
        of("new_tail", "edited_whole", F.col("some")).alias("changed"))
    if compared is not None:
        told = told.withColumns({c: smallest(F.col(c), compared) for c in ("own", "changed")})
    return told.select(
        "block", "copy", "doc_id", "tie", "n_chars", "edited_sha256", shown(smallest(F.col("own"))).alias("fingerprint"),
        shown(smallest(F.col("changed"))).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), compared).alias("near_edited"), "own")
