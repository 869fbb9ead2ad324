"""How the sources of a language differ in their words: count-level bitmaps.

A group is a language and a source. Its terms are runs of letters; a language keeps the terms that
at least ``LEAST_DOCS`` of its documents hold, numbered 0 to V - 1. As a term's smoothed frequency
in a group depends only on its count there, a group is stored as one bitset of term numbers per
(group, count), cut into words of 64 numbers. For two groups the AND of two words and its popcount
give how many terms have this pair of counts, a joint cell, and that times the cell's difference
is added up; terms that one or both groups lack are what the bitsets leave over (complement).

Counts come from one scan: a task adds up its own texts before anything is shuffled. Numbers go by
falling frequency, so a word holds terms of like counts and few levels. Words meet in tasks of
``BLOCK_WORDS`` words of the numbering and two tiles of ``TILE`` sources, so neither a language of
very many terms nor one of very many sources meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import arrow_rows, running_total, stored
from quern.llm.words import pieces, split_words

LEAST_DOCS = 30
#: Added to every count, and the unit in which frequencies are whole numbers.
SMOOTHING = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
#: Words of 64 term numbers in one block of a task, and sources in one tile.
BLOCK_WORDS = 64
TILE = 64
#: Counts of one task that are held before they are sent on.
HELD_ROWS = 1_000_000
#: Documents that are sent to Python at once.
DOCUMENTS_AT_ONCE = 1000

#: Capitals become small, letters and bytes of other characters stay, the rest becomes a space.
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased and every ASCII character but letters turned into a space."""
    texts = pc.fill_null(texts, "").cast(pa.string())
    if not len(texts):
        return texts
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    text = memoryview(data)[ends[0] : ends[-1]] if data else b""
    return pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((ends - ends[0]).astype(np.int32).tobytes()), pa.py_buffer(bytes(text).translate(FOLDED)))


def piece_counts(piece: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of some documents: occurrences, and documents that have it."""
    distinct, codes, words = split_words(folded(piece["text"]))
    document = np.repeat(np.arange(piece.num_rows), words)
    width = max(1, len(distinct))
    in_document, n = np.unique(document * width + codes, return_counts=True)
    sides = [piece[c].dictionary_encode() for c in ("lang", "source")]
    lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in sides)
    group = lang * len(sides[1].dictionary) + source
    first = {g: i for i, g in reversed(list(enumerate(group.tolist())))}
    keys, at = np.unique(group[in_document // width] * width + in_document % width, return_inverse=True)
    rows = np.array([first[g] for g in (keys // width).tolist()], np.int64)
    return pa.table({
        "lang": piece["lang"].take(pa.array(rows)), "source": piece["source"].take(pa.array(rows)),
        "term": pa.array(distinct, pa.string()).take(pa.array(keys % width)),
        "n": pa.array(np.bincount(at, n, len(keys)).astype(np.int64)),
        "docs": pa.array(np.bincount(at, minlength=len(keys)).astype(np.int64))})


def counted(docs: DataFrame) -> DataFrame:
    """Counts per language, source and term, added up inside each task; (.., n, docs) may repeat."""
    most = HELD_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for piece in pieces(batch):
                held.append(piece_counts(piece))
                rows += held[-1].num_rows
                if rows > most:
                    one = added(held)
                    rows = one.num_rows
                    held = [one]
                    if rows > most // 2:
                        yield from one.to_batches(max_chunksize=1 << 16)
                        held, rows = [], 0
        if held:
            yield from added(held).to_batches(max_chunksize=1 << 16)

    names = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*names).mapInArrow(count, "lang string, source string, term string, n long, docs long")


def added(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    sums = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.select([*keys, "n_sum", "docs_sum"]).rename_columns([*keys, "n", "docs"])


def frequency(n: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (n + SMOOTHING) / (total + SMOOTHING * terms)), exact; null without terms."""
    above = f"cast({UNIT} as decimal(20,0)) * cast({n} + {SMOOTHING} as decimal(20,0))"
    below = f"nullif(cast({total} + {SMOOTHING} * {terms} as decimal(20,0)), 0)"
    return F.expr(f"1 + ({above}) div {below}")


def numbered(kept: DataFrame) -> DataFrame:
    """(lang, term, id, lang_n): kept terms numbered from 0 in each language, frequent ones first."""
    totals = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    octave = 64 - F.floor(F.log2("lang_n")).cast("int")
    bucket = octave * 256 + F.shiftright(F.crc32(F.col("term").cast("binary")), 24).cast("int")
    rows = totals.withColumn("bucket", bucket).withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(rows, ["lang"], "bucket", ["term"], "one", "id")
    return ranked.select("lang", "term", (F.col("id") - 1).alias("id"), "lang_n")


def levels(rows: DataFrame) -> DataFrame:
    """(lang, source, n, p, chunk, bits): per group and count the set of term numbers, 64 a word."""
    bit = F.expr("shiftleft(1L, cast(id % 64 as int))")
    return rows.groupBy("lang", "source", "n", "p", F.expr("id div 64").alias("chunk")).agg(F.bit_or(bit).alias("bits"))


def joint_sums(words: pa.Table, block_words: int) -> pa.Table:
    """Sum of differences over one block of term numbers for all pairs of sources of two tiles.

    ``words`` has the bitset words of the block and, for every source, a row without a chunk that
    holds the frequency of a term it lacks. Both directions of a pair are given.
    """
    source = words["source"].combine_chunks().dictionary_encode()
    names, owner = source.dictionary, source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    get = {c: words[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("tile", "p", "bits")}
    chunk = pc.fill_null(words["chunk"].combine_chunks(), -1).to_numpy(zero_copy_only=False)
    lang, block, left, right, terms = (words[c][0].as_py() for c in ("lang", "block", "left", "right", "terms"))
    count = len(names)
    lacking, tile = np.zeros(count, np.int64), np.zeros(count, np.int64)
    lacking[owner[chunk < 0]] = get["p"][chunk < 0]
    tile[owner] = get["tile"]
    both, missing, zero = (np.zeros((count, count), np.int64) for _ in range(3))
    apart = np.abs(lacking[:, None] - lacking[None, :])
    for c in range(block * block_words, min((block + 1) * block_words, -(-terms // 64))):
        at = np.flatnonzero(chunk == c)
        at = at[np.argsort(owner[at], kind="stable")]
        p, bits, own = get["p"][at], get["bits"][at].view(np.uint64), owner[at]
        sizes = np.bitwise_count(bits).astype(np.int64)
        there, starts = np.unique(own, return_index=True)
        shared = np.zeros((count, count), np.int64)
        for a, begin, end in zip(there, starts, [*starts[1:], len(own)]):
            cells = np.bitwise_count(bits[begin:end, None] & bits[None, :]).astype(np.int64)
            gaps = (cells * np.abs(p[begin:end, None] - p[None, :])).sum(axis=0)
            both[a, there] += np.add.reduceat(gaps, starts)
            found = np.zeros((end - begin, count), np.int64)
            found[:, there] = np.add.reduceat(cells, starts, axis=1)
            shared[a] = found.sum(axis=0)
            rest = sizes[begin:end, None] - found
            missing[a] += (rest * np.abs(p[begin:end, None] - lacking[None, :])).sum(axis=0)
        held = np.diag(shared)
        zero += (min(64, terms - 64 * c) - held[:, None] - held[None, :] + shared) * apart
    total = both + missing + missing.T + zero
    a, b = np.nonzero(~np.eye(count, dtype=bool))
    # Within one tile all pairs; between two tiles those that have a source in each.
    take = (tile[a] == left) & (tile[b] == right) | (tile[a] == right) & (tile[b] == left)
    a, b = a[take], b[take]
    return pa.table({
        "lang": pa.array([lang] * len(a), pa.string()), "source": names.take(pa.array(a)),
        "item": names.take(pa.array(b)), "value": pa.array(total[a, b])})


def pair_values(groups: DataFrame, bitsets: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language, in both directions."""
    words = bitsets.join(groups.select("lang", "source", "tile", "tiles", "terms"), ["lang", "source"]).select(
        "lang", "source", "tile", "tiles", "terms", "p", "chunk", "bits", F.expr(f"chunk div {BLOCK_WORDS}").alias("block"))
    last = F.greatest(F.lit(0), F.expr(f"(terms - 1) div {64 * BLOCK_WORDS}"))
    lacking = groups.select(
        "lang", "source", "tile", "tiles", "terms", F.coalesce("lacking", F.lit(0)).alias("p"),
        F.lit(None).cast("long").alias("chunk"), F.lit(0).cast("long").alias("bits"),
        F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    # A row meets the rows of every tile, its own included, in the order of the tiles' numbers.
    dealt = words.unionByName(lacking).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)"))).select(
        "lang", "block", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"),
        "source", "tile", "terms", "p", "chunk", "bits")
    block_words = BLOCK_WORDS
    sums = dealt.groupBy("lang", "block", "left", "right").applyInArrow(
        lambda words: joint_sums(words, block_words), "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of the audit.

    Part ``pair``: the other sources of the language by falling sum of differences over all kept
    terms (0 if none is kept). Part ``term``: the ``top`` terms that stand out in the group above
    the language. Equal values rank by item. Null text, lang and source are empty texts. A group
    without kept terms takes part with counts of 0. Repeated rows count as documents each; doc_id
    and other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    every = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    with arrow_rows(spark, DOCUMENTS_AT_ONCE):
        sums = counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        # A term has a row for each source here, so no window holds more than the sources.
        held_by = F.sum("docs").over(Window.partitionBy("lang", "term"))
        kept = stored(sums.withColumn("held_by", held_by).where(F.col("held_by") >= least_docs).select(
            "lang", "source", "term", "n"), "kept-terms")
    numbers = stored(numbered(kept), "term-numbers")
    languages = numbers.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = every.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = every.join(totals, ["lang", "source"], "left").join(languages, "lang", "left").join(sources, "lang").select(
        "lang", "source", "lang_total", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms")],
        F.expr(f"cast((sources - 1) div {TILE} + 1 as int)").alias("tiles"))
    groups = stored(groups.select(
        "*", F.expr("cast(pmod(xxhash64(source), tiles) as int)").alias("tile"),
        frequency("0", "total", "terms").alias("lacking")), "groups")
    of_group = groups.select("lang", "source", "total", "terms", "lang_total")
    rows = stored(kept.join(numbers, ["lang", "term"]).join(of_group, ["lang", "source"]).select(
        "lang", "source", "term", "id", "n", frequency("n", "total", "terms").alias("p"),
        frequency("lang_n", "lang_total", "terms").alias("q")), "frequencies")
    pairs = pair_values(groups, levels(rows)).withColumn("part", F.lit("pair"))
    terms = rows.where("n > 0 AND p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = terms.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("rank", F.row_number().over(by_value)).select(*columns).unionAll(ranked.select(*columns))
