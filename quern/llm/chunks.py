"""Repeated passages: content-defined chunks, deduplicated by digest.

A gear hash rolls over the bytes of a text: ``h = (h << 1) + GEAR[byte]`` in 16 bits, so a value
depends on the last 16 bytes only. A chunk ends where the top bits of the hash are zero and the
chunk has at least ``SHORTEST`` bytes, or at ``LONGEST`` bytes. Cuts follow the content, so after
an insertion they fall into step again within a chunk or two.

The first occurrence of a digest, by (doc_id, place), stays; every other is a repeat. Repeats that
touch make one passage, and passages of at least ``PASSAGE`` bytes are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import stored
from quern.llm.near_duplicates import mixed

#: Zero bits that end a chunk: one place in 16.
CUT_BITS = 4
SHORTEST = 24
LONGEST = 512
#: Bytes of touching repeats that make a passage.
PASSAGE = 96

GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The 16-bit rolling hash after each byte, built by doubling the window four times."""
    hashes = GEAR[data]
    for width in (1, 2, 4, 8):
        if len(hashes) > width:
            hashes[width:] = hashes[width:] + (hashes[:-width] << np.uint16(width))
    return hashes


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length."""
    size = len(data)
    ends, last = [], 0
    places = np.flatnonzero(gear_hashes(np.frombuffer(data, np.uint8)) >> np.uint16(16 - CUT_BITS) == 0) + 1
    for place in [*places.tolist(), size]:
        while place - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if place - last >= SHORTEST or place == size > last:
            ends.append(place)
            last = place
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, start, size) of every chunk of every text, in UTF-8 bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            digests, starts, sizes, counts = [], [], [], []
            for text in batch["text"]:
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                ends = cuts(data) if data else []
                begins = [0, *ends[:-1]] if ends else []
                digests += [digest(data[a:b]) for a, b in zip(begins, ends)]
                starts += begins
                sizes += [b - a for a, b in zip(begins, ends)]
                counts.append(len(ends))
            ids = np.repeat(np.arange(batch.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(digests, np.uint64).view(np.int64)), batch["doc_id"].take(pa.array(ids)),
                 pa.array(starts, pa.int64()), pa.array(sizes, pa.int32())],
                names=["digest", "doc_id", "start", "size"])

    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, "digest long, doc_id long, start long, size int")


def repeated_passages(docs: DataFrame, shortest: int = PASSAGE) -> DataFrame:
    """Passages that occur before: doc_id, start, size (UTF-8 bytes), first_doc_id, n_chunks.

    ``first_doc_id`` holds the first occurrence of the passage's first chunk; it may be the
    document itself. First occurrences are not reported, so documents without repeats do not
    appear. Null and empty texts have no chunks; rows without doc_id are left out. Rows that
    repeat a doc_id are read as one document, a row that is there twice counts once. Other columns
    are ignored. An empty table gives an empty result.
    """
    found = chunks(docs)
    # Counts combine before the shuffle, so a passage of a third of all documents is a few rows.
    seen = found.groupBy("digest").agg(
        F.min(F.struct("doc_id", "start")).alias("first"),
        F.max(F.struct("doc_id", "start")).alias("last"),
    ).filter("first < last").select("digest", F.col("first.doc_id").alias("first_doc_id"),
                                    F.col("first.start").alias("first_start"))
    repeats = found.join(seen, "digest").filter(
        "doc_id != first_doc_id OR start != first_start").select("doc_id", "start", "size", "first_doc_id")
    repeats = stored(repeats, "repeats").dropDuplicates(["doc_id", "start", "size"])
    in_document = Window.partitionBy("doc_id").orderBy("start", "size")
    begins = F.coalesce(F.col("start") > F.lag(F.col("start") + F.col("size")).over(in_document), F.lit(True))
    numbered = repeats.withColumn("begins", begins).withColumn(
        "passage", F.sum(F.col("begins").cast("int")).over(in_document))
    return numbered.groupBy("doc_id", "passage").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"),
        F.min_by("first_doc_id", "start").alias("first_doc_id"), F.count("*").alias("n_chunks"),
    ).filter(F.col("end") - F.col("start") >= shortest).select(
        "doc_id", "start", (F.col("end") - F.col("start")).alias("size"), "first_doc_id", "n_chunks")


def without_repeats(docs: DataFrame, shortest: int = PASSAGE) -> DataFrame:
    """``docs`` with every repeated passage cut out of its text; other columns stay.

    Cuts lie on whole characters: bytes of a character that a passage holds only in part stay.
    """
    spans = repeated_passages(docs, shortest).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("__spans")).withColumnRenamed("doc_id", "__of")

    @F.pandas_udf("string")
    def kept(texts, spans):
        import pandas as pd

        out = []
        for text, cut in zip(texts, spans):
            data, at, parts = (text or "").encode(), 0, []
            for span in cut if cut is not None else ():
                begin, end = span["start"], span["start"] + span["size"]
                while begin < len(data) and data[begin] & 0xC0 == 0x80:
                    begin += 1
                while end < len(data) and end > begin and data[end] & 0xC0 == 0x80:
                    end -= 1
                parts.append(data[at:begin])
                at = max(at, end)
            out.append(None if text is None else b"".join([*parts, data[at:]]).decode())
        return pd.Series(out, dtype=object)

    joined = docs.join(spans, docs["doc_id"] == spans["__of"], "left")
    return joined.select(*[
        kept(docs["text"], joined["__spans"]).alias("text") if c == "text" else docs[c] for c in docs.columns])
