"""Benchmark passages inside documents, by the q-gram lemma and banded alignment.

Texts are compared as words without case (of all letters, after Unicode's canonical caseless matching)
with one space between. Every benchmark item is cut into overlapping windows. A window of n bytes that occurs with at most e edits shares at least
``n - Q + 1 - Q * e`` of its q-grams with the document, all on diagonals that differ by at most e. So
shared q-grams are counted in bands of ``2 * (e + 1)`` diagonals that overlap by half, which put any such
run wholly into one band; bands below the bound cannot hold the window and are dropped. What is
left is confirmed by an alignment inside the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.near_duplicates import mixed
from quern.llm.words import pieces

Q = 12
WINDOW = 96
STRIDE = 8
#: One edit is granted for so many bytes of a window.
BYTES_PER_EDIT = 16
#: Benchmark text compared in one pass over the documents, at most; larger sets take more passes.
PASS_BYTES = 4_000_000
#: Document text looked at together.
GROUP_BYTES = 1 << 20
FILTER_BITS = 21


def normal(text: str | None) -> bytes:
    if not text:
        return b""
    if not text.isascii():
        text = normalize("NFC", normalize("NFD", text).casefold())
    return b" ".join(text.encode().lower().split())


def qgrams(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the Q = 12 bytes from each place on."""
    if len(data) < Q:
        return np.empty(0, np.uint64)
    four = data.astype(np.uint64)
    for width in (1, 2):
        four = four[:-width] | (four[width:] << np.uint64(8 * width))
    places = len(data) - Q + 1
    eight = four[:places] | (four[4 : 4 + places] << np.uint64(32))
    return mixed(eight ^ (four[8 : 8 + places] * np.uint64(0x9E3779B97F4A7C15)))


@dataclass
class Index:
    """Windows of a block of items, and their q-grams in order of code."""

    texts: list[bytes]
    items: np.ndarray
    codes: np.ndarray
    owner: np.ndarray
    place: np.ndarray
    edits: np.ndarray
    least: np.ndarray
    known: np.ndarray


def build_index(rows: list[tuple[int, str | None]]) -> Index | None:
    texts, items = [], []
    for item, text in rows:
        data = normal(text)
        if len(data) < Q:
            continue
        starts = [*range(0, max(1, len(data) - WINDOW), STRIDE)]
        if len(data) > WINDOW:
            starts.append(len(data) - WINDOW)
        for start in dict.fromkeys(starts):
            texts.append(data[start : start + WINDOW])
            items.append(item)
    if not texts:
        return None
    grams = [qgrams(np.frombuffer(t, np.uint8)) for t in texts]
    codes = np.concatenate(grams)
    order = np.argsort(codes, kind="stable")
    owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    place = np.concatenate([np.arange(len(g)) for g in grams])
    sizes = np.array([len(t) for t in texts])
    edits = sizes // BYTES_PER_EDIT
    least = sizes - Q + 1 - Q * edits
    while (least < 1).any():  # a short window affords fewer edits
        edits = np.where(least < 1, edits - 1, edits)
        least = sizes - Q + 1 - Q * edits
    known = np.zeros(1 << FILTER_BITS, bool)
    known[(codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Index(texts, np.array(items), codes[order], owner[order], place[order], edits, least, known)


def edits_in_band(window: bytes, region: bytes, budget: int) -> int | None:
    """Least edits between the window and any part of the region, or None above the budget."""
    if window in region:
        return 0
    data = np.frombuffer(region, np.uint8)
    steps = np.arange(len(data) + 1)
    row = np.zeros(len(data) + 1, np.int64)  # a match may begin anywhere
    for byte in window:
        nearest = np.empty_like(row)
        nearest[0] = row[0] + 1
        nearest[1:] = np.minimum(row[:-1] + (data != byte), row[1:] + 1)
        row = np.minimum.accumulate(nearest - steps) + steps
        if row.min() > budget:
            return None
    return int(row.min())


def find(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """(text number, item, windows found, start, end, edits of the best) for normal texts."""
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    codes = qgrams(joined)
    maybe = np.flatnonzero(index.known[(codes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    low = np.searchsorted(index.codes, codes[maybe], "left")
    count = np.searchsorted(index.codes, codes[maybe], "right") - low
    total = int(count.sum())
    if not total:
        return []
    at = np.repeat(maybe, count)
    gram = np.repeat(low - np.cumsum(count) + count, count) + np.arange(total)
    owner, place = index.owner[gram], index.place[gram]
    ends = np.cumsum([len(t) + 1 for t in texts])
    text = np.searchsorted(ends, at, "right")
    begins = ends - np.array([len(t) + 1 for t in texts])
    # Shifted so that diagonals are not negative; bands overlap by half their width.
    diagonal = at - begins[text] - place + WINDOW
    step = index.edits[owner] + 1
    band = diagonal // step
    keys = np.concatenate([np.stack([text, owner, band, place]), np.stack([text, owner, band - 1, place])], axis=1)
    keys = np.unique(keys, axis=1)
    change = np.flatnonzero((np.diff(keys[:3], axis=1) != 0).any(axis=0)) + 1
    first = np.concatenate([[0], change])
    shared = np.diff(np.concatenate([first, [keys.shape[1]]]))
    groups = keys[:3, first]
    enough = shared >= index.least[groups[1]]
    found: dict[tuple[int, int], list[int]] = {}
    settled: set[tuple[int, int]] = set()
    for t, w, b in groups[:, enough].T.tolist():
        if (t, w) in settled:
            continue
        budget = int(index.edits[w])
        start = max(0, b * (budget + 1) - WINDOW - budget)
        end = (b + 2) * (budget + 1) - WINDOW + len(index.texts[w]) + budget
        edits = edits_in_band(index.texts[w], texts[t][start : max(0, end)], budget)
        if edits is not None:
            if edits == 0:
                settled.add((t, w))
            end = min(end, len(texts[t]))
            old = found.setdefault((t, int(index.items[w])), [set(), start, end, edits])
            old[0].add(w)
            old[1:] = [min(old[1], start), max(old[2], end), min(old[3], edits)]
    return [(t, i, len(v[0]), *v[1:]) for (t, i), v in found.items()]


def in_groups(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of together at most ``GROUP_BYTES``, or one longer text alone."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > GROUP_BYTES:
            yield begin, texts[begin:k]
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of blocks of the items; the blocks follow from the benchmark's measured size."""
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // PASS_BYTES)
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        index = build_index(sorted((r.item_id if r.item_id is not None else -1, r.text) for r in rows))
        if index is not None:
            yield index


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document and item found in it: doc_id, item_id, n_windows, start, end, edits.

    ``start`` and ``end`` bound the region in bytes of the normal text, ``edits`` is that of the best
    window. Documents without benchmark text do not appear. Null and empty texts hold nothing; an
    item that is null or shorter than ``Q`` bytes says nothing and is left out; an item without id
    is reported as -1. Repeated rows of documents are reported each, repeated items per id. Other
    columns are ignored. Empty tables give an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, n_windows long, start long, `end` long, edits long"
    result = None
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            for batch in batches:
                texts = [normal(t.as_py()) for t in batch["text"]]
                hits = []
                for begin, group in in_groups(texts):
                    hits += [(begin + t, *rest) for t, *rest in find(group, shared.value)]
                columns = list(zip(*hits)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].take(pa.array(columns[0], pa.int64())),
                     *[pa.array(c, pa.int64()) for c in columns[1:]]],
                    names=["doc_id", "item_id", "n_windows", "start", "end", "edits"])

        found = rows.mapInArrow(search, schema)
        result = found if result is None else result.union(found)
    return result if result is not None else docs.sparkSession.createDataFrame([], schema)


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark text; all columns stay."""
    for index in indexes(benchmark):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(index)), docs.schema)
    return docs


def _clean(shared):
    """A function that keeps the rows without text of one block of items."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b)):
            texts = [normal(t.as_py()) for t in piece["text"]]
            keep = np.ones(len(texts), bool)
            for begin, group in in_groups(texts):
                keep[[begin + hit[0] for hit in find(group, shared.value)]] = False
            yield piece.filter(pa.array(keep))

    return clean
