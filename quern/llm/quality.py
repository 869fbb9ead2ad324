"""Document quality from a linear-chain conditional random field over lines.

Every line is good (1) or bad (0). A line's score is linear in its own features and those of the
lines next to it; two further weights reward staying good or bad from one line to the next.
Forward-backward sums give each line's probability of being good, and their mean weighted by
line length is the document's score. Weights maximise the likelihood of the lines of labelled
documents, each line having its document's label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import fold, stored
from quern.llm.words import pieces, split_words

#: Documents and lines the weights are fitted on, at most about; longer documents are not drawn.
SAMPLE_DOCS = 6_000
SAMPLE_LINES = 80_000
LONGEST_SAMPLED = 20_000
#: Places that the hash of an id is drawn by.
PLACES = 1 << 20
#: Score from which a document is predicted to be good.
GOOD_FROM = 0.3
RIDGE = 1e-4
STEPS = 100

OWN = 15

_KIND = np.full(256, 5, np.uint8)  # symbols
_KIND[[*b" \t\r\x0b\x0c\n"]] = 0
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[*b".,;:!?'\"()-"]] = 4


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, lines per text, and bytes per line; an empty text is one empty line."""
    split = [(t or "").split("\n") for t in texts.to_pylist()]
    counts = np.array([len(s) for s in split], np.int64)
    lines = [line for s in split for line in s]
    data = np.frombuffer(("\n".join(lines) + "\n").encode() if lines else b"", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    size = ends - starts
    kind = _KIND[data]

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[ends] - sums[starts]) / np.maximum(size, 1)

    column = pa.array(lines, pa.string())
    words, codes, per_line = split_words(column)
    line_of = np.repeat(np.arange(len(lines)), per_line)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (line_of[1:] == line_of[:-1])
    distinct = np.bincount(np.unique(line_of * np.int64(max(1, len(words))) + codes) // max(1, len(words)),
                           minlength=len(lines))
    some = np.maximum(per_line, 1)
    # Lines that the text has more than once.
    named = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text_of = np.repeat(np.arange(len(counts)), counts)
    _, same, often = np.unique(text_of * np.int64(max(1, len(lines))) + named, return_inverse=True, return_counts=True)
    final = np.where(size > 0, data[np.maximum(ends - 1, 0)], 0) if len(ends) else ends
    initial = np.where(size > 0, kind[starts], 0) if len(ends) else ends
    own = np.stack([
        np.log1p(size) / 5, share(kind == 1), share(kind == 2), share(kind == 3), share(kind == 5),
        share(data == 33), share(data == 124), np.minimum(size / some, 60) / 10, np.log1p(per_line) / 5,
        np.bincount(line_of, again, len(lines)) / some, 1 - distinct / some,
        np.isin(final, [46, 33, 63]).astype(float), (initial == 2).astype(float),
        (often[same] > 1).astype(float), (size == 0).astype(float),
    ], axis=1).astype(np.float32) if lines else np.empty((0, OWN), np.float32)
    return own, counts, size


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (0 at a text's ends), and a constant."""
    text_of = np.repeat(np.arange(len(counts)), counts)
    inner = text_of[1:] == text_of[:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:][inner] = own[:-1][inner]
    after[:-1][inner] = own[1:][inner]
    return np.concatenate([own, before, after, np.ones((len(own), 1), np.float32)], axis=1)


WEIGHTS = 3 * OWN + 1
#: Beside the features: staying good, staying bad, beginning good.
PARAMETERS = WEIGHTS + 3


def marginals(score: np.ndarray, counts: np.ndarray, stay_good: float, stay_bad: float, begin: float):
    """Probability of good per line, log partition per text, and expected stays (good, bad).

    All texts move on by one line together; the texts still running are a prefix, longest first.
    """
    texts = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[texts]
    length = counts[texts]
    longest = int(length[0]) if len(length) else 0
    running = np.searchsorted(-length, -np.arange(longest), "left")  # texts with more than t lines
    good, bad = np.empty(len(score)), np.empty(len(score))
    for t in range(longest):
        n = running[t]
        at = first[:n] + t
        if t == 0:
            good[at], bad[at] = score[at] + begin, 0.0
        else:
            g, b = good[at - 1], bad[at - 1]
            good[at] = score[at] + np.logaddexp(g + stay_good, b)
            bad[at] = np.logaddexp(g, b + stay_bad)
    last = first + length - 1
    partition = np.empty(len(counts))
    partition[texts] = np.logaddexp(good[last], bad[last])
    z = np.repeat(partition, counts)
    back_good, back_bad = np.zeros(len(score)), np.zeros(len(score))
    stays = np.zeros(2)
    for t in range(longest - 2, -1, -1):
        at = first[: running[t + 1]] + t
        next_good, next_bad = score[at + 1] + back_good[at + 1], back_bad[at + 1]
        stays[0] += np.exp(good[at] + stay_good + next_good - z[at]).sum()
        stays[1] += np.exp(bad[at] + stay_bad + next_bad - z[at]).sum()
        back_good[at] = np.logaddexp(stay_good + next_good, next_bad)
        back_bad[at] = np.logaddexp(next_good, stay_bad + next_bad)
    return np.exp(good + back_good - z), partition, stays


@dataclass
class Field:
    """Weights of the random field."""

    weights: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        """Length-weighted share of good lines per text."""
        own, counts, size = line_features(texts)
        if not len(counts):
            return np.empty(0)
        lines = with_neighbours(own, counts) @ self.weights[:WEIGHTS]
        good, _, _ = marginals(lines, counts, *self.weights[WEIGHTS:])
        weight = np.maximum(size, 1).astype(float)
        begins = np.cumsum(counts) - counts
        return np.clip(np.add.reduceat(good * weight, begins) / np.add.reduceat(weight, begins), 0.0, 1.0)


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> Field:
    """Weights of greatest likelihood, by quasi-Newton steps; ``labels`` holds one per text."""
    of_line = np.repeat(labels, counts).astype(float)
    stays = (counts - 1).astype(float)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        score = x @ w[:WEIGHTS]
        good, partition, expected = marginals(score, counts, *w[WEIGHTS:])
        begins = np.cumsum(counts) - counts
        path = (score * of_line).sum() + (stays * np.where(labels == 1, w[WEIGHTS], w[WEIGHTS + 1])).sum() + (
            w[WEIGHTS + 2] * labels).sum()
        gradient = np.empty(PARAMETERS)
        gradient[:WEIGHTS] = x.T @ (of_line - good)
        gradient[WEIGHTS] = (stays * labels).sum() - expected[0]
        gradient[WEIGHTS + 1] = (stays * (1 - labels)).sum() - expected[1]
        gradient[WEIGHTS + 2] = labels.sum() - good[begins].sum()
        n = len(counts)
        return (partition.sum() - path) / n + ridge * (w @ w) / 2, ridge * w - gradient / n

    w = np.zeros(PARAMETERS)
    value, slope = loss(w)
    inverse = np.eye(PARAMETERS)
    for step in range(steps):
        direction = -inverse @ slope
        if direction @ slope >= 0:
            inverse, direction = np.eye(PARAMETERS), -slope
        size = 1.0 if step else min(1.0, 1.0 / (np.abs(slope).sum() + 1e-12))
        for _ in range(30):
            there, new = loss(w + size * direction)
            if there <= value + 1e-4 * size * (direction @ slope):
                break
            size /= 2
        else:
            break
        moved, change = size * direction, new - slope
        w, slope, gain, value = w + moved, new, value - there, there
        curve = moved @ change
        if curve > 1e-12:
            if step == 0:
                inverse *= curve / (change @ change)
            rho = 1 / curve
            left = np.eye(PARAMETERS) - rho * np.outer(moved, change)
            inverse = left @ inverse @ left.T + rho * np.outer(moved, moved)
        if gain < 1e-7 * max(1.0, abs(value)):
            break
    return Field(w)


def fit_field(docs: DataFrame, labels: DataFrame) -> Field | None:
    """Fits on documents with a label whose id has no remainder 0; None without both labels.

    A document with several labels counts as good only if all say so. The sample is drawn by the
    hash of the id, so that it holds about ``SAMPLE_DOCS`` documents and ``SAMPLE_LINES`` lines at
    most; documents of more than ``LONGEST_SAMPLED`` lines are not drawn.
    """
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("label")).select(F.col("doc_id").alias("labelled"), "label")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(PLACES))
    total = known.filter(fold(F.col("labelled")) != 0).count()
    rate = min(1.0, SAMPLE_DOCS / max(1, total))
    # Drawn before the join, so only the sample's texts are shuffled.
    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(
        fold(F.col("doc_id")) != 0).withColumn("place", place).filter(F.col("place") < int(rate * PLACES)).filter(
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) < LONGEST_SAMPLED)
    drawn = drawn.join(known, F.col("doc_id") == F.col("labelled")).select(
        F.col("label").cast("int").alias("label"), "place", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            own, counts, _ = line_features(batch["text"])
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array(counts), batch["place"],
                 pa.array([own[e - n : e].tobytes() for e, n in zip(ends, counts)], pa.binary())],
                names=["label", "lines", "place", "own"])

    sample = stored(drawn.mapInArrow(extract, "label int, lines long, place long, own binary"), "lines")
    lines_drawn = sample.agg(F.sum("lines")).first()[0] or 0
    fewer = min(1.0, SAMPLE_LINES / max(1, lines_drawn)) * rate
    found = sample.filter(F.col("place") < int(fewer * PLACES)).orderBy("place", "own").select(
        "label", "lines", "own").collect()
    labels_of = np.array([r.label for r in found])
    if len(set(labels_of)) < 2:
        return None
    counts = np.array([r.lines for r in found], np.int64)
    own = np.concatenate([np.frombuffer(r.own, np.float32).reshape(-1, OWN) for r in found])
    return fit(with_neighbours(own, counts), counts, labels_of)


def _scored(piece: pa.RecordBatch, field: Field | None) -> np.ndarray:
    """Scores of a piece's texts; without a fitted field every text scores 1."""
    return np.ones(piece.num_rows) if field is None else field.score(piece["text"])


def quality(docs: DataFrame, labels: DataFrame, good_from: float = GOOD_FROM) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from ``good_from`` on).

    Null and empty texts are one empty line. Rows that repeat an id are scored each; a null id is
    held out. If the labels do not show both kinds, all documents score 1. Other columns are not
    looked at. An empty table gives an empty result.
    """
    field = fit_field(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b)):
            yield pa.RecordBatch.from_arrays(
                [piece["doc_id"], piece["held_out"], pa.array(_scored(piece, field))],
                names=["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text",
    ).mapInArrow(score, "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= good_from).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, good_from: float = GOOD_FROM) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good; all columns stay."""
    field = fit_field(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for b in batches for p in pieces(b)):
            yield piece.filter(pa.array(_scored(piece, field) >= good_from))

    return docs.mapInArrow(keep, docs.schema)
