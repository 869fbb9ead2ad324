"""Personal data in texts: exact patterns, and boosted trees over many overlapping candidates.

Patterns find e-mail addresses, network addresses, card and phone numbers; a match that fails its
check is dropped and not tried again. Generators then propose far more spans: every run of digit
groups is cut at all group borders, so a number that a pattern swallowed with its neighbour is
among them. Boosted trees judge a candidate by its format and by the characters and words beside
it. They learn from candidates with a clear answer (see ``label``); a calibrated threshold, set on
documents that were not learned from, selects spans to add. Spans of the patterns always stay.

The texts are scanned twice, once for what the trees learn and once to decide; no candidate is kept
in between. All patterns start where a match can start, so a scan is linear in the text's length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.boosting import BoostedTrees, platt
from quern.llm.common import fold, stored
from quern.llm.words import pieces

#: Kinds in the order of equal starts.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD_MATCH = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE_MATCH = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

RUN = re.compile(r"[0-9]+(?:[\x20().-]{1,3}[0-9]+)*")
GROUP = re.compile(r"[0-9]+")
TOKEN = re.compile(r"\S+")
#: What is looked at on either side of a candidate for words, in characters.
BESIDE = 24
WORD_BUCKETS = 16
#: Candidates judged together.
JUDGED = 4096
#: Candidates the trees learn from and are calibrated on, at most about.
SAMPLE = 60_000
#: Precision the threshold must reach on documents that were not learned from.
PRECISION = 0.95


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def small(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def digits_of(text: str) -> str:
    return "".join(GROUP.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain: an @ takes the run of characters to its left."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL_PART.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, leftmost first; a longer run of numbers is cut into fours."""
    for m in DOTTED.finditer(text):
        if text.count(".", *m.span()) < 3:
            continue
        numbers = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m.group())]
        for k in range(0, len(numbers) - 3, 4):
            yield numbers[k][0], numbers[k + 3][1]


def matches(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Spans (kind, start, end) that pass their check, and the extents of those that fail."""
    found, failed = [(EMAIL, *s) for s in emails(text)], []
    spans = [(IP, *s) for s in addresses(text)]
    spans += [(k, *m.span()) for k, p in ((CARD, CARD_MATCH), (PHONE, PHONE_MATCH)) for m in p.finditer(text)]
    for kind, start, end in spans:
        if passes(kind, text[start:end]):
            found.append((kind, start, end))
        else:
            failed.append((start, end))
    return sorted(found, key=lambda s: (s[1], s[0])), failed


def passes(kind: int, span: str) -> bool:
    if kind == IP:
        return all(small(p) for p in span.split("."))
    digits = digits_of(span)
    if kind == CARD:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def candidates(text: str) -> Iterator[tuple[int, int, int, list[float]]]:
    """(kind, start, end, features) of overlapping spans that may be personal data."""
    for token in TOKEN.finditer(text) if "@" in text else ():
        left = token.start()
        at = text.find("@", left, token.end())
        while at >= 0:
            right = text.find("@", at + 1, token.end())
            stop = right if right >= 0 else token.end()
            inner = DOMAIN.search(text, at + 1, stop)
            start, end = left, inner.end() if inner else stop
            while start < at and not LOCAL_PART.match(text[start]):
                start += 1
            if start < at and end > at + 1:
                yield EMAIL, start, end, features(EMAIL, text, start, end, [])
            left, at = at + 1, right
    for m in RUN.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m.group())]
        for i, (start, _) in enumerate(groups):
            begin = start
            while begin > 0 and text[begin - 1] in "+(" and start - begin < 2:
                begin -= 1
            size = 0
            for j in range(i, len(groups)):
                size += groups[j][1] - groups[j][0]
                if size > 19:
                    break
                own, end = groups[i : j + 1], groups[j][1]
                between = {text[a:b] for (_, a), (b, _) in zip(own, own[1:])}
                if j - i == 3 and between == {"."}:
                    yield IP, start, end, features(IP, text, start, end, own)
                if size >= 12:
                    yield CARD, start, end, features(CARD, text, start, end, own)
                if 7 <= size <= 15:
                    yield PHONE, begin, end, features(PHONE, text, begin, end, own)


def _beside(char: str) -> float:
    return 0.0 if not char or char.isspace() else 1.0 if char.isdigit() else 2.0 if char.isalpha() else 3.0


def _word(text: str) -> tuple[float, float]:
    """Bucket and length of a word beside a span; (-1, 0) if there is none."""
    letters = "".join(c for c in text.lower() if c.isalpha())
    return (float(crc32(letters.encode()) % WORD_BUCKETS), float(len(letters))) if letters else (-1.0, 0.0)


def features(kind: int, text: str, start: int, end: int, groups: list[tuple[int, int]]) -> list[float]:
    """Format of a span, and the characters and words beside it."""
    span = text[start : min(end, start + 256)]
    digits = "".join(text[a:b] for a, b in groups)
    sizes = [b - a for a, b in groups] or [0]
    before, after = text[max(0, start - BESIDE) : start], text[end : end + BESIDE]
    return [
        float(kind), float(len(digits)), float(len(groups)), float("+" in span[:1]), float("(" in span),
        float(span.count(" ")), float(span.count("-")), float(span.count(".")), float(max(sizes)), float(min(sizes)),
        float(len(digits) > 1 and luhn(digits)),
        float(all(small(text[a:b]) for a, b in groups)),
        _beside(before[-1:]), _beside(after[:1]), float(any(c.isdigit() for c in before[-3:])),
        float(any(c.isdigit() for c in after[:3])), float(sizes[0]), float(sizes[-1]),
        float(DOMAIN.fullmatch(span.partition("@")[2]) is not None), float(min(end - start, 64)),
        *_word((before.split() or [""])[-1]), *_word((after.split() or [""])[0]),
        float(before.rstrip()[-1:] == ":"), float(crc32(digits[:2].encode()) % WORD_BUCKETS if digits else -1),
    ]


class Covered:
    """Which places of a text spans cover, as ordered intervals that do not touch each other."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for *_, start, end in sorted(spans, key=lambda s: s[-2]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start

    def add(self, start: int, end: int) -> None:
        k = bisect_left(self.starts, start)
        self.starts.insert(k, start)
        self.ends.insert(k, end)


def label(kind: int, start: int, end: int, text: str, known: set, base: Covered, dropped: Covered) -> int:
    """What the patterns say of a candidate: 1, 0, or -1 where they leave it open.

    A pattern's span is 1. Part of one, or a span that reaches over one, is 0, and so is a number
    whose checksum, parts or count of digits no kind allows. What would pass its check is open, as
    a pattern may have lost it to the number beside it; so is a telephone number without ``+``.
    """
    if (kind, start, end) in known:
        return 1
    span = text[start : min(end, start + 256)]
    if base.overlaps(start, end) or (kind != EMAIL and not passes(kind, span)):
        return 0
    if kind == EMAIL and not DOMAIN.fullmatch(span.partition("@")[2]):
        return 0
    return -1 if kind == PHONE or dropped.overlaps(start, end) else 0


def learned_from(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, kind, label, x) of all candidates with a label."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "end", "kind", "label", "x"]
        for batch in batches:
            held: list[tuple] = []
            for doc_id, text in _texts(batch):
                base, failed = matches(text)
                known, covered, dropped = set(base), Covered(base), Covered(failed)
                for kind, start, end, x in candidates(text):
                    told = label(kind, start, end, text, known, covered, dropped)
                    if told >= 0:
                        held.append((doc_id, start, end, kind, told, x))
                    if len(held) >= JUDGED:
                        yield _batch(held, names)
                        held = []
            if held:
                yield _batch(held, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id long, start long, `end` long, kind int, label int, x array<float>")


_KINDS = {"doc_id": pa.int64(), "start": pa.int64(), "end": pa.int64(), "kind": pa.int32(), "label": pa.int32(),
          "x": pa.list_(pa.float32())}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[n]) for n, c in zip(names, zip(*rows))], names=names)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int | None, str]]:
    """Ids and texts that may hold a span."""
    interesting = re.compile("[0-9@]")
    for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
        text = value.as_py() or ""
        if interesting.search(text):
            yield doc_id, text


@dataclass
class Judge:
    """Trees, their calibration, and the probability from which a candidate is added."""

    trees: BoostedTrees
    slope: float
    offset: float
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.offset, -30, 30)))


def fit_judge(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> Judge | None:
    """Learns from a bounded sample of labelled candidates, drawn by hash; None without both labels.

    Documents whose id has remainder 0 are kept for calibration and the threshold, which is the
    lowest probability from which on the added candidates reach the precision.
    """
    rows = stored(learned_from(docs), "candidates")
    total = rows.count()
    place = F.pmod(F.xxhash64("doc_id", "start", "end", "kind"), F.lit(1 << 20))
    drawn = rows.filter(place < int(min(1.0, sample / max(1, total)) * (1 << 20))).select(
        (fold(F.col("doc_id")) == 0).alias("aside"), "label", "x").collect()
    if not drawn:
        return None
    x = np.array([r.x for r in drawn], np.float32)
    y = np.array([r.label for r in drawn], float)
    aside = np.array([r.aside for r in drawn])
    if aside.all() or len(set(y[~aside])) < 2:
        return None
    trees = BoostedTrees().fit(x[~aside], y[~aside])
    if len(set(y[aside])) < 2:
        aside = ~aside
    margin = trees.margin(x[aside])
    slope, offset = platt(margin, y[aside])
    judge = Judge(trees, slope, offset, 1.0)
    p = judge.probability(x[aside])
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[aside][order]) / np.arange(1, len(order) + 1)
    last = np.append(p[order][1:] != p[order][:-1], True)  # ties share a threshold
    good = np.flatnonzero((hits >= precision) & last)
    if len(good):
        # Down to the next candidate below, which would spoil the precision; never under one half.
        below = p[order][good[-1] + 1 :]
        judge.threshold = max(0.5, float(np.nextafter(below[0], 1)) if len(below) else 0.5)
    else:
        judge.threshold = 1.1
    return judge


def personal_data(docs: DataFrame, judge: Judge | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, counts and digest of the patterns' spans, all spans, added spans.

    Spans are kind:start:end in code points, end exclusive, ordered by start, then kind. Added
    spans overlap no span of a pattern nor each other; the likelier one wins, then the earlier.
    Null and empty texts have no spans. Rows that repeat an id are judged each; a null id is kept.
    Other columns are ignored. An empty table gives an empty result.
    """
    judge = judge or fit_judge(docs)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            columns: dict[str, list] = {n: [] for n in names}
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = value.as_py() or ""
                base, _ = matches(text)
                added = added_spans(text, base, judge) if judge is not None else []
                columns["doc_id"].append(doc_id)
                for k, kind in enumerate(KINDS):
                    columns[f"n_{kind}"].append(sum(s[0] == k for s in base))
                columns["base_sha256"].append(hashlib.sha256(_shown(base).encode()).hexdigest())
                columns["spans"].append(_shown(base + added))
                columns["n_added"].append(len(added))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n, v in columns.items()],
                names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        decide, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, n_added long")


def added_spans(text: str, base: list[tuple[int, int, int]], judge: Judge) -> list[tuple[int, int, int]]:
    """Candidates beside the patterns' spans that reach the threshold; the likelier of two that overlap."""
    taken, likely = Covered(base), []
    found = (c for c in candidates(text) if not taken.overlaps(c[1], c[2]))
    while chunk := list(islice(found, JUDGED)):
        p = judge.probability(np.array([c[3] for c in chunk], np.float32))
        likely += [(-p[i], *chunk[i][:3]) for i in np.flatnonzero(p >= judge.threshold)]
    added = []
    for _, kind, start, end in sorted(likely, key=lambda c: (c[0], c[2], c[3])):
        if not taken.overlaps(start, end):
            added.append((kind, start, end))
            taken.add(start, end)
    return added


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans, key=lambda s: (s[1], s[0], s[2])))
