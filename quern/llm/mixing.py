"""How words are spelled, by logistic context mixing: bits of bytes, predicted from hashed contexts.

A word is its bytes and one space. Each byte is eight binary decisions. For a decision every
context (the last 1 to 5 bytes of the word, most with the class of the document) names a slot that
counts zeros and ones; the slots' log-odds are combined with weights that a gate selects by how
much the longer contexts have seen. The weights are learned online, batch by batch, and the mixed
odds are refined by an adaptive table that knows how often such odds came true.

The tables have a fixed size of some 15 MB, which is broadcast once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from quern.llm.near_duplicates import mixed

#: Bytes of a context, bits of its table, whether the class is part of it.
CONTEXTS = ((1, 16, True), (2, 18, True), (3, 19, True), (4, 19, True), (5, 19, False))
#: Contexts whose counts choose the gate.
GATED = (3, 4)
INPUTS = len(CONTEXTS) + 1
OFFSETS = np.concatenate([[0], np.cumsum([1 << b for _, b, _ in CONTEXTS])])
SLOTS = int(OFFSETS[-1])
#: Count added to both sides of a slot.
PRIOR = 0.2
#: Counts at which a context counts as better known.
KNOWN = np.array([0.5, 3.5, 31.5])
GATES = 4 * 4 * 8
REFINE_CONTEXTS = 1024
REFINE_LEVELS = 33
#: Bytes looked at together.
CHUNK = 1 << 15
#: Curvature that the weights start with, in decisions.
STEADY = 50.0
#: Weight given to the prior of an entry of the refining table.
REFINE_PRIOR = 16.0

_NODE = np.uint64(0x9E3779B97F4A7C15)


def chunks(words: list[bytes], size: int = CHUNK):
    """Ranges of words with together about ``size`` bytes."""
    ends = np.cumsum([len(w) + 1 for w in words])
    begin = 0
    while begin < len(words):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + size, "right")))
        yield begin, end
        begin = end


@dataclass
class Events:
    """Binary decisions of some words: per byte and bit the slots, the node, the outcome."""

    slots: list[np.ndarray]
    node: np.ndarray
    bit: np.ndarray
    before: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def events(words: list[bytes], classes: np.ndarray) -> Events:
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    lengths = np.array([len(w) + 1 for w in words])
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    wide = data.astype(np.uint64)
    last = []
    for back in range(1, 1 + max(width for width, _, _ in CONTEXTS)):
        shifted = np.zeros(len(data), np.uint64)
        shifted[back:] = wide[:-back]
        shifted[place < back] = 0
        last.append(shifted)
    shift = np.arange(8, dtype=np.uint8)
    node = ((1 << shift)[None, :] | (data[:, None] >> (8 - shift)[None, :].astype(np.uint8))).astype(np.uint64)
    node[:, 0] = 1
    bit = (data[:, None] >> (7 - shift)[None, :]) & 1
    slots = []
    kind = np.repeat(classes.astype(np.uint64) + np.uint64(1), lengths)
    for k, (width, bits, classed) in enumerate(CONTEXTS):
        context = np.minimum(place, width).astype(np.uint64)
        if classed:
            context = context * np.uint64(65_537) + kind
        for back_by in range(width):
            context = context * np.uint64(257) + last[back_by]
        start = mixed(context + np.array([k + 1], np.uint64) * _NODE)
        key = (start[:, None] + node * _NODE) * np.uint64(0xD6E8FEB86659FD93)
        slots.append((key >> np.uint64(64 - bits)).astype(np.int64) + OFFSETS[k])
    return Events(slots, node.astype(np.int64), bit, last[0].astype(np.int64), starts, lengths)


def count(words: list[bytes], classes: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> None:
    """Adds the words' decisions to ``counts`` (slots of zeros and ones, flat)."""
    for begin, end in chunks(words):
        e = events(words[begin:end], classes[begin:end])
        weight = np.repeat(np.repeat(weights[begin:end], e.lengths).astype(np.float32), 8)
        for slots in e.slots:
            np.add.at(counts, (slots * 2 + e.bit).ravel(), weight)


@dataclass
class Mixer:
    """Counts, gated weights with the curvature they were learned at, and the refining table."""

    counts: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, INPUTS), 1 / len(CONTEXTS)))
    curvature: np.ndarray = field(default_factory=lambda: np.zeros((GATES, INPUTS, INPUTS)))
    refined: np.ndarray = field(default_factory=lambda: np.zeros((REFINE_CONTEXTS * REFINE_LEVELS, 2)))

    def inputs(self, e: Events, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each context (and a constant) per decision, and the decision's gate.

        ``own`` takes the words' own share out of the counts, as if they had not been counted.
        """
        odds = np.empty((INPUTS, *e.bit.shape), np.float32)
        pairs = self.counts.reshape(-1, 2)
        gate = np.zeros(e.bit.shape, np.int64)
        for k, slots in enumerate(e.slots):
            seen = pairs[slots]
            zeros, ones = seen[..., 0], seen[..., 1]
            if own is not None:
                zeros = np.maximum(zeros - own * (1 - e.bit), 0)
                ones = np.maximum(ones - own * e.bit, 0)
            odds[k] = np.log((ones + PRIOR) / (zeros + PRIOR))
            if k in GATED:
                gate = gate * 4 + np.searchsorted(KNOWN, zeros + ones)
        odds[-1] = 0.3
        return odds, gate * 8 + np.arange(8)

    def mix(self, odds: np.ndarray, gate: np.ndarray) -> np.ndarray:
        chosen = self.weights[gate]
        return np.clip(sum(odds[k] * chosen[..., k] for k in range(INPUTS)), -14, 14)

    def learn(self, words: list[bytes], classes: np.ndarray, weights: np.ndarray) -> None:
        """One online pass: after each batch the weights of its gates take a Newton step.

        The curvature adds up over the batches, so steps shrink as more has been seen. The words'
        own counts are left out, else every word would look known.
        """
        for begin, end in chunks(words):
            e = events(words[begin:end], classes[begin:end])
            weight = np.repeat(weights[begin:end], e.lengths).astype(np.float32)[:, None]
            odds, gate = self.inputs(e, weight)
            p = 1 / (1 + np.exp(-self.mix(odds, gate)))
            error, curve = weight * (e.bit - p), weight * p * (1 - p)
            flat = gate.ravel()
            slope = np.stack([np.bincount(flat, (error * x).ravel(), GATES) for x in odds], axis=1)
            for k in range(INPUTS):
                bent = curve * odds[k]
                for j in range(k + 1):
                    more = np.bincount(flat, (bent * odds[j]).ravel(), GATES)
                    self.curvature[:, k, j] += more
                    if j < k:
                        self.curvature[:, j, k] += more
            steady = self.curvature + STEADY * np.eye(INPUTS)
            self.weights += np.clip(np.linalg.solve(steady, slope[..., None])[..., 0], -0.5, 0.5)

    def _levels(self, e: Events, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of the refining table below the odds, and how far they are towards the next."""
        context = ((e.before[:, None] * 256 + e.node) * 40503 >> 4) % REFINE_CONTEXTS
        at = (np.clip(odds, -7.99, 7.99) + 8) * ((REFINE_LEVELS - 1) / 16)
        low = at.astype(np.int64)
        return context * REFINE_LEVELS + low, at - low

    def watch(self, words: list[bytes], classes: np.ndarray, weights: np.ndarray, seen: np.ndarray) -> None:
        """Adds to ``seen`` how often mixed odds came true, per entry of the refining table."""
        for begin, end in chunks(words):
            e = events(words[begin:end], classes[begin:end])
            weight = np.repeat(weights[begin:end], e.lengths).astype(np.float32)[:, None]
            odds, gate = self.inputs(e, weight)
            entry, part = self._levels(e, self.mix(odds, gate))
            for place, share in ((entry, 1 - part), (entry + 1, part)):
                np.add.at(seen, (place.ravel(), e.bit.ravel()), (share * weight).ravel())

    def log10(self, words: list[bytes], classes: np.ndarray) -> np.ndarray:
        """log10 probability of each word in a document of its class."""
        levels = np.tile(np.linspace(-8, 8, REFINE_LEVELS), REFINE_CONTEXTS)
        believed = REFINE_PRIOR / (1 + np.exp(-levels))
        ones = (self.refined[:, 1] + believed) / (self.refined.sum(1) + REFINE_PRIOR)
        out = np.empty(len(words))
        for begin, end in chunks(words):
            e = events(words[begin:end], classes[begin:end])
            odds = self.mix(*self.inputs(e))
            entry, part = self._levels(e, odds)
            p = (1 / (1 + np.exp(-odds)) + (1 - part) * ones[entry] + part * ones[entry + 1]) / 2
            p = np.where(e.bit == 1, p, 1 - p)
            out[begin:end] = np.add.reduceat(np.log10(np.maximum(p, 1e-12)).sum(1), e.starts)
        return out
