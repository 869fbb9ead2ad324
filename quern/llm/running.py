"""The running text, by logistic context mixing: bits of word codes, predicted from the words before.

The commonest words have a number and a Huffman code; every other word is coded as number 0, the
escape, and spelled (see ``mixing``). Each step of a code is a binary decision. For a decision every
context (the class of the document; the last one, two and three words, across whatever word
borders) names a slot that counts zeros and ones. The slots' log-odds are combined with weights that
a gate selects by how much the contexts have seen. The weights are learned online on texts that the
counts do not hold yet, and the mixed odds are refined by an adaptive table, as in ``mixing``.

The tables have a fixed size, 13 MB at most as they are broadcast.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

from quern.llm.near_duplicates import mixed

#: Words that have a number of their own, at most; numbers fit 16 bits beside the escape.
MOST_WORDS = (1 << 16) - 2
ESCAPE = 0
#: What stands before a text's first word.
START = (1 << 16) - 1
#: Words before that a context holds; the first input is the class of the document.
BACK = (1, 2, 3)
INPUTS = len(BACK) + 2
#: Bits of a context's table: at least, at most, and more than the tokens' own.
LEAST_BITS, MOST_BITS = 16, 21
#: Count added to both sides of a slot.
PRIOR = 0.1
#: Counts at which a context counts as better known.
KNOWN = np.array([0.5, 2.5, 15.5])
GATES = 2 * 4 ** len(BACK)
#: Counts of the class from which its odds are taken for sure.
COMMON = 255.5
REFINE_CONTEXTS = 256
REFINE_LEVELS = 33
REFINE_PRIOR = 16.0
STEADY = 50.0
#: Tokens looked at together.
CHUNK = 1 << 12


@dataclass
class Code:
    """Huffman codes of numbers 0 to n - 1: their steps one after another, as (node, bit)."""

    nodes: np.ndarray
    bits: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @property
    def size(self) -> int:
        return max(1, len(self.lengths) - 1)


def code_of(counts: list[int]) -> Code:
    """The code for numbers that occur so often; equal counts are joined in the order of the numbers."""
    heap = [(max(1, c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent, side = np.zeros(2 * len(counts), np.int64), np.zeros(2 * len(counts), np.uint8)
    node = len(counts)
    while len(heap) > 1:
        (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
        parent[left] = parent[right] = node
        side[right] = 1
        heapq.heappush(heap, (a + b, node))
        node += 1
    steps, bits, lengths = [], [], []
    for at in range(len(counts)):
        path = []
        while at != node - 1:
            path.append((int(parent[at]) - len(counts), int(side[at])))
            at = int(parent[at])
        steps += [n for n, _ in reversed(path)]
        bits += [b for _, b in reversed(path)]
        lengths.append(len(path))
    lengths = np.array(lengths, np.int64)
    return Code(np.array(steps, np.int32), np.array(bits, np.uint8), np.cumsum(lengths) - lengths, lengths)


@dataclass
class Model:
    """A code, the bits of its contexts' tables, and where each input's slots begin."""

    code: Code
    classes: int
    bits: int

    @property
    def offsets(self) -> np.ndarray:
        return np.cumsum([0, self.classes * self.code.size, *[1 << self.bits] * len(BACK)])

    @property
    def slots(self) -> int:
        return int(self.offsets[-1])


def table_bits(tokens: int) -> int:
    return int(np.clip(int(tokens).bit_length() + 2, LEAST_BITS, MOST_BITS))


def before(words: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the last one, two, ... words before every word, of texts of these sizes."""
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    context, hashes = np.zeros(len(words), np.uint64), []
    for back in range(1, 1 + max(BACK)):
        last = np.full(len(words), START, np.uint64)
        last[back:] = words[:-back]
        last[place < back] = START
        context = context * np.uint64(65_537) + last + np.uint64(1)
        if back in BACK:
            hashes.append((mixed(context + np.uint64(back)) >> np.uint64(32)).astype(np.uint32))
    return hashes


@dataclass
class Events:
    """Binary decisions of some tokens: the slots of each input, the node, the outcome, the token."""

    slots: list[np.ndarray]
    node: np.ndarray
    bit: np.ndarray
    starts: np.ndarray


def events(model: Model, words: np.ndarray, classes: np.ndarray, hashes: list[np.ndarray]) -> Events:
    lengths = model.code.lengths[words]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(model.code.starts[words] - starts, lengths)
    node, bit = model.code.nodes[at], model.code.bits[at]
    offsets = model.offsets
    slots = [np.repeat(classes.astype(np.int32) * np.int32(model.code.size), lengths) + node]
    step = (node.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    step ^= step >> np.uint32(15)
    for k, hashed in enumerate(hashes):
        slot = ((np.repeat(hashed, lengths) ^ step) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - model.bits)
        slots.append(slot.astype(np.int32) + np.int32(offsets[k + 1]))
    return Events(slots, node, bit, starts)


def chunks(model: Model, words: np.ndarray, classes: np.ndarray, sizes: np.ndarray):
    """(first token, its chunk's events), for tokens of texts of these sizes; class is per token."""
    hashes = before(words, sizes)
    for at in range(0, len(words), CHUNK):
        part = slice(at, at + CHUNK)
        yield at, events(model, words[part], classes[part], [h[part] for h in hashes])


def count(model: Model, words: np.ndarray, classes: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
    """Adds the texts' decisions to ``counts`` (slots of zeros and ones, flat)."""
    one = counts.dtype.type(1)
    for _, e in chunks(model, words, classes, sizes):
        for slots in e.slots:
            np.add.at(counts, slots * 2 + e.bit, one)


def packed(counts: np.ndarray, exact: int) -> np.ndarray:
    """Per slot its log-odds in steps of 1 / 512, times four, and how well it is known, in 16 bits.

    The first ``exact`` slots are those of the class.
    """
    pairs = counts.reshape(-1, 2)
    odds = np.log((pairs[:, 1] + PRIOR) / (pairs[:, 0] + PRIOR))
    seen = pairs.sum(1)
    known = np.searchsorted(KNOWN, seen).astype(np.int16)
    known[:exact] = seen[:exact] > COMMON
    return np.round(np.clip(odds, -15.9, 15.9) * 512).astype(np.int16) * np.int16(4) + known


@dataclass
class Mixer:
    """The packed slots, gated weights with the curvature they were learned at, the refining table."""

    model: Model
    table: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, INPUTS), 0.4))
    curvature: np.ndarray = field(default_factory=lambda: np.zeros((GATES, INPUTS, INPUTS)))
    refined: np.ndarray = field(default_factory=lambda: np.zeros((REFINE_CONTEXTS * REFINE_LEVELS, 2)))

    def inputs(self, e: Events) -> tuple[list[np.ndarray], np.ndarray]:
        """Log-odds of each context (and a constant) per decision, and the decision's gate."""
        odds, gate = [], np.zeros(len(e.bit), np.int16)
        for slots in e.slots:
            value = self.table[slots]
            odds.append((value >> 2) * np.float32(1 / 512))
            gate = gate * np.int16(4) + (value & 3)
        return [*odds, np.full(len(gate), 0.3, np.float32)], gate.astype(np.intp)

    def mix(self, odds: list[np.ndarray], gate: np.ndarray) -> np.ndarray:
        weights = self.weights.astype(np.float32).T.copy()
        total = odds[0] * weights[0][gate]
        for k in range(1, INPUTS):
            total += odds[k] * weights[k][gate]
        return np.clip(total, -14, 14)

    def learn(self, words: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> None:
        """One online pass over texts that are not counted: a Newton step for every chunk.

        The curvature adds up over the chunks, so steps shrink as more has been seen.
        """
        for _, e in chunks(self.model, words, classes, sizes):
            odds, gate = self.inputs(e)
            p = 1 / (1 + np.exp(-self.mix(odds, gate)))
            error, curve = e.bit - p, p * (1 - p)
            slope = np.stack([np.bincount(gate, error * x, GATES) for x in odds], axis=1)
            for k in range(INPUTS):
                bent = curve * odds[k]
                for j in range(k + 1):
                    more = np.bincount(gate, bent * odds[j], GATES)
                    self.curvature[:, k, j] += more
                    if j < k:
                        self.curvature[:, j, k] += more
            steady = self.curvature + STEADY * np.eye(INPUTS)
            self.weights += np.clip(np.linalg.solve(steady, slope[..., None])[..., 0], -0.5, 0.5)

    def _levels(self, e: Events, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of the refining table below the odds, and how far they are towards the next."""
        at = (np.clip(odds, -7.99, 7.99) + np.float32(8)) * np.float32((REFINE_LEVELS - 1) / 16)
        low = at.astype(np.int32)
        return (e.node % REFINE_CONTEXTS) * REFINE_LEVELS + low, at - low

    def watch(self, words: np.ndarray, classes: np.ndarray, sizes: np.ndarray, seen: np.ndarray) -> None:
        """Adds to ``seen`` how often mixed odds came true, per entry of the refining table."""
        flat = seen.reshape(-1)
        for _, e in chunks(self.model, words, classes, sizes):
            entry, part = self._levels(e, self.mix(*self.inputs(e)))
            for place, share in ((entry, 1 - part), (entry + 1, part)):
                flat += np.bincount(place * 2 + e.bit, share, len(flat))

    def log10(self, words: np.ndarray, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 probability of each token's number after the words before it."""
        levels = np.tile(np.linspace(-8, 8, REFINE_LEVELS), REFINE_CONTEXTS)
        believed = REFINE_PRIOR / (1 + np.exp(-levels))
        ones = ((self.refined[:, 1] + believed) / (self.refined.sum(1) + REFINE_PRIOR)).astype(np.float32)
        more = np.diff(ones, append=ones[-1:])
        out = np.zeros(len(words))
        for at, e in chunks(self.model, words, classes, sizes):
            if not len(e.bit):  # a code of one word has no steps
                continue
            odds = self.mix(*self.inputs(e))
            entry, part = self._levels(e, odds)
            side = e.bit * np.float32(2) - np.float32(1)
            p = 1 / (1 + np.exp(-odds * side)) + np.abs((1 - e.bit) - (ones[entry] + part * more[entry]))
            # No step is below 4e-7, so a code's product is far from the least number.
            out[at : at + len(e.starts)] = np.log10(np.multiply.reduceat(p.astype(np.float64) / 2, e.starts))
        return out
