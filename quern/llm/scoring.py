"""Log-probability of whole texts under a word model learned from the corpus.

Documents are put into a few classes by their letters, found by clustering all learned documents.
Then they are read once more. A piece of a few megabytes keeps its documents' words in their order
as numbers, and sends its distinct words (with the class) once, dealt into buckets by the word's hash.
A bucket gathers a word from all pieces, so it knows the word's count in the whole corpus. The
commonest words get a number of their own for all pieces; the others are judged once for a class.
What a bucket knows goes back to the pieces in the order the words left them. Neither texts nor a row
per token is shuffled.

The running text is then modelled by context mixing (``running``): the bits of every word's number
are predicted from the words before it and the class. Counts come from all learned texts, weights from
texts of the mixing fold that are not counted yet. A word without a number is an escape, then a word
of the class: its count there less ``DISCOUNT``, or, if the class has not learned it, what the counts
gave up, spread by the spelling model (``mixing``), which learns from distinct words. The model adapts
to the text as it goes: after n words, m of them equal to the next, this has probability (m + a * p) /
(n + a), p being the mixing model's; the strength ``a`` is itself mixed over ``STRENGTHS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import mixing, running
from quern.llm.common import arrow_rows, fold, stored
from quern.llm.words import pieces, split_words

#: Text of one piece, and of all documents for each bucket, in bytes.
PIECE_BYTES = 2 << 20
BUCKET_BYTES = 16 << 20
#: Documents that are sent to Python at once.
DOCUMENTS_AT_ONCE = 1000
#: Buckets, or pieces, that are sent to Python at once.
BUCKETS_AT_ONCE = 2
#: Distinct words that one counting task takes on, and tasks that count at once, at most.
WORDS_PER_TASK = 2_000_000
COUNTING_TASKS = 256
#: Slots per row in which tables travel.
TABLE_ROW = 1 << 18
#: Text that one task counts, and tasks that count the running text at once, at most; their tables
#: travel in rows of so many slots.
COUNTED_BYTES = 64 << 20
RUNNING_TASKS = 128
RUNNING_ROW = 1 << 16
#: A number goes to words seen so often at least, and not to longer ones than this, the class included.
LEAST_COUNT = 2
MOST_WORD_LENGTH = 64
#: Steps of the counts' logarithm by which the commonest words are found.
STEPS = 8
#: Remainder of the documents that are not learned from, and of those the weights are learned on.
HELD_OUT = 1
MIXING_FOLD = 2
PASSES = 2
#: The mark at the end of a text; no word holds white space.
END = "\n"
#: What every count of a word gives up to words not seen.
DISCOUNT = 0.75
#: Classes of documents.
CLASSES = 6
#: How many words' worth the model counts against the words seen in the text so far.
STRENGTHS = (3.0, 30.0, 300.0, 3_000.0, 30_000.0, 1e9)
#: Letters whose shares make a document's profile: a-z and the second bytes of accented letters.
LETTERS = np.array([*range(97, 123), *range(160, 192)])

PIECES = (
    "piece long, bucket int, first long, words array<string>, learned binary, aside binary, "
    "doc_ids array<long>, folds array<int>, n_tokens array<long>, n_bytes array<long>, classes array<int>, tokens binary")


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers, all their lowest bytes first: small ones then leave runs of zeros, which compress."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def from_planes(data, kind: str) -> np.ndarray:
    bytes_each = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(bytes_each, -1).T.copy().view(kind).ravel()


def profile(text: str | None) -> np.ndarray:
    """Square roots of the letters' shares, so that distances compare distributions."""
    counts = np.bincount(np.frombuffer((text or "").encode().lower(), np.uint8), minlength=256)[LETTERS]
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


def class_centers(docs: DataFrame, seed: int = 7) -> np.ndarray:
    """Centers of the classes: k-means over the profiles of all documents that are learned from."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [profile(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float32()))], names=["profile"])

    learned = docs.filter(fold(F.col("doc_id")) != HELD_OUT).filter(F.octet_length("text") > 0).select("text")
    with arrow_rows(docs.sparkSession, DOCUMENTS_AT_ONCE):
        found = stored(learned.mapInArrow(profiles, "profile array<float>"), "profiles")
    rows = found.count()
    if not rows:
        return np.zeros((1, len(LETTERS)))
    model = KMeans(k=min(CLASSES, rows), seed=seed, maxIter=12, initSteps=2).fit(
        found.select(array_to_vector(F.col("profile").cast("array<double>")).alias("features")))
    return np.array(model.clusterCenters())


def cut(docs: DataFrame, buckets: int, centers: np.ndarray) -> DataFrame:
    """Rows of two kinds: per (piece, bucket) its words and counts, per piece its documents with the
    places of their words, one after another and each text's end mark after it (bucket -1).

    A word is preceded by its class, as one character.
    """
    schema = pa.schema([
        ("piece", pa.int64()), ("bucket", pa.int32()), ("first", pa.int64()), ("words", pa.list_(pa.string())),
        ("learned", pa.binary()), ("aside", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("folds", pa.list_(pa.int32())), ("n_tokens", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())),
        ("classes", pa.list_(pa.int32())), ("tokens", pa.binary())])

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for piece in (p for b in batches for p in pieces(b, size=PIECE_BYTES)):
            distinct, codes, words = split_words(piece["text"], lower=True)
            distinct = [*distinct, END]
            rows = piece.num_rows
            profiles = np.array([profile(t.as_py()) for t in piece["text"]])
            kinds = ((centers**2).sum(1) - 2 * profiles @ centers.T).argmin(1)
            # Every document's words and its end mark, as class and word.
            doc = np.repeat(np.arange(rows), words + 1)
            word = np.insert(codes, np.cumsum(words), len(distinct) - 1) * np.int64(len(centers)) + kinds[doc]
            there = np.bincount(word, minlength=len(distinct) * len(centers)) > 0
            used = np.flatnonzero(there)
            token = (np.cumsum(there) - 1)[word]
            word, kind = np.divmod(used, len(centers))
            hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))
            dealt = (hashed % np.uint64(buckets))[word]
            distinct = [chr(48 + k) + distinct[w] for w, k in zip(word.tolist(), kind.tolist())]
            order = np.argsort(dealt, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            token = place[token]
            folds = piece["fold"].to_numpy(zero_copy_only=False)
            learned = np.bincount(token, folds[doc] != HELD_OUT, len(distinct)).astype(np.int64)
            aside = np.bincount(token, folds[doc] == MIXING_FOLD, len(distinct)).astype(np.int64)
            bounds = np.searchsorted(dealt[order], np.arange(buckets + 1, dtype=np.uint64))
            out = []
            for bucket in range(buckets):
                a, b = int(bounds[bucket]), int(bounds[bucket + 1])
                if a < b:
                    out.append({"piece": number, "bucket": bucket, "first": a, "words": [distinct[i] for i in order[a:b]],
                                "learned": learned[a:b].tobytes(), "aside": aside[a:b].tobytes()})
            out.append({
                "piece": number, "bucket": -1, "doc_ids": piece["doc_id"].to_pylist(), "folds": folds.tolist(),
                "n_tokens": (words + 1).tolist(), "n_bytes": piece["bytes"].to_pylist(), "classes": kinds.tolist(),
                "tokens": planes(token.astype("<i4"))})
            number += 1
            for row in out:
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), fold(F.col("doc_id")).cast("int").alias("fold"), "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    return rows.mapInArrow(cut_rows, PIECES)


BUCKETS = ("bucket int, words array<string>, learned binary, aside binary, totals binary, pieces array<long>, "
           "firsts array<long>, sizes array<long>, places binary, n_words long, n_known long, "
           "class_tokens array<long>, class_words array<long>, steps array<long>")


def _gather(key, table):
    """One bucket's words over all pieces, with their counts in the corpus."""
    lists = table["words"].combine_chunks()
    encoded = lists.flatten().dictionary_encode()
    places = encoded.indices.to_numpy(zero_copy_only=False)
    size = len(encoded.dictionary)
    sums = [np.bincount(places, np.frombuffer(b"".join(table[c].to_pylist()), "<i8"), size).astype(np.int64)
            for c in ("learned", "aside")]
    # All classes of a word are in its bucket; together they make the word's count.
    plain = pc.utf8_slice_codeunits(encoded.dictionary, 1).dictionary_encode()
    word = plain.indices.to_numpy(zero_copy_only=False)
    totals = np.bincount(word, sums[0], len(plain.dictionary)).astype(np.int64)
    kind = _parted(encoded.dictionary.to_pylist())[1]
    row = {
        "bucket": key[0].as_py(), "words": encoded.dictionary.to_pylist(), "learned": sums[0].tobytes(),
        "aside": sums[1].tobytes(), "totals": totals[word].tobytes(), "pieces": table["piece"].to_pylist(), "firsts": table["first"].to_pylist(),
        "sizes": np.diff(lists.offsets.to_numpy()).tolist(), "places": places.astype("<i4").tobytes(),
        "n_words": size, "n_known": int((totals > 0).sum()),
        "class_tokens": np.bincount(kind, sums[0], CLASSES).astype(np.int64).tolist(),
        "class_words": np.bincount(kind, sums[0] > 0, CLASSES).astype(np.int64).tolist(),
        "steps": np.bincount(_step(totals[totals >= LEAST_COUNT])).tolist()}
    return pa.Table.from_pylist([row], schema=pa.schema([
        ("bucket", pa.int32()), ("words", pa.list_(pa.string())), ("learned", pa.binary()), ("aside", pa.binary()),
        ("totals", pa.binary()), ("pieces", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
        ("places", pa.binary()), ("n_words", pa.int64()), ("n_known", pa.int64()),
        ("class_tokens", pa.list_(pa.int64())), ("class_words", pa.list_(pa.int64())), ("steps", pa.list_(pa.int64()))]))


def _step(counts: np.ndarray) -> np.ndarray:
    return np.floor(STEPS * np.log2(counts)).astype(np.int64)


def _parted(words: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Words and their classes."""
    return [w[1:].encode() for w in words], np.fromiter((ord(w[0]) - 48 for w in words), np.int64, len(words))


def _learned_words(batches: Iterator[pa.RecordBatch], new: bool = False):
    """(words, classes, ones) learned, bucket by bucket; with ``new`` those only the mixing fold has."""
    for batch in batches:
        for words, learned, aside in zip(batch["words"], batch["learned"], batch["aside"]):
            learned, aside = (np.frombuffer(c.as_py(), "<i8") for c in (learned, aside))
            some = np.flatnonzero((learned > 0) & (learned == aside) if new else learned > 0)
            words = words.as_py()
            yield (*_parted([words[i] for i in some]), np.ones(len(some)))


def _table_rows(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(table), TABLE_ROW):
        yield pa.RecordBatch.from_arrays(
            [pa.array([at // TABLE_ROW], pa.int32()), pa.array([table[at : at + TABLE_ROW].tobytes()], pa.binary())],
            names=["row", "part"])


def _summed(parts: DataFrame, kind) -> np.ndarray:
    """Sum of tables that tasks sent in rows; only the sum, of fixed size, comes to the driver."""

    def add(key, table):
        total = sum(np.frombuffer(p.as_buffer(), kind).astype(np.float64) for p in table["part"])
        return pa.table({"row": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([total.astype(kind).tobytes()], pa.binary())})

    rows = parts.groupBy("row").applyInArrow(add, "row int, part binary").collect()
    return np.concatenate([np.frombuffer(r.part, kind) for r in sorted(rows, key=lambda r: r.row)])


def fit(buckets: DataFrame, n_words: int):
    """The spelling model and the broadcast of its counts.

    The counts come from all distinct words learned. Weights and refining come from the words that
    only the mixing fold has, each with its own share taken out of the counts, for such are the
    words whose spelling matters. Tasks learn on their words one after another; after a pass the
    tasks' weights are averaged, each by its words.
    """
    tasks = max(1, min(COUNTING_TASKS, -(-n_words // WORDS_PER_TASK)))
    words = buckets.select("words", "learned", "aside")

    def count(batches):
        counts = np.zeros(2 * mixing.SLOTS, np.float32)
        for found in _learned_words(batches):
            mixing.count(*found, counts)
        yield from _table_rows(counts)

    mixer = mixing.Mixer(_summed(words.coalesce(tasks).mapInArrow(count, "row int, part binary"), np.float32))
    shared = buckets.sparkSession.sparkContext.broadcast(mixer.counts)
    aside = words.coalesce(max(tasks, 4))
    for _ in range(PASSES):
        _learn_weights(aside, shared, mixer)
    mixer.refined = _watched(aside, shared, mixer.weights)
    return mixer, shared


def _learn_weights(aside: DataFrame, shared, mixer: mixing.Mixer) -> None:
    """One pass of all tasks from the mixer's weights; takes their mean and the summed curvature."""
    weights, curvature = mixer.weights, mixer.curvature

    def learn(batches):
        own = mixing.Mixer(shared.value, weights.copy(), curvature.copy())
        seen = 0.0
        for words, classes, ones in _learned_words(batches, new=True):
            own.learn(words, classes, ones)
            seen += len(words)
        yield from _table_rows(np.concatenate(
            [own.weights.ravel() * seen, (own.curvature - curvature).ravel(), [seen]]))

    sums = _summed(aside.mapInArrow(learn, "row int, part binary"), np.float64)
    if len(sums) and sums[-1] > 0:
        mixer.weights = (sums[: weights.size] / sums[-1]).reshape(weights.shape)
        mixer.curvature = curvature + sums[weights.size : -1].reshape(curvature.shape)


def _watched(aside: DataFrame, shared, weights: np.ndarray) -> np.ndarray:
    shape = (mixing.REFINE_CONTEXTS * mixing.REFINE_LEVELS, 2)

    def watch(batches):
        own, seen = mixing.Mixer(shared.value, weights), np.zeros(shape)
        for words, classes, ones in _learned_words(batches, new=True):
            own.watch(words, classes, ones, seen)
        yield from _table_rows(seen.ravel())

    return _summed(aside.mapInArrow(watch, "row int, part binary"), np.float64).reshape(shape)


def numbered_words(buckets: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The commonest words, with their counts in the corpus and per class; at most ``running.MOST_WORDS``.

    All words whose counts are above a bound that a histogram gives; only these come to the driver.
    """
    sums = buckets.select(F.posexplode("steps")).groupBy("pos").agg(F.sum("col").alias("n")).collect()  # 300 at most
    steps = np.zeros(1 + max((r.pos for r in sums), default=0), np.int64)
    for r in sums:
        steps[r.pos] = r.n
    few = np.cumsum(steps[::-1])[::-1] <= running.MOST_WORDS
    least = int(np.argmax(few)) if few.any() else len(steps)

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, totals, learned in zip(batch["words"], batch["totals"], batch["learned"]):
                totals, learned = (np.frombuffer(c.as_py(), "<i8") for c in (totals, learned))
                some = np.flatnonzero(totals >= LEAST_COUNT)
                some = some[_step(totals[some]) >= least]
                words, found = words.as_py(), {}
                for i in some.tolist():
                    if len(words[i]) <= MOST_WORD_LENGTH:
                        row = found.setdefault(words[i][1:], [int(totals[i]), [0] * CLASSES])
                        row[1][ord(words[i][0]) - 48] = int(learned[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array([t for t, _ in found.values()], pa.int64()),
                     pa.array([c for _, c in found.values()], pa.list_(pa.int64()))], names=["word", "total", "classes"])

    rows = buckets.select("words", "totals", "learned").mapInArrow(common, "word string, total long, classes array<long>").collect()
    rows.sort(key=lambda r: (-r.total, r.word))
    return ([r.word for r in rows], np.array([r.total for r in rows], np.int64),
            np.array([r.classes for r in rows], np.int64).reshape(-1, CLASSES))


READS = ("piece long, doc_ids array<long>, folds array<int>, n_tokens array<long>, n_bytes array<long>, classes array<int>, "
         "n_known array<long>, base array<double>, numbers binary, again binary, spelled binary")


def _texts(batches: Iterator[pa.RecordBatch], folds: set[int] | None = None):
    """Pieces as (row, numbers, class per token, sizes), of the documents in ``folds``."""
    for batch in batches:
        for row in range(batch.num_rows):
            numbers = np.frombuffer(batch["numbers"][row].as_buffer(), "<u2")
            sizes = np.array(batch["n_tokens"][row].as_py(), np.int64)
            classes = np.array(batch["classes"][row].as_py(), np.int32)
            if folds is not None:
                those = np.isin(batch["folds"][row].as_py(), list(folds))
                numbers, sizes, classes = numbers[np.repeat(those, sizes)], sizes[those], classes[those]
            yield (batch, row), numbers, np.repeat(classes, sizes), sizes


def fit_running(reads: DataFrame, model: running.Model, tasks: int):
    """Weights and refining table for the running text, and the broadcasts of its model and slots.

    Weights and refining are learned on the mixing fold with the counts of the other learned texts, so
    they know how far counts can be trusted for a text that is not among them; then it is counted, too.
    """
    spark = reads.sparkSession
    learned = {f for f in range(5)} - {HELD_OUT, MIXING_FOLD}
    exact, slots = int(model.offsets[1]), model.slots
    shared_model = spark.sparkContext.broadcast(model)

    def counting(folds: set[int], aside: bool):
        def count(batches):
            table = np.zeros(2 * slots, np.uint32)
            for _, numbers, classes, sizes in _texts(batches, folds):
                running.count(shared_model.value, numbers, classes, sizes, table)
            for at in range(0, slots, RUNNING_ROW):
                part = planes(table[2 * at : 2 * (at + RUNNING_ROW)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int64()), pa.array([aside]), pa.array([part], pa.binary())], names=["at", "aside", "part"])

        return texts.coalesce(tasks).mapInArrow(count, "at long, aside boolean, part binary")

    def add(key, table):
        at = key[0].as_py()
        sums = [np.zeros(2 * min(RUNNING_ROW, slots - at)) for _ in range(2)]
        for aside, part in zip(table["aside"].to_pylist(), table["part"]):
            sums[aside] += from_planes(part.as_buffer(), "<u4")
        counted, whole = (running.packed(t, max(0, exact - at)).tobytes() for t in (sums[0], sums[0] + sums[1]))
        return pa.table({"at": pa.array([at], pa.int64()), "counted": pa.array([counted], pa.binary()),
                         "whole": pa.array([whole], pa.binary())})

    texts = reads.select("folds", "n_tokens", "classes", "numbers")
    # Apart, so that a task holds one table.
    sums = counting(learned, False).union(counting({MIXING_FOLD}, True))
    rows = sorted(sums.groupBy("at").applyInArrow(add, "at long, counted binary, whole binary").collect(), key=lambda r: r.at)
    counted, whole = (np.frombuffer(b"".join(r[c] for r in rows), np.int16) for c in ("counted", "whole"))
    if not rows:
        counted = whole = np.zeros(model.slots, np.int16)
    shared = spark.sparkContext.broadcast(counted)
    aside = texts.coalesce(max(tasks, 4))
    fresh = running.Mixer(model, counted)
    shape = fresh.refined.shape

    def learn(batches):
        own, seen = running.Mixer(shared_model.value, shared.value), 0
        for _, numbers, classes, sizes in _texts(batches, {MIXING_FOLD}):
            own.learn(numbers, classes, sizes)
            seen += len(numbers)
        yield from _table_rows(np.concatenate([own.weights.ravel() * seen, [seen]]))

    sums = _summed(aside.mapInArrow(learn, "row int, part binary"), np.float64)
    weights = (sums[:-1] / sums[-1]).reshape(fresh.weights.shape) if len(sums) and sums[-1] else fresh.weights

    def watch(batches):
        own, seen = running.Mixer(shared_model.value, shared.value, weights), np.zeros(shape)
        for _, numbers, classes, sizes in _texts(batches, {MIXING_FOLD}):
            own.watch(numbers, classes, sizes, seen)
        yield from _table_rows(seen.ravel())

    refined = _summed(aside.mapInArrow(watch, "row int, part binary"), np.float64).reshape(-1, 2)
    return weights, refined, shared_model, spark.sparkContext.broadcast(whole)


def word_log10(counts: np.ndarray, classes: np.ndarray, spelled: np.ndarray, tokens: np.ndarray,
               words: np.ndarray) -> np.ndarray:
    """log10 probability of words from their counts in their class and their spelling's log10."""
    total = np.maximum(tokens, 1)[classes]
    open_mass = np.where(tokens > 0, DISCOUNT * words / np.maximum(tokens, 1), 1.0)[classes]
    return np.log10(np.maximum(counts - DISCOUNT, 0) / total + open_mass * 10.0 ** np.maximum(spelled, -300))


def _class_log10(cuts: DataFrame, classes: int) -> np.ndarray:
    """log10 share of each class among the documents learned from, smoothed."""
    pairs = cuts.filter("bucket = -1").select(F.explode(F.arrays_zip("folds", "classes")).alias("d"))
    counts = np.full(classes, 0.5)
    for r in pairs.filter(F.col("d.folds") != HELD_OUT).groupBy(F.col("d.classes").alias("c")).count().collect():
        counts[r.c] += r["count"]
    return np.log10(counts / counts.sum())


def adapted(logs: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """log10 probability per text, given its distinct words' log10 under the model and their counts,
    for a model that does not heed the words before."""
    word = np.repeat(np.arange(len(counts)), counts)
    again = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
    return along(logs[word], again, np.add.reduceat(counts, starts))


def along(logs: np.ndarray, again: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 probability per text of so many tokens, given each token's log10 under the model and how
    often its text has had the word before."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(logs)) - np.repeat(starts, sizes)
    repeated = np.flatnonzero(again)
    chance = 10.0 ** np.maximum(logs[repeated], -300)
    found = np.empty((len(STRENGTHS), len(sizes)))
    for k, strength in enumerate(STRENGTHS):
        each = logs + np.log10(strength)
        each[repeated] = np.log10(again[repeated] + strength * chance)
        found[k] = np.add.reduceat(each - np.log10(place + strength), starts)
    best = found.max(0)
    return best + np.log10((10.0 ** (found - best)).mean(0))


def occurrences(keys: np.ndarray) -> np.ndarray:
    """How often each key has stood before."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=-1))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    return out


def scores(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.

    Tokens are the words, A-Z lower-cased, and one end mark. ``base_score`` is the smoothed unigram
    log10 probability; ``score`` is that of the adapted context mixing model. Both learn from documents
    whose id has another remainder than ``HELD_OUT``. ``bits_per_byte`` spreads the score over the
    text's bytes and its end. Null and empty texts are the end mark alone. Rows that repeat an id
    are scored each; a null id is learned from. Other columns are ignored. An empty table gives an
    empty result.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    centers = class_centers(docs)
    with arrow_rows(docs.sparkSession, DOCUMENTS_AT_ONCE):
        cuts = stored(cut(docs, max(1, -(-size // BUCKET_BYTES)), centers), "pieces")
    class_bits = _class_log10(cuts, len(centers))
    dealt = cuts.filter("bucket >= 0").select("bucket", "piece", "first", "words", "learned", "aside")
    buckets = stored(dealt.groupBy("bucket").applyInArrow(_gather, BUCKETS), "buckets")
    kinds = range(CLASSES)
    totals = buckets.agg(
        F.sum("n_words"), F.sum("n_known"), *[F.sum(F.get("class_tokens", F.lit(k))) for k in kinds],
        *[F.sum(F.get("class_words", F.lit(k))) for k in kinds]).first()
    n_words, known, *by_class = (int(t or 0) for t in totals)
    class_tokens, class_words = np.array(by_class[:CLASSES]), np.array(by_class[CLASSES:])
    tokens = int(class_tokens.sum())
    with arrow_rows(docs.sparkSession, BUCKETS_AT_ONCE):
        common, common_counts, common_classes = numbered_words(buckets)
        mixer, shared = fit(buckets, n_words)
    numbers = docs.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(common)})
    # What the classes learned beside the words with a number.
    class_tokens, class_words = class_tokens - common_classes.sum(0), class_words - (common_classes > 0).sum(0)
    weights, refined = mixer.weights, mixer.refined

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = mixing.Mixer(shared.value, weights, refined=refined)
        for batch in batches:
            for row in range(batch.num_rows):
                text = batch["words"][row].as_py()
                number = np.fromiter((numbers.value.get(w[1:], running.ESCAPE) for w in text), "<u2", len(text))
                own = np.frombuffer(batch["learned"][row].as_py(), "<i8")
                words, classes = _parted(text)
                spelled = np.full(len(text), -300.0)
                new = np.flatnonzero((number == running.ESCAPE) & (own == 0))
                spelled[new] = model.log10([words[i] for i in new], classes[new])
                logs = word_log10(own, classes, spelled, class_tokens, class_words).astype("<f4")
                counts = np.frombuffer(batch["totals"][row].as_py(), "<i8")
                places = np.frombuffer(batch["places"][row].as_py(), "<i4")
                sizes = batch["sizes"][row].as_py()
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [batch["pieces"][row].values, batch["firsts"][row].values,
                     *[pa.array([planes(c[places[e - n : e]]) for e, n in zip(ends, sizes)], pa.binary())
                       for c in (counts, number, logs)]],
                    names=["piece", "first", "learned", "numbers", "logs"])

    values = buckets.select("words", "learned", "totals", "places", "pieces", "firsts", "sizes").mapInArrow(
        judge, "piece long, first long, learned binary, numbers binary, logs binary")
    kept = cuts.filter("bucket = -1").select("piece", "doc_ids", "folds", "n_tokens", "n_bytes", "classes", "tokens")

    def read(own, back):
        order = np.argsort(back["first"].to_numpy())
        learned, number, logs = (
            np.concatenate([from_planes(back[c][i].as_buffer(), kind) for i in order.tolist()])
            for c, kind in (("learned", "<i8"), ("numbers", "<u2"), ("logs", "<f4")))
        base = np.log10((learned + 0.5) / (tokens + 0.5 * (known + 1)))
        token = from_planes(own["tokens"][0].as_buffer(), "<i4")
        sizes = np.array(own["n_tokens"][0].as_py(), np.int64)
        starts = np.cumsum(sizes) - sizes
        again = occurrences(np.repeat(np.arange(len(sizes)), sizes) * np.int64(len(learned)) + token)
        escaped = token[number[token] == running.ESCAPE]
        return own.drop_columns(["tokens"]).append_column(
            "n_known", pa.array([np.add.reduceat((learned > 0).astype(np.int64)[token], starts).tolist()], pa.list_(pa.int64()))
        ).append_column("base", pa.array([np.add.reduceat(base[token], starts).tolist()], pa.list_(pa.float64()))
        ).append_column("numbers", pa.array([number[token].tobytes()], pa.binary())
        ).append_column("again", pa.array([planes(again.astype("<u4"))], pa.binary())
        ).append_column("spelled", pa.array([logs[escaped].tobytes()], pa.binary()))

    with arrow_rows(docs.sparkSession, BUCKETS_AT_ONCE):
        reads = stored(kept.groupBy("piece").cogroup(values.groupBy("piece")).applyInArrow(read, READS), "reads")
    rest = int(tokens - common_counts.sum())
    model = running.Model(running.code_of([rest, *common_counts.tolist()]), CLASSES, running.table_bits(tokens))
    tasks = max(1, min(RUNNING_TASKS, -(-size // COUNTED_BYTES)))
    with arrow_rows(docs.sparkSession, BUCKETS_AT_ONCE):
        running_weights, running_refined, shared_model, slots = fit_running(reads, model, tasks)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = running.Mixer(shared_model.value, slots.value, running_weights, refined=running_refined)
        for (batch, row), number, classes, sizes in _texts(batches):
            logs = mixer.log10(number, classes, sizes)
            logs[number == running.ESCAPE] += np.frombuffer(batch["spelled"][row].as_buffer(), "<f4")
            again = from_planes(batch["again"][row].as_buffer(), "<u4")
            score = along(logs, again, sizes) + class_bits[np.array(batch["classes"][row].as_py(), np.int64)]
            n_bytes = np.array(batch["n_bytes"][row].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_ids"][row].values, pa.array([f == HELD_OUT for f in batch["folds"][row].as_py()], pa.bool_()),
                 batch["n_tokens"][row].values, batch["n_known"][row].values,
                 pa.array(np.full(len(sizes), tokens, np.int64)), batch["base"][row].values, pa.array(score),
                 pa.array(-score * np.log2(10) / (n_bytes + 1))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return reads.mapInArrow(
        total, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double")
