"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

The sketch of a set of shingles has ``BINS`` places. In round i < BINS every shingle throws a
(bin, value) pair and a place keeps the smallest (round, value); the rounds end when every
place is taken. From round BINS on, round BINS + j fills place j alone, so all places are filled
after at most 2 * BINS rounds. Two sets agree in a place with the probability of their Jaccard
similarity, and the agreeing share concentrates as with independent minima.

``BANDS`` bands of ``ROWS`` places each make candidates: a pair of similarity s is missed with
probability (1 - s**ROWS)**BANDS, 5e-6 at 0.75. Candidates are confirmed on their full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import arrow_rows, stored
from quern.llm.graph import components
from quern.llm.words import pieces, split_words

BIN_BITS = 7
BINS = 1 << BIN_BITS
ROWS = 4
BANDS = BINS // ROWS
SHINGLE = 5
#: Similarity in hundredths from which two documents are linked.
SIMILAR = 75
#: Rounds in which a hub of each bucket is compared with its members, before the rest is tiled.
HUB_ROUNDS = 2
#: Documents, and pairs of sets, that are sent to Python at once.
DOCUMENTS_AT_ONCE = 1000
PAIRS_AT_ONCE = 500
#: Shingle hashes that one block of a tile holds, in bytes.
BLOCK_BYTES = 4 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: pa.Array, width: int = SHINGLE) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its distinct shingles of ``width`` words."""
    distinct, codes, counts = split_words(texts, lower=True)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct), np.uint64, len(distinct))[codes]
    out, end = [], 0
    for count in counts.tolist():
        words, end = hashed[end : end + count], end + count
        # A shorter text is one shingle of its own length, unlike any of the full width.
        size = min(width, count)
        places = count - size + 1 if count else 0
        shingles = np.full(places, size, np.uint64)
        for k in range(size):
            shingles = (shingles ^ words[k : k + places]) * _STEP
            shingles ^= shingles >> np.uint64(32)
        out.append(np.unique(mixed(shingles)))
    return out


def sketch(items: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: BINS numbers."""
    places = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64((1 << 48) - 1)
    done = 0
    together = max(1, 900 // len(items))
    while done < BINS:
        rounds = np.arange(done, min(BINS, done + together), dtype=np.uint64)
        thrown = mixed(items[None, :] + (rounds[:, None] + np.uint64(1)) * _GOLDEN)
        keys = (thrown & low) | (rounds[:, None] << np.uint64(48))
        np.minimum.at(places, (thrown >> np.uint64(64 - BIN_BITS)).astype(np.int64).ravel(), keys.ravel())
        done += len(rounds)
        if places.max() != np.iinfo(np.uint64).max:
            return places
    for j in np.flatnonzero(places == np.iinfo(np.uint64).max):
        at = np.array([BINS + j], np.uint64)
        places[j] = (mixed(items + (at + np.uint64(1)) * _GOLDEN) & low).min() | (at[0] << np.uint64(48))
    return places


def band_keys(places: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, from its places and its number."""
    keys = np.arange(BANDS, dtype=np.uint64) * _GOLDEN
    for column in places.reshape(BANDS, ROWS).T:
        keys = mixed(keys ^ column)
    return keys.view(np.int64)


def signatures(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, set size n, digest of the set, band keys (null if empty)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            sizes, digests, bands = [], [], []
            for items in shingle_hashes(batch["text"], shingle):
                sizes.append(len(items))
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                bands.append(band_keys(sketch(items)) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n", "digest", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sign, "doc_id long, n long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, ids: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, n, items): the sorted shingle hashes of the documents in ``ids`` (id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = shingle_hashes(batch["text"], shingle)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) for x in found], pa.int64()),
                 pa.array([x.tobytes() for x in found], pa.binary())],
                names=["id", "n", "items"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = rows.join(ids, rows.doc_id == ids.id, "left_semi")
    return wanted.mapInArrow(sets, "id long, n long, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """Those ``pairs`` (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["items_a"], batch["items_b"]):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                linked.append(100 * both >= similar * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "items_a", "items_b").mapInArrow(
        compare, "a long, b long")


def _merged(labels: DataFrame | None, links: DataFrame | None, found: DataFrame):
    """All links so far, and the components they make."""
    if found.isEmpty():
        return labels, links
    links = found if links is None else links.union(found)
    return components(links), links


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of their ``id``; an id without links is its own."""
    if labels is None:
        return rows.withColumn("component", F.col("id"))
    return rows.join(labels, rows.id == labels.node, "left").select(
        *rows.columns, F.coalesce("component", "id").alias("component"))


def _open_rows(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets that hold more than one component, with a hub of the bucket."""
    rows = _labelled(members, labels)
    hub = F.min(F.struct(F.xxhash64("id").alias("order"), "id", "n", "component")).alias("hub")
    several = rows.groupBy(F.col("key").alias("bucket")).agg(
        (F.min("component") < F.max("component")).alias("open"), hub).filter("open").drop("open")
    return rows.join(several, rows.key == several.bucket).drop("bucket")


def linked_components(members: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame | None:
    """Components (node, component) of the links inside the buckets of ``members`` (key, id, n).

    A bucket needs no pair of two documents that are connected already. So first one hub of each
    bucket is compared with the members outside its component, which settles most buckets at a
    cost in proportion to their size. What is still open, documents that are alike but mostly not
    enough, is gathered into clusters of buckets with common members and compared in tiles. No link
    between components is passed over. None if nothing is linked.
    """
    labels, links = None, None
    for _ in range(HUB_ROUNDS):
        rows = stored(_open_rows(members, labels), "open-buckets")
        pairs = rows.filter(
            (F.col("hub.component") != F.col("component"))
            & (100 * F.least("hub.n", "n") >= similar * F.greatest("hub.n", "n"))
        ).select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()
        with arrow_rows(members.sparkSession, PAIRS_AT_ONCE):
            found = stored(confirmed(pairs, sets, similar), "confirmed")
        labels, links = _merged(labels, links, found)
        members = rows.filter("id != hub.id").select("key", "id", "n")
    # With its hubs settled, a bucket is done if the other members are one component.
    rows = stored(_open_rows(members, labels), "open-buckets")
    if rows.isEmpty():
        return labels
    clusters = components(rows.filter("id != hub.id").select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct())
    found = stored(_tile_links(_in_clusters(rows, clusters), sets, similar), "confirmed")
    return _merged(labels, links, found)[0]


def _in_clusters(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """(id, n, own, cluster) for each document of an open bucket; ``own`` is its component so far."""
    own = rows.select("id", "n", F.col("component").alias("own")).distinct()
    return own.join(clusters.select("node", F.col("component").alias("cluster")), F.col("id") == F.col("node")).drop("node")


def _tile_links(placed: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Links (a, b) between components of a cluster.

    A cluster is cut into blocks of about ``BLOCK_BYTES`` and each pair of blocks is a tile, so the
    memory of a task is bounded however large the cluster. A tile counts common shingles from
    postings and gives at most one link per document beyond those that connect it already.
    """
    blocks = placed.groupBy(F.col("cluster").alias("of")).agg(
        F.ceil(F.sum(F.col("n")) * 8 / BLOCK_BYTES).cast("int").alias("blocks"))
    dealt = placed.join(blocks, placed.cluster == blocks["of"]).withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiled = dealt.withColumn("with", F.explode(other)).select(
        "id", "own", "cluster", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    full = tiled.join(sets.select(F.col("id").alias("set_of"), "items"), F.col("id") == F.col("set_of")).drop("set_of")

    def compare(table):
        owners, a, b = table["own"].to_pylist(), [], []
        ids, items = table["id"].to_pylist(), [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"]]
        sizes = np.array([len(x) for x in items])
        _, common = np.unique(np.concatenate(items), return_inverse=True)
        member = np.repeat(np.arange(len(items)), sizes)
        order = np.argsort(common, kind="stable")
        holders, begins = member[order], np.searchsorted(common[order], np.arange(common.max() + 2))
        ends = np.cumsum(sizes)
        group = {o: o for o in owners}

        def root(o):
            while group[o] != o:
                group[o] = o = group[group[o]]
            return o

        _, component, often = np.unique(owners, return_inverse=True, return_counts=True)
        # Every pair of components has a side outside the largest one.
        for k in np.flatnonzero(component != often.argmax()).tolist():
            own = common[ends[k] - sizes[k] : ends[k]]
            count = begins[own + 1] - begins[own]
            total = np.cumsum(count)
            at = np.repeat(begins[own] - total + count, count) + np.arange(total[-1])
            shared = np.bincount(holders[at], minlength=len(items))
            for m in np.flatnonzero(100 * shared >= similar * (sizes + sizes[k] - shared)).tolist():
                x, y = root(owners[k]), root(owners[m])
                if x != y:
                    group[max(x, y)] = min(x, y)
                    a.append(min(ids[k], ids[m]))
                    b.append(max(ids[k], ids[m]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return full.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two documents are linked if 100 * shared shingles >= ``similar`` * all their shingles, words
    being lower-cased (A-Z). ``component_id`` is the smallest doc_id reachable over links, and a
    document is kept if that is its own. Null or empty texts and texts without words have no
    shingles and are linked with nothing. Rows that repeat a doc_id are one node: they carry the
    links of all their texts. A row without doc_id is kept, its component is null. Other columns
    of ``docs`` are ignored. An empty table gives an empty result.
    """
    with arrow_rows(docs.sparkSession, DOCUMENTS_AT_ONCE):
        signed = stored(signatures(docs, shingle), "signatures")
    firsts = signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first"))
    named = signed.join(firsts, "digest", "left").select(
        "doc_id", "n", "bands", F.coalesce("first", "doc_id").alias("first"))
    banded = named.filter("doc_id = first AND n > 0").select("doc_id", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("key")
    members = stored(
        banded.join(shared, "key", "left_semi").select("key", F.col("doc_id").alias("id"), "n"), "members")
    with arrow_rows(docs.sparkSession, DOCUMENTS_AT_ONCE):
        sets = stored(shingle_sets(docs, members.select("id").distinct(), shingle), "sets")
    labels = linked_components(members, sets, similar)
    if labels is None:
        named = named.withColumn("component_id", F.col("first"))
    else:
        named = named.join(labels, named["first"] == labels.node, "left").withColumn(
            "component_id", F.coalesce("component", "first"))
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each group: that with the smallest doc_id.

    Rows that repeat an id with another text all stay; of equal ones (id and text) one does. Rows
    without doc_id all stay. All columns are kept.
    """
    dropped = near_duplicates(docs, **options).filter("NOT kept").select(F.col("doc_id").alias("id")).distinct()
    # The columns stay together in one, so none can clash with those added here.
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("own_id"),
        F.xxhash64(docs["text"]).alias("tie"))
    numbered = rows.filter("own_id IS NOT NULL")
    kept = numbered.join(dropped, numbered.own_id == dropped["id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("own_id", "tie").orderBy("own_id"))
    once = kept.withColumn("rank", rank).filter("rank = 1").select("row.*")
    return once.unionAll(rows.filter("own_id IS NULL").select("row.*"))
