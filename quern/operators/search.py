"""Full-text, vector and hybrid search."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import terms
from quern.functions.vectors import l2_normalize, similarity_verdict
from quern.operators.neighbors import id_kind, neighbors
from quern.schema import COSINE_THRESHOLD, VERBATIM_SIMILARITY
from quern.session import checkpointed, fresh_path

# BM25 and rank fusion constants.
BM25_K1, BM25_B = 1.2, 0.75
FUSION_K = 60

TERM_BUCKETS = 64
# Documents of which one task holds the postings of a term bucket, on average.
DOCUMENTS_PER_PART = 200_000

# Query vectors compared in one pass over the table.
QUERIES_PER_PASS = 2048
# Rows of one cell that a task of a batched index search holds.
PROBED_ROWS = 32_768


# --- full text ---------------------------------------------------------------


def term_bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def postings(df: DataFrame, id_col: str, text: str, parts: int = 1) -> DataFrame:
    """(term, id, length, tf, bucket): one row per distinct term of a document.

    A document's terms are counted in its own row, as runs of its sorted terms, so nothing is
    grouped before the one shuffle. That goes by term bucket and by one of ``parts`` of the ids,
    which spread a frequent term over several tasks. Documents that share id and length count as one.
    """
    sorted_ = F.sort_array(terms(F.col(text)))
    tokens = df.select(F.col(id_col).alias("id"), sorted_.alias("tokens")).where(F.size("tokens") > 0)
    length = F.size("tokens")
    begins = F.filter(
        F.sequence(F.lit(0), length - 1),
        lambda i: (i == 0) | (F.get("tokens", i) != F.get("tokens", i - 1)),
    )
    runs = F.transform(
        F.col("begins"),
        lambda b, n: F.struct(
            F.get("tokens", b).alias("term"),
            (F.coalesce(F.get("begins", n + 1), length) - b).cast("bigint").alias("tf"),
        ),
    )
    counted = tokens.withColumn("begins", begins).select("id", length.alias("length"), F.explode(runs).alias("run"))
    rows = counted.select("run.term", "id", "length", "run.tf", term_bucket(F.col("run.term")).alias("bucket"))
    spread = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).repartition("bucket", "part")
    again = df.groupBy(F.col(id_col)).count().where("count > 1")
    if not again.isEmpty():
        # All rows of a term and id are in one task by now.
        spread = spread.groupBy("bucket", "part", "term", "id", "length").agg(F.sum("tf").alias("tf"))
    return spread.select("term", "id", "length", "tf", "bucket")


def write_text_index(df: DataFrame, id_col: str, text: str, path: str) -> None:
    """Write (or replace) the postings, partitioned by term bucket, and the statistics."""
    docs = df.agg(F.count(text).alias("docs")).first()["docs"]
    rows = postings(df, id_col, text, 1 + docs // DOCUMENTS_PER_PART)
    # Sorted terms let Parquet statistics skip row groups inside a bucket.
    rows.sortWithinPartitions("bucket", "term", "id").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    # The sum of the term counts is the sum of the lengths, so the text is not split twice.
    stored = df.sparkSession.read.parquet(f"{path}/postings")
    words = stored.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    mean = F.coalesce(F.try_divide(F.col("words"), F.col("docs")), F.lit(0.0))
    stats = words.withColumn("docs", F.lit(docs).cast("bigint")).select("docs", mean.alias("mean_length"))  # one row
    stats.write.mode("overwrite").parquet(f"{path}/stats")


def query_terms(spark: SparkSession, query: str) -> list[str]:
    """Distinct terms of a query, split exactly as documents are."""
    row = spark.range(1).select(F.array_distinct(terms(F.lit(query))).alias("t")).first()
    return row["t"]


def bm25(matches: DataFrame, stats: DataFrame) -> DataFrame:
    """(id, score) from the postings of the query's terms."""
    per_term = matches.groupBy("term").agg(F.count("*").alias("df"))  # one row per query term
    joined = matches.join(F.broadcast(per_term), "term").join(F.broadcast(stats))
    idf = F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    scale = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.col("mean_length"))
    weight = F.col("tf") * (BM25_K1 + 1) / (F.col("tf") + scale)
    return joined.groupBy("id").agg(F.sum(idf * weight).alias("score"))


def top(scored: DataFrame, k: int) -> DataFrame:
    """Best ``k`` by score, the lowest id first on a tie."""
    return scored.orderBy(F.col("score").desc(), F.col("id").asc()).limit(k)


def text_search(
    df: DataFrame, id_col: str, text: str, query: str, k: int = 20, columns: tuple[str, ...] = ()
) -> DataFrame:
    """BM25 top-k over a table without an index; a document matches on any term.

    The text is scanned once, without a shuffle: each document yields its length and
    its count of every query term. Documents without a term only add to the count and
    length sums, which are taken in the same pass; the others are written to the shared
    folder, narrow, and the scores come from them. ``columns`` of the hits are added.
    """
    wanted = query_terms(df.sparkSession, query)
    tokens = df.where(F.col(text).isNotNull()).select(
        F.col(id_col).alias("id"), terms(F.col(text)).alias("tokens")
    )
    asked = F.array(*[F.lit(t) for t in wanted]).cast("array<string>")
    tf = F.transform(asked, lambda w: F.size(F.filter("tokens", lambda t: t == w)))
    counted = tokens.select("id", F.size("tokens").alias("length"), tf.alias("tf"))
    seen = Observation()
    watched = counted.observe(seen, F.count("*").alias("docs"), F.sum("length").alias("words"))
    path = fresh_path(df.sparkSession, "hits")
    watched.where(F.exists("tf", lambda n: n > 0)).write.parquet(path)
    docs = seen.get["docs"]
    mean = (seen.get["words"] or 0) / docs if docs else 0.0
    hits = df.sparkSession.read.schema(counted.schema).parquet(path)
    at = range(len(wanted))
    # One row: in how many documents each of the query's terms is.
    found = hits.agg(*[F.count_if(F.get("tf", i) > 0) for i in at]).first() if wanted else []
    scale = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.lit(mean))
    score = F.lit(0.0)
    for i in at:
        idf = math.log1p((docs - found[i] + 0.5) / (found[i] + 0.5))
        score = score + idf * F.get("tf", i) * (BM25_K1 + 1) / (F.get("tf", i) + scale)
    best = top(hits.select("id", score.alias("score")), k)
    return with_columns_of(df, id_col, best, columns)


def indexed_text_search(spark: SparkSession, path: str, query: str, k: int = 20) -> DataFrame:
    """BM25 top-k that reads only the buckets of the query's terms."""
    wanted = query_terms(spark, query)
    hashed = spark.createDataFrame([(t,) for t in wanted], "term string")
    buckets = [r["b"] for r in hashed.select(term_bucket(F.col("term")).alias("b")).collect()]
    rows = spark.read.parquet(f"{path}/postings")
    matches = rows.where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))
    return top(bm25(matches, spark.read.parquet(f"{path}/stats")), k)


# --- vectors -----------------------------------------------------------------


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise top k by (score descending, id ascending)."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _candidates(scores: np.ndarray, ids: np.ndarray, k: int):
    """Per query the top k of a batch, ties at the cut included, then cut by id."""
    if scores.shape[1] > k:
        order = np.argsort(ids, kind="stable")
        scores, ids = scores[:, order], ids[order]
        # A stable sort by falling score over ascending ids settles ties by id.
        if k == 1:
            chosen = scores.argmax(axis=1)[:, None]
        else:
            chosen = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(scores, chosen, 1), ids[chosen]
    return scores, np.broadcast_to(ids, scores.shape)


def nearest(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    queries: list[tuple[int, list[float]]],
    k: int,
    metric: str = "cosine",
    exclude_self: bool = False,
) -> DataFrame:
    """(query_id, id, score): exact top-k rows per query vector.

    Ids are whole numbers (as bigint) or else compared as text. A vector of another
    width than the queries is an error; rows without a vector are left out; one of length zero
    has the similarity 0 with any. The score is the cosine similarity, or minus the squared distance for
    ``metric="l2"``. One scan per QUERIES_PER_PASS queries: every task multiplies
    its Arrow batches with the query matrix and keeps k rows per query, so the
    shuffle carries tasks x queries x k rows whatever the table's size.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    spark = df.sparkSession
    width = len(queries[0][1]) if queries else 0
    if any(len(v) != width for _, v in queries):
        raise ValueError("query vectors differ in width")
    id_type = id_kind(df, id_col)
    kind = np.int64 if id_type == "bigint" else np.str_
    wrong = F.raise_error(F.concat(F.lit(f"a vector has not {width} numbers, but "), F.size(vec_col)))
    checked = F.when(F.size(vec_col) == width, F.col(vec_col)).otherwise(wrong)
    rows = df.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast(id_type).alias("id"), checked.alias("v")
    )
    schema = f"query_id {id_type}, id {id_type}, score double"
    passes = [
        queries[i : i + QUERIES_PER_PASS] for i in range(0, len(queries), QUERIES_PER_PASS)
    ]
    if not passes:
        return spark.createDataFrame([], schema)

    def scan_for(part):
        shared = spark.sparkContext.broadcast(
            (
                np.array([q for q, _ in part], kind),
                np.array([v for _, v in part], np.float64),
            )
        )

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, wanted = shared.value
            if metric == "cosine":
                lengths = np.linalg.norm(wanted, axis=1, keepdims=True)
                wanted = wanted / np.where(lengths == 0, 1, lengths)
            best_scores = np.empty((len(query_ids), 0))
            best_ids = np.empty((len(query_ids), 0), kind)
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids = np.array(batch.column(0).to_pylist(), kind)
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                vectors = flat.astype(np.float64).reshape(len(ids), width)
                if metric == "cosine":
                    norms = np.linalg.norm(vectors, axis=1)
                    scores = wanted @ vectors.T / np.where(norms == 0, np.inf, norms)
                else:
                    squares = (vectors * vectors).sum(axis=1)
                    own = (wanted * wanted).sum(axis=1)
                    scores = 2 * (wanted @ vectors.T) - squares - own[:, None]
                # Equal vectors may differ in the last bits of a product; ties go by id.
                scores = np.round(scores, 12)
                if exclude_self:
                    scores[query_ids[:, None] == ids[None, :]] = -np.inf
                new_scores, new_ids = _candidates(scores, ids, k)
                best_scores, best_ids = _best(
                    np.hstack([best_scores, new_scores]), np.hstack([best_ids, new_ids]), k
                )
            if best_ids.size:
                flat_scores = best_scores.ravel()
                keep = np.isfinite(flat_scores)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, best_ids.shape[1])[keep]),
                        pa.array(best_ids.ravel()[keep]),
                        pa.array(flat_scores[keep]),
                    ],
                    names=["query_id", "id", "score"],
                )

        return scan

    found = None
    for part in passes:
        one = rows.mapInArrow(scan_for(part), schema)
        found = one if found is None else found.unionByName(one)
    if len(queries) == 1:
        return found.orderBy(F.col("score").desc(), "id").limit(k)
    by_rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(by_rank))
    return ranked.where(F.col("rank") <= k).drop("rank")


def with_columns_of(df: DataFrame, id_col: str, hits: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """A cut list of hits with chosen columns of their rows."""
    if not columns:
        return hits
    rows = df.select(F.col(id_col).cast(id_kind(df, id_col)).alias("id"), *columns)
    return rows.join(F.broadcast(hits), "id").select(*hits.columns, *columns)


def vectors_of(df: DataFrame, id_col: str, vec_col: str, ids: list[int]):
    """Stored vectors of a few rows, as queries."""
    found = df.where(F.col(id_col).isin(ids)).select(id_col, vec_col).collect()
    return [(r[0], list(r[1])) for r in sorted(found)]


def vector_search(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    vector: list[float],
    k: int,
    metric: str = "cosine",
    prefilter: str | Column | None = None,
    postfilter: str | Column | None = None,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """(id, score, columns) of the top k. A prefilter limits what is ranked; a postfilter
    drops ranked rows, so fewer than k may remain."""
    rows = df if prefilter is None else df.where(prefilter)
    found = nearest(rows, id_col, vec_col, [(0, vector)], k, metric).select("id", "score")
    if postfilter is None:
        return with_columns_of(df, id_col, found, columns)
    # The right side is scanned for at most k ids.
    return with_columns_of(df.where(postfilter), id_col, found, columns or (vec_col,)).select(
        "id", "score", *columns
    )


def similar_to_row(df: DataFrame, id_col: str, vec_col: str, row_id: int, k: int) -> DataFrame:
    """Top k rows similar to a stored row, itself excluded."""
    queries = vectors_of(df, id_col, vec_col, [row_id])
    return nearest(df, id_col, vec_col, queries, k, exclude_self=True).select("id", "score")


def attribute(
    df: DataFrame, id_col: str, vec_col: str, queries: list[tuple[int, list[float]]], k: int = 3
) -> DataFrame:
    """Nearest rows per query with the verdict on the query's best similarity."""
    hits = nearest(df, id_col, vec_col, queries, k)
    per_query = Window.partitionBy("query_id")  # k rows
    best = F.max("score").over(per_query)
    return hits.withColumn("verdict", similarity_verdict(best, VERBATIM_SIMILARITY))


def neighbors_of(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    k: int,
    asked: str | Column | None = None,
    within: float | None = None,
) -> DataFrame:
    """(query_id, id, score): the ``k`` nearest other rows of every row that is ``asked`` about.

    Exact; see ``neighbors`` for how cells are ruled out and what odd vectors give.
    """
    return neighbors(df, id_col, vec_col, k, asked, within)


def near_neighbors(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    threshold: float = COSINE_THRESHOLD,
    asked: str | Column | None = None,
) -> DataFrame:
    """(query_id, id, score, flagged): nearest other row of each row asked about."""
    found = neighbors_of(df, id_col, vec_col, 1, asked)
    return found.withColumn("flagged", F.col("score") >= threshold)


def near_duplicate_rate(neighbors: DataFrame) -> DataFrame:
    """Sampled and flagged rows, their share, and the closest flagged pair."""
    # A pair is found from both sides with scores that may differ in the last bits.
    rounded = F.round(F.col("score"), 9)
    order = F.struct((-rounded).alias("s"), F.col("query_id").alias("q"), F.col("id").alias("i"))
    closest = F.min(F.when(F.col("flagged"), order))
    row = neighbors.agg(
        F.count("*").alias("sampled"),
        F.count_if("flagged").alias("flagged"),
        closest.alias("_closest"),
    )
    return row.select(
        "sampled",
        "flagged",
        F.coalesce(F.try_divide(F.col("flagged"), F.col("sampled")), F.lit(0.0)).alias("rate"),
        F.col("_closest.q").alias("closest_id"),
        F.col("_closest.i").alias("closest_to"),
        (-F.col("_closest.s")).alias("closest_score"),
    )


# --- fusion ------------------------------------------------------------------


def _ranks(scored: DataFrame, name: str) -> DataFrame:
    order = Window.orderBy(F.col("score").desc(), "id")  # a list already cut to its top
    return scored.select("id", F.row_number().over(order).alias(name))


def fuse(text_hits: DataFrame, vector_hits: DataFrame, k: int) -> DataFrame:
    """Reciprocal-rank fusion of two cut (id, score) lists."""
    lists = _ranks(text_hits, "text_rank").join(_ranks(vector_hits, "vector_rank"), "id", "full")
    parts = [
        F.coalesce(1.0 / (F.lit(FUSION_K) + F.col(r)), F.lit(0.0))
        for r in ("text_rank", "vector_rank")
    ]
    return top(lists.select("id", (parts[0] + parts[1]).alias("score")), k)


def hybrid_search(
    texts: DataFrame,
    vectors: DataFrame,
    id_col: str,
    text: str,
    vec_col: str,
    query: str,
    vector: list[float],
    k: int,
    depth: int = 100,
    columns: tuple[str, ...] = (),
) -> DataFrame:
    """BM25 and cosine lists of ``depth`` rows each, fused to the top k, with ``columns`` of the texts."""
    text_hits = text_search(texts, id_col, text, query, depth)
    vector_hits = vector_search(vectors, id_col, vec_col, vector, depth)
    return with_columns_of(texts, id_col, fuse(text_hits, vector_hits, k), columns)


# --- partitioned vector index ------------------------------------------------

def _fit_centroids(vectors: DataFrame, column: str, cells: int, seed: int) -> np.ndarray:
    """K-means centers of all rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = vectors.select(array_to_vector(F.col(column)).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10, initSteps=1).fit(checkpointed(features))
    return np.array(model.clusterCenters())


def _with_cells(df: DataFrame, column: str, centers: np.ndarray, books: list[np.ndarray]) -> DataFrame:
    """Add ``cell``, the nearest center, and with ``books`` the ``code`` of the nearest center per slice.

    All are found in one step, batch by batch: a step for each slice would run as many Python workers in a task.
    """
    at = df.columns.index(column)

    def nearest_of(x: np.ndarray, those: np.ndarray) -> np.ndarray:
        return ((those * those).sum(axis=1) - 2 * x @ those.T).argmin(axis=1).astype(np.int32)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = flat.reshape(batch.num_rows, centers.shape[1])
            batch = batch.append_column("cell", pa.array(nearest_of(x, centers)))
            if books:
                pieces = np.split(x, len(books), axis=1)
                codes = np.stack([nearest_of(piece, book) for piece, book in zip(pieces, books)], axis=1)
                ends = pa.array(np.arange(0, codes.size + 1, len(books), dtype=np.int32))
                batch = batch.append_column("code", pa.ListArray.from_arrays(ends, pa.array(codes.ravel())))
            yield batch

    added = [T.StructField("cell", T.IntegerType())]
    if books:
        added.append(T.StructField("code", T.ArrayType(T.IntegerType())))
    return df.mapInArrow(assign, T.StructType([*df.schema, *added]))


def build_vector_index(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    path: str,
    cells: int,
    metric: str = "cosine",
    subspaces: int = 0,
    codes: int = 256,
    seed: int = 0,
    carry: tuple[str, ...] = (),
) -> None:
    """Write vectors partitioned by their nearest k-means center.

    Cosine centers are fitted on unit vectors. With ``subspaces`` each vector also
    gets one product-quantizer code per slice of its dimensions. ``carry`` keeps
    columns for filtered search.
    """
    spark = df.sparkSession
    base = df.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast(id_kind(df, id_col)).alias("id"),
        F.col(vec_col).alias("vector"),
        *carry,
    )
    key = l2_normalize(F.col("vector")) if metric == "cosine" else F.col("vector")
    rows = base.withColumn("_key", key)
    cells = max(1, min(cells, rows.count()))
    centers = _fit_centroids(rows, "_key", cells, seed)
    books = []
    if subspaces:
        if centers.shape[1] % subspaces:
            raise ValueError(f"{centers.shape[1]} dimensions do not divide into {subspaces} subspaces")
        width = centers.shape[1] // subspaces
        count = rows.count()
        for s in range(subspaces):
            pieces = rows.withColumn("_piece", F.slice("_key", s * width + 1, width))
            books.append(_fit_centroids(pieces, "_piece", min(codes, count), seed + s))
        book_rows = [
            (s, c, [float(x) for x in center])
            for s, book in enumerate(books)
            for c, center in enumerate(book)
        ]
        spark.createDataFrame(
            book_rows, "subspace int, code int, center array<double>"
        ).write.mode("overwrite").parquet(f"{path}/codebook")
    placed = _with_cells(rows, "_key", centers, books)
    # Ranges split a hot cell over several tasks.
    spread = placed.drop("_key").repartitionByRange("cell", "id")
    spread.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    center_rows = [(i, [float(x) for x in c]) for i, c in enumerate(centers)]
    spark.createDataFrame(center_rows, "cell int, center array<double>").write.mode(
        "overwrite"
    ).parquet(f"{path}/centers")


def _probed_cells(spark, path: str, vector: list[float], nprobe: int, metric: str) -> list[int]:
    centers = spark.read.parquet(f"{path}/centers").collect()  # one row per cell
    wanted = np.array(vector, np.float64)
    if metric == "cosine":
        wanted = wanted / np.linalg.norm(wanted)
    gaps = [(float(((np.array(r["center"]) - wanted) ** 2).sum()), r["cell"]) for r in centers]
    return [cell for _, cell in sorted(gaps)[:nprobe]]


def indexed_vector_search(
    spark: SparkSession,
    path: str,
    vector: list[float],
    k: int,
    nprobe: int = 20,
    metric: str = "cosine",
    prefilter: str | Column | None = None,
    refine: int = 0,
) -> DataFrame:
    """(id, score) from the ``nprobe`` nearest cells; only their files are read.

    Approximate: rows in other cells are not seen. With ``refine`` the codes pick
    ``refine * k`` rows first and only those are compared exactly.
    """
    cells = _probed_cells(spark, path, vector, nprobe, metric)
    rows = spark.read.parquet(f"{path}/vectors").where(F.col("cell").isin(cells))
    if prefilter is not None:
        rows = rows.where(prefilter)
    if refine:
        rough = _code_distance(spark, path, vector, metric)
        rows = rows.withColumn("_rough", rough).orderBy("_rough", "id").limit(refine * k)
    return nearest(rows, "id", "vector", [(0, vector)], k, metric).select("id", "score")


def _code_distance(spark, path: str, vector: list[float], metric: str) -> Column:
    """Squared distance from the query to a row's codes, by table lookup."""
    wanted = np.array(vector, np.float64)
    if metric == "cosine":
        wanted = wanted / np.linalg.norm(wanted)
    book = spark.read.parquet(f"{path}/codebook").collect()  # subspaces x codes rows
    width = len(book[0]["center"])
    tables: dict[int, dict[int, float]] = {}
    for r in book:
        part = wanted[r["subspace"] * width : (r["subspace"] + 1) * width]
        gap = float(((np.array(r["center"]) - part) ** 2).sum())
        tables.setdefault(r["subspace"], {})[r["code"]] = gap
    total = F.lit(0.0)
    for s, gaps in sorted(tables.items()):
        lookup = F.array(*[F.lit(gaps[c]) for c in sorted(gaps)])
        total = total + F.get(lookup, F.get("code", s))
    return total


def indexed_search_many(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    nprobe: int = 20,
    metric: str = "cosine",
    refine: int = 0,
    exclude_self: bool = False,
) -> DataFrame:
    """(query_id, id, score): the top ``k`` of many queries through the partitioned index.

    ``queries`` has (query_id, vector) and may be as large as the table. Each query goes to its
    ``nprobe`` nearest cells; a cell of more than PROBED_ROWS rows is cut into blocks by id, and its
    queries into parts, so a task holds one block and one part. With ``refine`` a block's codes
    first pick ``refine * k`` rows by the query's table of distances to the codebook, and only
    those are compared exactly. Approximate unless all cells are probed without ``refine``; see
    ``index_recall``. A query of length zero has the cosine 0 with any row.
    """
    centers = spark.read.parquet(f"{path}/centers").orderBy("cell").collect()  # one row per cell
    cell_of, middle = [r["cell"] for r in centers], np.array([r["center"] for r in centers], np.float64)
    book = None
    if refine:
        rows = spark.read.parquet(f"{path}/codebook").orderBy("subspace", "code").collect()  # subspaces x codes
        book = [np.array([r["center"] for r in rows if r["subspace"] == s]) for s in sorted({r["subspace"] for r in rows})]
    stored = spark.read.parquet(f"{path}/vectors")
    id_type, query_type = dict(stored.dtypes)["id"], id_kind(queries, "query_id")
    arrow = {"bigint": pa.int64(), "string": pa.string()}

    def unit(x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return x / np.where(length == 0, 1, length)

    def matrix(column) -> np.ndarray:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["vector"])
                x = unit(x) if metric == "cosine" else x
                gaps = (middle * middle).sum(axis=1) - 2 * x @ middle.T
                near = np.argsort(gaps, axis=1, kind="stable")[:, :nprobe]
                cells = [[cell_of[c] for c in row] for row in near.tolist()]
                yield batch.append_column("cells", pa.array(cells, pa.list_(pa.int32())))

    asked = queries.select(F.col("query_id").cast(query_type).alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    probed = asked.mapInArrow(probe, f"query_id {query_type}, vector array<double>, cells array<int>")
    probed = checkpointed(probed.select("query_id", F.col("vector").alias("wanted"), F.explode("cells").alias("to_cell")))
    blocks = stored.groupBy("cell").agg(F.expr(f"cast((count(1) - 1) div {PROBED_ROWS} + 1 as int)").alias("blocks"))
    parts = probed.groupBy("to_cell").agg(F.expr(f"cast((count(1) - 1) div {QUERIES_PER_PASS} + 1 as int)").alias("parts"))
    split = checkpointed(blocks.join(parts, blocks["cell"] == parts["to_cell"]).drop("to_cell"))  # a row per cell
    rows = stored.join(split, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), "id", "vector", *(["code"] if refine else []))
    to = probed.join(split.withColumnRenamed("cell", "to_cell"), "to_cell").select(
        "to_cell", F.explode(F.expr("sequence(0, blocks - 1)")).alias("to_block"),
        F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("to_part"), "query_id", "wanted")

    def scan(own: pa.Table, those: pa.Table) -> pa.Table:
        out = [[], [], []]
        if own.num_rows and those.num_rows:
            ids = np.array(own["id"].to_pylist(), np.int64 if id_type == "bigint" else np.object_)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], matrix(own["vector"])[order]
            names, wanted = those["query_id"].to_pylist(), matrix(those["wanted"])
            if metric == "cosine":
                x, wanted = unit(x), unit(wanted)
            codes = np.array(own["code"].to_pylist())[order] if refine else None
            for name, q in zip(names, wanted):
                at = np.arange(len(ids))
                if refine and len(ids) > refine * k:
                    width = len(q) // len(book)
                    rough = sum(((book[s] - q[s * width : (s + 1) * width]) ** 2).sum(axis=1)[codes[:, s]] for s in range(len(book)))
                    at = np.sort(np.argpartition(rough, refine * k)[: refine * k])
                score = x[at] @ q if metric == "cosine" else -((x[at] - q) ** 2).sum(axis=1)
                score = np.round(score, 12)
                if exclude_self:
                    at, score = at[ids[at] != name], score[ids[at] != name]
                best = np.argsort(-score, kind="stable")[:k]
                out[0] += [name] * len(best)
                out[1] += ids[at[best]].tolist()
                out[2] += score[best].tolist()
        return pa.table({"query_id": pa.array(out[0], arrow[query_type]), "id": pa.array(out[1], arrow[id_type]),
                         "score": pa.array(out[2], pa.float64())})

    found = rows.groupBy("cell", "block", "part").cogroup(to.groupBy("to_cell", "to_block", "to_part")).applyInArrow(
        scan, f"query_id {query_type}, id {id_type}, score double")
    by_rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).drop("rank")


def index_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (queries, wanted, found, recall): how much of the exact lists an approximate search gives."""
    hits = exact.select("query_id", "id").join(
        found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return hits.agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("wanted"), F.count("hit").alias("found")).withColumn(
        "recall", F.coalesce(F.try_divide(F.col("found"), F.col("wanted")), F.lit(1.0)))
