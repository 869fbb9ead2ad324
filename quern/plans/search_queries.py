"""Full-text, vector and hybrid search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import vectors as vec_fn
from quern.operators import search
from quern.plans.inputs import corpus, flagged_frames, table, vectors, with_sql
from quern.plans.registry import query
from quern.session import fresh_path

TEXT_QUERY = "the of and data"
QUERY_ROW = 7
FRAME_QUERY = "night city street rider"

TERMS_SQL = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


def bm25_sql(source: str, id_col: str, text: str, words: str, k: int) -> str:
    wanted = ", ".join(f"'{w}'" for w in words.split())
    return f"""
tokens as (select {id_col} as id, {TERMS_SQL.format(text=text)} as t from {source}),
stats as (select count(*) as docs, avg(len(t)) as mean_length from tokens),
hits as (select id, len(t) as length, term, count(*) as tf
  from (select id, t, unnest(t) as term from tokens) where term in ({wanted}) group by id, t, term),
dfs as (select term, count(*) as df from hits group by term),
text_hits as (select id, sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2
    / (tf + 1.2 * (0.25 + 0.75 * length / mean_length))) as score
  from hits join dfs using (term), stats group by id order by score desc, id limit {k})"""


def cosine_sql(where: str = "true", k: int = 10, extra: str = "", source: str = "embeddings") -> str:
    return f"""
q as (select embedding as qv from embeddings where vec_id = {QUERY_ROW}),
vector_hits as (select vec_id as id, list_cosine_similarity(cast(embedding as double[]), cast(qv as double[])) as score
  from {source}, q where {where} order by score desc, vec_id limit {k}){extra}"""


def query_vector(spark, d):
    return search.vectors_of(vectors(spark, d), "vec_id", "embedding", [QUERY_ROW])[0][1]


def rounded(hits):
    # Adding zero turns a rounded -0.0 into 0.0.
    return hits.withColumn("score", F.round("score", 6) + 0.0)


@query(
    "build_fts",
    f"""with tokens as (select doc_id as id, {TERMS_SQL.format(text='text')} as t from documents)
      select term, count(distinct id) as docs, count(*) as occurrences from (select id, unnest(t) as term from tokens) group by term""",
)
def build_fts(spark, d):
    path = fresh_path(spark, "text-index")
    search.write_text_index(corpus(spark, d), "id", "text", path)
    stored = spark.read.parquet(f"{path}/postings")
    return stored.groupBy("term").agg(
        F.count("*").alias("docs"), F.sum("tf").alias("occurrences")
    )


@query(
    "fts_search",
    "with " + bm25_sql("documents", "doc_id", "text", TEXT_QUERY, 20)
    + " select id, round(score, 6) as score from text_hits",
)
def fts_search(spark, d):
    return rounded(search.text_search(corpus(spark, d), "id", "text", TEXT_QUERY, 20))


@query(
    "fts_search_indexed",
    "with " + bm25_sql("documents", "doc_id", "text", TEXT_QUERY, 20)
    + " select id, round(score, 6) as score from text_hits",
)
def fts_search_indexed(spark, d):
    path = fresh_path(spark, "text-index")
    search.write_text_index(corpus(spark, d), "id", "text", path)
    return rounded(search.indexed_text_search(spark, path, TEXT_QUERY, 20))


@query(
    "fts_search_frames",
    with_sql("frames", "flagged")
    + "," + bm25_sql("flagged", "frame_key", "scene_description", FRAME_QUERY, 20)
    + " select id as frame_key, scene_description, has_rider, round(score, 6) as score from text_hits join flagged on frame_key = id",
)
def fts_search_frames(spark, d):
    rows = flagged_frames(spark, d).select("frame_key", "scene_description", "has_rider")
    hits = search.text_search(rows, "frame_key", "scene_description", FRAME_QUERY, 20)
    shown = rows.join(F.broadcast(hits.withColumnRenamed("id", "frame_key")), "frame_key")
    return rounded(shown)


@query("vector_search", "with " + cosine_sql() + " select id, round(score, 6) as score from vector_hits")
def vector_search(spark, d):
    rows = vectors(spark, d)
    return rounded(search.vector_search(rows, "vec_id", "embedding", query_vector(spark, d), 10))


@query(
    "top_k_similar",
    f"""with q as (select embedding as qv from embeddings where vec_id = {QUERY_ROW})
      select vec_id as id, round(-(list_distance(cast(embedding as double[]), cast(qv as double[])) ** 2), 6) + 0.0 as score
      from embeddings, q order by list_distance(cast(embedding as double[]), cast(qv as double[])), vec_id limit 25""",
)
def top_k_similar(spark, d):
    rows = vectors(spark, d)
    vector = query_vector(spark, d)
    return rounded(search.vector_search(rows, "vec_id", "embedding", vector, 25, metric="l2"))


@query(
    "filtered_vector_search",
    "with " + cosine_sql("label = 3") + " select id, round(score, 6) as score from vector_hits",
)
def filtered_vector_search(spark, d):
    rows = vectors(spark, d)
    vector = query_vector(spark, d)
    return rounded(
        search.vector_search(rows, "vec_id", "embedding", vector, 10, prefilter="label = 3")
    )


@query(
    "prefilter_vs_postfilter",
    "with " + cosine_sql("label = 3", 20)
    + """, post as (select vec_id as id, list_cosine_similarity(cast(embedding as double[]), cast(qv as double[])) as score, label
        from embeddings, q order by score desc, vec_id limit 20)
      select 'prefilter' as mode, id from vector_hits union all select 'postfilter', id from post where label = 3""",
)
def prefilter_vs_postfilter(spark, d):
    rows = vectors(spark, d)
    vector = query_vector(spark, d)
    found = [
        search.vector_search(rows, "vec_id", "embedding", vector, 20, **{mode: "label = 3"}).select(
            F.lit(mode).alias("mode"), "id"
        )
        for mode in ("prefilter", "postfilter")
    ]
    return found[0].unionByName(found[1])


@query(
    "discovery_search",
    with_sql("frames", "flagged") + ","
    + cosine_sql("not has_rider", source="(embeddings join flagged on vec_id = frame_key)")
    + " select id, round(score, 6) as score from vector_hits",
)
def discovery_search(spark, d):
    flags = flagged_frames(spark, d).select(F.col("frame_key").alias("vec_id"), "has_rider")
    rows = vectors(spark, d).join(flags, "vec_id")
    vector = query_vector(spark, d)
    return rounded(
        search.vector_search(rows, "vec_id", "embedding", vector, 10, prefilter="has_rider = false")
    )


@query(
    "image_to_image",
    "with " + cosine_sql(f"vec_id <> {QUERY_ROW}", 12) + " select id, round(score, 6) as score from vector_hits",
)
def image_to_image(spark, d):
    return rounded(search.similar_to_row(vectors(spark, d), "vec_id", "embedding", QUERY_ROW, 12))


@query(
    "hybrid_search",
    "with " + bm25_sql("documents", "doc_id", "text", TEXT_QUERY, 100) + "," + cosine_sql(k=100)
    + """, t as (select id, row_number() over (order by score desc, id) as r from text_hits),
      v as (select id, row_number() over (order by score desc, id) as r from vector_hits),
      fused as (select id, coalesce(1.0::double/(60+t.r), 0) + coalesce(1.0::double/(60+v.r), 0) as score from t full join v using (id))
      select id, round(score, 9) as score from fused order by fused.score desc, id limit 15""",
)
def hybrid_search(spark, d):
    hits = search.hybrid_search(
        corpus(spark, d), vectors(spark, d).withColumnRenamed("vec_id", "id"), "id", "text",
        "embedding", TEXT_QUERY, query_vector(spark, d), 15,
    )
    return hits.withColumn("score", F.round("score", 9))


@query(
    "hybrid_fuse",
    """with a as (select o_orderkey as id, o_totalprice as score from orders order by score desc, id limit 200),
      b as (select o_custkey * 10 as id, max(o_totalprice) as score from orders group by 1 order by score desc, id limit 200),
      t as (select id, row_number() over (order by score desc, id) as r from a),
      v as (select id, row_number() over (order by score desc, id) as r from b),
      fused as (select id, coalesce(1.0::double/(60+t.r), 0) + coalesce(1.0::double/(60+v.r), 0) as score from t full join v using (id))
      select id, round(score, 9) as score from fused order by fused.score desc, id limit 100""",
)
def hybrid_fuse(spark, d):
    orders = table(spark, d, "orders")
    first = orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    second = orders.groupBy((F.col("o_custkey") * 10).alias("id")).agg(
        F.max("o_totalprice").alias("score")
    )
    fused = search.fuse(search.top(first, 200), search.top(second, 200), 100)
    return fused.withColumn("score", F.round("score", 9))


ATTRIBUTED = [3, 11, 42, 97]


@query(
    "attribution",
    f"""with q as (select vec_id as query_id, list_transform(embedding, lambda x, i: cast(x as double) + (i % 5) * 0.05) as qv
        from embeddings where vec_id in ({','.join(map(str, ATTRIBUTED))})),
      s as (select query_id, vec_id as id, list_cosine_similarity(cast(embedding as double[]), qv) as score from embeddings, q),
      r as (select *, row_number() over (partition by query_id order by score desc, id) as r, max(score) over (partition by query_id) as best from s)
      select query_id, id, round(score, 6) as score, case when best > 0.9 then 'close' else 'distant' end as verdict
      from r where r <= 3""",
)
def attribution(spark, d):
    rows = vectors(spark, d)
    stored = search.vectors_of(rows, "vec_id", "embedding", ATTRIBUTED)
    queries = [(i, [x + ((n + 1) % 5) * 0.05 for n, x in enumerate(v)]) for i, v in stored]
    return rounded(search.attribute(rows, "vec_id", "embedding", queries, 3))


# Asked about are the first documents of their text; compared with are all vectors.
NEIGHBORS = """with s as (select vec_id as query_id, embedding as qv from embeddings
  where vec_id in (select min(doc_id) from documents group by text)),
p as (select query_id, vec_id as id, list_cosine_similarity(cast(embedding as double[]), cast(qv as double[])) as score
  from embeddings join s on vec_id <> query_id),
nn as (select query_id, arg_max(id, (score, -id)) as id, max(score) as score from p group by query_id)
"""


def first_neighbors(spark, d):
    # Hashes are grouped, so no text is shuffled.
    hashed = table(spark, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("hash"))
    firsts = hashed.groupBy("hash").agg(F.min("doc_id").alias("vec_id"))
    marked = firsts.select("vec_id", F.lit(True).alias("first"))
    rows = vectors(spark, d).join(marked, "vec_id", "left")
    return search.near_neighbors(rows, "vec_id", "embedding", 0.4, asked="first")


@query(
    "cosine_nn_join",
    NEIGHBORS + "select query_id, id, round(score, 6) as score, score >= 0.4 as flagged from nn",
)
def cosine_nn_join(spark, d):
    return rounded(first_neighbors(spark, d))


@query(
    "neardup_rate",
    NEIGHBORS
    + """, f as (select * from nn where score >= 0.4)
      select (select count(*) from nn) as sampled, (select count(*) from f) as flagged,
        (select count(*) from f) / cast((select count(*) from nn) as double) as rate,
        query_id as closest_id, id as closest_to, round(score, 6) as closest_score from f order by round(f.score, 9) desc, query_id limit 1""",
)
def neardup_rate(spark, d):
    found = first_neighbors(spark, d)
    rate = search.near_duplicate_rate(found)
    return rate.withColumn("closest_score", F.round("closest_score", 6))


@query(
    "closest_pair",
    NEIGHBORS
    + "select query_id as id, id as near_id, round(score, 6) as score from nn order by round(nn.score, 9) desc, query_id limit 1",
)
def closest_pair(spark, d):
    found = first_neighbors(spark, d)
    best = F.min_by(F.struct("query_id", "id", "score"), F.struct(-F.round("score", 9), F.col("query_id")))
    row = found.agg(best.alias("b"))
    return row.select(
        F.col("b.query_id").alias("id"), F.col("b.id").alias("near_id"), F.round("b.score", 6).alias("score")
    )


@query(
    "vector_partition_index",
    "with " + cosine_sql() + " select id, round(score, 6) as score from vector_hits",
)
def vector_partition_index(spark, d):
    """Search through the partitioned index with every cell probed, which is exact."""
    path = fresh_path(spark, "vector-index")
    search.build_vector_index(vectors(spark, d), "vec_id", "embedding", path, cells=8)
    vector = query_vector(spark, d)
    return rounded(search.indexed_vector_search(spark, path, vector, 10, nprobe=8))


#: Of the cells an approximate search visits, and rows compared exactly per wanted one and block.
CELLS, PROBES, REFINE = 8, 6, 40


def probed_index(spark, d) -> str:
    path = fresh_path(spark, "vector-index")
    search.build_vector_index(vectors(spark, d), "vec_id", "embedding", path, cells=CELLS, subspaces=8, codes=32)
    return path


def every_twentieth(spark, d):
    return vectors(spark, d).where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@query("vector_partition_probe")
def vector_partition_probe(spark, d):
    """Approximate search: six cells of eight, product-quantizer codes, exact re-ranking."""
    path = probed_index(spark, d)
    return rounded(search.indexed_vector_search(spark, path, query_vector(spark, d), 10, nprobe=PROBES, refine=REFINE))


@query(
    "batched_vector_search",
    """with q as (select vec_id as query_id, embedding as qv from embeddings where vec_id % 20 = 0),
      p as (select query_id, vec_id as id, list_cosine_similarity(cast(embedding as double[]), cast(qv as double[])) as score from embeddings, q),
      r as (select *, row_number() over (partition by query_id order by score desc, id) as r from p where id <> query_id)
      select query_id, id from r where r <= 10""",
)
def batched_vector_search(spark, d):
    """All queries in one join with the index, every cell probed, which is exact."""
    path = probed_index(spark, d)
    found = search.indexed_search_many(spark, path, every_twentieth(spark, d), 10, nprobe=CELLS, exclude_self=True)
    return found.select("query_id", "id")


@query("batched_vector_recall")
def batched_vector_recall(spark, d):
    """Recall at 10 of the approximate batched search against the exact one, over every twentieth row."""
    path, queries = probed_index(spark, d), every_twentieth(spark, d)
    exact = search.indexed_search_many(spark, path, queries, 10, nprobe=CELLS, exclude_self=True)
    found = search.indexed_search_many(spark, path, queries, 10, nprobe=PROBES, refine=REFINE, exclude_self=True)
    return search.index_recall(found, exact)


@query(
    "cosine_similarity",
    """select a.vec_id, round(list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])), 6) as similarity,
      case when list_cosine_similarity(cast(a.embedding as double[]), cast(b.embedding as double[])) > 0.9 then 'close' else 'distant' end as verdict
      from embeddings a join embeddings b on b.vec_id = (a.vec_id * 7 + 1) % (select count(*) from embeddings)""",
)
def cosine_similarity(spark, d):
    rows = vectors(spark, d)
    total = rows.agg(F.count("*").alias("n"))
    left = rows.join(F.broadcast(total)).select(
        "vec_id", F.col("embedding").alias("v"), F.pmod(F.col("vec_id") * 7 + 1, F.col("n")).alias("o")
    )
    right = rows.select(F.col("vec_id").alias("o"), F.col("embedding").alias("w"))
    similarity = vec_fn.cosine_similarity(F.col("v"), F.col("w"))
    return left.join(right, "o").select(
        "vec_id",
        F.round(similarity, 6).alias("similarity"),
        vec_fn.similarity_verdict(similarity).alias("verdict"),
    )


@query(
    "l2_normalize",
    """select doc_id, round(list_sum(list_transform(v, lambda x: (x/n)*(x/n))), 4) as length_squared, round(v[1]/n, 4) as first
      from (select doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x*x))) as n
        from (select doc_id, list_transform(range(8), lambda i: cast((n_chars * (i+3)) % 101 + 1 as double)) as v from documents))""",
)
def l2_normalize(spark, d):
    place = F.array(*[F.lit(i) for i in range(8)])
    raw = F.transform(
        place, lambda i: (F.pmod(F.col("n_chars") * (i + 3), F.lit(101)) + 1).cast("double")
    )
    unit = table(spark, d, "documents").select("doc_id", vec_fn.l2_normalize(raw).alias("u"))
    return unit.select(
        "doc_id",
        F.round(vec_fn.dot(F.col("u"), F.col("u")), 4).alias("length_squared"),
        F.round(F.get("u", 0).cast("double"), 4).alias("first"),
    )


@query(
    "exclude_self",
    """with s as (select vec_id as query_id, embedding as qv from embeddings),
      p as (select query_id, vec_id as id, list_cosine_similarity(cast(embedding as double[]), cast(qv as double[])) as score from embeddings, s),
      r as (select *, row_number() over (partition by query_id order by score desc, id) as r from p where id <> query_id)
      select query_id, id from r where r <= 2""",
)
def exclude_self(spark, d):
    return search.neighbors_of(vectors(spark, d), "vec_id", "embedding", 2).select("query_id", "id")
