"""Queries over the text corpus: statistics, duplicates, tokens, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text as text_fn
from quern.operators import counts, dedup, filters
from quern.plans.inputs import corpus, counted_corpus, table, tokenized_corpus, with_sql
from quern.plans.registry import query
from quern.schema import BLOCK_LEN, EOS_ID, PAD_ID
from quern.session import fresh_path
from quern.sources.text import as_corpus
from quern.streaming.cycle import file_stream
from quern.streaming.first_seen import flag_arrivals

CORPUS = with_sql("corpus")
COUNTED = with_sql("corpus", "counted")
MIN_SCORE = 1.0
CLEAN_SQL = "not is_dup and score >= 1.0 and id % 100 <> 0"


def clean_rows(spark, d):
    return counted_corpus(spark, d).where(filters.train_filter(MIN_SCORE))


def joined_ids(column):
    return F.array_join(F.col(column) if isinstance(column, str) else column, ",")


def ids_sql(hexes: str, length: str) -> str:
    """The tokens, three hex digits each in ``hexes``, as decimal text."""
    return (
        f"array_to_string(list_transform(range({length}), "
        f"lambda i: cast(concat('0x', substr({hexes}, 3*i+1, 3)) as int)), ',')"
    )


@query(
    "scan_text",
    """select doc_id as id, md5(text) as text_md5, source, cast(0 as float) as score,
      cast(length(text) as int) as n_chars from documents""",
)
def scan_text(spark, d):
    rows = as_corpus(table(spark, d, "documents"), "doc_id")
    return rows.withColumn("text_md5", F.md5("text")).drop("text")


@query(
    "score_histogram",
    CORPUS
    + """select cast(b as int) as band, count(c.id) as n, round(count(c.id)/cast((select count(*) from corpus) as double), 6) as share
      from range(5) t(b) left join corpus c on c.score >= b and c.score < b+1 group by b""",
)
def score_histogram(spark, d):
    rows = counts.score_histogram(corpus(spark, d))
    return rows.withColumn("share", F.round("share", 6))


@query("range_predicate", CORPUS + "select count(*) as n from corpus where n_chars < 200")
def range_predicate(spark, d):
    return filters.count_where(corpus(spark, d), "n_chars < 200")


@query(
    "first_occurrence",
    COUNTED + "select id, is_dup from counted",
)
def first_occurrence(spark, d):
    return dedup.repeat_flags(corpus(spark, d))


@query(
    "first_occurrence_stream",
    COUNTED + "select id, min(id) over (partition by h) as first_id, is_dup from counted join hashed using (id)",
)
def first_occurrence_stream(spark, d):
    """Repeats flagged while the corpus arrives in four deliveries, one micro-batch each."""
    rows, root = corpus(spark, d).select("id", "text"), fresh_path(spark, "arrivals")
    most = rows.agg(F.max("id").alias("n")).first()["n"] or 0
    for quarter in range(4):  # ids rise from delivery to delivery, each of as many files as its tasks write
        inside = F.expr(f"id * 4 div {most + 1}") == quarter
        rows.where(inside).write.mode("append").parquet(f"{root}/in")
        stream = file_stream(spark, f"{root}/in", rows.schema)
        flag_arrivals(stream, "id", "text", f"{root}/flags", f"{root}/state").awaitTermination()
    return spark.read.parquet(f"{root}/flags")


@query("repeat_ids", COUNTED + "select id from counted where is_dup")
def repeat_ids(spark, d):
    return dedup.repeat_ids(corpus(spark, d))


@query("membership_flag", COUNTED + "select id, source, is_dup from counted")
def membership_flag(spark, d):
    rows = corpus(spark, d)
    flagged = dedup.membership_flag(rows.select("id", "source"), dedup.repeat_ids(rows), "id", "is_dup")
    return flagged.select("id", "source", "is_dup")


@query(
    "content_hash",
    COUNTED + "select id, h as content_hash from hashed",
)
def content_hash(spark, d):
    return corpus(spark, d).select("id", text_fn.content_hash(F.col("text")).alias("content_hash"))


@query(
    "train_filter",
    COUNTED + f"select id, score, n_tokens from counted where {CLEAN_SQL}",
)
def train_filter(spark, d):
    return clean_rows(spark, d).select("id", "score", "n_tokens")


@query(
    "holdout_split",
    CORPUS + "select id, case when id % 100 = 0 then 'val' else 'train' end as side from corpus",
)
def holdout_split(spark, d):
    side = F.when(filters.is_holdout(), "val").otherwise("train")
    return corpus(spark, d).select("id", side.alias("side"))


@query(
    "token_budget",
    COUNTED
    + f"""select docs, total_tokens, blocks - blocks % 8 as blocks from (
      select count(*) as docs, cast(sum(n_tokens) + count(*) as bigint) as total_tokens,
        cast((sum(n_tokens) + count(*)) // {BLOCK_LEN} as bigint) as blocks from counted where {CLEAN_SQL})""",
)
def token_budget(spark, d):
    return counts.token_budget(clean_rows(spark, d), num_splits=8)


@query(
    "step_budget",
    COUNTED
    + f"""select docs, total_tokens, greatest(total_tokens // {BLOCK_LEN} // 16 // 2, 1) as packed_steps,
      greatest(docs // 8 // 2, 1) as unpacked_steps from (
      select count(*) as docs, cast(sum(n_tokens) + count(*) as bigint) as total_tokens from counted where {CLEAN_SQL})""",
)
def step_budget(spark, d):
    return counts.step_budget(clean_rows(spark, d), num_splits=8, global_batch=16, grad_accum=2)


@query(
    "total_tokens", COUNTED + "select cast(sum(n_tokens) as bigint) as total_tokens from counted"
)
def total_tokens(spark, d):
    return counted_corpus(spark, d).agg(F.sum("n_tokens").alias("total_tokens"))


@query(
    "n_tokens",
    "select doc_id as id, cast(octet_length(encode(text)) + 2 as int) as n_tokens from documents",
)
def n_tokens(spark, d):
    return corpus(spark, d).select("id", text_fn.byte_token_count(F.col("text")).alias("n_tokens"))


HEXED = """with t as materialized (select doc_id as id, cast(octet_length(encode(text)) + 2 as int) as n,
  concat('100', regexp_replace(hex(encode(text)), '(..)', '0\\1', 'g'), '101') as h from documents)
"""


@query(
    "byte_tokenize",
    """select doc_id as id, md5(array_to_string(list_concat([256],
      list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: cast(concat('0x', x) as int)), [257]), ',')) as tokens_md5
      from documents""",
)
def byte_tokenize(spark, d):
    return tokenized_corpus(spark, d).select("id", F.md5(joined_ids("input_ids")).alias("tokens_md5"))


ROW_LEN = 256


@query(
    "pad_truncate_mask",
    HEXED
    + f"""select id, md5({ids_sql(f"concat(h, repeat('102', {ROW_LEN}))", str(ROW_LEN))}) as row_md5,
      cast(least(n, {ROW_LEN}) as int) as real_tokens, {ROW_LEN} as mask_length from t""",
)
def pad_truncate_mask(spark, d):
    rows = tokenized_corpus(spark, d).select(
        "id",
        text_fn.padded(F.col("input_ids"), ROW_LEN, PAD_ID).alias("row"),
        text_fn.loss_mask(F.size("input_ids"), ROW_LEN).alias("mask"),
    )
    return rows.select(
        "id",
        F.md5(joined_ids("row")).alias("row_md5"),
        F.size(F.filter("mask", lambda m: m)).alias("real_tokens"),
        F.size("mask").alias("mask_length"),
    )


@query(
    "pad_id_rule",
    "select cast(count(*) as bigint) as docs, cast(0 as bigint) as pad_in_text from documents",
)
def pad_id_rule(spark, d):
    pad = text_fn.pad_id_of(EOS_ID + 1)
    rows = tokenized_corpus(spark, d)
    return rows.agg(
        F.count("*").alias("docs"),
        F.count_if(F.array_contains("input_ids", pad)).alias("pad_in_text"),
    )


@query(
    "ingest_receipt",
    "select n, substr(md5(cast(n as varchar)), 1, 8) as checksum from (select count(*) as n from documents)",
)
def ingest_receipt(spark, d):
    return counts.ingest_receipt(corpus(spark, d))


@query(
    "white_balance",
    """with p as (select doc_id, hex(encode(text)) as h, greatest(cast(ceil(octet_length(encode(text))/48.0) as int), 1)*16 as pixels from documents),
      l as (select doc_id, pixels, regexp_extract_all(h, '..') as l from p),
      b as (select doc_id, pixels, unnest(range(len(l))) as i, cast(concat('0x', unnest(l)) as int) as x from l),
      s as (select doc_id, pixels, sum(case when i%3=0 then x else 0 end) as r,
        sum(case when i%3=2 then x else 0 end) as b from b group by doc_id, pixels)
      select concat('doc-', doc_id) as image_id,
        cast(round(least(greatest(6500.0/((r/cast(pixels as double))/(b/cast(pixels as double)+1e-6)+1e-6), 2500.0), 10000.0), 0) as bigint) as kelvin from s""",
)
def white_balance(spark, d):
    from quern.functions.images import white_balance as estimate
    from quern.plans.inputs import images

    rows = images(spark, d).select("image_id", estimate("image_bytes").alias("k"))
    return rows.select("image_id", F.round(F.col("k").cast("double")).cast("bigint").alias("kelvin"))


@query("dhash64")
def dhash64(spark, d):
    from quern.functions.images import dhash
    from quern.functions.vectors import pack_bits
    from quern.plans.inputs import images

    rows = images(spark, d).select("image_id", dhash("image_bytes").alias("dhash"))
    return rows.select("image_id", pack_bits(F.col("dhash")).alias("bits"))
