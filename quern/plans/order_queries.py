"""Queries about orders, splits, packing, block layouts and positioned reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.text import byte_tokens, real_tokens
from quern.operators import filters, ordering, packing
from quern.operators.counts import token_budget
from quern.plans.inputs import corpus, counted_corpus, flagged_frames, table, tokenized_corpus, with_sql
from quern.plans.registry import query
from quern.plans.text_queries import CLEAN_SQL, CORPUS, COUNTED, MIN_SCORE, ids_sql, joined_ids
from quern.schema import BLOCK_LEN, PAD_ID
from quern.session import checkpointed, fresh_path
from quern.sources import blocks as block_io
from quern.sources import text as text_io

SEED, SPLITS, EPOCH = 1234, 8, 1

ORDERED = CORPUS + f""", ordered as (select id, n_chars,
  row_number() over (order by md5(concat({SEED}, ':', id)), id) - 1 as position from corpus)
"""

PLAN = COUNTED + f""", clean as (select * from counted where {CLEAN_SQL}),
plan as (select id, n_tokens, position, cast(position % {SPLITS} as int) as split_id, position // {SPLITS} as seq,
    cast((position % {SPLITS}) // {SPLITS // 2} as int) as rank
  from (select id, n_tokens, row_number() over (order by md5(concat({SEED}, ':', {EPOCH}, ':', id)), id) - 1 as position from clean))
"""

# Tokens as three hex digits each, so that a block is a substring.
PACKED = PLAN + f""", texts as (select p.split_id, p.rank, p.seq, p.id, concat('100',
    regexp_replace(hex(encode(c.text)), '(..)', '0\\1', 'g'), '101', '101') as t from plan p join clean c using (id)),
streams as (select split_id, rank, string_agg(t, '' order by seq) as s from texts group by split_id, rank),
budget as (select cast((sum(n_tokens) + count(*)) // {BLOCK_LEN} as bigint) // {SPLITS} as per_split from clean)
"""


def clean_counts(spark, d):
    """(id, n_tokens) of the train rows, fixed so that laying out blocks is cheap."""
    kept = counted_corpus(spark, d).where(filters.train_filter(MIN_SCORE))
    return checkpointed(kept.select("id", "n_tokens"))


def packed(spark, d, full: bool = False, world_size: int = 2, in_order: bool = False):
    """Blocks of the train rows; without ``full``, an equal number per split."""
    lengths = clean_counts(spark, d)
    budget = None if full else token_budget(lengths, SPLITS).first()["blocks"]
    docs = corpus(spark, d).select("id", "text")
    return packing.pack_sequences(
        lengths, docs, SPLITS, SEED, EPOCH, blocks_per_epoch=budget, world_size=world_size,
        tokens=byte_tokens("text"), in_order=in_order,
    )


# --- orders ------------------------------------------------------------------


@query("seeded_order", ORDERED + "select id, position from ordered")
def seeded_order(spark, d):
    return ordering.seeded_positions(corpus(spark, d).select("id"), SEED, "id")


@query(
    "random_split",
    ORDERED
    + "select id, position, case when position < round((select count(*) from ordered)*0.8) then 0 else 1 end as split_id from ordered",
)
def random_split(spark, d):
    return ordering.random_split(corpus(spark, d), "id", 0.8, SEED)


@query(
    "random_split_of_spec",
    with_sql("frames", "flagged")
    + """, o as (select image_id, row_number() over (order by md5(concat(42, ':', image_id)), image_id) - 1 as position
        from flagged where timeofday='night' and has_rider)
      select split_id, count(*) as n from (select case when position < round((select count(*) from o)*0.8) then 0 else 1 end as split_id from o) group by split_id""",
)
def random_split_of_spec(spark, d):
    rows = flagged_frames(spark, d).where(filters.spec_filter("nighttime_rider"))
    split = ordering.random_split(rows.select("image_id"), "image_id", 0.8, 42)
    return split.groupBy("split_id").agg(F.count("*").alias("n"))


@query(
    "permutation_join",
    ORDERED
    + """select c.id, c.source, c.n_chars, o.position from ordered o join corpus c using (id)
      where o.position >= round((select count(*) from ordered)*0.8)""",
)
def permutation_join(spark, d):
    rows = corpus(spark, d)
    permutation = ordering.random_split(rows, "id", 0.8, SEED)
    val = ordering.through_permutation(rows.select("id", "source", "n_chars"), permutation, "id", 1)
    return val.orderBy("position")


@query("epoch_plan", PLAN + "select id, n_tokens, position, split_id, seq, rank from plan")
def epoch_plan(spark, d):
    return ordering.epoch_plan(clean_counts(spark, d), "id", SPLITS, SEED, EPOCH, world_size=2)


def saved_states(plan):
    """Positions of two readers: the first half and a third of their splits, one stale."""
    sizes = plan.groupBy("split_id").agg(F.count("*").alias("n"))

    def state(divisor):
        return sizes.select(
            F.lit(EPOCH).alias("epoch"),
            "split_id",
            F.floor(F.col("n") / divisor).cast("bigint").alias("next_seq"),
        )

    return state(2).where("split_id < 4"), state(3)


STATES = PLAN + """, sizes as (select split_id, count(*) as n from plan group by split_id),
merged as (select split_id, max(next_seq) as next_seq from (
  select split_id, n // 2 as next_seq from sizes where split_id < 4
  union all select split_id, n // 3 from sizes) group by split_id)
"""


@query(
    "resume_offsets",
    STATES + "select p.id, p.split_id, p.seq from plan p join merged m using (split_id) where p.seq >= m.next_seq",
)
def resume_offsets(spark, d):
    plan = ordering.epoch_plan(clean_counts(spark, d), "id", SPLITS, SEED, EPOCH)
    offsets = ordering.merge_offsets(*saved_states(plan))
    return ordering.remaining(plan, offsets, EPOCH).select("id", "split_id", "seq")


@query(
    "progress_counters",
    STATES
    + """select rank, cast(sum(m.next_seq) as bigint) as consumed_rows, cast(sum(s.n - m.next_seq) as bigint) as unread_rows
      from (select distinct rank, split_id from plan) p join sizes s using (split_id) join merged m using (split_id) group by rank""",
)
def progress_counters(spark, d):
    plan = ordering.epoch_plan(clean_counts(spark, d), "id", SPLITS, SEED, EPOCH, world_size=2)
    return ordering.progress(plan, ordering.merge_offsets(*saved_states(plan)), EPOCH)


@query(
    "topology_check",
    PLAN
    + """select rank, count(distinct split_id) as splits, count(*) as rows from plan group by rank""",
)
def topology_check(spark, d):
    ordering.check_topology(SPLITS, world_size=2, workers=2, global_batch=16)
    plan = ordering.epoch_plan(clean_counts(spark, d), "id", SPLITS, SEED, EPOCH, world_size=2)
    # Two steps: the rows of a split combine before splits are counted.
    per_split = plan.groupBy("rank", "split_id").agg(F.count("*").alias("n"))
    return per_split.groupBy("rank").agg(F.count("*").alias("splits"), F.sum("n").alias("rows"))


@query(
    "rank_stride",
    ORDERED + "select id, position, cast(position % 4 as int) as rank, cast((position // 4) % 2 as int) as worker from ordered",
)
def rank_stride(spark, d):
    rows = ordering.seeded_positions(corpus(spark, d).select("id"), SEED, "id")
    return ordering.rank_stride(rows, 4, 2)


@query(
    "local_shuffle",
    CORPUS
    + """select id, id // 100 as buffer, (id // 100) * 100 + row_number() over (partition by id // 100
        order by md5(concat(7, ':', id)), id) - 1 as shuffled from corpus""",
)
def local_shuffle(spark, d):
    rows = corpus(spark, d).select("id", F.col("id").alias("position"))
    return ordering.local_shuffle(rows, "id", seed=7, buffer=100).drop("position")


@query(
    "batch_ids",
    ORDERED + """select batch_id, count(*) as n from (select position // 48 as batch_id from ordered)
      where batch_id < (select count(*) // 48 from ordered) group by batch_id""",
)
def batch_ids(spark, d):
    rows = ordering.seeded_positions(corpus(spark, d).select("id"), SEED, "id")
    return ordering.batch_ids(rows, 48, drop_last=True).groupBy("batch_id").agg(
        F.count("*").alias("n")
    )


@query(
    "shuffled_shards",
    ORDERED
    + """, n as (select count(*) as n from ordered)
      select id, position, cast(case when position < (n%7)*(n//7+1) then position // (n//7+1)
        else n%7 + (position - (n%7)*(n//7+1)) // (n//7) end as int) as shard from ordered, n""",
)
def shuffled_shards(spark, d):
    rows = ordering.seeded_positions(corpus(spark, d).select("id"), SEED, "id")
    return ordering.equal_shards(rows, 7)


@query(
    "running_byte_shards",
    ORDERED
    + """select shard, count(*) as rows, cast(sum(n_chars) as bigint) as bytes from (
      select n_chars, cast((sum(n_chars) over (order by position) - n_chars) // 65536 as bigint) as shard from ordered) group by shard""",
)
def running_byte_shards(spark, d):
    rows = corpus(spark, d).select("id", "n_chars")
    return packing.shard_index(packing.sized_shards(rows, "id", "n_chars", 65_536, SEED), "n_chars")


# --- packing -----------------------------------------------------------------


@query(
    "pack_sequences",
    PACKED
    + f""", blocks as (select split_id, rank, s, unnest(range((select per_split from budget))) as block_no from streams)
      select split_id, rank, block_no, md5({ids_sql('t', str(BLOCK_LEN))}) as block_md5, {BLOCK_LEN} as length
      from (select *, rpad(substr(s, cast(block_no*{3 * BLOCK_LEN} as bigint) + 1, {3 * BLOCK_LEN}), {3 * BLOCK_LEN}, '102') as t from blocks)""",
)
def pack_sequences(spark, d):
    return packed(spark, d).select(
        "split_id",
        "rank",
        "block_no",
        F.md5(joined_ids("input_ids")).alias("block_md5"),
        F.size("input_ids").alias("length"),
    )


@query(
    "document_offsets",
    PLAN
    + """select id, split_id, rank, cast(sum(n_tokens+1) over (partition by split_id order by seq) - n_tokens - 1 as bigint) as start,
      cast(n_tokens + 1 as bigint) as length from plan""",
)
def document_offsets(spark, d):
    return packing.document_offsets(clean_counts(spark, d), SPLITS, SEED, EPOCH, world_size=2)


@query(
    "real_token_count",
    PLAN
    + """select split_id, rank, cast(sum(n_tokens + 1) as bigint) as real_tokens from plan group by split_id, rank""",
)
def real_token_count(spark, d):
    blocks = packed(spark, d, full=True)
    return blocks.groupBy("split_id", "rank").agg(
        F.sum(real_tokens(F.col("input_ids"), PAD_ID)).cast("bigint").alias("real_tokens")
    )


@query(
    "block_documents",
    PLAN
    + f""", placed as (select id, split_id, sum(n_tokens+1) over (partition by split_id order by seq) - n_tokens - 1 as s, n_tokens + 1 as len from plan),
      pieces as (select id, split_id, s, len, unnest(range(cast(s // {BLOCK_LEN} as bigint), cast((s+len-1) // {BLOCK_LEN} as bigint) + 1)) as block_no from placed)
      select split_id, block_no, id, cast(least((block_no+1)*{BLOCK_LEN}, s+len) - greatest(block_no*{BLOCK_LEN}, s) as int) as tokens from pieces""",
)
def block_documents(spark, d):
    blocks = packed(spark, d, full=True)
    pairs = F.arrays_zip(F.col("doc_ids").alias("id"), F.col("doc_lengths").alias("tokens"))
    return blocks.select("split_id", "block_no", F.inline(pairs))


@query(
    "reshape_blocks",
    """with t as materialized (select doc_id as id, cast(octet_length(encode(text)) + 2 as int) as n,
        concat('100', regexp_replace(hex(encode(text)), '(..)', '0\\1', 'g'), '101') as h from documents)
      select id, cast(b as int) as block_no, md5(%s) as block_md5
      from (select id, b, rpad(substr(h, cast(b*192 as bigint) + 1, 192), 192, '102') as t
        from (select id, h, unnest(range((n + 63) // 64)) as b from t))"""
    % ids_sql("t", "64"),
)
def reshape_blocks(spark, d):
    ids = F.col("input_ids")
    fill = F.pmod(-F.size(ids), F.lit(64))
    flat = F.concat(ids, F.array_repeat(F.lit(PAD_ID), fill))
    rows = tokenized_corpus(spark, d).select("id", flat.alias("flat"))
    cut = packing.reshape_blocks(rows, "flat", 64)
    return cut.select("id", "block_no", F.md5(joined_ids("input_ids")).alias("block_md5"))


# --- layouts -----------------------------------------------------------------

LAYOUT_ROWS = PACKED + f""", blocks as (select split_id, rank, s, unnest(range((select per_split from budget))) as block_no from streams),
laid as (select md5({ids_sql('t', str(BLOCK_LEN))}) as block_md5, rank
  from (select rank, rpad(substr(s, cast(block_no*{3 * BLOCK_LEN} as bigint) + 1, {3 * BLOCK_LEN}), {3 * BLOCK_LEN}, '102') as t from blocks))
"""


def block_hashes(rows, *others):
    return rows.select(F.md5(joined_ids("input_ids")).alias("block_md5"), *others)


def stored_blocks(spark, d):
    """Path of the packed blocks, written once as rank shards; other layouts read it."""
    path = fresh_path(spark, "blocks")
    block_io.write_rank_shards(packed(spark, d, in_order=True), path, in_order=True)
    return path


@query("write_blocks_parquet", LAYOUT_ROWS + "select block_md5, rank from laid")
def write_blocks_parquet(spark, d):
    return block_hashes(block_io.read_shards(spark, stored_blocks(spark, d)), "rank")


@query("write_shuffled_shards", LAYOUT_ROWS + "select block_md5 from laid")
def write_shuffled_shards(spark, d):
    blocks = block_io.read_shards(spark, stored_blocks(spark, d))
    path = fresh_path(spark, "blocks-shuffled")
    block_io.write_shuffled_shards(blocks, path, shards=8, seed=SEED)
    return block_hashes(block_io.read_shards(spark, path))


@query(
    "write_sized_shards",
    LAYOUT_ROWS
    + f"""select shard, count(*) as rows, cast(count(*)*{4 * BLOCK_LEN} as bigint) as bytes
      from (select (row_number() over () - 1) // 16 as shard from laid) group by shard""",
)
def write_sized_shards(spark, d):
    blocks = block_io.read_shards(spark, stored_blocks(spark, d))
    path = fresh_path(spark, "blocks-sized")
    return block_io.write_sized_shards(blocks, path, limit=16 * 4 * BLOCK_LEN, seed=SEED)


@query("append_block_shards", LAYOUT_ROWS + "select rank, count(*) as n from laid group by rank")
def append_block_shards(spark, d):
    path = stored_blocks(spark, d)
    found = None
    for rank in range(2):
        part = block_io.read_shards(spark, f"{path}/rank={rank}").withColumn("rank", F.lit(rank))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("rank").agg(F.count("*").alias("n"))


# --- positioned reads --------------------------------------------------------


@query(
    "sequential_id",
    "select doc_id, doc_id as id from documents",
)
def sequential_id(spark, d):
    rows = text_io.with_global_index(table(spark, d, "documents"), "id")
    return rows.select("doc_id", "id")


@query(
    "scan_parquet_shards",
    """select doc_id as id, md5(text) as text_md5, 'shards' as source, cast(0 as float) as score,
      cast(length(text) as int) as n_chars from documents""",
)
def scan_parquet_shards(spark, d):
    rows = text_io.scan_parquet_shards(spark, [f"{d}/documents.parquet"], "shards")
    return rows.withColumn("text_md5", F.md5("text")).drop("text")


@query("scan_projected", "select doc_id, source from documents")
def scan_projected(spark, d):
    return table(spark, d, "documents").select("doc_id", "source")


@query(
    "take_by_position",
    """select event_id as request_order, (event_id*7919) % (select count(*) from orders) as position,
      o_orderkey, o_custkey from events join orders on o_orderkey = (event_id*7919) % (select count(*) from orders)""",
)
def take_by_position(spark, d):
    rows = table(spark, d, "orders")
    total = rows.agg(F.count("*").alias("n"))
    requests = (
        table(spark, d, "events")
        .join(F.broadcast(total))
        .select(
            F.col("event_id").alias("request_order"),
            F.pmod(F.col("event_id") * 7919, F.col("n")).alias("position"),
        )
    )
    return text_io.take_rows(rows.select("o_orderkey", "o_custkey"), requests)


@query(
    "footer_layout",
    """select distinct (event_id*7919) % (select count(*) from orders) as position, 'orders.parquet' as file,
      (event_id*7919) % (select count(*) from orders) as "offset" from events""",
)
def footer_layout(spark, d):
    rows = table(spark, d, "orders")
    layout = text_io.file_layout(rows)
    total = rows.agg(F.count("*").alias("n"))
    wanted = (
        table(spark, d, "events")
        .join(F.broadcast(total))
        .select(F.pmod(F.col("event_id") * 7919, F.col("n")).alias("position"))
        .distinct()
    )
    found = text_io.locate(layout, wanted)
    return found.withColumn("file", F.substring_index("file", "/", -1))


@query(
    "sorted_files_first_n",
    "select doc_id, source from documents where doc_id % 7 < 3",
)
def sorted_files_first_n(spark, d):
    """Rows of the first three of seven files, in the order of their paths."""
    root = fresh_path(spark, "shards")
    rows = table(spark, d, "documents").select("doc_id", "source")
    dealt = rows.withColumn("shard", F.pmod(F.col("doc_id"), F.lit(7)))
    dealt.repartition(7, "shard").write.partitionBy("shard").parquet(root)
    return spark.read.parquet(*text_io.list_files(spark, root, "*.parquet", first=3)).select("doc_id", "source")


@query("limit_n", "select doc_id, source from documents order by doc_id limit 50")
def limit_n(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").orderBy("doc_id").limit(50)


@query(
    "scan_limit",
    "select event_id, user_id, value from events order by event_id limit 1000",
)
def scan_limit(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "value").orderBy("event_id").limit(1000)
