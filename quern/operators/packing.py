"""Packing documents into fixed-length blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import packed_ids, unpacked_ids
from quern.operators.ordering import (
    BUCKET_DIGITS,
    before,
    bucket_sums,
    epoch_plan,
    seeded_positions,
)
from quern.schema import BLOCK_LEN, EOS_ID, PAD_ID

# Largest (splits x buckets) table that is sent to every executor: 3 columns of
# 8 bytes per row, so about 24 MB.
BROADCAST_ROWS = 1_000_000

TOKENS_PER_TASK = 32_000_000


def document_offsets(
    lengths: DataFrame, num_splits: int, seed: int, epoch: int = 0, world_size: int = 1
) -> DataFrame:
    """(id, split_id, rank, start, length): where each document begins in its split.

    Reads only (id, n_tokens). A split is summed in two levels, over the order's
    hash buckets and inside each bucket, so no task holds a whole split. Both
    levels reuse the partitioning by bucket that ``epoch_plan`` leaves.
    """
    closed = lengths.select("id", (F.col("n_tokens") + 1).cast("bigint").alias("length"))
    plan = epoch_plan(closed, "id", num_splits, seed, epoch, world_size, keep_bucket=True)
    sums = plan.groupBy("split_id", "_bucket").agg(F.sum("length").alias("_sum"))
    by_bucket = Window.partitionBy("split_id").orderBy("_bucket")  # <= 16**BUCKET_DIGITS rows
    bases = sums.select("split_id", "_bucket", before(F.col("_sum"), by_bucket).alias("_base"))
    if num_splits * 16**BUCKET_DIGITS <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    inside = Window.partitionBy("_bucket", "split_id").orderBy("position")
    local = plan.withColumn("_local", before(F.col("length"), inside))
    return local.join(bases, ["split_id", "_bucket"]).select(
        "id", "split_id", "rank", (F.col("_base") + F.col("_local")).alias("start"), "length"
    )


def pack_sequences(
    lengths: DataFrame,
    docs: DataFrame,
    num_splits: int,
    seed: int,
    epoch: int = 0,
    block_len: int = BLOCK_LEN,
    blocks_per_epoch: int | None = None,
    eos_id: int = EOS_ID,
    pad_id: int = PAD_ID,
    world_size: int = 1,
    tokens: Column | None = None,
    in_order: bool = False,
) -> DataFrame:
    """Blocks of exactly ``block_len`` tokens from the documents listed in ``lengths``.

    ``lengths`` has (id, n_tokens) of the rows to pack and is read several times to
    lay them out; ``docs`` has id and the column behind ``tokens`` (``input_ids`` by
    default) and is read once. ``tokens`` is computed after the join, so text
    travels as text and not as four-byte ids.

    Documents of a split follow each other in the seeded order, each closed by
    ``eos_id``. With ``blocks_per_epoch`` every split yields the same number of
    blocks: surplus is cut, and a split that runs dry is padded. Without it all
    tokens are kept and only the last block of a split is padded.

    With ``in_order``, which needs ``blocks_per_epoch``, blocks are to be stored: pieces travel
    packed, each task holds consecutive blocks, and rows are in the order of (rank, split_id,
    block_no) over the tasks and inside each, so no further shuffle or wide sort is due.

    Returns (split_id, rank, block_no, input_ids, doc_ids, doc_lengths).
    """
    offsets = document_offsets(lengths, num_splits, seed, epoch, world_size)
    per_split = None
    if blocks_per_epoch is not None:
        per_split = blocks_per_epoch // num_splits
        offsets = offsets.where(F.col("start") < per_split * block_len)
    tokens = F.col("input_ids") if tokens is None else tokens
    closed = F.concat(tokens, F.array(F.lit(eos_id)))
    if in_order and blocks_per_epoch is None:
        raise ValueError("blocks are dealt in order by their number per epoch")
    # The layout rows are narrow but each brings its tokens, so tasks are sized by tokens.
    volume = lengths.agg(F.sum(F.col("n_tokens").cast("bigint"))).first()[0] or 0
    tasks = -(-volume // TOKENS_PER_TASK)
    at_least = lengths.sparkSession.sparkContext.defaultParallelism
    spread = offsets.repartition(max(tasks, at_least), "id")
    placed = spread.join(docs, "id").select(*offsets.columns, closed.alias("ids"))

    first = F.expr(f"start div {block_len}")
    last = F.expr(f"(start + length - 1) div {block_len}")

    def piece(block):
        start = F.greatest(block * block_len, F.col("start"))
        end = F.least((block + 1) * block_len, F.col("start") + F.col("length"))
        skip = (start - F.col("start") + 1).cast("int")
        return F.struct(
            block.alias("block_no"),
            start.alias("at"),
            F.slice("ids", skip, (end - start).cast("int")).alias("piece"),
        )

    pieces = placed.select(
        "split_id", "rank", "id", F.inline(F.transform(F.sequence(first, last), piece))
    )
    if per_split is not None:
        pieces = pieces.where(F.col("block_no") < per_split)
    piece = packed_ids("piece").alias("piece") if in_order else F.col("piece")
    part = F.struct("at", "id", piece, F.size("piece").alias("n"))
    block = ["split_id", "rank", "block_no"]
    pieces = pieces.select(*block, part.alias("part"))
    if per_split is not None:  # dry blocks have no parts
        dry = _dry_blocks(offsets, num_splits, per_split, block_len, world_size)
        pieces = pieces.unionByName(dry, allowMissingColumns=True)
    group = block
    if in_order:
        # The bounds are known; tasks have half the tokens, since they write them unpacked.
        spread_to = max(2 * tasks, at_least)
        place = f"(split_id * {per_split}L + block_no)"
        task = F.expr(f"cast({place} * {spread_to}L div {max(num_splits * per_split, 1)} as int)")
        pieces = pieces.withColumn("_task", task).repartitionById(spread_to, "_task")
        group = ["_task", *block]
    # A block gathers at most block_len pieces.
    blocks = pieces.groupBy(*group).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    found = F.transform("parts", lambda p: p["piece"])
    if in_order:
        blocks = blocks.sortWithinPartitions("rank", "split_id", "block_no")
    packed = blocks.select(
        *block,
        (unpacked_ids(found) if in_order else F.flatten(found)).alias("ids"),
        F.transform("parts", lambda p: p["id"]).alias("doc_ids"),
        F.transform("parts", lambda p: p["n"]).alias("doc_lengths"),
    )
    fill = F.array_repeat(F.lit(pad_id), F.lit(block_len) - F.size("ids"))
    packed = packed.withColumn("input_ids", F.concat("ids", fill)).drop("ids")
    columns = ["split_id", "rank", "block_no", "input_ids", "doc_ids", "doc_lengths"]
    return packed.select(*columns)


def _dry_blocks(offsets, num_splits, per_split, block_len, world_size):
    """The blocks of each split from its end to its last block."""
    ends = offsets.groupBy("split_id").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    splits = offsets.sparkSession.range(num_splits).select(F.col("id").cast("int").alias("split_id"))
    filled = splits.join(ends, "split_id", "left").withColumn(
        "used", F.ceil(F.coalesce(F.col("end"), F.lit(0)) / block_len).cast("bigint")
    )
    short = filled.where(F.col("used") < per_split)
    return short.select(
        "split_id",
        F.floor(F.col("split_id") / (num_splits // world_size)).cast("int").alias("rank"),
        F.explode(F.sequence(F.col("used"), F.lit(per_split - 1).cast("bigint"))).alias("block_no"),
    )


def reshape_blocks(df: DataFrame, flat: str, block_len: int) -> DataFrame:
    """Cut flat arrays, whose lengths are multiples of ``block_len``, into rows."""
    count = F.expr(f"size({flat}) div {block_len}")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    rows = F.transform(starts, lambda i: F.slice(flat, i * block_len + 1, block_len))
    others = [c for c in df.columns if c != flat]
    return df.select(*others, F.posexplode(rows).alias("block_no", "input_ids"))


def size_sums(df: DataFrame, id_col: str, size: str, seed: int) -> DataFrame:
    """What ``sized_shards`` takes from all rows before it places any."""
    return bucket_sums(df, seed, id_col, totals={"_bytes": F.col(size).cast("bigint")})


def sized_shards(
    df: DataFrame,
    id_col: str,
    size: str,
    limit: int,
    seed: int,
    in_order: bool = False,
    sums: DataFrame | None = None,
    turn: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Shard by running bytes in the seeded order: a shard takes the rows that begin
    inside its ``limit`` bytes. ``sums`` and ``turn`` as in ``seeded_positions``."""
    size_col = F.col(size).cast("bigint")
    placed = seeded_positions(
        df, seed, id_col, totals={"_bytes": size_col}, in_order=in_order, sums=sums, turn=turn
    )
    begin = F.col("_bytes") - size_col
    return placed.withColumn("shard", F.floor(begin / limit).cast("bigint")).drop("_bytes")


def shard_index(sharded: DataFrame, size: str) -> DataFrame:
    """Rows and bytes per shard."""
    return sharded.groupBy(F.col("shard").cast("bigint").alias("shard")).agg(
        F.count("*").alias("rows"), F.sum(F.col(size).cast("bigint")).alias("bytes")
    )
