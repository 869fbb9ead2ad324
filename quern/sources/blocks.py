"""Layouts of packed blocks: per-reader shards, shuffled shards, sized shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.text import packed_ids, unpacked_ids
from quern.operators.ordering import equal_shards, seeded_positions
from quern.operators.packing import shard_index, size_sums, sized_shards
from quern.schema import ROWS_PER_GROUP
from quern.session import checkpointed, wide_rows

BYTES_PER_TOKEN = 4

# Sized shards are small files, which take far more disk than their tokens; only a part of the
# blocks is shuffled at a time beside them.
TURNS = 4


def write_ordered(df: DataFrame, path: str, shard: str, mode: str = "overwrite") -> None:
    """Uncompressed Parquet, one folder per shard, rows in order over a folder's files.

    Rows are in order over the tasks and inside each; file names follow the order. Tasks move
    their own files into place: the driver would move those of many shards one after another.
    What was shuffled for the files goes when they are written.
    """
    with wide_rows(df.sparkSession):
        (
            df.write.mode(mode)
            .option("compression", "none")
            .option("parquet.block.row.count.limit", str(ROWS_PER_GROUP))
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .partitionBy(shard)
            .parquet(path)
        )


def with_packed(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("input_ids", packed_ids("input_ids"))


def in_shard_order(packed: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Rows sorted inside the tasks while their ids are packed, which they are no more."""
    rows = packed.sortWithinPartitions(shard, *order)
    return rows.withColumn("input_ids", unpacked_ids(F.array("input_ids")))


def write_rank_shards(blocks: DataFrame, path: str, in_order: bool = False) -> None:
    """One shard per rank that packed the blocks.

    Range partitions let several tasks write a large shard. Blocks that are ``in_order`` of rank,
    split and number already, over the tasks and inside each, are not shuffled.
    """
    order = ["split_id", "block_no"]
    if not in_order:
        spread = with_packed(blocks).repartitionByRange("rank", *order)
        blocks = in_shard_order(spread, "rank", order)
    write_ordered(blocks, path, "rank")


def block_ids(blocks: DataFrame) -> DataFrame:
    """Add ``block_id``, unique and stable over (split, block)."""
    return blocks.withColumn(
        "block_id", F.format_string("%08d-%012d", F.col("split_id"), F.col("block_no"))
    )


def write_shuffled_shards(blocks: DataFrame, path: str, shards: int, seed: int) -> None:
    """A seeded global shuffle, cut into near-equal shards."""
    placed = seeded_positions(with_packed(block_ids(blocks)), seed, "block_id", in_order=True)
    write_ordered(in_shard_order(equal_shards(placed, shards), "shard", ["position"]), path, "shard")


def write_sized_shards(blocks: DataFrame, path: str, limit: int, seed: int) -> DataFrame:
    """Shards of at most about ``limit`` bytes; returns the index (shard, rows, bytes).

    The blocks are read once a turn, so they should be stored. The index comes from the narrow
    rows of the same plan, so the many files of small shards are not listed and opened again.
    """
    sized = block_ids(blocks).withColumn("bytes", F.size("input_ids") * BYTES_PER_TOKEN)
    sums = checkpointed(size_sums(sized, "block_id", "bytes", seed))
    for turn in range(TURNS):
        sharded = sized_shards(
            with_packed(sized), "block_id", "bytes", limit, seed, True, sums, (turn, TURNS)
        )
        rows = in_shard_order(sharded, "shard", ["position"])
        write_ordered(rows, path, "shard", "append" if turn else "overwrite")
    narrow = sized.select("block_id", "bytes")
    index = shard_index(sized_shards(narrow, "block_id", "bytes", limit, seed, sums=sums), "bytes")
    index.write.mode("overwrite").json(f"{path}-index")
    return blocks.sparkSession.read.schema(index.schema).json(f"{path}-index")


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards of a layout as one table."""
    return spark.read.parquet(path)
