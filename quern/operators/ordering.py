"""Seeded orders, dense positions and running totals that never sort a whole table
in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import checkpointed, small_side

# A seeded order is cut into 16**BUCKET_DIGITS buckets by the first hex digits of
# its md5 key, so per-bucket tables have at most that many rows.
BUCKET_DIGITS = 3

# Requested positions that are sent to every executor: 16 bytes each.
BROADCAST_REQUESTS = 1_000_000


def seeded_key(seed: int, *parts: Column) -> Column:
    """Reproducible shuffle key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def key_bucket(key: Column) -> Column:
    return F.conv(F.substring(key, 1, BUCKET_DIGITS), 16, 10).cast("int")


def before(column: Column, window) -> Column:
    """Sum over the rows before the current one, 0 for the first."""
    preceding = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(preceding), F.lit(0))


def _added(totals: dict[str, Column] | None) -> dict[str, Column]:
    return {"position": F.lit(1).cast("bigint"), **(totals or {})}


def _keyed(df: DataFrame, seed: int, id_col: str, *extra: Column) -> DataFrame:
    keyed = df.withColumn("_key", seeded_key(seed, *extra, F.col(id_col)))
    return keyed.withColumn("_bucket", key_bucket(F.col("_key")))


def bucket_sums(
    df: DataFrame, seed: int, id_col: str, *extra: Column, totals: dict[str, Column] | None = None
) -> DataFrame:
    """Rows and totals of each bucket of a seeded order, at most 16**BUCKET_DIGITS rows."""
    return _keyed(df, seed, id_col, *extra).groupBy("_bucket").agg(
        *[F.sum(c).alias(f"_{n}") for n, c in _added(totals).items()]
    )


def seeded_positions(
    df: DataFrame,
    seed: int,
    id_col: str,
    *extra: Column,
    totals: dict[str, Column] | None = None,
    keep_bucket: bool = False,
    in_order: bool = False,
    sums: DataFrame | None = None,
    turn: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Add ``position``, the dense 0-based place of each row in a seeded order.

    md5 spreads distinct ids evenly, so the key's prefix is a range partitioning
    whose bounds need no sampling: the same rows get the same buckets on every
    evaluation. Each bucket is ranked on its own and shifted by the count of the
    buckets before it. ``totals`` adds, per name, the running sum of a bigint
    column in that order, up to and including the row. ``keep_bucket`` leaves
    ``_bucket``, by which the result is hash-partitioned. With ``in_order`` each task holds
    consecutive buckets, so that rows can be written in the order without another shuffle.
    ``turn`` (i, n) then gives only the rows of the i-th of n runs of tasks, placed among
    all rows; the ``bucket_sums`` of all, if given, are not taken again.
    """
    added = _added(totals)
    keyed = _keyed(df, seed, id_col, *extra)
    counts = bucket_sums(df, seed, id_col, *extra, totals=totals) if sums is None else sums
    by_bucket = Window.orderBy("_bucket")  # at most 16**BUCKET_DIGITS rows
    offsets = counts.select(
        "_bucket", *[before(F.col(f"_{n}"), by_bucket).alias(f"_{n}") for n in added]
    )
    group = ["_bucket"]
    if in_order:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        if turn[1] > 1:  # enough for each turn
            tasks = max(tasks, turn[1] * df.sparkSession.sparkContext.defaultParallelism)
        task = F.expr(f"cast(_bucket * {tasks}L div {16**BUCKET_DIGITS} as int)")
        keyed = keyed.withColumn("_task", task)
        if turn[1] > 1:
            keyed = keyed.where(F.expr(f"_task * {turn[1]}L div {tasks}") == turn[0])
        keyed = keyed.repartitionById(tasks, "_task")
        group = ["_task", "_bucket"]
    inside = Window.partitionBy(*group).orderBy("_key", id_col)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = keyed.select("*", *[F.sum(c).over(upto).alias(f"_in_{n}") for n, c in added.items()])
    placed = ranked.join(F.broadcast(offsets), "_bucket")
    shift = {"position": 1}
    return placed.select(
        *df.columns,
        *(["_bucket"] if keep_bucket else []),
        *[
            (F.col(f"_{n}") + F.col(f"_in_{n}") - shift.get(n, 0)).cast("bigint").alias(n)
            for n in added
        ],
    )


def running_totals(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    sums: dict[str, Column],
    max_group_rows: int = 2_000_000,
) -> DataFrame:
    """Add inclusive running sums by ``order`` inside each group.

    While the largest group is small, this is one window. Beyond
    ``max_group_rows`` the rows are range-partitioned by (group, order), so a hot
    group is spread over many tasks; the checkpoint freezes the partition of
    every row, and each partition is shifted by the totals of the earlier ones.
    ``order`` must be total inside a group.
    """
    sizes = df.groupBy(*group).count() if group else df.groupBy().count()
    largest = sizes.agg(F.max("count")).first()[0] or 0
    if largest <= max_group_rows:
        window = Window.partitionBy(*group).orderBy(*order)
        upto = window.rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(upto).alias(n) for n, c in sums.items()])

    ranges = df.repartitionByRange(*[F.col(g) for g in group], *order)
    fixed = checkpointed(ranges.withColumn("_part", F.spark_partition_id()))
    part_totals = fixed.groupBy(*group, "_part").agg(
        *[F.sum(c).alias(f"_{n}") for n, c in sums.items()]
    )
    earlier = Window.partitionBy(*group).orderBy("_part")  # one row per partition
    offsets = part_totals.select(
        *group, "_part", *[before(F.col(f"_{n}"), earlier).alias(f"_{n}") for n in sums]
    )
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = fixed.select("*", *[F.sum(c).over(upto).alias(f"_in_{n}") for n, c in sums.items()])
    return ranked.join(offsets, [*group, "_part"]).select(
        *df.columns, *[(F.col(f"_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums]
    )


def random_split(
    df: DataFrame, id_col: str, train_ratio: float = 0.8, seed: int = 42
) -> DataFrame:
    """(id, position, split_id): a seeded shuffle cut into train (0) and val (1)."""
    val_ratio = round(1.0 - train_ratio, 4)
    ids = df.select(id_col)
    total = ids.agg(F.count("*").alias("_total"))  # one row
    placed = seeded_positions(ids, seed, id_col).join(F.broadcast(total))
    cut = F.round(F.col("_total") * (train_ratio / (train_ratio + val_ratio)))
    return placed.select(
        id_col, "position", F.when(F.col("position") < cut, 0).otherwise(1).alias("split_id")
    )


def through_permutation(df: DataFrame, permutation: DataFrame, id_col: str, split_id: int):
    """Rows of one split with their ``position``; sort by it to read in order."""
    chosen = permutation.where(F.col("split_id") == split_id).select(id_col, "position")
    return df.join(chosen, id_col)


def epoch_plan(
    df: DataFrame,
    id_col: str,
    num_splits: int,
    seed: int,
    epoch: int,
    world_size: int = 1,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add ``position``, ``split_id``, ``seq`` (place in the split) and ``rank``.

    A row's split depends on seed and epoch only; ranks own contiguous ranges of
    splits, so any world size that divides ``num_splits`` reads the same order.
    """
    check_topology(num_splits, world_size)
    placed = seeded_positions(df, seed, id_col, F.lit(epoch), keep_bucket=keep_bucket)
    split = F.pmod(F.col("position"), F.lit(num_splits)).cast("int")
    return placed.withColumns(
        {"split_id": split, "seq": F.floor(F.col("position") / num_splits).cast("bigint")}
    ).withColumn("rank", F.floor(F.col("split_id") / (num_splits // world_size)).cast("int"))


def check_topology(
    num_splits: int, world_size: int, workers: int = 0, global_batch: int | None = None
) -> None:
    """Fail unless splits divide evenly over readers and the batch over splits."""
    readers = world_size * max(workers, 1)
    if num_splits % readers:
        raise ValueError(f"num_splits {num_splits} is not a multiple of {readers} readers")
    if global_batch is not None and global_batch % num_splits:
        raise ValueError(f"global batch {global_batch} is not a multiple of {num_splits} splits")


def merge_offsets(*states: DataFrame) -> DataFrame:
    """One (epoch, split_id, next_seq) table from the states saved by every rank."""
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state)
    return merged.groupBy("epoch", "split_id").agg(F.max("next_seq").alias("next_seq"))


def remaining(plan: DataFrame, offsets: DataFrame, epoch: int) -> DataFrame:
    """Rows of the plan not read yet. ``offsets`` has one row per split."""
    at = offsets.where(F.col("epoch") == epoch).select("split_id", "next_seq")
    joined = plan.join(at, "split_id", "left")
    unread = F.col("seq") >= F.coalesce(F.col("next_seq"), F.lit(0))
    return joined.where(unread).drop("next_seq")


def progress(plan: DataFrame, offsets: DataFrame, epoch: int) -> DataFrame:
    """Rows consumed and still unread per rank."""
    at = offsets.where(F.col("epoch") == epoch).select("split_id", "next_seq")
    per_split = plan.groupBy("rank", "split_id").count().join(at, "split_id", "left")
    done = F.least(F.coalesce(F.col("next_seq"), F.lit(0)), F.col("count"))
    return per_split.groupBy("rank").agg(
        F.sum(done).alias("consumed_rows"), F.sum(F.col("count") - done).alias("unread_rows")
    )


def rank_stride(df: DataFrame, world_size: int, workers: int = 1) -> DataFrame:
    """Reader of each position: every world_size-th row to a rank, then to its workers."""
    place = F.floor(F.col("position") / world_size)
    return df.withColumns(
        {
            "rank": F.pmod(F.col("position"), F.lit(world_size)).cast("int"),
            "worker": F.pmod(place, F.lit(workers)).cast("int"),
        }
    )


def local_shuffle(df: DataFrame, id_col: str, seed: int, buffer: int = 10_000) -> DataFrame:
    """Shuffle inside consecutive buffers of the position order; adds ``shuffled``."""
    grouped = df.withColumn("buffer", F.floor(F.col("position") / buffer).cast("bigint"))
    window = Window.partitionBy("buffer").orderBy(seeded_key(seed, F.col(id_col)), id_col)
    place = F.row_number().over(window) - 1
    return grouped.withColumn("shuffled", (F.col("buffer") * buffer + place).cast("bigint"))


def batch_ids(df: DataFrame, batch_size: int, drop_last: bool = False) -> DataFrame:
    """Add ``batch_id``; optionally drop a last batch that is not full."""
    batched = df.withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("bigint"))
    if not drop_last:
        return batched
    full = df.agg(F.floor(F.count("*") / batch_size).alias("_full"))  # one row
    return batched.join(F.broadcast(full)).where(F.col("batch_id") < F.col("_full")).drop("_full")


def equal_shards(df: DataFrame, shards: int) -> DataFrame:
    """Add ``shard``: consecutive positions in near-equal parts, the first ones larger."""
    total = df.agg(F.count("*").alias("_n"))  # one row
    base = F.floor(F.col("_n") / shards)
    extra = F.pmod(F.col("_n"), F.lit(shards))
    large_rows = extra * (base + 1)
    shard = F.when(
        F.col("position") < large_rows, F.floor(F.col("position") / (base + 1))
    ).otherwise(extra + F.floor((F.col("position") - large_rows) / base))
    return df.join(F.broadcast(total)).withColumn("shard", shard.cast("int")).drop("_n")


def take_positions(df: DataFrame, requests: DataFrame, position: str = "position") -> DataFrame:
    """Rows at the requested positions in request order.

    ``requests`` has (request_order, position); positions may repeat.
    """
    return df.join(small_side(requests, BROADCAST_REQUESTS), position).orderBy("request_order")
