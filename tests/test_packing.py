"""Packing against a sequential reference, and its invariants."""

import hashlib
import os
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quern.functions.text import loss_mask, packed_ids, padded, unpacked_ids
from quern.operators import counts, ordering, packing
from quern.sources import blocks as block_io

EOS, PAD = 257, 258


@pytest.fixture(scope="module")
def docs(spark):
    sizes = [(i * 37) % 90 + 1 for i in range(120)] + [2_000]
    rows = [(i, n, [i % 250] * n) for i, n in enumerate(sizes)]
    return rows, spark.createDataFrame(rows, "id bigint, n_tokens int, input_ids array<int>")


def sequential(rows, splits, seed, epoch, length):
    def key(i):
        return hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()

    order = sorted(rows, key=lambda r: (key(r[0]), r[0]))
    streams = [[] for _ in range(splits)]
    for position, (_, _, ids) in enumerate(order):
        streams[position % splits] += [*ids, EOS]
    found = {}
    for split, stream in enumerate(streams):
        for b in range(-(-len(stream) // length)):
            block = stream[b * length : (b + 1) * length]
            found[split, b] = block + [PAD] * (length - len(block))
    return found


def packed(df, **options):
    return packing.pack_sequences(df.select("id", "n_tokens"), df, 4, 9, 2, 64, **options)


def as_dict(blocks):
    return {(r["split_id"], r["block_no"]): r["input_ids"] for r in blocks.collect()}


def test_equals_sequential_packing(docs):
    rows, df = docs
    assert as_dict(packed(df)) == sequential(rows, 4, 9, 2, 64)


def test_budget_cuts_and_pads(spark, docs):
    rows, df = docs
    budget = counts.token_budget(df, 4, 64).first()["blocks"]
    blocks = as_dict(packed(df, blocks_per_epoch=budget))
    full = sequential(rows, 4, 9, 2, 64)
    assert len(blocks) == budget
    assert Counter(s for s, _ in blocks) == {s: budget // 4 for s in range(4)}
    for place, block in blocks.items():
        assert block == full.get(place, [PAD] * 64)


def test_documents_of_a_block_add_up(docs):
    rows, df = docs
    for r in packed(df).collect():
        assert sum(r["doc_lengths"]) == sum(t != PAD for t in r["input_ids"])
        assert len(r["doc_ids"]) == len(r["doc_lengths"])


def test_every_layout_holds_the_same_blocks(spark, docs, tmp_path):
    _, df = docs
    want = sorted(as_dict(packed(df, world_size=2)).values())
    first = str(tmp_path / "ranks")
    block_io.write_rank_shards(packed(df, world_size=2), first)
    stored = block_io.read_shards(spark, first)
    block_io.write_shuffled_shards(stored, str(tmp_path / "shuffled"), 3, 5)
    index = block_io.write_sized_shards(stored, str(tmp_path / "sized"), 64 * 4 * 5, 5).collect()
    for name in ("ranks", "shuffled", "sized"):
        rows = block_io.read_shards(spark, str(tmp_path / name)).collect()
        assert sorted(r["input_ids"] for r in rows) == want
    assert sum(r["rows"] for r in index) == len(want)
    assert max(r["bytes"] for r in index) <= 64 * 4 * 5
    sizes = spark.read.parquet(str(tmp_path / "shuffled")).groupBy("shard").count().collect()
    assert max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 1


def test_resume_under_another_world_size_reads_the_rest(spark):
    rows = spark.range(100)
    plan = ordering.epoch_plan(rows, "id", 8, seed=3, epoch=0, world_size=4)
    state = spark.createDataFrame([(0, s, 5 + s % 2) for s in range(8)], "epoch int, split_id int, next_seq bigint")
    stale = spark.createDataFrame([(0, 1, 2)], "epoch int, split_id int, next_seq bigint")
    offsets = ordering.merge_offsets(state, stale)
    other = ordering.epoch_plan(rows, "id", 8, seed=3, epoch=0, world_size=2)
    rest = {r["id"] for r in ordering.remaining(other, offsets, 0).collect()}
    read = {r["id"] for r in plan.where(F.col("seq") < 5 + F.col("split_id") % 2).collect()}
    assert rest | read == set(range(100)) and not rest & read


def test_positions_are_a_permutation_and_change_with_the_epoch(spark):
    rows = spark.range(500)
    first, second = (
        {r["id"]: r["position"] for r in ordering.epoch_plan(rows, "id", 5, 1, e).collect()}
        for e in (0, 1)
    )
    assert sorted(first.values()) == list(range(500)) == sorted(second.values())
    assert first != second


def test_topology_errors():
    with pytest.raises(ValueError):
        ordering.check_topology(10, 4)
    with pytest.raises(ValueError):
        ordering.check_topology(8, 2, workers=3)
    with pytest.raises(ValueError):
        ordering.check_topology(8, 2, global_batch=12)


def test_pad_truncate_and_mask(spark):
    rows = spark.createDataFrame([([1, 2],), ([1, 2, 3, 4, 5],), ([],)], "ids array<int>")
    got = rows.select(padded(F.col("ids"), 4, PAD).alias("p"), loss_mask(F.size("ids"), 4).alias("m"))
    assert [(r["p"], r["m"]) for r in got.collect()] == [
        ([1, 2, PAD, PAD], [True, True, False, False]),
        ([1, 2, 3, 4], [True] * 4),
        ([PAD] * 4, [False] * 4),
    ]


def test_shards_are_written_with_one_shuffle_of_the_blocks(spark, tmp_path, monkeypatch):
    rows = spark.range(300).select(
        F.lit(0).alias("split_id"), F.col("id").alias("block_no"), F.array_repeat(F.col("id").cast("int"), 4).alias("input_ids"))
    written, kept = [], type(rows.write).parquet
    monkeypatch.setattr(type(rows.write), "parquet", lambda self, *a: written.append(self._df) or kept(self, *a))
    block_io.write_shuffled_shards(rows, str(tmp_path / "shuffled"), 3, 5)
    index = block_io.write_sized_shards(rows, str(tmp_path / "sized"), 16 * 5, 5)
    monkeypatch.undo()
    for df in written[:2]:  # the blocks, dealt in the order already, are not dealt once more by shard
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Repartition" in line and "shard" in line]
    want = spark.read.parquet(str(tmp_path / "sized")).groupBy("shard").agg(F.count("*"), F.sum("bytes"), F.min("position"))
    found = sorted(map(tuple, index.collect()))
    assert [(s, n, b) for s, n, b, _ in sorted(map(tuple, want.collect()))] == found
    assert [n for _, n, _ in found] == [5] * 60
    position = ordering.seeded_positions(block_io.block_ids(rows), 5, "block_id").select("block_id", "position")
    stored = spark.read.parquet(str(tmp_path / "shuffled")).select("block_id", "position")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, position.collect()))


def file_order(path, columns):
    """Rows of each folder of a layout, in the order of its files."""
    found = {}
    for folder in sorted(path.glob("*=*")):
        files = [pq.read_table(f, partitioning=None) for f in sorted(folder.glob("*.parquet"))]
        found[folder.name] = [tuple(r[c] for c in columns) for f in files for r in f.to_pylist()]
    return found


def test_blocks_dealt_in_order_are_the_same(spark, docs, tmp_path):
    rows, df = docs
    budget = counts.token_budget(df, 4, 64).first()["blocks"]
    plain = packed(df, blocks_per_epoch=budget, world_size=2)
    dealt = packed(df, blocks_per_epoch=budget, world_size=2, in_order=True)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    found = [tuple(r) for r in dealt.select("rank", "split_id", "block_no").collect()]
    assert found == sorted(found)
    block_io.write_rank_shards(dealt, str(tmp_path / "dealt"), in_order=True)
    block_io.write_rank_shards(plain, str(tmp_path / "plain"))
    stored = [file_order(tmp_path / name, ["split_id", "block_no", "input_ids"]) for name in ("dealt", "plain")]
    assert stored[0] == stored[1] and all(r == sorted(r) and r for r in stored[0].values())
    with pytest.raises(ValueError):
        packed(df, in_order=True)


def test_layouts_leave_no_shuffled_blocks(spark, tmp_path, monkeypatch):
    """Blocks travel packed, a turn of them at a time, and are gone from the shuffle when a layout is written."""

    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = [os.path.join(d, f) for top in disk.localDirsString() for d, _, fs in os.walk(top) for f in fs]
        return sum(os.path.getsize(f) for f in names if "shuffle_" in f)

    ids = F.transform(F.sequence(F.lit(1), F.lit(256)), lambda i: F.pmod(F.hash("id", i), F.lit(259)))
    rows = spark.range(2000).select(
        F.lit(0).alias("split_id"), F.col("id").alias("block_no"), F.lit(0).alias("rank"), ids.alias("input_ids"))
    rows.write.parquet(str(tmp_path / "rows"))
    blocks = spark.read.parquet(str(tmp_path / "rows"))
    before, most = shuffled(), []
    kept = block_io.write_ordered
    monkeypatch.setattr(block_io, "write_ordered", lambda df, *a: (
        most.append(str([x.dataType().catalogString() for x in seq(shuffle_of(df).output())])), kept(df, *a)))
    block_io.write_rank_shards(blocks, str(tmp_path / "ranks"))
    block_io.write_shuffled_shards(blocks, str(tmp_path / "shuffled"), 3, 5)
    index = block_io.write_sized_shards(blocks, str(tmp_path / "sized"), 5 * 4 * 256, 5)
    assert len(most) == 2 + block_io.TURNS and all("binary" in x and "array<int>" not in x for x in most)
    for _ in range(50):  # files are removed in the background
        if (left := shuffled() - before) < 200_000:
            break
        time.sleep(0.1)
    assert left < 200_000  # of 2000 blocks of 1 KB
    assert [r["rows"] for r in index.collect()] == [5] * 400
    stored = file_order(tmp_path / "sized", ["position", "block_no", "input_ids"])
    assert sorted(p for shard in stored.values() for p, *_ in shard) == list(range(2000))
    assert all(r == sorted(r) for r in stored.values())
    want = {r["block_no"]: r["input_ids"] for r in blocks.collect()}
    assert {b: i for shard in stored.values() for _, b, i in shard} == want


def seq(scala):
    return [scala.apply(i) for i in range(scala.size())]


def shuffle_of(df):
    """The node of the plan that deals the blocks."""
    nodes = [df._jdf.queryExecution().analyzed()]
    while nodes:
        node = nodes.pop(0)
        if "Repartition" in node.nodeName():
            return node
        nodes += seq(node.children())


def test_packed_ids_come_back_and_sort_alike(spark):
    ids = [[], [0], [1, 2, 257], [1, 2, 258, 0], [65, 0xD800, 0xDFFF], [0x10FFFF], [1, 300, 127, 128], [1, 2]]
    odd = [[0x110000, 1], [-1], [2**31 - 1, -(2**31), None], [None]]
    rows = spark.createDataFrame([(i,) for i in [*ids, *odd, None]], "ids array<int>")
    there = rows.select("ids", packed_ids("ids").alias("packed"))
    assert all(r["ids"] == r["back"] for r in there.withColumn("back", unpacked_ids(F.array("packed"))).collect())
    for some in (ids, odd[:2]):
        order = [r["ids"] for r in there.orderBy("packed").collect() if r["ids"] in some]
        assert order == sorted(some)
    parts = F.array(packed_ids(F.lit([1, 2])), packed_ids(F.array(F.lit(-1))), packed_ids(F.lit([257])))
    assert rows.limit(1).select(unpacked_ids(parts)).first()[0] == [1, 2, -1, 257]
