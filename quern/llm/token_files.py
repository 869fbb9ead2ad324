"""Token ids in bit-packed files.

A file is a table of blocks in ascending document order. A block holds the ids of whole
documents, each id in the fewest bits its vocabulary needs, with the ids' places beside it:

======== ============================================================
part     number of the file's range of documents, ascending
block    number of the block in its part
first    ids of the part before this block
width    bits of one id
payload  the packed ids: 64 ids fill ``width`` 64-bit words
doc_ids  the documents of the block, in order
lengths  ids of each of these documents
======== ============================================================

Any id is found from its block, without reading others: ``unpack(payload, width, at, n)``.
The files are written and read by Spark, so they may lie in any store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.encoding import encoder
from quern.llm.words import pieces
from quern.session import fresh_path

BLOCK_IDS = 1 << 17
#: Text that is encoded together, in bytes; in larger pieces a word is looked up less often.
ENCODED_BYTES = 8 << 20
BLOCKS = "part int, block int, first long, width int, payload binary, doc_ids array<long>, lengths array<long>"
SUMS = "part int, doc_id long, first long, n_tokens long, ids_crc32 long"


def id_width(vocab_size: int) -> int:
    """Fewest bits for ids below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids in ``width`` bits each; the last group of 64 is filled up with zeros."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups * 64,), np.uint64)
    lanes[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.reshape(groups, 64).T)
    out = np.zeros((width, groups), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        out[word] |= lanes[lane] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start``, touching only the groups of 64 that hold them."""
    if not count:
        return np.empty(0, "<u4")
    low, high = start // 64, -(-(start + count) // 64)
    words = np.frombuffer(payload, "<u8", (high - low) * width, low * width * 8)
    words = np.ascontiguousarray(words.reshape(high - low, width).T)
    mask = np.uint64((1 << width) - 1)
    lanes = np.empty((64, high - low), "<u4")
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[lane] = value & mask
    return lanes.T.reshape(-1)[start - low * 64 : start - low * 64 + count]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    Every document ends in ``end_id``; a null or empty text has only that. Null ids come first;
    rows of one id are ordered by the text's hash, so repeated rows are written once each. A
    document stays in one block, so a block is larger than ``block_ids`` only for a longer
    document. An empty table gives files without rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        width = id_width(max(encode.vocab_size, end_id + 1))
        end = np.array([end_id], "<u4")
        held, ids, lengths, size, first, block = [], [], [], 0, 0, 0
        for batch in batches:
            for piece in pieces(batch, size=ENCODED_BYTES):
                found, counts = encode.ids(piece["text"])
                stops = np.cumsum(counts)
                for doc_id, count, stop in zip(piece["doc_id"].to_pylist(), counts.tolist(), stops.tolist()):
                    ids += (found[stop - count : stop], end)
                    held.append(doc_id)
                    lengths.append(count + 1)
                    size += count + 1
                    if size >= block_ids:
                        yield _block(part, block, first, width, ids, held, lengths)
                        first, block = first + size, block + 1
                        held, ids, lengths, size = [], [], [], 0
        if held:
            yield _block(part, block, first, width, ids, held, lengths)

    (rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text").mapInArrow(blocks, BLOCKS).write.parquet(path))


def _block(part, block, first, width, ids, held, lengths) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
            pa.array([width], pa.int32()), pa.array([pack(np.concatenate(ids), width)], pa.binary()),
            pa.array([held], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
        ],
        names=["part", "block", "first", "width", "payload", "doc_ids", "lengths"],
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: part, doc_id, its first id's place in the part, length, crc32."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = {n: batch[n][row].as_py() for n in ("part", "first", "width", "payload", "doc_ids", "lengths")}
                lengths = np.array(get["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = unpack(get["payload"], get["width"], 0, int(ends[-1]))
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([get["part"]] * len(crc), pa.int32()), pa.array(get["doc_ids"], pa.int64()),
                        pa.array(get["first"] + ends - lengths, pa.int64()), pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["part", "doc_id", "first", "n_tokens", "ids_crc32"],
                )

    return spark.read.parquet(path).mapInArrow(sums, SUMS)


def document_starts(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, ids of all documents before it, length and crc32."""
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("part").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("size"))
    # One row per file, so the running total over them is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return (
        read_documents(spark, path).join(offsets, "part")
        .select("doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Writes token files of ``docs`` and describes each document from the files as read back."""
    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return document_starts(spark, path)
