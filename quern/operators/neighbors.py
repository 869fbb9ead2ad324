"""Nearest other rows of many rows, exact, with cells that an angle bound rules out left unvisited.

1. Some rows, drawn by hash, are pivots. Rows are dealt in blocks that each meet the pivots in a
   task; a row belongs to the cell of its nearest pivot, and a cell keeps its radius, the largest
   angle to its pivot. Rows of a cell travel packed, as one matrix per block.
2. A question is first compared with its own block. No row of a cell is nearer to it than the angle
   to the pivot less the radius, so only cells where this does not exceed the angle of the k-th row
   found so far (or the angle asked for) are left open.
3. Blocks stand on shelves in the order of their cells. A block's questions go, packed too, once to
   each shelf with an open cell, with a bit for each question and open cell, and the best k rows of
   all are kept.

The result is exact whatever the pivots. Where vectors form groups few cells stay open; where they
do not (evenly spread in many dimensions) no bound can help, and every block meets every other one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import checkpointed

#: Rows of a block; questions that meet a block in one task, at least, and in one product.
BLOCK_ROWS = 4096
ASKED_AT_ONCE = 16_384
#: Rows of the blocks that meet their questions in one task, at least.
SHELF_ROWS = 65_536
#: Parts the questions and shelves the rows are cut into, until a task would hold so many bytes of either.
PARTS, SHELVES = 4, 8
HELD_BYTES = 32 << 20
#: The most pivots, about.
PIVOTS = 1024
#: Rows of a product taken at once.
SLICE = 256
#: Slack for the rounding of cosines and angles.
SLACK = 1e-7


def id_kind(df: DataFrame, id_col: str) -> str:
    """Type in which ids are compared: bigint for whole numbers, else string."""
    return "bigint" if isinstance(df.schema[id_col].dataType, T.IntegralType) else "string"


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def best_rows(
    asked: np.ndarray, asked_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the question, id, cosine) of the best ``k`` rows with another id, the lowest id on a tie."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    begin, end = np.searchsorted(ids, asked_ids, "left"), np.searchsorted(ids, asked_ids, "right")
    places, found, cosines = [], [], []
    for at in range(0, len(asked), SLICE):
        scores = asked[at : at + SLICE] @ rows.T
        for i in np.flatnonzero(end[at : at + SLICE] > begin[at : at + SLICE]):
            scores[i, begin[at + i] : end[at + i]] = -np.inf
        if scores.shape[1] > k:
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
            i, j = np.nonzero((scores >= least - 1e-9) & (scores > -2))
        else:
            i, j = np.nonzero(scores > -2)
        # Equal vectors may differ in the last bits of a product; ties go by id.
        s = np.round(scores[i, j], 12)
        sorted_ = np.lexsort((j, -s, i))
        i, j, s = i[sorted_], j[sorted_], s[sorted_]
        rank = np.arange(len(i)) - np.searchsorted(i, i, "left")
        keep = rank < k
        places.append(i[keep] + at)
        found.append(ids[j[keep]])
        cosines.append(s[keep])
    if not places:
        return np.empty(0, np.int64), ids[:0], np.empty(0)
    return np.concatenate(places), np.concatenate(found), np.concatenate(cosines)


def held_rows(count: int, cut: int, least: int, row_bytes: int) -> int:
    """Rows that a task holds of ``count``: a ``cut``-th, so the copies that travel do not grow with the rows
    until the bytes bound it, and no fewer than ``least``."""
    return max(least, min(-(-count // cut), HELD_BYTES // row_bytes))


def best_of(names: np.ndarray, found: np.ndarray, cosines: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The best ``k`` rows of each question, the lowest id on a tie."""
    order = np.argsort(found, kind="stable")
    order = order[np.argsort(-cosines[order], kind="stable")]
    order = order[np.argsort(names[order], kind="stable")]
    names, found, cosines = names[order], found[order], cosines[order]
    keep = np.arange(len(names)) - np.searchsorted(names, names, "left") < k
    return names[keep], found[keep], cosines[keep]


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


class Packed:
    """Rows with ids and vectors of one width, to and from Arrow."""

    def __init__(self, id_type: str, element: str):
        self.arrow_id = pa.int64() if id_type == "bigint" else pa.string()
        self.kind = np.int64 if id_type == "bigint" else np.object_
        self.element = np.dtype("<f4" if element == "float" else "<f8")
        self.fields = f"ids array<{id_type}>, asked array<boolean>, vectors binary"

    def ids(self, column) -> np.ndarray:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return np.array(column.to_pylist(), self.kind)

    def matrix(self, lists) -> np.ndarray:
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)

    def pack(self, ids, asked, x) -> dict:
        return {"ids": ids.tolist(), "asked": asked.tolist(), "vectors": x.astype(self.element).tobytes()}

    def unpack(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = self.ids(table["ids"].combine_chunks().flatten())
        asked = np.array(table["asked"].combine_chunks().flatten().to_pylist(), bool)
        flat = np.frombuffer(b"".join(table["vectors"].to_pylist()), self.element)
        return ids, asked, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 1)

    def table(self, rows: list[dict], ints: tuple[str, ...]) -> pa.Table:
        schema = pa.schema([
            *[(n, pa.int32()) for n in ints], ("radius", pa.float64()), ("ids", pa.list_(self.arrow_id)),
            ("asked", pa.list_(pa.bool_())), ("vectors", pa.binary())])
        return pa.Table.from_pylist(rows, schema)


def neighbors(
    df: DataFrame, id_col: str, vec_col: str, k: int, asked: str | Column | None = None, within: float | None = None
) -> DataFrame:
    """(query_id, id, score): the ``k`` nearest other rows by cosine of every row asked about.

    With ``within`` only rows of at least that cosine are wanted, so more cells are ruled out.
    Rows without a vector take no part. A vector of length zero has the cosine 0 with every other
    vector, as a question too. Vectors of different widths, and missing or non-finite numbers in
    one, are errors. Rows that share an id are no neighbors of each other. Ties: the lowest id.
    """
    id_type = id_kind(df, id_col)
    element = df.schema[vec_col].dataType.elementType.typeName()
    element = "float" if element == "float" else "double"
    mark = F.lit(True) if asked is None else F.expr(asked) if isinstance(asked, str) else asked
    v = F.col(vec_col)
    wrong = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = checkpointed(df.where(v.isNotNull()).select(
        F.col(id_col).cast(id_type).alias("id"), v.cast(f"array<{element}>").alias("v"),
        F.coalesce(mark, F.lit(False)).alias("asked"), wrong.alias("wrong"),
        (~F.exists(v, lambda x: x != 0)).alias("zero")))
    told = rows.agg(
        F.count("*").alias("rows"), F.count_if("asked").alias("asked"), F.count_if("wrong").alias("wrong"),
        F.count_if("zero").alias("zero"), F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    schema = f"query_id {id_type}, id {id_type}, score double"
    if not told["asked"]:
        return df.sparkSession.createDataFrame([], schema)
    if told["least"] != told["most"]:
        raise ValueError(f"a vector has not {told['most']} numbers, but {told['least']}")
    if told["wrong"]:
        raise ValueError(f"{told['wrong']} vectors hold a missing or non-finite number")
    found = _compared(rows.where("NOT zero"), told["rows"] - told["zero"], Packed(id_type, element), id_type, k, within, told["asked"],
                      told["most"])
    if told["zero"]:
        found = found.unionByName(_beside_zero(rows, k))
    if within is not None:
        found = found.where(F.col("score") >= within)
    by_rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(by_rank))
    return ranked.where(F.col("rank") <= k).drop("rank")


def _beside_zero(rows: DataFrame, k: int) -> DataFrame:
    """Pairs with a vector of length zero: their cosine is 0, so only the lowest ids matter."""

    def lowest(some: DataFrame) -> Column:
        ids = [r["id"] for r in some.select("id").distinct().orderBy("id").limit(k + 1).collect()]
        return F.explode(F.array(*[F.lit(i) for i in ids]))

    questions = rows.where("asked")
    pairs = [questions.where("NOT zero").select(F.col("id").alias("query_id"), lowest(rows.where("zero")).alias("id")),
             questions.where("zero").select(F.col("id").alias("query_id"), lowest(rows).alias("id"))]
    both = pairs[0].unionAll(pairs[1]).where(~F.col("query_id").eqNullSafe(F.col("id")))
    return both.select("query_id", "id", F.lit(0.0).alias("score"))


def _one_block(rows: DataFrame, packed: Packed, id_type: str, k: int) -> DataFrame:
    """Rows that make up one block, which has no cells to rule out."""

    def compare(own: pa.Table) -> pa.Table:
        ids, unit = packed.ids(own["id"]), unit_rows(packed.matrix(own["v"]))
        q = np.flatnonzero(np.array(own["asked"].to_pylist(), bool))
        at, found, cosine = best_rows(unit[q], ids[q], unit, ids, k)
        return pa.table({"query_id": pa.array(ids[q[at]].tolist(), packed.arrow_id),
                         "id": pa.array(found.tolist(), packed.arrow_id), "score": pa.array(cosine)})

    block = rows.select("id", "v", "asked", F.lit(0).alias("block"))
    return block.groupBy("block").applyInArrow(compare, f"query_id {id_type}, id {id_type}, score double")


def _compared(rows: DataFrame, count: int, packed: Packed, id_type: str, k: int, within: float | None, asked_count: int,
              width: int) -> DataFrame:
    buckets = max(1, -(-count // BLOCK_ROWS))
    if buckets == 1:
        return _one_block(rows, packed, id_type, k)
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    dealt = rows.select("id", "v", "asked", bucket.alias("bucket"))
    pivot_share = min(PIVOTS, buckets) / count
    place = F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(1 << 30))
    drawn = dealt.where(place <= int(pivot_share * (1 << 30)))
    numbered = drawn.select("v", (F.row_number().over(Window.orderBy("id", "v")) - 1).alias("pivot_no"))  # few rows
    pivots = numbered.select(
        F.col("v").alias("pivot"), "pivot_no", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))

    def place_rows(own: pa.Table, those: pa.Table) -> pa.Table:
        out = []
        if own.num_rows:
            ids, x = packed.ids(own["id"]), packed.matrix(own["v"])
            wanted, unit = np.array(own["asked"].to_pylist(), bool), unit_rows(packed.matrix(own["v"]))
            if those.num_rows:
                centers = packed.matrix(those["pivot"])[np.argsort(those["pivot_no"].to_numpy())]
            else:
                centers = x[:1]
            near = unit @ unit_rows(centers).T
            cell = near.argmax(axis=1)
            for c in np.unique(cell):
                at = np.flatnonzero(cell == c)
                radius = float(angles(near[at, c]).max())
                bucket = own["bucket"][0].as_py()
                out.append({"cell": int(c), "bucket": bucket, "radius": radius, **packed.pack(ids[at], wanted[at], x[at])})
                if not those.num_rows:
                    out[-1]["radius"] = float(np.pi)
        return packed.table(out, ("cell", "bucket"))

    subs = checkpointed(dealt.groupBy("bucket").cogroup(pivots.groupBy("bucket")).applyInArrow(
        place_rows, f"cell int, bucket int, radius double, {packed.fields}"))
    cells = subs.groupBy("cell").agg(
        F.max("radius").alias("radius"), F.expr(f"cast((sum(size(ids)) - 1) div {BLOCK_ROWS} + 1 as int)").alias("chunks"))
    cells = checkpointed(cells)  # at most a row for each pivot
    subs = subs.join(cells.select("cell", "chunks"), "cell").withColumn(
        "chunk", F.expr("cast(pmod(xxhash64(bucket), chunks) as int)"))
    # Blocks are numbered in the order of their cells, and consecutive ones share a shelf.
    in_cells = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most a row for each pivot
    starts = cells.withColumn("start", F.coalesce(F.sum("chunks").over(in_cells), F.lit(0)).cast("int"))
    row_bytes = max(1, width * packed.element.itemsize)
    on_shelf = max(1, held_rows(count, SHELVES, SHELF_ROWS, row_bytes) // BLOCK_ROWS)
    # Every block is told of all cells: their pivots in the order of the numbers, radius and blocks.
    in_order = F.array_sort(F.collect_list(F.struct("pivot_no", "v")))
    pivot_row = numbered.agg(F.transform(in_order, lambda s: s["v"]).alias("pivots"))
    cell_row = starts.agg(F.array_sort(F.collect_list(F.struct("cell", "radius", "chunks", "start"))).alias("cells"))
    # Both sides of a cogroup come from one table, so the columns of one are named anew.
    own_names = subs.select(F.col("cell").alias("to_cell"), F.col("chunk").alias("to_chunk")).distinct()
    known = own_names.join(F.broadcast(pivot_row.join(F.broadcast(cell_row))))  # one row
    limit = float(np.pi) if within is None else float(np.arccos(np.clip(within, -1, 1)))
    arrow_id = packed.arrow_id

    def first(key, own: pa.Table, told: pa.Table) -> pa.Table:
        cell, chunk = (x.as_py() for x in key)
        ids, wanted, x = packed.unpack(own)
        unit = unit_rows(x)
        q = np.flatnonzero(wanted)
        at, found, cosine = best_rows(unit[q], ids[q], unit, ids, k)
        reach = np.full(len(q), limit)
        counts = np.bincount(at, minlength=len(q))
        last = np.cumsum(counts) - 1
        full = counts >= k
        reach[full] = np.minimum(reach[full], angles(cosine[last[full]]))
        out = [{"kind": 0, "cell": cell, "chunk": chunk, **packed.pack(ids, wanted, x)}]
        cells_ = told["cells"][0].as_py()
        every = told["pivots"][0].as_py()
        asked_of: dict[int, list] = {}
        for c in cells_:
            if c["cell"] == cell and c["chunks"] == 1:
                continue
            if every and c["cell"] != cell:
                gap = angles(unit[q] @ unit_rows(np.array([every[c["cell"]]]))[0]) - c["radius"]
                open_ = gap <= reach + SLACK
            else:
                open_ = np.ones(len(q), bool)
            if open_.any():
                for shelf in range(c["start"] // on_shelf, (c["start"] + c["chunks"] - 1) // on_shelf + 1):
                    asked_of.setdefault(shelf, []).append((c["cell"], open_))
        for shelf, asks in asked_of.items():
            some = np.any([open_ for _, open_ in asks], axis=0)
            out.append({"kind": 1, "cell": cell, "chunk": chunk, "shelf": shelf, "open_cells": [c for c, _ in asks],
                        "open": np.packbits([open_[some] for _, open_ in asks], axis=1).tobytes(),
                        **packed.pack(ids[q[some]], wanted[q[some]], x[q[some]])})
        if len(at):
            out.append({"kind": 2, "cell": cell, "chunk": chunk, "query_ids": ids[q[at]].tolist(), "found": found.tolist(),
                        "scores": cosine.tolist()})
        return pa.Table.from_pylist(out, pa.schema([
            *[(n, pa.int32()) for n in ("kind", "cell", "chunk", "shelf")], ("open_cells", pa.list_(pa.int32())), ("open", pa.binary()),
            ("ids", pa.list_(arrow_id)), ("asked", pa.list_(pa.bool_())), ("vectors", pa.binary()),
            ("query_ids", pa.list_(arrow_id)), ("found", pa.list_(arrow_id)), ("scores", pa.list_(pa.float64()))]))

    both = checkpointed(subs.groupBy("cell", "chunk").cogroup(known.groupBy("to_cell", "to_chunk")).applyInArrow(
        first, f"kind int, cell int, chunk int, shelf int, open_cells array<int>, open binary, {packed.fields}, "
        f"query_ids array<{id_type}>, found array<{id_type}>, scores array<double>"))
    arrays = F.explode(F.arrays_zip("query_ids", "found", "scores")).alias("f")
    own = both.where("kind = 2").select(arrays).select(
        F.col("f.query_ids").alias("query_id"), F.col("f.found").alias("id"), F.col("f.scores").alias("score"))
    # Questions are dealt to parts by the block they come from: what a question finds on a shelf is cut
    # to its best k rows before it leaves the task. A block goes only to the parts that ask its cell.
    total = F.broadcast(cells.agg(F.sum("chunks").alias("total")))  # one row
    numbers = F.broadcast(starts.select("cell", "start").join(total))
    parts = max(1, -(-asked_count // held_rows(asked_count, PARTS, ASKED_AT_ONCE, row_bytes)))
    placed = both.where("kind < 2").join(numbers, "cell").withColumn("number", F.col("start") + F.col("chunk"))
    questions = placed.where("kind = 1").select(
        F.col("shelf").alias("to_shelf"), F.expr(f"cast(number * {parts}L div total as int)").alias("to_part"),
        F.col("cell").alias("from_cell"), F.col("chunk").alias("from_chunk"), "open_cells", "open",
        *[F.col(c).alias(c) for c in ("ids", "asked", "vectors")])  # named anew, as above
    needed = questions.select(
        F.explode("open_cells").alias("cell"), F.col("to_shelf").alias("shelf"), F.col("to_part").alias("part")).distinct()
    blocks = placed.where("kind = 0").select(
        "cell", "chunk", F.expr(f"number div {on_shelf}").cast("int").alias("shelf"), "ids", "asked", "vectors",
    ).join(needed, ["cell", "shelf"])

    def tile(rows_: pa.Table, asked_: pa.Table) -> pa.Table:
        gathered, rows_gathered = [], 0
        # Per asking block: its name, its questions, and which of them each cell is open to.
        asking = []
        for i in range(asked_.num_rows if rows_.num_rows else 0):
            q_ids, _, q = packed.unpack(asked_.slice(i, 1))
            cells_ = asked_["open_cells"][i].as_py()
            bits = np.frombuffer(asked_["open"][i].as_buffer(), np.uint8).reshape(len(cells_), -1)
            name = (asked_["from_cell"][i].as_py(), asked_["from_chunk"][i].as_py())
            asking.append((name, q_ids, q, dict(zip(cells_, bits))))
        most = 4 * k * sum(len(q_ids) for _, q_ids, *_ in asking)
        for r, block in enumerate(zip(rows_["cell"].to_pylist(), rows_["chunk"].to_pylist()) if asking else ()):
            own = [(q_ids, q, np.flatnonzero(np.unpackbits(bits[block[0]], count=len(q_ids))))
                   for name, q_ids, q, bits in asking if name != block and block[0] in bits]
            sizes = np.cumsum([len(at) for *_, at in own])
            if not own or not sizes[-1]:
                continue
            ids, _, x = packed.unpack(rows_.slice(r, 1))
            unit, product = unit_rows(x), (sizes - 1) // ASKED_AT_ONCE
            for p in np.unique(product):
                some = [o for o, n in zip(own, product) if n == p]
                q_ids, q = np.concatenate([i[at] for i, _, at in some]), np.concatenate([v[at] for _, v, at in some])
                if len(q_ids):
                    at, near, cosine = best_rows(unit_rows(q), q_ids, unit, ids, k)
                    gathered.append((q_ids[at], near, cosine))
                    rows_gathered += len(at)
            if rows_gathered > most:
                gathered = [best_of(*(np.concatenate(c) for c in zip(*gathered)), k)]
                rows_gathered = len(gathered[0][0])
        if not gathered:
            return pa.table({"query_id": pa.array([], arrow_id), "id": pa.array([], arrow_id), "score": pa.array([], pa.float64())})
        names, found, cosines = best_of(*(np.concatenate(c) for c in zip(*gathered)), k)
        return pa.table({"query_id": pa.array(names.tolist(), arrow_id), "id": pa.array(found.tolist(), arrow_id),
                         "score": pa.array(cosines)})

    more = blocks.groupBy("shelf", "part").cogroup(questions.groupBy("to_shelf", "to_part")).applyInArrow(
        tile, f"query_id {id_type}, id {id_type}, score double")
    return own.unionByName(more)
