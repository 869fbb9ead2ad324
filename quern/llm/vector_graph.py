"""Near-duplicate vectors: a robust-pruned flat graph, searched by range from medoids.

1. Equal vectors collapse to a node with a weight. Cluster centers are fitted on a bounded sample.
2. Every node is dealt to its ``OVERLAP`` nearest clusters. Inside a cluster the near nodes and some
   far ones are a node's candidates, and robust pruning keeps those that no kept one stands for;
   edges run both ways.
3. A node's adjacency is the union of its lists from all its clusters.
4. A node asks for all nodes in range: from the cluster's medoid it goes greedily along the edges,
   then it expands every node in range until none is new. An edge that leaves the cluster sends the
   question to the other end's cluster if the triangle inequality leaves that end in range; rounds
   end when no question is new. A node that does not find itself starts again at its own place.
5. Cosines at the border of the range are taken again in double precision.

A cluster of more than ``SHARD`` nodes is dealt to several graphs, each with its own medoid, and
its questions to blocks; every block asks every graph, so no task holds more than two shards,
whatever a group's size, and no link is cut off. Links are counted and joined to components inside
the task; only counts, one edge per node and questions leave it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import stored
from quern.llm.graph import components

SIMILAR = 0.9
#: Nodes of one graph, and questions asked of it at once.
SHARD = 2048
#: Nodes a cluster is meant to have, the most clusters there are, and clusters of a node.
CLUSTER = 1000
CLUSTERS = 4096
OVERLAP = 2
#: Vectors that the centers are fitted on, at most about, and the rounds of that.
SAMPLE = 20_000
ROUNDS = 6
#: Near and far candidates of a node, edges kept of them, and the slack of pruning.
NEAR, FAR, DEGREE, ALPHA = 48, 48, 24, 1.2
#: Nodes that a question expands on its way at least.
EXPANDED = 24
#: Single precision is trusted but for this margin.
MARGIN = 1e-4
#: Pairs whose cosines are taken together.
PAIRS = 1 << 17

EDGE = "struct<node:long,home:int,angle:float>"


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and not all zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    fine = (F.size(vector) > 0) & F.forall(vector, number) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one width as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centers(sample: np.ndarray, count: int, seed: int = 1) -> np.ndarray:
    """Spherical k-means; a center that loses all its vectors stays where it is."""
    rng = np.random.default_rng(seed)
    centers = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(ROUNDS if len(centers) > 1 else 0):
        own = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(size > 0, sums / np.where(size > 0, size, 1), centers)
    return centers


def clusters_of(nodes: DataFrame) -> tuple[dict[int, tuple[int, np.ndarray]], int]:
    """Per width of vectors: number of its first cluster, and centers fitted on a sample of nodes."""
    sizes = {r.width: r.n for r in nodes.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    found, first = {}, 0
    for width, n in sorted(sizes.items()):
        count = max(1, min(-(-n // CLUSTER), max(1, CLUSTERS * n // total)))
        share = min(1.0, SAMPLE / total)
        place = F.pmod(F.xxhash64("node"), F.lit(1 << 20))
        drawn = nodes.where((F.size("v") == width) & (place <= int(share * (1 << 20)))).select("v").toArrow()
        if not drawn.num_rows:
            drawn = nodes.where(F.size("v") == width).select("v").limit(1).toArrow()
        found[width] = (first, fit_centers(units(drawn["v"]), count))
        first += len(found[width][1])
    return found, first


def dealt(nodes: DataFrame, clusters: dict[int, tuple[int, np.ndarray]]) -> DataFrame:
    """Nodes with the numbers of their nearest clusters, the nearest first."""

    def assign(batches):
        for batch in batches:
            width = np.diff(batch["v"].offsets.to_numpy(zero_copy_only=False))
            cells = [None] * batch.num_rows
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                first, centers = clusters[int(w)]
                near = units(batch["v"].take(pa.array(at))) @ centers.T
                order = np.argsort(-near, axis=1, kind="stable")[:, :OVERLAP] + first
                for i, own in zip(at.tolist(), order.tolist()):
                    cells[i] = own
            yield batch.append_column("cells", pa.array(cells, pa.list_(pa.int32())))

    return nodes.mapInArrow(assign, "node long, v array<double>, weight long, cells array<int>")


def pruned(x: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of a graph over unit vectors, both ways."""
    n = len(x)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    near = x @ x.T
    np.fill_diagonal(near, -2)
    k = min(NEAR, n - 1)
    pool = np.argpartition(-near, k - 1, axis=1)[:, :k]
    far = np.random.default_rng(seed).integers(0, n, (n, min(FAR, n - 1)))
    pool = np.concatenate([pool, far], axis=1)
    pool = np.sort(pool, axis=1)
    rows = np.arange(n)[:, None]
    gap = np.sqrt(np.maximum(0, 2 - 2 * near[rows, pool]))
    gap[:, 1:][pool[:, 1:] == pool[:, :-1]] = np.inf  # drawn twice
    gap[pool == rows] = np.inf
    left, right = [], []
    for _ in range(DEGREE):
        best = gap.argmin(axis=1)
        open_ = np.flatnonzero(np.isfinite(gap[np.arange(n), best]))
        if not len(open_):
            break
        chosen = pool[open_, best[open_]]
        left.append(open_)
        right.append(chosen)
        apart = np.sqrt(np.maximum(0, 2 - 2 * near[chosen[:, None], pool[open_]]))
        apart[pool[open_] == chosen[:, None]] = 0
        covered = ALPHA * apart <= gap[open_]
        covered[np.arange(len(open_)), best[open_]] = True
        gap[open_] = np.where(covered, np.inf, gap[open_])
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.unique(np.concatenate([a * n + b, b * n + a]))
    return both // n, both % n


def medoid(x: np.ndarray) -> int:
    return int((x @ x.sum(axis=0)).argmax())


def shard_edges(table: pa.Table) -> pa.Table:
    """Adjacency lists of the nodes of one shard."""
    order = np.argsort(table["node"].to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    node = table["node"].to_numpy()
    home = np.array([c[0] for c in table["cells"].to_pylist()], np.int32)
    x = units(table["v"]).astype(np.float32)
    a, b = pruned(x)
    angle = np.arccos(np.clip((x[a] * x[b]).sum(axis=1), -1, 1))
    ends = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=len(node)))])
    edges = pa.StructArray.from_arrays(
        [pa.array(node[b]), pa.array(home[b], pa.int32()), pa.array(angle.astype(np.float32))], names=["node", "home", "angle"])
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), edges)
    return pa.table({"node": pa.array(node), "edges": lists})


class Shard:
    """A graph in a task, and questions asked of it."""

    def __init__(self, points: pa.Table, limit: float):
        points = points.take(pa.array(np.argsort(points["node"].to_numpy(), kind="stable")))
        self.node = points["node"].to_numpy()
        self.weight = points["weight"].to_numpy()
        self.cells = points["cells"].to_pylist()
        self.exact = units(points["v"])
        self.x = self.exact.astype(np.float32)
        lists = points["edges"].combine_chunks()
        flat = lists.flatten()
        owner = np.repeat(np.arange(len(self.node)), np.diff(lists.offsets.to_numpy()))
        to = flat.field("node").to_numpy()
        at = np.minimum(np.searchsorted(self.node, to), len(self.node) - 1)
        here = self.node[at] == to
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(owner[here], minlength=len(self.node)))])
        self.to = at[here]
        # Ends in another cluster that a question in range of this end may have in range.
        angle = flat.field("angle").to_numpy(zero_copy_only=False)
        away = ~here & (angle <= 2 * limit)
        self.exits = (owner[away], flat.field("home").to_numpy()[away], angle[away])

    def expand(self, score, asked, q, at):
        """Cosines of the neighbors of the nodes ``at`` that questions ``q`` have not seen."""
        count = np.diff(self.ends)[at]
        stop = np.cumsum(count)
        begin = 0
        while begin < len(q):
            before = stop[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(stop, before + PAIRS, "right")))
            own = count[begin:end]
            spot = np.repeat(self.ends[at[begin:end]] - np.cumsum(own) + own, own) + np.arange(int(own.sum()))
            who, new = np.repeat(q[begin:end], own), self.to[spot]
            fresh = np.unique((who * len(self.node) + new)[score[who, new] < -1.5])
            who, new = fresh // len(self.node), fresh % len(self.node)
            score[who, new] = np.einsum("ij,ij->i", asked[who], self.x[new])
            begin = end

    def search(self, asked: np.ndarray, own: np.ndarray, similar: float) -> tuple[np.ndarray, int]:
        """Cosines of the nodes seen by each question (-2: not seen); questions that missed themselves."""
        score = np.full((len(asked), len(self.node)), -2, np.float32)
        done = np.zeros(score.shape, bool)
        start = medoid(self.x)
        score[:, start] = asked @ self.x[start]
        every = np.arange(len(asked))
        for _ in range(EXPANDED):
            open_ = np.where(done, np.float32(-3), score)
            best = open_.argmax(axis=1)
            going = every[open_[every, best] > -1.5]
            if not len(going):
                break
            done[going, best[going]] = True
            self.expand(score, asked, going, best[going])
        itself = np.flatnonzero(own >= 0)
        lost = itself[score[itself, own[itself]] < -1.5]
        score[lost, own[lost]] = 1
        while True:
            q, at = np.nonzero((score >= similar - MARGIN) & ~done)
            if not len(q):
                return score, len(lost)
            done[q, at] = True
            self.expand(score, asked, q, at)


def answers(points: pa.Table, questions: pa.Table, similar: float) -> pa.Table:
    """What one block of questions finds in one shard.

    Rows (kind, a, b, n): 0: node a has n links here; 1: a and b hang together; 2: question a has
    to go on to cluster b; 3: a missed itself n times on the way.
    """
    out: dict[str, list] = {"kind": [], "a": [], "b": [], "n": []}

    def put(kind, a, b, n):
        out["kind"].append(np.full(len(a), kind, np.int32))
        for name, value in (("a", a), ("b", b), ("n", n)):
            out[name].append(np.broadcast_to(np.asarray(value, np.int64), (len(a),)))

    if points.num_rows and questions.num_rows:
        limit = float(np.arccos(similar)) + 0.01
        shard = Shard(points, limit)
        cell = questions["cell"][0].as_py()
        node = questions["node"].to_numpy()
        exact = units(questions["v"])
        at = np.minimum(np.searchsorted(shard.node, node), len(shard.node) - 1)
        own = np.where(shard.node[at] == node, at, -1)
        score, lost = shard.search(exact.astype(np.float32), own, similar)
        q, p = np.nonzero(score >= similar - MARGIN)
        keep = np.concatenate([
            np.einsum("ij,ij->i", exact[q[i : i + PAIRS]], shard.exact[p[i : i + PAIRS]]) >= similar
            for i in range(0, len(q), PAIRS)] or [np.empty(0, bool)])
        # Nodes go on along the edges of nodes in range, themselves included.
        leave, home, angle = shard.exits
        if len(leave):
            reach = np.arccos(np.clip(score, -1, 1))
            for i in range(len(node)):
                seen = score[i, leave] >= similar - MARGIN
                on = np.unique(home[seen][np.abs(reach[i, leave[seen]] - angle[seen]) <= limit])
                put(2, np.full(len(on), node[i]), on, 0)
        q, p = q[keep & (shard.node[p] != node[q])], p[keep & (shard.node[p] != node[q])]
        # A link may be found in every cluster that both visit; it counts in the first of them.
        visited = [set(b) | set(c) for b, c in zip(questions["before"].to_pylist(), questions["now"].to_pylist())]
        earlier = [set(b) for b in questions["before"].to_pylist()]
        shared = {c for p_ in np.unique(p).tolist() for c in shard.cells[p_]} - {cell}
        first = np.ones(len(q), bool)
        for c in shared:
            has = np.array([c in own_cells for own_cells in shard.cells])
            came = np.array([c in b for b in earlier])
            also = np.array([c in v and c < cell for v in visited])
            first &= ~(has[p] & (came | also)[q])
        counts = np.bincount(q[first], shard.weight[p[first]], len(node)).astype(np.int64)
        put(0, node, 0, counts)
        label = joined(np.concatenate([node[q], shard.node[p]]), len(q))
        put(1, label[0], label[1], 0)
        put(3, np.zeros(1, np.int64), 0, lost)
    kinds = {"kind": pa.int32(), "a": pa.int64(), "b": pa.int64(), "n": pa.int64()}
    return pa.table({c: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), kinds[c]) for c, v in out.items()})


def joined(ends: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of links and the smallest node each hangs together with, but for those themselves."""
    names, at = np.unique(ends, return_inverse=True)
    a, b = at[:count], at[count:]
    label = np.arange(len(names))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(names))
    return names[apart], names[label[apart]]


def links(nodes: DataFrame, similar: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links per node (node, n), edges of components (a, b), and questions that missed themselves."""
    clusters, _ = clusters_of(nodes)
    placed = stored(dealt(nodes, clusters), "placed")
    copies = placed.withColumn("cell", F.explode("cells"))
    sizes = copies.groupBy("cell").agg(F.expr(f"cast((count(1) - 1) div {SHARD} + 1 as int)").alias("shards"))
    spot = F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")
    copies = copies.join(sizes, "cell").withColumn("shard", spot)
    lists = copies.select("cell", "shard", "node", "v", "cells").groupBy("cell", "shard").applyInArrow(
        shard_edges, f"node long, edges array<{EDGE}>")
    # A node has one list from each of its clusters.
    union = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("edges"))).alias("edges"))
    points = stored(copies.join(union, "node").select("cell", "shard", "shards", "node", "v", "weight", "cells", "edges"), "graph")
    asked = placed.select("node", "v", F.expr("cast(array() as array<int>)").alias("before"), F.col("cells").alias("now"))
    found = []
    while True:
        found.append(stored(one_round(points, sizes, asked, similar), "answers"))
        on = found[-1].where("kind = 2").select(F.col("a").alias("node"), F.col("b").cast("int").alias("cell")).distinct()
        known = asked.select("node", "v", F.array_union("before", "now").alias("before"))
        onward = on.join(known, "node").where("NOT array_contains(before, cell)")
        asked = stored(onward.groupBy("node").agg(
            F.any_value("v").alias("v"), F.any_value("before").alias("before"), F.array_sort(F.collect_list("cell")).alias("now")),
            "questions")
        if asked.isEmpty():
            break
    rows = reduce(DataFrame.unionAll, found)
    return (rows.where("kind = 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n")),
            rows.where("kind = 1").select("a", "b"), rows.where("kind = 3").agg(F.sum("n").alias("missed")))


def one_round(points: DataFrame, sizes: DataFrame, asked: DataFrame, similar: float) -> DataFrame:
    """Every question in each of its new clusters, against all shards of the cluster."""
    questions = asked.withColumn("cell", F.explode("now"))
    blocks = questions.groupBy("cell").agg(F.expr(f"cast((count(1) - 1) div {SHARD} + 1 as int)").alias("blocks"))
    both = sizes.join(blocks, "cell")  # a row per cluster
    block = F.pmod(F.xxhash64(F.lit(7), F.col("node")), F.col("blocks")).cast("int")
    left = points.drop("shards").join(both.select("cell", "blocks"), "cell").withColumn(
        "block", F.explode(F.expr("sequence(0, blocks - 1)"))).drop("blocks")
    right = questions.join(both, "cell").select(
        "cell", F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"), block.alias("block"), "node", "v", "before", "now")
    keys = ["cell", "shard", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda p, q: answers(p, q, similar), "kind int, a long, b long, n long")


def vector_duplicates(df: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Per row of ``df`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Null and zero vectors and those with null or non-finite components link with nothing and are
    kept, as are vectors of different widths as to each other. Equal vectors link, rows that share
    an id too if their vectors are alike; each row counts. A null id takes part and is never a
    component's name unless it has no other. Other columns are ignored. An empty table gives none.
    """
    vector = F.col("embedding")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(vector), vector.cast("array<double>")).alias("v"))
    rows = rows.select("vec_id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("h1"),
                       F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")).alias("h2"))
    equal = rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.any_value("v").alias("v"))
    # Written once, so the numbers stay.
    nodes = stored(equal.withColumn("node", F.monotonically_increasing_id()), "nodes")
    if nodes.isEmpty():
        return _told(rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    counts, edges, _ = links(nodes.select("node", "v", "weight"), similar)
    root = components(edges).select(F.col("node"), "component") if not edges.isEmpty() else None
    named = nodes.select("node", "h1", "h2", "first", "weight")
    named = named.withColumn("component", F.col("node")) if root is None else named.join(root, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    told = named.join(lowest, "component").join(counts, "node", "left").select(
        "h1", "h2", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"))
    own = rows.select("vec_id", "h1", "h2").join(told, ["h1", "h2"], "left")
    return _told(own.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
                            F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")))


def _told(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def recall(df: DataFrame, result: DataFrame, asked: int = 256, similar: float = SIMILAR) -> float:
    """Share of the links of up to about ``asked`` vectors, drawn by hash, that ``result`` counts.

    The truth is a scan that compares them with all rows in double precision. Their ids must be unique.
    """
    rows = df.where(usable(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    total = rows.count()
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, total // asked))) == 0).limit(2 * asked).toArrow()
    if not drawn.num_rows:
        return 1.0
    ids = drawn["vec_id"].to_pylist()
    wanted = units(drawn["v"])

    def count(batches):
        sums = np.zeros(len(wanted), np.int64)
        for batch in batches:
            if batch.num_rows:
                sums += (wanted @ units(batch["v"]).T >= similar).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums)], names=["vec_id", "n"])

    same = rows.where(F.size("v") == wanted.shape[1])
    truth = same.mapInArrow(count, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("n"))
    sums = truth.join(result.select("vec_id", "n_links"), "vec_id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
    return sums[1] / sums[0] if sums[0] else 1.0
