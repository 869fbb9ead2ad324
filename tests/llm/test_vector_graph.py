"""Near-duplicate vectors against all pairs."""

import numpy as np

from quern.llm import vector_graph

SCHEMA = "vec_id long, embedding array<double>, label int, node long, v string, weight int"
INF, NAN = float("inf"), float("nan")


def fine(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, similar=0.9):
    unit = []
    for _, v in rows:
        if fine(v):
            x = np.array(v) / np.abs(v).max()
            unit.append(x / np.linalg.norm(x))
        else:
            unit.append(None)
    label, counts = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(unit):
        for j, y in enumerate(unit[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= similar:
                counts[i] += 1
                counts[j] += 1
                label[root(i)] = root(j)
    groups = {}
    for i, (vec_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(vec_id)
    lowest = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, counts[k], lowest[root(k)], i == lowest[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in vector_graph.vector_duplicates(df.repartition(3), **options).collect()), key=repr)


def groups(seed, sizes, width=16, noise=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        base = rng.normal(size=width)
        rows += [base + noise * rng.normal(size=width) for _ in range(size)]
    order = rng.permutation(len(rows))
    return [(int(i), [float(x) for x in rows[k] * rng.uniform(0.1, 10)]) for i, k in enumerate(order)]


def test_matches_all_pairs(spark):
    rows = groups(1, [1] * 150 + [2] * 30 + [7, 40])
    assert result(spark, rows) == brute(rows)


def test_clusters_larger_than_a_shard(spark, monkeypatch):
    monkeypatch.setattr(vector_graph, "SHARD", 16)
    monkeypatch.setattr(vector_graph, "CLUSTER", 12)
    rows = groups(2, [1] * 60 + [90, 3, 3], noise=0.04)
    assert result(spark, rows) == brute(rows)


def test_recall_of_links_at_the_border(spark, monkeypatch):
    """A chain around a circle and loose groups: links just in and just out of range."""
    monkeypatch.setattr(vector_graph, "CLUSTER", 20)
    turn = np.linspace(0, 2 * np.pi, 40, endpoint=False)
    rows = [(i, [float(np.cos(t)), float(np.sin(t)), 0.1]) for i, t in enumerate(turn)]
    assert result(spark, rows) == brute(rows)
    rows = groups(3, [12] * 25, width=12, noise=0.22)
    want, got = brute(rows), result(spark, rows)
    found = sum(g[1] for g in got) / sum(w[1] for w in want)
    assert found >= 0.97
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_odd_vectors_repeats_and_widths(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, NAN]), (6, [INF, 1.0]), (7, [1.0, 1.0]),
        (7, [1.0, 1.0]), (7, [-1.0, 1.0]), (8, [2.0, 2.0]), (None, [3.0, 3.0]), (9, [1.0, 1.0, 0.0]), (10, [1e200, 1e200]),
        (11, [1e-200, 1e-200]), (12, [5.0]), (0, [-2.0, 2.0]), (None, None), (13, [1.0, 1.0, 0.0])]
    want = [tuple(r) for r in brute(rows)]
    want = [(i, n, c, i == c) for i, n, c, _ in want]
    assert result(spark, rows) == sorted(want, key=repr)


def test_many_equal_vectors_and_very_wide_ones(spark):
    rows = [(i, [1.0, 2.0]) for i in range(3000)]
    assert result(spark, rows) == [*sorted(((i, 2999, 0, i == 0) for i in range(3000)), key=repr)]
    wide = [(i, [float((j * (i // 2 + 3)) % 7 + 1e-3 * i) for j in range(20_000)]) for i in range(8)]
    assert result(spark, wide) == brute(wide)


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_recall_is_measured(spark):
    rows = groups(5, [1] * 100 + [5] * 20)
    df = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA)
    found = vector_graph.vector_duplicates(df)
    assert vector_graph.recall(df, found, asked=200) == 1.0
    assert vector_graph.recall(df, found.selectExpr("vec_id", "cast(0 as long) AS n_links"), asked=200) == 0.0


def test_pruned_graph_reaches_every_node():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(300, 8)), np.ones((200, 8)) + 0.01 * rng.normal(size=(200, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = vector_graph.pruned(x)
    seen, front = {0}, [0]
    while front:
        front = [int(v) for u in front for v in b[a == u] if int(v) not in seen]
        front = list(dict.fromkeys(front))
        seen.update(front)
    assert len(seen) == len(x)
