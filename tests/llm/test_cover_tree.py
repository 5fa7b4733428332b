from __future__ import annotations

import numpy as np
import pyspark.sql.functions as F
import pytest

from tierhouse.llm import cover_tree, queries  # noqa: F401
from tierhouse.llm.cover_tree import Best, Tree, nearest
from tierhouse.llm.registry import QUERIES

SCHEMA = "vec_id long, vector array<long>"


def brute_force(rows, k, asks):
    found = set()
    for q, v in rows:
        if not asks(q):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
        found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return found


def clustered(rng, rows, dims):
    centres = rng.integers(-300, 300, (12, dims))
    return centres[rng.integers(0, 12, rows)] + rng.integers(-9, 9, (rows, dims))


@pytest.mark.parametrize("kind", ["clustered", "even", "ties"])
def test_same_as_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 150)
    monkeypatch.setattr(cover_tree, "QUERY_ROWS", 20)
    monkeypatch.setattr(cover_tree, "RUN", 2)
    rng = np.random.default_rng(4)
    points = {
        "clustered": lambda: clustered(rng, 700, 8), "even": lambda: rng.integers(-200, 200, (700, 8)),
        "ties": lambda: rng.integers(-1, 2, (700, 3)),
    }[kind]()
    rows = [(int(i), p.tolist()) for i, p in zip(rng.permutation(700), points, strict=True)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {tuple(r) for r in nearest(docs, 5, F.col("vec_id") % 9 == 0).collect()}
    assert found == brute_force(rows, 5, lambda q: q % 9 == 0)


def test_pairs_of_nodes_are_left_out(monkeypatch):
    rng = np.random.default_rng(1)
    tree = Tree.build(np.arange(4000), clustered(rng, 4000, 6))
    queries = Tree.build(np.arange(5000, 5200), clustered(rng, 200, 6))
    compared = []
    whole = Best._compare
    monkeypatch.setattr(Best, "_compare", lambda s, v, m, t: (compared.append((m.high - m.low) * (t.high - t.low)), whole(s, v, m, t)))
    Best(queries, 5).meet(tree)
    assert 0 < sum(compared) < 0.7 * 4000 * 200


def test_pairs_of_blocks_are_left_out(spark, monkeypatch):
    """Groups in different directions: most pairs of blocks never meet, and the results are those of all pairs."""
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 100)
    monkeypatch.setattr(cover_tree, "QUERY_ROWS", 20)
    written = {}
    whole = cover_tree.materialize
    monkeypatch.setattr(cover_tree, "materialize", lambda df, label: written.setdefault(label, whole(df, label)) if label in ("pairs", "meetings") else whole(df, label))
    rng = np.random.default_rng(3)
    centres = 400 * np.eye(12, dtype=int)
    points = centres[rng.integers(0, 12, 2400)] + rng.integers(-9, 9, (2400, 12))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    found = {tuple(r) for r in nearest(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 20 == 0).collect()}
    assert found == brute_force(rows, 5, lambda q: q % 20 == 0)
    pairs, met = written["pairs"].count(), written["meetings"].count()
    assert pairs >= 12 * 24 and met < 0.25 * pairs


def test_radii_cover_every_row():
    tree = Tree.build(np.arange(900), clustered(np.random.default_rng(2), 900, 5))

    def check(node):
        away = np.sqrt(((tree.points[node.low : node.high] - tree.points[node.centre]) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-9
        if node.children:
            assert [c.low for c in node.children] == [node.low, *(c.high for c in node.children[:-1])]
            assert node.children[-1].high == node.high
        for child in node.children:
            check(child)

    check(tree.root)
    assert sorted(tree.ids) == list(range(900)) and tree.root.children


def test_odd_rows(spark):
    rows = [(0, [1, 2]), (1, None), (2, []), (3, [1, None]), (4, [3, 4]), (4, [3, 4]), (None, [9, 9]), (50, [0, 0])]
    found = {tuple(r) for r in nearest(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 50 == 0).collect()}
    assert found == {(0, 1, 4, 11), (0, 2, 4, 11), (0, 3, 50, 0), (50, 1, 0, 0), (50, 2, 4, 0), (50, 3, 4, 0)}
    assert nearest(spark.createDataFrame([], SCHEMA), 5, F.lit(True)).collect() == []
    assert nearest(spark.createDataFrame(rows, SCHEMA), 5, F.lit(False)).collect() == []


def brute_force_any(rows, k, asks):
    """Exact, for vectors of any size and length; results end at the ends of a long."""
    found = set()
    for q, v in rows:
        if asks(q):
            products = [(sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
            scored = sorted((-min(max(p, -(2**63)), 2**63 - 1), i) for p, i in products)
            found |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return found


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(-50, 50, 3 + (i % 3)).tolist()) for i in range(200)] + [(300, [7])]
    got = {tuple(r) for r in nearest(spark.createDataFrame(rows, SCHEMA), 4, F.col("vec_id") % 10 == 0).collect()}
    assert got == brute_force_any(rows, 4, lambda q: q % 10 == 0)


@pytest.mark.parametrize("size", [2**27, 2**31, 2**45, 2**62])
def test_large_components_are_exact(spark, monkeypatch, size):
    """Products beyond what doubles hold, next to small vectors in the same blocks, with ties that a rounding would break."""
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", 60)
    monkeypatch.setattr(cover_tree, "QUERY_ROWS", 20)
    monkeypatch.setattr(cover_tree, "RUN", 2)
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-size, size, 4).tolist()) for i in range(100)]
    rows += [(100 + i, [size - 1, size - 2 - i % 3, 5, i % 2]) for i in range(60)]
    rows += [(200 + i, rng.integers(-9, 9, 4).tolist()) for i in range(100)]
    got = {tuple(r) for r in nearest(spark.createDataFrame(rows, SCHEMA), 5, F.col("vec_id") % 7 == 0).collect()}
    assert got == brute_force_any(rows, 5, lambda q: q % 7 == 0)


def test_query_with_one_large_and_one_short_vector(spark, tmp_path):
    """Every query of the table gets its results, whatever single vectors hold."""
    spark.createDataFrame([(i, [float(i % 9), 1.0]) for i in range(100)] + [(100, [1e30, 2.0]), (101, [3.0])],
                          "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op3_top_k"](spark, str(tmp_path))
    assert {r["query_id"]: r["n"] for r in got.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {0: 5, 50: 5, 100: 5}
    assert got.filter("query_id = 50 AND rank = 1").first()["vec_id"] == 100
