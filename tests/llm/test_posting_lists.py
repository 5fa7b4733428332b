import numpy as np
import pyspark.sql.functions as F
import pytest
from conftest import DATA

from tierhouse.llm import posting_lists
from tierhouse.llm.queries import op12_nearest

KIND = "vec_id long, vector array<double>"


def brute(rows, k, asks):
    """Exact results; equal rows ask once."""
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v and any(v)
              and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in sorted(set(usable)):
        if asks(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, k, condition, **more):
    got = posting_lists.nearest(spark.createDataFrame(rows, KIND), k, F.expr(condition), **more)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-12, atol=0)


def test_small_table_with_odd_rows(spark):
    rows = [(i, [float(i % 5), float(i % 3) - 1.0, 2.0]) for i in range(60)]
    rows += [(70, None), (71, []), (72, [0.0, 0.0, 0.0]), (73, [1.0, None, 1.0]), (74, [float("nan"), 1.0, 1.0]),
             (75, [float("inf"), 1.0, 1.0]), (None, [9.0, 9.0, 9.0]), (80, [5.0]), (90, [1.0, 1.0, 1.0, 7.0]),
             (10, [0.0, 0.0, 2.0]), (10, [0.0, 0.0, 2.0])]
    same(found(spark, rows, 5, "vec_id % 10 = 0"), brute(rows, 5, lambda i: i % 10 == 0))


def test_more_copies_than_results_and_fewer_rows_than_results(spark):
    rows = [(i, [1.0, 2.0]) for i in range(200)] + [(500 + i, [2.0, 1.0 + i]) for i in range(5)]
    same(found(spark, rows, 7, "vec_id % 4 = 0"), brute(rows, 7, lambda i: i % 4 == 0))
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    same(found(spark, few, 20, "vec_id < 2"), brute(few, 20, lambda i: i < 2))
    alone = [(0, [1.0, 0.0])]
    assert found(spark, alone, 3, "true") == []


def test_large_and_tiny_components(spark):
    rows = [(i, [1e150 if i == 3 else 1.0, i * 1e-150, 1.0]) for i in range(30)]
    got = found(spark, rows, 3, "vec_id % 5 = 0")
    assert [g[:3] for g in got] == [w[:3] for w in brute(rows, 3, lambda i: i % 5 == 0)]


def test_empty_table_no_queries_and_clashing_columns(spark):
    assert found(spark, [], 3, "true") == []
    rows = [(i, [float(i), 1.0]) for i in range(10)]
    assert found(spark, rows, 3, "false") == []
    frame = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS id", "2 AS key", "3 AS entry", "4 AS list", "5 AS asks")
    got = posting_lists.nearest(frame, 3, F.col("vec_id") == 4).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [9, 8, 7]


@pytest.mark.parametrize("spread", [0.15, 3.0])
def test_recall_and_balance_with_many_lists(spark, monkeypatch, spread):
    """Groups of vectors, and vectors without any structure."""
    monkeypatch.setattr(posting_lists, "LIST_ROWS", 64)
    monkeypatch.setattr(posting_lists, "BLOCK_BYTES", 16 * 8 * 50)
    dice = np.random.default_rng(1)
    centres = dice.normal(size=(40, 16))
    points = centres[dice.integers(40, size=4000)] + spread * dice.normal(size=(4000, 16))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    seen = []
    got = found(spark, rows, 10, "vec_id % 50 = 0", watch=seen.append)
    want = brute(rows, 10, lambda i: i % 50 == 0)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert len({g[:1] + g[2:3] for g in got} & {w[:1] + w[2:3] for w in want}) >= 0.9 * len(want)
    index = seen[0]
    assert len(index.centroids) == 63
    homes = index.homes(points)
    sizes = np.bincount(homes[:, 0], minlength=63)
    assert sizes.max() < 8 * 64 and ((homes >= 0).sum(axis=1) <= posting_lists.MOST_COPIES).all()
    if spread < 1:  # with groups, few lists are searched
        assert len(index.lists_of(points[::50])[0]) < 0.25 * 80 * 63


def test_walk_finds_the_nearest_centroids():
    dice = np.random.default_rng(2)
    points = dice.normal(size=(3000, 8))
    index = posting_lists.Lists.fit(points, 1.0, float(np.sqrt((points**2).sum(axis=1).max())), 120, 10)
    lifted = index.lifted(points[:300])
    names, away = index.walk(lifted, 16)
    exact = posting_lists._distances(lifted, index.centroids)
    assert np.allclose(away, np.take_along_axis(exact, names, axis=1))
    best = np.argsort(exact, axis=1)[:, :8]
    assert np.mean([len(set(a) & set(b[:8])) / 8 for a, b in zip(best, names)]) > 0.97


def test_query_recall_and_exact_scores(spark):
    folder = str(DATA / "sf0.01")
    got = op12_nearest(spark, folder)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    table = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    want = brute(rows, 20, lambda i: i % 20 == 0)
    mine = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())
    assert [m[:2] for m in mine] == [w[:2] for w in want]
    assert len({(m[0], m[2]) for m in mine} & {(w[0], w[2]) for w in want}) >= 0.95 * len(want)
    vectors = dict(rows)
    for query, _, vec, score in mine[::50]:
        assert score == pytest.approx(sum(a * b for a, b in zip(vectors[query], vectors[vec])), rel=1e-12, abs=1e-15)
