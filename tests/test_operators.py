import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierhouse import operators as op
from tierhouse.sources import plan_text
from tierhouse.operators import numbering

DAY = dt.date(2024, 6, 1)


# --- lookups -------------------------------------------------------------------------------


def sales_with_hot_key(spark):
    """A third of the rows on key 7, a third without a key, the rest spread."""
    return spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 500).cast("int").alias("key"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_rows", [None, 1000])
def test_lookup_equals_join(spark, how, min_rows):
    facts = sales_with_hot_key(spark)
    dimension = spark.range(0, 400).select(F.col("id").alias("natural"), (F.col("id") * 10).alias("surrogate"))
    take = ["surrogate"] if how in ("left", "inner") else []
    got = op.lookup(facts, dimension, {"key": "natural"}, take, how, min_rows)
    expected = facts.join(dimension, facts["key"] == dimension["natural"], how).select("id", "key", *take)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_lookup_with_duplicates_on_the_right(spark):
    facts = sales_with_hot_key(spark)
    doubled = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (None, "d")], "key INT, label STRING")
    got = op.lookup(facts, doubled, ["key"], {"label": "l"}, min_rows=1000)
    assert got.where("key = 7").count() == 2 * facts.where("key = 7").count()
    assert got.where("key IS NULL AND l IS NOT NULL").isEmpty()


def test_lookup_spreads_hot_and_missing_keys(spark):
    facts = sales_with_hot_key(spark)
    dimension = spark.range(0, 400).select(F.col("id").alias("natural"), F.col("id").alias("surrogate"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = op.lookup(facts.repartition(8, "id"), dimension, {"key": "natural"}, ["surrogate"], min_rows=1000)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30_000
    assert max(sizes) < 10_000  # a plain join puts the 10,000 rows of key 7 into one partition


def test_lookup_refuses_mixed_types_and_clashes(spark):
    left = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    right = spark.createDataFrame([("1", "b")], "k STRING, v STRING")
    with pytest.raises(TypeError):
        op.lookup(left, right, ["k"])
    with pytest.raises(ValueError):
        op.lookup(left, right.selectExpr("CAST(k AS INT) AS k", "v"), ["k"], ["v"])


def test_hot_keys(spark):
    facts = sales_with_hot_key(spark)
    assert sorted(op.hot_keys(facts, ["key"], min_rows=1000).values()) == [10_000, 10_020]
    assert op.hot_keys(facts, ["key"]) == {}
    assert op.hot_keys(facts.limit(0), ["key"], min_rows=0) == {}


def test_lookup_all_equals_joins(spark):
    facts = sales_with_hot_key(spark).withColumn("other", F.when(F.col("id") % 2 == 0, F.col("id") % 5))
    big = spark.range(0, 400).select(F.col("id").alias("natural"), (F.col("id") * 10).alias("surrogate"))
    small = spark.createDataFrame([(0, "a"), (4, "b")], "o INT, label STRING")
    steps = [(big, {"key": "natural"}, ["surrogate"]), (small, {"other": "o"}, ["label"])]
    expected = facts.join(big, facts["key"] == big["natural"], "left").join(small, F.col("other") == F.col("o"), "left")
    expected = expected.select("id", "key", "other", "surrogate", "label")
    for min_rows in (None, 1000):
        got = op.lookup_all(facts, steps, min_rows)
        assert got.exceptAll(expected).isEmpty() and got.count() == 30_000
    with pytest.raises(ValueError):
        op.lookup_all(facts, [steps[0], steps[0]])


def test_lookup_leaves_broadcasts_to_spark(spark, tmp_path):
    """A small side is broadcast, also one that is spread; a large one is not."""
    facts = sales_with_hot_key(spark)
    small = spark.createDataFrame([(7, "a")], "natural INT, label STRING")
    for min_rows in (None, 1000):
        got = op.lookup(facts, small, {"key": "natural"}, ["label"], min_rows=min_rows)
        got.collect()
        assert "BroadcastHashJoin" in plan_text(got, "simple")
    spark.range(3_000_000).write.parquet(str(tmp_path / "large"))
    large = spark.read.parquet(str(tmp_path / "large")).withColumn("label", F.col("id") * 2)
    got = op.lookup(facts, large, {"key": "id"}, ["label"])
    assert "SortMergeJoin" in plan_text(got, "simple")


# --- numbering -----------------------------------------------------------------------------


def test_surrogate_key_equals_global_row_number(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 50 != 0, F.hash("id") % 1000).alias("v"))
    got = op.surrogate_key(df, ["v", "id"], "k", task_rows=400).select("k", "id", "v")
    plain = df.select(F.row_number().over(Window.orderBy("v", "id")).cast("bigint").alias("k"), "id", "v")
    assert got.exceptAll(plain).isEmpty() and got.count() == 5000


def test_surrogate_key_descending_and_start(spark):
    df = spark.range(100)
    got = op.surrogate_key(df, [F.desc("id")], "k", start=11)
    assert got.where("k + id = 110").count() == 100


def test_surrogate_key_of_copies_is_dense_and_spread(spark, monkeypatch):
    staged = []

    def keep(df, label):
        staged.append(op.materialize(df, label))
        return staged[-1]

    monkeypatch.setattr(numbering, "materialize", keep)
    df = spark.range(0, 20_000, 1, 16).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(1).alias("v"))
    got = op.surrogate_key(df, ["v"], "k", task_rows=1000)
    # Two thirds of the rows are copies, and no partition of the sort holds more than a few of them.
    assert staged[0].groupBy("__part").count().agg(F.max("count")).first()[0] < 4000
    stats = got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    assert tuple(stats) == (1, 20_000, 20_000)
    assert got.select("v").exceptAll(df).isEmpty()


def test_surrogate_key_of_nothing(spark):
    assert op.surrogate_key(spark.range(0), ["id"], "k").columns == ["k", "id"]
    assert op.surrogate_key(spark.range(0), ["id"], "k").isEmpty()


def test_surrogate_key_repeats(spark, rows):
    df = spark.range(1000).select((F.col("id") % 10).alias("v"), "id")
    again = op.surrogate_key(df.repartition(5), ["v"], task_rows=90)
    assert rows(op.surrogate_key(df, ["v"])) == rows(again)


def test_next_value_same_with_and_without_splitting(spark):
    df = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 2, F.col("id") % 50).alias("k")
    )
    split = op.next_value(df, ["k"], ["id"], "id", "following", min_rows=500)
    plain = df.withColumn("following", F.lead("id").over(Window.partitionBy("k").orderBy("id")))
    assert split.exceptAll(plain).isEmpty() and split.count() == 6000


def test_fill_keys(spark):
    df = spark.createDataFrame([(1, "a"), (4, "b"), (None, "d"), (None, "c")], "k INT, v STRING")
    assert sorted(tuple(r) for r in op.fill_keys(df, "k", ["v"]).collect()) == [(1, "a"), (4, "b"), (5, "c"), (6, "d")]


# --- versions ------------------------------------------------------------------------------


def test_latest_version_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    latest = op.latest_version(df, ["k"], ["id"])
    assert sorted(r["id"] for r in latest.collect()) == [997, 998, 999]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_version_ranges(spark, rows):
    days = [dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2022, 1, 1)]
    df = spark.createDataFrame(
        [("a", days[1], days[0]), ("a", days[0], None), ("b", days[2], None)], "k STRING, start_date DATE, end_date DATE"
    )
    got = op.version_ranges(df, ["k"], "start_date", day_before=True)
    assert rows(got, "k", "start_date", "end_date", "is_current") == [
        ("a", days[0], dt.date(2020, 12, 31), False), ("a", days[1], None, True), ("b", days[2], None, True),
    ]


def test_version_checks(spark, rows):
    df = spark.createDataFrame(
        [("a", True), ("a", False), ("b", True), ("c", True), ("c", True)], "k STRING, is_current BOOLEAN"
    )
    assert rows(op.version_check(df, ["k"])) == [("a", 2, 1), ("c", 2, 2)]
    assert rows(op.versions_in_conflict(df, ["k"])) == [("c", 2)]


def test_current_rows(spark):
    df = spark.createDataFrame([(1, None, True), (2, DAY, False), (3, DAY, None)], "i INT, end_date DATE, is_current BOOLEAN")
    assert [r["i"] for r in op.current_rows(df).collect()] == [1]
    assert [r["i"] for r in op.current_rows(df, end="end_date").collect()] == [1]


# --- merges --------------------------------------------------------------------------------

DIM = "product_key_sk INT, product_key STRING, cost INT, line STRING, start_date DATE, end_date DATE, is_current BOOLEAN"
OLD = dt.date(2020, 1, 1)


def dimension(spark):
    return spark.createDataFrame(
        [
            (1, "A", 10, "Road", OLD, dt.date(2021, 1, 1), False),
            (2, "A", 11, "Road", dt.date(2021, 1, 2), None, True),
            (3, "B", 20, "Road", OLD, None, True),
            (4, "C", 30, None, OLD, None, True),
            (5, "D", 40, "Road", OLD, OLD, False),
            (6, None, 50, "Road", OLD, None, True),
        ],
        DIM,
    )


def batch(spark, *lines):
    return spark.createDataFrame(list(lines), "product_key STRING, cost INT, line STRING")


def test_scd1_upsert(spark, rows):
    source = batch(spark, ("A", 99, "Touring"), ("D", 41, "Road"), ("E", 60, None), (None, 70, "Road"))
    got = op.scd1_upsert(dimension(spark), source, ["product_key"], ["cost", "line"], "is_current")
    assert rows(got, "product_key", "cost", "line", "is_current") == sorted(
        [
            ("A", 10, "Road", False), ("A", 99, "Touring", True), ("B", 20, "Road", True), ("C", 30, None, True),
            ("D", 40, "Road", False), ("D", 41, "Road", None), ("E", 60, None, None), (None, 50, "Road", True),
            (None, 70, "Road", None),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    assert got.dtypes == dimension(spark).dtypes


def test_scd1_upsert_twice_is_once(spark, rows):
    source = batch(spark, ("A", 99, "Touring"), ("E", 60, "Road"))
    once = op.scd1_upsert(dimension(spark), source, ["product_key"], ["cost", "line"])
    assert rows(op.scd1_upsert(once, source, ["product_key"], ["cost", "line"])) == rows(once)


def test_scd1_upsert_refuses_two_source_rows(spark):
    twice = batch(spark, ("A", 1, ""), ("A", 2, ""))
    with pytest.raises(Exception, match="unique"):
        op.scd1_upsert(dimension(spark), twice, ["product_key"], ["cost"]).collect()
    with pytest.raises(Exception, match="unique"):
        op.scd2_merge(dimension(spark), twice, ["product_key"], ["cost"], DAY).collect()


def test_scd2_merge(spark, rows):
    source = batch(spark, ("A", 12, "Road"), ("B", 20, "Road"), ("C", 30, "Touring"), ("D", 41, "Road"), ("E", 60, None))
    merged = op.scd2_merge(dimension(spark), source, ["product_key"], ["cost", "line"], DAY)
    before = DAY - dt.timedelta(days=1)
    assert rows(merged.where("product_key IS NOT NULL"), "product_key", "cost", "line", "end_date", "is_current") == sorted(
        [
            ("A", 10, "Road", dt.date(2021, 1, 1), False), ("A", 11, "Road", before, False), ("A", 12, "Road", None, True),
            ("B", 20, "Road", None, True), ("C", 30, None, before, False), ("C", 30, "Touring", None, True),
            ("D", 40, "Road", OLD, False), ("D", 41, "Road", None, True), ("E", 60, None, None, True),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    assert op.versions_in_conflict(merged, ["product_key"]).isEmpty()
    assert rows(op.scd2_merge(merged, source, ["product_key"], ["cost", "line"], DAY)) == rows(merged)
    keyed = op.fill_keys(merged, "product_key_sk", ["product_key"])
    assert keyed.agg(F.max("product_key_sk"), F.count_distinct("product_key_sk")).first()[:] == (10, 10)


def test_merges_read_and_shuffle_each_side_once(spark, tmp_path):
    source = batch(spark, ("A", 12, "Road"), ("B", 20, "Road"), ("E", 60, None))
    dimension(spark).write.parquet(str(tmp_path / "target-side"))
    source.write.parquet(str(tmp_path / "source-side"))
    target, source = (spark.read.parquet(str(tmp_path / f"{n}-side")) for n in ("target", "source"))
    for merged in (
        op.scd1_upsert(target, source, ["product_key"], ["cost"], "is_current"),
        op.scd2_merge(target, source, ["product_key"], ["cost"], DAY),
    ):
        plan = plan_text(merged, "simple")
        assert [plan.count(w) for w in ("FileScan parquet", "Exchange hashpartitioning", "Join")] == [2, 1, 0]


@pytest.mark.parametrize("min_rows", [40, 10**6])
def test_upsert_with_frequent_keys(spark, rows, min_rows):
    """Keys with very many target rows, with and without a source row, and rows without a key."""
    target = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 8).when(F.col("id") % 6 == 2, F.col("id")).alias("k"),
        F.lit("old").alias("v"), (F.col("id") % 2 == 0).alias("open"),
    )
    source = spark.createDataFrame([(7, "new"), (2, "new"), (5000, "new"), (None, "lost"), (9, "new")], "k BIGINT, v STRING")
    got = op.scd1_upsert(target, source, ["k"], ["v"], "open", min_rows=min_rows)
    counts = {(r["k"], r["v"]): r["count"] for r in got.groupBy("k", "v").count().where("k < 10 OR k > 4000 OR k IS NULL").collect()}
    assert counts == {
        (7, "new"): 500, (7, "old"): 500, (8, "old"): 1001, (2, "new"): 1, (5000, "new"): 1, (None, "lost"): 1,
        (None, "old"): 500, (9, "new"): 1,
    }


CHANGE = "k STRING, at INT, v STRING, gone BOOLEAN"
HISTORY = "id INT, k STRING, v STRING, w STRING, begins INT, ends INT, current BOOLEAN"


def applied(target, changes, min_rows=10**6):
    return op.scd2_apply_changes(target, changes, ["k"], "at", "gone", "begins", "ends", "current", min_rows)


def plain_history(events):
    """Versions and empty ranges of (key, sequence, value or None for a delete)."""
    out = []
    for key in {e[0] for e in events}:
        mine = sorted({e[1]: e for e in events if e[0] == key}.values(), key=lambda e: e[1])
        for i, (_, at, value) in enumerate(mine):
            following = mine[i + 1][1] if i + 1 < len(mine) else None
            if value is not None:
                out.append((key, value, at, following, following is None))
            elif i == 0 or mine[i - 1][2] is None:
                out.append((key, None, at, at, False))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_rows", [15, 10**6])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changes_in_any_order_give_one_history(spark, seed, min_rows):
    dice = random.Random(seed)
    events = {(dice.choice("aaaab"), at): None if dice.random() < 0.3 else f"v{at}" for at in range(60)}
    events = [(k, at, v) for (k, at), v in events.items()]
    dice.shuffle(events)
    known = spark.createDataFrame([], HISTORY)
    for part in (events[:20], events[10:25], events[25:50], events[40:], events[:5]):
        rows = [(k, at, v, v is None) for k, at, v in part]
        known = op.materialize(applied(known, spark.createDataFrame(rows, CHANGE), min_rows))
    got = sorted((tuple(r) for r in known.select("k", "v", "begins", "ends", "current").collect()), key=str)
    assert got == plain_history(events)


def test_changes_splice_correct_and_end_versions(spark, rows):
    target = spark.createDataFrame(
        [(1, "a", "one", "x", 10, 20, False), (2, "a", "two", "x", 20, None, True), (3, None, "lost", "x", 1, None, True),
         (4, "b", "only", "y", 10, None, True), (5, "c", "odd", "z", None, None, None)], HISTORY)
    changes = spark.createDataFrame(
        [("a", 15, "late", False), ("a", 20, "right", False), ("a", 15, "late", False), ("b", 30, None, True),
         ("d", 5, None, True), ("a", 1, "first", False), ("c", 7, "new", None)], CHANGE)
    got = applied(target, changes)
    assert got.dtypes == target.dtypes
    want = [
        (None, "a", "first", None, 1, 10, False), (1, "a", "one", "x", 10, 15, False), (None, "a", "late", None, 15, 20, False),
        (2, "a", "right", "x", 20, None, True), (3, None, "lost", "x", 1, None, True), (4, "b", "only", "y", 10, 30, False),
        (None, "d", None, None, 5, 5, False), (5, "c", "odd", "z", None, None, None), (None, "c", "new", None, 7, None, True),
    ]
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert rows(applied(got, changes)) == rows(got)
    later = applied(got, spark.createDataFrame([("d", 2, "early", False)], CHANGE)).where("k = 'd'")
    assert rows(later) == [(None, "d", "early", None, 2, 5, False)]


def test_changes_that_cannot_be_applied(spark):
    target = spark.createDataFrame([], HISTORY)
    for bad in ([("a", 1, "x", False), ("a", 1, "y", False)], [("a", 1, "x", False), ("a", 1, None, True)],
                [(None, 1, "x", False)], [("a", None, "x", False)]):
        with pytest.raises(Exception, match="two different changes|a change lacks"):
            applied(target, spark.createDataFrame(bad, CHANGE)).collect()
    assert applied(target, spark.createDataFrame([], CHANGE)).isEmpty()


def test_scd2_merge_corrects_on_the_same_day(spark, rows):
    first = op.scd2_merge(dimension(spark), batch(spark, ("B", 21, "Road")), ["product_key"], ["cost"], DAY)
    second = op.scd2_merge(first, batch(spark, ("B", 22, "Road")), ["product_key"], ["cost"], DAY)
    assert rows(second.where("product_key = 'B'"), "cost", "start_date", "is_current") == [
        (20, OLD, False), (22, DAY, True),
    ]


def test_scd2_merge_with_an_old_batch(spark, rows):
    target, source = dimension(spark), batch(spark, ("A", 1, "Road"), ("B", 20, "Road"))
    early = dt.date(2019, 1, 1)
    with pytest.raises(Exception, match="older than a current version"):
        op.scd2_merge(target, source, ["product_key"], ["cost"], early).collect()
    kept = op.scd2_merge(target, source, ["product_key"], ["cost"], early, on_stale="keep")
    assert rows(kept) == rows(target)


def test_scd2_merge_without_broadcast(spark, rows):
    source = batch(spark, ("A", 12, "Road"), ("B", 20, "Road"), ("E", 60, None))
    expected = rows(op.scd2_merge(dimension(spark), source, ["product_key"], ["cost"], DAY))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(op.scd2_merge(dimension(spark), source, ["product_key"], ["cost"], DAY)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_delete_where(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v INT")
    assert [r[0] for r in op.delete_where(df, "v > 1").collect()] == [1, None]
    assert op.delete_where(df, "1 = 1").isEmpty()


def test_snapshot_diff(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d"), (None, "n")], "k INT, v STRING")
    assert rows(op.snapshot_diff(old, new, ["k"])) == [
        ("delete", 3, None), ("insert", 4, "d"), ("update_postimage", 2, "c"), ("update_preimage", 2, "b"),
    ]
    for sides in ((old.union(old), new), (old, new.union(new))):
        with pytest.raises(Exception, match="unique"):
            op.snapshot_diff(*sides, ["k"]).collect()


def test_snapshot_diff_of_other_columns(spark, rows):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k INT, v STRING, gone INT")
    new = spark.createDataFrame([("a", 1, "x"), ("c", 3, None)], "v STRING, k INT, added STRING")
    assert rows(op.snapshot_diff(old, new, ["k"]), "change_type", "k", "v", "gone", "added") == [
        ("delete", 2, "b", 6, None), ("insert", 3, "c", None, None),
        ("update_postimage", 1, "a", None, "x"), ("update_preimage", 1, "a", 5, None),
    ]
    same = op.snapshot_diff(old.drop("gone"), old.drop("gone").select("v", "k"), ["k"])
    assert same.isEmpty()
    assert plan_text(op.snapshot_diff(old, new, ["k"]), "simple").count("Exchange") == 1


# --- star ----------------------------------------------------------------------------------


def test_orphans(spark, rows):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "i INT, c INT")
    customers = spark.createDataFrame([(10, 1)], "c INT, customer_key INT")
    assert rows(op.orphans(facts, customers, ["c"]), "i") == [(2,), (3,)]
    keyed = op.with_dimension_keys(facts, [(customers, {"c": "c"}, "customer_key")])
    assert rows(keyed, "i", "customer_key") == [(1, 1), (2, None), (3, None)]
    assert rows(op.without_orphans(keyed, ["customer_key"]), "i") == [(1,)]


def test_top_groups_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 5), (None, 1)], "g STRING, v INT")
    top = op.top_groups(df, {"g": F.col("g")}, {"total": F.sum("v")}, "total", 3)
    assert [r["g"] for r in top.collect()] == ["c", None, "a"]


def test_counts(spark, rows):
    df = spark.createDataFrame([("x",), ("y",), ("x",)], "g STRING")
    assert [tuple(r) for r in op.group_counts(df, ["g"], "n", ordered=True).collect()] == [("x", 2), ("y", 1)]
    assert rows(op.table_counts({"a": df, "b": df.limit(0)})) == [("a", 3), ("b", 0)]


# --- ranges, key maps, distinct counts ---------------------------------------------------------


def conflicts_by_sweep(ranges):
    """Conflicts of (key, low, high or None), the plain way."""
    out = []
    for key in {r[0] for r in ranges}:
        mine = [r for r in ranges if r[0] == key]
        out += [(key, "inverted", h, lo) for _, lo, h in mine if h is not None and h < lo]
        latest = None
        for _, lo, h in sorted((r for r in mine if r[2] is None or r[2] > r[1]), key=lambda r: (r[1], r[2] is None, r[2] or 0)):
            end = float("inf") if h is None else h
            if latest is not None and lo < latest:
                least = min(end, latest)
                out.append((key, "overlap", lo, None if least == float("inf") else least))
            elif latest is not None and lo > latest:
                out.append((key, "gap", latest, lo))
            latest = end if latest is None else max(latest, end)
    return sorted(out, key=str)


@pytest.mark.parametrize("min_rows", [10, 10**6])
def test_range_conflicts(spark, min_rows):
    dice = random.Random(4)
    ranges = [(dice.choice(["a", "a", "a", "b", None]), lo := dice.randrange(400), dice.choice([None] + [lo + d for d in range(-1, 12)] * 2))
              for _ in range(300)]
    df = spark.createDataFrame([*ranges, ("a", None, 5)], "key STRING, low INT, high INT")
    got = op.range_conflicts(df, ["key"], "low", "high", min_rows=min_rows, chunk_rows=7)
    assert sorted((tuple(r) for r in got.collect()), key=str) == conflicts_by_sweep(ranges)


def test_range_conflicts_of_days(spark, rows):
    def day(d):
        return dt.date(2024, 1, d)

    sound = spark.createDataFrame([("a", day(1), day(4)), ("a", day(5), None), ("b", day(1), day(1))],
                                  "k STRING, start_date DATE, end_date DATE")
    assert op.range_conflicts(sound, ["k"], inclusive=True).isEmpty()
    assert rows(op.range_conflicts(sound, ["k"])) == [("a", "gap", day(4), day(5))]
    assert op.range_conflicts(sound.limit(0), ["k"]).isEmpty()


def test_key_map_keeps_numbers(spark, rows, tmp_path):
    keys = op.KeyMap(spark, ["k"], "number", path=str(tmp_path / "map"))
    with pytest.raises(LookupError):
        keys.number(spark.createDataFrame([("a",)], "k STRING"))
    first = spark.createDataFrame([("m", 3), ("p", 1), (None, 0), ("m", 2)], "k STRING, v INT")
    assert keys.extend(first, ["v"]) == 2
    assert rows(keys.known(), "k", "number") == [("m", 2), ("p", 1)]
    assert keys.extend(first) == 0
    later = spark.createDataFrame([("a", 1), ("m", 9), ("z", 0), (None, 1)], "k STRING, v INT")
    assert keys.extend(later) == 2
    assert rows(keys.number(later), "k", "v", "number") == [(None, 1, None), ("a", 1, 3), ("m", 9, 2), ("z", 0, 4)]
    assert keys.extend(later.limit(0)) == 0


def test_key_map_as_table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS maps")
    for expected in (50, 0):
        assert op.KeyMap(spark, ["id"], "n", table="maps.numbers").extend(spark.range(50)) == expected
    with pytest.raises(ValueError):
        op.KeyMap(spark, ["id"], "n")


def test_distinct_by_bitmap(spark, rows):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 11 > 0, F.col("id") % 70_000).alias("k"),
        F.lit(1).alias("one"),
    )
    got = op.distinct_by_bitmap(df, ["g"], "k", "n", {"one": "rows"})
    assert rows(got) == rows(df.groupBy("g").agg(F.countDistinct("k").alias("n"), F.sum("one").alias("rows")))
    plan = plan_text(got, "simple")
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
