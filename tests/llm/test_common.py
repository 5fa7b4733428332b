from __future__ import annotations

import pyspark.sql.functions as F

from tierhouse.llm import common
from tierhouse.llm.common import possibly_in, shingles, words


def test_filter_keeps_every_wanted_row(spark, monkeypatch):
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 7 != 0, F.col("id")))
    wanted = rows.filter("id % 100 < 2").select(F.col("id").alias("a"), F.col("k").alias("b"))
    passed = possibly_in(rows, ["id", "k"], wanted, ["a", "b"])
    ids = {r.id for r in passed.collect()}
    assert {k for k in range(20_000) if k % 100 < 2} <= ids and len(ids) < 2000
    assert passed.columns == rows.columns
    monkeypatch.setattr(common, "MOST_BITS", 1 << 8)
    assert possibly_in(rows, ["id", "k"], rows.toDF("a", "b"), ["a", "b"]).count() == 20_000
    assert possibly_in(rows, ["id"], wanted.limit(0), ["a"]).count() == 0


def test_words_and_shingles(spark):
    rows = [(" The\tTHE É  x\n",), ("",), (None,), ("one",), ("a b a b a",)]
    found = spark.createDataFrame(rows, "t string").select(
        words(F.col("t")).alias("w"), F.size(shingles(F.col("t"), 2)).alias("two"), F.size(shingles(F.col("t"), 5)).alias("five")
    ).collect()
    assert [tuple(r) for r in found] == [
        (["the", "the", "É", "x"], 3, 1), ([], 0, 0), (None, 0, 0), (["one"], 1, 1), (["a", "b", "a", "b", "a"], 2, 1)
    ]
