from __future__ import annotations

import math

import numpy as np
import pytest

from tierhouse.llm.sharding import communication_matrix, hypergeometric, shuffle_into_shards

SCHEMA = "doc_id long, shard string"


def test_hypergeometric_law():
    rng = np.random.default_rng(0)
    drawn = [hypergeometric(rng, 7, 5, 6) for _ in range(6000)]
    for k in range(1, 7):
        chance = math.comb(7, k) * math.comb(5, 6 - k) / math.comb(12, 6)
        assert abs(drawn.count(k) / 6000 - chance) < 0.025
    huge = [hypergeometric(rng, 6 * 10**10, 3 * 10**10, 9 * 10**9) for _ in range(60)]
    assert abs(np.mean(huge) - 6 * 10**9) < 60_000 and 10_000 < np.std(huge) < 100_000
    assert hypergeometric(rng, 0, 9, 4) == 0 and hypergeometric(rng, 5, 0, 4) == 4 and hypergeometric(rng, 3, 3, 6) == 3


def test_matrix_has_the_right_sums():
    matrix = np.array(communication_matrix([5, 0, 90, 13], [36, 36, 36], 3))
    assert matrix.sum(axis=1).tolist() == [5, 0, 90, 13] and matrix.sum(axis=0).tolist() == [36, 36, 36]
    with pytest.raises(ValueError, match="equally many"):
        communication_matrix([1], [2], 0)


@pytest.mark.parametrize("bucket_rows", [50_000, 20])
def test_exact_sizes_and_gapless_slots(spark, bucket_rows):
    rows = [(k, "x") for k in range(1003)] + [(None, None)] * 300
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = shuffle_into_shards(docs, 7, seed=1, bucket_rows=bucket_rows).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == sorted((r[0] is None, r[0] or 0) for r in rows)
    slots = [sorted(r.slot for r in found if r.shard == s) for s in range(7)]
    assert all(s == list(range(len(s))) for s in slots) and {len(s) for s in slots} == {186, 187}


def test_every_place_is_as_likely(spark):
    """Where rows go must not depend on where they came from."""
    docs = spark.range(4000).withColumnRenamed("id", "doc_id").coalesce(4)
    found = shuffle_into_shards(docs, 4, seed=5).collect()
    table = np.zeros((4, 4))
    for r in found:
        table[r.doc_id // 1000, r.shard] += 1
    assert ((table - 250) ** 2 / 250).sum() < 28  # 9 degrees of freedom, chance below 0.001
    order = np.array([r.slot for r in sorted(found, key=lambda r: r.doc_id) if r.shard == 0])
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.12


def test_empty_and_few_rows(spark):
    assert shuffle_into_shards(spark.createDataFrame([], SCHEMA), 4).collect() == []
    found = shuffle_into_shards(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), 16).collect()
    assert {r.slot for r in found} == {0} and len({r.shard for r in found}) == 2


def test_columns_of_the_same_names_are_replaced(spark):
    docs = spark.createDataFrame([(k, 77, 88, 99, "p") for k in range(20)], "doc_id long, slot int, shard int, place int, part string")
    found = shuffle_into_shards(docs, 4, seed=3)
    assert found.columns == ["doc_id", "place", "part", "shard", "slot"]
    rows = found.collect()
    assert {r.place for r in rows} == {99} and sorted(r.slot for r in rows) == sorted(list(range(5)) * 4)
