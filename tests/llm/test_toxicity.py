from __future__ import annotations

import random

import numpy as np
import pytest

from tierhouse.llm import toxicity
from tierhouse.llm.toxicity import BlockMaxIndex, rising, score_toxicity


def brute_force(examples, idf, terms, counts, k, leave_out=None):
    def vector(t, c):
        v = np.zeros(len(idf))
        v[np.asarray(t)] = (1 + np.log(np.asarray(c))) * idf[np.asarray(t)]
        return v / np.linalg.norm(v)

    q = vector(terms, counts)
    every = [(-round(float(q @ vector(t, c)), 12), key, label) for key, label, t, c in examples if key != leave_out]
    return [(-s, key, label) for s, key, label in sorted(every) if s < 0][:k]


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_the_same_neighbours_as_all_pairs(seed):
    rng = random.Random(seed)
    idf = np.array([rng.uniform(0.1, 5) for _ in range(40)])

    def held():
        terms = rng.sample(range(40), rng.choice([1, 1, 2, 5, 9]))
        return terms, [rng.choice([1, 1, 2, 7]) for _ in terms]

    examples = [(key, rng.randrange(2), *held()) for key in rng.sample(range(10_000), 900)]
    index = BlockMaxIndex.build(examples, idf, {0: 3.0, 1: 1.0})
    for _ in range(150):
        q = held()
        found = index.nearest(np.array(q[0]), np.array(q[1]))
        expected = brute_force(examples, idf, *q, toxicity.NEIGHBOURS)
        assert [f[1:] for f in found] == [e[1:] for e in expected]
        assert np.allclose([f[0] for f in found], [e[0] for e in expected])
    for key, _, terms, counts in examples[:60]:
        found = index.nearest(np.array(terms), np.array(counts), leave_out=key)
        expected = brute_force(examples, idf, terms, counts, toxicity.NEIGHBOURS, leave_out=key)
        assert [f[1] for f in found] == [e[1] for e in expected]


def test_rates_rise_with_votes():
    x, y = rising(np.array([0.1, 0.1, 0.2, 0.3, 0.9]), np.array([0, 1, 0, 1, 1]), np.ones(5))
    assert x == sorted(x) and y == sorted(y) and y[-1] == 1.0 and y[0] == pytest.approx(1 / 3)


def corpus():
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("alo", "emi", "iru", "ona")]
    rows, labels = [], []
    for key in range(400):
        text = [rng.choice(words) for _ in range(30)]
        toxic = key % 8 == 0
        if toxic:
            text[rng.randrange(30)] = rng.choice(["vilewort", "grobian", "grobianly"])
        rows.append((key, " ".join(text), key))
        if key % 3:
            labels.append((key, int(toxic)))
    return rows, labels


def test_toxic_documents_get_high_scores(spark):
    rows, labels = corpus()
    odd = [(1000, "", 1), (1001, None, 1), (1002, "Grobian! " * 4000, 1), (None, "grobian", 1), (5, rows[5][1], 1)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score int")
    known = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, label int")
    found = score_toxicity(docs, known).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    by_id = {r.doc_id: r for r in found}
    unseen = [r for r in found if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 3 == 0]
    assert sum(r.predicted == int(r.doc_id % 8 == 0) for r in unseen) >= 0.97 * len(unseen)
    assert by_id[1002].predicted == 1 and by_id[None].predicted == 1
    assert by_id[1000].score == by_id[1001].score < 0.3 and by_id[1000].evidence == []
    assert {e.toxic for e in by_id[1002].evidence} == {1}


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_without_both_labels(spark, labels, score):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    found = score_toxicity(docs, spark.createDataFrame(labels, "doc_id long, label int")).collect()
    assert [r.score for r in found] == [score, score]


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score_toxicity(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")).collect() == []
