from __future__ import annotations

import random

import numpy as np
import pyspark.sql.functions as F
import pytest

from tierhouse.llm import near_dedup
from tierhouse.llm.components import components
from tierhouse.llm.near_dedup import near_duplicates, signatures

SCHEMA = "doc_id long, text string"


def shingle_set(text, width):
    found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if len(found) < width:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1))


def brute_force(rows, width):
    """doc_id -> (n, component, kept) by all pairs."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def mutated(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 80, 200]))]
        for _ in range(rng.choice([1, 4, 25])):
            rows.append(mutated(rng, base, rng.randrange(0, max(2, len(base) // 12))))
    rows += ["", None, "   \n", "one", "ONE", "one two", "one  two", rows[0], rows[5]]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [2, 5])
def test_same_components_as_all_pairs(spark, width):
    rows = corpus(width)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), width=width).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_force(rows, width)
    assert len(found) == len(rows)


@pytest.mark.parametrize("idle", [1, 3])
def test_later_rounds_make_up_for_earlier_ones(spark, monkeypatch, idle):
    """Where the first rounds find no link, the later ones connect everything but what only a leader connects."""
    rows = corpus(9)
    verified, calls = near_dedup._Search._verified, []

    def later_only(self, pairs):
        calls.append(pairs)
        return verified(self, pairs.limit(0) if len(calls) <= idle else pairs)

    monkeypatch.setattr(near_dedup._Search, "_verified", later_only)
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), width=2).collect()
    exact = brute_force(rows, 2)
    assert len(calls) == 3
    assert len({r.component_id for r in found}) < len({r[0] for r in rows}) - 20
    assert all(exact[r.component_id][1] == exact[r.doc_id][1] for r in found)


def test_odd_rows(spark):
    rows = [(1, "a b c", "s", 1), (1, "a b c", "s", 1), (None, "a b c", None, 2), (2, None, None, None), (3, "a b d", "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, node int")
    found = {(r.doc_id, r.text, r.component_id, r.kept) for r in near_duplicates(docs, width=2).collect()}
    assert found == {(1, "a b c", 1, True), (None, "a b c", 1, False), (2, None, 2, True), (3, "a b d", 3, True)}
    assert near_duplicates(docs).count() == 5
    assert near_duplicates(docs).columns == [*docs.columns, "n_shingles", "component_id", "kept"]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(5)
    items = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = items[:2000], items[1000:]
    both = signatures(np.concatenate((a, b)), np.array([0, 2000, 4000]))
    assert abs((both[0] == both[1]).mean() - 1 / 3) < 0.1
    small = signatures(np.concatenate((items[:9], items[:10])), np.array([0, 9, 19]))
    assert (small < near_dedup.REGISTERS).all()
    assert 0.75 < (small[0] == small[1]).mean() <= 1


def test_signature_does_not_depend_on_chunks(monkeypatch):
    items = np.random.default_rng(6).integers(0, 2**63, 5000, dtype=np.uint64)
    ends = np.array([0, 0, 10, 3000, 3001, 5000])
    whole = signatures(items, ends)
    monkeypatch.setattr(near_dedup, "CHUNK", 700)
    assert (signatures(items, ends) == whole).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(300, 500)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(120)]
    edges += [(1000, k) for k in range(1001, 1200)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a long, b long").repartition(7)
    found = components(frame).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.label for r in found} == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(frame.filter(F.lit(False))).collect() == []
