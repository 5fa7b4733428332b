from __future__ import annotations

import random

import numpy as np
import pytest
from test_near_dedup import shingle_set

from tierhouse.llm import decontamination
from tierhouse.llm.decontamination import contained_items, decontaminate, in_signature

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]

    def prose(n):
        return [rng.choice(vocab) for _ in range(n)]

    items = [prose(n) for n in (5, 6, 9, 12, 25, 40, 70) for _ in range(4)] + [prose(3), []]
    docs = []
    for k in range(120):
        words = prose(rng.choice([10, 60, 500, 4000]))
        if k % 2:
            held = list(rng.choice(items))
            for _ in range(rng.choice([0, 0, 1, 2])):
                if held:
                    held[rng.randrange(len(held))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = held
        docs.append((k, " ".join(words)))
    docs += [(500, None), (501, ""), (502, " ".join(items[-2]).upper()), (503, "w1")]
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)] + [(90, None)]


def brute_force(docs, items):
    found = set()
    for i, item in items:
        q = shingle_set(item, 5)
        for d, text in docs:
            common = len(q & shingle_set(text, 5))
            if q and 100 * common >= 80 * len(q):
                found.add((d, i, len(q), common))
    return found


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bits", [1 << 26, 1 << 15])
def test_same_pairs_as_brute_force(spark, monkeypatch, seed, bits):
    """Also with a filter that many other shingles pass."""
    monkeypatch.setattr(decontamination, "FILTER_BITS", bits)
    docs, items = corpus(seed)
    found = contained_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    expected = brute_force(docs, items)
    assert {tuple(r) for r in found} == expected and len(found) == len(expected) > 30


def test_clean_documents_stay(spark):
    docs, items = corpus(3)
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    kept = {r.doc_id for r in decontaminate(*frames).collect()}
    assert kept == {d for d, _ in docs} - {r[0] for r in brute_force(docs, items)}


def test_odd_rows(spark):
    item = "one two three four five six"
    rows = [(1, f"x {item} y", 5), (1, f"x {item} y", 5), (None, item, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, item), (1, item), (None, item)], ITEMS)
    assert contained_items(docs, items).count() == 9
    assert contained_items(docs, items.limit(0)).collect() == []
    assert contained_items(docs.limit(0), items).collect() == []
    assert decontaminate(docs, items).collect() == []
    assert decontaminate(docs, items.limit(0)).columns == docs.columns


def test_bins_keep_most_shingles():
    items = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    kept = in_signature(items, np.arange(5000))
    assert 0.92 < kept.mean() < 0.98
    assert in_signature(items[:1], np.array([0])).all()
