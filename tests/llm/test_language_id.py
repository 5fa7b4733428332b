from __future__ import annotations

import random

import numpy as np
import pytest

from tierhouse.llm.language_id import Model, codewords, fit

SYLLABLES = {"aa": "ka po ri tu", "bb": "sch ein ung ach", "cc": "eau oir ètre ment", "dd": "ión ñar lle ado",
             "ee": "щи на ло ве", "ff": "ij oe aar sch", "gg": "ó ść prz ni"}


def text(rng, lang, words=40):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.mark.parametrize("count", [1, 2, 3, 7])
def test_held_out_texts(spark, count):
    rng, langs = random.Random(count), sorted(SYLLABLES)[:count]
    train = [(text(rng, x), x) for x in langs for _ in range(20)] + [(None, "aa"), ("zz", None)]
    model = fit(spark.createDataFrame(train, "text string, lang string"))
    asked = [(k, text(rng, x, 12), x) for k, x in enumerate(langs * 10)]
    found = model.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string")).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_texts(spark):
    rng = random.Random(0)
    model = fit(spark.createDataFrame([(text(rng, x), x) for x in ("aa", "bb") for _ in range(9)], "text string, lang string"))
    rows = [(1, None), (1, None), (2, ""), (3, "123 -- \n"), (4, text(rng, "bb", 60_000)), (None, "einung")]
    found = model.predict(spark.createDataFrame(rows, "score long, text string")).collect()
    assert sorted((r.lang_pred, r.ambiguous) for r in found) == [("bb", False)] * 2 + [("und", True)] * 4
    assert model.predict(spark.createDataFrame([], "text string")).collect() == []
    clash = spark.createDataFrame([(1, "x", text(rng, "bb"))], "__told int, told____ string, text string")
    assert [(r["__told"], r["told____"], r.lang_pred) for r in model.predict(clash).collect()] == [(1, "x", "bb")]
    none = fit(spark.createDataFrame([], "text string, lang string"))
    assert none.tell("abc") == ("und", 0.0, True)


@pytest.mark.parametrize("languages, least", [(2, 1), (4, 4), (6, 16), (7, 8), (40, 12)])
def test_codewords_are_apart(languages, least):
    code = codewords(languages).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2
    assert len(code) == languages and (apart + np.eye(languages, dtype=int) * 999).min() >= least


def test_wrong_bits_are_corrected():
    code = codewords(4)
    model = Model(["p", "q", "r", "s"], code, np.zeros((7, 3)), np.ones(7))
    for k, name in enumerate(model.languages):
        bits = code[k].astype(float)
        bits[2] *= -1
        assert model.decode(bits)[0] == name
    assert model.decode(np.zeros(7))[2]
