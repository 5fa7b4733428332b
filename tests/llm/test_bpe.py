from __future__ import annotations

import json
import random
from array import array

import pyspark.sql.functions as F
import pytest
from tokenizers import Tokenizer as Library

import corpus_pipeline
from tierhouse.llm import bpe
from tierhouse.llm.queries import tokenizer_path
from tierhouse.llm.registry import QUERIES as LLM_QUERIES
from tierhouse.sources import plan_text


@pytest.fixture(scope="module")
def spec():
    with open(tokenizer_path(), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return Library.from_file(tokenizer_path())


def test_same_ids_and_text_as_the_library(spec, library):
    rng, own, labels = random.Random(1), bpe.Tokenizer(spec), bpe.labels_of(json.loads(spec))
    pools = ["abcdefghij", "aab", "the sing", "éüßñ 'sd\u0301", "aA1!?<|>\t\n", "中文ΣİΟ🙂"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    texts += ["<|startoftext|>Hello<|endoftext|> world", "ΟΔΟΣ İstanbul ΣΣ", "it's I'LL", "x" * 5000, "", " ", "<|endoftext|>"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == array("I", ids).tobytes(), text
        assert bpe.decode_ids(labels, own.encode(text)) == library.decode(ids, skip_special_tokens=False)


def tiny(merges):
    """Automaton over the bytes a, b, c with the given merges, and plain BPE by rank."""
    names = ["a", "b", "c"]
    rules = []
    for left, right in merges:
        names.append(left + right)
        rules.append((names.index(left), names.index(right), len(names) - 1))
    return names, bpe.MergeAutomaton(len(names), rules, set()), {(names[a], names[b]): r for r, (a, b, _) in enumerate(rules)}


def merged(word, ranks):
    parts = list(word)
    while True:
        pairs = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not pairs:
            return parts
        k = min(pairs)[1]
        parts[k : k + 2] = ["".join(parts[k : k + 2])]


@pytest.mark.parametrize("merges", [
    [("a", "a")], [("a", "a"), ("aa", "a")], [("a", "b"), ("ab", "a"), ("b", "b")], [("b", "a"), ("a", "a"), ("aa", "ba")],
    [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")][:3], [("a", "a"), ("aa", "aa"), ("b", "aa"), ("c", "b")],
])
def test_paths_are_what_merging_makes(merges):
    names, automaton, ranks = tiny(merges)
    rng = random.Random(7)
    for _ in range(600):
        word = "".join(rng.choice("aabc") for _ in range(rng.randrange(1, 12)))
        paths = [(bpe.START, 0, [])]
        whole = []
        while paths:
            state, at, path = paths.pop()
            if at == len(word):
                whole.append(path)
            for n, name in enumerate(names):
                if word.startswith(name, at) and automaton.follows(state, n):
                    paths.append((n, at + len(name), [*path, name]))
        assert whole == [merged(word, ranks)], word


def test_columns(spark, spec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    codec = bpe.Codec(spark, tokenizer_path())
    rows = [(1, "The cat's hat"), (2, None), (3, ""), (3, ""), (4, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    coded = docs.withColumn("ids", codec.encode(F.col("text"))).withColumn("back", codec.decode(F.col("ids")))
    for r in coded.withColumn("n", bpe.n_tokens(F.col("ids"))).collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (bytes(r.ids), r.back, r.n) == (array("I", ids).tobytes(), library.decode(ids, skip_special_tokens=False), len(ids))
    assert coded.limit(0).collect() == []
    both = docs.select("doc_id", "text", codec.encode_and_decode(F.col("text")).alias("c")).select("doc_id", "text", "c.*")
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, coded.collect()), key=str)
    assert both.limit(0).collect() == []


def test_a_task_needs_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "x", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    for coded in (corpus_pipeline.encode_tokens(spark, docs, ""), LLM_QUERIES["op5_bpe"](spark, "/root/testdata/sf0.001")):
        assert plan_text(coded, "simple").count("ArrowEvalPython ") == 1


def test_ambiguous_merges_are_refused():
    with pytest.raises(ValueError, match="more than one merge"):
        bpe.MergeAutomaton(4, [(0, 1, 3), (1, 2, 3)], set())
