"""The pipeline, and stages one by one, against plain Python."""

from __future__ import annotations

import hashlib
from array import array

import pyspark.sql.functions as F
import pytest
from conftest import DATA
from test_near_dedup import brute_force, shingle_set
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tierhouse.llm import near_dedup
from tierhouse.llm.line_dedup import MIN_CHARS, MIN_LINES
from tierhouse.llm.queries import tokenizer_path
from tierhouse.sources import plan_text

SF = str(DATA / "sf0.001")


def plain_line_dedup(docs):
    """(doc_id, text) in order -> doc_id: text, without the lines of any run that stands earlier."""
    seen, out = set(), {}
    for key, text in sorted(docs):
        lines = text.split("\n")
        full = [n for n, x in enumerate(lines) if x.strip(" ")]
        held = [lines[n] for n in full]
        gone = set()
        for i in range(len(held)):
            for n in range(1, MIN_LINES + 1):
                run = tuple(held[i : i + n])
                if len(run) == n and (n == MIN_LINES or sum(map(len, run)) >= MIN_CHARS):
                    if run in seen:
                        gone.update(range(i, i + n))
                    seen.add(run)
        out[key] = "\n".join(x for n, x in enumerate(lines) if n not in {full[g] for g in gone})
    return out


def test_run_is_what_plain_python_makes(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [shingle_set(r.text, 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    spoken = cp.identify_language(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()
    assert len(spoken) >= 0.97 * len(docs)
    assert sum(r.lang == docs[r.doc_id].lang for r in spoken) >= 0.97 * len(spoken)
    texts = plain_line_dedup([(r.doc_id, r.text) for r in spoken])
    texts = {k: t for k, t in texts.items() if t.strip(" ") or t == docs[k].text}
    kept = {k for k, (_, _, stays) in brute_force(list(texts.items()), 5).items() if stays}
    clean = {k for k in kept if not any(q and 100 * len(q & shingle_set(texts[k], 5)) >= 80 * len(q) for q in items)}
    assert 0 < len(clean) < len(kept) < len(texts)
    library = Tokenizer.from_file(tokenizer_path())
    found = {r.doc_id: r for r in cp.run(spark, SF).collect()}
    assert set(found) == clean
    for k, r in found.items():
        ids = library.encode(texts[k], add_special_tokens=False).ids
        assert bytes(r.ids) == array("I", ids).tobytes() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES[:-1]])
def test_stages_keep_the_columns_and_odd_rows(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (900002, "", "en", "s", 0), (None, "The of and the that.", None, None, 3)], docs.schema
    )
    kept = stage(spark, docs.unionByName(odd).unionByName(odd), SF)
    assert kept.schema.names == docs.schema.names
    assert [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    assert kept.filter("doc_id < 900000").count() > 0
    if stage is not cp.identify_language:
        assert kept.filter(F.col("doc_id") > 900000).count() == 4
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_row_of_each_group_stays(spark):
    words = [" ".join(f"w{g}x{k}" for k in range(60)) for g in range(6)]
    near = [w + " end" for w in words]
    rows = [
        (1, words[0], "a"), (1, words[0], "a"), (1, words[0], "b"), (7, near[0], "a"),  # repeated rows of the smallest id
        (2, words[1], "a"), (2, near[1], "a"),  # two near copies under one id
        (None, words[2], "a"), (None, words[2], "a"), (None, near[2], "a"),  # no ids at all
        (None, words[3], "a"), (9, near[3], "a"), (5, words[4], "a"), (6, words[5], "a"), (6, words[5], "a"),
        (8, "", "a"), (8, "", "a"), (None, None, "a"), (None, None, "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    kept = cp.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(r.doc_id or 0 for r in kept if r.text) == [0, 1, 2, 5, 6, 9]
    assert sorted(r.text.split(" ")[0] for r in kept if r.text) == [f"w{g}x0" for g in range(6)]
    assert len([r for r in kept if not r.text]) == 4 and {tuple(r) for r in kept} <= set(rows)


def test_filters_on_results_of_python_take_no_second_worker(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "x", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    pairs = spark.createDataFrame([(1, 2, bytearray(b"abc"), bytearray(b"abd"))], "a long, b long, x binary, y binary")
    near = near_dedup._agreeing(pairs).filter("agreeing >= 2").select("a", "b", "agreeing")
    for told in (cp.identify_language(spark, docs, SF), near):
        assert plan_text(told, "simple").count("ArrowEvalPython ") == 1
    assert [tuple(r) for r in near.collect()] == [(1, 2, 2)]
    assert near_dedup._agreeing(pairs).filter("agreeing >= 3").count() == 0
