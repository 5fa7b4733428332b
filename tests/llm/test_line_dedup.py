from __future__ import annotations

import random

import pytest
from test_pipeline import plain_line_dedup

from tierhouse.llm import line_dedup
from tierhouse.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string"
LONG = "a line that is long enough to be a window of its own, with more than sixty characters"


def deduped(spark, rows, **options):
    return {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, SCHEMA), **options).collect()}


def test_long_lines_go_alone_and_short_ones_in_runs(spark):
    rows = [(1, f"a\nb\nc\n{LONG}\nz"), (2, f"x\na\nb\nc\ny\n{LONG}"), (3, "a\nb\nq"), (4, f"z\n\n{LONG}\nz")]
    found = deduped(spark, rows)
    assert found == {1: rows[0][1], 2: "x\ny", 3: "a\nb\nq", 4: "z\n"}


def test_every_earlier_place_counts(spark):
    """A run is looked for at all its earlier places, not only where its first line stands first."""
    tail = f"{LONG}\nshort tail"
    assert deduped(spark, [(1, LONG), (2, tail), (3, tail)]) == {1: LONG, 2: "short tail", 3: ""}
    rows = [(1, f"{LONG}\nx"), (2, f"{LONG}\ny\nz"), (3, f"w\n{LONG}\ny\nz\nv"), (4, f"y\nz\nv\n{LONG}\nx")]
    assert deduped(spark, rows) == {1: rows[0][1], 2: "y\nz", 3: "w\nv", 4: ""}


def test_only_runs_around_repeated_fingerprints_go_on(spark, monkeypatch):
    """Lines that stand once are dropped by the selected positions alone."""
    written = {}
    whole = line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda df, label: written.setdefault(label, whole(df, label)))
    rows = [(k, "\n".join(f"{LONG} {k} {n}" for n in range(50))) for k in range(40)] + [(99, f"{LONG} 7 7\nend")]
    assert deduped(spark, rows)[99] == "end"
    assert written["fingerprints"].count() == 1 and written["runs"].count() < 40


def test_repeats_within_a_document(spark):
    assert deduped(spark, [(1, "\n".join([LONG] * 5)), (2, "a\nb\nc\na\nb\nc\na\nb\nc")]) == {1: LONG, 2: "a\nb\nc"}


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_plain_python(spark, seed):
    rng = random.Random(seed)
    pool = ["a", "b", "cc", "d" * 20, "e" * 35, "f" * 70, "", "  "]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for k in range(150)]
    assert deduped(spark, rows) == plain_line_dedup(rows)


def test_odd_rows(spark):
    rows = [(None, LONG), (1, LONG), (1, LONG), (2, None), (3, ""), (4, "\n"), (1, "other")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, gone int")
    found = sorted(((r.doc_id, r.text, r.n_removed) for r in dedup_lines(docs).collect()), key=str)
    assert found == sorted([(None, LONG, 0), (1, "", 1), (1, "", 1), (2, None, 0), (3, "", 0), (4, "\n", 0),
                            (1, "other", 0)], key=str)
    assert dedup_lines(docs).columns == ["doc_id", "text", "gone", "n_lines", "n_removed"]
    assert dedup_lines(docs.limit(0)).collect() == []


def test_very_long_document(spark):
    lines = [f"line number {k} of a very long document with many words in it and so on" for k in range(5000)]
    found = deduped(spark, [(1, "\n".join(lines)), (2, "\n".join(lines[::-1])), (3, "\n".join([*lines, "new"]))])
    assert found == {1: "\n".join(lines), 2: "", 3: "new"}
