"""Repeated runs of lines, found by winnowing line hashes.

A run of lines counts if it has ``min_lines`` lines or ``min_chars`` characters. Its fingerprint is the smallest line hash
in it (the last one of equal hashes). Equal runs choose the same fingerprint at the same place, so a run can only stand
twice if its fingerprint is selected twice: the selected positions are counted by hash first, and only runs around
hashes that are selected more than once go on. These are joined with the first place of the same lines, and the lines of
all later places are deleted. Runs of up to ``min_lines`` lines on both sides of a fingerprint are looked at, each with
all its earlier places, so that longer matches are covered whole, to their first and last line.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ..operators.staging import materialize
from .common import all_equal, bound, packed, possibly_in, text_hash, unpacked

MIN_LINES, MIN_CHARS = 3, 60


def _lines(text: Column) -> Column:
    """Lines that are not blank: two hashes and the length of each."""
    each = F.transform(
        F.split(text, "\n", -1),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"), F.length(x).alias("c"),
            (F.trim(x) == "").alias("blank"),
        ),
    )
    return F.filter(each, lambda x: ~x["blank"])


def _runs(lines: Column, min_lines: int, min_chars: int) -> Column:
    """The runs that count: first line, number of lines, position and hash of the fingerprint, and a hash of the lines.

    Left out are runs of which both ends can be cut off so that what is left still counts: their lines are all in
    shorter runs.
    """

    def chars(i: Column, low: int, high: int) -> Column:
        return sum((F.get(lines, i + F.lit(k))["c"] for k in range(low, high)), F.lit(0))

    def from_line(i: Column) -> Column:
        found = []
        for n in range(1, min_lines + 1):
            counts = i + F.lit(n) <= F.size(lines)
            if n < min_lines:
                counts = counts & (chars(i, 0, n) >= min_chars)
            if n > 1:
                counts = counts & ~((chars(i, 0, n - 1) >= min_chars) & (chars(i, 1, n) >= min_chars))
            found.append(F.when(counts, F.lit(n)))
        return F.transform(F.array_compact(F.array(*found)), lambda n: F.struct(i.alias("i"), n.alias("n")))

    def described(run: Column) -> Column:
        part = F.slice(lines, run["i"] + F.lit(1), run["n"])
        lowest = F.array_min(F.transform(part, lambda x, j: F.struct(x["a"].alias("a"), (-j).alias("back"))))
        return F.struct(
            run["i"].alias("i"), run["n"].alias("n"), (run["i"] - lowest["back"]).alias("at"),
            lowest["a"].alias("fingerprint"),
            F.xxhash64(lowest["back"], F.transform(part, lambda x: x["b"])).alias("content"),
        )

    starts = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1))
    return F.transform(F.flatten(F.transform(starts, from_line)), described)


def repeated_lines(docs: DataFrame, min_lines: int, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """Numbers (from 0, blank lines not counted) of the lines to delete: ``id, hash, gone`` per document with any."""
    runs = bound(_lines(F.col(text_col)), lambda lines: _runs(lines, min_lines, min_chars))
    cut = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("hash"), runs.alias("runs"))
    selected = F.array_distinct(F.transform("runs", lambda r: F.struct(r["at"].alias("at"), r["fingerprint"].alias("f"))))
    twice = materialize(
        cut.select(F.explode(selected).alias("s")).groupBy("s.f").agg(F.count("*").alias("n")).filter("n > 1").select("f"),
        "fingerprints",
    )
    each = cut.select("id", "hash", F.explode("runs").alias("r")).select("id", "hash", "r.*")
    able = possibly_in(each, ["fingerprint"], twice, ["f"])
    windows = materialize(able.drop("at"), "runs")
    place = F.struct("id", "hash", "i")
    key = ["fingerprint", "content", "n"]
    repeated = windows.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    first = repeated.select(*[F.col(k).alias(f"own_{k}") for k in key], "first")
    met = windows.join(first, all_equal([F.col(k) for k in key], [F.col(f"own_{k}") for k in key]))
    later = met.filter(place > F.col("first"))
    spans = later.select("id", "hash", F.sequence(F.col("i"), F.col("i") + F.col("n") - 1).alias("span"))
    return spans.groupBy("id", "hash").agg(F.array_distinct(F.flatten(F.collect_list("span"))).alias("gone"))


def dedup_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Delete every line of a run that stands earlier in the corpus too.

    Returns all columns with the shortened text, and ``n_lines`` and ``n_removed``, which replace columns of these
    names. Lines end at ``\\n``. Documents are ordered by id (NULL first), then by a hash of the text; lines by their
    place, and compared as they stand in the given texts. A run has at least ``min_lines`` lines or ``min_chars``
    characters; blank lines (spaces at most) are no part of any, match nothing and stay. Rows equal in id and text count as one document and get the same result. A NULL text
    stays NULL with 0 lines; an empty one stays empty. An empty table gives an empty one.
    """
    gone = repeated_lines(docs, min_lines, min_chars, id_col, text_col)
    text = F.col("row").getField(text_col)
    rows = docs.select(packed(docs), F.col(id_col).alias("own_id"), text_hash(F.col(text_col)).alias("own_hash"))
    joined = rows.join(gone, all_equal([F.col("own_id"), F.col("own_hash")], [F.col("id"), F.col("hash")]), "left")

    def shortened(lines: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        filled = F.filter(every, lambda p: F.trim(F.get(lines, p)) != "")
        dropped = bound(filled, lambda numbers: F.transform("gone", lambda k: F.get(numbers, k)))
        return F.array_join(F.transform(F.array_except(every, dropped), lambda p: F.get(lines, p)), "\n")

    lines = F.split(text, "\n", -1)
    return unpacked(
        joined,
        docs.columns,
        replaced={
            text_col: F.when(F.col("gone").isNull(), text).otherwise(bound(lines, shortened)),
            "n_lines": F.coalesce(F.when(text.isNotNull(), F.size(lines)), F.lit(0)),
            "n_removed": F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)),
        },
    )
