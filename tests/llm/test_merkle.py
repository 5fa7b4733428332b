import hashlib

import pyspark.sql.functions as F
import pytest

from tierhouse.llm import merkle
from tierhouse.llm.ranking import ranked

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
KIND = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for each node the siblings left and right of its path."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    proofs = []
    for place in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            run, k = level[place // 16 * 16 : place // 16 * 16 + 16], place % 16
            proof.append(("".join(run[:k]), "".join(run[k + 1 :])))
            place //= 16
        proofs.append(proof)
    return levels[-1][0], proofs


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0], leaf_of(row)))
    for found in groups.values():
        found.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for _, leaf in groups[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    return sorted(
        (str(i), str(s), leaf, trees[s][0], root, proof + top)
        for s, top in zip(names, tops) for (i, leaf), proof in zip(groups[s], trees[s][1])
    )


def found(df):
    return sorted(
        (str(r.doc_id), str(r.source), r.leaf, r.subroot, r.root, [(x.left, x.right) for x in r.proof]) for r in df.collect()
    )


MIXED = (
    [(i, None if i % 7 == 0 else f"s{i % 3}", "x", i, f"Text {i}") for i in range(900)]
    + [(i, "big", "y", 1, "A") for i in range(4500)]
    + [(None, "one", None, None, None), (5, "", "de", 0, ""), (7, "é", "fr", 3, "Ünïcode")]
    + [(1, "two", "x", None, "same")] * 20
)


def test_manifest_equals_plain_trees(spark):
    got = found(merkle.manifest(spark.createDataFrame(MIXED, KIND), COLUMNS))
    assert got == plain_manifest(MIXED)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257, 4097])
def test_sizes_around_full_runs(spark, count):
    rows = [(i, "s", "x", i, "t") for i in range(count)]
    assert found(merkle.manifest(spark.createDataFrame(rows, KIND), COLUMNS)) == plain_manifest(rows)


def test_proofs_lead_to_the_root_unless_a_row_was_altered(spark):
    df = spark.createDataFrame(MIXED, KIND)
    other = merkle.digest_of([*map(F.col, COLUMNS[:-1]), F.lower("text")])
    got = merkle.manifest(df, COLUMNS, carried={"other": other})
    told = got.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("whole"),
                      (merkle.folded(F.col("other"), F.col("proof")) == F.col("root")).alias("altered"),
                      (F.col("leaf") == F.col("other")).alias("same"))
    assert told.filter("NOT whole").isEmpty()
    assert told.filter("altered <> same").isEmpty() and not told.filter("NOT same").isEmpty()
    row = got.filter("source = 'big' AND doc_id = 3").first()
    texts = [r[0] for r in got.filter("source = 'big' AND doc_id = 3").select(merkle.siblings(F.col("proof"))).collect()]
    assert texts == ["".join(x.left + x.right for x in row.proof)]


def test_empty_table_long_text_and_clashing_columns(spark):
    assert merkle.manifest(spark.createDataFrame([], KIND), COLUMNS).isEmpty()
    rows = [(1, "s", "x", 1, "ab " * 300_000), (2, "s", "x", 1, "b")]
    extra = spark.createDataFrame(rows, KIND).withColumns({n: F.lit(9) for n in ("g", "rank", "block", "item", "digest0", "root")})
    assert found(merkle.manifest(extra, COLUMNS)) == plain_manifest(rows)


def test_ranks_within_groups_of_any_size(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 3001).alias("o"), "id")
    got = ranked(df, "g", ["o"], task_rows=200).toPandas()
    want = got.sort_values("o").groupby("g", dropna=False).cumcount().reindex(got.index)
    assert (got["rank"] == want).all()
