"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

The space has the terms that toxic examples hold more often than clean ones: words and beginnings of words. Inverse
document frequencies come from all documents. Examples are searched with an inverted index whose postings lie in
blocks; a block is read only if the sum of its largest weights can still beat the worst of the k best.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ..operators.staging import materialize
from .common import small_batches

# Labelled documents learned from, of each label at most, by hash order.
EXAMPLES_PER_LABEL = 8192
# Terms of the space at most; least evidence (likelihood ratio) and least number of toxic examples of a term.
TERMS, EVIDENCE, LEAST_EXAMPLES = 4096, 15.0, 3
NEIGHBOURS, BLOCK = 15, 64
# Lengths of the word beginnings that are terms beside whole words.
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in BEGINNINGS if len(word) > n)]


def _example_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Toxic and clean examples of a task that hold each term."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            seen[int(label)].update({t for w in set(WORD.findall(text.lower())) for t in terms_of(w)})
    terms = list(seen[1] | seen[0])
    for k in range(0, len(terms), 50_000):
        part = terms[k : k + 50_000]
        yield pd.DataFrame({"term": part, "toxic": [seen[1][t] for t in part], "clean": [seen[0][t] for t in part]})


class _TermNumbers(dict):
    """Term numbers by word, remembered for the words a task has met."""

    def __init__(self, vocabulary: dict[str, int]) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = tuple(n for t in terms_of(word) if (n := self.vocabulary.get(t)) is not None)
        return found


def vector(text: str | None, numbers: _TermNumbers) -> dict[int, int]:
    """How often each term of the space stands in a text."""
    held: dict[int, int] = {}
    for word, times in Counter(WORD.findall(text.lower())).items() if text else ():
        for n in numbers[word]:
            held[n] = held.get(n, 0) + times
    return held


@dataclass
class BlockMaxIndex:
    """Unit vectors of the examples, their postings in blocks of ``BLOCK`` vectors, and each block's largest weights.

    Examples with equal vectors share one; as ties go to the smaller id, only the first ``NEIGHBOURS + 1`` of them can
    be among the nearest.
    """

    members: list[list[tuple[int, int]]]  # by vector: ids and labels of its examples
    weight: dict[int, float]  # by label: what an example counts in votes
    idf: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]  # by term: vectors and weights
    largest: np.ndarray  # terms x blocks

    @classmethod
    def build(cls, examples: list[tuple], idf: np.ndarray, weight: dict[int, float]) -> BlockMaxIndex:
        """From ``(id, label, term numbers, counts)``. Vectors with the same strongest term are neighbours."""
        same: dict[tuple, list[tuple[int, int]]] = {}
        for key, label, terms, counts in sorted(examples, key=lambda e: e[0]):
            same.setdefault(tuple(sorted(zip(terms, counts, strict=True))), []).append((key, label))
        units = []
        for held, members in same.items():
            terms, counts = np.array(held).T
            w = cls.unit(terms, counts, idf)
            units.append((int(terms[int(np.argmax(w))]), held, members[: NEIGHBOURS + 1], terms, w))
        units.sort(key=lambda u: u[:2])
        largest = np.zeros((len(idf), -(-len(units) // BLOCK)))
        lists: list[list[tuple[int, float]]] = [[] for _ in idf]
        for at, (_, _, _, terms, w) in enumerate(units):
            np.maximum.at(largest, (terms, at // BLOCK), w)
            for t, x in zip(terms.tolist(), w.tolist(), strict=True):
                lists[t].append((at, x))
        postings = [(np.array([h[0] for h in held], dtype=int), np.array([h[1] for h in held])) for held in lists]
        return cls([u[2] for u in units], weight, idf, postings, largest)

    @staticmethod
    def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
        w = (1.0 + np.log(counts)) * idf[terms]
        return w / np.sqrt((w * w).sum())

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS, leave_out: int | None = None
                ) -> list[tuple[float, int, int]]:
        """The k examples with the highest cosine above 0, ties to the smaller id, as (cosine, id, label)."""
        q = self.unit(terms, counts, self.idf)
        bounds = q @ self.largest[terms]
        scores = np.zeros(len(self.members))
        unread = bounds > 0
        read = np.zeros_like(unread)
        # First the two most promising blocks; then all that can beat the worst of the k best found there.
        read[np.argsort(-bounds, kind="stable")[:2]] = True
        for _ in range(2):
            read &= unread
            for t, x in zip(terms, q, strict=True):
                at, w = self.postings[t]
                here = read[at // BLOCK]
                scores[at[here]] += x * w[here]
            unread &= ~read
            wanted = k + (leave_out is not None)
            found = scores[scores > 0]
            worst = np.partition(found, len(found) - wanted)[len(found) - wanted] if len(found) >= wanted else 0.0
            read = bounds >= worst - 1e-9
        best = []
        for at in np.nonzero((scores > 0) & (scores >= worst - 1e-9))[0]:
            cosine = round(float(scores[at]), 12)
            best += [(-cosine, key, label) for key, label in self.members[at] if key != leave_out]
        return [(-c, key, label) for c, key, label in sorted(best)[:k]]

    def vote(self, near: list[tuple[float, int, int]]) -> float:
        """Weighted share of toxic examples; the nearer, the more an example counts."""
        w = np.array([self.weight[label] / (1.05 - min(cosine, 1.0)) for cosine, _, label in near])
        return float((w * np.array([label for _, _, label in near])).sum() / w.sum())


def rising(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[list[float], list[float]]:
    """Votes and the rates of toxic examples at them, made to rise by pooling neighbours that do not."""
    pools: list[list[float]] = []
    for v in np.unique(votes):
        here = votes == v
        pools.append([float(v), float(v), float((weights * labels)[here].sum()), float(weights[here].sum())])
        while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
            _, high, hits, total = pools.pop()
            pools[-1][1:] = [high, pools[-1][2] + hits, pools[-1][3] + total]
    points = [(x, hits / total) for low, high, hits, total in pools for x in dict.fromkeys((low, high))]
    return [p[0] for p in points], [p[1] for p in points]


@dataclass
class Scorer:
    vocabulary: dict[str, int]
    index: BlockMaxIndex | None
    scale: tuple[list[float], list[float]]
    otherwise: float  # the score of a document with no term of the space

    def score(self, terms: list[int], counts: list[int]) -> tuple[float, list[tuple[int, float, int]]]:
        if self.index is None or not len(terms):
            return self.otherwise, []
        near = self.index.nearest(np.asarray(terms), np.asarray(counts))
        if not near:
            return self.otherwise, []
        score = float(np.interp(self.index.vote(near), *self.scale))
        return score, [(key, cosine, label) for cosine, key, label in near[:3]]


def _with_terms(docs: DataFrame, text_col: str, vocabulary: dict[str, int]) -> DataFrame:
    """The rows without the text, with term numbers and counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    @F.pandas_udf("terms array<int>, counts array<int>")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        numbers = _TermNumbers(shared.value)
        for texts in batches:
            found = [vector(t, numbers) for t in texts]
            yield pd.DataFrame({"terms": [list(f) for f in found], "counts": [list(f.values()) for f in found]})

    rest = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row")
    return docs.select(rest, held(F.col(text_col)).alias("held")).select("row", "held.terms", "held.counts")


def choose_terms(examples: DataFrame) -> dict[str, int]:
    """The terms with the most evidence of being commoner in toxic examples. ``examples``: text, label."""
    sizes = {r.label: r["count"] for r in examples.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    toxic, clean = F.col("toxic"), F.col("clean")
    share = (toxic + clean) / (sizes[0] + sizes[1])

    def part(seen, of):
        return F.when(seen > 0, seen * F.log(seen / (share * of))).otherwise(0.0)

    evidence = 2 * (
        part(toxic, sizes[1]) + part(clean, sizes[0])
        + part(sizes[1] - toxic, sizes[1] * (1 - share) / share) + part(sizes[0] - clean, sizes[0] * (1 - share) / share)
    )
    counted = (
        examples.mapInPandas(_example_terms, "term string, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((toxic >= LEAST_EXAMPLES) & (toxic / sizes[1] > 2 * clean / sizes[0]))
        .withColumn("evidence", evidence).filter(F.col("evidence") >= EVIDENCE)
    )
    top = counted.orderBy(F.desc("evidence"), "term").limit(TERMS).select("term").collect()
    return {r.term: k for k, r in enumerate(top)}


def score_toxicity(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    examples_per_label: int = EXAMPLES_PER_LABEL, threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows, without the text, with ``score`` (0 to 1), ``predicted`` (0 or 1) and ``evidence``.

    ``labels`` has an id and a ``label`` (0 or 1); rows with a NULL are left out, and an id with both labels is toxic.
    At most ``examples_per_label`` documents of each label are learned from; this bounds the index that is broadcast.
    Clean examples get the weight that restores the labels' shares. Scores are votes set to the rate of toxic
    examples among those with such a vote, each example judged by the others. A text with no term of the space (an
    empty one and NULL too) gets the rate among such examples; where one label is missing, every text gets the overall
    rate (0.5 without labels). ``evidence`` holds the three nearest examples. Columns of these names are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = (
        labels.select(F.col(id_col).cast("bigint").alias("key"), F.col("label").cast("int").alias("label")).dropna()
        .groupBy("key").agg(F.max("label").alias("label"))
    )
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    order = [F.xxhash64("key"), F.col("key")]
    parts = [known.filter(F.col("label") == y).orderBy(*order).limit(examples_per_label) for y in (0, 1)]
    sample = materialize(parts[0].unionByName(parts[1]), "toxic-sample")
    texts = docs.select(F.col(id_col).cast("bigint").alias("own"), F.col(text_col).alias("text"))
    # The sample has a fixed bound of two longs per example.
    examples = texts.join(F.broadcast(sample), F.col("own") == F.col("key")).select("text", "label").dropna()
    vocabulary = choose_terms(examples)
    held = materialize(_with_terms(docs, text_col, vocabulary), "toxic-terms")
    scorer = _learn(held, sample, vocabulary, totals, id_col)
    shared = spark.sparkContext.broadcast(scorer.__dict__ | {"index": scorer.index and scorer.index.__dict__})

    @F.pandas_udf("score double, evidence array<struct<doc_id: bigint, similarity: double, toxic: int>>")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        state = dict(shared.value)
        state["index"] = state["index"] and BlockMaxIndex(**state["index"])
        own, seen = Scorer(**state), {}
        for terms, counts in batches:
            rows = []
            for t, c in zip(terms, counts, strict=True):
                key = (tuple(t), tuple(c))
                if key not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    seen[key] = own.score(*key)
                rows.append(seen[key])
            yield pd.DataFrame(
                {"score": [r[0] for r in rows],
                 "evidence": [[{"doc_id": i, "similarity": s, "toxic": y} for i, s, y in r[1]] for r in rows]}
            )

    names = [c for c in docs.columns if c not in (text_col, "score", "predicted", "evidence")]
    told = held.select("row", scored(F.col("terms"), F.col("counts")).alias("told"))
    return told.select(
        *(F.col("row").getField(c).alias(c) for c in names), F.col("told.score").alias("score"),
        (F.col("told.score") >= threshold).cast("int").alias("predicted"), F.col("told.evidence").alias("evidence"),
    )


def _learn(held: DataFrame, sample: DataFrame, vocabulary: dict[str, int], totals: dict[int, int],
           id_col: str) -> Scorer:
    overall = totals.get(1, 0) / sum(totals.values()) if totals else 0.5
    if not vocabulary:
        return Scorer({}, None, ([0.0], [overall]), overall)
    stated = held.agg(F.count("*").alias("n")).first().n
    frequency = np.zeros(len(vocabulary))
    for r in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term
        frequency[r.term] = r["count"]
    idf = np.log((1 + stated) / (1 + frequency)) + 1e-3
    key = F.col("row").getField(id_col).cast("bigint")
    rows = (
        held.select(key.alias("own"), "terms", "counts")
        .join(F.broadcast(sample), F.col("own") == F.col("key")).select("key", "label", "terms", "counts").collect()
    )
    sizes = Counter(r.label for r in rows)
    weight = {y: totals[y] / sizes[y] for y in sizes}
    index = BlockMaxIndex.build([(r.key, r.label, r.terms, r.counts) for r in rows if r.terms], idf, weight)
    none = [r.label for r in rows if not r.terms]
    blank = sum(weight[y] for y in none)
    # One example's weight of the overall rate, for the case that there are few.
    otherwise = (sum(weight[y] * y for y in none) + overall) / (blank + 1)
    votes, toxic, weights = [], [], []
    for r in rows:
        near = r.terms and index.nearest(np.asarray(r.terms), np.asarray(r.counts), leave_out=r.key)
        if near:
            votes.append(index.vote(near))
            toxic.append(r.label)
            weights.append(weight[r.label])
    scale = rising(np.array(votes), np.array(toxic), np.array(weights)) if votes else ([0.0], [overall])
    return Scorer(vocabulary, index, scale, otherwise)
