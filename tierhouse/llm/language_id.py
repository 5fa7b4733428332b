"""Language identification with error-correcting output codes over byte n-grams.

Each language has a codeword. One binary classifier per bit tells, from the n-grams of a text, the languages with a 1
at that bit from those with a 0. Decoding compares the margins of all bits with every codeword, by a loss that weighs
each bit by how well its classifier tells the languages apart, and takes the codeword with the least loss.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from .common import small_batches

# n-grams are hashed to so many features per length.
FEATURES = 1 << 13
LENGTHS = (1, 2, 3)
UNKNOWN = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")
# A text is ambiguous if its best two codewords get shares closer than this.
CLEAR = 0.1
MOST_LANGUAGES = 512


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed UTF-8 n-grams of all letters of a text, lower-cased, with one space between words."""
    kept = f" {NO_LETTERS.sub(' ', text.lower()).strip()} "
    letters = np.frombuffer(kept.encode(), dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(len(LENGTHS) * FEATURES, dtype=np.float32)
    for k, n in enumerate(LENGTHS):
        size = max(len(letters) - n + 1, 0)
        grams = np.zeros(size, dtype=np.uint32)
        for j in range(n):
            grams = grams * np.uint32(257) + letters[j : j + size]
        slots = (grams * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
        counts[k * FEATURES : (k + 1) * FEATURES] = np.bincount(slots, minlength=FEATURES)
    return counts


def codewords(languages: int) -> np.ndarray:
    """One row of -1 and 1 per language: all different splits for up to 6 languages, else random dense codes.

    Random codes have ten bits per doubling of the languages; of several draws the one with the largest least distance
    is taken. The draw is fixed.
    """
    if languages < 2:
        return np.ones((languages, 1), dtype=np.int8)
    if languages <= 6:
        rest = range(1, languages)
        splits = [c for n in range(1, languages) for c in combinations(rest, n)]
        return np.array([[1 if k in c else -1 for c in splits] for k in range(languages)], dtype=np.int8)
    bits = int(np.ceil(10 * np.log2(languages)))
    rng, best, least = np.random.default_rng(11), None, -1
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), size=(languages, bits))
        code = code[:, np.abs(code.astype(int).sum(axis=0)) < languages]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        np.fill_diagonal(apart, bits)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    """Languages, codewords, bit classifiers and what their bits weigh."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, counts: np.ndarray) -> np.ndarray:
        total = counts[:FEATURES].sum()
        return self.weights @ counts / max(total, 1.0)

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether the runner-up is too close."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = (self.trust * np.log1p(np.exp(-np.clip(4 * self.code * margins, -50, 50)))).sum(axis=1)
        shares = np.exp(-(loss - loss.min()) * 2)
        shares /= shares.sum()
        order = np.argsort(-shares, kind="stable")
        best, second = shares[order[0]], shares[order[1]]
        return self.languages[order[0]], float(best), bool(best - second < CLEAR)

    def predict(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All rows with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

        A text that is NULL or has no letter gets ``und`` with score 0 and counts as ambiguous; so does every text if
        no language was learned. Columns of these names are replaced. Each text counts whole.
        """
        small_batches(docs.sparkSession)
        own = "told" + "_" * max(map(len, docs.columns), default=0)  # longer than any name of the rows
        told = docs.withColumn(own, self.column(F.col(text_col)))
        kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
        return told.select(*kept, F.col(f"{own}.lang").alias("lang_pred"), F.col(f"{own}.score").alias("score"),
                           F.col(f"{own}.ambiguous").alias("ambiguous"))

    def column(self, text: Column) -> Column:
        """Struct of what ``tell`` returns. Filters on it read what was told and do not tell it again.

        Spark copies functions that it takes as deterministic into filters on their results; each copy takes a Python
        worker of its own for every task.
        """
        model = self

        @F.pandas_udf("lang string, score double, ambiguous boolean")
        def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                rows = [model.tell(t) for t in texts]
                yield pd.DataFrame(rows, columns=["lang", "score", "ambiguous"]).astype(
                    {"lang": object, "score": float, "ambiguous": bool}
                )

        return told.asNondeterministic()(text)

    def tell(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        return self.decode(self.margins(ngram_counts(text)))


def _language_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per language and task: its number of documents and their summed n-gram counts."""
    sums: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            counts = ngram_counts(text)
            total = counts[:FEATURES].sum()
            if total <= 0:
                continue
            if lang not in sums:
                sums[lang], docs[lang] = np.zeros_like(counts, dtype=np.float64), 0
            # Long documents count as a hundred n-grams, so that none outweighs the others.
            sums[lang] += counts * (min(total, 100.0) / total)
            docs[lang] += 1
    if sums:
        yield pd.DataFrame(
            {"lang": list(sums), "n": [docs[k] for k in sums], "counts": [sums[k].tobytes() for k in sums]}
        )


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, dtype=np.float64) for c in group["counts"])
    return pd.DataFrame({"lang": [group["lang"].iloc[0]], "n": [group["n"].sum()], "counts": [total.tobytes()]})


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from all rows that have a text and a language.

    The n-grams are counted in the tasks; one vector of fixed length per language reaches the driver. More than
    ``MOST_LANGUAGES`` languages are refused. Bit classifiers are naive Bayes: a weight per n-gram is the logarithm of
    how much likelier it is in the languages with a 1, each language counting alike. A bit's trust is the share of its
    languages' mean vectors that it tells right, weighted by their margins.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    parts = rows.mapInPandas(_language_counts, "lang string, n long, counts binary")
    found = parts.groupBy("lang").applyInPandas(_added, "lang string, n long, counts binary")
    per_language = sorted(found.limit(MOST_LANGUAGES + 1).collect())
    if len(per_language) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r.lang for r in per_language]
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    counts = np.array([np.frombuffer(r.counts, dtype=np.float64) for r in per_language])
    blocks = counts.reshape(len(languages), len(LENGTHS), FEATURES) + 0.5
    chances = (blocks / blocks.sum(axis=2, keepdims=True)).reshape(len(languages), -1)
    code = codewords(len(languages))
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    mean = lambda side: (side.T @ chances) / np.maximum(side.sum(axis=0)[:, None], 1)
    weights = np.log(np.maximum(mean(ones), 1e-12)) - np.log(np.maximum(mean(zeros), 1e-12))
    if len(languages) == 1:
        weights = np.zeros_like(weights)
    told = weights @ chances.T
    right = np.clip(told * code.T, -4, 4)
    trust = np.maximum(right.mean(axis=1), 0.0)
    trust = trust / trust.sum() * len(trust) if trust.sum() > 0 else np.ones(len(trust))
    return Model(languages, code, weights.astype(np.float32), trust)
