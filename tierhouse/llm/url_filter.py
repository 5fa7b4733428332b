"""Block decisions for URLs: given rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

import pyspark.sql.functions as F
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame

from ..operators.staging import materialize
from .common import ascii_lower, packed, unpacked

# Most distinct labelled URLs of each label that the trees are trained on, by hash order.
TRAIN_ROWS = 200_000
# Weight of the overall rate in a suffix's rate, in rows.
PRIOR_ROWS = 20.0

FEATURES = [
    "length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio", "hyphens",
    "entropy", "host_entropy", "parameters", "fragment", "secure", "longest_label", "top_rate", "extension_rate",
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without ``://``."""
    return F.when(url.contains("://"), ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """From the end of the host to the next ``?``, ``#`` or end; empty without ``://``."""
    path = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    return F.when(url.contains("://"), path).otherwise("")


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule ``(verdict, host, path)`` whose host is the URL's or a parent of it and whose path begins the
    URL's, as a struct of ``rule`` (host and path) and ``verdict``; NULL if none fits."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, on, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(on + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for an empty text."""
    size = F.length(text).cast("double")
    letters = F.array_distinct(F.split(text, ""))

    def bits(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -share * F.log2(share)

    total = F.aggregate(F.filter(letters, lambda c: c != ""), F.lit(0.0), lambda acc, c: acc + bits(c))
    return F.when(size > 0, total).otherwise(0.0)


def _share(text: Column, pattern: str) -> Column:
    size = F.length(text)
    return F.when(size > 0, F.regexp_count(text, F.lit(pattern)) / size).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "host_depth": F.size(F.split(host, r"\.")), "path_depth": F.size(F.split(path, "/")),
        "digit_ratio": _share(url, "[0-9]"), "host_digit_ratio": _share(host, "[0-9]"),
        "hyphens": F.regexp_count(host, F.lit("-")),
        "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "fragment": url.contains("#").cast("int"), "secure": url.startswith("https").cast("int"),
        "longest_label": F.array_max(F.transform(F.split(host, r"\."), F.length)),
        "top": F.substring_index(host, ".", -1), "extension": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    }


def _rates(labelled: DataFrame, suffix: str, overall: float) -> DataFrame:
    blocked = F.sum(F.col("label") * F.col("weight"))
    rate = (blocked + F.lit(PRIOR_ROWS * overall)) / (F.sum("weight") + F.lit(PRIOR_ROWS))
    return materialize(
        labelled.groupBy(F.col(suffix).alias(f"{suffix}_key")).agg(rate.alias(f"{suffix}_rate")), f"{suffix}-rates"
    )


def _with_rates(urls: DataFrame, rates: dict[str, DataFrame], overall: float) -> DataFrame:
    for suffix, rate in rates.items():
        urls = urls.join(rate, urls[suffix] == rate[f"{suffix}_key"], "left").drop(f"{suffix}_key")
    return urls.fillna(overall, [f"{s}_rate" for s in rates])


def _assembled(urls: DataFrame) -> DataFrame:
    doubles = urls.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(doubles)


def train(labelled: DataFrame, rates: dict[str, DataFrame], overall: float, train_rows: int) -> GBTClassificationModel:
    """Trees from the distinct URLs with a rule's verdict, at most ``train_rows`` of each label.

    A URL weighs as many rows as it has, and the labels keep their shares of all labelled rows.
    """
    order = [F.xxhash64("url"), F.col("url")]
    parts = [labelled.filter(F.col("label") == y).orderBy(*order).limit(train_rows) for y in (0, 1)]
    sample = _with_rates(parts[0].unionByName(parts[1]), rates, overall).select("label", "weight", *FEATURES)
    ready = materialize(sample, "url-sample")
    all_rows, taken = (
        {r.label: r.weight for r in df.groupBy("label").agg(F.sum("weight").alias("weight")).collect()}
        for df in (labelled, ready)
    )
    share = F.when(F.col("label") == 1, all_rows[1] / taken[1]).otherwise(all_rows[0] / taken[0])
    trees = GBTClassifier(
        labelCol="label", weightCol="weight", maxIter=10, maxDepth=3, stepSize=0.3, maxBins=32, seed=7
    )
    return trees.fit(_assembled(ready).select(
        "features", F.col("label").cast("double").alias("label"), (F.col("weight") * share).alias("weight")
    ))


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url", train_rows: int = TRAIN_ROWS
) -> DataFrame:
    """All rows with ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``verdict_by`` (rule or method).

    Rules label the URLs that they fit. Trees learn from these what a blocked URL looks like and judge the others;
    rates of blocked URLs by top domain and file extension, over all labelled URLs, are among the features. Where the
    labelled URLs hold one verdict only, the others get that verdict; without labelled URLs they are allowed. A NULL
    URL, or one without ``://``, has an empty host and path, fits no rule and is judged like the others. Equal URLs
    get equal verdicts. Columns with the names of results are replaced; an empty table gives an empty result.
    """
    url = F.col(url_col)
    host, path = host_of(F.coalesce(url, F.lit(""))), path_of(F.coalesce(url, F.lit("")))
    split = pages.select(packed(pages), url.alias("url"), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    traits = lexical(F.col("url"), F.col("host"), F.col("path"))
    labelled = materialize(
        ruled.filter(F.col("found").isNotNull())
        .groupBy("url", "host", "path", (F.col("found.verdict") == "block").cast("int").alias("label"))
        .agg(F.count("*").cast("double").alias("weight"))
        .select("url", "label", "weight", *(c.alias(n) for n, c in traits.items())),
        "labelled-urls",
    )
    blocked, known = labelled.agg(
        F.coalesce(F.sum(F.col("label") * F.col("weight")), F.lit(0.0)), F.coalesce(F.sum("weight"), F.lit(0.0))
    ).first()
    results = {
        "host": F.col("host"), "path": F.col("path"), "rule": F.col("found.rule"),
        "verdict_by": F.when(F.col("found").isNotNull(), "rule").otherwise("method"),
    }
    if blocked in (0, known):
        other = F.lit("block" if blocked else "allow")
        return unpacked(ruled, pages.columns,
                        replaced=results | {"verdict": F.coalesce(F.col("found.verdict"), other)})
    overall = blocked / known
    rates = {suffix: _rates(labelled, suffix, overall) for suffix in ("top", "extension")}
    model = train(labelled, rates, overall, train_rows)
    rest = _with_rates(ruled.withColumns(traits), rates, overall)
    told = model.transform(_assembled(rest))
    verdict = F.coalesce(F.col("found.verdict"), F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    return unpacked(told, pages.columns, replaced=results | {"verdict": verdict})
