"""A uniform shuffle into shards of exact size.

How many rows each input part sends to each shard is drawn as a matrix with the right multivariate hypergeometric
law. Every part is permuted and cut by its row of the matrix, the rows are exchanged, and each shard is permuted
again, in buckets of a fresh random key, so that no task holds a whole shard.
"""

from __future__ import annotations

import math

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from ..operators.staging import materialize
from .common import packed

BUCKET_ROWS = 50_000
# Spark seeds each partition with the seed plus its number: two keys need seeds that far apart.
FAR_SEED = 1 << 40


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Number of good ones among ``drawn`` out of ``good + bad``, exact for totals of any size.

    By inversion over all values whose probability a double can tell from 0.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mean = drawn * good / total
    spread = math.sqrt(mean * (bad / total) * (total - drawn) / max(total - 1, 1))
    reach = int(40 * spread) + 40
    values = np.arange(max(low, int(mean) - reach), min(high, int(mean) + reach) + 1, dtype=np.float64)
    steps = np.log((good - values[:-1]) * (drawn - values[:-1])) - np.log(
        (values[:-1] + 1) * (bad - drawn + values[:-1] + 1)
    )
    weights = np.concatenate(([0.0], np.cumsum(steps)))
    weights = np.cumsum(np.exp(weights - weights.max()))
    return int(values[min(np.searchsorted(weights, rng.random() * weights[-1], "right"), len(values) - 1)])


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each part sends to each shard, as a uniform permutation of all rows would send them."""
    if sum(parts) != sum(shards):
        raise ValueError("parts and shards must hold equally many rows")
    rng, left, matrix = np.random.default_rng(seed), list(shards), []
    for rows in parts:
        row, open_slots = [], sum(left)
        for k, room in enumerate(left):
            sent = hypergeometric(rng, room, open_slots - room, rows)
            row.append(sent)
            rows, open_slots, left[k] = rows - sent, open_slots - room, room - sent
        matrix.append(row)
    return matrix


def shuffle_into_shards(
    rows: DataFrame, shards: int, seed: int = 0, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """All rows with ``shard`` (from 0) and ``slot`` (place in the shard, from 0, without gaps).

    The numbers of rows of two shards differ by one at most, and every arrangement that allows is equally likely, up
    to the quality of the random numbers. Rows are told apart by their place in the input, so repeated rows, NULLs
    and rows without an id are shuffled like any other; equal rows do not stay together. Columns named ``shard`` or
    ``slot`` are replaced. The rows are written once to the shared folder with their random keys: a lost executor then
    reads the same keys again. The driver gets one count per input part, none per row. An empty table gives an empty
    result.
    """
    spark = rows.sparkSession
    keyed = materialize(
        rows.select(
            packed(rows), F.spark_partition_id().alias("part"), F.rand(seed).alias("local"),
            F.rand(seed + FAR_SEED).alias("final"), F.monotonically_increasing_id().alias("place"),
        ),
        "shuffle",
    )
    counts = sorted((r.part, r["count"]) for r in keyed.groupBy("part").count().collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    cuts = spark.createDataFrame(
        [(part, np.cumsum(row).tolist()) for (part, _), row in zip(counts, matrix, strict=True)],
        "sender int, cuts array<bigint>",
    )
    ranked = keyed.withColumn(
        "turn", F.row_number().over(Window.partitionBy("part").orderBy("local", "place")).cast("bigint")
    )
    sent = ranked.join(cuts, F.col("part") == F.col("sender")).select(
        "row", "final", "place",
        F.size(F.filter("cuts", lambda c: c < F.col("turn"))).alias("shard"),
    )
    buckets = max(1, -(-total // (shards * bucket_rows)))
    dealt = sent.withColumn("bucket", F.floor(F.col("final") * buckets).cast("int"))
    full = dealt.groupBy("shard", "bucket").count()
    before = full.select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"),
        (F.sum("count").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("count")).alias("start"),
    )
    own = Window.partitionBy("shard", "bucket").orderBy("final", "place")
    placed = dealt.withColumn("nth", F.row_number().over(own)).join(
        before, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b"))
    )
    kept = [F.col("row").getField(c).alias(c) for c in rows.columns if c not in ("shard", "slot")]
    return placed.select(*kept, F.col("shard"), (F.col("start") + F.col("nth") - 1).alias("slot"))
