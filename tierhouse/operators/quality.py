"""Data-quality rules: warn, drop and fail, and the reports around them.

Counts of warn and drop rules are taken before any row is dropped. A condition that is NULL counts
as a violation. Fail rules apply to the rows that survive the drop rules.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL condition that should hold for every row."""

    name: str
    condition: str
    action: str = WARN

    def __post_init__(self) -> None:
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class RuleViolation(Exception):
    """Raised by an eager check; ``counts`` maps rule names to violating rows."""

    def __init__(self, counts: dict[str, int]):
        super().__init__(", ".join(f"{name}: {n} rows" for name, n in counts.items()))
        self.counts = counts


def expect(name: str, condition: str) -> Rule:
    return Rule(name, condition, WARN)


def expect_or_drop(name: str, condition: str) -> Rule:
    return Rule(name, condition, DROP)


def expect_or_fail(name: str, condition: str) -> Rule:
    return Rule(name, condition, FAIL)


def survives(rules: Iterable[Rule]) -> Column:
    """Whether a row passes all drop rules."""
    drops = [r.holds for r in rules if r.action == DROP]
    return functools.reduce(Column.__and__, drops, F.lit(True))


def violated(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row violates."""
    names = [F.when(~r.holds, F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def rule_counts(spark: SparkSession, rules: Sequence[Rule], counts: Mapping[str, int]) -> DataFrame:
    """Observed counts as in ``rule_report``: one row per rule with checked rows and violations."""
    lines = [(r.name, r.action, counts["rows"], counts[r.name]) for r in rules]
    return spark.createDataFrame(lines, "rule STRING, action STRING, checked BIGINT, violations BIGINT")


def _violations(rules: Sequence[Rule]) -> list[Column]:
    passes = survives(rules)
    return [
        F.count_if(passes & ~r.holds if r.action == FAIL else ~r.holds).alias(r.name) for r in rules
    ]


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Frame with drop and fail rules in force, and the counts observed while it runs.

    Nothing runs here. The first action on the frame raises on a violated fail rule, and fills the
    observation (``observation.get``: ``rows`` and one count per rule) without a further pass.
    """
    counts = Observation()
    watched = df.observe(counts, F.count(F.lit(1)).alias("rows"), *_violations(rules))
    passes = survives(rules)
    keep = passes
    for rule in rules:
        if rule.action == FAIL:
            # Raises by itself for surviving rows only, wherever the optimizer moves the filter.
            stop = F.raise_error(F.lit(f"rule {rule.name} violated: {rule.condition}")).cast("boolean")
            keep = keep & F.when(passes & ~rule.holds, stop).otherwise(F.lit(True))
    return watched.where(keep), counts


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Check the fail rules now, in one pass; returns the rows that survive the drop rules."""
    fails = [r for r in rules if r.action == FAIL]
    if fails:
        found = df.where(survives(rules)).agg(*[F.count_if(~r.holds).alias(r.name) for r in fails]).first()
        counts = {r.name: found[r.name] for r in fails if found[r.name]}
        if counts:
            raise RuleViolation(counts)
    return df.where(survives(rules))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with checked rows and violations, from a single pass."""
    totals = df.agg(F.count(F.lit(1)).alias("__rows"), *_violations(rules))
    lines = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col("__rows").alias("checked"),
                F.col(r.name).alias("violations"),
            )
            for r in rules
        ]
    )
    return totals.select(F.explode(lines).alias("line")).select("line.*")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).where("copies > 1")


def require_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if a key occurs more than once; otherwise return the frame."""
    worst = duplicate_keys(df, columns).agg(F.count("*"), F.max("copies")).first()
    if worst[0]:
        raise RuleViolation({f"unique({', '.join(columns)})": worst[0]})
    return df


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: rows of (column, null_count)."""
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns])
    return totals.select(F.explode(lines).alias("line")).select("line.*")


def amount_mismatches(
    df: DataFrame, columns: Sequence[str], sales: str = "sales", quantity: str = "quantity", price: str = "price"
) -> DataFrame:
    """Rows whose sales differ from quantity * price, or are NULL, zero or negative."""
    s = F.col(sales)
    expected = F.col(quantity) * F.col(price)
    return (
        df.withColumn("expected_sales", expected)
        .where((s != F.col("expected_sales")) | s.isNull() | (s <= 0))
        .select(*columns, sales, quantity, price, "expected_sales")
    )


def negative_amounts(
    df: DataFrame, columns: Sequence[str], quantity: str = "quantity", price: str = "price"
) -> DataFrame:
    """Rows with a negative price, or a quantity that is not positive."""
    return df.where((F.col(price) < 0) | (F.col(quantity) <= 0)).select(*columns, quantity, price)


def dates_in_order(first: str, second: str) -> str:
    """Rule condition: the second date is missing or not before the first."""
    return f"{second} IS NULL OR {first} <= {second}"
