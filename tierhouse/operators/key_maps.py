"""Surrogate keys that stay: a table from natural key to number, which only grows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookups import lookup, not_null
from .numbering import surrogate_key
from .staging import folder_exists, materialize


class KeyMap:
    """Numbers of natural keys, kept as a table or a parquet folder.

    A key keeps its number for good, whatever rows are added before it; new keys are numbered without gaps after the
    highest number in use. One writer at a time is assumed; a run that fails before it appends leaves nothing behind.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], name: str, table: str | None = None, path: str | None = None):
        if (table is None) == (path is None):
            raise ValueError("give a table or a path")
        self.spark, self.keys, self.name, self.table, self.path = spark, list(keys), name, table, path

    def known(self) -> DataFrame | None:
        """The natural keys with their numbers; None before the first ``extend``."""
        if self.table:
            return self.spark.table(self.table) if self.spark.catalog.tableExists(self.table) else None
        return self.spark.read.parquet(self.path) if folder_exists(self.spark, self.path) else None

    def extend(self, rows: DataFrame, order: Sequence[str] | None = None) -> int:
        """Number the natural keys of ``rows`` that have no number yet; returns how many.

        They are numbered in ``order`` (the keys themselves unless given; of other columns the smallest value per key
        counts, NULL first). Rows with a NULL in the key get no number.
        """
        order = list(order or self.keys)
        more = [c for c in order if c not in self.keys]
        known = self.known()
        fresh = not_null(rows.select(*self.keys, *more), self.keys)
        # Reduced to one row per key and task before the keys meet the known ones.
        least = [F.min(F.struct(F.col(c).isNotNull(), c))[c].alias(c) for c in more]
        fresh = fresh.groupBy(*self.keys).agg(*least) if more else fresh.distinct()
        if known is not None:
            fresh = lookup(fresh, known, self.keys, how="left_anti")
        fresh = materialize(fresh, "new-keys")
        count = fresh.count()
        if not count and known is not None:
            return 0
        highest = known.agg(F.max(self.name)).first()[0] if known is not None else None
        tail = [k for k in self.keys if k not in order]
        numbered = surrogate_key(fresh, [*order, *tail], self.name, (highest or 0) + 1, rows=count)
        writer = numbered.select(*self.keys, self.name).write.mode("append").format("parquet")
        writer.saveAsTable(self.table) if self.table else writer.save(self.path)
        return count

    def number(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of their natural key in front; NULL where there is none."""
        known = self.known()
        if known is None:
            raise LookupError("no keys are numbered yet")
        return lookup(rows, known, self.keys, [self.name]).select(self.name, *rows.columns)
