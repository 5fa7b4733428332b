"""Merges, deletes and change rows, as new frames (write them to a new table or version)."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookups import HOT_ROWS, hot_keys, key_hash, spread
from .numbering import neighbours
from .staging import materialize, row_hash


def _no_null(keys: Sequence[str]) -> Column:
    return functools.reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


# Parts that rows which match nothing are dealt to, by key and hash.
_UNMATCHED_PARTS = 64


def _frequent_keys(target: DataFrame, keys: Sequence[str], matchable: Column, min_rows: int) -> DataFrame | None:
    """The keys with more than ``min_rows`` rows that can match, and how many parts they make; None without any.

    At most about as many rows as the sketch reports, with exact counts.
    """
    able = target.where(matchable)
    hot = hot_keys(able, keys, min_rows)
    if not hot:
        return None
    counts = able.where(key_hash(keys).isin(list(hot))).groupBy(*keys).count().where(F.col("count") > min_rows)
    named = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                          F.ceil(F.col("count") / min_rows).cast("bigint").alias("__parts"))
    rows = named.collect()
    return target.sparkSession.createDataFrame(rows, named.schema) if rows else None


def paired(
    target: DataFrame, source: DataFrame, keys: Sequence[str], matchable: Column, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Every target row with its source row, and every source row without one: structs ``t`` and ``s``, NULL if absent.

    One tagged union of both sides, shuffled once by key; each side is read once. NULL keys match nothing, nor do
    target rows for which ``matchable`` does not hold. Two source rows of one key raise an error when the result runs.
    Keys with more than ``min_rows`` target rows are split into parts that get a copy of the source row each; rows that
    match nothing are dealt out evenly.
    """
    able = F.coalesce(matchable, F.lit(False)) & _no_null(keys)
    hot = _frequent_keys(target, keys, able, min_rows)
    names = [f"__k{i}" for i in range(len(keys))]
    apart = -1 - spread([F.col("__row")], F.lit(_UNMATCHED_PARTS))

    def side(df: DataFrame, name: str, able: Column) -> DataFrame:
        rows = df.select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], able.alias("__able"),
            F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name), row_hash(df).alias("__row"),
        )
        if hot is None:
            return rows.withColumn("__parts", F.lit(1).cast("bigint"))
        return rows.join(F.broadcast(hot), names, "left").withColumn("__parts", F.coalesce("__parts", F.lit(1)))

    mine = side(target, "t", able)
    mine = mine.withColumn(
        "__part", F.when(~F.col("__able"), apart).when(F.col("__parts") > 1, spread([F.col("__row")], F.col("__parts")))
        .otherwise(F.lit(0))
    )
    theirs = side(source, "s", _no_null(keys))
    copies = F.when(F.col("__able"), F.sequence(F.lit(0).cast("bigint"), F.col("__parts") - 1)).otherwise(F.array(apart))
    theirs = theirs.withColumn("__part", F.explode(copies)).withColumn("__met", F.col("__parts") > 1)
    both = mine.drop("__able", "__row", "__parts").unionByName(
        theirs.drop("__able", "__row", "__parts"), allowMissingColumns=True
    )
    group = Window.partitionBy(*names, "__part")
    twice = F.raise_error(F.lit(f"unique({', '.join(keys)}) violated")).cast("boolean")
    seen = both.select(
        "t", "s", "__part", "__met", F.first("s", ignorenulls=True).over(group).alias("__s"),
        F.count("s").over(group).alias("__sources"), F.count("t").over(group).alias("__targets"),
    )
    alone = (F.col("__part") < 0) | ((F.col("__part") == 0) & (F.col("__targets") == 0) & ~F.col("__met"))
    kept = F.when((F.col("__part") >= 0) & (F.col("__sources") > 1), twice).otherwise(F.col("t").isNotNull() | alone)
    match = F.when(F.col("t").isNull(), F.col("s")).when(F.col("__part") >= 0, F.col("__s"))
    return seen.where(kept).select("t", match.alias("s"))


def _field(name: str, column: str) -> Column:
    return F.col(name).getField(column)


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    condition: str | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Matched target rows get ``update_columns`` from the source; unmatched source rows are added.

    ``condition`` restricts which target rows can match (for instance ``is_current``). NULL keys match nothing, as in
    MERGE. Both sides are read and shuffled once; two source rows of one key raise an error when the result runs.
    """
    pairs = paired(target, source, keys, F.expr(condition) if condition else F.lit(True), min_rows)

    def value(field: T.StructField) -> Column:
        name, old = field.name, _field("t", field.name)
        new = _field("s", name) if name in source.columns else F.lit(None)
        kept = F.when(F.col("s").isNotNull(), new).otherwise(old) if name in update_columns else old
        return F.when(F.col("t").isNull(), new).otherwise(kept).cast(field.dataType).alias(name)

    return pairs.select(*[value(f) for f in target.schema.fields])


def scd2_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    effective: dt.date,
    start: str = "start_date",
    end: str = "end_date",
    flag: str = "is_current",
    on_stale: str = "fail",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Type-2 merge of a batch that takes effect on one date.

    Unchanged keys stay as they are; a change in ``tracked`` (NULL-safe) closes the current version
    on the day before and adds a new one; unknown keys are added. A change on the very day the
    current version began corrects that version in place, so that a repeated batch changes nothing.
    A batch older than a current version it would change raises an error, or leaves that version
    (``on_stale="keep"``); changes that carry their own time go through ``scd2_apply_changes``. Both sides are read and
    shuffled once. The source needs one row per key (reduce it with ``latest_version``), or the result raises.
    """
    if on_stale not in ("fail", "keep"):
        raise ValueError("on_stale must be fail or keep")
    carried = [c for c in source.columns if c in target.columns and c not in (*keys, start, end, flag)]
    day = F.lit(effective)
    pairs = paired(target, source, keys, F.col(flag), min_rows)
    differs = [~_field("t", c).eqNullSafe(_field("s", c)) for c in tracked]
    changed = F.col("s").isNotNull() & functools.reduce(Column.__or__, differs, F.lit(False))
    stale = changed & (_field("t", start) > day)
    if on_stale == "fail":
        refuse = F.raise_error(F.lit(f"batch of {effective} is older than a current version"))
        verdict = F.when(stale, refuse.cast("string"))
    else:
        verdict = F.when(stale, F.lit("keep"))
    verdict = (
        F.when(F.col("t").isNull(), F.lit("new"))
        .otherwise(
            verdict.when(changed & (_field("t", start) == day), F.lit("correct"))
            .when(changed, F.lit("close"))
            .otherwise(F.lit("keep"))
        )
    )

    def version(**values: Column) -> Column:
        return F.struct(
            *[values.get(f.name, _field("t", f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
        )

    renewed = {c: _field("s", c) for c in carried}
    unknown = {
        f.name: F.lit(None) for f in target.schema.fields if f.name not in (*keys, *carried, start, end, flag)
    }
    named = {k: _field("s", k) for k in keys}
    added = version(**named, **renewed, **unknown, **{start: day, end: F.lit(None), flag: F.lit(True)})
    closed = version(**{end: F.date_sub(day, 1), flag: F.lit(False)})
    rows = (
        F.when(F.col("__verdict") == "close", F.array(closed, added))
        .when(F.col("__verdict") == "new", F.array(added))
        .when(F.col("__verdict") == "correct", F.array(version(**renewed)))
        .otherwise(F.array(version()))
    )
    judged = pairs.withColumn("__verdict", verdict)
    return judged.select(F.explode(rows).alias("v")).select("v.*")


def scd2_apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str,
    delete: str | None = None,
    start: str = "start_date",
    end: str = "end_date",
    flag: str = "is_current",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Type-2 history after change rows that carry a ``sequence``, in whatever order they arrive.

    A version holds from its ``start`` up to its ``end`` (the start of the next one, NULL if there is none). Every
    change starts a version at its sequence. A late one is spliced in: the version it falls into ends there, and it ends
    where the next version begins. Rows for which the condition ``delete`` holds start no version; they end the one
    before. A delete that finds no version to end stays as an empty range (``start`` equal to ``end``), so that an older
    change which arrives later ends there. So the result depends on the changes alone, not on how they are batched (of
    changes with one key and sequence the later batch wins).

    A change with the sequence of a known version corrects it: columns the changes have are replaced, others stay. A
    delete with that sequence removes the version. Equal change rows count once; two different ones of one key and
    sequence raise an error when the result runs, as do changes without a key or sequence. Target rows without a key or
    start pass unchanged. Columns that the changes lack are NULL in new versions (``fill_keys`` numbers them). Keys with
    more than ``min_rows`` events are chained across partitions.
    """
    spark_type = target.schema[start].dataType
    named = [f"__k{i}" for i in range(len(keys))]
    own = (*keys, start, end, flag)
    plain = [f for f in target.schema.fields if f.name not in own]
    given = [f for f in plain if f.name in changes.columns]
    kept = F.struct(F.lit(True).alias("is_row"), *[F.col(f"`{f.name}`") for f in plain])
    gone = F.coalesce(F.expr(delete), F.lit(False)) if delete else F.lit(False)

    def event(at: Column, kind: Column, row: Column) -> Column:
        return F.struct(at.cast(spark_type).alias("at"), kind.alias("kind"), row.alias("row"))

    # Events of the target: a version (or an empty range, which is a delete), and the end of one. Events that meet at one
    # sequence are told apart by kind: a change is stronger than what is stored, a version stronger than an end.
    nothing = F.lit(None).cast(T.StructType([T.StructField("is_row", T.BooleanType()), *plain]))
    empty = F.col(start).eqNullSafe(F.col(end))
    known = F.when(empty, F.array(event(F.col(start), F.lit("stored delete"), nothing))).otherwise(
        F.array(event(F.col(start), F.lit("version"), kept), event(F.col(end), F.lit("end"), nothing))
    )
    sound = F.col(start).isNotNull() & _no_null(keys)
    stored = target.select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], sound.alias("sound"),
        F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("whole"),
        F.explode(F.when(sound, F.filter(known, lambda e: e["at"].isNotNull())).otherwise(
            F.array(event(F.lit(None), F.lit("unsound"), nothing)))).alias("e"),
    ).select(*named, "sound", F.when(~F.col("sound"), F.col("whole")).alias("whole"), "e.*",
             F.when(~F.col("sound"), F.monotonically_increasing_id()).alias("apart"))
    missing = F.raise_error(F.lit(f"a change lacks {', '.join(keys)} or {sequence}")).cast("boolean")
    new = F.struct(F.lit(True).alias("is_row"), *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in given])
    arrived = changes.where(F.when(F.col(sequence).isNull() | ~_no_null(keys), missing).otherwise(F.lit(True))).select(
        *[F.col(k).alias(n) for k, n in zip(keys, named)], F.lit(True).alias("sound"),
        F.col(sequence).cast(spark_type).alias("at"), F.when(gone, "delete").otherwise("change").alias("kind"),
        F.when(~gone, new).alias("new"),
    )
    both = stored.unionByName(arrived, allowMissingColumns=True)

    # One row per key and sequence, whatever the number of copies.
    def has(*kinds: str) -> Column:
        return F.bool_or(F.col("kind").isin(*kinds))

    change = F.when(F.col("kind") == "change", F.col("new"))
    merged = both.groupBy(*named, "at", "sound", "apart").agg(
        has("change").alias("changed"), has("delete").alias("deleted"), has("version").alias("versioned"),
        F.any_value("row", ignoreNulls=True).alias("row"), F.any_value(change, ignoreNulls=True).alias("new"),
        F.any_value("whole", ignoreNulls=True).alias("whole"),
        F.min(F.when(F.col("kind") == "change", F.xxhash64("new"))).alias("least"),
        F.max(F.when(F.col("kind") == "change", F.xxhash64("new"))).alias("most"),
    )
    conflict = F.raise_error(F.lit(f"two different changes of one {', '.join(keys)} and {sequence}")).cast("boolean")
    clash = (F.col("changed") & F.col("deleted")) | (F.col("least") != F.col("most"))
    live = F.col("changed") | (~F.col("deleted") & F.col("versioned"))
    events = merged.withColumn("live", F.when(F.col("sound") & clash, conflict).otherwise(live))
    events = materialize(events.drop("least", "most"), "events")

    unsound = events.where(~F.col("sound")).select("whole.*")
    linked = neighbours(events.where("sound"), named, ["at"], {"next_at": ("at", 1), "was_live": ("live", -1)}, min_rows)
    # A delete after a version is told by that version's end.
    told = linked.where(F.col("live") | ~F.coalesce(F.col("was_live"), F.lit(False)))

    def value(field: T.StructField) -> Column:
        name = field.name
        if name in keys:
            return F.col(named[list(keys).index(name)])
        if name == start:
            return F.col("at")
        if name == end:
            return F.when(F.col("live"), F.col("next_at")).otherwise(F.col("at"))
        if name == flag:
            return F.col("live") & F.col("next_at").isNull()
        before = F.when(F.col("live"), _field("row", name))
        return F.when(F.col("changed"), _field("new", name)).otherwise(before) if field in given else before

    versions = told.select(*[value(f).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    return versions.unionByName(unsound)


def delete_where(df: DataFrame, condition: str | Column) -> DataFrame:
    """Rows left after DELETE WHERE: a condition that is NULL deletes nothing."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(condition, F.lit(False)))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes from ``old`` to ``new`` with a ``change_type`` column.

    insert and delete give one row; a change gives update_preimage and update_postimage. Columns that only one side
    has are NULL on the other. ``keys`` must identify the rows of both sides: running the result raises if they do not.
    Both sides are shuffled once, by key.
    """
    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    types = {f.name: f.dataType for f in [*new.schema.fields, *old.schema.fields]}

    def side(df: DataFrame, name: str) -> DataFrame:
        whole = [
            (F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in columns
        ]
        return df.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.lit(name).alias("__side"),
            F.struct(*whole).alias("__row"),
        )

    def row_of(name: str) -> Column:
        mine = F.col("__side") == name
        found = F.any_value(F.when(mine, F.col("__row")), ignoreNulls=True)
        twice = F.raise_error(F.lit(f"unique({', '.join(keys)}) violated")).cast("boolean")
        return F.when(F.count_if(mine) > 1, twice).alias(f"{name}_check"), found.alias(name)

    both = side(old, "o").unionByName(side(new, "n"))
    keyed = both.groupBy(*[f"__k{i}" for i in range(len(keys))]).agg(*row_of("o"), *row_of("n"))

    def change(kind: str, row: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(row).alias("row"))

    kinds = (
        F.when(F.col("o").isNull(), F.array(change("insert", "n")))
        .when(F.col("n").isNull(), F.array(change("delete", "o")))
        .when(
            ~F.col("o").eqNullSafe(F.col("n")),
            F.array(change("update_preimage", "o"), change("update_postimage", "n")),
        )
    )
    unchecked = F.coalesce("o_check", "n_check", F.lit(False))
    return (
        keyed.where(~unchecked).select(F.explode(kinds).alias("c")).select("c.change_type", "c.row.*")
    )
