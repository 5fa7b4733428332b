"""Queries for versions, merges, deletes and snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as op
from ..plans import gold
from .registry import query, table

_DAY = dt.date(2024, 6, 1)


@query(
    """SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""
)
def latest_version(spark, folder):
    events = table(spark, folder, "events")
    return op.latest_version(events, ["user_id", "event_type"], ["ts", "event_id"])


def _event_versions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", "value", "props", F.col("ts").alias("start_ts")
    )
    return op.version_ranges(events, ["user_id"], "start_ts", ["event_id"], end="end_ts")


_EVENT_VERSIONS = """WITH versions AS (
    SELECT event_id, user_id, event_type, value, props, ts AS start_ts,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_ts,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
    FROM events) """


@query(_EVENT_VERSIONS + "SELECT * FROM versions")
def scd2_ranges(spark, folder):
    """Each event as a version of its user, valid until the next one."""
    return _event_versions(spark, folder)


@query(_EVENT_VERSIONS + "SELECT * FROM versions WHERE is_current")
def current_rows(spark, folder):
    return op.current_rows(_event_versions(spark, folder))


@query(
    _EVENT_VERSIONS
    + """SELECT user_id, count(*) AS versions, CAST(sum(CAST(is_current AS int)) AS bigint) AS current_versions
  FROM versions GROUP BY user_id HAVING count(*) > 1 ORDER BY versions DESC, user_id"""
)
def scd2_version_check(spark, folder):
    return op.version_check(_event_versions(spark, folder), ["user_id"])


@query(
    """SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey, p_name, p_brand, p_type, p_size,
    p_retailprice, DATE '2024-06-01' AS start_date, CAST(NULL AS date) AS end_date, TRUE AS is_current FROM part"""
)
def scd2_initial(spark, folder):
    stamped = op.with_open_version(table(spark, folder, "part"), _DAY)
    return op.surrogate_key(stamped, ["p_partkey"], "product_key")


_PARTS = """WITH target AS (
    SELECT p_partkey, p_name, CAST(p_retailprice AS decimal(10, 2)) AS cost, p_size,
      CASE WHEN p_partkey % 10 = 9 THEN DATE '2024-06-01' ELSE DATE '2020-01-01' END AS start_date,
      CASE WHEN p_partkey % 7 = 0 THEN DATE '2021-01-01' END AS end_date, p_partkey % 7 <> 0 AS is_current
    FROM part),
  source AS (
    SELECT CASE WHEN p_partkey % 5 < 3 THEN p_partkey ELSE -1 - p_partkey END AS p_partkey,
      concat(p_name, CASE WHEN p_partkey % 8 = 0 THEN ' new' ELSE '' END) AS p_name,
      CAST(CASE p_partkey % 4 WHEN 0 THEN p_retailprice + 1 WHEN 1 THEN NULL ELSE p_retailprice END
        AS decimal(10, 2)) AS cost, p_size
    FROM part) """


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A dimension and a batch of changes to it; two fifths of the batch are new products."""
    part = table(spark, folder, "part")
    target = part.selectExpr(
        "p_partkey",
        "p_name",
        "CAST(p_retailprice AS decimal(10, 2)) AS cost",
        "p_size",
        "CASE WHEN p_partkey % 10 = 9 THEN DATE '2024-06-01' ELSE DATE '2020-01-01' END AS start_date",
        "CASE WHEN p_partkey % 7 = 0 THEN DATE '2021-01-01' END AS end_date",
        "p_partkey % 7 <> 0 AS is_current",
    )
    source = part.selectExpr(
        "CASE WHEN p_partkey % 5 < 3 THEN p_partkey ELSE -1 - p_partkey END AS p_partkey",
        "concat(p_name, CASE WHEN p_partkey % 8 = 0 THEN ' new' ELSE '' END) AS p_name",
        "CAST(CASE p_partkey % 4 WHEN 0 THEN p_retailprice + 1 WHEN 1 THEN NULL ELSE p_retailprice END"
        " AS decimal(10, 2)) AS cost",
        "p_size",
    )
    return target, source


@query(
    _PARTS
    + """SELECT t.p_partkey, t.p_name, CASE WHEN s.p_partkey IS NULL THEN t.cost ELSE s.cost END AS cost, t.p_size,
    t.start_date, t.end_date, t.is_current
  FROM target t LEFT JOIN source s ON t.p_partkey = s.p_partkey AND t.is_current
  UNION ALL
  SELECT p_partkey, p_name, cost, p_size, NULL, NULL, NULL FROM source
  WHERE p_partkey NOT IN (SELECT p_partkey FROM target WHERE is_current)"""
)
def scd1_upsert(spark, folder):
    target, source = _parts(spark, folder)
    return op.scd1_upsert(target, source, ["p_partkey"], ["cost"], "is_current")


@query(
    _PARTS
    + """, paired AS (
    SELECT t.*, s.p_partkey IS NOT NULL AND (t.p_name IS DISTINCT FROM s.p_name OR t.cost IS DISTINCT FROM s.cost)
        AS changed, s.p_name AS new_name, s.cost AS new_cost, s.p_size AS new_size
    FROM target t LEFT JOIN source s ON t.p_partkey = s.p_partkey AND t.is_current)
  SELECT p_partkey, CASE WHEN changed AND start_date = DATE '2024-06-01' THEN new_name ELSE p_name END AS p_name,
    CASE WHEN changed AND start_date = DATE '2024-06-01' THEN new_cost ELSE cost END AS cost, p_size, start_date,
    CASE WHEN changed AND start_date < DATE '2024-06-01' THEN DATE '2024-05-31' ELSE end_date END AS end_date,
    is_current AND NOT (changed AND start_date < DATE '2024-06-01') AS is_current
  FROM paired
  UNION ALL
  SELECT p_partkey, new_name, new_cost, new_size, DATE '2024-06-01', NULL, TRUE FROM paired
  WHERE changed AND start_date < DATE '2024-06-01'
  UNION ALL
  SELECT p_partkey, p_name, cost, p_size, DATE '2024-06-01', NULL, TRUE FROM source
  WHERE p_partkey NOT IN (SELECT p_partkey FROM target WHERE is_current)"""
)
def scd2_merge(spark, folder):
    """Unchanged, changed, corrected on the same day, and new products in one batch."""
    target, source = _parts(spark, folder)
    return op.scd2_merge(target, source, ["p_partkey"], ["p_name", "cost"], _DAY)


@query(
    """WITH log AS (
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 9 <> 4 THEN value END AS value, event_type <> 'error' AS live,
      lead(event_id) OVER w AS next_id, lag(event_type) OVER w AS before FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
  SELECT user_id, CASE WHEN live THEN event_type END AS event_type, CASE WHEN live THEN value END AS value,
    event_id AS start_id, CASE WHEN live THEN next_id ELSE event_id END AS end_id, live AND next_id IS NULL AS is_current
  FROM log WHERE live OR before IS NULL OR before = 'error'"""
)
def scd2_apply_changes(spark, folder):
    """The history of every user from a log of changes that arrives in three batches, out of order.

    The second batch repeats half of the first one, the third one is older than what is known and corrects a column; an
    error deletes its user.
    """
    events = table(spark, folder, "events").select("user_id", "event_type", "value", "event_id")
    kinds = "user_id BIGINT, event_type STRING, value DOUBLE, start_id BIGINT, end_id BIGINT, is_current BOOLEAN"
    known = spark.createDataFrame([], kinds)
    right = F.when(F.col("event_id") % 9 != 4, F.col("value"))
    wrong = F.when(F.col("event_id") % 3 == 2, right).otherwise(F.col("value"))
    batches = [
        events.withColumn("value", wrong).where("event_id % 4 <> 1 AND event_id % 5 < 3"),
        events.withColumn("value", wrong).where("event_id % 4 <> 1 AND (event_id % 5 > 2 OR event_id % 2 = 0)"),
        events.withColumn("value", right).where("event_id % 4 = 1 OR event_id % 9 = 4"),
    ]
    for batch in batches:
        known = op.scd2_apply_changes(
            known, batch, ["user_id"], "event_id", "event_type = 'error'", "start_id", "end_id"
        )
    return known


_VERSIONED = _PARTS + """, changed AS (
    SELECT s.*, row_number() OVER (ORDER BY s.p_partkey) + (SELECT count(*) FROM target) AS product_sk
    FROM source s LEFT JOIN target t ON s.p_partkey = t.p_partkey AND t.is_current
    WHERE t.p_partkey IS NULL OR (t.start_date < DATE '2024-06-01'
      AND (t.p_name IS DISTINCT FROM s.p_name OR t.cost IS DISTINCT FROM s.cost)))
  SELECT row_number() OVER (ORDER BY t.p_partkey) AS product_sk, t.p_partkey,
    CASE WHEN s.p_partkey IS NOT NULL AND t.start_date = DATE '2024-06-01' THEN s.p_name ELSE t.p_name END AS p_name,
    CASE WHEN s.p_partkey IS NOT NULL AND t.start_date = DATE '2024-06-01' THEN s.cost ELSE t.cost END AS cost,
    t.p_size, t.start_date,
    CASE WHEN c.p_partkey IS NOT NULL THEN DATE '2024-05-31' ELSE t.end_date END AS end_date,
    t.is_current AND c.p_partkey IS NULL AS is_current
  FROM target t LEFT JOIN source s ON t.p_partkey = s.p_partkey AND t.is_current
    LEFT JOIN changed c ON t.p_partkey = c.p_partkey AND t.is_current
  UNION ALL SELECT product_sk, p_partkey, p_name, cost, p_size, DATE '2024-06-01', NULL, TRUE FROM changed"""


@query(_VERSIONED)
def scd2_refresh(spark, folder):
    """A versioned product dimension after a batch, new versions numbered after the known ones."""
    target, source = _parts(spark, folder)
    known = op.surrogate_key(target, ["p_partkey"], "product_sk")
    return gold.product_history(known, source, _DAY, ["p_partkey"], ["p_name", "cost"], "product_sk")


@query(
    """WITH stays AS (SELECT o_custkey, CAST(o_orderdate AS date) AS low, CASE WHEN o_orderkey % 60 <> 7 THEN
      CAST(o_orderdate AS date) + CAST(o_orderkey % 91 - 3 AS int) END AS high, o_orderkey FROM orders),
  swept AS (SELECT *, max(coalesce(high, DATE '9999-12-31')) OVER (PARTITION BY o_custkey
      ORDER BY low, high IS NULL, high, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
    FROM stays WHERE high IS NULL OR high > low),
  told AS (SELECT o_custkey, 'overlap' AS conflict, low, least(coalesce(high, DATE '9999-12-31'), latest) AS high
    FROM swept WHERE low < latest
    UNION ALL SELECT o_custkey, 'gap', latest, low FROM swept WHERE low > latest
    UNION ALL SELECT o_custkey, 'inverted', high, low FROM stays WHERE high < low)
  SELECT o_custkey, conflict, low, CASE WHEN high < DATE '9999-12-31' THEN high END AS high FROM told"""
)
def scd2_overlaps(spark, folder):
    """Orders as ranges of days per customer, some open and some inverted: where they overlap or leave a gap."""
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    length = (F.col("o_orderkey") % 91 - 3).cast("int")
    ranges = orders.select(
        "o_custkey", day.alias("start_date"), F.when(F.col("o_orderkey") % 60 != 7, F.date_add(day, length)).alias("end_date")
    )
    return op.range_conflicts(ranges, ["o_custkey"])


@query(
    """WITH numbered AS (SELECT *, row_number() OVER (ORDER BY c_custkey % 3 <> 1, c_custkey) AS customer_key FROM customer)
  SELECT customer_key, c_custkey, c_name, TRUE AS kept FROM numbered"""
)
def stable_keys(spark, folder):
    """Customers numbered in two loads; the second one adds customers in front of the known ones, which keep their number."""
    keys = op.KeyMap(spark, ["c_custkey"], "customer_key", path=op.scratch_path(spark, "customer-keys"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    first = customers.where("c_custkey % 3 = 1")
    keys.extend(first)
    before = op.materialize(keys.number(first).select("c_custkey", F.col("customer_key").alias("before")), "before")
    keys.extend(customers)
    after = op.lookup(keys.number(customers), before, ["c_custkey"], ["before"])
    kept = F.coalesce(F.col("before") == F.col("customer_key"), F.lit(True))
    return after.select("customer_key", "c_custkey", "c_name", kept.alias("kept"))


@query(
    _PARTS
    + """SELECT p_partkey, count(*) AS current_versions FROM (
    SELECT p_partkey FROM target WHERE is_current UNION ALL SELECT p_partkey FROM source) GROUP BY 1 HAVING count(*) > 1"""
)
def dimension_conflicts(spark, folder):
    """Products with two current versions, after a batch was appended instead of merged."""
    target, source = _parts(spark, folder)
    appended = target.unionByName(source.withColumn("is_current", F.lit(True)), allowMissingColumns=True)
    return op.versions_in_conflict(appended, ["p_partkey"])


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size FROM part
  WHERE p_partkey % 3 = 0 OR NOT p_size > 25"""
)
def delete_where(spark, folder):
    """A condition that is NULL deletes nothing."""
    part = table(spark, folder, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_size END AS size"
    )
    return op.delete_where(part, "size > 25")


@query(
    _PARTS
    + """, before AS (SELECT p_partkey, p_name, cost FROM target),
  after AS (SELECT p_partkey, p_name, cost, p_size FROM source)
  SELECT 'delete' AS change_type, *, NULL AS p_size FROM before WHERE p_partkey NOT IN (SELECT p_partkey FROM after)
  UNION ALL SELECT 'insert', * FROM after WHERE p_partkey NOT IN (SELECT p_partkey FROM before)
  UNION ALL SELECT 'update_preimage', b.*, NULL FROM before b JOIN after a ON a.p_partkey = b.p_partkey
  UNION ALL SELECT 'update_postimage', a.* FROM before b JOIN after a ON a.p_partkey = b.p_partkey"""
)
def snapshot_diff(spark, folder):
    """Changes between two states, the later of which has a column more."""
    target, source = _parts(spark, folder)
    return op.snapshot_diff(target.select("p_partkey", "p_name", "cost"), source, ["p_partkey"])


def _order_versions(spark: SparkSession, folder: str) -> str:
    """Orders as a versioned table: one version per order year, committed at the end of that year."""
    path = op.scratch_path(spark, "orders")
    orders = table(spark, folder, "orders").withColumns(
        {
            "_version": F.year("o_orderdate") - 1995,
            "_committed_at": F.make_timestamp_ntz(
                F.year("o_orderdate"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)
            ),
        }
    )
    op.append_snapshots(orders, path)
    return path


_ORDER_VERSIONS = """WITH versions AS (
    SELECT CAST(year(o_orderdate) - 1995 AS bigint) AS _version,
      make_timestamp(year(o_orderdate), 12, 31, 0, 0, 0) AS _committed_at, * FROM orders) """


@query("SELECT * FROM orders WHERE year(o_orderdate) = 1997")
def read_as_of(spark, folder):
    """The version that was current in the middle of 1998."""
    return op.read_as_of(spark, _order_versions(spark, folder), "1998-06-30 00:00:00")


@query(
    _ORDER_VERSIONS
    + """SELECT _version, _committed_at, 'WRITE' AS _operation, count(*) AS row_count FROM versions GROUP BY ALL
    ORDER BY _version DESC"""
)
def snapshot_history(spark, folder):
    return op.history(spark, _order_versions(spark, folder))


@query("SELECT * FROM orders WHERE year(o_orderdate) = 1996")
def restore_version(spark, folder):
    """Everything is deleted by mistake, then version 1 is restored and read as the newest one."""
    path = _order_versions(spark, folder)
    op.append_snapshot(op.delete_where(op.read_version(spark, path), "1 = 1"), path, dt.datetime(2010, 1, 1))
    op.restore(spark, path, 1, dt.datetime(2010, 1, 2))
    return op.read_version(spark, path)


@query(
    _ORDER_VERSIONS
    + """, known AS (SELECT DISTINCT _version, _committed_at FROM versions),
  replaced AS (SELECT *, lead(_committed_at) OVER (ORDER BY _version) AS replaced_at FROM known)
  SELECT * FROM replaced WHERE replaced_at < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 168 HOUR"""
)
def expired_versions(spark, folder):
    return op.expired_versions(spark, _order_versions(spark, folder), "2000-01-01 00:00:00")
