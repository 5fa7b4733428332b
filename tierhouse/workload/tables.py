"""Queries that write files or tables and read them back."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from .. import operators as op
from ..functions import interleave_bits
from ..plans import warehouse
from ..sources import (SOURCES, bad_records, describe, detail, drop_table, field_types, get_properties, plan_text,
                       preview, read_csv, read_table, unset_properties, with_ingest_metadata, write_table)
from ..streaming import Sink, ingest_files, stream_rules
from .bronze import bronze, with_layers
from .registry import query, table

_CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
_ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE,"
    " o_orderpriority STRING"
)


@query(
    """SELECT * REPLACE (CASE WHEN c_custkey % 10 <> 3 THEN c_nationkey END AS c_nationkey),
    c_custkey % 10 = 3 AS is_bad, (SELECT count(*) FROM customer WHERE c_custkey % 10 = 3) AS bad_rows,
    TRUE AS has_file, TRUE AS has_time FROM customer"""
)
def csv_ingest(spark, folder):
    """Customers through CSV files with other columns in another order, some rows with a malformed number."""
    path = op.scratch_path(spark, "customer-csv")
    customers = table(spark, folder, "customer")
    odd = F.col("c_custkey") % 10 == 3
    written = customers.withColumn("c_nationkey", F.when(odd, "1x").otherwise(F.col("c_nationkey").cast("string")))
    written.select(*reversed(customers.columns), F.lit("s").alias("surplus")).write.option("header", "true").csv(path)
    loaded = with_ingest_metadata(read_csv(spark, path, _CUSTOMER, bad_records="keep"))
    stored = op.materialize(loaded, "customers")
    return stored.select(
        *customers.columns, F.col("_bad_record").isNotNull().alias("is_bad"),
        F.lit(bad_records(stored).count()).alias("bad_rows"),
        F.col("_source_file").contains("customer-csv").alias("has_file"), F.col("_ingest_timestamp").isNotNull().alias("has_time"),
    )


@query(
    """SELECT * REPLACE (CAST(o_orderdate AS date) AS o_orderdate,
      CASE WHEN o_orderkey % 7 <> 3 THEN o_totalprice END AS o_totalprice), o_orderkey % 7 = 3 AS is_bad,
    CAST(CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 1 ELSE 0 END AS bigint) AS batch
  FROM orders WHERE o_orderstatus <> 'P'"""
)
def stream_ingest(spark, folder):
    """Orders through CSV files of three column orders in two runs of the incremental load: each file counts once.

    Rows with a malformed price are kept with their line. Files of another name hold the pending orders and are left out.
    """
    files, target, memory = (op.scratch_path(spark, f"orders-{part}") for part in ("csv", "table", "checkpoint"))
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    price = F.when(F.col("o_orderkey") % 7 == 3, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    shown = orders.withColumn("o_totalprice", price)
    early, pending = F.col("o_orderdate") < dt.date(1998, 1, 1), F.col("o_orderstatus") == "P"
    names = orders.columns

    def deliver(rows, columns, ending):
        rows.select(*columns).write.mode("append").option("header", "true").option("compression", ending).csv(files)

    deliver(shown.where(pending), names, "gzip")
    for first, last in ((names, list(reversed(names))), (["surplus", *names[3:], *names[:3]], names)):
        delivery = shown.where(~pending & (early if first == names else ~early)).withColumn("surplus", F.lit("s"))
        deliver(delivery.where("o_orderkey % 2 = 0"), first, "none")
        deliver(delivery.where("o_orderkey % 2 = 1"), last, "none")
        ingest_files(spark, files, _ORDERS, memory, Sink(path=target), "*.csv")
    loaded = spark.read.parquet(target)
    return loaded.select(*names, F.col("_bad_record").isNotNull().alias("is_bad"), F.col("_batch").cast("bigint").alias("batch"))


_CHECKED = """WITH delivered AS (SELECT o_orderkey, CAST(o_orderkey % 3 // 2 AS bigint) AS batch,
    NOT o_totalprice > 100000 AS cheap, o_orderpriority = '5-LOW' AS low, o_orderstatus = 'P' AS pending FROM orders) """


def _checked_orders(spark, folder):
    """Orders delivered as parquet files in two batches, under a warning and two drop rules: the three sinks' folders."""
    files, kept, dropped, counts, memory = (
        op.scratch_path(spark, f"checked-{part}") for part in ("files", "kept", "dropped", "counts", "checkpoint")
    )
    orders = table(spark, folder, "orders")
    rules = [op.expect("not_cheap", "o_totalprice > 100000"), op.expect_or_drop("not_low", "o_orderpriority <> '5-LOW'"),
             op.expect_or_drop("settled", "o_orderstatus <> 'P'")]
    for delivery in ("o_orderkey % 3 < 2", "o_orderkey % 3 = 2"):
        orders.where(delivery).write.mode("append").parquet(files)
        stream_rules(spark.readStream.schema(orders.schema).parquet(files), rules, memory, Sink(path=kept),
                     Sink(path=dropped), Sink(path=counts))
    return kept, dropped, counts


@query(
    _CHECKED
    + """SELECT batch, rule, action, (SELECT count(*) FROM delivered d WHERE d.batch = b.batch) AS checked,
    (SELECT count(*) FILTER (CASE rule WHEN 'not_cheap' THEN cheap WHEN 'not_low' THEN low ELSE pending END)
      FROM delivered d WHERE d.batch = b.batch) AS violations
  FROM (SELECT DISTINCT batch FROM delivered) b, (VALUES ('not_cheap', 'warn'), ('not_low', 'drop'), ('settled', 'drop'))
    AS r(rule, action)"""
)
def stream_rules_counts(spark, folder):
    """Checked rows and violations of each rule in each batch of a stream."""
    counts = spark.read.parquet(_checked_orders(spark, folder)[2])
    return counts.select(F.col("_batch").cast("bigint").alias("batch"), "rule", "action", "checked", "violations")


@query(
    _CHECKED
    + """SELECT o_orderkey, batch, NOT (low OR pending) AS kept, CASE WHEN low OR pending THEN
    concat_ws(',', CASE WHEN cheap THEN 'not_cheap' END, CASE WHEN low THEN 'not_low' END, CASE WHEN pending THEN 'settled' END)
    END AS violated FROM delivered"""
)
def stream_rules_rows(spark, folder):
    """Where each order of the stream went: the table, or the quarantine with the rules it violates."""
    kept, dropped, _ = (spark.read.parquet(path) for path in _checked_orders(spark, folder))
    batch = F.col("_batch").cast("bigint").alias("batch")
    passed = kept.select("o_orderkey", batch, F.lit(True).alias("kept"), F.lit(None).cast("string").alias("violated"))
    names = F.array_join("_violated", ",").alias("violated")
    return passed.unionByName(dropped.select("o_orderkey", batch, F.lit(False).alias("kept"), names))


@query(
    """SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority),
    TRUE AS fewer_files FROM orders"""
)
def compacted(spark, folder):
    """Orders in partition folders of many small files of two schemas, rewritten as few large ones."""
    small, large = op.scratch_path(spark, "small"), op.scratch_path(spark, "large")
    orders = table(spark, folder, "orders")
    for rows in (orders.where("o_orderkey % 2 = 0").drop("o_orderpriority"), orders.where("o_orderkey % 2 = 1")):
        rows.repartition(16).write.mode("append").partitionBy("o_orderstatus").parquet(small)
    op.compact(spark, small, large)
    before, after = (op.file_summary(spark, path).first()["files"] for path in (small, large))
    return spark.read.parquet(large).select(*orders.columns, F.lit(after < before / 8).alias("fewer_files"))


@query("SELECT *, o_orderkey % 2 = 0 AS left_alone, TRUE AS fewer_files FROM orders")
def compacted_selectively(spark, folder):
    """Orders in partition folders, half of them in a large file each and half in many small ones: only these are packed."""
    source, packed = op.scratch_path(spark, "mixed"), op.scratch_path(spark, "packed")
    orders = table(spark, folder, "orders")
    for rows, files in ((orders.where("o_orderkey % 2 = 0"), 1), (orders.where("o_orderkey % 2 = 1"), 12)):
        rows.repartition(files).write.mode("append").partitionBy("o_orderstatus").parquet(source)
    sizes = [r["length"] for r in op.files_of(spark, source).orderBy("length").collect()]
    # Three folders with one large file each.
    live = op.compact_small(spark, source, packed, file_bytes=sum(sizes), small_below=sizes[-3])
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*live)
    file = F.col("_metadata.file_path")
    told = rows.select("*", F.regexp_extract(file, "o_orderstatus=([^/]*)", 1).alias("o_orderstatus"),
                       (~file.contains("/packed-")).alias("left_alone"))
    return told.select(*orders.columns, "left_alone", F.lit(len(live) == 6).alias("fewer_files"))


@query("SELECT c_custkey, c_name, TRUE AS narrow FROM customer")
def clustered_text(spark, folder):
    """Customers laid out by name, whose values share a long beginning: no two files overlap."""
    path = op.scratch_path(spark, "clustered-names")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    op.cluster(customers, ["c_name"]).write.option("maxRecordsPerFile", max(1, customers.count() // 8)).parquet(path)
    stored = spark.read.parquet(path)
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min("c_name").alias("low"), F.max("c_name").alias("high"))
    other = ranges.toDF("other", "other_low", "other_high")
    met = (F.col("file") < F.col("other")) & (F.col("low") < F.col("other_high")) & (F.col("other_low") < F.col("high"))
    narrow = ranges.count() >= 8 and ranges.join(other, met).isEmpty()  # a row per file
    return stored.withColumn("narrow", F.lit(narrow))


@query("SELECT * FROM orders")
def clustered(spark, folder):
    """Orders laid out along a curve over date and customer."""
    path = op.scratch_path(spark, "clustered")
    op.cluster(table(spark, folder, "orders"), ["o_orderdate", "o_custkey"]).write.parquet(path)
    return spark.read.parquet(path)


@query("SELECT l_orderkey, l_partkey, l_extendedprice, TRUE AS even FROM lineitem")
def sized_files(spark, folder):
    """Line items in files of a wanted size, which comes from the size of encoded rows."""
    path = op.scratch_path(spark, "sized-files")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    wanted = int(op.bytes_per_row(lines) * lines.count() / 5)
    op.write_files(lines, path, wanted)
    found = op.file_summary(spark, path).first()
    even = found["smallest"] > wanted / 2 and found["largest"] < wanted * 2
    return spark.read.parquet(path).withColumn("even", F.lit(even))


@query("SELECT * FROM lineitem")
def sized_write(spark, folder):
    """Line items partitioned by flag, written with balanced tasks."""
    path = op.scratch_path(spark, "sized")
    lines = table(spark, folder, "lineitem")
    op.sized_for_write(lines, "l_returnflag").write.partitionBy("l_returnflag").parquet(path)
    return spark.read.parquet(path)


_BITS = 5
_CURVE = " + ".join(
    f"(((CAST({column} AS bigint) >> {i}) & 1) << {2 * i + j})"
    for i in range(_BITS)
    for j, column in enumerate(("month_bucket", "customer_bucket"))
)


@query(
    f"""WITH buckets AS (SELECT o_orderkey, month(o_orderdate) AS month_bucket, o_custkey % 32 AS customer_bucket
    FROM orders) SELECT o_orderkey, {_CURVE} AS curve_key FROM buckets"""
)
def zorder_key(spark, folder):
    key = interleave_bits([F.month("o_orderdate"), F.col("o_custkey") % 32], _BITS)
    return table(spark, folder, "orders").select("o_orderkey", key.alias("curve_key"))


@query("SELECT * FROM customer WHERE NOT c_acctbal < 0")
def snapshot_roundtrip(spark, folder):
    """Three versions of a table; the newest is read."""
    path = op.scratch_path(spark, "customer-versions")
    customers = table(spark, folder, "customer")
    op.append_snapshot(customers, path, dt.datetime(2024, 1, 1))
    op.append_snapshot(op.delete_where(op.read_version(spark, path), "c_custkey >= 0"), path, dt.datetime(2024, 1, 2))
    op.append_snapshot(op.delete_where(op.read_version(spark, path, 0), "c_acctbal < 0"), path, dt.datetime(2024, 1, 3))
    return op.read_version(spark, path)


@query(with_layers("SELECT * FROM gold_sales"))
def full_refresh(spark, folder):
    """The fact table after all sources were ingested from CSV files and the three layers rebuilt."""
    files, prefix = op.scratch_path(spark, "sources"), f"r{uuid.uuid4().hex}_"
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "header": "true"}
    for known in SOURCES:
        rows = bronze(spark, folder, known.table)
        rows.write.options(**spaces).csv(f"{files}/{known.system}/{known.file}")
    warehouse.refresh(spark, {system: f"{files}/{system}" for system in ("crm", "erp")}, prefix)
    return read_table(spark, f"{prefix}gold.fact_sales")


@query(
    """SELECT c_custkey, c_name, 'EXTERNAL' AS kind, 'parquet' AS format, 'customers' AS topic, TRUE AS topic_unset,
    TRUE AS described, TRUE AS counted, TRUE AS dropped FROM customer"""
)
def table_metadata(spark, folder):
    """Customers as an external table: its properties, description, detail, and the files after it is dropped."""
    name, path = f"meta_{uuid.uuid4().hex}", op.scratch_path(spark, "external")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    write_table(customers, name, path=path, comment="All customers", properties={"topic": "customers"})
    topic = get_properties(spark, name)["topic"]
    unset_properties(spark, name, ["topic"])
    facts = detail(spark, name).first()
    lines = {r["col_name"]: r["data_type"] for r in describe(spark, name).collect()}
    described = field_types(read_table(spark, name)) == field_types(customers) and lines["Comment"] == "All customers"
    topic_unset = "topic" not in get_properties(spark, name)
    drop_table(spark, name)
    return spark.read.parquet(path).withColumns(
        {
            "kind": F.lit(facts["type"]), "format": F.lit(facts["format"]), "topic": F.lit(topic),
            "topic_unset": F.lit(topic_unset), "described": F.lit(described),
            "counted": F.lit(facts["num_files"] > 0 and facts["size_in_bytes"] > 0),
            "dropped": F.lit(not spark.catalog.tableExists(name)),
        }
    )


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ordered_preview(spark, folder):
    """The first rows in an order: the limit is the feature."""
    return preview(table(spark, folder, "orders"), 10, [F.desc("o_totalprice"), "o_orderkey"])


@query("SELECT l_orderkey, l_linenumber, TRUE AS pushed, TRUE AS pruned FROM lineitem WHERE l_quantity > 40")
def plan_facts(spark, folder):
    """A filtered projection, and whether its plan hands filter and columns to the scan."""
    rows = table(spark, folder, "lineitem").where("l_quantity > 40").select("l_orderkey", "l_linenumber")
    text = plan_text(rows, "formatted")
    pushed = re.search(r"PushedFilters: \[.*GreaterThan\(l_quantity", text) is not None
    scan = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    return rows.withColumns({"pushed": F.lit(pushed), "pruned": F.lit(scan.count(":") == 3)})


@query(
    """SELECT l_orderkey, l_linenumber, (SELECT count(*) FROM lineitem WHERE l_quantity > 45) AS violations,
    TRUE AS stopped FROM lineitem"""
)
def fail_rule(spark, folder):
    """Line items under a fail rule that does not hold: how many rows violate it, and that it stops the run."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rule = op.expect_or_fail("few_pieces", "l_quantity <= 45")
    found = op.rule_report(lines, [rule]).first()["violations"]
    try:
        op.enforce(lines, [rule])
        stopped = False
    except op.RuleViolation as violation:
        stopped = violation.counts == {"few_pieces": found}
    return lines.select("l_orderkey", "l_linenumber", F.lit(found).alias("violations"), F.lit(stopped).alias("stopped"))
