import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from tierhouse import operators as op
from tierhouse import sources, streaming

T0, T1, T2 = (dt.datetime(2024, 1, day) for day in (1, 2, 3))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def write_csv(path, name, *lines):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\r\n".join(lines) + "\r\n")


# --- sources -------------------------------------------------------------------------------


def test_read_csv(spark, tmp_path):
    write_csv(tmp_path, "items.csv", "id,name,day", "1,a,2020-01-01", "2,,")
    write_csv(tmp_path, "other.csv", "id,name,day", "9,z,2020-01-01")
    inferred = sources.read_csv(spark, str(tmp_path / "items.csv"))
    assert inferred.dtypes == [("id", "int"), ("name", "string"), ("day", "date")]
    typed = sources.read_csv(spark, str(tmp_path), "id BIGINT, name STRING, day DATE", "items.csv")
    assert [r["id"] for r in typed.orderBy("id").collect()] == [1, 2]
    assert typed.where("id = 2").first()["name"] is None


def test_csv_columns_are_found_by_name(spark, tmp_path):
    write_csv(tmp_path / "a", "loc.csv", "CNTRY,extra,cid", "Germany,1,AW1", "1x,2,AW2")
    found = sources.read_csv(spark, str(tmp_path / "a"), "CID STRING, CNTRY STRING")
    assert [tuple(r) for r in found.orderBy("CID").collect()] == [("AW1", "Germany"), ("AW2", "1x")]
    with pytest.raises(ValueError, match="no column name"):
        sources.read_csv(spark, str(tmp_path / "a"), "CID STRING, name STRING")
    write_csv(tmp_path / "a", "more [1].csv", "cid,CNTRY", "AW3,France")
    (tmp_path / "a" / "none.csv").write_text("")
    both = sources.read_csv(spark, str(tmp_path / "a"), "CID STRING, CNTRY STRING", metadata=True)
    assert [tuple(r)[:2] for r in both.orderBy("CID").collect()] == [("AW1", "Germany"), ("AW2", "1x"), ("AW3", "France")]
    assert both.where("CID = 'AW3' AND _source_file LIKE '%more%'").count() == 1
    write_csv(tmp_path / "a", "wrong.csv", "cid,place", "AW4,Spain")
    with pytest.raises(ValueError, match="no column CNTRY"):
        sources.read_csv(spark, str(tmp_path / "a"), "CID STRING, CNTRY STRING")
    assert sources.read_csv(spark, str(tmp_path / "a"), "CID STRING, CNTRY STRING", "absent*").isEmpty()


def test_first_lines_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources.files, "_FILES_PER_JOB", 3)
    for i in range(8):
        write_csv(tmp_path, f"f{i}.csv", f"h{i % 3},\"a,b\"", "1,2", "3,4")
    found = sources.header_manifest(spark, str(tmp_path), "f*.csv")
    assert {pathlib.PurePath(f).name: h for f, h in found.items()} == {f"f{i}.csv": f"h{i % 3},\"a,b\"" for i in range(8)}


def test_bad_rows_are_kept_or_fail(spark, tmp_path):
    write_csv(tmp_path, "a.csv", "id,name", "1,a", "1x,b", "3,c,surplus", "4")
    kept = sources.read_csv(spark, str(tmp_path), "name STRING, id INT", bad_records="keep").cache()
    assert sorted((r["id"], r["name"], r["_bad_record"]) for r in kept.where("id IS NOT NULL").collect()) == [
        (1, "a", None), (3, "c", "3,c,surplus"), (4, None, "4")
    ]
    assert [(r["name"], r["_bad_record"]) for r in kept.where("id IS NULL").collect()] == [("b", "1x,b")]
    assert sources.bad_records(kept).count() == 3
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        sources.read_csv(spark, str(tmp_path), "name STRING, id INT").collect()


def test_stream_finds_columns_by_name_and_keeps_bad_rows(spark, tmp_path):
    files, sink = tmp_path / "in", streaming.Sink(path=str(tmp_path / "out"))

    def load():
        streaming.ingest_files(spark, str(files), "id INT, name STRING", str(tmp_path / "memory"), sink)
        found = spark.read.parquet(str(tmp_path / "out"))
        return sorted((r["name"], r["id"], r["_bad_record"], r["_batch"]) for r in found.collect())

    write_csv(files, "a.csv", "name,id", "x,1", "y,z")
    write_csv(files, "b.csv", "id,more,name", "2,m,v")
    first = [("v", 2, None, 0), ("x", 1, None, 0), ("y", None, "y,z", 0)]
    assert load() == first
    write_csv(files, "c.csv", "more,NAME,id", "m,w,3")
    assert load() == sorted([*first, ("w", 3, None, 1)])


def test_a_failed_batch_comes_again_and_is_written_once(spark, tmp_path):
    files, out = tmp_path / "in", str(tmp_path / "out")
    sink, tries = streaming.Sink(path=out), []
    write_csv(files, "a.csv", "id", "1", "2")

    def process(batch, number):
        rows = sources.read_csv(batch.sparkSession, [r["path"] for r in batch.collect()], "id INT")
        sink.put(rows, number)
        tries.append(number)
        if len(tries) == 1:
            raise RuntimeError("lost after the write")

    def run():
        streaming.run_batches(streaming.stream_files(spark, str(files)), str(tmp_path / "memory"), process)

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    run()
    assert tries == [0, 0]
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_rules_on_a_stream(spark, tmp_path):
    files, memory = tmp_path / "in", str(tmp_path / "memory")
    sinks = [streaming.Sink(path=str(tmp_path / name)) for name in ("kept", "dropped", "counts")]
    rules = [op.expect("named", "name IS NOT NULL"), op.expect_or_drop("positive", "id > 0"), op.expect_or_fail("small", "id < 100")]

    def load():
        streaming.ingest_files(spark, str(files), "id INT, name STRING", memory, sinks[0], rules=rules,
                               quarantine=sinks[1], metrics=sinks[2])
        return [spark.read.parquet(s.path) for s in sinks]

    write_csv(files, "a.csv", "id,name", "1,a", "-1,", "2,")
    load()
    write_csv(files, "b.csv", "name,id", "c,3")
    kept, dropped, counts = load()
    assert sorted((r["id"], r["_batch"]) for r in kept.collect()) == [(1, 0), (2, 0), (3, 1)]
    assert [(r["id"], r["_violated"], r["_batch"]) for r in dropped.collect()] == [(-1, ["named", "positive"], 0)]
    told = sorted((r["_batch"], r["rule"], r["action"], r["checked"], r["violations"]) for r in counts.collect())
    assert told == [(0, "named", "warn", 3, 2), (0, "positive", "drop", 3, 1), (0, "small", "fail", 3, 0),
                    (1, "named", "warn", 1, 0), (1, "positive", "drop", 1, 0), (1, "small", "fail", 1, 0)]
    write_csv(files, "c.csv", "id,name", "4,d", "500,e")
    with pytest.raises(Exception, match="small violated"):
        load()
    assert kept.count() == 3 and spark.read.parquet(sinks[2].path).count() == 6


def test_ingest_all(spark, tmp_path):
    write_csv(tmp_path, "a.csv", "id", "1", "2")
    write_csv(tmp_path, "b.csv", "id", "3")
    sources.init_layers(spark, {"raw_zone": "it's raw"})
    items = [
        {"source": "x", "path": str(tmp_path / "a.csv"), "table": "a", "schema": "id INT"},
        {"source": "x", "path": str(tmp_path / "b.csv"), "table": "b"},
    ]
    written = sources.ingest_all(spark, items, "raw_zone", metadata=True)
    assert written == {"a": "raw_zone.a", "b": "raw_zone.b"}
    sources.ingest_all(spark, items, "raw_zone", metadata=True)
    table = sources.read_table(spark, "raw_zone.a")
    assert table.count() == 2 and table.where("_source_file LIKE '%a.csv' AND _ingest_timestamp IS NOT NULL").count() == 2


def test_stream_loads_each_file_once(spark, tmp_path):
    files, out, memory = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "memory")
    write_csv(files, "cust_1.csv", "id,name", "1,a", "2,b")
    write_csv(files, "prd_1.csv", "id,name", "7,x")

    def load():
        sink = streaming.Sink(path=out)
        streaming.ingest_files(spark, str(files), "id INT, name STRING", memory, sink, "cust_*.csv", files_per_batch=1)
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    assert load() == [1, 2]
    assert load() == [1, 2]
    write_csv(files, "cust_2.csv", "id,name", "3,c")
    assert load() == [1, 2, 3]
    with pytest.raises(ValueError):
        streaming.Sink("a.table", out)


def test_ingest_sources_into_tables(spark, tmp_path):
    write_csv(tmp_path / "erp_1", "PX_CAT_G1V2.csv", "ID,CAT,SUBCAT,MAINTENANCE", "AC_BR,Accessories,Racks,Yes")
    sources.init_layers(spark, {"stream_zone": "x"})
    wanted = [sources.source("erp_px_cat_g1v2")]
    rules = {"erp_px_cat_g1v2": [op.expect_or_drop("has_id", "length(ID) > 0")]}

    def load():
        folders = {"erp": str(tmp_path / "erp_*")}
        streaming.ingest_sources(spark, folders, "stream_zone", str(tmp_path / "checkpoints"), wanted, rules=rules)

    load()
    load()
    assert spark.table("stream_zone.erp_px_cat_g1v2").count() == 1
    write_csv(tmp_path / "erp_2", "PX_CAT_G1V2.csv", "CAT,ID,MAINTENANCE,SUBCAT", "Bikes,BI_MB,No,Mountain", "None,,No,x")
    load()
    assert spark.table("stream_zone.erp_px_cat_g1v2").where("ID = 'BI_MB' AND CAT = 'Bikes' AND _batch = 1").count() == 1
    assert [r["CAT"] for r in spark.table("stream_zone.erp_px_cat_g1v2_dropped").collect()] == ["None"]
    counts = spark.table("stream_zone.erp_px_cat_g1v2_rules").orderBy("_batch").collect()
    assert [(r["checked"], r["violations"]) for r in counts] == [(1, 0), (2, 1)]


# --- catalog -------------------------------------------------------------------------------


def test_table_life(spark, folder):
    sources.init_layers(spark, {"life": "first"})
    sources.init_layers(spark, {"life": "again"})
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    sources.write_table(df, "life.t", comment="it's ten", properties={"domain": "products", "pii": "false"})
    sources.write_table(df.limit(4), "life.t", properties={"domain": "products", "pii": "false"})
    assert sources.read_table(spark, "life.t").count() == 4
    sources.unset_properties(spark, "life.t", ["pii", "absent"])
    properties = sources.get_properties(spark, "life.t")
    assert properties["domain"] == "products" and "pii" not in properties
    detail = sources.detail(spark, "life.t").first()
    assert detail["type"] == "MANAGED" and detail["num_files"] >= 1 and detail["size_in_bytes"] > 0
    sources.write_table(df, "life.ext", path=f"{folder}/ext", partition_by=["part"], sized=True)
    kind = sources.describe(spark, "life.ext").where("col_name = 'Type'").first()["data_type"]
    assert kind == "EXTERNAL"
    sources.drop_table(spark, "life.ext")
    sources.drop_table(spark, "life.ext")
    assert spark.read.parquet(f"{folder}/ext").count() == 10


def test_a_sized_table_is_written_without_a_shuffle(spark, folder, monkeypatch):
    monkeypatch.setattr(sources.catalog, "FILE_ROWS", 100)
    sources.init_layers(spark, {"sized": "x"})
    spark.range(1000).repartition(1).write.parquet(f"{folder}/to-size")
    sources.write_table(spark.read.parquet(f"{folder}/to-size"), "sized.t", sized=True)
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    written = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "sized.db/t" in p]
    assert written and not any("Exchange" in p for p in written)
    assert sources.detail(spark, "sized.t").first()["num_files"] == 10
    assert spark.table("sized.t").distinct().count() == 1000


def test_bucketed_tables_join_without_shuffle(spark):
    sources.init_layers(spark, {"buckets": "x"})
    for name in ("a", "b"):
        sources.write_table(spark.range(1000), f"buckets.{name}", bucket_by=(4, ["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("buckets.a").join(spark.table("buckets.b"), "id")
        assert "Exchange" not in sources.plan_text(joined, "simple") and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_preview_and_schema(spark):
    df = spark.range(100).withColumn("v", -F.col("id"))
    sources.register_view(df, "here")
    sources.register_view(df, "there", everywhere=True)
    assert spark.sql("SELECT count(*) FROM here JOIN global_temp.there USING (id)").first()[0] == 100
    assert [r["id"] for r in sources.preview(df, 2, ["v"]).collect()] == [99, 98]
    assert sources.preview(df).count() == 10
    assert sources.field_types(df) == {"id": "bigint", "v": "bigint"}
    assert "Optimized Logical Plan" in sources.plan_text(df)


# --- snapshots -----------------------------------------------------------------------------


def test_snapshots(spark, folder, rows):
    path = f"{folder}/versions"
    assert op.latest_number(spark, path) is None
    assert op.append_snapshot(spark.range(5), path, T0) == 0
    assert op.append_snapshot(spark.range(8), path, T1) == 1
    bad = op.delete_where(op.read_version(spark, path), "1 = 1")
    assert op.append_snapshot(bad, path, T2) == 2
    assert op.read_version(spark, path).count() == 0
    assert op.read_version(spark, path, 0).count() == 5
    assert op.read_as_of(spark, path, T1).count() == 8
    assert op.read_as_of(spark, path, "2024-01-01 12:00:00").count() == 5
    with pytest.raises(LookupError):
        op.read_as_of(spark, path, "2023-12-31")
    assert op.restore(spark, path, 1, dt.datetime(2024, 1, 4)) == 3
    assert op.read_version(spark, path).count() == 8
    assert [tuple(r) for r in op.history(spark, path).collect()] == [
        (3, dt.datetime(2024, 1, 4), "RESTORE", 8), (2, T2, "WRITE", 0), (1, T1, "WRITE", 8), (0, T0, "WRITE", 5),
    ]
    with pytest.raises(ValueError, match="not before"):
        op.append_snapshot(spark.range(1), path, dt.datetime(2024, 1, 3))
    with pytest.raises(LookupError):
        op.read_version(spark, path, 9)
    assert rows(op.expired_versions(spark, path, "2024-01-10 00:00:00"), "_version") == [(0,)]
    assert rows(op.expired_versions(spark, path, "2024-01-10 00:00:00", 24), "_version") == [(0,), (1,), (2,)]
    assert op.expired_versions(spark, path, "2024-01-04 00:00:00").isEmpty()
    assert op.read_version(spark, path, 0).count() == 5


def test_snapshot_schema_may_change(spark, folder):
    path = f"{folder}/versions"
    op.append_snapshot(spark.range(2), path, T0)
    op.append_snapshot(spark.range(2).withColumn("extra", F.lit("x")), path, T1)
    assert op.read_version(spark, path, 0).columns == ["id"]
    assert op.read_version(spark, path).columns == ["id", "extra"]


# --- layout --------------------------------------------------------------------------------


def test_compact(spark, folder):
    small, large = f"{folder}/small", f"{folder}/large"
    df = spark.range(10_000)
    df.repartition(40).write.parquet(small)
    assert op.file_summary(spark, small).first()["files"] == 40
    op.compact(spark, small, large)
    assert op.file_summary(spark, large).first()["files"] == 1
    op.compact(spark, small, f"{folder}/middle", file_bytes=op.file_summary(spark, small).first()["bytes"] // 4)
    assert 3 <= op.file_summary(spark, f"{folder}/middle").first()["files"] <= 7
    assert spark.read.parquet(large).exceptAll(df).isEmpty()
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_compact_keeps_columns_and_folders(spark, folder):
    small, large = f"{folder}/by=x/small", f"{folder}/large"
    ids = spark.range(40).withColumn("part", F.concat(F.lit("00"), F.col("id") % 3))
    ids.repartition(5).write.partitionBy("part").parquet(small)
    ids.withColumn("extra", F.lit("e")).repartition(5).write.mode("append").partitionBy("part").parquet(small)
    op.compact(spark, small, large)
    found = spark.read.option("basePath", large).parquet(*[f"{large}/part=00{k}" for k in range(3)])
    assert found.count() == 80 and found.where("extra = 'e'").count() == 40
    assert op.file_summary(spark, large).first()["files"] == 3
    spark.range(3).withColumn("id", F.lit("text")).write.mode("append").parquet(f"{folder}/mixed")
    spark.range(3).write.mode("append").parquet(f"{folder}/mixed")
    with pytest.raises(Exception, match="(?i)merge"):
        op.compact(spark, f"{folder}/mixed", f"{folder}/never")


def test_cluster_by_texts_with_one_beginning(spark):
    rows = spark.range(20_000).withColumn("name", F.format_string("AW%010d", "id")).repartition(7)
    keyed = op.with_curve_key(rows, ["name"], "curve", bits=6)
    assert keyed.select("curve").distinct().count() == 64
    odd = spark.createDataFrame([(x, None if x == 1.0 else "a") for x in (float("nan"), float("inf"), 1.0, -5.0)], "x DOUBLE, t STRING")
    assert op.cluster(odd, ["x", "t"]).count() == 4


def test_row_hash_of_nested_maps(spark):
    rows = spark.sql("SELECT id, array(map('k', id % 3)) AS m, map('a', 1, 'b', id) AS n FROM range(6)")
    numbered = op.surrogate_key(rows, ["id"])
    assert [r["surrogate_key"] for r in numbered.orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]


def test_cluster_narrows_the_ranges_of_files(spark, folder):
    df = spark.range(40_000).select(
        (F.hash("id") % 1000).alias("a"), (F.hash(F.col("id") + 7) % 1000).alias("b"), F.col("id").cast("string").alias("s")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        op.cluster(df, ["a", "b"]).write.parquet(f"{folder}/z")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{folder}/z")
    assert back.exceptAll(df).isEmpty()
    files = back.groupBy("_metadata.file_path").agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).collect()
    assert len(files) >= 4
    hits = [sum(low <= 100 <= high for low, high in [r[i : i + 2] for r in files]) for i in (1, 3)]
    assert all(h < len(files) for h in hits)  # a point filter on either column skips files


def test_cluster_types_and_hot_values(spark, folder):
    df = spark.range(2000).select(
        F.lit("same").alias("s"), F.lit(dt.date(2020, 1, 1)).alias("d"), (F.col("id") % 2 == 0).alias("b"),
        F.when(F.col("id") > 5, F.col("id").cast("double")).alias("x"), F.current_timestamp().alias("t"),
        F.col("id").cast("decimal(10,2)").alias("m"),
    )
    assert op.cluster(df, ["s", "d", "b", "x", "t", "m"], bits=4).count() == 2000


def test_sized_write_splits_a_hot_value(spark):
    df = spark.range(1000).withColumn("k", F.lit(1))
    plan = op.sized_for_write(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


# --- sizes and filters -------------------------------------------------------------------------


def scanned_rows(df):
    """Rows that the scan of an executed frame put out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if hasattr(plan, "executedPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_of_an_absent_key_reads_no_row_group(spark, folder):
    sources.init_layers(spark, {"filters": "x"})
    rows = spark.range(20_000).select((F.col("id") * 2).alias("k"), F.uuid().alias("v"))
    sources.write_table(rows.repartition(2), "filters.with_bloom", path=f"{folder}/b", bloom=["k"])
    sources.write_table(rows.repartition(2), "filters.without", path=f"{folder}/n")
    read = {}
    for name in ("with_bloom", "without"):
        for key in (5001, 5000):
            found = spark.table(f"filters.{name}").where(F.col("k") == key)
            assert len(found.collect()) == (key == 5000)
            read[name, key] = scanned_rows(found)
    assert read["with_bloom", 5001] == 0
    assert read["without", 5001] == 20_000
    assert 0 < read["with_bloom", 5000] < 20_000


def test_files_of_a_wanted_size(spark, folder):
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    op.write_files(rows, f"{folder}/sized", 2_000_000)
    found = op.file_summary(spark, f"{folder}/sized").first()
    assert found["files"] > 4 and 1_000_000 < found["smallest"] <= found["largest"] < 4_000_000
    assert spark.read.parquet(f"{folder}/sized").count() == 200_000
    assert op.rows_within(rows, 2_000_000) == pytest.approx(2_000_000 / op.bytes_per_row(rows), rel=0.1)
    assert op.bytes_per_row(rows.limit(0)) == 1.0


def test_compaction_leaves_large_files_alone(spark, folder):
    for part, files in (("x", 1), ("y", 9), ("z", 1)):
        spark.range(30_000).repartition(files).write.parquet(f"{folder}/in/p={part}")
    spark.range(7).coalesce(1).write.mode("append").parquet(f"{folder}/in/p=z")
    large = max(r["length"] for r in op.files_of(spark, f"{folder}/in").collect())
    plan = {r["path"]: r["bin"] for r in op.compaction_plan(spark, f"{folder}/in", large, large // 2).collect()}
    assert sum(b is not None for b in plan.values()) == 9
    live = op.compact_small(spark, f"{folder}/in", f"{folder}/out", large, large // 2)
    assert {p for p, b in plan.items() if b is None} <= set(live) and len(live) < len(plan)
    assert spark.read.option("recursiveFileLookup", "true").parquet(*live).count() == 90_007
    assert spark.read.parquet(f"{folder}/out").select("p").distinct().collect()[0]["p"] == "y"
    untouched = op.compact_small(spark, f"{folder}/in", f"{folder}/none", large, 1)
    assert set(untouched) == set(plan)
