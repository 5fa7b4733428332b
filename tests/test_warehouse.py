import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from tierhouse import operators as op
from tierhouse.operators import expect_or_fail
from tierhouse.plans import checked, gold, silver, warehouse
from tierhouse.sources import SOURCES, init_layers, read_csv, source, write_table


def with_ingest_time(df):
    return df.withColumn("_ingest_timestamp", F.current_timestamp())



def write_csv(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)


@pytest.fixture
def shop(tmp_path):
    """Six small source files with one row per kind of dirt."""
    crm, erp = tmp_path / "crm", tmp_path / "erp"
    write_csv(
        crm, "cust_info.csv",
        "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
        "11000,AW00011000, Jon,Yang ,M,M,2025-10-06\n"
        "11001,AW00011001,Eugene,Huang,s,,2025-10-06\n"
        ",AW00011002,No,Id,S,F,2025-10-06\n"
        "11003,AW00011003,Chris,Zhu,X,x,\n",
    )
    write_csv(
        crm, "prd_info.csv",
        "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt\n"
        "1,AC-HE-HL-U509-R,Helmet,12,S ,2011-07-01,2007-12-28\n"
        "2,AC-HE-HL-U509-R,Helmet,14,S ,2012-07-01,2008-12-27\n"
        "3,CO-RF-FR-R92B-58,Frame,,r ,2003-07-01,\n"
        "4,CO-PE-PD-M282,Pedal,30,,2013-07-01,\n",
    )
    write_csv(
        crm, "sales_details.csv",
        "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,sls_price\n"
        "SO1,HL-U509-R,11000,20101229,20110105,20110110,70,2,\n"
        "SO2,FR-R92B-58,11001,0,20110105,32154,,1,-5\n"
        "SO3,none,99999,20101340,20110105,20110110,10,0,0\n",
    )
    write_csv(erp, "CUST_AZ12.csv", "CID,BDATE,GEN\nNASAW00011000,1971-10-06,Male\nNASAW00011001,2971-10-06,FEMALE\n")
    write_csv(erp, "LOC_A101.csv", "CID,CNTRY\nAW-00011000,Australia\nAW-00011001, DE\nAW-00011003,\n")
    write_csv(
        erp, "PX_CAT_G1V2.csv",
        "ID,CAT,SUBCAT,MAINTENANCE\nAC_HE,Accessories,Helmets,Yes\nCO_RF,Components,Road Frames,no\n",
    )
    return {"crm": str(crm), "erp": str(erp)}


def test_refresh(spark, shop, rows):
    warehouse.refresh(spark, shop, prefix="shop_")
    warehouse.refresh(spark, shop, prefix="shop_")  # a full refresh may run again
    customers = spark.table("shop_gold.dim_customers")
    assert rows(customers, "customer_key", "customer_id", "first_name", "marital_status", "gender", "country") == [
        (1, 11000, "Jon", "Married", "Male", "Australia"),
        (2, 11001, "Eugene", "Single", "Female", "Germany"),
        (3, 11003, "Chris", "n/a", "n/a", "n/a"),
    ]
    assert [r["birthdate"] is None for r in customers.orderBy("customer_key").collect()] == [False, True, True]
    products = spark.table("shop_gold.dim_products")
    assert rows(products, "product_key", "product_id", "product_number", "category", "maintenance_flag", "product_line") == [
        (1, 3, "FR-R92B-58", "Components", False, "Road"),
        (2, 2, "HL-U509-R", "Accessories", True, "Other Sales"),
        (3, 4, "PD-M282", None, None, "n/a"),
    ]
    facts = spark.table("shop_gold.fact_sales")
    assert rows(facts, "order_number", "product_key", "customer_key", "price") == [
        ("SO1", 2, 1, 35.0), ("SO2", 1, 2, None), ("SO3", None, None, None),
    ]
    dates = {r["order_number"]: (str(r["order_date"]), str(r["due_date"])) for r in facts.collect()}
    assert dates == {"SO1": ("2010-12-29", "2011-01-10"), "SO2": ("None", "None"), "SO3": ("None", "2011-01-10")}
    report = spark.sql(
        """SELECT c.country, sum(f.sales_amount) AS total FROM shop_gold.fact_sales f
           LEFT JOIN shop_gold.dim_customers c ON f.customer_key = c.customer_key GROUP BY c.country"""
    )
    assert rows(report) == [(None, 10), ("Australia", 70), ("Germany", None)]


def test_product_versions(spark, shop):
    read = {
        t: read_csv(spark, f"{shop[source(t).system]}/{source(t).file}", source(t).schema)
        for t in ("crm_prd_info", "erp_px_cat_g1v2")
    }
    products, categories = silver.crm_products(read["crm_prd_info"]), silver.erp_categories(read["erp_px_cat_g1v2"])
    counts = {v: gold.dim_products(products, categories, v).count() for v in ("latest", "open", "all")}
    assert counts == {"latest": 3, "open": 2, "all": 4}
    with pytest.raises(ValueError):
        gold.dim_products(products, categories, "some")
    repaired = silver.crm_products(read["crm_prd_info"], repair_ranges=True)
    ends = {r["product_id"]: str(r["end_date"]) for r in repaired.collect()}
    assert ends == {1: "2012-06-30", 2: "None", 3: "None", 4: "None"}
    flagged = op.with_current_flag(products)
    kept = gold.dim_products(flagged, categories, "all", extra=("end_date", "is_current"))
    assert kept.where("is_current").count() == 2


def test_sources_are_complete():
    assert [s.table for s in SOURCES] == [
        "crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2",
    ]
    assert {source for source, _ in silver.BUILDERS.values()} == {s.table for s in SOURCES}


GOLDEN = os.environ.get("GOLDEN_PRODUCTS")
SOURCE_FOLDER = os.environ.get("GOLDEN_SOURCES")


@pytest.fixture(params=["own", "given"])
def golden_files(request, shop, tmp_path):
    """Folder with source files, and the expected product dimension: small ones of our own, and given ones if set."""
    if request.param == "given":
        if not (GOLDEN and SOURCE_FOLDER):
            pytest.skip("GOLDEN_PRODUCTS and GOLDEN_SOURCES are not set")
        return SOURCE_FOLDER, GOLDEN
    expected = tmp_path / "dim_products.csv"
    expected.write_text(
        "product_key,product_id,product_number,product_name,category_id,category,subcategory,maintenance,cost,"
        "product_line,start_date\n"
        "1,3,FR-R92B-58,Frame,CO_RF,Components,Road Frames,No,0,Road,2003-07-01\n"
        "2,2,HL-U509-R,Helmet,AC_HE,Accessories,Helmets,Yes,14,Other Sales,2012-07-01\n"
        "3,4,PD-M282,Pedal,CO_PE,,,,30,n/a,2013-07-01\n"
    )
    return str(tmp_path), str(expected)


def test_golden_products(spark, rows, golden_files):
    """The product dimension equals a given product file, all columns and rows.

    GOLDEN_SOURCES names a folder with the product and category source files at any depth,
    GOLDEN_PRODUCTS the expected dimension as CSV.
    """
    folder, golden_file = golden_files

    def read(table):
        found = next(pathlib.Path(folder).rglob(source(table).file))
        return read_csv(spark, str(found), source(table).schema)

    products, categories = silver.crm_products(read("crm_prd_info")), silver.erp_categories(read("erp_px_cat_g1v2"))
    built = gold.dim_products(products, categories, extra=("product_cost",))
    built = built.withColumns(
        {
            "maintenance": F.when(F.col("maintenance_flag"), "Yes").when(~F.col("maintenance_flag"), "No"),
            "cost": F.col("product_cost"),
        }
    )
    golden = read_csv(
        spark, golden_file,
        "product_key INT, product_id INT, product_number STRING, product_name STRING, category_id STRING,"
        " category STRING, subcategory STRING, maintenance STRING, cost INT, product_line STRING, start_date DATE",
    )
    assert golden.count() > 0
    assert rows(built, *golden.columns) == rows(golden)


def test_checked_refresh(spark, shop, rows):
    sources = {
        t: read_csv(spark, f"{shop[source(t).system]}/{source(t).file}", source(t).schema)
        for t in (*checked.BRONZE, "crm_prd_info")
    }
    init_layers(spark, {"chk_bronze": "", "chk_silver": "", "chk_gold": ""})
    for table, df in sources.items():
        write_table(with_ingest_time(df), f"chk_bronze.{table}")
    counts = checked.refresh(spark, "chk_bronze", "chk_silver", "chk_gold")
    assert counts["crm_customers"] == {"rows": 4, "valid_customer_id": 0, "customer_id_not_empty": 0, "valid_firstname": 0}
    assert counts["sales"]["valid_quantity"] == 1 and counts["fact_sales"]["rows"] == 2
    facts = spark.table("chk_gold.fact_sales")
    assert rows(facts, "sales_order_number", "sales_order_qty", "revenue") == [("SO1", 2, 70), ("SO2", 1, 0)]
    assert rows(spark.table("chk_gold.dim_products"), "product_key", "product_id", "category") == [
        ("FR-R92B-58", "R92B", "Components"), ("HL-U509-R", "U509", "Accessories"), ("PD-M282", "", None),
    ]
    assert "_ingest_timestamp" in spark.table("chk_silver.sales").columns
    customers = spark.table("chk_gold.dim_customers")
    assert rows(customers, "customer_key", "customer_id", "gender", "country") == [
        (1, "AW00011000", "Male", "Australia"), (2, "AW00011001", "Female", "DE"),
        (3, "AW00011002", "Female", None), (4, "AW00011003", None, None),
    ]
    assert spark.table("chk_gold.dim_products").where("is_current").count() == 3


def test_refresh_with_stable_keys_and_history(spark, shop, rows):
    """A product that sorts first and a changed cost arrive: numbers stay, the change becomes a version."""
    day = dt.date(2026, 1, 1)
    warehouse.refresh(spark, shop, prefix="stable_", stable_keys=True, effective=day)
    gold_tables = "stable_gold"
    first = dict(rows(spark.table(f"{gold_tables}.dim_products"), "product_number", "product_key"))
    assert sorted(first.values()) == [1, 2, 3]
    assert rows(spark.table(f"{gold_tables}.product_history"), "product_number", "start_date", "is_current") == [
        (n, day, True) for n in sorted(first)
    ]
    path = pathlib.Path(shop["crm"]) / "prd_info.csv"
    path.write_text(path.read_text() + "9,AC-HE-AA-0000,Visor,3,S,1999-01-01,\n10,AC-HE-HL-U509-R,Helmet,77,S,2014-07-01,\n")
    for _ in range(2):
        warehouse.refresh(spark, shop, prefix="stable_", stable_keys=True, effective=day + dt.timedelta(days=30))
    again = dict(rows(spark.table(f"{gold_tables}.dim_products"), "product_number", "product_key"))
    assert again == first | {"AA-0000": 4}
    history = spark.table(f"{gold_tables}.product_history").where("product_number = 'HL-U509-R'")
    assert rows(history, "start_date", "end_date", "is_current", "product_cost") == [
        (day, dt.date(2026, 1, 30), False, 14), (dt.date(2026, 1, 31), None, True, 77),
    ]
    numbers = [r["product_key"] for r in spark.table(f"{gold_tables}.product_history").collect()]
    assert sorted(numbers) == [1, 2, 3, 4, 5]
    facts = spark.table(f"{gold_tables}.fact_sales").where("product_key IS NOT NULL")
    assert {r["product_key"] for r in facts.collect()} <= set(first.values())


def test_refresh_from_new_files_alone(spark, shop, rows, tmp_path):
    """A second delivery, with columns in another order, is added to what the first one brought."""
    for system in ("crm", "erp"):
        (tmp_path / "in" / system).mkdir(parents=True)
        pathlib.Path(shop[system]).rename(tmp_path / "in" / system / "first")
    folders = {s: str(tmp_path / "in" / s / "*") for s in ("crm", "erp")}

    def load():
        warehouse.refresh(spark, folders, prefix="added_", checkpoints=str(tmp_path / "checkpoints"))
        return rows(spark.table("added_gold.dim_customers"), "customer_id", "first_name", "customer_key")

    first = [(11000, "Jon", 1), (11001, "Eugene", 2), (11003, "Chris", 3)]
    assert load() == first
    write_csv(
        tmp_path / "in" / "crm" / "second", "cust_info.csv",
        "cst_key,cst_id,cst_lastname,cst_firstname,cst_gndr,cst_marital_status,cst_create_date\n"
        "AW00011005,11005,New,Ana,F,S,2025-10-07\n",
    )
    assert load() == [*first, (11005, "Ana", 4)] == load()
    assert spark.table("added_bronze.crm_cust_info").count() == 5 and spark.table("added_gold.fact_sales").count() == 3


def test_a_refresh_leaves_no_scratch_files(spark, shop):
    scratch = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "tierhouse"
    before = set(scratch.iterdir()) if scratch.exists() else set()
    warehouse.refresh(spark, shop, prefix="neat_")
    assert set(scratch.iterdir()) == before and spark.table("neat_gold.fact_sales").count() == 3


def test_a_key_that_occurs_twice_stops_the_refresh(spark, shop):
    path = pathlib.Path(shop["crm"]) / "cust_info.csv"
    path.write_text(path.read_text() + "11000,AW00011009,Twice,Yang,M,M,2025-10-06\n")
    with pytest.raises(op.RuleViolation, match="unique"):
        warehouse.refresh(spark, shop, prefix="twice_")
    init_layers(spark, {"two_silver": "", "two_gold": ""})
    with pytest.raises(op.RuleViolation, match="unique"):
        checked.refresh(spark, "twice_bronze", "two_silver", "two_gold")


def test_a_failed_rule_leaves_the_table(spark):
    init_layers(spark, {"kept": ""})
    checked.publish(spark.range(3), "kept.t", [expect_or_fail("few", "id < 3")], comment="three rows")
    with pytest.raises(Exception, match="rule few violated"):
        checked.publish(spark.range(9), "kept.t", [expect_or_fail("few", "id < 3")])
    assert spark.table("kept.t").count() == 3


def test_rows_under_a_fail_rule_are_written_once(spark):
    init_layers(spark, {"once": ""})
    for rows in (3, 2):  # the second one takes the place of the first
        scratch = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "tierhouse"
        before = set(scratch.iterdir()) if scratch.exists() else set()
        counts = checked.publish(spark.range(rows), "once.t", [expect_or_fail("few", "id < 3")], comment="some rows")
        assert counts == {"rows": rows, "few": 0} and spark.table("once.t").count() == rows
        assert (set(scratch.iterdir()) if scratch.exists() else set()) == before
        lines = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED once.t").collect()}
        assert lines["Type"] == "MANAGED" and lines["Comment"] == "some rows"
    assert [t.name for t in spark.catalog.listTables("once") if not t.isTemporary] == ["t"]
    folder = pathlib.Path(lines["Location"].removeprefix("file:"))
    assert folder.name == "t" and [p.name for p in folder.parent.iterdir()] == ["t"]
