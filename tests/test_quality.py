import pytest
from pyspark.sql import functions as F

from tierhouse import operators as op
from tierhouse.plans import checked, rules

RULES = [
    op.expect("known", "v IS NOT NULL"),
    op.expect_or_drop("positive", "v > 0"),
    op.expect_or_fail("small", "v < 100"),
]


def values(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "v INT")


def test_drop_counts_and_null_is_a_violation(spark):
    kept, counts = op.apply_rules(values(spark, 1, 0, None, 5), RULES)
    assert sorted(r["v"] for r in kept.collect()) == [1, 5]
    assert counts.get == {"rows": 4, "known": 1, "positive": 2, "small": 0}


def test_fail_rule_stops_the_action(spark):
    kept, _ = op.apply_rules(values(spark, 1, 100), RULES)
    with pytest.raises(Exception, match="rule small violated"):
        kept.collect()


def test_fail_rule_ignores_dropped_rows(spark):
    # NULL violates the fail rule as well, but the drop rule takes the row out first.
    kept, counts = op.apply_rules(values(spark, 1, None), RULES)
    assert kept.where("v > 0").count() == 1
    assert counts.get["small"] == 0


def test_enforce(spark):
    assert op.enforce(values(spark, 1, 0), RULES).count() == 1
    with pytest.raises(op.RuleViolation) as problem:
        op.enforce(values(spark, 1, 100, 200), RULES)
    assert problem.value.counts == {"small": 2}


def test_rule_report(spark, rows):
    assert rows(op.rule_report(values(spark, 1, 0, None, 200), RULES)) == [
        ("known", "warn", 4, 1), ("positive", "drop", 4, 2), ("small", "fail", 4, 1),
    ]


def test_report_is_one_pass(spark):
    plan = op.rule_report(spark.range(10).selectExpr("CAST(id AS INT) AS v"), RULES)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Range (") == 1


def test_unknown_action():
    with pytest.raises(ValueError):
        op.Rule("x", "1 = 1", "explode")


def test_require_unique(spark, rows):
    df = values(spark, 1, 2, 2, None, None)
    with pytest.raises(op.RuleViolation):
        op.require_unique(df, ["v"])
    assert rows(op.duplicate_keys(df, ["v"])) == [(None, 2), (2, 2)]
    assert op.require_unique(values(spark, 1, 2), ["v"]).count() == 2


def test_null_counts_one_pass(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a INT, b STRING")
    counts = op.null_counts(df, ["a", "b"])
    assert rows(counts) == [("a", 1), ("b", 2)]


def test_amount_checks(spark, rows):
    df = spark.createDataFrame(
        [(1, 10, 2, 5), (2, 11, 2, 5), (3, None, 2, 5), (4, 0, 0, 5), (5, 5, 1, -5), (6, 5, None, 5)],
        "id INT, sales INT, quantity INT, price INT",
    )
    assert [r[0] for r in rows(op.amount_mismatches(df, ["id"]), "id")] == [2, 3, 4, 5]
    assert [r[0] for r in rows(op.negative_amounts(df, ["id"]), "id")] == [4, 5]


def test_dates_in_order(spark):
    df = spark.createDataFrame([("2020-01-02", "2020-01-01"), ("2020-01-01", None), (None, "2020-01-01")], "a STRING, b STRING")
    rule = op.expect("order", op.dates_in_order("a", "b"))
    assert [r[0] for r in df.select(rule.holds).collect()] == [False, True, False]


def test_catalogue_covers_all_tables():
    declared = [r for table in checked.RULES.values() for r in table]
    assert len(declared) == 25
    assert sum(r.action == "drop" for r in declared) == 7
    assert sum(r.action == "fail" for r in declared) == 3
    assert rules.FACT_SALES[0].name == "has_dimension_keys"


def test_checked_builders_end_to_end(spark, rows):
    crm = spark.createDataFrame(
        [(1, " aw1 ", " Ann", "Lee ", "S", " f ", "2024-01-01"), (2, "AW2", None, "Kay", "M", "  ", "bad")],
        "cst_id INT, cst_key STRING, cst_firstname STRING, cst_lastname STRING, cst_marital_status STRING,"
        " cst_gndr STRING, cst_create_date STRING",
    )
    erp = spark.createDataFrame([("NASAW2", "19711006", "Male"), ("AW1", "0", "F")], "CID STRING, BDATE STRING, GEN STRING")
    places = spark.createDataFrame([("AW-1", " Canada "), ("NASAW2", "")], "CID STRING, CNTRY STRING")
    items = spark.createDataFrame([("ac_br ", "Accessories", "Racks", "Yes")], "ID STRING, CAT STRING, SUBCAT STRING, MAINTENANCE STRING")
    lines = spark.createDataFrame(
        [("so1", "AC_BR", 1, 20200101, 20200102, 0, "10", "2", "5"), ("so2", "none", 2, 0, 0, 0, "x", "1", None)],
        "sls_ord_num STRING, sls_prd_key STRING, sls_cust_id INT, sls_order_dt INT, sls_ship_dt INT, sls_due_dt INT,"
        " sls_sales STRING, sls_quantity STRING, sls_price STRING",
    )
    customers = checked.dim_customers(
        checked.crm_customers(crm), checked.erp_customers(erp), checked.erp_locations(places)
    )
    assert rows(customers, "customer_key", "customer_id", "gender", "country") == [
        (1, "AW1", "Female", "Canada"), (2, "AW2", "Male", ""),
    ]
    products = checked.dim_products(checked.erp_products(items))
    assert rows(products, "product_key_sk", "product_key", "maintenance", "is_current") == [(1, "AC_BR", True, True)]
    facts = checked.fact_sales(checked.sales(lines), customers, products)
    kept, counts = op.apply_rules(facts, rules.FACT_SALES)
    assert [(r["customer_key"], r["product_key_sk"], float(r["revenue"])) for r in kept.collect()] == [(1, 1, 10.0)]
    assert counts.get["has_dimension_keys"] == 1
    codes = checked.crm_customers(crm, label_gender=False).select(F.col("gender"))
    assert [r[0] for r in codes.collect()] == ["f", ""]
