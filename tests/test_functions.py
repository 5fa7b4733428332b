import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierhouse import functions as fn
from tierhouse import sources
from tierhouse.plans import labels


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_trim_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(1, " a ", "b  ", 2.5)], "`x y` INT, `a.b` STRING, c STRING, d DOUBLE")
    assert tuple(fn.trim_strings(df).first()) == (1, "a", "b", 2.5)
    assert fn.trim_strings(df).columns == df.columns


def test_clean_keys_named_and_all(spark):
    df = spark.createDataFrame([(" NASAW-1 ", "Guinea-Bissau", 1)], "k STRING, c STRING, n INT")
    assert tuple(fn.clean_keys(df, ["k"], "-").first()) == ("NASAW1", "Guinea-Bissau", 1)
    assert tuple(fn.clean_keys(df).first()) == ("NASAW1", "GuineaBissau", 1)
    assert tuple(fn.clean_keys(df, ["k"], "^NAS").first())[0] == "AW-1"


def test_rename_is_case_insensitive_and_skips_missing(spark):
    df = spark.createDataFrame([(1, 2)], "CID INT, other INT")
    assert fn.rename_columns(df, {"cid": "customer_number", "zz": "y"}).columns == ["customer_number", "other"]


@pytest.mark.parametrize(
    ("mapping", "values", "expected"),
    [
        (labels.MARITAL_STATUS, ["S", "m", "", None, "X"], ["Single", "Married", "n/a", "n/a", "n/a"]),
        (labels.GENDER_LONG, ["F", "male", "FEMALE", "", None], ["Female", "Male", "Female", "n/a", "n/a"]),
        (labels.PRODUCT_LINE, ["M", "r", "S", "t", None], ["Mountain", "Road", "Other Sales", "Touring", "n/a"]),
    ],
)
def test_map_codes(spark, mapping, values, expected):
    assert column(spark, "STRING", values, lambda c: fn.map_codes(c, mapping)) == expected


def test_map_codes_passthrough_and_case(spark):
    values = ["DE", "US", "USA", "", None, "Australia", "de"]
    expected = ["Germany", "United States", "United States", "n/a", "n/a", "Australia", "de"]
    assert column(
        spark, "STRING", values, lambda c: fn.map_codes(c, labels.COUNTRY, passthrough=True, ignore_case=False)
    ) == expected
    assert column(spark, "STRING", ["m", "M"], lambda c: fn.map_codes(c, labels.GENDER, ignore_case=False)) == ["n/a", "Male"]


def test_yes_no_flag(spark):
    assert column(spark, "STRING", ["Yes", "NO", "", "maybe", None], fn.yes_no_flag) == [True, False, None, None, None]


def test_strip_prefix(spark):
    values = ["NASAW00011000", "AW00011000", "XNAS1", "NAS", None]
    assert column(spark, "STRING", values, lambda c: fn.strip_prefix(c, "NAS")) == [
        "AW00011000", "AW00011000", "XNAS1", "", None,
    ]


def test_prefer(spark):
    df = spark.createDataFrame(
        [("Male", "Female"), ("n/a", "Female"), (None, "Female"), ("n/a", None)], "p STRING, f STRING"
    )
    p, f = F.col("p"), F.col("f")
    got = df.select(fn.prefer(p, f, "n/a", "n/a"), fn.prefer(p, f)).collect()
    assert [tuple(r) for r in got] == [("Male", "Male"), ("Female", "Female"), ("Female", "Female"), ("n/a", None)]


DATES = [20101229, 0, 32154, 20101340, 20100230, -1234567, None]


def test_parse_yyyymmdd_numbers(spark):
    expected = [dt.date(2010, 12, 29), None, None, None, None, None, None]
    assert column(spark, "INT", DATES, fn.parse_yyyymmdd) == expected
    assert column(spark, "INT", DATES, fn.lenient_date) == expected


def test_parse_yyyymmdd_text(spark):
    values = ["20101229", "0", "", "2010-12-29", "junk", "20101340", "2010 1 1", "+1230101", "32154", None]
    day = dt.date(2010, 12, 29)
    assert column(spark, "STRING", values, fn.parse_yyyymmdd) == [day] + [None] * 9
    assert column(spark, "STRING", values, fn.lenient_date) == [day, None, None, day] + [None] * 6


WHOLE = [
    20101229, 20240229, 20230229, 19000229, 20000229, 20100631, 20100600, 20100001, 20101301, 99991231, 10000101, 9999999,
    100000000, 2010, 1000, 999, 99999, 0, 7, -2010, -20101229, 2**31 - 1, -(2**31), None,
]


@pytest.mark.parametrize("make", [fn.parse_yyyymmdd, fn.lenient_date])
def test_dates_of_numbers_need_no_pattern_and_equal_those_of_their_text(spark, make):
    df = spark.createDataFrame([(n,) for n in WHOLE], "n INT").select("n", F.col("n").cast("string").alias("t"))
    df = df.withColumn("long", F.col("n").cast("bigint"))
    got = df.select(make(F.col("n")), make(F.col("long")), make(F.col("t"))).collect()
    assert [(r[0], r[1]) for r in got] == [(r[2], r[2]) for r in got] and sum(r[0] is not None for r in got) >= 5
    lines = spark.range(9).select(F.col("id").cast("int").alias("n"))
    assert "regexp" not in sources.plan_text(lines.select(make(F.col("n")).alias("day")), "simple")
    far = spark.range(2**62, 2**62 + 2).select(make(F.col("id")), make(-F.col("id")))
    assert [tuple(r) for r in far.collect()] == [(None, None)] * 2


def test_lenient_date_keeps_dates(spark):
    assert column(spark, "DATE", [dt.date(1971, 10, 6), None], fn.lenient_date) == [dt.date(1971, 10, 6), None]


def test_future_to_null(spark):
    today = dt.date(2024, 1, 1)
    values = [dt.date(2023, 12, 31), today, dt.date(2024, 1, 2), None]
    assert column(spark, "DATE", values, lambda c: fn.future_to_null(c, today)) == [values[0], today, None, None]
    far = [dt.date(1990, 1, 1), dt.date(9999, 1, 1)]
    assert column(spark, "DATE", far, fn.future_to_null) == [far[0], None]


def test_repair_amounts_uses_repaired_price(spark):
    df = spark.createDataFrame(
        [(1, None, 20, 4), (2, 0, 0, 4), (3, -1, 30, 0), (4, 5, None, 3), (5, 5, 99, 3), (6, None, None, 2)],
        "id INT, price INT, sales_amount INT, quantity INT",
    )
    got = {r["id"]: (r["price"], r["sales_amount"]) for r in fn.repair_amounts(df).collect()}
    assert got == {1: (5.0, 20), 2: (0.0, 0), 3: (None, 30), 4: (5.0, 15), 5: (5.0, 99), 6: (None, None)}


def test_defaults_and_safe_casts(spark):
    assert column(spark, "INT", [None, 3], lambda c: fn.default_to(c, 0)) == [0, 3]
    assert column(spark, "STRING", ["12", "x", None], fn.to_int) == [12, 0, 0]
    assert column(spark, "STRING", ["1.5", "Yes", None], fn.to_money) == [Decimal("1.50"), Decimal(0), Decimal(0)]
    df = spark.createDataFrame([("1",)], "v STRING").select(fn.to_money(F.col("v")).alias("m"))
    assert df.dtypes == [("m", "decimal(10,2)")]


def test_product_key_parts(spark):
    key = ["CO-RF-FR-R92B-58"]
    parts = {
        fn.category_id: "CO_RF",
        fn.product_number: "FR-R92B-58",
        fn.first_segment: "CO",
        fn.drop_first_segment: "RF-FR-R92B-58",
        fn.middle_segment: "RF",
    }
    for part, expected in parts.items():
        assert column(spark, "STRING", key, part) == [expected]
    assert column(spark, "STRING", ["BK-M68B-42", "AC_BR"], fn.middle_segment) == ["M68B", ""]


def test_normalize_id(spark):
    assert column(spark, "STRING", [" aw1 ", None], fn.normalize_id) == ["AW1", None]
    assert column(spark, "INT", [11000], fn.normalize_id) == ["11000"]


def test_interleave_bits(spark):
    df = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "a INT, b INT")
    key = fn.interleave_bits([F.col("a"), F.col("b")], 2)
    assert [r[0] for r in df.select(key).collect()] == [0b0101, 0b1010, 0b0110]
    with pytest.raises(ValueError):
        fn.interleave_bits([F.col("a")] * 8, 8)


def test_bucket_of(spark):
    df = spark.createDataFrame([(v,) for v in (None, -5.0, 0.0, 1.5, 2.0, 9.0)], "v DOUBLE")
    assert [r[0] for r in df.select(fn.bucket_of("v", [0.0, 1.0, 2.0])).collect()] == [0, 0, 1, 2, 3, 3]


def test_bucket_of_texts_and_odd_numbers(spark):
    words = ["", "a", "AW0001", "AW0002", "AW00021", "zebra", None]
    df = spark.createDataFrame([(w,) for w in words], "v STRING")
    assert [r[0] for r in df.select(fn.bucket_of("v", ["AW0001", "AW0002", "it's"])).collect()] == [0, 2, 1, 2, 2, 3, 0]
    odd = spark.createDataFrame([(v,) for v in (float("nan"), float("inf"), float("-inf"), 1.0)], "v DOUBLE")
    assert [r[0] for r in odd.select(fn.bucket_of("v", [0.0, float("inf")])).collect()] == [2, 2, 0, 1]
