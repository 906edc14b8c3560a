import math

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import text
from starmill.operators import clean as c
from starmill.operators.numbering import exact_medians, number_rows


def frame(spark, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"place int, {schema}")
    return df.withColumn("_ord", F.struct("place")).drop("place")


def column(df, name):
    return [r[name] for r in df.orderBy("_ord").collect()]


MESSY = [
    ("1", "  Ann  ", "a@b.com", "25"),
    ("2", "Sue", "N/A", "30"),
    ("3", "NULL", "c@d.com", ""),
    ("4", "", "e@f.com", "22"),
]
MESSY_SCHEMA = "id string, name string, email string, age string"


def test_names():
    assert text.standard_names([" First Name", "Last-Name", "b.c", "Last_Name", "É 1"]) == [
        "first_name", "last_name", "b_c", "last_name_2", "é_1",
    ]


def test_default_config_reports_only(spark):
    out = c.clean(frame(spark, MESSY, MESSY_SCHEMA))
    assert column(out, "name") == ["Ann", "Sue", None, None]
    assert column(out, "email") == ["a@b.com", None, "c@d.com", "e@f.com"]
    assert c.null_counts(out).first().asDict() == {"id": 0, "name": 2, "email": 1, "age": 1}


def test_strip_takes_unicode_space_and_spares_other_types(spark):
    df = spark.createDataFrame(
        [("  x y\t", 5, [" a "])], "s string, n int, l array<string>"
    )
    assert c.strip_strings(df).first().asDict() == {"s": "x y", "n": 5, "l": [" a "]}


def test_fill_by_hint(spark):
    config = {
        "null_strategy": "fill",
        "type_map": {"age": "int", "pay": "float", "seen": "datetime"},
        "fill_values": {"email": "none@x"},
    }
    rows = [
        ("a", "1", "1.5", "2024-01-05", None),
        ("b", "2", None, "no", "m"),
        (None, None, "2.5", None, "n"),
        ("d", "4", "x", "2024-01-06", "o"),
        ("e", "5", None, "2024-01-07 10:00:00", "p"),
    ]
    df = frame(spark, rows, "name string, age string, pay string, seen string, email string")
    out = c.clean(df, config)
    assert column(out, "name") == ["a", "b", "Unknown", "d", "e"]
    assert column(out, "age") == [1, 2, 3, 4, 5]
    assert column(out, "pay") == [1.5, 2.0, 2.5, None, 2.0]
    assert [str(v) if v else None for v in column(out, "seen")] == [
        "2024-01-05 00:00:00", None, None, "2024-01-06 00:00:00", None,
    ]
    assert column(out, "email")[0] == "none@x"


def test_fill_of_empty_columns(spark):
    config = {"null_strategy": "fill", "type_map": {"n": "int", "d": "float"}}
    out = c.clean(frame(spark, [("x", None, None)], "k string, n string, d string"), config)
    assert out.drop("_ord").first().asDict() == {"k": "x", "n": 0, "d": 0.0}


def test_median_rounds_half_to_even(spark):
    config = {"null_strategy": "fill", "type_map": {"n": "int"}}
    out = c.clean(frame(spark, [("2",), ("3",), (None,)], "n string"), config)
    assert column(out, "n") == [2, 3, 2]


def test_numeric_column_without_hint_takes_the_mean(spark):
    out = c.clean(frame(spark, [(1,), (None,), (4,)], "n long"), {"null_strategy": "fill"})
    assert column(out, "n") == [1.0, 2.5, 4.0]


def test_int_cast_is_all_or_nothing(spark):
    config = {"type_map": {"a": "int", "b": "int", "c": "int64"}}
    df = frame(spark, [("1", "1", "7.0"), ("x", "2.5", "1e3"), ("3", None, None)],
               "a string, b string, c string")
    out = c.clean(df, config)
    assert column(out, "a") == [1, None, 3]
    assert column(out, "b") == ["1", "2.5", None]
    assert column(out, "c") == [7, 1000, None]


def test_int_cast_refuses_what_does_not_fit(spark):
    config = {"type_map": {"a": "int", "b": "int"}}
    df = frame(spark, [("1", "inf"), ("99999999999999999999", "1")], "a string, b string")
    out = c.clean(df, config)
    assert dict(out.dtypes)["a"] == "string" and dict(out.dtypes)["b"] == "string"
    big = c.clean(frame(spark, [("9007199254740993",)], "a string"), {"type_map": {"a": "int"}})
    assert column(big, "a") == [9007199254740993]


def test_bool_and_plain_types(spark):
    config = {"type_map": {"f": "bool", "n": "int32", "m": "int32", "s": "category"}}
    df = frame(spark, [("True", "1", "1", "p"), ("0", "2", "x", "q"), ("yes", "3", "3", "r")],
               "f string, n string, m string, s string")
    out = c.clean(df, config)
    assert column(out, "f") == [True, False, None]
    assert column(out, "n") == [1, 2, 3]
    assert column(out, "m") == ["1", "x", "3"]
    assert column(out, "s") == ["p", "q", "r"]


def test_integral_floats_option(spark):
    df = frame(spark, [("85000", "1"), ("2500", "1.5")], "a string, b string")
    types = {"a": "float", "b": "float"}
    assert dict(c.clean(df, {"type_map": types}).dtypes)["a"] == "double"
    kept = c.clean(df, {"type_map": types, "integral_floats": "long"})
    assert dict(kept.dtypes)["a"] == "bigint" and dict(kept.dtypes)["b"] == "double"


def test_drop_rows_and_empty_rows(spark):
    df = frame(spark, [("1", "x"), (None, "y"), (None, None), ("-", "none")], "a string, b string")
    df = df.withColumn("_lineage", F.lit(None).cast("string"))
    assert column(c.clean(df, {"null_strategy": "drop_rows"}), "a") == ["1"]
    assert column(c.clean(df), "b") == ["x", "y"]


def test_wide_tables_plan_quickly(spark):
    names = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(str(i) for i in range(40))], names).withColumn(
        "_ord", F.struct(F.lit(1))
    )
    config = {"type_map": {n: "float" for n in names}}
    out = c.clean(df, config)
    from starmill.operators.dedup import add_row_hash, deduplicate

    assert add_row_hash(deduplicate(out, ["c1"])).where("c2 = 2").count() == 1


DATES = [
    ["2023-01-05", "2023-1-7", "2023-01-05 10:00:00", "01/02/2023"],
    ["01/02/2023", "13/02/2023", "12/25/2023"],
    ["13/02/2023", "01/02/2023"],
    ["2023-01-05 10:00:00", "2023-01-06"],
    ["2023/01/05", "2023-01-05"],
    ["20230105", "20230106", "x"],
    ["Jan 5, 2023", "Feb 6, 2023"],
    ["5 Jan 2023", "bad"],
]


@pytest.mark.parametrize("cells", DATES)
def test_dates_follow_the_first_value(spark, cells):
    df = frame(spark, [("k", v) for v in cells], "k string, d string")
    out = c.clean(df, {"type_map": {"d": "datetime"}})
    expected = pd.to_datetime(pd.Series(cells), errors="coerce")
    assert column(out, "d") == [None if pd.isna(v) else v.to_pydatetime() for v in expected]


NUMBERS = ["+5", "5.", ".5", "1e5", "1E+5", "inf", "-Infinity", "0x10", "1_000", "1,000", "5d",
           "5f", "", "True", "1e400", "-3", "1 2", "e5", "."]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([(v,) for v in NUMBERS], "t string")
    found = [r["n"] for r in df.select(
        text.number(F.col("t"), df.schema["t"].dataType).alias("n")).collect()]
    expected = pd.to_numeric(pd.Series(NUMBERS), errors="coerce")
    assert found == [None if math.isnan(v) else v for v in expected]


def test_text_of_doubles(spark):
    cells = [0.0, 1.0, 20575.0, 1276.9666666666667, 1e7, 12345678.9, 123456789012345.6, 1e15,
             9999999999999998.0, 1e16, 1.5e300, 1e-4, 0.00012345, 1e-5, 2.5e-10, -3.25e-7, 4.375,
             -1e22, 0.001, float("inf"), float("-inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in cells], "d double")
    found = [r["t"] for r in df.select(text.double_text(F.col("d")).alias("t")).collect()]
    assert found == [str(v) for v in cells]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5), st.floats(-100, 100)), max_size=30))
def test_medians_are_exact(spark, cells):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in cells], "v double")
    found = exact_medians(df, {"v": F.col("v")})
    present = [float(v) for v in cells if v is not None]
    if not present:
        assert found == {}
    else:
        assert found["v"] == pytest.approx(pd.Series(present).median())


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_numbers_are_dense_and_ordered(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k")
        rows = number_rows(df, ["k"], "n", 11).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r["k"], r["n"]) for r in rows) == [(k, k + 11) for k in range(5000)]


def test_tokens_of_any_type(spark):
    df = spark.createDataFrame([("x", -1, -1.0), ("N/A", 5, 2.5), ("-1", 7, float("nan"))], "a string, b long, c double")
    rows = c.null_tokens(df, ["N/A", None, -1]).collect()
    assert [r["a"] for r in rows] == ["x", None, "-1"]
    assert [r["b"] for r in rows] == [None, 5, 7]
    assert [r["c"] for r in rows][:2] == [None, 2.5]


def test_what_is_no_number_is_filled(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (float("nan"),), (None,)], "v double")
    config = {"null_strategy": "fill"}
    assert c.null_counts(df).first()["v"] == 2
    found = c.fill_missing(df, config, c.column_facts(df, config))
    assert [r["v"] for r in found.collect()] == [1.5, 2.5, 2.0, 2.0]
