import hashlib

import pytest
from pyspark.sql import functions as F

from starmill.operators.dedup import add_row_hash, deduplicate, duplicate_report
from starmill.operators.profile import (
    page,
    page_after,
    quality_report,
    referential_orphans,
    report_dict,
    source_breakdown,
    uniqueness,
)
from starmill.operators.validate import split_valid, tag_violations, validate, violation_table

BAD = [("SH-0042", 310, "rail"), ("sh42", 9000, "rail"), ("SH-0077", 120, "river")]
RULES = {
    "code": {"regex": r"SH-\d{4}$"},
    "weight": {"min_value": 1, "max_value": 5000},
    "lane": {"allowed_values": ["rail", "road"]},
}


@pytest.fixture(scope="module")
def bad(spark):
    return spark.createDataFrame(BAD, "code string, weight long, lane string")


def test_violations_are_counted(bad):
    report = validate(bad, RULES)
    assert report == {
        "passed": False,
        "total_violations": 3,
        "violations": {
            "code": [r"1 value(s) do not match pattern 'SH-\d{4}$'"],
            "weight": ["1 value(s) above max (5000)"],
            "lane": ["1 value(s) not in allowed set ['rail', 'road']"],
        },
    }
    counted = {(r["column"], r["rule"]): r["violations"] for r in violation_table(bad, RULES).collect()}
    assert counted[("weight", "min_value")] == 0 and counted[("weight", "max_value")] == 1


def test_clean_rows_pass(spark):
    df = spark.createDataFrame([(12, "road"), (4000, "rail")], "weight long, lane string")
    rules = {c: RULES[c] for c in ("weight", "lane")}
    assert validate(df, rules) == {"passed": True, "total_violations": 0, "violations": {}}


def test_missing_columns(bad):
    report = validate(bad, {"gone": {"required": True}, "other": {"min_value": 1}})
    assert report["violations"] == {
        "gone": ["Column 'gone' is missing from dataset"], "other": [],
    }
    assert report["total_violations"] == 1


def test_nulls_fail_only_required(spark):
    df = spark.createDataFrame([(None,), ("abc",), ("12",)], "v string")
    rules = {"v": {
        "required": True, "min_value": 20, "allowed_values": ["abc", 12], "regex": "[a-z]",
        "min_length": 3, "max_length": 2,
    }}
    assert validate(df, rules)["violations"]["v"] == [
        "Required column has 1 null value(s)",
        "1 value(s) below min (20)",
        "1 value(s) do not match pattern '[a-z]'",
        "1 value(s) shorter than 3 chars",
        "1 value(s) longer than 2 chars",
    ]


def test_regex_is_anchored_at_the_start_and_knows_unicode(spark):
    df = spark.createDataFrame([("xab",), ("abx",), ("é1",)], "v string")
    assert validate(df, {"v": {"regex": "ab|é"}})["violations"]["v"][0].startswith("1 ")
    assert validate(df, {"v": {"regex": r"(?P<w>\w)\w+\Z"}})["passed"]


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,)], "v double")
    assert validate(df, {"v": {"max_value": 10}})["passed"]
    assert validate(df, {"v": {"required": True}})["violations"]["v"] == ["Required column has 1 null value(s)"]
    assert report_dict(quality_report(df))["null_counts"] == {"v": 1}


def test_tags_and_quarantine(bad):
    tags = {r["code"]: r["_violations"] for r in tag_violations(bad, RULES).collect()}
    assert tags == {
        "SH-0042": [], "sh42": ["code:regex", "weight:max_value"], "SH-0077": ["lane:allowed_values"],
    }
    good, quarantined = split_valid(bad, RULES)
    assert good.count() == 1 and quarantined.count() == 2


ROWS = [(7, "k", 1), (8, "m", 2), (8, "m", 2), (9, None, 4), (6, None, 4), (9, None, 4)]


@pytest.fixture(scope="module")
def repeated(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(ROWS)], "i int, id long, name string, value long")
    return df.withColumn("_ord", F.struct("i")).withColumnRenamed("i", "_i")


def kept(df):
    return sorted(r["_i"] for r in df.collect())


def test_keep_first_last_none(repeated):
    assert kept(deduplicate(repeated)) == [0, 1, 3, 4]
    assert kept(deduplicate(repeated, keep="last")) == [0, 2, 4, 5]
    assert kept(deduplicate(repeated, keep=False)) == [0, 4]
    assert kept(deduplicate(repeated, ["name"])) == [0, 1, 3]
    assert kept(deduplicate(deduplicate(repeated))) == [0, 1, 3, 4]


def test_missing_key_columns(repeated):
    assert kept(deduplicate(repeated, ["name", "gone"])) == [0, 1, 3]
    with pytest.raises(ValueError):
        deduplicate(repeated, ["gone"])


def test_hot_keys_are_cut_before_the_shuffle(repeated):
    for keep in ("first", "last", False):
        plan = deduplicate(repeated, ["id"], keep)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[-1]
        assert plan.count("Exchange") == 1


def test_duplicate_report(repeated):
    assert duplicate_report(repeated) == {
        "total_rows": 6, "duplicate_rows": 4, "unique_rows": 2, "duplicate_percent": 66.67,
    }


def test_row_hash(spark):
    df = spark.createDataFrame(
        [("x", 1, 2.0, None, None)], "s string, n long, d double, t timestamp_ntz, m long"
    ).withColumn("_src", F.lit("f"))
    expected = hashlib.sha256("x|1|2.0|NaT|<NA>".encode()).hexdigest()
    assert add_row_hash(df).first()["_row_hash"] == expected


def test_quality_report(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "x"), (3.0, "y"), (3.0, "y")], "a double, b string")
    report = report_dict(quality_report(df))
    assert report == {
        "total_rows": 4, "total_columns": 2, "null_counts": {"a": 1, "b": 0},
        "null_percent": {"a": 25.0, "b": 0.0}, "data_types": {"a": "double", "b": "string"},
        "duplicate_rows": 1,
    }
    empty = report_dict(quality_report(df.where("a > 5")))
    assert empty["total_rows"] == 0 and empty["null_percent"] == {"a": 0.0, "b": 0.0}


def test_uniqueness_does_not_count_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    row = uniqueness(df, "k", "d").first()
    assert not row["is_valid"] and row["message"] == "d: 1 duplicate keys found in k"
    assert uniqueness(df.where("k > 0"), "k", "d").first()["message"] == "d: ✓ All 2 keys are unique"


def test_orphans_breakdown_and_pages(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(2,)], "k long")
    assert referential_orphans(fact, {"k": parent}).first()["orphans"] == 3
    tagged = spark.createDataFrame([("CSV",), ("JSON",), ("CSV",)], "_source_type string")
    assert [tuple(r) for r in source_breakdown(tagged).collect()] == [("CSV", 2), ("JSON", 1)]
    numbers = spark.range(50)
    assert [r["id"] for r in page(numbers, ["id"], 3, 20).collect()] == list(range(40, 50))
    assert [r["id"] for r in page_after(numbers, "id", 9, 3).collect()] == [10, 11, 12]
