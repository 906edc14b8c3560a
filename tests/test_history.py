"""History dimensions: change, no change, late change, return to an old value, and look-ups."""

from datetime import date

from pyspark.sql import functions as F

from starmill.operators.history import as_of, changed_versions, daily_states, merge_states, versions


def states(spark, *rows):
    df = spark.createDataFrame([(k, date(2024, 1, d), v) for k, d, v in rows], "id string, day date, city string")
    return daily_states(df, "id", F.col("day"), ["city"], F.lit(0))


def shown(df):
    return sorted(
        (r["id"], r["version"], r["city"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None, r["is_current"])
        for r in df.collect()
    )


def test_versions(spark):
    found = versions(states(spark, ("a", 1, "X"), ("a", 3, "X"), ("a", 5, "Y"), ("a", 9, "X"), ("b", 2, None), ("b", 4, None), ("b", 6, "Z")), "id")
    assert shown(found) == [
        ("a", 1, "X", 1, 5, False), ("a", 2, "Y", 5, 9, False), ("a", 3, "X", 9, None, True),
        ("b", 1, None, 2, 6, False), ("b", 2, "Z", 6, None, True),
    ]


def test_late_changes_split_and_join(spark):
    stored = states(spark, ("a", 1, "X"), ("a", 4, "X"), ("a", 8, "Y"), ("b", 1, "Z"))
    for late, want in (
        ([("a", 2, "Q")], [(1, 2, "X"), (2, 4, "Q"), (4, 8, "X"), (8, None, "Y")]),  # seen again as X on day 4
        ([("a", 8, "X")], [(1, None, "X")]),  # a correction of the same day
        ([("a", 9, "Y")], [(1, 8, "X"), (8, None, "Y")]),
    ):
        batch = states(spark, *late)
        merged = merge_states(stored, batch, "id")
        found = shown(changed_versions(versions(stored, "id"), merged, batch, "id"))
        assert [(f, t, c) for k, _, c, f, t, _ in found if k == "a"] == want
        assert [x for x in found if x[0] == "b"] == [("b", 1, "Z", 1, None, True)]
        assert found == shown(versions(merged, "id"))


def test_last_row_of_a_day_and_rows_without_key_or_day(spark):
    rows = [("a", date(2024, 1, 1), "X", 1), ("a", date(2024, 1, 1), "Y", 2), (None, date(2024, 1, 1), "Z", 3), ("a", None, "Z", 4)]
    df = spark.createDataFrame(rows, "id string, day date, city string, n int")
    assert [tuple(r) for r in daily_states(df, "id", F.col("day"), ["city"], F.col("n")).collect()] == [("a", date(2024, 1, 1), "Y")]


def test_facts_as_of_their_day(spark):
    history = versions(states(spark, ("a", 10, "X"), ("a", 20, "Y")), "id")
    rows = [(1, "a", date(2024, 1, 9)), (2, "a", date(2024, 1, 10)), (3, "a", date(2024, 1, 19)), (4, "a", date(2024, 1, 20)),
            (5, "a", date(2025, 6, 1)), (6, "b", date(2024, 1, 10)), (7, None, date(2024, 1, 10)), (8, "a", None)]
    found = as_of(spark.createDataFrame(rows, "n int, id string, bought date"), history, "id", "bought")
    assert {r["n"]: r["city"] for r in found.collect()} == {1: None, 2: "X", 3: "X", 4: "Y", 5: "Y", 6: None, 7: None, 8: None}
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
