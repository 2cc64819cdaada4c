import shop
from pyspark.sql import functions as F

from tablespoon.operators import quality as Q


def result(df):
    return {r.check_name: (r.passed, r.measured, r.expected) for r in df.collect()}


def frame(spark):
    return spark.createDataFrame(
        [("a", 1, 1.0, True), ("a", 7, 2.0, False), (None, 3, None, None)], "k string, n int, v double, f boolean"
    )


def test_row_checks_pass_and_fail(spark):
    df = frame(spark)
    found = result(Q.check_rows(
        df, "t", Q.row_count(3), Q.not_null("k", "n"), Q.null_bound("v", 1), Q.value_count("k", "a", 2),
        Q.formula("v", F.col("n") * 1.0, F.col("v")), Q.flag_matches("f", F.col("n") == 1),
        Q.in_domain("k", ["a"]), Q.in_range(1, 5, "n")))
    assert found == {
        "row_count": (True, 3, 3), "not_null:k": (False, 1, 0), "not_null:n": (True, 0, 0),
        "null_bound:v": (False, 1, 1), "value_count:k": (True, 2, 2), "formula:v": (False, 2, 0),
        "flag_matches:f": (False, 1, 0), "in_domain:k": (False, 1, 0), "in_range:n": (False, 1, 0)}
    good = df.filter("n = 1")
    found = result(Q.check_rows(
        good, "t", Q.not_null("k"), Q.null_bound("v", 1), Q.formula("v", F.col("n") * 1.0, F.col("v")),
        Q.flag_matches("f", F.col("n") == 1), Q.in_domain("k", ["a"]), Q.in_range(1, 5, "n")))
    assert all(passed for passed, _, _ in found.values())
    assert not result(Q.check_rows(good, "t", Q.row_count(2), Q.value_count("k", "a", 2)))["row_count"][0]


def test_one_table_is_read_once(spark):
    plan = Q.check_rows(frame(spark), "t", Q.not_null("k", "n", "v"), Q.row_count(3))
    assert plan._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_types(spark):
    found = result(Q.has_type(frame(spark), "t", {"f": "boolean", "n": "bigint", "missing": "int"}))
    assert found == {"has_type:f": (True, 0, 0), "has_type:n": (False, 1, 0), "has_type:missing": (False, 1, 0)}


def test_checks_across_tables(spark):
    df, good = frame(spark), frame(spark).filter("n = 1")
    assert result(Q.same_count("t", df, good))["same_count"] == (False, 3, 1)
    assert result(Q.same_count("t", df, df))["same_count"] == (True, 3, 3)
    assert result(Q.unique(df, "t", ["k"]))["unique:k"] == (False, 1, 0)
    assert result(Q.unique(df, "t", ["k", "n"]))["unique:k+n"] == (True, 0, 0)
    dim = spark.createDataFrame([("b",)], "k string")
    assert result(Q.no_orphans(df, dim, "t", "k"))["no_orphans:k"] == (False, 2, 0)
    assert result(Q.no_orphans(good, df, "t", "k"))["no_orphans:k"] == (True, 0, 0)
    assert result(Q.same_distinct(df, df, "t", "k"))["same_distinct:k"] == (False, 3, 1)
    assert result(Q.same_distinct(good, df, "t", "k"))["same_distinct:k"] == (True, 1, 1)


def test_coverage(spark):
    calendar = shop.dates(spark, "2023-01-02", "2023-01-05")
    for first, last, out in (("2023-01-02", "2023-01-05", 0), ("2023-01-01", "2023-01-05", 1), ("2023-01-01", "2023-01-09", 2)):
        assert result(Q.covers(calendar, shop.dates(spark, first, last), "t", "date_key"))["covers"] == (out == 0, out, 0)
    assert result(Q.covers(calendar.limit(0), calendar, "t", "date_key"))["covers"] == (False, 2, 0)


def test_series(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 0.995), ("a", 3, 5.0), ("b", 1, 0.5), ("b", 2, 0.1)], "k string, d int, v double")
    df = df.withColumn("v", F.col("v").cast("decimal(18,3)"))
    assert result(Q.non_decreasing(df, "t", "k", "d", "v"))["non_decreasing:v"] == (False, 1, 0)
    assert result(Q.non_decreasing(df.filter("k = 'a'"), "t", "k", "d", "v"))["non_decreasing:v"] == (True, 0, 0)
