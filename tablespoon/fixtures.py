"""Derives the landing tables from the driver's ``lineitem``, ``orders`` and ``part``.

Each column is one SQL expression that Spark and DuckDB read alike, so the same text feeds the Spark job
and the oracle. Only the calendar needs engine-specific date formatting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Holidays by month and day.
HOLIDAYS = {
    "01-01": "New Year's Day",
    "01-02": "New Year's Day Observed",
    "01-16": "Martin Luther King Jr.",
    "02-20": "Washington's Birthday",
    "05-29": "Memorial Day",
    "06-19": "Juneteenth",
    "07-04": "Indep. Day",
    "09-04": "Labor Day",
    "10-09": "Columbus Day",
    "11-11": "Veterans Day",
    "11-23": "Thanksgiving Day",
    "12-25": "Christmas",
}

TEST_ACCOUNTS = ["u7", "u257"]

_LINE_KEY = "CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"

ITEM_COLUMNS = {
    "APP_NAME": "o_orderpriority",
    "RESTAURANT_ID": "'loc' || lpad(CAST((o_custkey + (o_orderkey % 3) * 5) % 28 AS STRING), 6, '0')",
    "CREATION_TIME_UTC": "substr(CAST(o_orderdate AS STRING), 1, 10) || 'T'"
    " || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')"
    " || ':00.000Z'",
    "ORDER_ID": "CAST(o_orderkey AS STRING)",
    "USER_ID": "CASE WHEN o_orderkey % 12 = 0 THEN NULL ELSE 'u' || CAST(o_custkey AS STRING) END",
    "PRINTED_CARD_NUMBER": "CAST(NULL AS STRING)",
    "IS_LOYALTY": "CASE WHEN (o_custkey + o_orderkey % 4) % 3 = 0 THEN 'TRUE' ELSE 'FALSE' END",
    "CURRENCY": "'USD'",
    "LINEITEM_ID": f"CASE WHEN l_partkey % 499 = 0 THEN NULL ELSE {_LINE_KEY} END",
    "ITEM_CATEGORY": "CASE WHEN l_partkey % 53 = 0 THEN 'Test Items' WHEN l_partkey % 59 = 0 THEN NULL"
    " WHEN l_partkey % 61 = 0 THEN 'Sqalads' WHEN l_partkey % 67 = 0 THEN 'Bowls0'"
    " WHEN l_partkey % 71 = 0 THEN 'Sandwiches & Wraps' ELSE p_type END",
    "ITEM_NAME": "p_name",
    "ITEM_PRICE": "CASE WHEN l_partkey % 211 = 0 THEN '1500.00'"
    " ELSE CAST(CAST(FLOOR(p_retailprice) AS BIGINT) % 45 AS STRING) || '.99' END",
    "ITEM_QUANTITY": "CASE WHEN l_suppkey % 97 = 0 AND l_linenumber = 1 THEN '120'"
    " ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
}

QUOTED_NAME = "CASE WHEN ORDER_ID LIKE '%3' THEN ITEM_NAME || ',' || chr(10) || '\"' || ITEM_QUANTITY || '\"' ELSE ITEM_NAME END"

_OPTION_HEAD = {"ORDER_ID": "CAST(l_orderkey AS STRING)", "LINEITEM_ID": _LINE_KEY}
_OPTION_TAIL = {"OPTION_QUANTITY": "CAST(1 + l_linenumber % 3 AS STRING)"}

ADD_ON_FILTER = "l_linenumber % 2 = 0"
ADD_ON_COLUMNS = {
    **_OPTION_HEAD,
    "OPTION_GROUP_NAME": "'Add-on'",
    "OPTION_NAME": "'tier ' || CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING)",
    "OPTION_PRICE": "CASE WHEN l_tax = 0 THEN '0.00'"
    " ELSE CAST(CAST(ROUND(l_tax * 100) AS INT) AS STRING) || '.50' END",
    **_OPTION_TAIL,
}

DISCOUNT_FILTER = "l_discount > 0 AND l_orderkey % 2 = 0"
DISCOUNT_COLUMNS = {
    **_OPTION_HEAD,
    "OPTION_GROUP_NAME": "'Promo'",
    "OPTION_NAME": "'promo'",
    "OPTION_PRICE": "'-0.' || lpad(CAST(CAST(ROUND(l_discount * 100) AS INT) AS STRING), 2, '0')",
    **_OPTION_TAIL,
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select([F.expr(text).alias(name) for name, text in columns.items()])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landing_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, parts = (_table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return _select(joined, ITEM_COLUMNS)


def landing_order_item_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    return _select(lines.filter(ADD_ON_FILTER), ADD_ON_COLUMNS).unionByName(
        _select(lines.filter(DISCOUNT_FILTER), DISCOUNT_COLUMNS)
    )


def landing_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar text rows for every day that has an order."""
    day = F.col("day")
    holiday = F.lit(None).cast("string")
    for month_day, name in HOLIDAYS.items():
        holiday = F.when(F.date_format(day, "MM-dd") == month_day, F.lit(name)).otherwise(holiday)
    days = _table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        F.date_format(day, "dd-MM-yyyy").alias("date_key"),
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        F.weekofyear(day).cast("string").alias("week"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.upper(F.dayofweek(day).isin(1, 7).cast("string")).alias("is_weekend"),
        F.upper(holiday.isNotNull().cast("string")).alias("is_holiday"),
        holiday.alias("holiday_name"),
    )


#: Columns of the customer x day snapshot in the order in which a row's digest reads them.
SNAPSHOT_TEXT = (
    "user_id", "date_key", "is_loyalty", "daily_order_count", "daily_gross_revenue", "daily_net_revenue",
    "daily_discount_amount", "cumulative_order_count", "cumulative_ltv", "days_since_last_order", "avg_order_gap_days",
    "clv_segment", "churn_risk_flag",
)
