"""How the rows of the snapshot are dealt, cut and stored."""

import datetime as dt
from pathlib import Path

import shop
from pyspark.sql import functions as F
from test_shuffles import exchanges

from tablespoon.functions.selection import order_statistics, rank_of_fraction
from tablespoon.operators import customer_daily as C
from tablespoon.session import stored
from tablespoon.sources import Layout, write_table


def some_orders(spark):
    orders = shop.orders(spark, *[shop.order(f"o{i}", f"u{i % 7}", str(dt.date(2023, 1, 1) + dt.timedelta(i * 3)), 5 + i % 11) for i in range(60)])
    return shop.customers(spark, orders), shop.dates(spark, "2023-01-01", "2023-08-31"), orders


def test_sums_by_customer_stay_where_the_days_are(spark):
    snapshot = C.fct_customer_daily_snapshot(*some_orders(spark))
    months = snapshot.groupBy("user_id", F.last_day("date_key").alias("m")).agg(F.sum("cumulative_ltv"))
    assert sum("user_id" in e for e in exchanges(months)) == 1  # the order days; it was the customer x day rows before
    assert snapshot.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_dealt_months_carry_the_order_day_once(spark):
    totals = C.activity_with_totals(*some_orders(spark))
    rows = C.within_months(totals).filter(F.trunc("order_day", "month") != F.col("_month"))
    assert rows.count() > 0
    assert rows.filter(F.coalesce("daily_order_count", "daily_gross_revenue", "daily_net_revenue").isNotNull()).count() == 0


def test_wanted_buckets_come_with_the_groups_that_want_them(spark):
    totals = stored(C.activity_with_totals(*some_orders(spark)), "test")
    intervals = C.value_intervals(totals)
    days = intervals.withColumn("date_key", F.explode(F.sequence("first", "last")))
    assert shop.rows(C.snapshot_cuts(totals)) == shop.rows(C.clv_cuts(days))
    asked = []
    order_statistics(days, ["date_key"], "cumulative_ltv", {"high": rank_of_fraction("0.8")}, rows_in=lambda b: asked.append(b.columns) or days)
    assert asked == [["_wb", "_by_date_key"]]


def test_stored_tables_are_packed(spark, tmp_path):
    path = write_table(spark.range(3), Layout(str(tmp_path)), "gold", "t")
    files = list(Path(path).glob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
