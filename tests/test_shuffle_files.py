"""Shuffle files go with the write they were made for."""

import time
from pathlib import Path

import shop
from pyspark.sql import functions as F
from test_shuffles import exchanges

from tablespoon.operators import customer_daily as C
from tablespoon.session import settings, stored
from tablespoon.sources import Layout, write_table


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {str(f) for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def left_by(spark, run, wanted):
    """Shuffle files that ``run`` leaves; these are removed in the background, so it is waited for."""
    before = shuffle_files(spark)
    run()
    for _ in range(100):
        left = shuffle_files(spark) - before
        if bool(left) == wanted:
            break
        time.sleep(0.1)
    return left


def sums(spark):
    frame = spark.range(0, 50_000, 1, 4).select((F.col("id") % 997).alias("k"), F.to_date(F.lit("2024-01-05")).alias("date_key"))
    return frame.groupBy("k", "date_key").agg(F.count(F.lit(1)).alias("n"))


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert not left_by(spark, lambda: stored(sums(spark), "test"), False)
    assert not left_by(spark, lambda: write_table(sums(spark), layout, "gold", "plain"), False)
    assert not left_by(spark, lambda: write_table(sums(spark), layout, "gold", "months", ["date_key_month"]), False)
    assert spark.read.parquet(layout.path("gold", "months")).count() == stored(sums(spark), "test").count() == 997


def test_what_is_returned_keeps_them_and_runs_twice(spark):
    kept = sums(spark)
    assert left_by(spark, kept.collect, True)
    stored(kept, "test")
    assert len(kept.collect()) == kept.count() == 997


def test_settings_hold_inside_only(spark):
    known, unknown = "spark.sql.shuffle.partitions", "spark.sql.tablespoon.test"
    before = spark.conf.get(known)
    with settings(spark, {known: "3", unknown: "x"}):
        assert (spark.conf.get(known), spark.conf.get(unknown)) == ("3", "x")
    assert (spark.conf.get(known), spark.conf.get(unknown, None)) == (before, None)


def test_cut_values_are_stored_before_the_days_are_made(spark):
    orders = shop.orders(spark, *[shop.order(f"o{i}", f"u{i % 5}", f"2023-01-{1 + i:02d}", 5 + i) for i in range(20)])
    totals = C.activity_with_totals(shop.customers(spark, orders), shop.dates(spark, "2023-01-01", "2023-02-28"), orders)
    cuts = C.snapshot_cuts(stored(totals, "test"))
    assert exchanges(cuts) == [] and cuts.count() == 58  # the first day has one customer, whom nobody ranks
