"""Report: performance of the locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import percent_one_decimal, to_gold_money
from .sales import with_location_label


def orders_with_location(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders with their location label; two locations with the same label are reported as one."""
    labels = with_location_label(restaurants).select("restaurant_id", "location_label")
    return orders.join(labels, "restaurant_id", "left")


def customers_per_location(df: DataFrame) -> DataFrame:
    """Orders and revenue per location and customer. Location totals, distinct customers and retention all
    come from this one aggregate."""
    return df.filter(F.col("location_label").isNotNull()).groupBy("location_label", "user_id").agg(
        F.count("order_id").alias("orders"),
        F.count(F.lit(1)).alias("visits"),
        F.sum("net_revenue").alias("revenue"),
    )


def _totals(per_customer: DataFrame) -> DataFrame:
    known = F.count("user_id")
    return per_customer.groupBy("location_label").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("total_orders"),
        F.sum("visits").alias("visits"),
        known.alias("unique_customers"),
        F.count_if(F.col("user_id").isNotNull() & (F.col("visits") > 1)).alias("repeat_customers"),
    )


def _average() -> Column:
    return F.try_divide(F.col("revenue").cast("double"), F.col("visits").cast("double"))


def location_totals(df: DataFrame) -> DataFrame:
    return _totals(customers_per_location(df)).select(
        "location_label",
        to_gold_money(F.col("revenue")).alias("total_revenue"),
        "total_orders",
        "unique_customers",
        _average().alias("avg_order_value"),
    )


def retention(df: DataFrame) -> DataFrame:
    """Share of a location's customers with more than one order there, in percent to one decimal."""
    return _totals(customers_per_location(df)).select(
        "location_label",
        F.col("unique_customers").alias("total_customers"),
        "repeat_customers",
        percent_one_decimal(F.col("repeat_customers"), F.col("unique_customers")).alias("retention_rate"),
    )


def location_ranking(df: DataFrame) -> DataFrame:
    """Totals and retention of every location, most revenue first."""
    return (
        _totals(customers_per_location(df))
        .select(
            "location_label",
            to_gold_money(F.col("revenue")).alias("total_revenue"),
            "total_orders",
            "unique_customers",
            _average().alias("avg_order_value"),
            percent_one_decimal(F.col("repeat_customers"), F.col("unique_customers")).alias("retention_rate"),
        )
        .orderBy(F.desc("total_revenue"), "location_label")
    )


def ranking_table(ranking: DataFrame) -> DataFrame:
    """The ranking with its place and with money to two decimals; one row per location, so one task ranks them."""
    place = F.row_number().over(Window.orderBy(F.desc("total_revenue"), "location_label"))
    return ranking.withColumns({"avg_order_value": F.col("avg_order_value").cast("decimal(18,2)"), "rank": place})


def location_kpis(ranking: DataFrame) -> DataFrame:
    return ranking.agg(
        F.count(F.lit(1)).alias("locations"),
        F.max("total_revenue").alias("highest_revenue"),
        F.avg("retention_rate").cast("decimal(18,4)").alias("avg_retention_rate"),
    )
