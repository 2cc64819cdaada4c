"""Report: add-on pricing and revenue composition over the order fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import mean, order_type, percent_one_decimal, share, to_gold_money, zero_if_null


def with_order_type(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_type", order_type(F.col("option_revenue")))


def order_type_agg(df: DataFrame) -> DataFrame:
    amounts = {"gross": "gross_revenue", "net": "net_revenue", "option_rev": "option_revenue"}
    return df.groupBy("order_type").agg(
        F.count("order_id").alias("order_count"),
        *[to_gold_money(F.sum(column)).alias(f"total_{name}") for name, column in amounts.items()],
        *[mean(F.col(column)).alias(f"avg_{name}") for name, column in amounts.items()],
    )


def revenue_composition(df: DataFrame) -> DataFrame:
    """Gross revenue split into base and add-ons.

    Gross revenue does not contain the add-ons in the order fact; base is nevertheless gross minus add-ons, as in
    the report this reproduces.
    """
    gross, add_ons = zero_if_null(F.sum("gross_revenue")), zero_if_null(F.sum("option_revenue"))
    return df.agg(
        to_gold_money(gross - add_ons).alias("base_item_revenue"),
        to_gold_money(add_ons).alias("add_on_revenue"),
        to_gold_money(gross).alias("total_gross"),
    )


def addon_rate_monthly(df: DataFrame) -> DataFrame:
    """Share of orders with paid add-ons per month end, in percent to one decimal; months without orders show
    zero orders and no rate."""
    monthly = df.groupBy(F.last_day("date_key").alias("month_end")).agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("option_revenue") > 0).alias("addon_orders"),
    )
    bounds = df.agg(F.min("date_key").alias("first"), F.max("date_key").alias("last"))
    months = bounds.select(
        F.explode(F.sequence(F.trunc("first", "month"), F.trunc("last", "month"), F.expr("interval 1 month"))).alias("m")
    ).select(F.last_day("m").alias("month_end"))
    # Both sides are one row per calendar month.
    filled = months.join(F.broadcast(monthly), "month_end", "left").select(
        "month_end",
        *[zero_if_null(F.col(name)).alias(name) for name in ("total_orders", "addon_orders")],
    )
    return filled.withColumn("addon_rate", percent_one_decimal(F.col("addon_orders"), F.col("total_orders")))


def order_type_counts(df: DataFrame) -> DataFrame:
    counts = df.groupBy("order_type").agg(F.count(F.lit(1)).alias("orders"))
    return counts.orderBy(F.desc("orders"), "order_type")


def addon_insights(df: DataFrame) -> DataFrame:
    """Mean add-on revenue of orders with add-ons, its total, and its percentage of all gross revenue."""
    paid = F.when(F.col("option_revenue") > 0, F.col("option_revenue"))
    gross, add_ons = zero_if_null(F.sum("gross_revenue")), zero_if_null(F.sum(paid))
    return df.agg(
        mean(paid).alias("avg_addon_revenue"),
        to_gold_money(add_ons).alias("total_addon_revenue"),
        F.when(gross > 0, share(add_ons, gross)).otherwise(F.lit(0.0)).alias("addon_pct_of_gross"),
    )
