"""Silver to gold: sales by day, location and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import to_gold_money, zero_if_null
from .order_summary import option_totals

SALES_KEYS = ["date_key", "restaurant_id", "item_category"]


def line_options_agg(options: DataFrame) -> DataFrame:
    return options.groupBy("order_id", "lineitem_id").agg(*(total.alias(name) for name, total in option_totals().items()))


def enrich_lines(items: DataFrame, options: DataFrame) -> DataFrame:
    """Lines with their own option totals and net revenue. A line without an id matches nothing; equal line
    ids each receive the total.

    Lines and options are dealt by order together and meet in a window, not in a join on both keys: what follows groups
    by keys that hold the order, and needs no further shuffle of lines.
    """
    parts = {"_price": "option_price", "_revenue": "option_revenue", "_is_discount": "is_discount"}
    types = {name: options.schema[column].dataType for name, column in parts.items()}
    lines = items.select("*", F.lit(True).alias("_line"), *(F.lit(None).cast(t).alias(name) for name, t in types.items()))
    extras = options.select("order_id", "lineitem_id", F.lit(False).alias("_line"), *(F.col(c).alias(name) for name, c in parts.items()))
    dealt = lines.unionByName(extras, allowMissingColumns=True).repartition("order_id")
    own, known = W.partitionBy("order_id", "lineitem_id"), F.col("order_id").isNotNull() & F.col("lineitem_id").isNotNull()
    totals = option_totals(*(F.col(name) for name in parts))
    joined = dealt.withColumns({name: total.over(own) for name, total in totals.items()}).filter("_line").drop("_line", *parts)
    joined = joined.withColumns({name: zero_if_null(F.when(known, F.col(name))) for name in totals})
    net = F.col("line_item_revenue") + F.col("option_revenue") - F.col("discount_amount")
    return joined.withColumn("line_net_revenue", net)


def order_category_totals(lines: DataFrame) -> DataFrame:
    """Lines collapsed to one row per order and sales key.

    This is where the volume goes away: partial sums run before the shuffle, and every distinct count over
    orders becomes a plain count afterwards.
    """
    return lines.groupBy("order_id", F.col("order_date").alias("date_key"), "restaurant_id", "item_category").agg(
        F.sum("item_quantity").alias("items"),
        F.sum("line_item_revenue").alias("gross"),
        F.sum("line_net_revenue").alias("net"),
        F.sum("discount_amount").alias("discount"),
        F.max("discounted").alias("discounted"),
    )


def with_order_discount(totals: DataFrame) -> DataFrame:
    """Mark each collapsed row with whether any line of its order is discounted.

    The window sees an order's distinct sales keys, never its lines.
    """
    return totals.withColumn("order_discounted", F.max("discounted").over(W.partitionBy("order_id")))


def daily_sales(totals: DataFrame) -> DataFrame:
    """Rows of one order share the order flag, and each key holds an order once, so counts are distinct counts."""
    flag = F.col("order_discounted")
    return totals.groupBy(*SALES_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").alias("total_items_sold"),
        to_gold_money(F.sum("gross")).alias("gross_revenue"),
        to_gold_money(F.sum("net")).alias("net_revenue"),
        to_gold_money(F.sum("discount")).alias("discount_amount"),
        F.count(F.when(flag == 1, F.col("order_id"))).alias("discounted_order_count"),
        F.count(F.when(flag == 0, F.col("order_id"))).alias("non_discounted_order_count"),
    )


def fct_daily_sales_summary(items: DataFrame, options: DataFrame) -> DataFrame:
    sales = daily_sales(with_order_discount(order_category_totals(enrich_lines(items, options))))
    average = F.try_divide(F.col("net_revenue"), F.col("total_orders").cast("decimal(18,0)"))
    return sales.withColumn("avg_order_value", to_gold_money(zero_if_null(average)))
