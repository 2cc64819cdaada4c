"""Silver to gold: one row per order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import to_gold_money, zero_if_null


def option_totals(
    price: Column | str = "option_price", revenue: Column | str = "option_revenue", is_discount: Column | str = "is_discount"
) -> dict[str, Column]:
    """Paid add-ons, discounts as a positive amount, and whether any option is a discount; by name."""
    price, revenue, is_discount = (F.col(c) if isinstance(c, str) else c for c in (price, revenue, is_discount))
    return {
        "option_revenue": F.sum(F.when(price >= 0, revenue).otherwise(F.lit(0))),
        "discount_amount": F.sum(F.when(price < 0, F.abs(revenue)).otherwise(F.lit(0))),
        "discounted": F.max(is_discount.cast("int")),
    }


def order_items_agg(items: DataFrame) -> DataFrame:
    """Lines to orders. Order attributes come from the earliest line with a readable timestamp.

    Lines at one time count by user, location, day, app and flag, so the first of them is always the same. Lines that
    agree in these collapse by hash first, their categories to a set, so that about a row per order is shuffled instead of
    one per order and category; only what is left is compared as structs.
    """
    head = ["order_timestamp", "user_id", "restaurant_id", "order_date", "app_name", "is_loyalty"]
    collapsed = items.groupBy("order_id", *head).agg(
        F.sum("item_quantity").alias("quantity"),
        F.sum("line_item_revenue").alias("revenue"),
        F.collect_set("item_category").alias("categories"),
    )
    first_line = F.min(
        F.struct(
            F.col("order_timestamp").isNull().alias("unknown"),
            "order_timestamp",
            "user_id",
            "restaurant_id",
            F.col("order_date").alias("date_key"),
            "app_name",
            "is_loyalty",
        )
    ).alias("head")
    return (
        collapsed.groupBy("order_id")
        .agg(
            first_line,
            F.sum("quantity").alias("total_items"),
            F.sum("revenue").alias("gross_revenue"),
            F.size(F.array_distinct(F.flatten(F.collect_list("categories")))).cast("bigint").alias("distinct_categories"),
        )
        .select(
            "order_id",
            "head.user_id",
            "head.restaurant_id",
            "head.date_key",
            "head.app_name",
            "head.is_loyalty",
            "total_items",
            to_gold_money(F.col("gross_revenue")).alias("gross_revenue"),
            "distinct_categories",
        )
    )


def order_options_agg(options: DataFrame) -> DataFrame:
    return options.groupBy("order_id").agg(*(total.alias(name) for name, total in option_totals().items()))


def orders_with_options(items: DataFrame, options: DataFrame) -> DataFrame:
    """Both sides are aggregated by order before they meet, so the join reuses their partitioning and no
    order is repeated. Options of lines that silver dropped still count here."""
    joined = order_items_agg(items).join(order_options_agg(options), "order_id", "left")
    return joined.withColumns(
        {name: zero_if_null(F.col(name)) for name in ("option_revenue", "discount_amount", "discounted")}
    )


def fct_order_summary(items: DataFrame, options: DataFrame) -> DataFrame:
    net = F.col("gross_revenue") + F.col("option_revenue") - F.col("discount_amount")
    return orders_with_options(items, options).select(
        "order_id",
        "user_id",
        "restaurant_id",
        "date_key",
        "app_name",
        "is_loyalty",
        "total_items",
        "gross_revenue",
        "distinct_categories",
        to_gold_money(F.col("option_revenue")).alias("option_revenue"),
        to_gold_money(F.col("discount_amount")).alias("discount_amount"),
        to_gold_money(net).alias("net_revenue"),
        (F.col("discounted") == 1).alias("has_discount"),
    )
