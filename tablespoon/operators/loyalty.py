"""Report: effect of loyalty membership on spending and repeat orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import loyalty_label, mean, share, to_gold_money
from ..functions.selection import percentiles
from ..session import pin
from .sales import monthly_by


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, revenue and mean order value per customer with the customer's loyalty flag."""
    totals = orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        to_gold_money(F.sum("net_revenue")).alias("total_revenue"),
        mean(F.col("net_revenue")).alias("avg_order_value"),
    )
    joined = totals.join(customers.select("user_id", "is_loyalty"), "user_id", "left")
    return joined.withColumns(
        {"loyalty_status": loyalty_label(F.col("is_loyalty")), "is_repeat": F.col("total_orders") > 1}
    )


def _with_status(df: DataFrame) -> DataFrame:
    return df.filter(F.col("loyalty_status").isNotNull())


def loyalty_kpis(df: DataFrame) -> DataFrame:
    """Mean lifetime value, mean of the customers' order values and repeat rate in percent.

    The customers' means are summed as decimals, so the result does not depend on the order of rows.
    """
    summed = F.sum(F.col("avg_order_value").cast("decimal(28,8)")).cast("double")
    return _with_status(df).groupBy("loyalty_status").agg(
        mean(F.col("total_revenue")).alias("avg_clv"),
        (summed / F.count("avg_order_value")).cast("decimal(18,4)").alias("avg_order_value"),
        share(F.count_if("is_repeat"), F.count(F.lit(1))).alias("repeat_rate_pct"),
    )


def repeat_rate(df: DataFrame) -> DataFrame:
    customers, repeat = F.count("user_id"), F.count_if("is_repeat")
    return _with_status(df).groupBy("loyalty_status").agg(
        customers.alias("total_customers"),
        repeat.alias("repeat_customers"),
        share(repeat, customers).alias("repeat_rate_pct"),
    )


def capped_histogram(df: DataFrame, cap: str = "0.95", bins: int = 50) -> DataFrame:
    """Customers with positive revenue up to the exact ``cap`` percentile, in ``bins`` equal bins from zero.

    The customers are written to the shared folder once; the percentile and the bins both read them.
    """
    positive = pin(df.filter(F.col("total_revenue") > 0))
    limit = percentiles(positive, [], "total_revenue", {"cap": cap}).select("cap")
    kept = _with_status(positive).withColumn("cap", limit.scalar()).filter(F.col("total_revenue") <= F.col("cap"))
    scaled = (F.col("total_revenue") * 10000 * bins).cast("decimal(38,0)")
    number = F.floor(scaled / (F.col("cap") * 10000).cast("decimal(22,0)")).cast("bigint")
    return kept.groupBy("loyalty_status", F.least(number, F.lit(bins - 1)).alias("bin"), "cap").agg(
        F.count(F.lit(1)).alias("customers")
    )


def box_stats(df: DataFrame) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 quartile ranges of the box) and outliers of lifetime value."""
    positive = pin(_with_status(df).filter(F.col("total_revenue") > 0))
    quartiles = percentiles(
        positive, ["loyalty_status"], "total_revenue", {"q1": "0.25", "median": "0.5", "q3": "0.75"}
    )
    reach = (F.col("q3") - F.col("q1")) * F.lit("1.5").cast("decimal(2,1)")
    low, high = F.col("q1") - reach, F.col("q3") + reach
    value = F.col("total_revenue")
    inside = (value >= low) & (value <= high)
    # One quartile row per loyalty status.
    return (
        positive.join(F.broadcast(quartiles), "loyalty_status")
        .groupBy("loyalty_status", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .withColumnRenamed("n", "customers")
    )


def monthly_loyalty(orders: DataFrame) -> DataFrame:
    """Net revenue per month end by the loyalty flag the order itself carried."""
    return monthly_by(orders.withColumn("loyalty_status", loyalty_label(F.col("is_loyalty"))), "loyalty_status")
