"""Report: churn risk on the latest snapshot day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import mean, share, zero_if_null

FLAGS = {"Active": "active", "At Risk": "at_risk", "Churned": "churned"}


def normalize_money(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing amounts count as zero in the reports."""
    return df.withColumns({c: zero_if_null(F.col(c)).cast(df.schema[c].dataType) for c in columns})


def churn_kpis(latest: DataFrame) -> DataFrame:
    """Customers in total and per status, with percentages."""
    total = F.count(F.lit(1))
    counts = {name: F.count_if(F.col("churn_risk_flag") == flag) for flag, name in FLAGS.items()}
    return latest.agg(
        total.alias("total_customers"),
        *[count.alias(name) for name, count in counts.items()],
        *[share(count, total).alias(f"{name}_pct") for name, count in counts.items()],
    )


def churn_counts(latest: DataFrame) -> DataFrame:
    counts = latest.groupBy("churn_risk_flag").agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy(F.desc("customers"), "churn_risk_flag")


def histogram(df: DataFrame, column: str, width: float, by: list[str]) -> DataFrame:
    """Rows per fixed-width bin and group; bin b covers [b * width, (b + 1) * width)."""
    binned = df.filter(F.col(column).isNotNull()).withColumn(
        "bin", F.floor(F.col(column).cast("double") / F.lit(float(width))).cast("bigint")
    )
    return binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("rows_in_bin"))


def gap_by_status(latest: DataFrame) -> DataFrame:
    """Mean order gap per status. A customer with one order counts as gap 0 in ``avg_order_gap_days``;
    ``avg_gap_known`` leaves such customers out."""
    return latest.groupBy("churn_risk_flag").agg(
        mean(zero_if_null(F.col("avg_order_gap_days"))).alias("avg_order_gap_days"),
        mean(F.col("avg_order_gap_days")).alias("avg_gap_known"),
    )


def ltv_by_status(latest: DataFrame) -> DataFrame:
    return latest.groupBy("churn_risk_flag").agg(mean(zero_if_null(F.col("cumulative_ltv"))).alias("avg_ltv"))


def at_risk_top(latest: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` at-risk customers with the highest lifetime value."""
    at_risk = latest.filter(F.col("churn_risk_flag") == "At Risk")
    return (
        normalize_money(at_risk, ["cumulative_ltv", "avg_order_gap_days"])
        .select(
            "user_id", "days_since_last_order", "cumulative_order_count", "cumulative_ltv", "avg_order_gap_days",
            "is_loyalty", "clv_segment",
        )
        .orderBy(F.desc("cumulative_ltv"), "user_id")
        .limit(k)
    )
