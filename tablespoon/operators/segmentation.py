"""Report: customer segments by RFM and loyalty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import loyalty_label, mean, share


def rfm_with_loyalty(rfm: DataFrame, customers: DataFrame) -> DataFrame:
    joined = rfm.join(customers.select("user_id", "is_loyalty"), "user_id", "left")
    return joined.withColumn("loyalty_status", loyalty_label(F.col("is_loyalty")))


def segmentation_kpis(df: DataFrame) -> DataFrame:
    """Customers and the percentage of VIP, loyalty and churn-risk customers."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_customers"),
        share(F.count_if(F.col("rfm_segment") == "VIP"), total).alias("vip_pct"),
        share(F.count_if(F.col("is_loyalty")), total).alias("loyalty_pct"),
        share(F.count_if(F.col("rfm_segment") == "Churn Risk"), total).alias("churn_risk_pct"),
    )


def rfm_sample(df: DataFrame, n: int = 2000, seed: int = 42) -> DataFrame:
    """Repeatable sample of up to ``n`` customers for a scatter plot, with the inverse-recency bubble size."""
    return (
        df.orderBy(F.md5(F.concat("user_id", F.lit(f"-{seed}")).cast("binary")), "user_id")
        .limit(n)
        .withColumn("bubble_size", F.lit(1.0) / (F.col("recency_days") + 1))
    )


def segment_counts(df: DataFrame) -> DataFrame:
    counts = df.filter(F.col("rfm_segment").isNotNull()).groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy(F.desc("customers"), "rfm_segment")


def segment_by_loyalty(df: DataFrame) -> DataFrame:
    """Customers per segment and loyalty status; unknown status is left out."""
    known = df.filter(F.col("rfm_segment").isNotNull() & F.col("loyalty_status").isNotNull())
    return known.groupBy("rfm_segment", "loyalty_status").agg(F.count(F.lit(1)).alias("customers"))


def segment_profile(df: DataFrame) -> DataFrame:
    """Size, mean recency, frequency and spend, and loyalty rate in percent of each segment."""
    loyal = F.count_if(F.col("is_loyalty"))
    return df.filter(F.col("rfm_segment").isNotNull()).groupBy("rfm_segment").agg(
        F.count("user_id").alias("customers"),
        mean(F.col("recency_days")).alias("avg_recency_days"),
        mean(F.col("frequency")).alias("avg_frequency"),
        mean(F.coalesce("monetary", F.lit(0))).alias("avg_monetary"),
        share(loyal, F.count("is_loyalty")).alias("loyalty_rate_pct"),
    )
