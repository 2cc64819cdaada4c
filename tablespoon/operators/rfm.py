"""Gold: recency, frequency and monetary scores, one row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import rfm_segment, to_gold_money
from ..functions.selection import global_ntile

RFM_COLUMNS = [
    "user_id", "recency_days", "frequency", "monetary", "date_key", "r_score", "f_score", "m_score", "rfm_segment",
]


def reference_date(orders: DataFrame) -> DataFrame:
    """Day of the last order as one row."""
    return orders.agg(F.max("date_key").alias("date_key"))


def rfm_metrics(orders: DataFrame, as_of: str | None = None, months: int | None = None) -> DataFrame:
    """Days since the last order, number of orders and net revenue per customer.

    Lifetime up to the last order by default; ``as_of`` sets an earlier day, ``months`` limits the history.
    """
    if as_of:
        last = F.lit(as_of).cast("date")
        orders = orders.filter(F.col("date_key") <= last)
    else:
        last = reference_date(orders).scalar()
    if months is not None:
        orders = orders.filter(F.col("date_key") > F.add_months(last, -months))
    return (
        orders.groupBy("user_id")
        .agg(
            F.max("date_key").alias("last_order"),
            F.count("order_id").alias("frequency"),
            to_gold_money(F.sum("net_revenue")).alias("monetary"),
        )
        .withColumn("date_key", last)
        .select("user_id", F.datediff("date_key", "last_order").alias("recency_days"), "frequency", "monetary", "date_key")
    )


def rfm_scores(metrics: DataFrame) -> DataFrame:
    """Quintiles 1 to 5 over all customers, ties by user id; the most recent fifth has r_score 5."""
    scored = global_ntile(
        metrics, "user_id", {"r_score": "recency_days", "f_score": "frequency", "m_score": "monetary"}
    )
    return scored.withColumn("r_score", F.lit(6) - F.col("r_score"))


def with_rfm_segment(scores: DataFrame) -> DataFrame:
    return scores.withColumn("rfm_segment", rfm_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def fct_customer_rfm(orders: DataFrame, as_of: str | None = None, months: int | None = None) -> DataFrame:
    return with_rfm_segment(rfm_scores(rfm_metrics(orders, as_of, months))).select(*RFM_COLUMNS)
