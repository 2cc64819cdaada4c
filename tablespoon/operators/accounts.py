"""Accounts that order faster, more often or at more places than a customer does: candidates for the denylist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .silver import GUEST

QUICK_SECONDS = 300
RANGE_SECONDS = 3600


def order_times(items: DataFrame) -> DataFrame:
    """First timestamp of each order of an account."""
    return items.groupBy("user_id", "order_id").agg(F.min("order_timestamp").alias("ordered_at"), F.min("order_date").alias("order_date"))


def quick_gaps(orders: DataFrame, seconds: int = QUICK_SECONDS, range_seconds: int = RANGE_SECONDS) -> DataFrame:
    """Per account: gaps between consecutive orders, and how many last at most ``seconds``.

    An account's orders are cut into ranges of time. Gaps inside a range come from a window over that range alone; the gap
    to the range before comes from the bounds of the ranges, of which an account has at most one per ``range_seconds``.
    So an account with a third of all orders is no single window. Orders without a timestamp have no gaps.
    """
    timed = orders.filter(F.col("ordered_at").isNotNull()).select("user_id", F.unix_micros("ordered_at").alias("t"))
    ranged = timed.withColumn("part", F.floor(F.col("t") / (range_seconds * 1_000_000)))
    inside = W.partitionBy("user_id", "part").orderBy("t")
    quick = (F.col("t") - F.lag("t").over(inside)) <= seconds * 1_000_000
    parts = ranged.select("user_id", "part", "t", quick.alias("quick")).groupBy("user_id", "part").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if("quick").alias("quick"), F.min("t").alias("first"), F.max("t").alias("last")
    )
    carried = F.lag("last").over(W.partitionBy("user_id").orderBy("part"))
    bounds = parts.withColumn("carried", (F.col("first") - carried <= seconds * 1_000_000).cast("long"))
    return bounds.groupBy("user_id").agg(
        (F.sum("orders") - 1).alias("gaps"), (F.sum("quick") + F.coalesce(F.sum("carried"), F.lit(0))).alias("quick_gaps")
    )


def account_activity(items: DataFrame, seconds: int = QUICK_SECONDS, range_seconds: int = RANGE_SECONDS) -> DataFrame:
    """Per account: orders, gaps, quick gaps and their share, most orders on a day, different locations."""
    orders = order_times(items)
    days = orders.groupBy("user_id", "order_date").agg(F.count(F.lit(1)).alias("n"))
    daily = days.groupBy("user_id").agg(F.sum("n").alias("orders"), F.max("n").alias("most_a_day"))
    places = items.groupBy("user_id", "restaurant_id").agg(F.lit(1).alias("one"))
    located = places.groupBy("user_id").agg(F.count("restaurant_id").alias("locations"))
    gaps = quick_gaps(orders, seconds, range_seconds)
    joined = daily.join(located, "user_id").join(gaps, "user_id", "left")
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("gaps", "quick_gaps")}
    joined = joined.withColumns(counts)
    share = F.coalesce(F.try_divide(F.col("quick_gaps").cast("double"), F.col("gaps").cast("double")), F.lit(0.0))
    return joined.select("user_id", "orders", "gaps", "quick_gaps", share.alias("quick_share"), "most_a_day", "locations")


def rapid_accounts(
    activity: DataFrame, least_orders: int = 20, quick_share: float = 0.5, most_a_day: int = 15, locations: int = 5,
    keep: tuple[str, ...] = (GUEST,),
) -> DataFrame:
    """(user_id) of accounts with enough orders, of which enough are quick or fall on one day, at enough locations.

    ``keep`` names accounts that are no person. The result is what ``silver.exclude_users`` takes.
    """
    fast = (F.col("quick_share") >= quick_share) | (F.col("most_a_day") >= most_a_day)
    suspect = (F.col("orders") >= least_orders) & fast & (F.col("locations") >= locations)
    return activity.filter(suspect & ~F.col("user_id").isin(*keep)).select("user_id")
