"""Gold: customer x day snapshot of lifetime value, the primary deliverable.

A customer's state only changes on days with an order. The work is therefore done on order days: running sums
and the next order day come from one window over them, and each order day then unfolds into the calendar days
it stays valid for. The customer x day rows are produced by that last step only and flow to the sink without a
join, shuffle or sort of their own: for a table in month folders the order days are cut at month bounds and dealt by
month while they are still sparse.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import churn_flag, to_gold_money, zero_if_null
from ..functions.selection import log_bucket, order_statistics, rank_of_fraction, reaches, thresholds
from ..session import pin

ROWS_PER_TASK = 4_000_000  # customer x day rows that one task writes or sums up
LTV_BUCKETS = 128  # per e-fold: finer than elsewhere, as buckets of days come from counted intervals and cost no rows

SNAPSHOT_COLUMNS = [
    "user_id", "date_key", "is_loyalty", "daily_order_count", "daily_gross_revenue", "daily_net_revenue",
    "daily_discount_amount", "cumulative_order_count", "cumulative_ltv", "days_since_last_order",
    "avg_order_gap_days", "clv_segment", "churn_risk_flag",
]

_ACTIVITY = ["daily_order_count", "daily_gross_revenue", "daily_net_revenue", "daily_discount_amount"]


def _ltv_bucket(value: Column) -> Column:
    return log_bucket(value, LTV_BUCKETS)


def last_day(dates: DataFrame) -> DataFrame:
    """Last calendar day as one row."""
    return dates.agg(F.max("date_key").alias("last_day"))


def _customers_until_last_day(customers: DataFrame, dates: DataFrame) -> DataFrame:
    return customers.select(
        "user_id", "is_loyalty", "first_order_date", last_day(dates).scalar().alias("last_day")
    )


def _every_day(first: Column, last: Column) -> Column:
    """Days first..last, none when the range is empty."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def customer_spine(customers: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per customer and day from the first order to the last calendar day, without a cross product."""
    return _customers_until_last_day(customers, dates).select(
        "user_id",
        "is_loyalty",
        "first_order_date",
        F.explode(_every_day(F.col("first_order_date"), F.col("last_day"))).alias("date_key"),
    )


def daily_activity(orders: DataFrame) -> DataFrame:
    """Orders and revenue per customer and day."""
    return orders.groupBy("user_id", "date_key").agg(
        F.count("order_id").alias("daily_order_count"),
        to_gold_money(F.sum("gross_revenue")).alias("daily_gross_revenue"),
        to_gold_money(F.sum("net_revenue")).alias("daily_net_revenue"),
        to_gold_money(F.sum("discount_amount")).alias("daily_discount_amount"),
    )


def activity_with_totals(customers: DataFrame, dates: DataFrame, orders: DataFrame) -> DataFrame:
    """Order days of every customer with running totals and the days each stays valid for.

    ``valid_from`` is the order day itself, except that a customer's first row starts on the customer's first
    order date; ``valid_to`` is the day before the next order day, or the last calendar day. A customer has at
    most one row per day here, whatever the number of orders.
    """
    return running_totals(customers, dates, daily_activity(orders))


def running_totals(customers: DataFrame, dates: DataFrame, activity: DataFrame) -> DataFrame:
    """:func:`activity_with_totals` from :func:`daily_activity`."""
    activity = activity.withColumnRenamed("date_key", "order_day").withColumnRenamed("user_id", "buyer")
    people = _customers_until_last_day(customers, dates)
    days = people.join(
        activity,
        (F.col("user_id") == F.col("buyer"))
        & (F.col("order_day") >= F.col("first_order_date"))
        & (F.col("order_day") <= F.col("last_day")),
        "left",
    ).drop("buyer")
    # An order day unfolds into many calendar days, so tasks sized by these rows would be far too few. A fixed
    # number of partitions is left alone by adaptive coalescing, and the window below needs this partitioning anyway.
    days = days.repartition(int(days.sparkSession.conf.get("spark.sql.shuffle.partitions")), "user_id")

    in_order = W.partitionBy("user_id").orderBy("order_day")
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = F.col("daily_order_count") > 0
    totals = days.withColumns(
        {
            "cumulative_order_count": F.sum("daily_order_count").over(so_far),
            "cumulative_ltv": F.sum("daily_net_revenue").over(so_far),
            "last_order_so_far": F.max(F.when(placed, F.col("order_day"))).over(so_far),
            "valid_to": F.coalesce(
                F.date_sub(F.lead("order_day").over(in_order), 1), F.col("last_day")
            ),
            "valid_from": F.when(F.row_number().over(in_order) == 1, F.col("first_order_date")).otherwise(
                F.col("order_day")
            ),
        }
    )
    return _final_values(totals.drop("last_day"))


def _final_values(totals: DataFrame) -> DataFrame:
    """Everything that holds for as long as an order day is valid, in its final type.

    Doing this before the days unfold keeps decimal arithmetic out of the customer x day rows.
    """
    count = F.col("cumulative_order_count").cast("int")
    gap = F.datediff("last_order_so_far", "first_order_date").cast("decimal(10,0)") / F.nullif(
        (count - 1).cast("decimal(10,0)"), F.lit(0).cast("decimal(10,0)")
    )
    value = to_gold_money(zero_if_null(F.col("cumulative_ltv")))
    return totals.withColumns(
        {
            "cumulative_order_count": count,
            "cumulative_ltv": value,
            "ltv_bucket": _ltv_bucket(value),
            "avg_order_gap_days": F.when(count > 1, gap.cast("decimal(10,2)")),
            **{name: to_gold_money(zero_if_null(F.col(name))) for name in _ACTIVITY[1:]},
        }
    )


def unfold_days(totals: DataFrame, *extra: str) -> DataFrame:
    """Order days to calendar days. Amounts of the day show on the order day only; totals hold until the next."""
    days = totals.withColumn("date_key", F.explode(_every_day(F.col("valid_from"), F.col("valid_to"))))
    return _state_on_day(days, *extra)


def _state_on_day(days: DataFrame, *extra: str) -> DataFrame:
    """Snapshot columns, and the bucket of the lifetime value, of rows that carry ``date_key`` and the order day
    valid on it. Before that order day, and without one, everything is zero."""
    day, order_day, no_money = F.col("date_key"), F.col("order_day"), to_gold_money(F.lit(0))
    today, started = day == order_day, day >= order_day
    return days.select(
        "user_id",
        "date_key",
        "is_loyalty",
        F.when(today, F.col("daily_order_count")).otherwise(F.lit(0)).cast("bigint").alias("daily_order_count"),
        *[F.when(today, F.col(name)).otherwise(no_money).alias(name) for name in _ACTIVITY[1:]],
        F.when(started, F.col("cumulative_order_count")).otherwise(F.lit(0)).alias("cumulative_order_count"),
        F.when(started, F.col("cumulative_ltv")).otherwise(no_money).alias("cumulative_ltv"),
        F.when(started, F.datediff(day, "last_order_so_far")).alias("days_since_last_order"),
        F.when(started, F.col("avg_order_gap_days")).alias("avg_order_gap_days"),
        F.when(started, F.col("ltv_bucket")).otherwise(_ltv_bucket(F.lit(0))).alias("ltv_bucket"),
        *extra,
    )


def clv_cuts(days: DataFrame, high: str = "0.8", medium: str = "0.2", **interval: object) -> DataFrame:
    """Per day, the lifetime values at which percent_rank reaches the two bounds; ``days`` carries ``ltv_bucket``."""
    ranks = {"high": rank_of_fraction(high), "medium": rank_of_fraction(medium)}
    stats = order_statistics(days, ["date_key"], "cumulative_ltv", ranks, bucket="ltv_bucket", **interval)
    return thresholds(stats, ["date_key"], ranks)


def value_intervals(totals: DataFrame) -> DataFrame:
    """Days over which a customer's lifetime value stays the same: zero before the order day, then its total."""
    before = F.coalesce(F.least("valid_to", F.date_sub("order_day", 1)), F.col("valid_to"))
    parts = F.array(
        F.struct(
            F.col("valid_from").alias("first"), before.alias("last"), to_gold_money(F.lit(0)).alias("cumulative_ltv"),
            _ltv_bucket(F.lit(0)).alias("ltv_bucket"),
        ),
        F.struct(
            F.greatest("valid_from", "order_day").alias("first"),
            F.when(F.col("order_day").isNotNull(), F.col("valid_to")).alias("last"),
            "cumulative_ltv",
            "ltv_bucket",
        ),
    )
    return totals.select(F.explode(parts).alias("i")).select("i.*").filter("first <= last")


def interval_counts(intervals: DataFrame) -> DataFrame:
    """Customers by day and bucket of the lifetime value, from where intervals begin and end.

    One more where an interval begins, one less after its end, summed up along the days of a bucket: at most one row per
    calendar day and bucket at any time, whatever the number of customers.
    """
    ends = F.array(
        F.struct(F.col("first").alias("day"), F.lit(1).alias("step")), F.struct(F.date_add("last", 1).alias("day"), F.lit(-1).alias("step"))
    )
    steps = intervals.select("ltv_bucket", F.explode(ends).alias("e")).groupBy("ltv_bucket", "e.day").agg(F.sum("e.step").alias("step"))
    along = W.partitionBy("ltv_bucket").orderBy("day")
    levels = steps.withColumns(
        {"_c": F.sum("step").over(along), "until": F.date_sub(F.lead("day").over(along), 1)}
    ).filter("_c > 0")
    days = F.explode(_every_day(F.col("day"), F.col("until"))).alias("date_key")
    return levels.select(days, F.col("ltv_bucket").alias("_b"), "_c")


def snapshot_cuts(totals: DataFrame) -> DataFrame:
    """:func:`clv_cuts` of all days of the snapshot; only intervals in a wanted bucket are unfolded, to the days from the
    first to the last that wants it. Stored, a row per calendar day, so that what was shuffled for them is gone before the
    days are made."""
    intervals = value_intervals(totals)

    def unfolded(frame: DataFrame) -> DataFrame:
        return frame.withColumn("date_key", F.explode(_every_day(F.col("first"), F.col("last"))))

    def rows_in(buckets: DataFrame) -> DataFrame:
        spans = buckets.groupBy("_wb").agg(F.min("_by_date_key").alias("_from"), F.max("_by_date_key").alias("_to"))
        near = intervals.join(F.broadcast(spans), F.col("ltv_bucket") == F.col("_wb"))
        return unfolded(near.withColumns({"first": F.greatest("first", "_from"), "last": F.least("last", "_to")}))

    return pin(clv_cuts(unfolded(intervals), counted=interval_counts(intervals), rows_in=rows_in))


def with_clv_segment(days: DataFrame, high: str = "0.8", medium: str = "0.2", cuts: DataFrame | None = None) -> DataFrame:
    """High / Medium / Low by percent_rank of lifetime value among all customers of the day.

    Only the two cut values per day are computed from the ranking; a day's customers are compared with them
    where they are, so no day is ever sorted as a whole. The cuts are one row per calendar day.
    """
    cuts = (clv_cuts(days, high, medium) if cuts is None else cuts).withColumnRenamed("date_key", "cut_day")
    value = F.col("cumulative_ltv")
    segment = F.when(reaches(value, "high"), "High").when(reaches(value, "medium"), "Medium").otherwise("Low")
    return (
        days.join(F.broadcast(cuts), F.col("date_key") == F.col("cut_day"), "left")
        .select(*[c for c in days.columns if c != "ltv_bucket"], segment.alias("clv_segment"))
    )


def with_churn_flag(days: DataFrame, active_days: int = 30, at_risk_days: int = 90) -> DataFrame:
    return days.withColumn("churn_risk_flag", churn_flag(F.col("days_since_last_order"), active_days, at_risk_days))


def within_months(totals: DataFrame) -> DataFrame:
    """Order days with their validity cut at month bounds: a row per order day and month, whose first day is ``_month``.

    What was bought on the order day shows on that day only; rows of other months go without it, which packs better.
    """
    months = F.sequence(F.trunc("valid_from", "month"), F.trunc("valid_to", "month"), F.expr("interval 1 month"))
    rows = totals.withColumn("_month", F.explode(F.when(F.col("valid_from") <= F.col("valid_to"), months)))
    here = F.trunc("order_day", "month") == F.col("_month")
    return rows.withColumns(
        {
            "valid_from": F.greatest("valid_from", "_month"),
            "valid_to": F.least("valid_to", F.last_day("_month")),
            **{name: F.when(here, F.col(name)) for name in _ACTIVITY},
        }
    )


def dealt_by_month(totals: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Order days within months, each task with a range of (month, customer) that unfolds to about ``rows_per_task`` rows.

    Sorted within tasks, so that a writer of month folders meets one month after the other. Counts days in one job.
    """
    keys = ["_month", "user_id"]
    dealt = within_months(totals).repartitionByRange(_tasks(totals, rows_per_task), *keys).sortWithinPartitions(*keys)
    return dealt.withColumn("date_key_month", F.date_format("_month", "yyyy-MM")).drop("_month")


def dealt_by_customer(totals: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Order days in tasks of whole customers that unfold to about ``rows_per_task`` rows, and no fewer than other shuffles
    have. What is then grouped by keys that hold the customer needs no shuffle of its own. Counts days in one job."""
    least = int(totals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return totals.repartition(max(least, _tasks(totals, rows_per_task)), "user_id")


def _tasks(totals: DataFrame, rows_per_task: int) -> int:
    days = F.sum(F.greatest(F.datediff("valid_to", "valid_from") + 1, F.lit(0)))
    return max(1, -(-(totals.agg(days.alias("n")).first().n or 0) // rows_per_task))


def fct_customer_daily_snapshot(
    customers: DataFrame, dates: DataFrame, orders: DataFrame, by_month: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every customer on every day since the first order, up to the last calendar day.

    The order days are written to the shared folder once. The ranking counts intervals between them, so the customer x
    day rows are made only once, on their way to the sink. With ``by_month`` the rows carry ``date_key_month`` and are dealt
    for month folders before they unfold.
    """
    totals = pin(activity_with_totals(customers, dates, orders))
    return snapshot_of(totals, snapshot_cuts(totals), by_month, rows_per_task)


def snapshot_of(totals: DataFrame, cuts: DataFrame, by_month: bool = False, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The snapshot rows of order days, ranked by ``cuts``."""
    extra = ["date_key_month"] if by_month else []
    dealt = dealt_by_month if by_month else dealt_by_customer
    days = unfold_days(dealt(totals, rows_per_task), *extra)
    return with_churn_flag(with_clv_segment(days, cuts=cuts)).select(*SNAPSHOT_COLUMNS, *extra)


def totals_since(customers: DataFrame, dates: DataFrame, orders: DataFrame, state: DataFrame, since: dt.date) -> DataFrame:
    """:func:`activity_with_totals` from day ``since`` on, without the orders before it.

    ``state`` has the snapshot rows of the day before. What a customer had by then enters as one order day of its own, the
    last one before ``since``, with all earlier orders and revenue; its validity is cut at ``since``.
    """
    before = F.lit(since - dt.timedelta(days=1))
    carried = state.filter(F.col("days_since_last_order").isNotNull()).select(
        "user_id", F.date_sub(before, F.col("days_since_last_order")).alias("date_key"),
        F.col("cumulative_order_count").cast("bigint").alias(_ACTIVITY[0]), to_gold_money(F.lit(0)).alias(_ACTIVITY[1]),
        F.col("cumulative_ltv").alias(_ACTIVITY[2]), to_gold_money(F.lit(0)).alias(_ACTIVITY[3]),
    )
    recent = daily_activity(orders.filter(F.col("date_key") >= F.lit(since)))
    totals = running_totals(customers, dates, recent.unionByName(carried))
    return totals.withColumn("valid_from", F.greatest("valid_from", F.lit(since))).filter("valid_from <= valid_to")


def _last_month(snapshot: DataFrame) -> DataFrame:
    """Rows in the last month folder, known from the names of the files; no data is read to find it."""
    folders = {m for f in snapshot.inputFiles() for m in re.findall(r"/date_key_month=(\d{4,}-\d{2})/", f)}
    return snapshot.filter(F.col("date_key_month") == max(folders, key=lambda m: (len(m), m))) if folders else snapshot


def latest_date(snapshot: DataFrame) -> DataFrame:
    """Last snapshot day; reads one column, and of a stored table with its month folders at hand one month of it."""
    recent = _last_month(snapshot) if "date_key_month" in snapshot.columns else snapshot
    return recent.agg(F.max("date_key").alias("date_key"))


def latest_snapshot(snapshot: DataFrame) -> DataFrame:
    """Rows of the last day of a stored snapshot. The day is a scalar subquery, so it reaches the scan as a filter once
    it is known; where the month folders are at hand as a column, only the last one is opened."""
    if "date_key_month" not in snapshot.columns:
        return snapshot.filter(F.col("date_key") == latest_date(snapshot).scalar())
    recent = _last_month(snapshot)
    return recent.filter(F.col("date_key") == latest_date(recent).scalar()).drop("date_key_month")


def snapshot_as_of(customers: DataFrame, dates: DataFrame, orders: DataFrame, day: str | None = None) -> DataFrame:
    """The snapshot rows of one day (default: the last calendar day) straight from the orders.

    One pass over the orders up to that day replaces the whole history; its result, one row per customer, is
    written to the shared folder for the ranking.
    """
    as_of = F.lit(day).cast("date") if day else last_day(dates).scalar()
    people = customers.select("user_id", "is_loyalty", "first_order_date").filter(F.col("first_order_date") <= as_of)
    daily = daily_activity(orders.filter(F.col("date_key") <= as_of))
    daily = daily.withColumnRenamed("date_key", "order_day").withColumnRenamed("user_id", "buyer")
    counted = people.join(
        daily, (F.col("user_id") == F.col("buyer")) & (F.col("order_day") >= F.col("first_order_date")), "left"
    )
    on_day = F.col("order_day") == as_of
    days = (
        counted.groupBy("user_id", "is_loyalty", "first_order_date")
        .agg(
            F.sum("daily_order_count").alias("cumulative_order_count"),
            F.sum("daily_net_revenue").alias("cumulative_ltv"),
            F.max(F.when(F.col("daily_order_count") > 0, F.col("order_day"))).alias("last_order_so_far"),
            F.max("order_day").alias("order_day"),
            F.coalesce(F.sum(F.when(on_day, F.col("daily_order_count"))), F.lit(0)).alias("today"),
            *[F.sum(F.when(on_day, F.col(name))).alias(f"{name}_today") for name in _ACTIVITY[1:]],
        )
        .withColumn("date_key", as_of)
        .withColumnsRenamed({"today": _ACTIVITY[0], **{f"{name}_today": name for name in _ACTIVITY[1:]}})
    )
    return with_churn_flag(with_clv_segment(pin(_state_on_day(_final_values(days))))).select(*SNAPSHOT_COLUMNS)
