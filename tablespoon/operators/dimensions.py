"""Silver to gold: calendar, location and customer dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import calendar_columns


def date_bounds(items: DataFrame) -> DataFrame:
    """First and last order day as one row; it stays in the plan instead of going through the driver."""
    return items.agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from the first to the last date, both included."""
    return bounds.select(
        F.explode(F.sequence("first_date", "last_date", F.expr("interval 1 day"))).alias("date_key")
    )


def calendar_attributes(days: DataFrame) -> DataFrame:
    return days.withColumns(calendar_columns(F.col("date_key")))


def holiday_lookup(silver_dates: DataFrame) -> DataFrame:
    """One holiday name per month and day, the first by name where a calendar of several years has more."""
    month_day = F.date_format("date_key", "MM-dd").alias("month_day")
    return silver_dates.filter("is_holiday").groupBy(month_day).agg(F.min("holiday_name").alias("holiday_name"))


def dim_date(items: DataFrame, silver_dates: DataFrame) -> DataFrame:
    """Calendar over the whole order range; holidays repeat every year on their month and day."""
    days = calendar_attributes(date_spine(date_bounds(items))).withColumn(
        "month_day", F.date_format("date_key", "MM-dd")
    )
    # Both sides are calendar-sized: at most 366 month-days on the right.
    return (
        days.join(F.broadcast(holiday_lookup(silver_dates)), "month_day", "left")
        .withColumn("is_holiday", F.col("holiday_name").isNotNull())
        .drop("month_day")
    )


def dim_restaurant(items: DataFrame) -> DataFrame:
    """Each location with its most frequent app; equal counts go to the first name.

    Two aggregations with map-side combine, so a location with most of the lines is no hot spot.
    """
    per_app = items.groupBy("restaurant_id", "app_name").agg(F.count("order_id").alias("lines"))
    best = F.min(F.struct((-F.col("lines")).alias("rank"), "app_name"))
    return per_app.groupBy("restaurant_id").agg(best.alias("best")).select("restaurant_id", "best.app_name")


def dim_customer(items: DataFrame) -> DataFrame:
    """First and last order day, latest loyalty flag and the (location, app) pair with most lines; one scan."""
    return customers_of(customer_state(items))


def customer_state(items: DataFrame) -> DataFrame:
    """What lines say about a customer, per location and app: lines, order days and the latest line.

    Lines collapse by hash to (customer, location, app, order, flag), with counts and times only, before structs are
    compared per (customer, location, app). The guest account, which may hold a large part of all lines, arrives at its
    task as a few pre-aggregated rows. States of different lines add up by :func:`merged_states`.
    """
    visits = items.groupBy("user_id", "restaurant_id", "app_name", "order_id", "is_loyalty").agg(
        F.count("order_id").alias("lines"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.max("order_timestamp").alias("order_timestamp"),
    )
    return _per_place(visits.withColumn("latest", F.struct("order_timestamp", "order_id", "is_loyalty")))


def merged_states(*states: DataFrame) -> DataFrame:
    """State of all lines from the states of parts of them, such as a stored state and that of new lines."""
    return _per_place(reduce(DataFrame.unionByName, states))


def _per_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "restaurant_id", "app_name").agg(
        F.sum("lines").alias("lines"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.max("latest").alias("latest"),
    )


def customers_of(state: DataFrame) -> DataFrame:
    """The customer dimension; the latest flag is the one on the line with the greatest (timestamp, order, flag)."""
    favourite = F.struct((-F.col("lines")).alias("rank"), "restaurant_id", "app_name")
    best = state.groupBy("user_id").agg(
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.max("latest").alias("latest"),
        F.min(favourite).alias("favourite"),
    )
    return best.select(
        "user_id",
        "first_order_date",
        "last_order_date",
        "latest.is_loyalty",
        F.col("favourite.restaurant_id").alias("primary_restaurant_id"),
        F.col("favourite.app_name").alias("primary_app"),
    )
