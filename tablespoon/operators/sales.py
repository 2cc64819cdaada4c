"""Report: sales trends and seasons over the daily sales fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import location_label, mean, season, to_gold_money, zero_if_null


def with_location_label(restaurants: DataFrame) -> DataFrame:
    return restaurants.withColumn("location_label", location_label(F.col("app_name"), F.col("restaurant_id")))


def enrich_sales(sales: DataFrame, restaurants: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales rows with location label, calendar columns and season.

    No broadcast is forced: the number of locations grows with the business, so Spark decides by table size.
    """
    labels = with_location_label(restaurants).select("restaurant_id", "location_label")
    calendar = dates.select("date_key", "is_holiday", "holiday_name", "month_name", "month_number", "year")
    joined = sales.join(labels, "restaurant_id", "left").join(calendar, "date_key", "left")
    return joined.withColumn("season", season(F.col("month_number")))


def between_dates(df: DataFrame, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
    """Keep days from ``first`` to ``last``, both included; an open end keeps everything on that side."""
    if first is not None:
        df = df.filter(F.col("date_key") >= F.lit(str(first)).cast("date"))
    if last is not None:
        df = df.filter(F.col("date_key") <= F.lit(str(last)).cast("date"))
    return df


def revenue_by(df: DataFrame, key: str) -> DataFrame:
    """Net revenue per key, missing keys left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(to_gold_money(F.sum("net_revenue")).alias("net_revenue"))
    )


def top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` keys with most net revenue; equal revenue goes by name."""
    return revenue_by(df, key).orderBy(F.desc("net_revenue"), key).limit(n)


def keep_keys(df: DataFrame, keys: DataFrame | list[str], key: str) -> DataFrame:
    """Rows whose key is listed. ``keys`` is a short list or a frame such as :func:`top_n`, whose row limit tells
    Spark that it is small enough to broadcast."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(key), key, "left_semi")
    return df.filter(F.col(key).isin(keys))


def sales_kpis(df: DataFrame) -> DataFrame:
    """Revenue, orders and average order value.

    Orders are summed over the rows of the fact, so an order with two categories counts twice, and so does it
    in the average.
    """
    revenue, orders = F.sum("net_revenue"), F.sum("total_orders")
    average = F.try_divide(revenue.cast("double"), orders.cast("double"))
    return df.agg(
        to_gold_money(zero_if_null(revenue)).alias("total_revenue"),
        zero_if_null(orders).alias("total_orders"),
        F.when(orders > 0, average).otherwise(F.lit(0.0)).alias("avg_order_value"),
    )


def monthly_by(df: DataFrame, key: str, keys: DataFrame | list[str] | None = None) -> DataFrame:
    """Net revenue per month end and key. Months without a row of the key do not appear."""
    kept = df.filter(F.col(key).isNotNull()) if keys is None else keep_keys(df, keys, key)
    return kept.groupBy(F.last_day("date_key").alias("month_end"), key).agg(
        to_gold_money(F.sum("net_revenue")).alias("net_revenue")
    )


def _per_season_day(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total, days with sales and revenue per such day.

    Rows collapse to days first, which turns the distinct count of days into a plain count.
    """
    daily = df.groupBy(*keys, "date_key").agg(F.sum("net_revenue").alias("revenue"))
    totals = daily.groupBy(*keys).agg(F.sum("revenue").alias("total"), F.count("date_key").alias("days"))
    return totals.select(
        *keys,
        to_gold_money(F.col("total")).alias("total_revenue"),
        "days",
        F.try_divide(F.col("total").cast("double"), F.col("days").cast("double")).alias("avg_daily_revenue"),
    )


def seasonal_by(df: DataFrame, key: str, keys: DataFrame | list[str] | None = None) -> DataFrame:
    kept = df.filter(F.col(key).isNotNull()) if keys is None else keep_keys(df, keys, key)
    return _per_season_day(kept, ["season", key])


def seasonal_total(df: DataFrame) -> DataFrame:
    return _per_season_day(df, ["season"])


def holiday_effect(df: DataFrame) -> DataFrame:
    """Mean of the daily totals on holidays and on other days."""
    daily = (
        df.filter(F.col("is_holiday").isNotNull())
        .groupBy("date_key", "is_holiday")
        .agg(F.sum("net_revenue").alias("revenue"))
    )
    return daily.groupBy("is_holiday").agg(mean(F.col("revenue")).alias("avg_daily_revenue")).select(
        "is_holiday", F.when(F.col("is_holiday"), "Holiday").otherwise("Non-Holiday").alias("label"), "avg_daily_revenue"
    )


#: Dimensions of the cube and the column each is taken from; ``all`` has the totals.
CUBE_KEYS = {"category": "item_category", "location": "location_label"}


def sales_cube(df: DataFrame) -> DataFrame:
    """(dimension, key, period, month_end, season, is_holiday, revenue, days): revenue and days with sales.

    ``period`` is month, season or holiday; of the three columns after it only the one it names is set. Enriched sales are
    read once: they collapse to days by grouping sets over the dimensions, and these few rows to periods by grouping sets
    over the three calendars, so counts of days need no distinct.
    """
    by_day = ["date_key", "season", "is_holiday"]
    category, location = (F.col(c) for c in CUBE_KEYS.values())
    sets = [[*by_day, *extra] for extra in ([CUBE_KEYS["category"]], [CUBE_KEYS["location"]], [])]
    days = df.groupingSets([[F.col(c) for c in one] for one in sets], *by_day, *CUBE_KEYS.values()).agg(
        F.sum("net_revenue").alias("revenue"), F.grouping(category).alias("no_category"), F.grouping(location).alias("no_location")
    )
    dimension = F.when(F.col("no_category") == 0, "category").when(F.col("no_location") == 0, "location").otherwise("all")
    key = F.when(dimension == "category", category).when(dimension == "location", location)
    days = days.select(dimension.alias("dimension"), key.alias("key"), F.last_day("date_key").alias("month_end"), *by_day, "revenue")
    days = days.filter("dimension = 'all' OR key IS NOT NULL")
    calendars = {"month": "month_end", "season": "season", "holiday": "is_holiday"}
    head = ["dimension", "key"]
    cube = days.groupingSets([[F.col(c) for c in (*head, one)] for one in calendars.values()], *head, *calendars.values()).agg(
        F.sum("revenue").alias("revenue"), F.count("date_key").alias("days"),
        *(F.grouping(c).alias(f"no_{p}") for p, c in calendars.items()),
    )
    period = F.when(F.col("no_month") == 0, "month").when(F.col("no_season") == 0, "season").otherwise("holiday")
    return cube.select(*head, period.alias("period"), *calendars.values(), "revenue", "days")


def _slice(cube: DataFrame, dimension: str, period: str, top: int | None = None) -> DataFrame:
    """Rows of one dimension and calendar, of the ``top`` keys by revenue if that is given; equal revenue goes by name."""
    rows = cube.filter((F.col("dimension") == dimension) & (F.col("period") == period))
    if top is None:
        return rows
    all_time = cube.filter((F.col("dimension") == dimension) & (F.col("period") == "month"))
    best = all_time.groupBy("key").agg(to_gold_money(F.sum("revenue")).alias("total")).orderBy(F.desc("total"), "key").limit(top)
    return rows.join(best.select("key"), "key", "left_semi")


def cube_months(cube: DataFrame, dimension: str, top: int | None = None, keys: DataFrame | None = None) -> DataFrame:
    """:func:`monthly_by` from the cube, of the ``top`` keys or of those in ``keys``."""
    rows = _slice(cube, dimension, "month", top)
    if keys is not None:
        rows = rows.join(keys.select(F.col(CUBE_KEYS[dimension]).alias("key")), "key", "left_semi")
    return rows.select("month_end", F.col("key").alias(CUBE_KEYS[dimension]), to_gold_money(F.col("revenue")).alias("net_revenue"))


def cube_seasons(cube: DataFrame, dimension: str = "all", top: int | None = None) -> DataFrame:
    """:func:`seasonal_by`, or :func:`seasonal_total` of all, from the cube."""
    rows = _slice(cube, dimension, "season", top)
    keys = [F.col("key").alias(CUBE_KEYS[dimension])] if dimension in CUBE_KEYS else []
    average = F.try_divide(F.col("revenue").cast("double"), F.col("days").cast("double"))
    return rows.select("season", *keys, to_gold_money(F.col("revenue")).alias("total_revenue"), "days", average.alias("avg_daily_revenue"))


def cube_holidays(cube: DataFrame) -> DataFrame:
    """:func:`holiday_effect` from the cube."""
    rows = _slice(cube, "all", "holiday").filter(F.col("is_holiday").isNotNull())
    average = F.try_divide(F.col("revenue").cast("double"), F.col("days").cast("double"))
    return rows.select(
        "is_holiday", F.when(F.col("is_holiday"), "Holiday").otherwise("Non-Holiday").alias("label"), average.alias("avg_daily_revenue")
    )
