"""Bronze to silver: typing, repair and exclusion. One projection and filter chain per table, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, repair_category, to_count, to_money

GUEST = "GUEST"

# Accounts confirmed as testers.
TEST_ACCOUNTS = [
    "5ecf9eda505ee9682b445912",
    "5ece77fe902ad501337b23fd",
    "5f1b00e5535ee93e0cb768e7",
    "5f3c1860505ee9de2a7b23f0",
    "60388a4d4f5ee9231e8dda0f",
    "5ecf54cf4f5ee92f387b23f3",
    "5fcc79d04f5ee9f812be49c2",
    "5f184fc74f5ee9e640b4f7ea",
    "5ff415c0505ee9d953b281c4",
    "5ecf6d334f5ee97259ce6751",
    "5eac88d6902ad598127b240b",
    "5f3d955c37ab46de2a7b240b",
    "5f17eb6d505ee9293ccf7dc1",
    "5ef4983d505ee9904cedf505",
]

ITEM_COLUMNS = [
    "order_id", "lineitem_id", "app_name", "restaurant_id", "order_date", "order_timestamp", "user_id", "is_loyalty",
    "currency", "item_category", "item_name", "item_price", "item_quantity", "line_item_revenue",
]
OPTION_COLUMNS = [
    "order_id", "lineitem_id", "option_group_name", "option_name", "option_price", "option_quantity",
    "option_revenue", "is_discount",
]
DATE_COLUMNS = [
    "date_key", "day_of_week", "week_number", "month_name", "month_number", "year", "is_weekend", "is_holiday",
    "holiday_name",
]
SILVER_PARTITIONS = {"order_items": ["order_date_partition_month"], "order_item_options": [], "date_dim": ["year"]}


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case the names that are all upper case or hold a space; a space itself stays."""
    return df.toDF(*[name.lower() if name.isupper() or " " in name else name for name in df.columns])


def backfill_guest(df: DataFrame, tag: str = GUEST) -> DataFrame:
    return df.withColumn("user_id", F.coalesce("user_id", F.lit(tag)))


def typed_items(df: DataFrame) -> DataFrame:
    """Timestamps, day, price, quantity, loyalty flag and line revenue. What does not parse becomes NULL.

    The day is the date part of the text, so it does not move with the session time zone.
    """
    return df.withColumns(
        {
            "order_timestamp": F.try_to_timestamp("creation_time_utc"),
            "order_date": F.col("creation_time_utc").try_cast("date"),
            "is_loyalty": F.col("is_loyalty").try_cast("boolean"),
            "item_price": to_money(F.col("item_price")),
            "item_quantity": to_count(F.col("item_quantity")),
        }
    ).withColumn("line_item_revenue", (F.col("item_price") * F.col("item_quantity")).try_cast(MONEY))


def with_repaired_category(df: DataFrame) -> DataFrame:
    return df.withColumn("item_category", repair_category(F.col("item_category")))


def drop_test_items(df: DataFrame, category: str = "Test Items") -> DataFrame:
    """A missing category is dropped as well, since the comparison is then unknown."""
    return df.filter(F.col("item_category") != category)


def drop_outliers(df: DataFrame, price: int = 1000, quantity: int = 100, revenue: int = 2000) -> DataFrame:
    """Keep rows strictly below all three bounds; a NULL operand drops the row."""
    return df.filter(
        (F.col("item_price") < price)
        & (F.col("item_quantity") < quantity)
        & (F.col("line_item_revenue") < revenue)
    )


def exclude_users(df: DataFrame, accounts: Sequence[str] | DataFrame) -> DataFrame:
    """Drop the listed accounts. A short list becomes a filter; a table of ids becomes an anti join whose
    strategy Spark picks from the size of that table."""
    if isinstance(accounts, DataFrame):
        return df.join(accounts.select("user_id"), "user_id", "left_anti")
    return df.filter(~F.col("user_id").isin(list(accounts))) if accounts else df


def with_silver_partition(df: DataFrame) -> DataFrame:
    return df.withColumn("order_date_partition", F.col("order_date").cast("string"))


def silver_order_items(bronze: DataFrame, test_accounts: Sequence[str] | DataFrame = TEST_ACCOUNTS) -> DataFrame:
    """Clean, typed order lines. The printed card number never leaves bronze."""
    items = with_repaired_category(typed_items(backfill_guest(normalize_columns(bronze))))
    items = exclude_users(drop_outliers(drop_test_items(items)), test_accounts)
    return with_silver_partition(items).select(*ITEM_COLUMNS, "order_date_partition")


def silver_order_item_options(bronze: DataFrame) -> DataFrame:
    options = normalize_columns(bronze).withColumns(
        {"option_price": to_money(F.col("option_price")), "option_quantity": to_count(F.col("option_quantity"))}
    )
    return options.withColumns(
        {
            "option_revenue": (F.col("option_price") * F.col("option_quantity")).try_cast(MONEY),
            "is_discount": F.col("option_price") < 0,
        }
    ).select(*OPTION_COLUMNS)


def silver_date_dim(bronze: DataFrame) -> DataFrame:
    """Typed calendar; the text columns ``month`` and ``week`` give way to numbers."""
    day = F.try_to_date("date_key", "dd-MM-yyyy")
    return bronze.select(
        day.alias("date_key"),
        "day_of_week",
        to_count(F.col("week")).alias("week_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        to_count(F.col("month")).alias("month_number"),
        to_count(F.col("year")).alias("year"),
        F.col("is_weekend").try_cast("boolean").alias("is_weekend"),
        F.col("is_holiday").try_cast("boolean").alias("is_holiday"),
        "holiday_name",
    )
