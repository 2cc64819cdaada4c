"""Small hand-made frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tablespoon.sources import LANDING_SCHEMAS

ITEM_SCHEMA = (
    "order_id string, lineitem_id string, app_name string, restaurant_id string, order_date date,"
    " order_timestamp timestamp, user_id string, is_loyalty boolean, currency string, item_category string,"
    " item_name string, item_price decimal(10,2), item_quantity int, line_item_revenue decimal(10,2)"
)
OPTION_SCHEMA = (
    "order_id string, lineitem_id string, option_group_name string, option_name string, option_price decimal(10,2),"
    " option_quantity int, option_revenue decimal(10,2), is_discount boolean"
)
ORDER_SCHEMA = (
    "order_id string, user_id string, restaurant_id string, date_key date, app_name string, is_loyalty boolean,"
    " total_items bigint, gross_revenue decimal(18,2), distinct_categories bigint, option_revenue decimal(18,2),"
    " discount_amount decimal(18,2), net_revenue decimal(18,2), has_discount boolean"
)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def landing(spark, name: str, rows: list[dict]):
    """Landing rows from dicts; columns not given are NULL."""
    schema = LANDING_SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def line(order, line_id, user="u1", date="2023-01-01", category="Soup", price=10, quantity=1, place="r00001", app="A",
         loyal=True, time="12:00:00"):
    stamp = dt.datetime.fromisoformat(f"{date}T{time}+00:00")
    return (order, line_id, app, place, day(date), stamp, user, loyal, "USD", category, "x", money(price), quantity,
            money(price * quantity))


def items(spark, *lines):
    return spark.createDataFrame(list(lines), ITEM_SCHEMA)


def option(order, line_id, price, quantity=1):
    revenue = None if price is None else money(price * quantity)
    return (order, line_id, "g", "o", money(price), quantity, revenue, None if price is None else price < 0)


def options(spark, *rows):
    return spark.createDataFrame(list(rows), OPTION_SCHEMA)


def order(order_id, user, date, net, place="r00001", loyal=True, add_on=0, gross=None, discount=0):
    gross = net if gross is None else gross
    return (order_id, user, place, day(date), "A", loyal, 1, money(gross), 1, money(add_on), money(discount), money(net),
            discount > 0)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDER_SCHEMA)


def customers(spark, order_frame):
    """Customer dimension of an order frame."""
    from pyspark.sql import functions as F

    return order_frame.groupBy("user_id").agg(
        F.min("date_key").alias("first_order_date"),
        F.max("date_key").alias("last_order_date"),
        F.bool_or("is_loyalty").alias("is_loyalty"),
    )


def dates(spark, first: str, last: str):
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS date_key")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
