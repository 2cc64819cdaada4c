import datetime as dt
from decimal import Decimal

import shop
from pyspark.sql import functions as F

from tablespoon.functions.expressions import percent_one_decimal, repair_category
from tablespoon.operators import silver as S

BASE = {
    "ORDER_ID": "1", "LINEITEM_ID": "l", "CREATION_TIME_UTC": "2023-03-08T23:59:59.500Z", "IS_LOYALTY": "TRUE",
    "ITEM_CATEGORY": "Soup", "ITEM_PRICE": "2.50", "ITEM_QUANTITY": "3", "USER_ID": "u", "PRINTED_CARD_NUMBER": "4111",
}


def silver(spark, *changes, **kwargs):
    return S.silver_order_items(shop.landing(spark, "order_items", [{**BASE, **c} for c in changes]), **kwargs)


def test_types_and_documented_columns(spark):
    df = silver(spark, {})
    assert df.columns == [*S.ITEM_COLUMNS, "order_date_partition"]
    row = df.first()
    assert row.order_date == dt.date(2023, 3, 8) and row.order_date_partition == "2023-03-08"
    assert df.select(F.unix_millis("order_timestamp")).first()[0] == 1678319999500
    assert row.is_loyalty is True and row.line_item_revenue == Decimal("7.50")


def test_day_is_the_text_day_in_any_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert silver(spark, {}).first().order_date == dt.date(2023, 3, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_time_stays_as_null(spark):
    row = silver(spark, {"CREATION_TIME_UTC": "soon"}).first()
    assert (row.order_timestamp, row.order_date, row.order_date_partition) == (None, None, None)


def test_category_rules_in_order(spark):
    cases = {
        "BBQ Plateshttps://x": "BBQ Plates", "Drip Chttps": "Drip Coffee", "Kid'shttps": "Kids", "Kid's": "Kids",
        "Sqalads": "Salads", "Bowls0": "Bowls", "Sandwiches/Subs": "Sandwiches", "Soup": "Soup", None: None,
        "Sandwiches BBQ Plateshttps": "BBQ Plates", "Bowls01": "Bowls01", "My Sandwiches": "My Sandwiches",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string").select("c", repair_category(F.col("c")).alias("r"))
    assert {r.c: r.r for r in df.collect()} == cases


def test_test_items_and_missing_categories_are_dropped(spark):
    df = silver(spark, {"ITEM_CATEGORY": "Test Items"}, {"ITEM_CATEGORY": None}, {"ORDER_ID": "2"})
    assert shop.rows(df, "order_id") == [("2",)]


def test_outlier_bounds_and_bad_numbers(spark):
    df = silver(
        spark,
        {"ORDER_ID": "keep price", "ITEM_PRICE": "999.99", "ITEM_QUANTITY": "1"},
        {"ORDER_ID": "drop price", "ITEM_PRICE": "1000", "ITEM_QUANTITY": "1"},
        {"ORDER_ID": "keep quantity", "ITEM_PRICE": "1", "ITEM_QUANTITY": "99"},
        {"ORDER_ID": "drop quantity", "ITEM_PRICE": "1", "ITEM_QUANTITY": "100"},
        {"ORDER_ID": "keep revenue", "ITEM_PRICE": "666.66", "ITEM_QUANTITY": "3"},
        {"ORDER_ID": "drop revenue", "ITEM_PRICE": "500", "ITEM_QUANTITY": "4"},
        {"ORDER_ID": "drop text", "ITEM_PRICE": "free"},
        {"ORDER_ID": "drop overflow", "ITEM_PRICE": "99999999999"},
        {"ORDER_ID": "cut quantity", "ITEM_QUANTITY": "2.9"},
    )
    kept = {r.order_id: r.item_quantity for r in df.collect()}
    assert kept == {"keep price": 1, "keep quantity": 99, "keep revenue": 3, "cut quantity": 2}


def test_guests_and_test_accounts(spark):
    changes = [{"USER_ID": None}, {"USER_ID": S.TEST_ACCOUNTS[0]}, {"USER_ID": "bad"}, {"USER_ID": "good"}]
    assert shop.rows(silver(spark, *changes), "user_id") == [("GUEST",), ("bad",), ("good",)]
    as_table = spark.createDataFrame([("bad",)], "user_id string")
    for accounts in (["bad"], as_table):
        found = shop.rows(silver(spark, *changes, test_accounts=accounts), "user_id")
        assert found == sorted([("GUEST",), (S.TEST_ACCOUNTS[0],), ("good",)], key=repr)
    assert silver(spark, *changes, test_accounts=[]).count() == 4


def test_whole_silver_chain_does_not_shuffle(spark):
    plan = silver(spark, {})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["UPPER", "Two Words", "Mixed"])
    assert S.normalize_columns(df).columns == ["upper", "two words", "Mixed"]


def test_options(spark):
    def opt(price, quantity="2"):
        return {"ORDER_ID": "1", "LINEITEM_ID": "l", "OPTION_PRICE": price, "OPTION_QUANTITY": quantity}

    df = S.silver_order_item_options(
        shop.landing(spark, "order_item_options", [opt("-1"), opt("0"), opt("2.50"), opt(None)])
    )
    assert df.columns == S.OPTION_COLUMNS
    found = {(r.option_price, r.option_revenue, r.is_discount) for r in df.collect()}
    assert found == {
        (Decimal("-1.00"), Decimal("-2.00"), True), (Decimal("0.00"), Decimal("0.00"), False),
        (Decimal("2.50"), Decimal("5.00"), False), (None, None, None),
    }


def test_calendar(spark):
    source = shop.landing(spark, "date_dim", [
        {"date_key": "01-01-2023", "year": "2023", "month": "1", "week": "52", "day_of_week": "Sunday",
         "is_weekend": "TRUE", "is_holiday": "TRUE", "holiday_name": "New Year's Day"},
        {"date_key": "junk", "year": "x", "month": "2"},
    ])
    df = S.silver_date_dim(source)
    assert df.columns == S.DATE_COLUMNS
    first, bad = sorted(df.collect(), key=lambda r: r.date_key is None)
    assert tuple(first) == (dt.date(2023, 1, 1), "Sunday", 52, "January", 1, 2023, True, True, "New Year's Day")
    assert bad.date_key is None and bad.year is None and bad.month_number == 2


def test_percent_rounds_ties_to_even(spark):
    cases = [(1, 16, "6.2"), (3, 16, "18.8"), (2, 3, "66.7"), (1, 1, "100.0"), (0, 5, "0.0"), (1, 0, None), (7, 80, "8.8")]
    df = spark.createDataFrame([(a, b) for a, b, _ in cases], "a bigint, b bigint")
    found = {(r.a, r.b): r.p for r in df.select("a", "b", percent_one_decimal(F.col("a"), F.col("b")).alias("p")).collect()}
    assert found == {(a, b): None if p is None else Decimal(p) for a, b, p in cases}
