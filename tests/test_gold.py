import datetime as dt
from decimal import Decimal

import shop
from pyspark.sql import functions as F

from tablespoon.operators import daily_sales as A
from tablespoon.operators import dimensions as D
from tablespoon.operators import order_summary as O

Z = Decimal("0.00")


def test_calendar_attributes_on_edge_days(spark):
    items = shop.items(spark, shop.line("1", "a", date="2020-02-27"), shop.line("2", "a", date="2021-01-04"))
    holidays = spark.createDataFrame(
        [(shop.day("2023-01-01"), True, "New Year's Day"), (shop.day("2023-03-01"), False, None)],
        "date_key date, is_holiday boolean, holiday_name string",
    )
    dim = {r.date_key.isoformat(): r for r in D.dim_date(items, holidays).collect()}
    assert len(dim) == 313 and min(dim) == "2020-02-27" and max(dim) == "2021-01-04"
    leap, eve, year = dim["2020-02-29"], dim["2020-12-31"], dim["2021-01-01"]
    assert (leap.day_of_week, leap.is_weekend, leap.month_name, leap.is_holiday) == ("Saturday", True, "February", False)
    assert (eve.week_number, year.week_number) == (53, 53)
    assert (year.is_holiday, year.holiday_name, year.year, year.month_number) == (True, "New Year's Day", 2021, 1)


def test_empty_calendar(spark):
    assert D.date_spine(D.date_bounds(shop.items(spark, shop.line("1", "a")).limit(0))).count() == 0


def test_restaurant_takes_most_frequent_app_then_name(spark):
    items = shop.items(
        spark,
        *[shop.line(str(i), "a", place="r1", app=app) for i, app in enumerate(["B", "A", "B", "A"])],
        *[shop.line(str(i), "b", place="r2", app=app) for i, app in enumerate(["A", "Z", "Z"])],
    )
    assert shop.rows(D.dim_restaurant(items)) == [("r1", "A"), ("r2", "Z")]


def test_customer_dimension(spark):
    items = shop.items(
        spark,
        shop.line("1", "a", date="2023-01-05", loyal=True, place="r2"),
        shop.line("1", "b", date="2023-01-05", loyal=True, place="r2"),
        shop.line("2", "a", date="2023-02-01", loyal=False, place="r1"),
        shop.line("2", None, date="2023-02-01", loyal=False, place="r1"),
        shop.line("3", "a", user="u2", date="2023-01-01", time="09:00:00", loyal=True),
        shop.line("4", "a", user="u2", date="2023-01-01", time="08:00:00", loyal=False),
    )
    assert shop.rows(D.dim_customer(items)) == [
        ("u1", dt.date(2023, 1, 5), dt.date(2023, 2, 1), False, "r1", "A"),
        ("u2", dt.date(2023, 1, 1), dt.date(2023, 1, 1), True, "r00001", "A"),
    ]


def test_order_takes_attributes_of_earliest_line(spark):
    items = shop.items(
        spark,
        shop.line("1", "b", time="10:00:00", category="Soup", price=5, quantity=2, place="late"),
        shop.line("1", "a", time="09:00:00", category="Tea", place="early", loyal=False),
        shop.line("1", "c", time="11:00:00", category="Soup"),
    )
    row = O.order_items_agg(items).first()
    assert (row.restaurant_id, row.is_loyalty, row.total_items, row.distinct_categories) == ("early", False, 4, 2)
    assert row.gross_revenue == Decimal("30.00")


def test_option_totals_split_add_ons_and_discounts(spark):
    options = shop.options(
        spark, *[shop.option("1", "a", price, 2) for price in (-1, 0, 2.5, None)], shop.option("2", "a", None)
    )
    assert shop.rows(O.order_options_agg(options)) == [
        ("1", Decimal("5.00"), Decimal("2.00"), 1), ("2", Z, Z, None),
    ]


def test_order_summary_with_and_without_options(spark):
    items = shop.items(spark, shop.line("1", "a"), shop.line("2", "a"))
    options = shop.options(spark, shop.option("1", "a", 3), shop.option("1", "a", -1))
    found = {r.order_id: r for r in O.fct_order_summary(items, options).collect()}
    assert (found["1"].net_revenue, found["1"].has_discount) == (Decimal("12.00"), True)
    assert (found["2"].net_revenue, found["2"].has_discount, found["2"].option_revenue) == (Decimal("10.00"), False, Z)


def test_options_of_dropped_lines_count_in_orders_but_not_in_daily_sales(spark):
    items = shop.items(spark, shop.line("1", "a"), shop.line("1", None))
    options = shop.options(spark, shop.option("1", "a", 1), shop.option("1", "gone", 5), shop.option("1", None, 7))
    assert O.fct_order_summary(items, options).first().net_revenue == Decimal("33.00")
    assert A.fct_daily_sales_summary(items, options).first().net_revenue == Decimal("21.00")


def test_equal_line_ids_each_receive_the_options(spark):
    items = shop.items(spark, shop.line("1", "a"), shop.line("1", "a"))
    options = shop.options(spark, shop.option("1", "a", 1))
    assert O.fct_order_summary(items, options).first().net_revenue == Decimal("21.00")
    assert A.fct_daily_sales_summary(items, options).first().net_revenue == Decimal("22.00")


def test_discount_marks_the_order_in_every_category(spark):
    items = shop.items(
        spark,
        shop.line("1", "a", category="Soup"), shop.line("1", "b", category="Tea"), shop.line("1", "c", category="Tea"),
        shop.line("2", "a", category="Tea", price=3),
    )
    options = shop.options(spark, shop.option("1", "a", -1))
    sales = {r.item_category: r for r in A.fct_daily_sales_summary(items, options).collect()}
    soup, tea = sales["Soup"], sales["Tea"]
    assert (soup.discounted_order_count, soup.non_discounted_order_count, soup.discount_amount) == (1, 0, Decimal("1.00"))
    assert (tea.total_orders, tea.discounted_order_count, tea.non_discounted_order_count) == (2, 1, 1)
    assert (tea.net_revenue, tea.avg_order_value, tea.total_items_sold) == (Decimal("23.00"), Decimal("11.50"), 3)


def test_one_order_with_most_of_the_lines_is_collapsed_before_the_window(spark):
    hot = spark.range(30000).select(F.lit("hot").alias("order_id"), F.col("id").cast("string").alias("lineitem_id"))
    template = shop.items(spark, shop.line("x", "y")).drop("order_id", "lineitem_id")
    lines = hot.join(F.broadcast(template)).select(*shop.items(spark, shop.line("x", "y")).columns)
    row = A.fct_daily_sales_summary(lines, shop.options(spark, shop.option("hot", "7", -1))).first()
    assert (row.total_orders, row.discounted_order_count, row.net_revenue) == (1, 1, Decimal("299999.00"))
    plan = A.daily_sales(A.with_order_discount(A.order_category_totals(lines.withColumns(
        {"line_net_revenue": F.lit(1), "discount_amount": F.lit(0), "discounted": F.lit(0)}
    ))))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate", plan.index("Window"))  # aggregate feeds the window


def test_order_lines_are_dealt_twice_at_most(spark):
    lines = shop.items(spark, shop.line("1", "a"), shop.line("1", "b", category="Tea"), shop.line("2", "c"), shop.line("2", "c"))
    found = O.order_items_agg(lines)
    assert shop.rows(found, "order_id", "total_items", "distinct_categories") == [("1", 2, 2), ("2", 2, 1)]
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 2
