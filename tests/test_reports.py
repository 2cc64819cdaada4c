import datetime as dt
from decimal import Decimal

import shop
from pyspark.sql import functions as F

from tablespoon.operators import churn as H
from tablespoon.operators import locations as N
from tablespoon.operators import loyalty as Y
from tablespoon.operators import pricing as P
from tablespoon.operators import sales as T
from tablespoon.operators import segmentation as G

RFM = "user_id string, recency_days int, frequency bigint, monetary decimal(18,2), rfm_segment string"
FACT = "date_key date, restaurant_id string, item_category string, total_orders bigint, net_revenue decimal(18,2)"
LATEST = (
    "user_id string, days_since_last_order int, cumulative_order_count int, cumulative_ltv decimal(18,2),"
    " avg_order_gap_days decimal(10,2), is_loyalty boolean, clv_segment string, churn_risk_flag string"
)


def rfm_frame(spark):
    rfm = spark.createDataFrame(
        [("a", 1, 9, Decimal(90), "VIP"), ("b", 5, 1, Decimal(10), "Regular"), ("c", 7, 2, None, "Regular")], RFM)
    customers = spark.createDataFrame([("a", True), ("b", False)], "user_id string, is_loyalty boolean")
    return G.rfm_with_loyalty(rfm, customers)


def test_segmentation(spark):
    df = rfm_frame(spark)
    assert shop.rows(df, "user_id", "loyalty_status") == [("a", "Loyalty Member"), ("b", "Non-Member"), ("c", None)]
    kpi = G.segmentation_kpis(df).first()
    assert (kpi.total_customers, kpi.vip_pct, kpi.loyalty_pct, kpi.churn_risk_pct) == (3, 1 / 3 * 100, 1 / 3 * 100, 0)
    assert [tuple(r) for r in G.segment_counts(df).collect()] == [("Regular", 2), ("VIP", 1)]
    assert shop.rows(G.segment_by_loyalty(df)) == [("Regular", "Non-Member", 1), ("VIP", "Loyalty Member", 1)]
    profile = {r.rfm_segment: r for r in G.segment_profile(df).collect()}
    assert (profile["Regular"].avg_recency_days, profile["Regular"].avg_monetary) == (6.0, 5.0)
    assert (profile["Regular"].loyalty_rate_pct, profile["VIP"].loyalty_rate_pct) == (0.0, 100.0)


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("user_id"), F.lit(3).alias("recency_days"))
    first, again = (shop.rows(G.rfm_sample(df.repartition(n), 10)) for n in (1, 7))
    assert first == again and len(first) == 10 and first[0][-1] == 0.25
    assert G.rfm_sample(df, 500).count() == 100
    assert shop.rows(G.rfm_sample(df, 10, seed=1)) != first


def test_churn(spark):
    latest = spark.createDataFrame([
        ("a", 5, 3, Decimal(50), Decimal(4), True, "High", "Active"),
        ("b", 45, 1, Decimal(20), None, True, "Low", "At Risk"),
        ("c", 60, 2, Decimal(20), Decimal(8), False, "Low", "At Risk"),
        ("d", 31, 2, None, Decimal(2), None, "Low", "At Risk"),
    ], LATEST)
    kpi = H.churn_kpis(latest).first()
    assert (kpi.total_customers, kpi.active, kpi.at_risk, kpi.churned, kpi.at_risk_pct) == (4, 1, 3, 0, 75.0)
    assert [tuple(r) for r in H.churn_counts(latest).collect()] == [("At Risk", 3), ("Active", 1)]
    assert shop.rows(H.histogram(latest, "days_since_last_order", 30, ["churn_risk_flag"])) == [
        ("Active", 0, 1), ("At Risk", 1, 2), ("At Risk", 2, 1)]
    gaps = {r.churn_risk_flag: r for r in H.gap_by_status(latest).collect()}
    assert (gaps["At Risk"].avg_order_gap_days, gaps["At Risk"].avg_gap_known) == (10 / 3, 5.0)
    assert {r.churn_risk_flag: r.avg_ltv for r in H.ltv_by_status(latest).collect()}["At Risk"] == 40 / 3
    top = H.at_risk_top(latest, 2).collect()
    assert [(r.user_id, r.avg_order_gap_days) for r in top] == [("b", Decimal("0.00")), ("c", Decimal("8.00"))]


def sales_frame(spark):
    fact = spark.createDataFrame([
        (dt.date(2023, 1, 1), "r1", "Soup", 2, Decimal(10)), (dt.date(2023, 1, 1), "r2", "Tea", 1, Decimal(4)),
        (dt.date(2023, 1, 31), "r1", "Soup", 1, Decimal(6)), (dt.date(2023, 4, 2), "r1", "Tea", 1, Decimal(4)),
        (dt.date(2023, 4, 3), "rX", "Cake", 1, Decimal(1)),
    ], FACT)
    restaurants = spark.createDataFrame([("r1", "A"), ("r2", "B")], "restaurant_id string, app_name string")
    dates = shop.dates(spark, "2023-01-01", "2023-04-30").select(
        "date_key", (F.dayofyear("date_key") == 1).alias("is_holiday"), F.lit(None).cast("string").alias("holiday_name"),
        F.date_format("date_key", "MMMM").alias("month_name"), F.month("date_key").alias("month_number"),
        F.year("date_key").alias("year"))
    return T.enrich_sales(fact, restaurants, dates)


def test_sales(spark):
    df = sales_frame(spark)
    assert {r.season for r in df.collect()} == {"Winter", "Spring"}
    assert {r.location_label for r in df.collect()} == {"A (#r1)", "B (#r2)", None}
    kpi = T.sales_kpis(df).first()
    assert (kpi.total_revenue, kpi.total_orders, kpi.avg_order_value) == (Decimal("25.00"), 6, 25 / 6)
    assert tuple(T.sales_kpis(df.limit(0)).first()) == (Decimal("0.00"), 0, 0.0)
    assert [r.item_category for r in T.top_n(df, "item_category", 2).collect()] == ["Soup", "Tea"]
    assert [r.location_label for r in T.top_n(df, "location_label", 9).collect()] == ["A (#r1)", "B (#r2)"]
    assert shop.rows(T.monthly_by(df, "item_category", ["Soup"])) == [(dt.date(2023, 1, 31), "Soup", Decimal("16.00"))]
    top = T.top_n(df, "location_label", 1)
    assert shop.rows(T.monthly_by(df, "location_label", top)) == [
        (dt.date(2023, 1, 31), "A (#r1)", Decimal("16.00")), (dt.date(2023, 4, 30), "A (#r1)", Decimal("4.00"))]
    winter = {r.season: r for r in T.seasonal_total(df).collect()}["Winter"]
    assert (winter.total_revenue, winter.days, winter.avg_daily_revenue) == (Decimal("20.00"), 2, 10.0)
    assert len(T.seasonal_by(df, "location_label").collect()) == 3
    effect = {r.label: r.avg_daily_revenue for r in T.holiday_effect(df).collect()}
    assert effect == {"Holiday": 14.0, "Non-Holiday": 11 / 3}
    assert T.between_dates(df, "2023-01-31", dt.date(2023, 4, 2)).count() == 2
    assert T.between_dates(df).count() == 5


def test_season_of_every_month(spark):
    from tablespoon.functions.expressions import season

    df = spark.range(1, 13).select(season(F.col("id")).alias("s"))
    assert [r.s for r in df.collect()] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def order_frame(spark):
    return shop.orders(
        spark,
        shop.order("1", "a", "2023-01-05", 10, place="r1", add_on=2, gross=8), shop.order("2", "a", "2023-01-06", 20, place="r1"),
        shop.order("3", "b", "2023-03-01", 30, place="r1", loyal=False), shop.order("4", "c", "2023-03-02", 5, place="r2"),
        shop.order("5", "c", "2023-03-02", 0, place="r9"),
    )


def test_loyalty(spark):
    customers = spark.createDataFrame([("a", True), ("b", False)], "user_id string, is_loyalty boolean")
    buyers = Y.customer_orders(order_frame(spark), customers)
    found = {r.user_id: r for r in buyers.collect()}
    assert (found["a"].total_orders, found["a"].avg_order_value, found["a"].is_repeat) == (2, 15.0, True)
    assert found["c"].loyalty_status is None
    kpi = {r.loyalty_status: r for r in Y.loyalty_kpis(buyers).collect()}
    assert (kpi["Loyalty Member"].avg_clv, kpi["Loyalty Member"].repeat_rate_pct) == (30.0, 100.0)
    assert kpi["Non-Member"].avg_order_value == Decimal("30.0000")
    assert shop.rows(Y.repeat_rate(buyers)) == [("Loyalty Member", 1, 1, 100.0), ("Non-Member", 1, 0, 0.0)]
    assert shop.rows(Y.monthly_loyalty(order_frame(spark)))[-1] == (dt.date(2023, 3, 31), "Non-Member", Decimal("30.00"))


def test_value_distribution(spark):
    buyers = spark.range(-1, 101).select(
        F.col("id").cast("string").alias("user_id"), F.col("id").cast("decimal(18,2)").alias("total_revenue"),
        F.lit("Loyalty Member").alias("loyalty_status"))
    bins = Y.capped_histogram(buyers, "0.95", 10).collect()
    assert {r.cap for r in bins} == {Decimal("95.0500")} and sum(r.customers for r in bins) == 95
    assert {r.bin for r in bins} == set(range(10))
    outlier = buyers.unionByName(buyers.limit(1).withColumn("total_revenue", F.lit(1000).cast("decimal(18,2)")))
    box = Y.box_stats(outlier).first()
    assert (box.customers, box.q1, box.median, box.q3) == (101, Decimal(26), Decimal(51), Decimal(76))
    assert (box.whisker_low, box.whisker_high, box.outliers) == (Decimal("1.00"), Decimal("100.00"), 1)


def test_locations(spark):
    restaurants = spark.createDataFrame([("r1", "A"), ("r2", "B")], "restaurant_id string, app_name string")
    df = N.orders_with_location(order_frame(spark), restaurants)
    ranking = N.location_ranking(df)
    assert [tuple(r) for r in ranking.collect()] == [
        ("A (#r1)", Decimal("60.00"), 3, 2, 20.0, Decimal("50.0")), ("B (#r2)", Decimal("5.00"), 1, 1, 5.0, Decimal("0.0"))]
    assert shop.rows(N.retention(df)) == [("A (#r1)", 2, 1, Decimal("50.0")), ("B (#r2)", 1, 0, Decimal("0.0"))]
    assert shop.rows(N.location_totals(df)) == shop.rows(ranking.drop("retention_rate"))
    assert tuple(N.location_kpis(ranking).first()) == (2, Decimal("60.00"), Decimal("25.0000"))
    assert N.ranking_table(ranking).first().avg_order_value == Decimal("20.00")


def test_equal_labels_are_one_location(spark):
    restaurants = spark.createDataFrame([("x-000001", "A"), ("y-000001", "A")], "restaurant_id string, app_name string")
    orders = shop.orders(
        spark, shop.order("1", "a", "2023-01-01", 1, place="x-000001"), shop.order("2", "a", "2023-01-01", 1, place="y-000001"))
    row = N.location_ranking(N.orders_with_location(orders, restaurants)).first()
    assert (row.total_orders, row.unique_customers, row.retention_rate) == (2, 1, Decimal("100.0"))


def test_pricing(spark):
    df = P.with_order_type(order_frame(spark))
    kinds = {r.order_type: r for r in P.order_type_agg(df).collect()}
    assert (kinds["With Paid Add-ons"].order_count, kinds["Base Order Only"].total_net) == (1, Decimal("55.00"))
    assert tuple(P.revenue_composition(df).first()) == (Decimal("61.00"), Decimal("2.00"), Decimal("63.00"))
    assert [tuple(r) for r in P.order_type_counts(df).collect()] == [("Base Order Only", 4), ("With Paid Add-ons", 1)]
    insight = P.addon_insights(df).first()
    assert (insight.avg_addon_revenue, insight.total_addon_revenue, insight.addon_pct_of_gross) == (2.0, Decimal("2.00"), 2 / 63 * 100)
    empty = P.addon_insights(df.limit(0)).first()
    assert (empty.avg_addon_revenue, empty.addon_pct_of_gross) == (None, 0.0)


def test_months_without_orders_stay(spark):
    assert shop.rows(P.addon_rate_monthly(order_frame(spark))) == [
        (dt.date(2023, 1, 31), 2, 1, Decimal("50.0")), (dt.date(2023, 2, 28), 0, 0, None),
        (dt.date(2023, 3, 31), 3, 0, Decimal("0.0"))]
