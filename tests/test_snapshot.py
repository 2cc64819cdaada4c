import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
import shop
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablespoon.operators import customer_daily as C
from tablespoon.operators import rfm as R


def plain_snapshot(customers, dates, orders):
    """The definition on plain rows: every customer walks through the days with a purse."""
    calendar = sorted(r.date_key for r in dates.collect())
    bought = {}
    for o in orders.collect():
        bought.setdefault((o.user_id, o.date_key), []).append(o)
    rows = []
    for c in customers.collect():
        count, value, seen = 0, Decimal(0), None
        for day in (d for d in calendar if c.first_order_date is not None and d >= c.first_order_date):
            today = bought.get((c.user_id, day), [])
            sums = [sum((getattr(o, k) for o in today), Decimal(0)) for k in ("gross_revenue", "net_revenue", "discount_amount")]
            count, value, seen = count + len(today), value + sums[1], day if today else seen
            since = (day - seen).days if seen else None
            gap = None
            if count > 1:
                gap = (Decimal((seen - c.first_order_date).days) / (count - 1)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            flag = "Churned" if since is None or since > 90 else "Active" if since <= 30 else "At Risk"
            rows.append([c.user_id, day, c.is_loyalty, len(today), *sums, count, value, since, gap, None, flag])
    for day in calendar:
        of_day = [r for r in rows if r[1] == day]
        for r in of_day:
            below = sum(x[8] < r[8] for x in of_day)
            rank = below / (len(of_day) - 1) if len(of_day) > 1 else 0.0
            r[11] = "High" if rank >= 0.8 else "Medium" if rank >= 0.2 else "Low"
    return [tuple(r) for r in rows]


def plain_rows(df, *columns):
    at = [C.SNAPSHOT_COLUMNS.index(c) for c in columns or C.SNAPSHOT_COLUMNS]
    return Counter(tuple(r[i] for i in at) for r in df)


def spark_rows(df, *columns):
    return Counter(map(tuple, df.select(*columns or C.SNAPSHOT_COLUMNS).collect()))


@pytest.fixture(scope="module")
def random_shop(spark):
    rnd = random.Random(7)
    start = dt.date(2023, 1, 1)
    rows = []
    for i in range(400):
        user = rnd.choice(["GUEST"] * 10 + [f"u{k}" for k in range(25)])
        date = start + dt.timedelta(rnd.randrange(150))
        rows.append(shop.order(str(i), user, date.isoformat(), rnd.choice([5, 5, 10, 12.34, 80]), discount=rnd.choice([0, 1])))
    orders = shop.orders(spark, *rows).cache()
    customers = shop.customers(spark, orders)
    # u1's lines start before the first order of the fact, u2 starts after an order of the fact; u99 has no order.
    first = F.when(F.col("user_id") == "u1", F.date_sub("first_order_date", 3)).when(
        F.col("user_id") == "u2", F.date_add("first_order_date", 2)).otherwise(F.col("first_order_date"))
    customers = customers.withColumn("first_order_date", first)
    extra = spark.createDataFrame([("u99", start, start, True), ("u98", dt.date(2024, 1, 1), start, True)], customers.schema)
    return customers.unionByName(extra).cache(), shop.dates(spark, "2023-01-01", "2023-06-10"), orders


def test_snapshot_equals_its_definition(random_shop):
    found = C.fct_customer_daily_snapshot(*random_shop)
    assert found.columns == C.SNAPSHOT_COLUMNS
    assert spark_rows(found) == plain_rows(plain_snapshot(*random_shop))


def test_spine_equals_the_cross_product(random_shop):
    customers, dates, orders = random_shop
    assert spark_rows(C.customer_spine(customers, dates), "user_id", "date_key") == plain_rows(
        plain_snapshot(customers, dates, orders), "user_id", "date_key")


@pytest.mark.parametrize("day", ["2023-01-01", "2023-02-14", "2023-06-10", None])
def test_one_day_equals_the_filtered_snapshot(random_shop, day):
    customers, dates, orders = random_shop
    wanted = C.fct_customer_daily_snapshot(customers, dates, orders).filter(F.col("date_key") == F.lit(day or "2023-06-10").cast("date"))
    found = C.snapshot_as_of(customers, dates, orders, day)
    assert found.schema.simpleString() == wanted.schema.simpleString()
    assert shop.rows(found) == shop.rows(wanted)


def test_stored_snapshot_is_filtered_in_the_scan(spark, random_shop, tmp_path):
    path = str(tmp_path / "snapshot")
    C.fct_customer_daily_snapshot(*random_shop).write.partitionBy("date_key").parquet(path)
    latest = C.latest_snapshot(spark.read.parquet(path))
    assert {r.date_key for r in latest.select("date_key").distinct().collect()} == {dt.date(2023, 6, 10)}
    assert "PartitionFilters: [isnotnull(date_key" in latest._jdf.queryExecution().executedPlan().toString()


def one_customer(spark, *days):
    orders = shop.orders(spark, *[shop.order(str(i), "u", d, 10) for i, d in enumerate(days)])
    return shop.customers(spark, orders), orders


@pytest.mark.parametrize("gap,flag", [(30, "Active"), (31, "At Risk"), (90, "At Risk"), (91, "Churned")])
def test_churn_bounds(spark, gap, flag):
    customers, orders = one_customer(spark, "2023-01-01")
    last = (dt.date(2023, 1, 1) + dt.timedelta(gap)).isoformat()
    row = C.fct_customer_daily_snapshot(customers, shop.dates(spark, "2023-01-01", last), orders).orderBy(F.desc("date_key")).first()
    assert (row.days_since_last_order, row.churn_risk_flag, row.avg_order_gap_days) == (gap, flag, None)
    assert row.clv_segment == "Low"  # a single customer has percent_rank 0


def test_two_orders_on_one_day_and_gap(spark):
    customers, orders = one_customer(spark, "2023-01-01", "2023-01-01", "2023-01-06")
    found = {r.date_key.day: r for r in C.fct_customer_daily_snapshot(customers, shop.dates(spark, "2023-01-01", "2023-01-07"), orders).collect()}
    assert (found[1].daily_order_count, found[1].avg_order_gap_days) == (2, Decimal("0.00"))
    assert (found[5].daily_order_count, found[5].cumulative_order_count, found[5].daily_net_revenue) == (0, 2, Decimal("0.00"))
    assert (found[7].cumulative_order_count, found[7].avg_order_gap_days) == (3, Decimal("2.50"))


@pytest.mark.parametrize("values,segments", [
    ([1, 2, 3, 4, 5, 6], "LMMMHH"), ([1, 1, 1, 1, 2], "LLLLH"), ([1, 2, 2, 2, 2], "LMMMM"), ([3, 3, 3, 3, 3], "LLLLL"),
    ([1, 1, 1, 2, 2, 2, 3, 3, 3, 3], "LLLMMMMMMM"), ([1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 9], "LLMMMMMMMHH"),
])
def test_segment_edges_with_ties(spark, values, segments):
    orders = shop.orders(spark, *[shop.order(str(i), f"u{i:02d}", "2023-01-01", v) for i, v in enumerate(values)])
    df = C.fct_customer_daily_snapshot(shop.customers(spark, orders), shop.dates(spark, "2023-01-01", "2023-01-01"), orders)
    ranks = {r.user_id: r.p for r in orders.withColumn("p", F.percent_rank().over(W.orderBy("net_revenue"))).collect()}
    wanted = {u: "High" if p >= 0.8 else "Medium" if p >= 0.2 else "Low" for u, p in ranks.items()}
    found = {r.user_id: r.clv_segment for r in df.collect()}
    assert found == wanted
    assert "".join(found[u][0] for u in sorted(found)) == segments


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7])
def test_rfm_scores_and_segments(spark, n):
    orders = [shop.order("base", "zz", "2023-03-01", 1)] if n else []
    for i in range(max(n - 1, 0)):
        orders += [shop.order(f"{i}-{j}", f"u{i}", "2023-02-01", 10) for j in range(1 + i % 2)]
    frame = shop.orders(spark, *orders) if orders else shop.orders(spark, shop.order("x", "x", "2023-01-01", 1)).limit(0)
    found = {r.user_id: r for r in R.fct_customer_rfm(frame).collect()}
    metrics = R.rfm_metrics(frame)
    for column, score in (("recency_days", "r_score"), ("frequency", "f_score"), ("monetary", "m_score")):
        tile = F.ntile(5).over(W.orderBy(column, "user_id"))
        wanted = {r.user_id: r.t for r in metrics.select("user_id", tile.alias("t")).collect()}
        assert {u: (6 - r[score] if score == "r_score" else r[score]) for u, r in found.items()} == wanted
    for r in found.values():
        rule = (
            "VIP" if min(r.r_score, r.f_score, r.m_score) >= 4
            else "New Customer" if r.f_score <= 2 and r.r_score >= 4
            else "Churn Risk" if r.r_score <= 2 and r.f_score <= 2
            else "Regular"
        )
        assert r.rfm_segment == rule


def test_rfm_as_of_and_months(spark):
    orders = shop.orders(spark, shop.order("1", "u", "2023-01-01", 5), shop.order("2", "u", "2023-05-01", 7), shop.order("3", "v", "2023-06-01", 9))
    early = R.rfm_metrics(orders, as_of="2023-05-10").first()
    assert (early.user_id, early.recency_days, early.frequency, early.date_key) == ("u", 9, 2, dt.date(2023, 5, 10))
    recent = {r.user_id: r.frequency for r in R.rfm_metrics(orders, months=3).collect()}
    assert recent == {"u": 1, "v": 1}
