"""

Queries derive the landing tables from the driver's ``lineitem``, ``orders`` and ``part``. Layer tables that a query
builds on are written once per session to the shared folder and read back, as in the batch job.
Large facts (customer x day) are registered as per-customer or per-day summaries over all of their rows.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_text
from tablespoon import fixtures as X
from tablespoon.functions.expressions import GOLD_MONEY, season
from tablespoon.operators import bronze as B
from tablespoon.operators import churn as H
from tablespoon.operators import accounts as K
from tablespoon.operators import customer_daily as C
from tablespoon.operators import daily_sales as A
from tablespoon.operators import dimensions as D
from tablespoon.operators import locations as N
from tablespoon.operators import loyalty as Y
from tablespoon.operators import order_summary as O
from tablespoon.operators import pricing as P
from tablespoon.operators import quality as Q
from tablespoon.operators import rfm as R
from tablespoon.operators import sales as T
from tablespoon.operators import segmentation as G
from tablespoon.operators import silver as S
from tablespoon.plans import Warehouse, roll_forward
from tablespoon.session import scratch_dir, stored
from tablespoon.sources import LANDING_SCHEMAS, Layout, load_landing, read_table, write_table
from tablespoon.streaming import ingest_landing

try:
    import corpus_pipeline
    from tablespoon.llm import queries as training_data
except ImportError as missing:  # the subpackage, or a library that only it needs, is not there
    logging.getLogger(__name__).warning("training-data queries left out: %s", missing)
    corpus_pipeline = training_data = None

INGESTED_AT = "2024-03-01T00:00:00+00:00"

_warehouses: dict[tuple[str, str], Warehouse] = {}
_cubes: dict[Warehouse, DataFrame] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The layer tables over ``sf_dir``, built on first use and kept for the session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _warehouses:
        sources = {
            "order_items": X.landing_order_items,
            "order_item_options": X.landing_order_item_options,
            "date_dim": X.landing_date_dim,
        }
        _warehouses[key] = Warehouse(
            spark,
            lambda name: sources[name](spark, sf_dir),
            Layout(scratch_dir(spark, "tables")),
            INGESTED_AT,
            X.TEST_ACCOUNTS,
        )
    return _warehouses[key]


def _money(column: str, alias: str):
    return F.sum(column).cast(GOLD_MONEY).alias(alias)


def _days_with(column: str, value: str):
    return F.count_if(F.col(column) == value).alias(f"days_{value.lower().replace(' ', '_')}")


# --- sources and sinks -------------------------------------------------------------------------------------------


def _csv_scan(w: Warehouse) -> DataFrame:
    path = scratch_dir(w.spark, "landing-csv")
    w.landing("order_items").write.option("header", "true").csv(path)
    return load_landing(w.spark, path, "csv", LANDING_SCHEMAS["order_items"]).drop("PRINTED_CARD_NUMBER")


def _quoted_csv(w: Warehouse) -> DataFrame:
    """Item names that hold a comma, a newline and a quote, written and scanned by blocks."""
    path = scratch_dir(w.spark, "landing-quoted")
    w.landing("order_items").withColumn("ITEM_NAME", F.expr(X.QUOTED_NAME)).write.option("header", "true").csv(path)
    return load_landing(w.spark, path, "csv", LANDING_SCHEMAS["order_items"]).drop("PRINTED_CARD_NUMBER")


def _incremental_landing(w: Warehouse) -> DataFrame:
    """Two arrivals of landing files and a run without any, as batches of a file stream."""
    folder, layout = scratch_dir(w.spark, "arrivals"), Layout(scratch_dir(w.spark, "incremental"))
    options, second = w.landing("order_item_options"), F.pmod(F.xxhash64("ORDER_ID"), F.lit(2))
    for part in (0, 1, 2):
        if part < 2:
            options.where(second == part).write.option("header", "true").csv(f"{folder}/{part}")
        found = ingest_landing(
            w.spark, folder, layout, "order_item_options", lambda df: B.bronze_order_item_options(df, INGESTED_AT),
            checkpoint=f"{layout.root}/progress", pattern="*.csv",
        )
    return found.drop("ingest_batch")


def _rapid_lines(w: Warehouse) -> DataFrame:
    """Lines by location without the accounts that the given, low bounds find."""
    typed = S.drop_outliers(S.drop_test_items(_typed(w)))
    found = K.rapid_accounts(K.account_activity(typed), least_orders=2, quick_share=0.5, most_a_day=2, locations=2)
    return S.exclude_users(typed, found).groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("lines"))


def _parquet_scan(w: Warehouse) -> DataFrame:
    path = scratch_dir(w.spark, "landing-parquet")
    w.landing("order_item_options").write.parquet(path)
    return load_landing(w.spark, path, "parquet")


def _round_trip(w: Warehouse, df: DataFrame, layer: str, name: str, partition_cols: list[str]) -> DataFrame:
    layout = Layout(scratch_dir(w.spark, "round-trip"))
    write_table(df, layout, layer, name, partition_cols)
    return read_table(w.spark, layout, layer, name)


# --- shared frames -----------------------------------------------------------------------------------------------


def _items(w: Warehouse) -> DataFrame:
    return w.silver("order_items")


def _options(w: Warehouse) -> DataFrame:
    return w.silver("order_item_options")


def _bronze_items(w: Warehouse) -> DataFrame:
    return S.backfill_guest(S.normalize_columns(w.bronze("order_items")))


def _typed(w: Warehouse) -> DataFrame:
    return S.with_repaired_category(S.typed_items(_bronze_items(w)))


def _orders(w: Warehouse) -> DataFrame:
    return w.gold("fct_order_summary")


def _customers(w: Warehouse) -> DataFrame:
    return w.gold("dim_customer")


def _snapshot_inputs(w: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    return _customers(w), w.gold("dim_date"), _orders(w)


def _lines(w: Warehouse) -> DataFrame:
    return A.enrich_lines(_items(w), _options(w))


def _states(w: Warehouse) -> DataFrame:
    return C.unfold_days(C.activity_with_totals(*_snapshot_inputs(w)))


def _snapshot(w: Warehouse) -> DataFrame:
    return C.fct_customer_daily_snapshot(*_snapshot_inputs(w))


def _latest(w: Warehouse) -> DataFrame:
    return C.snapshot_as_of(*_snapshot_inputs(w))


def _rfm(w: Warehouse) -> DataFrame:
    return G.rfm_with_loyalty(w.gold("fct_customer_rfm"), _customers(w))


def _scores(w: Warehouse) -> DataFrame:
    return R.rfm_scores(R.rfm_metrics(_orders(w)))


def _sales(w: Warehouse) -> DataFrame:
    return T.enrich_sales(w.gold("fct_daily_sales_summary"), w.gold("dim_restaurant"), w.gold("dim_date"))


def _cube(w: Warehouse) -> DataFrame:
    """The stored sales cube, built on first use."""
    if w not in _cubes:
        _cubes[w] = stored(T.sales_cube(_sales(w)), "cube")
    return _cubes[w]


def _merged_customers(w: Warehouse) -> DataFrame:
    """The customer dimension from the stored states of two halves of the lines."""
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    states = [stored(D.customer_state(_items(w).filter(half == k)), "customers") for k in (0, 1)]
    return D.customers_of(D.merged_states(*states))


def _buyers(w: Warehouse) -> DataFrame:
    return Y.customer_orders(_orders(w), _customers(w))


def _located(w: Warehouse) -> DataFrame:
    return N.orders_with_location(_orders(w), w.gold("dim_restaurant"))


def _typed_orders(w: Warehouse) -> DataFrame:
    return P.with_order_type(_orders(w))


def _typed_options(w: Warehouse) -> DataFrame:
    return S.silver_order_item_options(w.bronze("order_item_options"))


_TOTALS = ["option_revenue", "discount_amount", "discounted"]


def _option_sums(df: DataFrame, *extra: str) -> DataFrame:
    money = {c: F.col(c).cast(GOLD_MONEY) for c in _TOTALS[:2]}
    return df.withColumns(money).select("order_id", *extra, *_TOTALS)


def _with_epoch(df: DataFrame) -> DataFrame:
    return df.withColumn("order_timestamp_ms", F.unix_millis("order_timestamp")).drop("order_timestamp")


def _snapshot_months(w: Warehouse) -> DataFrame:
    """All snapshot rows, rolled up to customer and month."""
    return _snapshot(w).groupBy("user_id", F.last_day("date_key").alias("month_end")).agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if("is_loyalty").alias("loyal_days"),
        F.sum("daily_order_count").alias("orders"),
        _money("daily_gross_revenue", "gross"),
        _money("daily_net_revenue", "net"),
        _money("daily_discount_amount", "discount"),
        F.max("cumulative_order_count").alias("lifetime_orders"),
        F.max("cumulative_ltv").alias("lifetime_value"),
        F.sum("days_since_last_order").alias("sum_days_since"),
        _money("avg_order_gap_days", "sum_gap"),
        *[_days_with("clv_segment", v) for v in ("High", "Medium", "Low")],
        *[_days_with("churn_risk_flag", v) for v in ("Active", "At Risk", "Churned")],
    )


def _last_order_days(w: Warehouse) -> DataFrame:
    """The operator's own column, weighted by the days for which each order day stays the last one."""
    totals = C.activity_with_totals(*_snapshot_inputs(w)).filter("valid_from <= valid_to")
    seen = F.col("last_order_so_far")
    return totals.groupBy("user_id").agg(
        F.sum(F.datediff("valid_to", "valid_from") + 1).cast("bigint").alias("days"),
        F.countDistinct(seen).alias("order_days"),
        F.min(seen).alias("first_seen"),
        F.max(seen).alias("last_seen"),
    )


def _row_text(snapshot: DataFrame) -> Column:
    """The columns of a row as one text. Days come as text from the calendar, a zero amount is text already: writing these
    out for every row would take most of the time."""

    def text(name: str) -> Column:
        column, kind = F.col(name), snapshot.schema[name].dataType
        if name == "date_key":
            return F.coalesce("day_text", column.cast("string"))
        if kind.simpleString() == GOLD_MONEY:
            return F.when(column == 0, F.lit("0.00")).otherwise(column.cast("string"))
        return column.cast("string")

    return F.concat_ws("|", *(F.coalesce(text(name), F.lit("")) for name in X.SNAPSHOT_TEXT))


def _digest(snapshot: DataFrame, dates: DataFrame) -> DataFrame:
    """Every row and column of a stored snapshot, as one number per customer; ``dates`` has one row per calendar day."""
    days = dates.select(F.col("date_key").alias("day"), F.col("date_key").cast("string").alias("day_text"))
    number = F.conv(F.substring(F.md5(_row_text(snapshot).cast("binary")), 1, 8), 16, 10).cast("bigint")
    rows = snapshot.join(F.broadcast(days), F.col("date_key") == F.col("day"), "left")
    return rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("days"), F.sum(number).alias("digest"))


def _snapshot_digest(w: Warehouse) -> DataFrame:
    return _digest(w.gold("fct_customer_daily_snapshot"), w.gold("dim_date"))


def _rolled_forward(w: Warehouse) -> DataFrame:
    """The snapshot built over the first half of the calendar, short of some late orders, then advanced; as one number
    per customer like :func:`_snapshot_digest`."""
    layout = Layout(scratch_dir(w.spark, "rolled"))
    ends = w.gold("dim_date").agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")).first()
    cut = ends.a + (ends.b - ends.a) // 2
    late = (F.col("date_key") >= F.lit(cut - dt.timedelta(days=40))) & (F.pmod(F.xxhash64("order_id"), F.lit(7)) == 0)
    known = (F.col("date_key") < F.lit(cut)) & ~late
    orders = _orders(w)
    early = orders.filter(known)
    half = D.dim_customer(_items(w).join(early.select("order_id"), "order_id", "left_semi"))
    days = w.gold("dim_date").filter(F.col("date_key") < F.lit(cut))
    table = ("gold", "fct_customer_daily_snapshot")
    write_table(C.fct_customer_daily_snapshot(half, days, early, by_month=True), layout, *table, ["date_key_month"])
    new = orders.filter(~known).agg(F.min("date_key").alias("d")).first().d
    roll_forward(layout, _customers(w), w.gold("dim_date"), orders, new)
    return _digest(read_table(w.spark, layout, *table), w.gold("dim_date"))


def _row_counts(w: Warehouse, sf_dir: str) -> DataFrame:
    lines = w.spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return Q.run_checks(
        [
            Q.check_rows(w.gold("dim_restaurant"), "gold.dim_restaurant", Q.row_count(28)),
            Q.same_count("bronze.order_items", w.bronze("order_items"), lines),
        ]
    )


def _not_null(w: Warehouse) -> DataFrame:
    return Q.run_checks(
        [
            Q.check_rows(
                _items(w), "silver.order_items",
                Q.not_null("user_id", "line_item_revenue", "item_price", "item_quantity"),
            ),
            Q.check_rows(_options(w), "silver.order_item_options", Q.not_null("option_price", "option_quantity")),
            Q.check_rows(
                _orders(w), "gold.fct_order_summary",
                Q.not_null("gross_revenue", "net_revenue", "option_revenue", "discount_amount"),
            ),
            Q.check_rows(_customers(w), "gold.dim_customer", Q.not_null("first_order_date", "last_order_date")),
        ]
    )


def _formulas(w: Warehouse) -> DataFrame:
    col = F.col
    net = col("gross_revenue") + col("option_revenue") - col("discount_amount")
    return Q.run_checks(
        [
            Q.check_rows(
                _items(w), "silver.order_items",
                Q.formula("line_item_revenue", col("item_price") * col("item_quantity"), col("line_item_revenue")),
            ),
            Q.check_rows(
                _options(w), "silver.order_item_options",
                Q.formula("option_revenue", col("option_price") * col("option_quantity"), col("option_revenue")),
            ),
            Q.check_rows(_orders(w), "gold.fct_order_summary", Q.formula("net_revenue", net, col("net_revenue"))),
        ]
    )


def _uniques(w: Warehouse) -> DataFrame:
    keys = {"dim_customer": "user_id", "dim_restaurant": "restaurant_id", "dim_date": "date_key",
            "fct_order_summary": "order_id", "fct_customer_rfm": "user_id"}
    checks = [Q.unique(w.gold(table), f"gold.{table}", [key]) for table, key in keys.items()]
    return Q.run_checks([*checks, Q.unique(_items(w), "silver.order_items", ["order_id", "lineitem_id"])])


def _domains(w: Warehouse) -> DataFrame:
    return Q.run_checks(
        [
            Q.check_rows(
                w.gold("fct_customer_daily_snapshot"), "gold.fct_customer_daily_snapshot",
                Q.in_domain("clv_segment", ["High", "Medium", "Low"]),
                Q.in_domain("churn_risk_flag", ["Active", "At Risk", "Churned"]),
            ),
            Q.check_rows(
                w.gold("fct_customer_rfm"), "gold.fct_customer_rfm",
                Q.in_domain("rfm_segment", ["VIP", "New Customer", "Churn Risk", "Regular"]),
            ),
        ]
    )


def _types(w: Warehouse) -> DataFrame:
    return Q.run_checks(
        [
            Q.has_type(
                _items(w), "silver.order_items",
                {"is_loyalty": "boolean", "item_price": "decimal(10,2)", "order_date": "date"},
            ),
            Q.has_type(w.silver("date_dim"), "silver.date_dim", {"is_weekend": "boolean", "is_holiday": "boolean"}),
        ]
    )


_QUERIES: dict[str, Callable[[Warehouse, str], DataFrame]] = {
    # sources and sinks
    "s1_csv_scan": lambda w, d: _csv_scan(w),
    "s1_quoted_csv": lambda w, d: _quoted_csv(w),
    "s2_parquet_scan": lambda w, d: _parquet_scan(w),
    "s4_layer_scan": lambda w, d: _options(w),
    "s5_sink_roundtrip": lambda w, d: _round_trip(w, _orders(w), "gold", "fct_order_summary", ["date_key_month"]),
    "s8_latest_date": lambda w, d: C.latest_date(w.with_months("gold", "fct_customer_daily_snapshot")),
    "s9_latest_snapshot": lambda w, d: C.latest_snapshot(w.with_months("gold", "fct_customer_daily_snapshot")),
    # landing to bronze
    "b1_ingest_stamp": lambda w, d: B.with_ingestion_ts(
        w.landing("order_item_options").select("ORDER_ID", "LINEITEM_ID", "OPTION_NAME", "OPTION_PRICE"), INGESTED_AT
    ),
    "b2_partition_key": lambda w, d: B.with_order_date_partition(
        w.landing("order_items").select("ORDER_ID", "LINEITEM_ID", "CREATION_TIME_UTC")
    ),
    "b3_bronze_items": lambda w, d: _round_trip(
        w, B.bronze_order_items(w.landing("order_items"), INGESTED_AT), "bronze", "order_items",
        B.BRONZE_PARTITIONS["order_items"],
    ).drop("PRINTED_CARD_NUMBER"),
    "b6_incremental_landing": lambda w, d: _incremental_landing(w),
    "b4_bronze_options": lambda w, d: _round_trip(
        w, B.bronze_order_item_options(w.landing("order_item_options"), INGESTED_AT), "bronze", "order_item_options",
        B.BRONZE_PARTITIONS["order_item_options"],
    ),
    "b5_bronze_dates": lambda w, d: _round_trip(
        w, B.bronze_date_dim(w.landing("date_dim"), INGESTED_AT), "bronze", "date_dim",
        B.BRONZE_PARTITIONS["date_dim"],
    ),
    # bronze to silver
    "v1_rename": lambda w, d: S.normalize_columns(w.landing("order_items")).drop("printed_card_number"),
    "v2_order_ts": lambda w, d: _with_epoch(_typed(w).select("order_id", "lineitem_id", "order_timestamp")),
    "v3_order_date": lambda w, d: _typed(w).select("order_id", "lineitem_id", "order_date"),
    "v4_guest_backfill": lambda w, d: _bronze_items(w).select("order_id", "lineitem_id", "user_id"),
    "v5_typed_items": lambda w, d: _typed(w).select(
        "order_id", "lineitem_id", "item_price", "item_quantity", "is_loyalty"
    ),
    "v6_line_revenue": lambda w, d: _typed(w).select("order_id", "lineitem_id", "line_item_revenue"),
    "v7_category_repair": lambda w, d: S.with_repaired_category(
        _bronze_items(w).withColumn("raw_category", F.col("item_category"))
    ).groupBy("raw_category", "item_category").agg(F.count(F.lit(1)).alias("lines")),
    "v8_test_item_filter": lambda w, d: S.drop_test_items(_typed(w)).select("order_id", "lineitem_id", "item_category"),
    "v9_outlier_filter": lambda w, d: S.drop_outliers(_typed(w)).select(
        "order_id", "lineitem_id", "item_price", "item_quantity", "line_item_revenue"
    ),
    "v10_account_activity": lambda w, d: K.account_activity(_items(w)),
    "v10_rapid_lines": lambda w, d: _rapid_lines(w),
    "v10_denylist": lambda w, d: S.exclude_users(_bronze_items(w), X.TEST_ACCOUNTS).select(
        "order_id", "lineitem_id", "user_id"
    ),
    "v11_silver_partition": lambda w, d: S.with_silver_partition(_typed(w)).select(
        "order_id", "lineitem_id", "order_date_partition"
    ),
    "v12_typed_options": lambda w, d: _typed_options(w).select(
        "order_id", "lineitem_id", "option_name", "option_price", "option_quantity"
    ),
    "v13_option_revenue": lambda w, d: _typed_options(w).select(
        "order_id", "lineitem_id", "option_name", "option_revenue"
    ),
    "v14_is_discount": lambda w, d: _typed_options(w).select("order_id", "lineitem_id", "option_name", "is_discount"),
    "v15_date_typing": lambda w, d: S.silver_date_dim(w.bronze("date_dim")),
    "v17_silver_items": lambda w, d: _with_epoch(S.silver_order_items(w.bronze("order_items"), X.TEST_ACCOUNTS)),
    "v17_silver_options": lambda w, d: _typed_options(w),
    # dimensions
    "d1_date_bounds": lambda w, d: D.date_bounds(_items(w)),
    "d2_date_spine": lambda w, d: D.date_spine(D.date_bounds(_items(w))),
    "d3_calendar": lambda w, d: D.calendar_attributes(D.date_spine(D.date_bounds(_items(w)))),
    "d4_holidays": lambda w, d: D.holiday_lookup(w.silver("date_dim")),
    "d5_dim_date": lambda w, d: D.dim_date(_items(w), w.silver("date_dim")),
    "d6_dim_restaurant": lambda w, d: D.dim_restaurant(_items(w)),
    "d7_customer_span": lambda w, d: D.dim_customer(_items(w)).select("user_id", "first_order_date", "last_order_date"),
    "d8_latest_loyalty": lambda w, d: D.dim_customer(_items(w)).select("user_id", "is_loyalty"),
    "d9_primary_restaurant": lambda w, d: D.dim_customer(_items(w)).select(
        "user_id", "primary_restaurant_id", "primary_app"
    ),
    "d11_merged_customers": lambda w, d: _merged_customers(w),
    "d10_dim_customer": lambda w, d: D.dim_customer(_items(w)),
    # order summary
    "o1_items_per_order": lambda w, d: O.order_items_agg(_items(w)),
    "o2_options_per_order": lambda w, d: _option_sums(O.order_options_agg(_options(w))),
    "o3_order_join": lambda w, d: _option_sums(O.orders_with_options(_items(w), _options(w)), "gross_revenue"),
    "o4_order_summary": lambda w, d: O.fct_order_summary(_items(w), _options(w)),
    # daily sales
    "a1_options_per_line": lambda w, d: _option_sums(A.line_options_agg(_options(w)), "lineitem_id"),
    "a2_line_join": lambda w, d: _option_sums(_lines(w), "lineitem_id", "line_item_revenue"),
    "a3_line_net": lambda w, d: _lines(w).select(
        "order_id", "lineitem_id", F.col("line_net_revenue").cast(GOLD_MONEY).alias("line_net_revenue")
    ),
    "a4_order_discount": lambda w, d: A.with_order_discount(A.order_category_totals(_lines(w))).select(
        "order_id", *A.SALES_KEYS, "order_discounted"
    ),
    "a5_daily_sales": lambda w, d: A.daily_sales(A.with_order_discount(A.order_category_totals(_lines(w)))),
    "a6_daily_sales_fact": lambda w, d: A.fct_daily_sales_summary(_items(w), _options(w)),
    # customer x day snapshot
    "c1_global_max": lambda w, d: C.last_day(w.gold("dim_date")),
    "c2_customer_spine": lambda w, d: C.customer_spine(_customers(w), w.gold("dim_date")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("date_key").alias("first_day"), F.max("date_key").alias("last_day")
    ),
    "c3_daily_activity": lambda w, d: C.daily_activity(_orders(w)),
    "c4_spine_activity": lambda w, d: _states(w).groupBy("date_key").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("daily_order_count").alias("orders"),
        _money("daily_gross_revenue", "gross"),
        _money("daily_net_revenue", "net"),
        _money("daily_discount_amount", "discount"),
    ),
    "c5_cumulative_ltv": lambda w, d: _states(w).groupBy("user_id").agg(
        F.sum("cumulative_order_count").alias("sum_orders"),
        F.max("cumulative_order_count").alias("max_orders"),
        _money("cumulative_ltv", "sum_ltv"),
        F.min("cumulative_ltv").alias("min_ltv"),
        F.max("cumulative_ltv").alias("max_ltv"),
    ),
    "c6_last_order_so_far": lambda w, d: _last_order_days(w),
    "c7_days_since": lambda w, d: _states(w).groupBy("user_id").agg(
        F.sum("days_since_last_order").alias("sum_days"), F.max("days_since_last_order").alias("max_days")
    ),
    "c8_avg_gap": lambda w, d: _states(w).groupBy("user_id").agg(
        F.count("avg_order_gap_days").alias("days_with_gap"), _money("avg_order_gap_days", "sum_gap")
    ),
    "c9_clv_segment": lambda w, d: _snapshot(w).groupBy("date_key", "clv_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("cumulative_ltv").alias("min_ltv"),
        F.max("cumulative_ltv").alias("max_ltv"),
        _money("cumulative_ltv", "sum_ltv"),
    ),
    "c10_churn_flag": lambda w, d: C.with_churn_flag(_states(w)).groupBy("date_key", "churn_risk_flag").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("days_since_last_order").alias("min_days"),
        F.max("days_since_last_order").alias("max_days"),
    ),
    "c11_snapshot": lambda w, d: _snapshot_months(w),
    "c13_rolled_forward": lambda w, d: _rolled_forward(w),
    "c12_snapshot_digest": lambda w, d: _snapshot_digest(w),
    # rfm
    "r1_reference_date": lambda w, d: R.reference_date(_orders(w)),
    "r2_rfm_metrics": lambda w, d: R.rfm_metrics(_orders(w)),
    "r3_r_score": lambda w, d: _scores(w).select("user_id", "r_score"),
    "r4_f_score": lambda w, d: _scores(w).select("user_id", "f_score"),
    "r5_m_score": lambda w, d: _scores(w).select("user_id", "m_score"),
    "r6_rfm": lambda w, d: R.fct_customer_rfm(_orders(w)),
    # reports: loaders and segmentation
    "l1_location_label": lambda w, d: T.with_location_label(w.gold("dim_restaurant")),
    "l2_normalize": lambda w, d: H.normalize_money(
        _latest(w), ["daily_net_revenue", "cumulative_ltv", "avg_order_gap_days"]
    ).select("user_id", "daily_net_revenue", "cumulative_ltv", "avg_order_gap_days"),
    "g1_rfm_loyalty": lambda w, d: _rfm(w),
    "g2_segment_kpis": lambda w, d: G.segmentation_kpis(_rfm(w)),
    "g3_rfm_sample": lambda w, d: G.rfm_sample(_rfm(w), 500),
    "g4_segment_counts": lambda w, d: G.segment_counts(_rfm(w)),
    "g5_segment_loyalty": lambda w, d: G.segment_by_loyalty(_rfm(w)),
    "g6_segment_profile": lambda w, d: G.segment_profile(_rfm(w)),
    # reports: churn
    "h1_latest_snapshot": lambda w, d: _latest(w),
    "h2_churn_kpis": lambda w, d: H.churn_kpis(_latest(w)),
    "h3_churn_counts": lambda w, d: H.churn_counts(_latest(w)),
    "h4_inactivity_hist": lambda w, d: H.histogram(_latest(w), "days_since_last_order", 30, ["churn_risk_flag"]),
    "h5_gap_by_status": lambda w, d: H.gap_by_status(_latest(w)),
    "h6_ltv_by_status": lambda w, d: H.ltv_by_status(_latest(w)),
    "h7_at_risk_top50": lambda w, d: H.at_risk_top(_latest(w)),
    # reports: sales
    "t1_enriched_sales": lambda w, d: _sales(w).drop("season"),
    "t2_season": lambda w, d: _sales(w)
    .withColumn("season", season(F.col("month_number")))
    .groupBy("month_number", "season")
    .agg(F.count(F.lit(1)).alias("sales_rows")),
    "t3_date_range": lambda w, d: T.between_dates(_sales(w), "1996-01-01", "2000-06-30").select(
        "date_key", "restaurant_id", "item_category", "net_revenue"
    ),
    "t4_top_categories": lambda w, d: T.top_n(_sales(w), "item_category", 8),
    "t5_top_locations": lambda w, d: T.top_n(_sales(w), "location_label", 5),
    "t6_sales_kpis": lambda w, d: T.sales_kpis(_sales(w)),
    "t7_monthly_category": lambda w, d: T.cube_months(_cube(w), "category", 8),
    "t8_monthly_location": lambda w, d: T.cube_months(_cube(w), "location", 5),
    "t9_season_category": lambda w, d: T.cube_seasons(_cube(w), "category", 8),
    "t10_season_location": lambda w, d: T.cube_seasons(_cube(w), "location", 10),
    "t11_holiday_effect": lambda w, d: T.cube_holidays(_cube(w)),
    "t12_season_total": lambda w, d: T.cube_seasons(_cube(w)),
    # reports: loyalty
    "y1_customer_orders": lambda w, d: _buyers(w),
    "y2_loyalty_kpis": lambda w, d: Y.loyalty_kpis(_buyers(w)),
    "y3_clv_hist": lambda w, d: Y.capped_histogram(_buyers(w)),
    "y4_repeat_rate": lambda w, d: Y.repeat_rate(_buyers(w)),
    "y5_box_stats": lambda w, d: Y.box_stats(_buyers(w)),
    "y6_monthly_loyalty": lambda w, d: Y.monthly_loyalty(_orders(w)),
    # reports: locations
    "n1_orders_location": lambda w, d: _located(w).select("order_id", "restaurant_id", "location_label"),
    "n2_location_totals": lambda w, d: N.location_totals(_located(w)),
    "n3_retention": lambda w, d: N.retention(_located(w)),
    "n4_location_ranking": lambda w, d: N.location_ranking(_located(w)),
    "n7_ranking_table": lambda w, d: N.ranking_table(N.location_ranking(_located(w))),
    "n5_location_kpis": lambda w, d: N.location_kpis(N.location_ranking(_located(w))),
    "n6_location_trend": lambda w, d: T.cube_months(_cube(w), "location", keys=N.location_ranking(_located(w)).limit(3)),
    # reports: pricing
    "x1_order_type": lambda w, d: _typed_orders(w).select("order_id", "option_revenue", "order_type"),
    "x2_type_agg": lambda w, d: P.order_type_agg(_typed_orders(w)),
    "x3_composition": lambda w, d: P.revenue_composition(_orders(w)),
    "x4_addon_rate": lambda w, d: P.addon_rate_monthly(_orders(w)),
    "x5_volume_split": lambda w, d: P.order_type_counts(_typed_orders(w)),
    "x6_addon_insights": lambda w, d: P.addon_insights(_orders(w)),
    # data quality
    "q1_row_count": _row_counts,
    "q2_layer_counts": lambda w, d: Q.run_checks(
        [
            Q.same_count(f"silver.{name}", w.silver(name), w.bronze(name))
            for name in ("order_items", "order_item_options")
        ]
    ),
    "q3_not_null": lambda w, d: _not_null(w),
    "q4_null_bound": lambda w, d: Q.check_rows(
        w.bronze("order_items"), "bronze.order_items", Q.null_bound("LINEITEM_ID", 100)
    ),
    "q5_value_count": lambda w, d: Q.same_value_count(
        _items(w), "silver.order_items", "user_id", S.GUEST,
        S.silver_order_items(w.bronze("order_items").filter("USER_ID IS NULL"), X.TEST_ACCOUNTS),
    ),
    "q6_types": lambda w, d: _types(w),
    "q7_formula": lambda w, d: _formulas(w),
    "q8_flag": lambda w, d: Q.check_rows(
        _options(w), "silver.order_item_options", Q.flag_matches("is_discount", F.col("option_price") < 0)
    ),
    "q9_unique": lambda w, d: _uniques(w),
    "q10_coverage": lambda w, d: Q.covers(w.gold("dim_date"), _items(w), "gold.dim_date", "order_date"),
    "q11_orphans": lambda w, d: Q.run_checks(
        [
            Q.no_orphans(_orders(w), _customers(w), "gold.fct_order_summary", "user_id"),
            Q.no_orphans(_orders(w), w.gold("dim_restaurant"), "gold.fct_order_summary", "restaurant_id"),
        ]
    ),
    "q12_grain": lambda w, d: Q.run_checks(
        [
            Q.same_distinct(_orders(w), _items(w), "gold.fct_order_summary", "order_id"),
            Q.same_distinct(w.gold("fct_customer_rfm"), _customers(w), "gold.fct_customer_rfm", "user_id"),
        ]
    ),
    "q13_domain": lambda w, d: _domains(w),
    "q14_range": lambda w, d: Q.check_rows(
        w.gold("fct_customer_rfm"), "gold.fct_customer_rfm", Q.in_range(1, 5, "r_score", "f_score", "m_score")
    ),
    "q15_monotonic": lambda w, d: Q.non_decreasing(
        w.gold("fct_customer_daily_snapshot"), "gold.fct_customer_daily_snapshot", "user_id", "date_key", "cumulative_ltv"
    ),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the lifetime-value snapshot of the last day, one row per customer."""
    return queries()["h1_latest_snapshot"](spark, "/root/testdata/sf0.001")


def _with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import the package from here, whatever folder the driver was started in."""
    here, known = os.path.dirname(os.path.abspath(__file__)), spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, known]))
    return spark


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Warehouse, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(warehouse(spark, sf_dir), sf_dir)

    found = {key: bind(build) for key, build in _QUERIES.items()}
    if training_data:
        for key, query in (training_data.QUERIES | {"pipeline": corpus_pipeline.run}).items():
            found[key] = lambda spark, sf_dir, query=query: query(_with_package(spark), sf_dir)
    return found


def oracle_sql() -> dict[str, str]:
    return oracle_text.STATEMENTS | (training_data.ORACLE if training_data else {})
