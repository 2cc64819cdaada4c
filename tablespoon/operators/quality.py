"""Data-quality checks. Every check yields one row (check_name, table_name, passed, measured, expected).

``measured`` is a count: of rows, of distinct keys, or of rows that break the rule (then ``expected`` is 0).
Row-level checks of one table are columns of a single aggregate, so a table is read once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """A check that one aggregate column can measure; it passes when ``holds(measured)``."""

    name: str
    measured: Column
    expected: int = 0
    holds: Callable[[Column], Column] | None = None


def _violations(rule_broken: Column) -> Column:
    return F.count_if(F.coalesce(rule_broken, F.lit(True)))


def row_count(n: int) -> RowCheck:
    return RowCheck("row_count", F.count(F.lit(1)), n)


def not_null(*columns: str) -> list[RowCheck]:
    return [RowCheck(f"not_null:{c}", F.count_if(F.col(c).isNull())) for c in columns]


def null_bound(column: str, fewer_than: int) -> RowCheck:
    return RowCheck(
        f"null_bound:{column}", F.count_if(F.col(column).isNull()), fewer_than, lambda measured: measured < fewer_than
    )


def value_count(column: str, value: object, n: int) -> RowCheck:
    return RowCheck(f"value_count:{column}", F.count_if(F.col(column) == F.lit(value)), n)


def same_value_count(df: DataFrame, table: str, column: str, value: object, source: DataFrame) -> DataFrame:
    """Rows with a value against the rows of a source that must lead to it."""
    counted = df.agg(F.count_if(F.col(column) == F.lit(value)).alias("a"))
    both = counted.withColumn("b", source.agg(F.count(F.lit(1))).scalar())
    return _single(both, f"value_count:{column}", table, F.col("a") == F.col("b"), F.col("a"), F.col("b"))


def formula(name: str, expected: Column, actual: Column, tolerance: str = "0.01") -> RowCheck:
    """Two amounts agree within the tolerance on every row; a NULL on either side breaks the rule."""
    far = F.abs(actual - expected) > F.lit(tolerance).cast("decimal(18,4)")
    return RowCheck(f"formula:{name}", _violations(far))


def flag_matches(flag: str, rule: Column) -> RowCheck:
    return RowCheck(f"flag_matches:{flag}", F.count_if(~F.col(flag).eqNullSafe(rule)))


def in_domain(column: str, values: Sequence[str]) -> RowCheck:
    return RowCheck(f"in_domain:{column}", _violations(~F.col(column).isin(list(values))))


def in_range(low: int, high: int, *columns: str) -> list[RowCheck]:
    return [
        RowCheck(f"in_range:{c}", _violations((F.col(c) < low) | (F.col(c) > high))) for c in columns
    ]


def _flat(checks: Sequence[RowCheck | list[RowCheck]]) -> list[RowCheck]:
    return [c for entry in checks for c in (entry if isinstance(entry, list) else [entry])]


def measures(checks: Sequence[RowCheck | list[RowCheck]]) -> list[Column]:
    """What row checks measure, as aggregate columns for one pass, be it a scan or the write of the table."""
    return [c.measured.cast("bigint").alias(f"m{i}") for i, c in enumerate(_flat(checks))]


def check_rows(df: DataFrame, table: str, *checks: RowCheck | list[RowCheck]) -> DataFrame:
    """Run row-level checks of one table in one pass."""
    return verdicts(df.agg(*measures(checks)), table, *checks)


def verdicts(measured: DataFrame, table: str, *checks: RowCheck | list[RowCheck]) -> DataFrame:
    """Results of row checks from one row of :func:`measures`."""
    rows = []
    for i, c in enumerate(_flat(checks)):
        value = F.col(f"m{i}")
        rows.append(_result(c.name, table, (c.holds or (lambda m, c=c: m == c.expected))(value), value, F.lit(c.expected)))
    return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _result(check: str, table: str, passed: Column, measured: Column, expected: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        passed.alias("passed"),
        measured.cast("bigint").alias("measured"),
        expected.cast("bigint").alias("expected"),
    )


def _single(df: DataFrame, check: str, table: str, passed: Column, measured: Column, expected: Column) -> DataFrame:
    return df.select(_result(check, table, passed, measured, expected).alias("r")).select("r.*")


def has_type(df: DataFrame, table: str, types: Mapping[str, str]) -> DataFrame:
    """Columns whose type differs from the wanted one. The schema is known without reading data; the row is
    one row of a constant, so the table is not opened."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    rows = []
    for column, wanted in types.items():
        wrong = int(actual.get(column) != wanted)
        rows.append(_result(f"has_type:{column}", table, F.lit(wrong == 0), F.lit(wrong), F.lit(0)))
    return df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def same_count(table: str, a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of two layers of one table."""
    return _same_count(a.agg(F.count(F.lit(1)).alias("a")).withColumn("b", b.agg(F.count(F.lit(1))).scalar()), table)


def _same_count(both: DataFrame, table: str) -> DataFrame:
    return _single(both, "same_count", table, F.col("a") == F.col("b"), F.col("a"), F.col("b"))


def unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; counted per key with map-side combine, so a hot key is one row."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.count_if(F.col("_rows") > 1).alias("bad"))
    return _single(repeated, f"unique:{'+'.join(keys)}", table, F.col("bad") == 0, F.col("bad"), F.lit(0))


def covers(calendar: DataFrame, fact: DataFrame, table: str, fact_day: str) -> DataFrame:
    """The calendar starts no later and ends no earlier than the fact; measured is the number of ends that stick out."""
    ends = fact.agg(F.struct(F.min(fact_day).alias("first"), F.max(fact_day).alias("last")))
    both = calendar.agg(F.min("date_key").alias("c0"), F.max("date_key").alias("c1")).withColumn("f", ends.scalar())
    out = (F.col("c0") > F.col("f.first")).cast("int") + (F.col("c1") < F.col("f.last")).cast("int")
    out = F.coalesce(out, F.lit(2))
    return _single(both, "covers", table, out == 0, out, F.lit(0))


def no_orphans(fact: DataFrame, dim: DataFrame, table: str, key: str) -> DataFrame:
    """Fact keys without a dimension row. Keys are reduced to distinct values before the anti join."""
    missing = fact.select(key).distinct().join(dim.select(key), key, "left_anti")
    lost = missing.agg(F.count(F.lit(1)).alias("bad"))
    return _single(lost, f"no_orphans:{key}", table, F.col("bad") == 0, F.col("bad"), F.lit(0))


def same_distinct(fact: DataFrame, source: DataFrame, table: str, key: str) -> DataFrame:
    """The fact has exactly one row per distinct key of its source."""
    keys = source.select(key).distinct().agg(F.count(key))
    both = fact.agg(F.count(F.lit(1)).alias("a")).withColumn("b", keys.scalar())
    return _single(both, f"same_distinct:{key}", table, F.col("a") == F.col("b"), F.col("a"), F.col("b"))


def non_decreasing(
    df: DataFrame, table: str, key: str, order: str, column: str, tolerance: str = "0.01"
) -> DataFrame:
    """Runs of a value that a later day of the same key falls below by more than the tolerance; none in a rising series.

    A series that changes seldom is first summed up per key, month and value to its first and last day, where the rows
    are. Only these runs are shuffled; each is compared with the last day of all values below it.
    """
    units = 10_000  # amounts as whole numbers, so that values can be a range of a window
    value = (F.col(column).cast("decimal(34,4)") * units).cast("long")
    dated = df.schema[order].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    month = F.trunc(order, "month") if dated else F.lit(None).cast("date")  # other series have no months
    runs = df.filter(F.col(column).isNotNull()).groupBy(key, month.alias("month"), value.alias("value")).agg(
        F.min(order).alias("first"), F.max(order).alias("last")
    )
    below = W.partitionBy(key).orderBy("value").rangeBetween(W.unboundedPreceding, -int(Decimal(tolerance) * units) - 1)
    falls = runs.withColumn("fallen", F.max("last").over(below)).agg(F.count_if(F.col("fallen") > F.col("first")).alias("bad"))
    return _single(falls, f"non_decreasing:{column}", table, F.col("bad") == 0, F.col("bad"), F.lit(0))


def run_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def row_rules() -> dict[tuple[str, str], list[RowCheck | list[RowCheck]]]:
    """Row checks by layer and table."""
    col = F.col
    net = col("gross_revenue") + col("option_revenue") - col("discount_amount")
    return {
        ("bronze", "order_items"): [not_null("ingestion_timestamp", "ORDER_ID"), null_bound("LINEITEM_ID", 100)],
        ("bronze", "order_item_options"): [not_null("ingestion_timestamp", "ORDER_ID", "LINEITEM_ID")],
        ("bronze", "date_dim"): [not_null("ingestion_timestamp", "date_key")],
        ("silver", "order_items"): [
            not_null("user_id", "line_item_revenue", "item_price", "item_quantity"),
            formula("line_item_revenue", col("item_price") * col("item_quantity"), col("line_item_revenue")),
        ],
        ("silver", "order_item_options"): [
            not_null("option_price", "option_quantity"),
            formula("option_revenue", col("option_price") * col("option_quantity"), col("option_revenue")),
            flag_matches("is_discount", col("option_price") < 0),
        ],
        ("silver", "date_dim"): [not_null("date_key")],
        ("gold", "dim_customer"): [not_null("first_order_date", "last_order_date")],
        ("gold", "fct_order_summary"): [
            formula("net_revenue", net, col("net_revenue")),
            not_null("gross_revenue", "net_revenue", "option_revenue", "discount_amount"),
        ],
        ("gold", "fct_customer_daily_snapshot"): [
            not_null("cumulative_ltv", "days_since_last_order"),
            in_domain("clv_segment", ["High", "Medium", "Low"]),
            in_domain("churn_risk_flag", ["Active", "At Risk", "Churned"]),
        ],
        ("gold", "fct_customer_rfm"): [
            in_range(1, 5, "r_score", "f_score", "m_score"),
            in_domain("rfm_segment", ["VIP", "New Customer", "Churn Risk", "Regular"]),
        ],
    }


def layer_checks(
    table: Callable[[str, str], DataFrame], measured: Mapping[tuple[str, str], Mapping[str, int]] | None = None
) -> DataFrame:
    """All checks of the three layers; ``table(layer, name)`` supplies the frames.

    ``measured`` has, by layer and table, the number of ``rows`` and :func:`measures` of :func:`row_rules` as they were
    observed while the table was written. These tables are then read again only for checks of keys and of several tables.
    """
    measured = measured or {}
    silver = {name: table("silver", name) for name in ("order_items", "order_item_options", "date_dim")}
    items, days = silver["order_items"], silver["date_dim"]
    customers, restaurants, dates = (table("gold", n) for n in ("dim_customer", "dim_restaurant", "dim_date"))
    orders, snapshot, rfm = (
        table("gold", n) for n in ("fct_order_summary", "fct_customer_daily_snapshot", "fct_customer_rfm")
    )
    spark = items.sparkSession

    def known(values: Mapping[str, int]) -> DataFrame:
        return spark.createDataFrame([tuple(values.values())], ", ".join(f"`{c}` bigint" for c in values))

    def rows_of(key: tuple[str, str], rules: list) -> DataFrame:
        named = ".".join(key)
        return verdicts(known(measured[key]), named, *rules) if key in measured else check_rows(table(*key), named, *rules)

    def counts_of(name: str) -> DataFrame:
        a, b = ("silver", name), ("bronze", name)
        if a in measured and b in measured:
            return _same_count(known({"a": measured[a]["rows"], "b": measured[b]["rows"]}), f"silver.{name}")
        return same_count(f"silver.{name}", silver[name], table(*b))

    return run_checks(
        [
            *[rows_of(key, rules) for key, rules in row_rules().items()],
            *[counts_of(name) for name in silver],
            has_type(items, "silver.order_items", {"is_loyalty": "boolean"}),
            has_type(days, "silver.date_dim", {"is_weekend": "boolean", "is_holiday": "boolean"}),
            unique(customers, "gold.dim_customer", ["user_id"]),
            unique(restaurants, "gold.dim_restaurant", ["restaurant_id"]),
            unique(dates, "gold.dim_date", ["date_key"]),
            covers(dates, items, "gold.dim_date", "order_date"),
            unique(orders, "gold.fct_order_summary", ["order_id"]),
            same_distinct(orders, items, "gold.fct_order_summary", "order_id"),
            no_orphans(orders, customers, "gold.fct_order_summary", "user_id"),
            no_orphans(orders, restaurants, "gold.fct_order_summary", "restaurant_id"),
            non_decreasing(snapshot, "gold.fct_customer_daily_snapshot", "user_id", "date_key", "cumulative_ltv"),
            unique(rfm, "gold.fct_customer_rfm", ["user_id"]),
            same_distinct(rfm, customers, "gold.fct_customer_rfm", "user_id"),
        ]
    )
