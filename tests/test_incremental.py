"""Landing scans by blocks, file streams, account activity, months dealt and rolled forward, checks while writing."""

import datetime as dt
import random
import re
import shutil
from collections import Counter
from pathlib import Path

import pytest
import shop
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from tablespoon.operators import accounts as K
from tablespoon.operators import bronze as B
from tablespoon.operators import customer_daily as C
from tablespoon.operators import quality as Q
from tablespoon.operators import silver as S
from tablespoon.plans import failed_checks
from tablespoon.sources import LANDING_SCHEMAS, Layout, load_landing, write_table
from tablespoon.streaming import ingest_landing
from tablespoon.streaming.landing import write_batch

SF = "/root/testdata/sf0.001"
SNAPSHOT = ("gold", "fct_customer_daily_snapshot")


@pytest.fixture(scope="module")
def warehouse(spark):
    return entry.warehouse(spark, SF)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "90")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


# --- quoted csv ----------------------------------------------------------------------------------------------------


def quoted_text(rng, lines):
    out = ["a,b,c"]
    for _ in range(lines):
        row = []
        for _ in range(3):
            kind = rng.random()
            if kind < 0.35:
                row.append("".join(rng.choice("xyz 1é") for _ in range(rng.randrange(6))))
            elif kind < 0.5:
                row.append('in"ch' + rng.choice(["", '"']))
            else:
                parts = ["x", ",", "\n", "\r\n", '\\"', "é", " ", "y"]
                row.append('"' + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) + '"')
        out.append(",".join(row))
        if rng.random() < 0.05:
            out.append("")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_blocks_of_quoted_csv_equal_one_task(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    for name in "ab":
        eol = rng.choice(["\n", "\r\n"])
        (tmp_path / f"{name}.csv").write_text(eol.join(quoted_text(rng, rng.randrange(1, 60))) + rng.choice(["", eol]), newline="")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    plain = spark.read.option("header", "true").option("multiLine", "true").schema(schema).csv(str(tmp_path))
    found = load_landing(spark, str(tmp_path), "csv", schema)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 2


def test_records_longer_than_a_block_and_open_ends(spark, tmp_path, small_blocks):
    long = "\n".join(["line"] * 100)
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{long}"\n2,x\n3,"open\nend')
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])
    assert shop.rows(load_landing(spark, str(tmp_path), "csv", schema)) == [("1", long), ("2", "x"), ("3", "open\nend")]
    (tmp_path / "a.csv").write_text("a,b\n")
    assert load_landing(spark, str(tmp_path), "csv", schema).count() == 0


# --- file stream ---------------------------------------------------------------------------------------------------


def arrivals(spark, tmp_path):
    header = ",".join(LANDING_SCHEMAS["order_item_options"].names)
    layout, source = Layout(str(tmp_path / "lake")), tmp_path / "in"
    source.mkdir()

    def arrive(name, *rows):
        (source / name).write_text("\n".join([header, *rows]) + "\n")

    def run():
        bronze = lambda df: B.bronze_order_item_options(df, "now")
        return ingest_landing(spark, str(source), layout, "order_item_options", bronze, checkpoint=str(tmp_path / "progress"))

    return layout, arrive, run


def test_arrivals_and_a_replay_equal_one_batch(spark, tmp_path):
    layout, arrive, run = arrivals(spark, tmp_path)
    arrive("1.csv", '1,l1,"Size\nbig",L,1.00,1', "2,l1,g,o,2.00,1")
    assert run().count() == 2
    arrive("2.csv", "3,l1,g,o,3.00,1")
    assert shop.rows(run().select("ORDER_ID", "ingest_batch")) == [("1", 0), ("2", 0), ("3", 1)]
    assert run().count() == 3  # nothing new
    last = tmp_path / "progress" / "commits" / "1"
    shutil.copy(last, tmp_path / "kept")
    for path in (last, last.with_name(".1.crc")):
        Path(path).unlink(missing_ok=True)  # as if the driver was lost before the batch was known to be done
    assert shop.rows(run().select("ORDER_ID", "OPTION_GROUP_NAME")) == [("1", "Size\nbig"), ("2", "g"), ("3", "g")]


def test_a_batch_written_twice_is_there_once(spark, tmp_path):
    layout, arrive, _ = arrivals(spark, tmp_path)
    arrive("1.csv", "1,l1,g,o,1.00,1")
    files = spark.createDataFrame([(str(tmp_path / "in" / "1.csv"),)] * 2, "path string")
    path = layout.path("bronze", "order_item_options")
    for _ in range(2):
        write_batch(files, 7, lambda df: df, path, "csv", LANDING_SCHEMAS["order_item_options"])
    assert spark.read.parquet(path).count() == 1


# --- accounts ------------------------------------------------------------------------------------------------------


def plain_activity(lines):
    orders, places = {}, {}
    for order, _, _, place, day, stamp, user, *_ in lines:
        t, d = orders.setdefault(user, {}).get(order, (stamp, day))
        orders[user][order] = (min(t, stamp), min(d, day))
        places.setdefault(user, set()).add(place)
    out = []
    for user, own in orders.items():
        times = sorted(t for t, _ in own.values())
        gaps = [(b - a).total_seconds() for a, b in zip(times, times[1:])]
        quick = sum(g <= 300 for g in gaps)
        most = max(Counter(d for _, d in own.values()).values())
        out.append((user, len(own), len(gaps), quick, quick / len(gaps) if gaps else 0.0, most, len(places[user])))
    return sorted(out)


@pytest.mark.parametrize("seconds", [60, 3600, 10**7])
def test_activity_equals_plain_gaps_in_any_ranges(spark, seconds):
    rng = random.Random(seconds)
    lines = []
    for i in range(400):
        user = rng.choice(["GUEST", "GUEST", "a", "b", "c"])
        stamp = dt.datetime(2023, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=rng.randrange(0, 200_000, 50))
        lines.append(shop.line(f"o{i // 2}{user}", f"l{i}", user, str(stamp.date()), place=f"r{rng.randrange(9)}", time=f"{stamp:%H:%M:%S}"))
    found = K.account_activity(shop.items(spark, *lines), range_seconds=seconds)
    assert shop.rows(found) == plain_activity(lines)
    names = K.rapid_accounts(found, least_orders=5, quick_share=0.0, locations=2)
    assert shop.rows(names) == [("a",), ("b",), ("c",)]
    assert {r.user_id for r in S.exclude_users(shop.items(spark, *lines), names).select("user_id").distinct().collect()} == {"GUEST"}


# --- snapshot ------------------------------------------------------------------------------------------------------


def test_snapshot_rows_are_dealt_while_sparse(warehouse):
    orders = warehouse.gold("fct_order_summary")
    dense = C.fct_customer_daily_snapshot(warehouse.gold("dim_customer"), warehouse.gold("dim_date"), orders, by_month=True, rows_per_task=20_000)
    plan = dense._jdf.queryExecution().executedPlan().toString()
    unfolds = [line for line in plan.splitlines() if re.search(r"Generate explode\(CASE WHEN \(valid_from", line)]
    assert len(unfolds) == 2 and "[date_key#" in unfolds[0]  # to days last, after months were cut and dealt
    above = plan[: plan.index(unfolds[0])]
    assert "BroadcastHashJoin" in above and not re.search(r"Exchange (hash|range|rebalance|Round)|ShuffleExchange|\bSort\b", above)


def test_month_files_hold_what_the_plain_snapshot_has(spark, warehouse, tmp_path):
    inputs = [warehouse.gold(t) for t in ("dim_customer", "dim_date", "fct_order_summary")]
    layout = Layout(str(tmp_path))
    write_table(C.fct_customer_daily_snapshot(*inputs, by_month=True, rows_per_task=5000), layout, *SNAPSHOT, ["date_key_month"])
    stored = spark.read.parquet(layout.path(*SNAPSHOT))
    assert stored.filter("date_format(date_key, 'yyyy-MM') <> date_key_month").count() == 0
    plain = C.fct_customer_daily_snapshot(*inputs)
    columns = [F.col(c) for c in plain.columns]
    digest = lambda df: df.select(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))).first()
    assert digest(stored) == digest(plain)
    files = len(list(Path(layout.path(*SNAPSHOT)).rglob("*.parquet")))
    months, tasks = stored.select("date_key_month").distinct().count(), -(-stored.count() // 5000)
    assert files <= months + tasks


def test_last_day_opens_one_month(warehouse):
    latest = C.latest_date(warehouse.with_months(*SNAPSHOT))
    plan = latest._jdf.queryExecution().executedPlan()
    latest.collect()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan.toString())
    assert any("date_key_month" in s and "subquery" not in s for s in scans)
    last = warehouse.gold("dim_date").agg(F.max("date_key")).first()[0]
    assert latest.first().date_key == last


# --- checks --------------------------------------------------------------------------------------------------------


def series(spark, **values):
    rows = [(k, dt.date(2023, 1, 1) + dt.timedelta(days=i), shop.money(v)) for k, own in values.items() for i, v in enumerate(own) if v is not None]
    return spark.createDataFrame(rows, "user_id string, date_key date, v decimal(18,2)")


def test_falls_are_found_inside_and_across_months(spark):
    check = lambda **v: Q.non_decreasing(series(spark, **v), "t", "user_id", "date_key", "v").first()
    assert check(a=[1, 1, 2, 2, 3], b=[0, None, 5]).passed
    assert not check(a=[1, 5, 5, 3, 5, 5]).passed  # inside a month, and back again
    assert not check(a=[9] * 31 + [8] * 3).passed  # at the end of a month
    assert check(a=[5, 4.99, 5]).passed and not check(a=[5, 4.98, 5]).passed
    assert check(a=[9], b=[1]).passed and check().passed


def test_rising_check_shuffles_runs_only(spark):
    df = series(spark, a=[1] * 40)
    plan = Q.non_decreasing(df, "t", "user_id", "date_key", "v")._jdf.queryExecution().executedPlan().toString()
    first = plan.splitlines()[max(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning" in line) + 1]
    assert "HashAggregate" in first and "partial_min" in first


def test_checks_from_the_write_equal_checks_by_scan(warehouse):
    for name in ("order_items", "order_item_options", "date_dim"):
        warehouse.silver(name)
    scanned, measured = Q.layer_checks(warehouse.table), Q.layer_checks(warehouse.table, warehouse.measured)
    assert shop.rows(measured) == shop.rows(scanned)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(scanned) - scans(measured) >= len(Q.row_rules())
    assert failed_checks(warehouse) == []
    assert failed_checks(warehouse, by_design=()) == [("silver.order_items", "same_count")]


def test_silver_lines_keep_the_folders_of_bronze(warehouse, tmp_path):
    """A table of the same month folders is not dealt anew, and nothing is sorted for a few folders."""
    lines = warehouse.silver("order_items")
    assert warehouse._in_place("silver", "order_items") and not warehouse._in_place("bronze", "order_items")
    layout = Layout(str(tmp_path))
    write_table(lines, layout, "silver", "order_items", ["order_date_partition_month"], in_place=True)
    again = lines.sparkSession.read.parquet(layout.path("silver", "order_items"))
    assert shop.rows(again, *lines.columns) == shop.rows(lines)
    month = F.substring("order_date_partition", 1, 7)
    assert again.filter(F.col("order_date_partition_month") != month).count() == 0


def test_rows_of_the_snapshot_are_known_without_observing_them(warehouse):
    snapshot = warehouse.gold("fct_customer_daily_snapshot")
    assert SNAPSHOT not in warehouse.measured
    assert warehouse.rows_written[SNAPSHOT] == snapshot.agg(F.count_if(F.col("date_key").isNotNull())).first()[0]


def test_digest_reads_every_value_as_text(spark):
    """Zero, negative and missing amounts, days that the calendar has and lacks, customers without a name."""
    money, d = shop.money, dt.date(2023, 1, 1)
    rows = [
        ("a", d, True, 0, money(0), money(-1), None, 0, money(0), None, None, "Low", "Churned"),
        ("a", d + dt.timedelta(days=9), None, 2, money(1), money("0.01"), money(0), 2, money("12.30"), 0, money(0), "High", None),
        (None, None, False, 1, money(5), money(5), money("-0.00"), 1, money(5), 3, money("1.50"), None, "Active"),
    ]
    schema = ("user_id string, date_key date, is_loyalty boolean, daily_order_count bigint, daily_gross_revenue decimal(18,2),"
              " daily_net_revenue decimal(18,2), daily_discount_amount decimal(18,2), cumulative_order_count int,"
              " cumulative_ltv decimal(18,2), days_since_last_order int, avg_order_gap_days decimal(10,2),"
              " clv_segment string, churn_risk_flag string")  # fmt: skip
    df = spark.createDataFrame(rows, schema)
    plain = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in entry.X.SNAPSHOT_TEXT))
    number = F.conv(F.substring(F.md5(plain.cast("binary")), 1, 8), 16, 10).cast("bigint")
    wanted = df.groupBy("user_id").agg(F.count(F.lit(1)).alias("days"), F.sum(number).alias("digest"))
    assert shop.rows(entry._digest(df, shop.dates(spark, "2023-01-01", "2023-01-03"))) == shop.rows(wanted)
