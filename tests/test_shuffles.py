"""Plans and rows of the steps that take most of the shuffled volume."""

import random
import re
from collections import Counter

import pytest
import shop
from pyspark.sql import types as T

from tablespoon.operators import daily_sales as A
from tablespoon.operators import order_summary as O
from tablespoon.sources import landing, load_landing


def exchanges(df):
    """Shuffles of the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|rebalance|RoundRobin)", plan)


def test_orders_are_shuffled_without_a_row_per_category(spark):
    items = shop.items(
        spark, shop.line("o1", "l1", category="Soup", price=2, time="12:00:00", place="r2"),
        shop.line("o1", "l2", category="Soup", price=3, time="11:00:00", place="r1", user="u2"),
        shop.line("o1", "l3", category=None, price=4, time="11:00:00", place="r0", user="u3"),
        shop.line("o1", None, category="Tea", price=5, time="13:00:00"),
        shop.line(None, "l4", category=None, price=6), shop.line(None, "l4", category=None, price=6),
    ).repartition(3)
    found = O.order_items_agg(items.localCheckpoint())
    assert all("item_category" not in e for e in exchanges(found))
    assert shop.rows(found, "order_id", "user_id", "restaurant_id", "total_items", "gross_revenue", "distinct_categories") == [
        ("o1", "u2", "r1", 4, shop.money(14), 2), (None, "u1", "r00001", 2, shop.money(12), 0)
    ]


def test_lines_and_options_meet_in_one_shuffle(spark):
    items = shop.items(
        spark, shop.line("o1", "l1", price=10), shop.line("o1", "l1", price=20), shop.line("o1", None, price=30),
        shop.line(None, "l1", price=40), shop.line("o2", "l1", price=50, category="Tea"),
    )
    options = shop.options(
        spark, shop.option("o1", "l1", 2), shop.option("o1", "l1", -1), shop.option("o1", None, 7), shop.option(None, "l1", 8),
        shop.option("o2", "l9", 9), shop.option("o2", "l1", None),
    )
    lines = A.enrich_lines(items.localCheckpoint(), options.localCheckpoint())
    money = shop.money
    assert lines.columns == [*items.columns, "option_revenue", "discount_amount", "discounted", "line_net_revenue"]
    assert shop.rows(lines, "line_item_revenue", "option_revenue", "discount_amount", "discounted", "line_net_revenue") == sorted([
        (money(10), money(2), money(1), 1, money(11)), (money(20), money(2), money(1), 1, money(21)),
        (money(30), money(0), money(0), 0, money(30)), (money(40), money(0), money(0), 0, money(40)),
        (money(50), money(0), money(0), 0, money(50)),
    ], key=repr)
    totals = A.with_order_discount(A.order_category_totals(lines))
    assert len(exchanges(totals)) == 1
    assert len(exchanges(A.daily_sales(totals))) == 2


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_quoted_csv_is_put_in_order_in_pieces_of_a_block(spark, tmp_path, monkeypatch, bits):
    """Records, open fields and headers of files in one block each, cut into pieces of one to eight lines."""
    monkeypatch.setattr(landing, "PIECE_BITS", bits)
    rng = random.Random(bits)
    for name in "abc":
        rows = [f'{i},"{rng.choice(["x", "x,y", "x" + chr(10) * rng.randrange(1, 20) + "y"])}"' if rng.random() < 0.5 else f"{i},z" for i in range(40)]
        (tmp_path / f"{name}.csv").write_text("\n".join(["a,b", *rows]))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])
    plain = spark.read.option("header", "true").option("multiLine", "true").schema(schema).csv(str(tmp_path))
    assert Counter(map(tuple, load_landing(spark, str(tmp_path), "csv", schema).collect())) == Counter(map(tuple, plain.collect()))
