import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablespoon.functions.selection import (
    global_ntile,
    log_bucket,
    order_statistics,
    percentiles,
    rank_of_fraction,
    reaches,
    thresholds,
)


def frame(spark, n, distinct, seed, nulls=False):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        value = None if nulls and rnd.random() < 0.2 else Decimal(rnd.randrange(distinct)) / 4 - 3
        data.append((f"k{rnd.randrange(10**9)}-{i}", rnd.choice("ab"), value, rnd.randrange(3)))
    return spark.createDataFrame(data, "k string, g string, v decimal(18,2), w int")


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 1000])
@pytest.mark.parametrize("nulls", [False, True])
def test_ntile_equals_the_window_function(spark, n, nulls):
    df = frame(spark, n, 40, n, nulls)
    found = global_ntile(df, "k", {"tv": "v", "tw": "w"}, tiles=5, buckets=8, sample_rows=100)
    for column, tile in (("v", "tv"), ("w", "tw")):
        window = F.ntile(5).over(W.orderBy(F.col(column).asc_nulls_first(), "k"))
        assert sorted(found.select("k", tile).collect()) == sorted(df.select("k", window).collect())


def test_ntile_of_one_value_shared_by_all_is_spread_over_the_key(spark):
    df = spark.range(20000).select(F.concat(F.lit("it's \\"), F.lpad("id", 6, "0")).alias("k"), F.lit(1).alias("v"))
    found = global_ntile(df, "k", {"t": "v"}, sample_rows=500)
    assert sorted(found.groupBy("t").agg(F.count("*"), F.min("k")).collect()) == [
        (t, 4000, f"it's \\{(t - 1) * 4000:06d}") for t in range(1, 6)
    ]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [2, 6, 11, 300])
@pytest.mark.parametrize("distinct", [1, 3, 10_000])
def test_reaching_a_fraction_equals_percent_rank(spark, n, distinct):
    df = frame(spark, n, distinct, n * 31 + distinct)
    fractions = ("0", "0.2", "0.5", "0.8", "1")
    ranks = {f"f{i}": rank_of_fraction(f) for i, f in enumerate(fractions)}
    stats = thresholds(order_statistics(df, ["g"], "v", ranks), ["g"], ranks)
    size = F.count("*").over(W.partitionBy("g"))
    joined = df.join(stats, "g").withColumn("n", size).withColumn("p", F.percent_rank().over(W.partitionBy("g").orderBy("v")))
    for i, f in enumerate(fractions):
        reached = F.coalesce(reaches(F.col("v"), f"f{i}"), F.lit(False))
        wrong = joined.filter((reached != (F.col("p") >= float(f))) & (F.col("n") > 1)).count()
        assert wrong == 0


def brute_percentile(values, q):
    values = sorted(values)
    position = q * (len(values) - 1)
    low = int(position)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * Decimal((position - low).numerator) / Decimal(
        (position - low).denominator
    )


@pytest.mark.parametrize("n", [1, 2, 777])
def test_percentiles_are_exact(spark, n):
    df = frame(spark, n, 5000, n, nulls=n > 3)
    wanted = {"q1": "0.25", "q2": "0.5", "cap": "0.95"}
    values = [r.v for r in df.collect() if r.v is not None]
    row = percentiles(df, [], "v", wanted).first()
    assert row.n == len(values)
    for name, text in wanted.items():
        assert row[name] == brute_percentile(values, Fraction(text)).quantize(Decimal("0.0001"))
    for row in percentiles(df, ["g"], "v", wanted).collect():
        group = [r.v for r in df.collect() if r.v is not None and r.g == row.g]
        assert row.q2 == brute_percentile(group, Fraction(1, 2)).quantize(Decimal("0.0001"))


def test_bucket_keeps_order_and_is_narrow(spark):
    values = sorted({-(10**9), -5, -1, 0, 1, 2, 3} | {int(1.01**k) for k in range(0, 2500, 3)})
    found = [r.b for r in spark.createDataFrame([(Decimal(v),) for v in values], "v decimal(18,2)").orderBy("v").select(
        log_bucket(F.col("v")).alias("b")).collect()]
    assert found == sorted(found)
    assert len(set(found)) > 200


def test_a_group_is_counted_before_it_is_shuffled(spark):
    plan = order_statistics(frame(spark, 50, 9, 1), ["g"], "v", {"x": rank_of_fraction("0.5")})
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text and "percent_rank" not in text


def test_ntile_cuts_large_buckets_again(spark):
    rows = [(f"k{i:05d}", None if i % 50 == 0 else i * 7919 % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "user_id string, v int")
    found = global_ntile(df, "user_id", {"tile": "v"}, buckets=3, sample_rows=40, rows_per_task=60)
    wanted = df.withColumn("tile", F.ntile(5).over(W.orderBy(F.col("v").asc_nulls_first(), "user_id")))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)
