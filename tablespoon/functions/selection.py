"""Exact order statistics and quantile scores without gathering a group in one task.

``percentile``, ``percent_rank`` and ``ntile`` bring a whole window group into one task. Here a group is first
counted by coarse value buckets (combined before the shuffle, so it stays small whatever the row count or skew),
the counts tell which bucket holds a wanted rank, and only that bucket is looked at exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin

BUCKETS_PER_E_FOLD = 32


def log_bucket(value: Column, per_e_fold: int = BUCKETS_PER_E_FOLD) -> Column:
    """Order-preserving bucket, about 3 % of the value wide by default. A bucket of cent amounts near ``v`` therefore holds
    about ``3 v`` distinct values (3 % of 100 v) at most, however many rows there are, and amounts up to a
    billion need fewer than 700 buckets."""
    x = value.cast("double")
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * per_e_fold).cast("int")


def rank_of_fraction(fraction: str | float) -> Callable[[Column], Column]:
    """Smallest 0-based rank k with k / (n - 1) >= fraction, in whole numbers; NULL for fewer than two rows."""
    q = Fraction(str(fraction))

    def rank(n: Column) -> Column:
        scaled = F.lit(q.numerator).cast("bigint") * (n - 1) + (q.denominator - 1)
        return F.when(n > 1, F.floor((scaled - scaled % q.denominator) / q.denominator).cast("bigint"))

    return rank


def order_statistics(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    ranks: Mapping[str, Callable[[Column], Column]],
    bucket: str | None = None,
    counted: DataFrame | None = None,
    rows_in: Callable[[DataFrame], DataFrame] | None = None,
    few_groups: bool = True,
) -> DataFrame:
    """For each group of ``by``: ``n`` and, for each name in ``ranks``, a struct (value, below).

    ``ranks[name](n)`` is the wanted 0-based rank among the group's non-NULL values in ascending order; ``value``
    is the value there and ``below`` the number of rows strictly smaller. NULL where the rank does not exist.
    With ``few_groups``, ``by`` is a closed small domain such as calendar days or labels, and one row per group and rank is
    broadcast; without, Spark chooses how these rows meet the others.
    ``bucket`` names a column that already holds :func:`log_bucket` of the value, of any fineness.

    Where the rows of ``df`` are costly to make, ``counted`` has their number by group and bucket (``by``, ``_b``, ``_c``),
    and ``rows_in`` makes the rows of the wanted buckets only (others may come along), given these as ``_wb`` with the groups
    (``_by_`` and the name) that want them.
    """
    by = list(by)
    coarse = F.col(bucket) if bucket else log_bucket(F.col(value))

    def plain(frame: DataFrame) -> DataFrame:
        return frame.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), coarse.alias("_b"))

    group = W.partitionBy(*[F.col(c) for c in by]) if by else W.partitionBy(F.lit(0))
    before = group.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    counts = plain(df).groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c")) if counted is None else counted
    counts = counts.withColumns(
        {
            "n": F.sum("_c").over(group),
            "_below": F.coalesce(F.sum("_c").over(before), F.lit(0)),
        }
    )
    wanted = counts.select(
        *by,
        "_b",
        "_c",
        "n",
        "_below",
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).alias("rank")) for name, rank in ranks.items()])
        ).alias("_w"),
    ).filter((F.col("_w.rank") >= F.col("_below")) & (F.col("_w.rank") < F.col("_below") + F.col("_c")))
    wanted = wanted.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_b").alias("_wb"),
        "n",
        F.col("_below").alias("_offset"),
        F.col("_w.name").alias("_name"),
        F.col("_w.rank").alias("_rank"),
    )

    rows = plain(rows_in(wanted.select("_wb", *(f"_by_{c}" for c in by)).distinct()) if rows_in else df)
    match = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], F.col("_b") == F.col("_wb")
    )
    fine = (
        rows.join(F.broadcast(wanted) if few_groups else wanted, match)
        .groupBy(*by, "n", "_name", "_rank", "_offset", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    inside = W.partitionBy(*by, "_name").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    fine = fine.withColumn("_less", F.col("_offset") + F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    found = fine.filter((F.col("_rank") >= F.col("_less")) & (F.col("_rank") < F.col("_less") + F.col("_c")))
    return found.groupBy(*by).agg(
        F.max("n").alias("n"),
        *[
            F.max(
                F.when(F.col("_name") == name, F.struct(F.col("_v").alias("value"), F.col("_less").alias("below")))
            ).alias(name)
            for name in ranks
        ],
    )


def thresholds(stats: DataFrame, by: Sequence[str], ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Per group and name of :func:`order_statistics`: ``<name>_value``, and ``<name>_included`` telling whether rows
    equal to it reach the rank, that is whether their run starts there."""
    return stats.select(
        *by,
        *[F.col(name)["value"].alias(f"{name}_value") for name in ranks],
        *[(F.col(name)["below"] >= rank(F.col("n"))).alias(f"{name}_included") for name, rank in ranks.items()],
    )


def reaches(value: Column, name: str) -> Column:
    """True where percent_rank of ``value`` is at least the fraction behind the threshold ``name``."""
    threshold = F.col(f"{name}_value")
    return (value > threshold) | ((value == threshold) & F.col(f"{name}_included"))


def percentiles(df: DataFrame, by: Sequence[str], value: str, fractions: Mapping[str, str]) -> DataFrame:
    """Exact percentiles with linear interpolation between neighbours, as DECIMAL(18,4), per group of ``by``."""
    exact = {name: Fraction(text) for name, text in fractions.items()}

    def split(q: Fraction, n: Column) -> tuple[Column, Column]:
        position = F.lit(q.numerator).cast("bigint") * (n - 1)
        rest = position % q.denominator
        return F.floor((position - rest) / q.denominator).cast("bigint"), rest

    ranks: dict[str, Callable[[Column], Column]] = {}
    for name, q in exact.items():
        ranks[f"{name}_lo"] = lambda n, q=q: split(q, n)[0]
        ranks[f"{name}_hi"] = lambda n, q=q: F.least(split(q, n)[0] + 1, n - 1)
    stats = order_statistics(df, by, value, ranks)

    def interpolate(name: str, q: Fraction) -> Column:
        low = F.col(f"{name}_lo")["value"].cast("decimal(18,2)")
        high = F.col(f"{name}_hi")["value"].cast("decimal(18,2)")
        rest = split(q, F.col("n"))[1].cast("decimal(9,0)")
        return (low + (high - low) * rest / F.lit(q.denominator).cast("decimal(9,0)")).cast("decimal(18,4)").alias(name)

    return stats.select(*by, "n", *[interpolate(name, q) for name, q in exact.items()])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _CompositeOrder:
    """Comparison of (value, key) with fixed cut points, NULL values first.

    The conditions are SQL text: a tree of cut points parses in one call, while building it from Column
    objects would take thousands of calls into the JVM.
    """

    def __init__(self, value: str, value_type: str, key: str):
        self.value, self.type, self.key = f"`{value}`", value_type, f"`{key}`"

    def at_or_after(self, bound: object, bound_key: str) -> str:
        key_test = f"{self.key} >= {_quoted(bound_key)}"
        if bound is None:
            return f"({self.value} IS NOT NULL OR {key_test})"
        cut = f"CAST({_quoted(str(bound))} AS {self.type})"
        return f"coalesce({self.value} > {cut} OR ({self.value} = {cut} AND {key_test}), false)"

    def bucket(self, cuts: list[tuple[object, str]], first: int = 0) -> str:
        """Number of cuts at or before the row, by halving."""
        if not cuts:
            return str(first)
        middle = len(cuts) // 2
        upper = self.bucket(cuts[middle + 1 :], first + middle + 1)
        lower = self.bucket(cuts[:middle], first)
        return f"CASE WHEN {self.at_or_after(*cuts[middle])} THEN {upper} ELSE {lower} END"

    def tile(self, opening_rows: list[tuple[object, str]]) -> str:
        """1 + number of tile-opening rows at or before the row."""
        return " + ".join(["1", *[f"CAST({self.at_or_after(*row)} AS INT)" for row in opening_rows]])


def _sort_key(row: tuple[object, str]) -> tuple:
    value, key = row
    return (0, key) if value is None else (1, value, key)


def global_ntile(
    df: DataFrame,
    key: str,
    columns: Mapping[str, str],
    tiles: int = 5,
    buckets: int = 64,
    sample_rows: int = 4096,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Add ``ntile(tiles)`` over the whole table for several columns; ``columns`` maps score name to value column.

    Order is value ascending with NULLs first, then ``key``, which must be unique. ``ntile`` over an unpartitioned
    window would sort everything in one task. Here a sample of about ``sample_rows`` rows gives cut points on
    (value, key), so even one value shared by every row is spread evenly; the cuts only balance the work and do
    not touch the result. Counting the buckets shows which few buckets hold the first row of a tile. Such a bucket is
    cut again until it has at most ``rows_per_task`` rows, however large the table; only then is it ordered, and the
    tile-opening rows found there become constants of one projection: the table itself is
    never shuffled. These passes run as jobs while the plan is built, also for a caller that only wants to see it.
    The driver sees the sample, ``buckets`` counts per column and ``tiles - 1`` rows per column.
    """
    df = pin(df)
    total = df.count()
    if total == 0:
        return df.withColumns({score: F.lit(None).cast("int") for score in columns})
    values = list(dict.fromkeys(columns.values()))
    picked = df.select(key, *values)
    if total > sample_rows:
        picked = picked.sample(fraction=sample_rows / total, seed=42)
    sample = picked.collect()

    k = F.col(key)
    order = {s: _CompositeOrder(c, df.schema[c].dataType.simpleString(), key) for s, c in columns.items()}
    bucket_of: dict[str, Column] = {}
    for score, column in columns.items():
        points = sorted({(row[column], row[key]) for row in sample}, key=_sort_key)
        step = max(1, len(points) // buckets)
        bucket_of[score] = F.expr(order[score].bucket(points[step::step]))

    sizes: dict[str, dict[int, int]] = {score: {} for score in columns}
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), b.alias("b")) for s, b in bucket_of.items()]))
    for row in df.select(pairs.alias("p")).groupBy("p.s", "p.b").count().collect():
        sizes[row["s"]][row["b"]] = row["count"]

    quotient, remainder = divmod(total, tiles)
    starts = {j * quotient + min(j, remainder) for j in range(1, tiles)}
    candidates = []
    for score, column in columns.items():
        wanted, seen = [], 0
        for bucket in sorted(sizes[score]):
            size = sizes[score][bucket]
            wanted += [(bucket, start - seen + 1) for start in starts if seen <= start < seen + size]
            seen += size
        rows = df.select(k, F.col(column), bucket_of[score].alias("_b"))
        for found in _rows_at(rows, wanted, sizes[score], order[score], column, key, buckets, sample_rows, rows_per_task):
            candidates.append(
                found.select(F.lit(score).alias("score"), k.alias("key"), F.col(column).cast("string").alias("value"))
            )
    opening_rows: dict[str, list[tuple[object, str]]] = {score: [] for score in columns}
    for row in reduce(DataFrame.unionByName, candidates).collect() if candidates else []:
        opening_rows[row["score"]].append((row["value"], row["key"]))
    return df.withColumns({score: F.expr(order[score].tile(opening_rows[score])) for score in columns})


def _rows_at(
    rows: DataFrame,
    wanted: list[tuple[int, int]],
    sizes: Mapping[int, int],
    order: _CompositeOrder,
    column: str,
    key: str,
    buckets: int,
    sample_rows: int,
    rows_per_task: int,
) -> list[DataFrame]:
    """The rows at ``wanted`` places (bucket ``_b``, place from 1); no more than ``rows_per_task`` rows are ordered at once."""
    out = []
    small = [(b, place) for b, place in wanted if sizes[b] <= rows_per_task]
    if small:
        in_order = W.partitionBy("_b").orderBy(F.col(column).asc_nulls_first(), F.col(key))
        at = reduce(lambda x, y: x | y, [(F.col("_b") == b) & (F.col("_rn") == place) for b, place in small])
        some = rows.filter(F.col("_b").isin(sorted({b for b, _ in small})))
        out.append(some.withColumn("_rn", F.row_number().over(in_order)).filter(at))
    for large in sorted({b for b, _ in wanted if sizes[b] > rows_per_task}):
        inside = rows.filter(F.col("_b") == large).drop("_b")
        picked = inside.sample(fraction=min(1.0, sample_rows / sizes[large]), seed=large).collect()
        points = sorted({(row[column], row[key]) for row in picked}, key=_sort_key)
        cuts = points[max(1, len(points) // buckets) :: max(1, len(points) // buckets)]
        inside = inside.withColumn("_b", F.expr(order.bucket(cuts)))
        counts = {row["_b"]: row["count"] for row in inside.groupBy("_b").count().collect()}
        limit = rows_per_task if len(counts) > 1 else sizes[large]  # a sample without a second row cuts nothing
        below, nested = 0, []
        for b in sorted(counts):
            nested += [(b, place - below) for x, place in wanted if x == large and below < place <= below + counts[b]]
            below += counts[b]
        out += _rows_at(inside, nested, counts, order, column, key, buckets, sample_rows, limit)
    return out
