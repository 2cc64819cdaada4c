"""Mixing sources to target weights by entropy balancing.

Among all document rates between 0 and ``cap`` that give every source its target of words, the rates of least relative
entropy to 1 are wanted. They are ``min(cap, exp(a * size / mean size))`` with one dual variable ``a`` per source, found
by Newton iterations in Spark over a table of (source, size, number of documents). Rates are then rounded to whole copies:
going from long to short documents, the rounding error of one size is carried to the next, so the words of a source end
within about its shortest document of the target. Which documents of a size get the extra copy is decided by their hash,
and among rows of one hash, as repeated rows are, by their row number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespoon.session import stored

WEIGHTS = (5, 2, 1)  # of the sources in code point order, repeating
SHARE = 1.5  # of all words
CAP = 2.0  # copies of a document, and words of a source as a multiple
ROUNDS = 200  # halving alone would need about 60; a source that is open after these is an error
TOLERANCE = 1e-5  # of a target, or of a word
_DIGIT = 16  # bits of a number by which a cut is narrowed down at once
_EXACT = "decimal(38,6)"  # sums that do not depend on the order of rows


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(cells: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) by water filling: ``share`` of all words by weight, none above ``cap`` times its size.

    ``cells`` has (source, size, n). Works on one row per source; a source is full where its size per weight is below
    the level at which the others take up the rest.
    """
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(named) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("double")
    everything = Window.partitionBy()
    ordered = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rows = sizes.withColumn("weight", weight).withColumn("ratio", F.col("source_size") * cap / F.col("weight"))
    before = F.coalesce(F.sum("source_size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    level = (total * share - before * cap) / rest
    rows = rows.withColumn("level", level)
    reached = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)
    target = F.least(F.col("source_size") * cap, F.coalesce(reached["level"] * F.col("weight"), F.col("source_size") * cap))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def balanced_rates(cells: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, a, mean): the dual solution of every source; ``a`` is null where all rates are ``cap``.

    Each round sums gradient and curvature per source, takes the Newton step, or halves the bracket where the step
    leaves it. Sums are exact decimals, so reruns agree. Ends when every source is within ``TOLERANCE`` of its target, or its
    bracket is as narrow as a double can tell.
    """
    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    moments = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).cast("double").alias("total"),
        F.sum("n").cast("double").alias("docs"),
        F.sum((F.col("size") * F.col("size")).cast("decimal(38,0)") * F.col("n")).cast("double").alias("square"),
    )
    start = targets.alias("t").join(moments.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source"))).select(
        "t.source",
        F.when((F.col("total") > 0) & (F.col("target") < F.col("total") * cap * (1 - 1e-9)), F.col("target")).alias("target"),
        (F.col("total") / F.col("docs")).alias("mean"),
        # the step that a source of equal sizes would need; one without words has none, and its sums are no divisors
        F.when(
            F.col("total") > 0,
            F.log(F.col("target") / F.col("total")) * F.col("total") / F.col("docs") * F.col("total") / F.col("square"),
        ).alias("a"),
        F.lit(float("-inf")).alias("low"),
        F.lit(float("inf")).alias("high"),
    )
    # one row per source, rewritten each round as one file
    state = stored(start.withColumn("open", F.col("target").isNotNull()).coalesce(1), "dual")
    for done in range(ROUNDS + 1):
        if state.where("open").isEmpty():
            break
        if done == ROUNDS:
            raise RuntimeError(f"no dual solution after {ROUNDS} rounds")
        x = F.col("c.size") / F.col("s.mean")
        rate = F.exp(F.least(F.col("s.a") * x, F.lit(700.0)))
        words = F.col("c.size") * F.col("c.n")
        sums = (
            cells.alias("c").join(state.where("open").alias("s"), same).groupBy("s.source").agg(
                F.sum((words * F.least(rate, F.lit(cap))).cast(_EXACT)).cast("double").alias("taken"),
                F.sum(F.when(rate < cap, words * x * rate).otherwise(0.0).cast(_EXACT)).cast("double").alias("slope"),
            )
        )
        joined = state.alias("s").join(sums.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")), "left")
        gap = F.col("g.taken") - F.col("s.target")
        low = F.when(gap < 0, F.col("s.a")).otherwise(F.col("s.low"))
        high = F.when(gap > 0, F.col("s.a")).otherwise(F.col("s.high"))
        moved = joined.select(
            "s.source", "s.target", "s.mean", "s.a", low.alias("low"), high.alias("high"),
            (F.col("s.a") - gap / F.when(F.col("g.slope") > 0, F.col("g.slope"))).alias("step"),
            (F.col("s.open") & (F.abs(gap) > F.greatest("s.target", F.lit(1.0)) * TOLERANCE) & (high - low > 1e-13)).alias("open"),
        )
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        wider = F.when(F.col("high") == float("inf"), F.col("low") + F.abs("low") + 1).when(
            F.col("low") == float("-inf"), F.col("high") - F.abs("high") - 1
        ).otherwise((F.col("low") + F.col("high")) / 2)
        following = F.when(F.col("open"), F.when(inside, F.col("step")).otherwise(wider)).otherwise(F.col("a"))
        state = stored(moved.select("source", "target", "mean", following.alias("a"), "low", "high", "open").coalesce(1), "dual")
    return state.select("source", F.when(F.col("target").isNotNull(), F.round("a", 9)).alias("a"), "mean")


def _whole_copies(cap: float):
    def run(cells: pa.Table) -> pa.Table:
        """One source's sizes, at most as many rows as there are different sizes."""
        cells = cells.sort_by([("size", "descending")])
        size, n, rate = (cells[c].to_numpy().astype(float) for c in ("size", "n", "rate"))
        low = np.minimum(np.floor(rate), np.floor(cap))
        extra, carry = np.zeros(len(cells), dtype=np.int64), 0.0
        for i in range(len(cells)):
            if size[i] > 0:
                want = n[i] * (rate[i] - low[i]) * size[i] + carry
                room = n[i] if low[i] < np.floor(cap) else 0
                extra[i] = int(min(max(np.floor(want / size[i] + 0.5), 0), room))
                carry = want - extra[i] * size[i]
        made = [pa.array(low.astype(np.int64)), pa.array(extra)]
        return pa.Table.from_arrays([*(cells[c] for c in ("source", "size", "n")), *made], ["source", "size", "n", "low", "extra"])

    return run


def copy_plan(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """(targets, plan) for ``documents`` with (source, size, hash, row).

    The plan has one row per source and size: every document gets ``low`` copies, and one more if its hash is below ``cut``,
    or is ``cut`` and its row number is at most ``row_cut``. ``row`` is different in every row.
    """
    # at most one row per source and different size: as many files as there are cores, not as shuffle partitions
    tasks = documents.sparkSession.sparkContext.defaultParallelism
    cells = stored(documents.groupBy("source", "size").agg(F.count("*").alias("n")).coalesce(tasks), "cells")
    targets = stored(source_targets(cells, weights, share, cap), "targets")
    dual = balanced_rates(cells, targets, cap)
    raw = F.exp(F.least(F.col("d.a") * F.col("c.size") / F.col("d.mean"), F.lit(700.0)))
    rate = F.when(F.col("d.a").isNull(), F.when(F.col("c.size") > 0, F.lit(cap)).otherwise(1.0)).otherwise(
        F.least(raw, F.lit(cap))
    )
    rates = cells.alias("c").join(dual.alias("d"), F.col("c.source").eqNullSafe(F.col("d.source"))).select(
        "c.source", "c.size", "c.n", rate.alias("rate")
    )
    kind = documents.schema["source"].dataType.simpleString()
    whole = rates.groupBy("source").applyInArrow(
        _whole_copies(cap), f"source {kind}, size long, n long, low long, extra long"
    )
    whole = stored(whole.coalesce(tasks), "copies")
    part = whole.where("extra > 0 AND extra < n").select("source", "size", F.col("extra").alias("need"))
    cuts = _smallest(documents, part, "hash")
    ties = cuts.where("need < n").select("source", "size", "need", F.col("value").alias("hash"))
    rows = _smallest(documents, ties, "row")
    last = F.lit(-1).cast("long")  # the largest of the numbers read as unsigned
    plan = (
        whole.alias("w")
        .join(cuts.alias("k"), _same_cell("w", "k"), "left")
        .join(rows.alias("r"), _same_cell("w", "r"), "left")
        .select(
            "w.source", "w.size", "w.low",
            F.when(F.col("w.extra") >= F.col("w.n"), last).when(F.col("w.extra") > 0, F.col("k.value")).alias("cut"),
            F.coalesce("r.value", last).alias("row_cut"),
        )
    )
    return targets, stored(plan.coalesce(tasks), "plan")


def _same_cell(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source")) & (F.col(f"{a}.size") == F.col(f"{b}.size"))


def _smallest(documents: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """(source, size, value, need, n): the ``value`` of ``column`` that the ``need``-th smallest row of a cell has.

    ``need`` becomes the number of rows with that value that are needed, ``n`` counts all of them. ``wanted`` has (source,
    size, need), and the hash that rows must have where row numbers are cut. The value is found digit by digit: rows are
    counted by the next ``_DIGIT`` bits and only those of the digit where ``need`` is reached go on. No group is sorted.
    """
    keys = ["source", "size", *(c for c in wanted.columns if c == "hash")]
    found = wanted.select(*keys, "need", F.lit(0).cast("long").alias("value"), F.lit(0).cast("long").alias("n"))
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        found = stored(found.coalesce(1) if shift == 64 - _DIGIT else found, "digits")
        on = _same_cell("d", "f")
        if "hash" in keys:
            on &= F.col("d.hash") == F.col("f.hash")
        if shift < 64 - _DIGIT:
            on &= F.shiftrightunsigned(f"d.{column}", shift + _DIGIT) == F.col("f.value")
        digit = F.shiftrightunsigned(f"d.{column}", shift).alias("value")
        rows = documents.alias("d").join(found.alias("f"), on).select(*(F.col(f"f.{k}") for k in keys), "f.need", digit)
        counts = rows.groupBy(*keys, "need", "value").agg(F.count("*").alias("n"))
        # at most 2**16 digits of a cell
        ahead = Window.partitionBy("source", "size").orderBy(_unsigned("value")).rowsBetween(Window.unboundedPreceding, -1)
        left = counts.withColumn("need", F.col("need") - F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        found = left.where("need > 0 AND need <= n").select(*keys, "need", "value", "n")
    return stored(found, "digits")


def _unsigned(number: str) -> Column:
    """An order-preserving form of a number read as unsigned."""
    return F.col(number).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def copies(low: str, cut: str, hash_: str, row_cut: str = "row_cut", row: str = "row") -> Column:
    below = _unsigned(hash_) < _unsigned(cut)
    tied = (F.col(hash_) == F.col(cut)) & (_unsigned(row) <= _unsigned(row_cut))
    return F.col(low) + F.coalesce((below | tied).cast("long"), F.lit(0))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """(key, size, source_size, target, taken) of every row; ``taken`` is copies times size.

    Null and empty texts have size 0 and take nothing. A null source is a source of its own, the last one. Repeated rows
    count one by one: as many of them get another copy as the target needs. An empty table gives no rows.
    """
    documents = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(key, text).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    documents = stored(documents, "sizes")
    targets, plan = copy_plan(documents, **options)
    targets = targets.withColumnRenamed("source", "its")
    rows = _planned(documents, plan).join(targets, F.col("source").eqNullSafe(F.col("its")))
    taken = copies("low", "cut", "hash") * F.col("size")
    return rows.select(F.col("key").alias(key), "size", "source_size", "target", taken.alias("taken"))


def _planned(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """``documents`` with their row of the plan; a size that very many share is a skewed join key that Spark splits."""
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size"))
    return documents.alias("d").join(plan.alias("p"), same).select("d.*", "p.low", "p.cut", "p.row_cut")


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Rows of ``docs``, all columns as they are, each as often as the mix takes it (0 to ``cap`` times).

    Row numbers tell repeated rows apart, so ``docs`` must be a table that gives its rows in the same order when read again.
    """
    narrow = [
        F.col(source).alias("source"), word_count(text).alias("size"), F.xxhash64(key, text).alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    ]
    _, plan = copy_plan(stored(docs.select(*narrow), "sizes"), **options)
    rows = _planned(docs.select(F.struct("*").alias("doc"), *narrow), plan)
    repeated = rows.select("doc", F.explode(F.array_repeat(F.lit(1), copies("low", "cut", "hash").cast("int"))).alias("copy"))
    return repeated.select("doc.*")
