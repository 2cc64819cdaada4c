"""Landing scans. Every landing column is text; typing happens in the silver layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


PIECE_BITS = 16  # 65,536 lines of a block of text, at most, are put in order at once


def _all_text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column names of the landing files.
LANDING_SCHEMAS = {
    "order_items": _all_text(
        "APP_NAME", "RESTAURANT_ID", "CREATION_TIME_UTC", "ORDER_ID", "USER_ID", "PRINTED_CARD_NUMBER", "IS_LOYALTY",
        "CURRENCY", "LINEITEM_ID", "ITEM_CATEGORY", "ITEM_NAME", "ITEM_PRICE", "ITEM_QUANTITY",
    ),
    "order_item_options": _all_text(
        "ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME", "OPTION_PRICE", "OPTION_QUANTITY",
    ),
    "date_dim": _all_text(
        "date_key", "year", "month", "week", "day_of_week", "is_weekend", "is_holiday", "holiday_name",
    ),
}


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a partitioned JDBC read; ``partition`` is (column, lower, upper, number of reads).

    Without ``partition`` the whole table comes through one connection, which only suits small tables.
    """
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition is not None:
        column, lower, upper, reads = partition
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(reads)
        )
    return options


def load_landing(
    spark: SparkSession,
    source: str | Sequence[str] | dict[str, str],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read one landing table.

    csv: header row, all text, quoted fields may hold newlines. The scan is split (:func:`scan_quoted_csv`); with
    ``multi_line=False``, when no field has a newline, rows need not be put together. With a ``schema`` no file is opened
    before the job runs; without one the names come from the header.
    parquet: plain scan. jdbc: ``source`` is the dict of :func:`jdbc_options`.
    """
    if fmt == "csv":
        paths = [source] if isinstance(source, str) else list(source)
        reader = spark.read.option("header", "true").option("inferSchema", "false")
        if multi_line:
            return scan_quoted_csv(spark, paths, schema or reader.option("multiLine", "true").csv(paths).schema)
        return (reader.schema(schema) if schema is not None else reader).csv(paths)
    if fmt == "parquet":
        return spark.read.parquet(*([source] if isinstance(source, str) else list(source)))
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**source).load()
    raise ValueError(f"unknown landing format {fmt!r}, expected csv, parquet or jdbc")


def _quote_effects(line: Column) -> tuple[Column, Column]:
    """Whether a quoted field is open after a line (1 or 0), if none was open before it, and if one was.

    A quote opens a field at its very start, and closes it before a comma or the end of the line unless a backslash
    stands before it; any other quote is text.
    """
    parts = F.split(line, '"', -1)
    n = F.size(parts)

    def quote(k: Column) -> Column:
        before, after = F.element_at(parts, k), F.element_at(parts, k + 1)
        opens = F.endswith(before, F.lit(",")) | ((k == 1) & (before == ""))
        escaped = F.length(F.regexp_extract(before, r"(\\*)$", 1)) % 2 == 1
        ends = F.regexp_like(after, F.lit(r"^\s*,")) | ((k + 1 == n) & F.regexp_like(after, F.lit(r"^\s*$")))
        return F.struct(opens.alias("opens"), (ends & ~escaped).alias("closes"))

    quotes = F.transform(F.sequence(F.lit(1), n - 1), quote)

    def after(start: int) -> Column:
        step = lambda s, q: F.when(s == 1, F.when(q["closes"], 0).otherwise(1)).otherwise(F.when(q["opens"], 1).otherwise(0))
        return F.when(F.contains(line, F.lit('"')), F.aggregate(quotes, F.lit(start), step)).otherwise(start)

    return after(0), after(1)


def _open_before(window: Window, start: Column | int) -> Column:
    """Whether a field is open before a row of ``window``, which has ``o`` and ``i`` as of :func:`_quote_effects`.

    A row that keeps or swaps the state is counted, one that sets it makes the rows before it irrelevant; so the state is
    a running sum since the last row that sets it.
    """
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    sets, swaps = F.col("o") == F.col("i"), F.col("o") > F.col("i")
    so_far = F.coalesce(F.sum(swaps.cast("int")).over(before), F.lit(0))
    kept = F.last(F.when(sets, F.struct(F.col("o").alias("state"), F.col("swaps"))), ignorenulls=True).over(before)
    return F.pmod(F.when(kept.isNull(), so_far + start).otherwise(so_far - kept["swaps"] + kept["state"]), F.lit(2))


def _with_swaps(df: DataFrame, window: Window) -> DataFrame:
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("swaps", F.sum((F.col("o") > F.col("i")).cast("int")).over(upto))


def scan_quoted_csv(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with a header and quoted fields that may hold newlines, read by as many tasks as the files have blocks.

    Each physical line either keeps, swaps or sets whether a quoted field is open. These effects compose, so a prefix over
    the lines of a piece of a block, and one over the few pieces of a file, tell for every line whether it starts a record; no task
    reads more than a block. Lines that are records go on as they are, others are put together, also across blocks.
    Lines end with a newline, or carriage return and newline; commas, double quotes and backslash as escape as in the
    plain reader, whose rows these are, in another order.
    """
    whole = Window.partitionBy("file", "block").orderBy("line")
    text = spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start_byte"),
        F.monotonically_increasing_id().alias("line"),
    )
    # lines of a block are numbered on, so cut by number they stay in order: pieces of a bounded number of lines to sort
    piece = F.struct("start_byte", F.shiftright("line", PIECE_BITS).alias("nth"))
    text = text.select("value", "file", piece.alias("block"), "line")
    o, i = _quote_effects(F.col("value"))
    lines = _with_swaps(text.withColumns({"o": o, "i": i}), whole)
    after = lambda state: F.when(state == 0, F.col("o")).otherwise(F.col("i"))
    both = lines.withColumns({f"b{k}": _open_before(whole, k) for k in (0, 1)})
    blocks = both.groupBy("file", "block").agg(
        *(F.max(F.struct("line", after(F.col(f"b{k}")).alias("s")))["s"].alias("oi"[k]) for k in (0, 1)),
        *(F.count_if(F.col(f"b{k}") == 0).alias(f"n{k}") for k in (0, 1)),
        F.min(F.struct("line", F.endswith("value", F.lit("\r")).alias("returns")))["returns"].alias("returns"),
    )
    file = Window.partitionBy("file").orderBy("block")
    starts = _with_swaps(blocks, file).withColumn("start", _open_before(file, 0)).withColumn(
        "records", F.when(F.col("start") == 0, F.col("n0")).otherwise(F.col("n1"))
    )
    last = F.last(F.when(F.col("records") > 0, F.struct(F.col("block").alias("block"), "records")), ignorenulls=True)
    starts = starts.select(
        F.col("file").alias("_f"), F.col("block").alias("_b"), "start", F.first("returns").over(file).alias("returns"), F.first("block").over(file).alias("top"), last.over(file.rowsBetween(Window.unboundedPreceding, -1)).alias("carried")
    )
    rows = lines.join(starts, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    rows = rows.withColumn("open", _open_before(whole, F.col("start")))
    nth = F.sum((F.col("open") == 0).cast("long")).over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("nth", nth)
    at_home = F.col("nth") > 0
    rows = rows.select(
        "file", F.when(at_home, F.col("block")).otherwise(F.col("carried.block")).alias("home"),
        F.when(at_home, F.col("nth")).otherwise(F.col("carried.records")).alias("nth"), "block", "line", "value",
        ((F.col("open") == 0) & (F.col("o") == 0)).alias("alone"), "returns", "top",
    )
    alone = rows.where("alone AND value NOT IN ('', '\r')").select("home", "nth", "top", F.col("value").alias("record"))
    parts = rows.where("NOT alone").groupBy("file", "home", "nth").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"), F.any_value("returns").alias("returns"), F.any_value("top").alias("top")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    # as the plain reader: where the first line of a file ends with both characters, newlines in fields lose the first
    joined = F.when(F.col("returns"), F.replace(joined, F.lit("\r\n"), F.lit("\n"))).otherwise(joined)
    joined = parts.select("home", "nth", "top", joined.alias("record"))
    records = alone.unionByName(joined).where("NOT (home = top AND nth = 1)")  # without headers
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    record = F.regexp_replace("record", r"\r$", "")
    return records.select(F.from_csv(record, names, {"multiLine": "true"}).alias("r")).select("r.*")
