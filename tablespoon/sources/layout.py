"""Layer paths and the Parquet table scan and sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import FREE_SHUFFLES, settings

#: A partition column of this ending is the month (``yyyy-MM``) of the day column it is named after. It exists in the
#: folders only: a day's folder would hold too few rows for a file of its own in most tables.
MONTH = "_month"
OPEN_WRITERS = 16
COMPRESSION = "zstd"
LAYERS = ("landing", "bronze", "silver", "gold")


@dataclass(frozen=True)
class Layout:
    """Where the layers live. ``overrides`` maps a layer to a root of its own."""

    root: str
    overrides: tuple[tuple[str, str], ...] = ()

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        base = dict(self.overrides).get(layer) or f"{self.root.rstrip('/')}/{layer}"
        return f"{base.rstrip('/')}/{table}"


def read_table(spark: SparkSession, layout: Layout, layer: str, table: str, months: bool = False) -> DataFrame:
    """A stored table as it was written; with ``months`` also its month folders as a column, for filters on them."""
    df = spark.read.parquet(layout.path(layer, table))
    return df if months else df.drop(*(c for c in df.columns if c.endswith(MONTH) and c.removesuffix(MONTH) in df.columns))


def write_table(
    df: DataFrame,
    layout: Layout,
    layer: str,
    table: str,
    partition_cols: Sequence[str] = (),
    only_touched_partitions: bool = False,
    in_place: bool = False,
) -> str:
    """Overwrite a layer table and return its path.

    A partitioned write is rebalanced on its partition columns first, so that one day is written by a few
    tasks instead of by all of them. Adaptive execution splits a day that is too large for one task and
    joins small ones, so neither tiny files nor a hot day hold the job up. ``date_key_month`` and the like are made
    here; a frame that brings its month column has been dealt by its maker and goes to the files as it is, a month's
    writer staying open while its rows come. So is one that comes ``in_place`` from a table of the same folders, whose files
    each hold rows of one of them. Tasks keep a few folders open instead of sorting. Shuffle files go with the write. ``only_touched_partitions`` replaces just the partitions present in ``df``: a
    rerun brings whole partitions.
    """
    path = layout.path(layer, table)
    dealt = any(c.endswith(MONTH) and c in df.columns for c in partition_cols)
    if partition_cols and not dealt:
        made = [c for c in partition_cols if c.endswith(MONTH) and c not in df.columns]
        df = df.withColumns({c: F.substring(F.col(c.removesuffix(MONTH)).cast("string"), 1, 7) for c in made}) if made else df
        df = df if in_place else df.hint("rebalance", *partition_cols)
    writer = df.write.mode("overwrite").option("compression", COMPRESSION)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer = writer.option("partitionOverwriteMode", "dynamic" if only_touched_partitions else "static")
    open_writers = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_WRITERS)} if partition_cols else {}
    with settings(df.sparkSession, FREE_SHUFFLES | open_writers):
        writer.parquet(path)
    return path
