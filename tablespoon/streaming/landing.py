"""Incremental bronze: new landing files since the last run, as one or more batches of a file stream.

The stream only finds files; a batch reads its files with the landing scan, so quoted fields with newlines are split as
in a full load. Each batch owns a folder of the bronze table and overwrites it, so a batch that is run again after a lost
driver leaves the same rows. The checkpoint lies below the shared folder or where the caller keeps it between runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..sources import LANDING_SCHEMAS, Layout, load_landing

BATCH = "ingest_batch"
_FILES = "path string, modificationTime timestamp, length long, content binary"


def write_batch(
    batch: DataFrame,
    batch_id: int,
    bronze: Callable[[DataFrame], DataFrame],
    path: str,
    fmt: str,
    schema: T.StructType,
) -> None:
    """Load the files of ``batch`` and put them, as ``bronze`` makes them, into the folder of this batch."""
    files = [r.path for r in batch.select("path").distinct().toLocalIterator()]  # names only, a few per trigger
    if files:
        bronze(load_landing(batch.sparkSession, files, fmt, schema)).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def ingest_landing(
    spark: SparkSession,
    source: str,
    layout: Layout,
    table: str,
    bronze: Callable[[DataFrame], DataFrame],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    checkpoint: str | None = None,
    files_per_batch: int = 1000,
    pattern: str = "*",
) -> DataFrame:
    """Append all landing files below ``source`` that no earlier run has seen, and return the whole bronze table.

    Files are taken as soon as they are complete, so writers move finished files into ``source``. ``bronze`` adds the
    metadata columns. Runs with the same ``checkpoint`` continue each other; a table takes one run at a time.
    """
    path = layout.path("bronze", table)
    schema = schema or LANDING_SCHEMAS[table]
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
    found = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(source).select("path")
    stream = (
        found.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint or f"{shared_dir(spark)}/ingest-{table}")
        .foreachBatch(lambda batch, number: write_batch(batch, number, bronze, path, fmt, schema))
        .start()
    )
    stream.awaitTermination()
    return read_batches(spark, layout, table)


def read_batches(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    """A bronze table of batches, with the number of the batch as a column."""
    return spark.read.parquet(layout.path("bronze", table)).withColumn(BATCH, F.col(BATCH).cast("long"))
