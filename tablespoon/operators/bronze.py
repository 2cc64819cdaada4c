"""Landing to bronze: the source columns unchanged, plus ingestion metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_ingestion_ts(df: DataFrame, ingested_at: str) -> DataFrame:
    """Stamp every row with one ISO timestamp, given by the caller so that a rerun can repeat it."""
    return df.withColumn("ingestion_timestamp", F.lit(ingested_at))


def with_order_date_partition(df: DataFrame) -> DataFrame:
    """Day of the order, cut from the timestamp text without parsing it."""
    return df.withColumn("order_date_partition", F.substring("CREATION_TIME_UTC", 1, 10))


def bronze_order_items(landing: DataFrame, ingested_at: str) -> DataFrame:
    return with_order_date_partition(with_ingestion_ts(landing, ingested_at))


def bronze_order_item_options(landing: DataFrame, ingested_at: str) -> DataFrame:
    return with_ingestion_ts(landing, ingested_at)


def bronze_date_dim(landing: DataFrame, ingested_at: str) -> DataFrame:
    return with_ingestion_ts(landing, ingested_at)


# Partition columns each bronze table is written with.
BRONZE_PARTITIONS = {"order_items": ["order_date_partition_month"], "order_item_options": [], "date_dim": ["year"]}
