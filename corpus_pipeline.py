"""Corpus preparation: line rules, near copies, decontamination, mixing and token files, each stage stored.

Every stage takes all rows its predecessor kept and all but the last return the columns of ``documents``. Near copies share
at least 80 % of their five-word shingles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablespoon.llm import decontaminate, line_rules, mixing, near_dup, token_store
from tablespoon.llm.queries import vocabulary
from tablespoon.session import scratch_dir, stored

#: Near copies and the grammar of the token files are no SQL statements; the run is tested against plain Python.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their failing lines; rejected documents go."""
    return line_rules.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words at least a twentieth lies in benchmark windows."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: never, once or twice."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, read back: place, number and checksum of every document's ids."""
    path = scratch_dir(spark, "pipeline-tokens")
    token_store.write_tokens(docs, path, vocabulary())
    return token_store.read_tokens(spark, path)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
