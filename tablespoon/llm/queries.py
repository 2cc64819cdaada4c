"""Registered queries of the training-data operators; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespoon.llm import collocations, decontaminate, licenses, line_rules, mixing, near_dup, oracle, pii, quality_rank, secret_scan, suffix_dedup, token_align, token_store, url_filter
from tablespoon.session import scratch_dir, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the production vocabulary, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "tokens")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), path, vocabulary())
    return token_store.read_tokens(spark, path)


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_table(spark, sf_dir, "documents"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.rank_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "rules.*").drop("clean_text")


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_copies(_table(spark, sf_dir, "documents"), words=2, percent=80)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    files = docs.select(licenses.digit_path("source", "lang", "doc_id").alias("path"), "text")
    found = licenses.scan_licences(files)
    return found.select(F.regexp_extract("path", r"([^/]*)$", 1).cast("long").alias("doc_id"), *found.columns)


#: The rules of the url filter, and hosts that it blocks where no rule fits.
URL_RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
)
BLOCKED_HOSTS = (
    "ads-track.example.com", "adult-x.example.com", "casino-win.example.net", "cheap-pills.example.net",
    "free-bets.example.net", "spam-farm.example.org",
)
#: The names of these hosts; the query blocks them under every domain that the pages have.
BLOCKED_NAMES = tuple(h.split(".")[0] for h in BLOCKED_HOSTS)


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    entries = [url_filter.Entry(text, verdict) for text, verdict in URL_RULES]
    entries += [url_filter.Entry(f"{host}/", "block", rule=False) for host in BLOCKED_HOSTS]
    listed = stored(url_filter.named_hosts(pages, BLOCKED_NAMES), "blocked")
    return url_filter.filter_urls(pages, entries, blocked=listed)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.verbatim_matches(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m.length)), F.lit(0).cast("long")).alias("longest_match"),
    )


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    digest = F.sha2("kept_bytes", 256).alias("kept_sha256")
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), digest)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_align.align_tokens(_table(spark, sf_dir, "documents"), *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": token_files,
    "op2_personal_data": personal_data,
    "op3_secrets": secrets,
    "op4_source_mix": source_mix,
    "op5_quality_scores": quality_scores,
    "op6_line_cleaning": line_cleaning,
    "op7_near_copies": near_copies,
    "op8_license_scan": license_scan,
    "op9_url_verdicts": url_verdicts,
    "op10_decontamination": decontamination,
    "op11_suffix_dedup": repeated_strings,
    "op12_collocations": phrases,
    "op13_token_alignment": token_alignment,
}
ORACLE: dict[str, str] = {
    "op6_line_cleaning": oracle.LINE_CLEANING,
    "op8_license_scan": oracle.license_scan(
        licenses.TEMPLATES, licenses.CUE, licenses.WORD, licenses.LEAST_COSINE, licenses.FILE_SHARE
    ),
    "op9_url_verdicts": oracle.url_verdicts(URL_RULES, BLOCKED_HOSTS, BLOCKED_NAMES),
    "op10_decontamination": oracle.DECONTAMINATION,
    "op12_collocations": oracle.COLLOCATIONS,
}
