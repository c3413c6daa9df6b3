"""The corpus operators over the driver's tables, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import contamination
from .html_text import extract
from .line_quality import line_quality
from .line_runs import line_runs
from .minhash import near_duplicates
from .mixing import mix
from .oracles import ORACLES  # noqa: F401
from .shared import table
from .substring import cut_repeats
from .token_count import count_tokens
from .token_store import store_round_trip
from .warc import round_trip


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "times")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, table(spark, sf_dir, "pages"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("body_hash")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_runs(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents")).drop("body_hash", "kept_text")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_html_text": op2_html_text,
    "op3_warc": op3_warc,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_line_runs": op6_line_runs,
    "op7_token_store": op7_token_store,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_repeats": op9_repeats,
    "op10_quality_rules": op10_quality_rules,
}
