"""From raw documents to a token store: five stages, each over all rows that the one before it kept.

Every stage but the last returns rows with the columns of documents. Its result is written as Parquet to the shared folder
and read again, so that a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glyphflow.llm.decontaminate import uncontaminated
from glyphflow.llm.line_quality import keep_good
from glyphflow.llm.minhash import one_of_each
from glyphflow.llm.mixing import mixed
from glyphflow.llm.queries import tokenizer
from glyphflow.llm.shared import discard, table, written
from glyphflow.llm.token_store import store_round_trip


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and from the others the lines that too many of their host share."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token store of the documents; returns what is read back from it."""
    return store_round_trip(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("token-ID / binary output", token_output),
]

#: Near-dedup and the token store can't be put in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows that the token store gives back."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{number}")
        discard(before)
    return docs
