"""The queries of this subpackage and, where SQL can say them, their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import brown, chat, contamination, impact, keyed, packing, paragraphs, quality, simhash, tokenfiles
from .common import materialize, prepare, table


def op1_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer products of every 20th vector."""
    return impact.nearest(spark, table(spark, sf_dir, "embeddings"))


def op2_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in a window of ten words of a benchmark item."""
    return contamination.contamination_report(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    return packing.packed(spark, table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations with repaired roles, rendered piece by piece."""
    return chat.formatted(spark, table(spark, sf_dir, "conversations"))


def op5_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-bigram and base log10 probabilities of every text."""
    return brown.scored_documents(spark, table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes by 64-bit fingerprints."""
    return simhash.simhash_classes(spark, table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of each document by a byte-level network."""
    return quality.quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by a separator scan of flat files."""
    return tokenfiles.token_counts(spark, table(spark, sf_dir, "documents"))


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All paragraphs and passages that repeat an earlier one, with their runs' words and the one that stays."""
    docs = table(spark, sf_dir, "documents")
    seen = paragraphs.Found(spark, docs)
    lines = materialize(paragraphs.removals(spark, docs, min_run=0, found=seen), "lines").withColumn("kind", F.lit("paragraph"))
    inside = paragraphs.passages(spark, docs, found=seen).withColumn("kind", F.lit("passage"))
    found = lines.unionByName(inside)
    return found.withColumnsRenamed({"id": "doc_id", "keeper_id": "keeper_doc_id"})


def op10_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to shards and read back by key."""
    return keyed.stored_texts(spark, table(spark, sf_dir, "documents"))


def lm_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5 returns but for the class model's score."""
    return brown.base_scores(spark, table(spark, sf_dir, "documents"))


def simhash_sign_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6's search over given fingerprints, the signs of vectors."""
    return simhash.sign_classes(spark, table(spark, sf_dir, "embeddings"))


_QUERIES = (op1_impact, op2_contamination, op3_packing, op4_chat, op5_brown, op6_simhash, op7_quality, op8_token_counts, op9_paragraphs, op10_binary, lm_base_scores, simhash_sign_classes)


def _prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _prepared(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_impact": impact.NEAREST_SQL, "op2_contamination": contamination.REPORT_SQL, "lm_base_scores": brown.BASE_SQL, "simhash_sign_classes": simhash.SIGN_SQL}
