"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's docs.

All stages: other columns are carried through whatever their names, an empty
table gives an empty result, rows that occur twice are treated alike unless a
stage says otherwise, and very long texts are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.llm import contamination, packing, paragraphs, quality, simhash
from quarryline.llm.common import discard, materialize, prepare, table

CACHE_ENTRIES = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network does not reject.

    Null and empty texts have the score of a text without windows; null ids
    are judged like others; without labels of both kinds nothing is rejected.
    """
    prepare(spark)
    network = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, network)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies, the one of the smallest id.

    Null and empty texts are copies of one another; of rows with one id and
    text one stays, unlike texts of one id all stay; null ids all stay.
    """
    prepare(spark)
    return simhash.keep_one(spark, docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without paragraphs and passages that repeat an earlier one.

    Earlier is a smaller id, then an earlier place. Null and empty texts and
    rows with a null id are left as they are; rows that occur twice are cut
    alike; ``n_chars`` follows the text.
    """
    prepare(spark)
    return paragraphs.without_repeats(spark, docs, inside=True)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item.

    Null and empty texts and items have no words; null ids are judged like others.
    """
    prepare(spark)
    return contamination.without_benchmark(spark, docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids.

    A null or empty text is its end id; rows that occur twice and null ids are
    packed like others.
    """
    prepare(spark)
    # executors that ran the stages before have grown; a small cache leaves them their memory
    return packing.packed(spark, docs, CACHE_ENTRIES)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The network, the fingerprints and the packing are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that pass all stages."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
