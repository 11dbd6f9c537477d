"""The document pipeline: quality, toxicity, near duplicates, benchmark passages, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's ``docs``.  All but the last return the columns of ``documents``: rows are dropped, none is
changed.  Null texts pass the filters as empty ones would; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpus_audit.llm import decontaminate, jaccard, packing, quality, toxicity
from corpus_audit.llm.common import stash, table
from corpus_audit.llm.queries import word_tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant accepts."""
    return quality.keep(docs, table(spark, sf_dir, "labels"), threshold=0.5)


def keep_clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more: the smallest id."""
    return jaccard.one_of_each(docs, words=5, share=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that is within the edit budget of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs, word_tokenizer(), ids=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", keep_clean_language),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("best-fit packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
