"""Corpus preparation in five stages, each a DataFrame written as Parquet and read again as the next stage's documents.

Defined results: a null text is treated as an empty one by every stage and stays null until it is encoded; of repeated rows
and of near copies one stays, of rows with a null id only those of groups without any id; a score at the threshold is kept;
texts of any length are read whole; columns beyond those of ``documents`` are carried along whatever their names; an empty
table gives an empty table. What a stage stores on its way is deleted when its output is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridweave.llm import bpe, decontamination, pii, quality, simhash
from gridweave.plans.storage import materialise, release, released


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash near-duplicate group."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return decontamination.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take personal data and the terms that disclose it out of the texts."""
    return pii.sanitise(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the texts: ``doc_id, n_tokens, ids, decoded``."""
    return bpe.encode_documents(docs, bpe.vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: The stages score, hash and tokenise; SQL cannot express them. tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with released():
            after = materialise(stage(spark, docs, sf_dir), name, stay=True)
        release(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
