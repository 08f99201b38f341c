"""Labelled rows for the classifiers, and the fold rule that both share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id's text is divisible by FOLDS. A null id can match no label: it counts as held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def training_rows(documents: DataFrame, labels: DataFrame, target: str, limit: int) -> DataFrame:
    """``text, label, rank`` of at most ``limit`` labelled ids outside the held-out fold.

    The sample is the ``limit`` ids of smallest hash, so it does not depend on row order or partitions. Only ids and
    labels (at most ``limit`` rows of a few bytes) are broadcast. Ids labelled twice take the larger label; null labels
    and null texts do not train.
    """
    ids = (
        labels.select(F.col("doc_id").alias("id"), F.col(target).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .withColumn("rank", F.xxhash64("id"))
        .orderBy("rank", "id")
        .limit(limit)
    )
    docs = documents.select(F.col("doc_id").alias("id"), "text").where(F.col("text").isNotNull())
    return docs.join(F.broadcast(ids), "id").select("text", "label", "rank")
