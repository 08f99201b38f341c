"""Every operator on awkward rows: columns of clashing names change nothing, empty tables give empty tables."""

import pytest
from pyspark.sql import functions as F

from gridweave.llm import bpe, decontamination, embeddings, html_extraction, pii, quality, secrets, simhash, toxicity, warc

CLASH = "score label fp id rank row_key base spans component t e n text_ i j d key group low high set_id low high word ids pieces at to file size digest links codes block ck".split()


def clashing(df):
    for name in dict.fromkeys(CLASH):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("op", [simhash.op3_query, secrets.op4_query, pii.op5_query, bpe.op7_query])
def test_text_operators(awkward, op):
    plain = awkward.select("doc_id", "text")
    want = rows(op(plain))
    assert len(want) == awkward.count()
    assert rows(op(clashing(awkward))) == want
    assert op(clashing(awkward).limit(0)).count() == 0


@pytest.mark.parametrize("op", [toxicity.op2_query, quality.op9_query])
def test_classifiers(documents, awkward, labels, op):
    docs = documents.select("doc_id", "text").unionByName(awkward.select(F.col("doc_id") - 1000, "text").toDF("doc_id", "text"))
    assert rows(op(clashing(docs), labels.withColumn("text", F.lit("clash")).withColumn("id", F.lit(1)))) == rows(op(docs, labels))


def test_decontamination(spark, awkward):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog near the river bank today."), (None, "word word")], "item_id long, text string")
    plain = rows(decontamination.op8_query(awkward.select("doc_id", "text"), items))
    assert plain and rows(decontamination.op8_query(clashing(awkward), clashing(items))) == plain


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>One text.</p></article>"), (1, None, None), (None, "v", "x" * 200), (3, "u", "")], "page_id long, url string, html string")
    for op in (html_extraction.op1_query, warc.op10_query):
        assert rows(op(clashing(pages))) == rows(op(pages))
        assert op(clashing(pages).limit(0)).count() == 0


def test_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.99, 0.01]), (2, None), (None, [1.0, 0.0]), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0])], "vec_id long, embedding array<float>")
    assert rows(embeddings.op6_query(clashing(vectors))) == rows(embeddings.op6_query(vectors))
    assert embeddings.op6_query(clashing(vectors).limit(0)).count() == 0
