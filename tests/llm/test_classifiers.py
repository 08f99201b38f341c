"""Held-out accuracy and defined results of the quality and toxicity classifiers."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.llm import quality, toxicity

BIG = "/root/testdata/sf0.1"


@pytest.mark.parametrize(("op", "target", "floor"), [(quality.op9_query, "quality", 0.97), (toxicity.op2_query, "toxic", 0.93)])
def test_held_out(spark, op, target, floor):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    out = op(docs, labels).toPandas()
    assert len(out) == docs.count() and list(out.columns) == ["doc_id", "held_out", "score", "predicted"]
    assert out.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(out.doc_id, out.held_out))
    both = out.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held[target]).mean() >= floor


@pytest.mark.parametrize("op", [quality.op9_query, toxicity.op2_query])
def test_awkward_and_empty(spark, awkward, documents, labels, op):
    apart = awkward.withColumn("doc_id", F.col("doc_id") - 1000)
    out = op(apart.unionByName(documents, allowMissingColumns=True), labels).toPandas()
    assert len(out) == awkward.count() + documents.count() and out.score.notna().all()
    twins = out[out.doc_id == -999]
    assert len(twins) == 2 and twins.score.nunique() == 1
    empty = out[out.doc_id.isin([-998, -997])]
    assert empty.score.nunique() == 1
    assert op(awkward.limit(0), labels).count() == 0
    untrained = op(awkward, labels.limit(0)).toPandas()
    assert set(untrained.predicted) == ({1} if op is quality.op9_query else {0})


def test_labels_of_held_out_rows_do_not_matter(documents, labels):
    from gridweave.llm.labelled import held_out

    flipped = labels.select("doc_id", *[F.when(held_out(), 1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")])
    assert quality.train(documents, labels, 60) == quality.train(documents, flipped, 60)
    one, two = (toxicity.train(documents, table, 150) for table in (labels, flipped))
    assert (one[0] == two[0]).all() and (one[1] == two[1]).all() and one[2] == two[2]


def test_convolution_covers_the_whole_text():
    rng = np.random.default_rng(0)
    model = quality.ByteConvNet(rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), np.zeros(quality.FILTERS, np.float32), rng.normal(size=quality.FILTERS).astype(np.float32), 0.1)
    text = bytes(rng.integers(32, 127, 3 * quality.PIECE + 77).astype(np.uint8))
    padded = np.frombuffer(text + bytes(quality.WIDTH), np.uint8)
    full = sum(model.table[k][padded[k : k + len(text)]] for k in range(quality.WIDTH))
    cells = [full[i : i + quality.CELL].max(axis=0) for i in range(0, len(text), quality.CELL)]
    cells += [cells[-1]] * (len(cells) % 2)
    chunks = [np.max(cells[i : i + 4], axis=0) for i in range(0, len(cells) - 2, 2)]
    hidden = np.maximum(np.array(chunks), 0).mean(axis=0)
    assert quality.score_text(text, model, model.pairs()) == pytest.approx(1 / (1 + np.exp(-(hidden @ model.head + 0.1))), rel=1e-3)


def test_ftrl_is_sparse_and_finds_the_word():
    rng = np.random.default_rng(1)
    rows = [(np.unique(np.concatenate([rng.integers(100, 5000, 40), [7] if i % 3 == 0 else []]).astype(np.int64)), int(i % 3 == 0)) for i in range(600)]
    weights, bias = toxicity.fit(rows)
    assert weights.argmax() == 7 and (weights != 0).sum() < 500 and bias < 0


def test_long_texts_train_like_any_other():
    import pyarrow as pa

    rows = [(1, "x" * 200_000, 1), (2, "good words of a page " * 5, 1), (3, "zz qq zz qq zz " * 5, 0)]
    ranks, texts, labels = zip(*rows)
    out = list(quality._fit_task(iter([pa.record_batch({"rank": list(ranks), "text": list(texts), "label": list(labels)})])))
    want = quality.fit([(t.encode(), y) for _, t, y in rows])
    got = quality.ByteConvNet.from_bytes(out[0].column("model")[0].as_py())
    assert (got.table == want.table).all() and got.shift == want.shift
