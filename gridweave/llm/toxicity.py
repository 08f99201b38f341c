"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its words, word pairs, and pairs that skip one or two words, each present or absent, hashed into
2^HASH_BITS weights; one that fewer than MIN_ROWS training rows have stays out. FTRL-proximal keeps a learning rate per
coordinate and sets small weights to exactly zero by L1, so what is broadcast is a short list of (index, weight), at most 2^HASH_BITS entries whatever the corpus.

Training makes EPOCHS passes, in hash order, over a bounded sample of labelled rows (TRAIN_ROWS ids) in one task: the method
is sequential. Scoring is one scan without a shuffle; words are hashed by numpy on the UTF-8 buffers, over whole texts.
``tuning`` has how the settings were picked.

Defined results: null and empty texts get the score of the bias alone; texts of any length are scored whole; a score of
exactly THRESHOLD is toxic; without labelled rows every score is 0.0; an id labelled twice takes the larger label; a null id
counts as held out; repeated rows get equal scores; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.labelled import held_out, training_rows
from gridweave.llm.textblock import blocks, in_batches, utf8
from gridweave.llm.words import mixed, words

HASH_BITS = 23
SKIPS = (1, 2, 3)
THRESHOLD = 0.5
TRAIN_ROWS = 16_000
#: Training rows that must have a feature before it takes part.
MIN_ROWS = 6
EPOCHS = 10
ALPHA = 3.0
BETA = 1.0
L1 = 12.0
L2 = 0.1
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and weight index of every feature occurrence of a block."""
    _, _, rows, hashes = words(raw, offsets)
    shift = np.uint64(64 - HASH_BITS)
    row_parts, index_parts = [rows], [mixed(hashes * _SALTS[0]) >> shift]
    for skip in SKIPS:
        same = rows[skip:] == rows[:-skip]
        pair = hashes[:-skip][same] * _SALTS[0] + hashes[skip:][same] * _SALTS[skip]
        row_parts.append(rows[:-skip][same])
        index_parts.append(mixed(pair + np.uint64(skip)) >> shift)
    return np.concatenate(row_parts), np.concatenate(index_parts).astype(np.int64)


def distinct(rows: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, index) once."""
    key = np.unique((rows << HASH_BITS) | index)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


def fit(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Weights and bias from (distinct feature indices, label) rows, in the order given."""
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    seen = np.zeros(1 << HASH_BITS, np.int32)
    for index, _ in rows:
        seen[index] += 1
    rows = [(index[seen[index] >= MIN_ROWS], label) for index, label in rows]
    bias_z = bias_n = 0.0

    def weight(z, n):  # noqa: ANN001, ANN202
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for index, label in rows:
            own_z, own_n = z[index], n[index]
            w = weight(own_z, own_n)
            bias = -bias_z / ((BETA + bias_n**0.5) / ALPHA)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - label
            grown = own_n + g * g
            z[index] = own_z + g - (np.sqrt(grown) - np.sqrt(own_n)) / ALPHA * w
            n[index] = grown
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * bias
            bias_n += g * g
    return weight(z, n), -bias_z / ((BETA + bias_n**0.5) / ALPHA)


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch):
            rows, index = distinct(*features(*utf8(part.column("text"))))
            bounds = np.searchsorted(rows, np.arange(part.num_rows + 1))
            lists = [index[i:j].astype(np.int32) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch([part.column("rank"), part.column("label"), pa.array(lists, pa.list_(pa.int32()))], ["rank", "label", "features"])


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        column = batch.column("features")
        rows += zip(batch.column("rank").to_pylist(), batch.column("label").to_pylist(), (x.values.to_numpy() for x in column), strict=True)
    rows.sort(key=lambda r: (r[0], len(r[2])))
    kept = [(index, label) for _, label, index in rows]
    if kept:
        w, bias = fit(kept)
        at = np.flatnonzero(w)
        yield pa.record_batch({"at": pa.array([at.astype(np.int32)], pa.list_(pa.int32())), "weight": pa.array([w[at]], pa.list_(pa.float64())), "bias": pa.array([bias])})


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Indices and values of the weights that are not zero, and the bias; None without a labelled row."""
    rows = in_batches(training_rows(documents, labels, "toxic", limit), _feature_task, "rank long, label int, features array<int>")
    found = in_batches(rows.repartition(1), _fit_task, "at array<int>, weight array<double>, bias double").collect()
    return (np.array(found[0][0], np.int64), np.array(found[0][1]), found[0][2]) if found else None


def toxicity_scores(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, score, predicted`` of every document."""
    model = train(documents, labels, limit)
    docs = documents.select("doc_id", "text")
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, bias = shared.value
        heavy = np.zeros(1 << HASH_BITS, bool)
        heavy[at] = True
        for batch in batches:
            for part in blocks(batch):
                rows, index = features(*utf8(part.column("text")))
                known = heavy[index]
                rows, index = distinct(rows[known], index[known])
                total = np.bincount(rows, value[np.searchsorted(at, index)], part.num_rows) + bias
                p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
                yield pa.record_batch([part.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = dict(documents.dtypes)["doc_id"]
    return in_batches(docs, score, f"doc_id {kind}, score double, predicted int")


def op2_query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return toxicity_scores(documents, labels).select("doc_id", held_out().alias("held_out"), "score", "predicted")
