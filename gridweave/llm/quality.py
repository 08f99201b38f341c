"""Quality classifier: a byte-level convolutional network in numpy.

A filter looks at WIDTH consecutive bytes; its weights for each place and byte value are learned. The responses over a
whole document are max-pooled in overlapping chunks of CHUNK bytes (a new chunk every CHUNK / 2 bytes), rectified,
averaged over the chunks and combined into one probability. Every byte of a text is inside one or two chunks, whatever
its length; long texts are convolved piece by piece, so memory does not follow the longest text.

Training is minibatch Adam on a bounded sample of labelled rows (TRAIN_ROWS ids, whole texts) in one task; the fitted model
has a fixed size (under 200 kB) and is broadcast. Scoring is one pass without a shuffle. ``tuning`` has how the settings were
picked.

Defined results: a null or empty text is scored as an empty document; texts of any length are scored whole; a score of exactly
THRESHOLD is kept; repeated rows are scored alike; an id labelled twice takes the larger label; a null id counts as held out;
without labelled rows every score is 1.0 (nothing can be rejected); an empty table gives an empty table; extra columns of the
input are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridweave.llm.labelled import held_out, training_rows
from gridweave.llm.textblock import blocks, in_batches, texts

FILTERS = 16
WIDTH = 6
CELL = 128
CHUNK = 4 * CELL
PIECE = 64 * CELL
THRESHOLD = 0.3
TRAIN_ROWS = 6_000
EPOCHS = 8
BATCH = 32
RATE = 0.02


@dataclass
class ByteConvNet:
    """table: (WIDTH, 256, FILTERS) weights of byte values; bias: of the filters; head, shift: of the output."""

    table: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    shift: float

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, table=self.table, bias=self.bias, head=self.head, shift=np.float64(self.shift))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> ByteConvNet:
        with np.load(io.BytesIO(data)) as x:
            return cls(x["table"], x["bias"], x["head"], float(x["shift"]))

    def pairs(self) -> list[np.ndarray]:
        """Weights of two adjacent bytes at once, which halves the lookups: WIDTH / 2 tables of (65536, FILTERS)."""
        return [(self.table[k][:, None, :] + self.table[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]


def _codes(text: bytes) -> np.ndarray:
    """Codes of adjacent byte pairs, with zero bytes after the end so that every byte starts a window."""
    raw = np.zeros(max(len(text), 1) + WIDTH, np.uint16)
    raw[: len(text)] = np.frombuffer(text, np.uint8)
    return raw[:-1] * np.uint16(256) + raw[1:]


def _responses(codes: np.ndarray, tables: list[np.ndarray], start: int, stop: int) -> np.ndarray:
    out = tables[0][codes[start:stop]]
    for k, table in enumerate(tables[1:], 1):
        out += table[codes[start + 2 * k : stop + 2 * k]]
    return out


def _cells(codes: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Largest response of each filter in each run of CELL positions."""
    n = len(codes) - WIDTH + 1
    parts = []
    for start in range(0, n, PIECE):
        stop = min(start + PIECE, n)
        parts.append(np.maximum.reduceat(_responses(codes, tables, start, stop), np.arange(0, stop - start, CELL), axis=0))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _chunks(cells: np.ndarray) -> np.ndarray:
    """Max over four cells, every two cells."""
    if len(cells) % 2:
        cells = np.concatenate([cells, cells[-1:]])
    halves = np.maximum(cells[0::2], cells[1::2])
    return halves if len(halves) == 1 else np.maximum(halves[:-1], halves[1:])


def score_text(text: bytes, model: ByteConvNet, tables: list[np.ndarray]) -> float:
    hidden = np.maximum(_chunks(_cells(_codes(text), tables)) + model.bias, 0).mean(axis=0)
    return float(1 / (1 + np.exp(-np.clip(hidden @ model.head + model.shift, -30, 30))))


def _winners(codes: np.ndarray, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For training: value and position of each chunk's largest response, both (chunks, FILTERS)."""
    n = len(codes) - WIDTH + 1
    cells = -(-n // CELL)
    full = np.full((cells * CELL, FILTERS), -np.inf, np.float32)
    full[:n] = _responses(codes, tables, 0, n)
    at = full.reshape(cells, CELL, FILTERS).argmax(axis=1) + np.arange(cells)[:, None] * CELL
    best = np.take_along_axis(full, at, axis=0)
    members = np.minimum(np.arange(0, max(cells - 2, 1), 2)[:, None] + np.arange(4), cells - 1)
    pick = best[members].argmax(axis=1)
    cell = np.take_along_axis(members[:, :, None].repeat(FILTERS, 2), pick[:, None, :], axis=1)[:, 0, :]
    return np.take_along_axis(best, cell, axis=0), np.take_along_axis(at, cell, axis=0)


def fit(rows: list[tuple[bytes, int]], seed: int = 7) -> ByteConvNet:
    """Train on (text, label) pairs, in the order given; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    model = ByteConvNet(
        rng.normal(0, 0.2, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32),
        0.0,
    )
    flat = [model.table.reshape(-1), model.bias, model.head, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(x) for x in flat], [np.zeros_like(x) for x in flat]
    codes = [_codes(t) for t, _ in rows]
    labels = np.array([y for _, y in rows], np.float32)
    step, steps = 0, EPOCHS * -(-len(rows) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            tables, chosen = model.pairs(), order[begin : begin + BATCH]
            places, pulls = [], []
            grads = [np.zeros_like(x) for x in flat]
            for i in chosen:
                value, at = _winners(codes[i], tables)
                hidden = np.maximum(value + model.bias, 0)
                mean = hidden.mean(axis=0)
                error = 1 / (1 + np.exp(-np.clip(mean @ model.head + flat[3][0], -30, 30))) - labels[i]
                grads[2] += error * mean
                grads[3] += error
                pull = (hidden > 0) * (error * model.head / len(hidden))
                grads[1] += pull.sum(axis=0)
                raw = codes[i] >> 8
                for k in range(WIDTH):
                    places.append(((k * 256 + raw[at + k].astype(np.int64)) * FILTERS + np.arange(FILTERS)).ravel())
                    pulls.append(pull.ravel())
            grads[0] = np.bincount(np.concatenate(places), np.concatenate(pulls), len(flat[0])).astype(np.float32)
            step += 1
            for x, g, m, v in zip(flat, grads, first, second, strict=True):
                g /= len(chosen)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= RATE * (1 - (step - 1) / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            model.shift = float(flat[3][0])
    return model


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for part in blocks(batch):
            rows += zip(part.column("rank").to_pylist(), texts(part.column("text")), part.column("label").to_pylist(), strict=True)
    if rows:
        rows.sort()
        yield pa.record_batch({"model": pa.array([fit([r[1:] for r in rows]).to_bytes()], pa.binary())})


def train(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> bytes | None:
    """The fitted model, or None without a labelled row."""
    rows = training_rows(documents, labels, "quality", limit).repartition(1)
    found = in_batches(rows, _fit_task, "model binary").collect()
    return bytes(found[0][0]) if found else None


def quality_scores(documents: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """``documents`` with ``score`` (double) and ``predicted`` (int) as last columns.

    Input columns of these names are replaced.
    """
    data = train(documents, labels, limit)
    plain = documents.drop("score", "predicted")
    if data is None:
        return plain.withColumn("score", F.lit(1.0)).withColumn("predicted", F.lit(1))
    shared = documents.sparkSession.sparkContext.broadcast(data)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ByteConvNet.from_bytes(shared.value)
        tables = model.pairs()
        for batch in batches:
            scores = [score_text(t, model, tables) for part in blocks(batch) for t in texts(part.column("text"))]
            out = batch.append_column("score", pa.array(scores, pa.float64()))
            yield out.append_column("predicted", pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()))

    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return in_batches(plain, score, schema)


def op9_query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return quality_scores(documents.select("doc_id", "text"), labels).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    scored = quality_scores(documents, labels)
    return scored.where("predicted = 1").select(*documents.columns)
