"""Whole texts as byte blocks for vectorised work.

``mapInArrow`` hands over record batches whose strings already lie in one UTF-8 buffer. The helpers here expose that
buffer to numpy without copying and cut a batch into blocks of bounded size, so that the working memory of a task follows
BLOCK_BYTES (or the longest single text) and not the batch. Null texts count as empty.

``in_batches`` runs a task on batches of bounded bytes and has its worker give memory back: workers live on between tasks,
and what they hoard would add up beside the next stage.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
#: Bytes of a batch between Spark and a worker; one row may be longer.
BATCH_BYTES = 1 << 21
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: What a worker keeps for the next task of the same owner, and how to drop it.
_KEPT: dict[str, Callable[[], None]] = {}


def kept_by(owner: str, drop: Callable[[], None]) -> None:
    """Register what tasks of ``owner`` keep in their worker; tasks of other owners drop it."""
    _KEPT[owner] = drop


def _enter(owner: str) -> None:
    pa.set_memory_pool(pa.system_memory_pool())
    for name, drop in _KEPT.items():
        if name != owner:
            drop()


def _leave() -> None:
    """Hand freed memory back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_batches(rows: DataFrame, task: Task, schema: str | T.StructType, owner: str = "") -> DataFrame:
    """``rows.mapInArrow(task, schema)`` on batches of at most BATCH_BYTES.

    Lowers the session's setting for the size of batches where it is larger, for this and later queries.
    """
    conf = rows.sparkSession.conf
    size = conf.get(_BATCH_SETTING)
    if not size.isdigit() or int(size) > BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _enter(owner)
        try:
            yield from task(batches)
        finally:
            _leave()

    return rows.mapInArrow(run, schema)


def filled(column: pa.Array) -> pa.Array:
    """The column with nulls as empty strings."""
    return pc.fill_null(column, "") if column.null_count else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column without nulls."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, index, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(index, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts take at most ``limit`` bytes together; a longer text stands alone."""
    if not batch.num_rows:
        return
    at = batch.schema.get_field_index(column)
    batch = batch.set_column(at, column, filled(batch.column(at)))
    _, offsets = utf8(batch.column(at))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def texts(column: pa.Array) -> list[bytes]:
    """The rows as bytes."""
    raw, offsets = utf8(column)
    data = raw.tobytes()
    return [data[i:j] for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
