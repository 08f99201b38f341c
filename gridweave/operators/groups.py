"""Kernels over whole groups, many small groups to a batch.

A grouped function that is called once per group pays for a batch of its own each time, which dwarfs the work where groups
have a handful of rows. Here rows are dealt by their group, sorted, and handed over in batches that end where a group ends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Bounds = list[int]


def _changes(column: pa.Array) -> np.ndarray:
    """Places at which a sorted column without nulls takes another value."""
    if len(column) < 2:
        return np.zeros(0, np.int64)
    return np.flatnonzero(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, Bounds]]:
    """Sorted rows again, cut so that no group crosses a batch, with the places where groups begin and the row count."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = _changes(batch.column(key))
        if held and batch.column(key)[0] != held[-1].column(key)[0]:
            cuts = np.concatenate([[0], cuts])
        if not len(cuts):
            held.append(batch)
            continue
        yield _joined([*held, batch.slice(0, int(cuts[-1]))], key)
        held = [batch.slice(int(cuts[-1]))]
    if held:
        yield _joined(held, key)


def _joined(parts: list[pa.RecordBatch], key: str) -> tuple[pa.RecordBatch, Bounds]:
    whole = pa.Table.from_batches([p for p in parts if p.num_rows]).combine_chunks().to_batches()[0]
    return whole, [0, *_changes(whole.column(key)).tolist(), whole.num_rows]


def by_group(rows: DataFrame, key: str, order: list[str], kernel: Callable[[pa.RecordBatch, Bounds], pa.RecordBatch], schema: str | T.StructType) -> DataFrame:
    """``kernel`` over the groups of ``key``, whose rows come in ``order``: it takes a batch of groups and their bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_groups(batches, key):
            yield kernel(batch, bounds)

    return rows.repartition(key).sortWithinPartitions(key, *order).mapInArrow(run, schema)
