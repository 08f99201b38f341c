"""Embedding near-duplicates by collision-counting projections.

Two vectors link at cosine COSINE or more. Every unit vector is projected on LINES random lines. On each line, in sorted
order, a query's window is the run of vectors within WINDOW of the query; a pair collides once for each line on which one
lies in the other's window. Two unit vectors at cosine c differ on a Gaussian line by N(0, 2 - 2c), so the collisions of a
linked pair are at least binomial: NEED is the largest count that a pair at exactly COSINE reaches with probability
COUNT_RECALL. Pairs that reach it are verified by their cosine in double precision; no pair below COSINE links.

Who meets whom. Sorting all vectors on every line would compare a constant share of all pairs, so the lines are counted
inside cells: a table cuts the space by the signs of BITS further projections (BITS follows the number of vectors, so cells
keep about CELL members), and the number of tables is set by the probability that a pair at exactly COSINE shares a cell of
one of them, for TABLE_RECALL. A pair is counted in the first table that has both in one cell, which both rows' codes tell
without looking at other cells, so links are added up from cells without listing pairs. A cell above HOT members is cut into
blocks, and each pair of blocks is a task of its own. A cell sends per member its links and its root in the cell.

Equal vectors are one class (counted with their number), so copies of one vector cost one row. Components are contracted
in Spark over classes.

Defined results: null, empty and zero vectors, and those with null or non-finite components, link with nothing; vectors of
different lengths never link; rows with a null id link with nothing and have a null component; rows of one repeated id are
each counted as vectors; a pair at exactly COSINE links; vectors of any length are taken whole; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.textblock import in_batches
from gridweave.operators.graph import connected_components
from gridweave.plans.storage import materialise

COSINE = 0.9
LINES = 24
WINDOW = 0.45
COUNT_RECALL = 0.99
TABLE_RECALL = 0.97
CELL = 64
MAX_BITS = 30
HOT = 4096
SEED = 20240229
#: What names a cell, and a pair of its blocks.
KEYS = ("t", "code", "d", "i", "j")


def needed_collisions() -> int:
    p = erf(WINDOW / sqrt(2 - 2 * COSINE) / sqrt(2))
    tail, need = 1.0, 0
    while True:
        tail -= comb(LINES, need) * p**need * (1 - p) ** (LINES - need)
        if tail < COUNT_RECALL:
            return need
        need += 1


NEED = needed_collisions()


def tables_for(vectors: int) -> tuple[int, int]:
    """(bits, tables) for a number of distinct vectors."""
    bits = min(max(ceil(log2(max(vectors, 1) / CELL)), 0), MAX_BITS)
    meet = (1 - acos(COSINE) / pi) ** bits
    return bits, 1 if meet >= TABLE_RECALL else ceil(log(1 - TABLE_RECALL) / log(1 - meet))


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: row numbers and unit vectors in double precision."""
    lengths = np.diff(column.offsets.to_numpy().astype(np.int64))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    out = {}
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        x = values[starts[rows][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[d] = rows, x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def _lines(d: int, count: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, salt, d]).standard_normal((d, count))


def _code_task(bits: int, tables: int):  # noqa: ANN202
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int32)
        for batch in batches:
            codes, lengths = np.zeros((batch.num_rows, tables), np.int32), np.zeros(batch.num_rows, np.int32)
            for d, (rows, x) in _matrix(batch.column("embedding")).items():
                signs = (x @ _lines(d, bits * tables, 1) > 0).reshape(len(rows), tables, bits)
                codes[rows], lengths[rows] = signs @ weights, d
            yield batch.append_column("codes", pa.array(list(codes), pa.list_(pa.int32()))).append_column("d", pa.array(lengths))

    return code


def collisions(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of lines on which each row of ``b`` is in the window of each row of ``a`` (projections, rows by lines)."""
    counts = np.zeros(len(a) * len(b), np.int8)
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j], kind="stable")
        line = b[order, j]
        low = np.searchsorted(line, a[:, j] - WINDOW, side="left")
        size = np.searchsorted(line, a[:, j] + WINDOW, side="right") - low
        run = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        counts[np.repeat(np.arange(len(a)) * len(b), size) + order[run]] += 1
    return counts.reshape(len(a), len(b))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable over the pairs."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return root


def cell_links(x: np.ndarray, codes: np.ndarray, size: np.ndarray, block: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """(links, root position) of the members of a cell; ``codes`` are those of the tables before, where a pair with an equal
    one has been counted; ``across``: only pairs of different blocks count.
    """
    lines = x @ _lines(x.shape[1], LINES, 0)
    links, firsts, seconds = np.zeros(len(x), np.int64), [], []
    step = 2048
    for i in range(0, len(x), step):
        for j in range(i, len(x), step):
            at, to = np.nonzero(collisions(lines[i : i + step], lines[j : j + step]) >= NEED)
            at, to = at + i, to + j
            good = at < to
            if across:
                good &= block[at] != block[to]
            at, to = at[good], to[good]
            good = np.einsum("ij,ij->i", x[at], x[to]) >= COSINE
            at, to = at[good], to[good]
            good = ~(codes[at] == codes[to]).any(axis=1)
            firsts.append(at)
            seconds.append(to)
            np.add.at(links, at[good], size[to[good]])
            np.add.at(links, to[good], size[at[good]])
    return links, _roots(len(x), np.concatenate(firsts), np.concatenate(seconds))


def _cell_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in cell order; a cell may continue in the next batch."""
    held: pa.Table | None = None

    def cells(rows: pa.Table) -> pa.RecordBatch:
        keys = np.stack([rows.column(c).to_numpy() for c in KEYS])
        bounds = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), rows.num_rows]
        name, count, root = [], [], []
        size, block, ck = (rows.column(c).to_numpy() for c in ("size", "block", "ck"))
        for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
            if stop - start > 1:
                part = rows.slice(start, stop - start)
                ((_, x),) = _matrix(part.column("embedding").combine_chunks()).values()
                codes = part.column("codes").combine_chunks()
                codes = codes.flatten().to_numpy().reshape(stop - start, -1)
                links, roots = cell_links(x, codes, size[start:stop], block[start:stop], keys[3, start] != keys[4, start])
                own = ck[start:stop]
                some = np.flatnonzero((links > 0) | (roots != np.arange(len(roots))))
                name.append(own[some])
                count.append(links[some])
                root.append(own[roots[some]])
        return pa.record_batch({k: pa.array(np.concatenate([np.zeros(0, np.int64), *v])) for k, v in (("ck", name), ("links", count), ("root", root))})

    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        if not rows.num_rows:
            continue
        keys = np.stack([rows.column(c).to_numpy() for c in KEYS])
        other = np.flatnonzero((keys != keys[:, -1:]).any(axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield cells(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield cells(held)


def classes(vectors: DataFrame) -> DataFrame:
    """``ck, least, size, embedding``: the distinct vectors that can link."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & finite & F.exists(x, lambda v: v != 0))
    return usable.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size")).select(F.xxhash64("embedding").alias("ck"), "least", "size", "embedding")


def class_links(distinct: DataFrame) -> DataFrame:
    """``ck, links, root``: what each cell says of its members; links to copies outside the class, root for components."""
    bits, tables = tables_for(distinct.count())
    schema = distinct.schema.simpleString()[len("struct<") : -1]
    coded = materialise(in_batches(distinct, _code_task(bits, tables), schema + ",codes:array<int>,d:int"), "codes")
    # A row takes along the codes of the tables before only, which are all that the count of a pair depends on.
    cell = coded.select("ck", "size", "embedding", "codes", "d", F.posexplode("codes").alias("t", "code"))
    cell = cell.withColumn("codes", F.slice("codes", 1, F.col("t")))
    narrow = coded.select("ck", "d", F.posexplode("codes").alias("t", "code"))
    sizes = narrow.groupBy("t", "code", "d").agg(F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("blocks"))
    hot = materialise(sizes.where("blocks > 1"), "hot")
    if hot.limit(1).count():
        placed = cell.join(hot, ["t", "code", "d"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        placed = placed.withColumn("block", F.pmod(F.xxhash64("ck", F.lit(1)), "blocks").cast("int"))
        placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with"))
    else:
        placed = cell.withColumn("block", F.lit(0)).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    rows = placed.select(*KEYS, "block", "ck", "size", "embedding", "codes")
    dealt = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "ck")
    return in_batches(dealt, _cell_task, "ck long, links long, root long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    vectors = vectors.select("vec_id", "embedding")
    distinct = materialise(classes(vectors), "classes")
    found = materialise(class_links(distinct), "links")
    counts = found.groupBy("ck").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("ck <> root"), "ck", "root").select(F.col("node").alias("ck"), "component")
    sized = distinct.select("ck", "least", "size").join(counts, "ck", "left").join(labels, "ck", "left")
    sized = sized.select("ck", "least", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "ck").alias("component"))
    least = sized.groupBy("component").agg(F.min("least").alias("component_id"))
    known = materialise(sized.join(least, "component").select("ck", "links", "component_id"), "known")
    rows = vectors.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.xxhash64("embedding")).alias("ck"))
    out = rows.join(known, "ck", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op6_query(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)
