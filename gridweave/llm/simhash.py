"""SimHash near-duplicates found with BK-trees.

Fingerprints. ASCII-lower-cased words (runs without ASCII white space), shingles of three words, XXH64 with seed 42 of each
shingle, repeats included; a bit is set where more than half of the hashes have it. Fewer than three words make one
shingle of the whole sequence; no words make fingerprint zero, which is linked like any other. One scan without a shuffle.

Links. Two fingerprints link at RADIUS = 2 or fewer differing bits. Equal fingerprints are first merged, so copies cost
nothing further. The 64 bits are cut into SLICES = 6 slices. Two differing bits touch at most two slices, hence any linked
pair agrees on at least four: each distinct fingerprint is sent to the 15 shards named by four slices and their values,
and every linked pair meets in a shard. A shard leaves only 21 or 22 free bits, so even the near copies of one very common
text are spread over many shards. In each shard a BK-tree is built (children keyed by their integer Hamming distance to the
parent); a query follows only edges within RADIUS of its distance. A query ends up in a union-find of its shard, and a
spanning forest of at most one edge per shard member leaves the task, never all pairs. A shard above SHARD_PRINTS members is
cut into blocks, and each pair of blocks is a task of its own.

The trees of all shards together grow with the corpus, so they are not broadcast: a shard's tree and the queries that need
it share a task through one shuffle of (shard, fingerprint) rows.

Components are contracted over distinct fingerprints in Spark; nothing is collected to the driver.

``keep_first``, the pipeline's stage, does not use these links: see there.

Defined results: a null text has no words, as an empty one; texts of any length are hashed whole; a bit that exactly half of
the hashes have is 0; rows with a null id are fingerprinted and take the component of their fingerprint but never name it (a
component of null ids only is null); repeated rows and ids get equal results; an empty table gives an empty table; extra
columns are ignored by the query and kept by ``keep_first``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.hot import in_blocks, split_rows
from gridweave.llm.textblock import blocks, in_batches, texts
from gridweave.llm.words import mixed
from gridweave.operators.graph import connected_components
from gridweave.plans.storage import materialise, release

RADIUS = 2
SHINGLE = 3
SEED = 42
SLICES = 6
#: First bit and bit count of each slice.
BOUNDS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
#: Masks of the slices that a shard fixes: all but RADIUS of them.
MASKS = [sum(((1 << width) - 1) << low for low, width in kept) for kept in combinations(BOUNDS, SLICES - RADIUS)]

#: Members of a shard, or sets of a group, that meet in one block.
SHARD_PRINTS = 50_000
GROUP_SETS = 1_024
#: One row in so many is counted to find shards above SHARD_PRINTS.
COUNTED = 16

#: ``keep_first`` has its own measure: shingles of five words, near copies from this Jaccard similarity on.
KEEP_SHINGLE = 5
KEEP_JACCARD = 0.8
#: At similarity 0.8, 19 of 128 bits differ on average (standard deviation 4).
KEEP_BITS = 128
KEEP_RADIUS = 36
#: Share of the pairs at similarity KEEP_JACCARD that must meet in a shard; closer pairs meet more often.
KEEP_RECALL = 0.995
#: A shard's bits are chosen so that unlike sets fall into groups of about 2^GROUP_BITS.
GROUP_BITS = 9
_SECOND = np.uint64(0xD6E8FEB86659FD93)
#: A second fingerprint of KEEP_BITS must be within KEEP_RADIUS too: of 10^12 unlike pairs some 400,000 pass one, none both.
_AGAIN = np.uint64(0x9FB21C651E98DF25)
#: Members up to which all queries of a shard go down its tree together, and (query, node) pairs held at a time.
BULK, PAIRS = 4_096, 1 << 18


def fingerprint(text: bytes) -> int:
    """SimHash of one text."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    if len(words) > SHINGLE:
        starts, ends = starts[: 1 - SHINGLE], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.fromiter(
        (digest(view[i:j], SEED) for i, j in zip(starts.tolist(), (ends - 1).tolist(), strict=True)), np.uint64, len(starts)
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t) for part in blocks(batch) for t in texts(part.column("text"))]
        more = [c for c in batch.schema.names if c not in ("doc_id", "text")]
        prints = pa.array(np.array(values, np.uint64).view(np.int64))
        yield pa.record_batch([batch.column("doc_id"), prints, *map(batch.column, more)], ["doc_id", "fp", *more])


def fingerprints(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint as a signed long) and further columns of longs."""
    rows = documents.select(F.col("doc_id").cast("long"), "text", *more)
    names = [c for c in rows.columns if c not in ("doc_id", "text")]
    return in_batches(rows, _fingerprint_task, ", ".join(f"{c} long" for c in ("doc_id", "fp", *names)))


class BKTree:
    """A Burkhard-Keller tree over integers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        if self.values:
            at = 0
            while True:
                distance = (self.values[at] ^ value).bit_count()
                below = self.children[at].get(distance)
                if below is None:
                    self.children[at][distance] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of the stored values at most ``radius`` away."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            open_nodes += [node for edge, node in self.children[at].items() if distance - radius <= edge <= distance + radius]
        return found


def shard_forest(values: list[int]) -> list[tuple[int, int]]:
    """Spanning forest (positions) of the links among a shard's values."""
    tree, root, forest = BKTree(), list(range(len(values))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, value in enumerate(values):
        for j in tree.within(value, RADIUS):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                forest.append((i, j))
        tree.insert(value)
    return forest


def _shard_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in the order of shards and blocks; a block may continue in the next batch."""
    held_keys, held_values = np.zeros((4, 0), np.int64), np.zeros(0, np.int64)

    def forest(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        changed = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = np.concatenate([[0], changed])
        stops = np.concatenate([changed, [len(values)]])
        a, b = [], []
        for i in np.flatnonzero(stops - starts > 1).tolist():
            own = values[starts[i] : stops[i]]
            for x, y in shard_forest(own.view(np.uint64).tolist()):
                a.append(own[x])
                b.append(own[y])
        return pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    for batch in batches:
        keys = np.concatenate([held_keys, np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)])], axis=1)
        values = np.concatenate([held_values, batch.column(4).to_numpy()])
        if not len(values):
            continue
        last = int(np.flatnonzero((keys != keys[:, -1:]).any(axis=0))[-1]) + 1 if (keys != keys[:, -1:]).any() else 0
        if last:
            yield forest(keys[:, :last], values[:last])
        held_keys, held_values = keys[:, last:], values[last:]
    if len(held_values):
        yield forest(held_keys, held_values)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect exactly the distinct values of ``fp`` that RADIUS links connect."""
    shards = F.array(*[F.struct(F.lit(k).cast("long").alias("shard"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for k, m in enumerate(MASKS)])
    rows = distinct.select("fp", F.explode(shards).alias("s")).select("s.shard", "s.part", "fp")
    keys = ["shard", "part", "i", "j"]
    rows = in_blocks(rows, ["shard", "part"], "fp", SHARD_PRINTS, COUNTED).select(*keys, "fp")
    return in_batches(rows.repartition(*keys).sortWithinPartitions(*keys, "fp"), _shard_task, "a long, b long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(documents: DataFrame, prints: DataFrame | None = None) -> DataFrame:
    """``doc_id, fp, component_id`` of every document, and further columns of ``prints`` (stored fingerprints)."""
    prints = prints if prints is not None else materialise(fingerprints(documents), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = connected_components(fingerprint_links(classes.select("fp")))
    named = classes.join(labels.withColumnRenamed("node", "fp"), "fp").select("fp", "component", "least")
    least = named.groupBy("component").agg(F.min("least").alias("least_of_component"))
    linked = named.join(least, "component").select("fp", F.col("least_of_component").alias("linked_id"))
    ids = materialise(classes.join(linked, "fp", "left").select("fp", F.coalesce("linked_id", "least").alias("component_id")), "components")
    return prints.join(ids, "fp")


def op3_query(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id``; the fingerprint as 16 lower-case hex digits."""
    return near_duplicates(documents).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles of KEEP_SHINGLE words; fewer words make one shingle, no words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    last = min(len(words), KEEP_SHINGLE) - 1
    places = zip(starts[: len(words) - last].tolist(), (ends[last:] - 1).tolist(), strict=True)
    return np.unique(np.fromiter((digest(view[i:j], SEED) for i, j in places), np.uint64))


def wide_fingerprint(shingles: np.ndarray) -> np.ndarray:
    """Two SimHashes of KEEP_BITS = 128 bits of a shingle set, as four words.

    Where half of the hashes have a bit, the smallest shingle decides: with ties at 0, sets of a few shingles, an even
    number of them, would have mostly zeros and be near each other without sharing anything.
    """
    seeds = np.array([0, _SECOND, _AGAIN, _SECOND ^ _AGAIN], np.uint64)
    bits = np.zeros(2 * KEEP_BITS, np.int64)
    for at in range(0, len(shingles), 1 << 13):
        part = np.stack([mixed(shingles[at : at + (1 << 13)] ^ seed) for seed in seeds], axis=1).view(np.uint8)
        ones = np.unpackbits(part, axis=1, bitorder="little")
        bits += 2 * ones.sum(axis=0, dtype=np.int64) + (ones[0] if at == 0 else 0)
    return np.packbits(bits > len(shingles), bitorder="little").view(np.uint64)


#: Columns of the two fingerprints.
WORDS = ("low", "high", "low2", "high2")


def _set_id(shingles: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(shingles.tobytes()))


def _wide_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, prints = [], []
        for part in blocks(batch):
            for t in texts(part.column("text")):
                shingles = shingle_set(t)
                ids.append(_set_id(shingles))
                prints.append(wide_fingerprint(shingles))
        words = np.array(prints, np.uint64).reshape(-1, len(WORDS)).T
        columns = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in words]
        yield pa.record_batch([batch.column("doc_id"), batch.column("row_hash"), pa.array(ids, pa.int64()), *columns], ["doc_id", "row_hash", "set_id", *WORDS])


def shard_masks(rows: int) -> list[tuple[int, int]]:
    """Bits (two words) that each shard fixes: more bits for more rows, and as many shards as KEEP_RECALL then needs."""
    fixed = min(max(math.ceil(math.log2(max(rows, 1))) - GROUP_BITS, 4), 24)
    agree = 1 - math.acos(2 * KEEP_JACCARD / (1 + KEEP_JACCARD)) / math.pi
    shards = math.ceil(math.log(1 - KEEP_RECALL) / math.log(1 - agree**fixed))
    rng = np.random.default_rng(SEED)
    out = []
    for _ in range(shards):
        mask = sum(1 << int(b) for b in rng.choice(KEEP_BITS, fixed, replace=False))
        out.append((mask & (1 << 64) - 1, mask >> 64))
    return out


class WideTree:
    """The BK-tree of 128-bit fingerprints (two words each) in arrays, built and asked level by level."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.low, self.high = low, high
        parent, self.edge = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        below, at = np.arange(1, len(low)), np.zeros(max(len(low) - 1, 0), np.int64)
        while len(below):
            d = self.apart(below, at)
            _, first, place = np.unique(at * (KEEP_BITS + 1) + d, return_index=True, return_inverse=True)
            child = below[first]
            parent[child], self.edge[child] = at[first], d[first]
            at = child[place]
            deeper = below != at
            below, at = below[deeper], at[deeper]
        self.children = np.argsort(parent[1:], kind="stable") + 1
        self.first = np.searchsorted(parent[self.children], np.arange(len(low) + 1))

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.low[x] ^ self.low[y]).astype(np.int64) + np.bitwise_count(self.high[x] ^ self.high[y])

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, found) of all members (positions) at most ``radius`` from the queries (positions)."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        q, node = queries, np.zeros(len(queries), np.int64)
        while len(q):
            d = self.apart(q, node)
            near = d <= radius
            found.append((q[near], node[near]))
            many = self.first[node + 1] - self.first[node]
            skip = np.repeat(self.first[node] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
            child = self.children[skip + np.arange(len(skip))]
            open_ = np.abs(self.edge[child] - np.repeat(d, many)) <= radius
            q, node = np.repeat(q, many)[open_], child[open_]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def near_forest(low: np.ndarray, high: np.ndarray, *more: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest (positions) of the pairs at most KEEP_RADIUS bits apart, in each of the fingerprints.

    ``more`` has two words for each further fingerprint. What is linked is not asked again.
    """
    n = len(low)
    if n < 2:
        return []
    tree, again = WideTree(low, high), [WideTree.__new__(WideTree) for _ in more[::2]]
    for k, other in enumerate(again):
        other.low, other.high = more[2 * k], more[2 * k + 1]

    def near(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = tree.within(queries, KEEP_RADIUS)
        for other in again:
            good = other.apart(x, y) <= KEEP_RADIUS
            x, y = x[good], y[good]
        return x, y

    asked = np.arange(n)
    if n <= BULK and len(near(asked[:1])[1]) * 2 <= n:
        step = max(PAIRS // n, 1)
        pairs = [near(asked[k : k + step]) for k in range(0, n, step)]
        x, y = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        root = list(range(n))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        out = []
        for a, b in zip(x[x < y].tolist(), y[x < y].tolist(), strict=True):
            i, j = find(a), find(b)
            if i != j:
                root[max(i, j)] = min(i, j)
                out.append((a, b))
        return out
    out, left, count = [], np.ones(n, bool), n
    for start in range(n):
        if not left[start]:
            continue
        queue, left[start] = [start], False
        count -= 1
        while queue and count:
            x = queue.pop()
            hits = near(np.array([x]))[1]
            hits = hits[left[hits]]
            left[hits], count = False, count - len(hits)
            out += [(x, y) for y in hits.tolist()]
            queue += hits.tolist()
    return out


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows again, cut so that no run of equal values of the first ``keys`` columns crosses a batch."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()
        if not rows or not rows[0].num_rows:
            continue
        own = rows[0]
        change = np.zeros(own.num_rows - 1, bool)
        for k in range(keys):
            values = own.column(k).to_numpy()
            change |= values[1:] != values[:-1]
        last = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
        if last:
            yield own.slice(0, last)
        held = own.slice(last)
    if held is not None and held.num_rows:
        yield held


def _starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """First rows of the runs of equal values of the first ``keys`` columns, and the row count."""
    change = np.zeros(batch.num_rows - 1, bool)
    for k in range(keys):
        values = batch.column(k).to_numpy()
        change |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])


def _wide_shard_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in runs(batches, 3):
        starts = _starts(batch, 3)
        ids, *words = (batch.column(k).to_numpy() for k in range(3, 4 + len(WORDS)))
        words = [w.view(np.uint64) for w in words]
        edges = set()
        for i in np.flatnonzero(np.diff(starts) > 1).tolist():
            a, b = int(starts[i]), int(starts[i + 1])
            edges |= {(int(ids[a + x]), int(ids[a + y])) for x, y in near_forest(*(w[a:b] for w in words))}
        yield pa.record_batch({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})


def wide_links(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` of set ids that connect what the wide fingerprints bring together."""
    masks = shard_masks(distinct.count())
    part = lambda c, m: F.col(c).bitwiseAND(F.lit(_signed(m)))
    # Shards whose names collide meet for nothing: what comes together is compared anyway.
    shards = F.array(*[F.xxhash64(F.lit(k), part("low", m), part("high", n)) for k, (m, n) in enumerate(masks)])
    rows = distinct.select(F.explode(shards).alias("shard"), "set_id", *WORDS)
    keys = ["shard", "i", "j"]
    rows = in_blocks(rows, ["shard"], "set_id", SHARD_PRINTS, COUNTED).select(*keys, "set_id", *WORDS)
    return in_batches(rows.repartition(*keys).sortWithinPartitions(*keys), _wide_shard_task, "a long, b long")


def _sets_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch):
            found = [shingle_set(t).view(np.int64) for t in texts(part.column("text"))]
            yield pa.record_batch([*map(part.column, ("component", "i", "j", "set_id")), pa.array(found, pa.list_(pa.int64()))], ["component", "i", "j", "set_id", "shingles"])


def jaccard_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest (positions) of the pairs of sorted sets with a Jaccard similarity of at least KEEP_JACCARD."""
    sizes = np.array([len(s) for s in sets])
    out, left = [], np.arange(len(sets))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            own = left[(np.minimum(sizes[left], sizes[x]) >= KEEP_JACCARD * np.maximum(sizes[left], sizes[x])) & (sizes[left] > 0)]
            if not len(own) or not sizes[x]:
                continue
            values = np.concatenate([sets[y] for y in own.tolist()])
            slot = np.minimum(np.searchsorted(sets[x], values), sizes[x] - 1)
            both = np.add.reduceat((sets[x][slot] == values).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[own])[:-1]]))
            near = both >= KEEP_JACCARD * (sizes[own] + sizes[x] - both)
            hits = own[near].tolist()
            out += [(x, y) for y in hits]
            queue += hits
            left = np.setdiff1d(left, own[near], assume_unique=True)
    return out


def _jaccard_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in runs(batches, 3):
        starts, ids, column = _starts(batch, 3), batch.column(3).to_numpy(), batch.column(4)
        a, b = [], []
        for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            for x, y in jaccard_forest([column[k].values.to_numpy().view(np.uint64) for k in range(i, j)]):
                a.append(ids[i + x])
                b.append(ids[i + y])
        yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_copies(documents: DataFrame, prints: DataFrame) -> DataFrame:
    """``set_id, group``: the distinct shingle sets that are linked to others by Jaccard similarity KEEP_JACCARD.

    ``documents`` have a column ``__row``, which ``prints`` holds as ``row_hash``. Only texts whose set was brought together
    with another one are moved.
    """
    distinct = prints.groupBy("set_id").agg(F.min("row_hash").alias("row_hash"), *[F.first(w).alias(w) for w in WORDS])
    distinct = materialise(distinct, "sets")
    found = connected_components(wide_links(distinct.select("set_id", *WORDS)))
    wanted = found.withColumnRenamed("node", "set_id").join(distinct.select("set_id", "row_hash"), "set_id")
    wanted = in_blocks(wanted.select(F.col("row_hash").alias("__row"), "set_id", "component"), ["component"], "set_id", GROUP_SETS)
    wanted = materialise(wanted, "wanted")
    some, _ = split_rows(documents.select("__row", "text"), wanted, "__row")
    rows = some.join(wanted, "__row").select("component", "i", "j", "set_id", "text")
    sets = in_batches(rows, _sets_task, "component long, i int, j int, set_id long, shingles array<long>")
    keys = ["component", "i", "j"]
    edges = in_batches(sets.repartition(*keys).sortWithinPartitions(*keys), _jaccard_task, "a long, b long")
    groups = connected_components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("group"))
    for table in (distinct, wanted):
        release(table)
    return groups


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each group of near copies, with the columns of ``documents``: the one of the smallest id.

    Near copies have a Jaccard similarity of at least KEEP_JACCARD on their sets of KEEP_SHINGLE-word shingles; groups are
    their connected components. Equal sets are merged first. Sets within KEEP_RADIUS bits of two SimHashes of KEEP_BITS bits
    are found by a BK-tree in each of the shards that fix a sample of the bits, and what they connect is verified exactly; a
    group above GROUP_SETS sets is verified in pairs of blocks.

    Of several rows with that id the one of smallest row hash stays, of equal rows one. Rows with a null id stay only if
    their whole group has none; of the rows of such a group one stays. Rows are told apart by id and row hash. Only rows that
    may have to go (by the low bits of their hash) are moved; the others are passed on by the scan.
    """
    columns = documents.columns
    row_hash = F.xxhash64(*columns)
    rows = documents.select(F.col("doc_id").cast("long"), "text", row_hash.alias("row_hash"))
    prints = materialise(in_batches(rows, _wide_task, "doc_id long, row_hash long, set_id long, " + ", ".join(f"{w} long" for w in WORDS)), "fingerprints")
    groups = near_copies(documents.withColumn("__row", row_hash), prints)
    found = prints.select("doc_id", "row_hash", "set_id").join(groups, "set_id", "left").withColumn("group", F.coalesce("group", "set_id"))
    name = F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")
    first = found.groupBy("group").agg(F.min_by(F.struct("doc_id", "row_hash"), name).alias("k"))
    keep = materialise(first.select(F.col("k.doc_id").alias("__id"), F.col("k.row_hash").alias("__row")), "keep")
    counted = prints.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("n"))
    same = (F.col("row_hash") == F.col("__row")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    doubtful = materialise(counted.join(keep, same, "left").where("n > 1 or __row is null").select("row_hash"), "doubtful")
    marked = documents.withColumn("__row", row_hash)
    some, rest = split_rows(marked, doubtful.withColumnRenamed("row_hash", "__row"), "__row")
    kept = keep.withColumnRenamed("__row", "__key")
    some = some.join(kept, (F.col("__row") == F.col("__key")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi")
    return rest.unionByName(some.dropDuplicates(["__row", "doc_id"])).select(*columns)
