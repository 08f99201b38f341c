"""Order-dependent clustering of points, decomposed so that it runs in parallel.

Capped single linkage joins pairs closest first and refuses a union whose bounding box would be wider than a cap; greedy
matching takes pairs closest first and uses each end once. Both only ever touch pairs within a tolerance, so the connected
components of the pair graph are independent of each other, and inside a component of at most GROUP_ROWS rows the sequential
rule runs as it is, with ties broken by the points' own order.

Points that are dense enough percolate into one huge component. There the rule runs in rounds over the whole table: a pair
that comes first of all pairs at both of its ends (points, or clusters so far) cannot be affected by any other pair, so all
such pairs are settled at once. The first pair of all is always among them, and the result is that of the sequential rule.

No pair is affected by a longer one, so dense points are matched in bands of distance: what a band has matched takes no part
in the next, which is wider as fewer points are left. That keeps both the pairs and the components of a band small. Linkage goes
in bands too: a band takes the clusters of the bands before it, and only pairs of two clusters that keep within the cap, which
are few where clusters have grown to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.operators.graph import connected_components
from gridweave.operators.groups import by_group
from gridweave.operators.spatial import meetings, pairs_within, point_cells
from gridweave.plans.storage import dealt, materialise, release

#: Rows of a component that one task takes; larger components are worked on in rounds.
GROUP_ROWS = 100_000
#: Neighbours of a point that a band of distance is to have on average; twice as many make huge components.
NEIGHBOURS = 2.0


def close_pairs(x: np.ndarray, y: np.ndarray, reach: float) -> Iterable[tuple[float, int, int]]:
    """(distance, i, j) of all pairs within reach, i < j, by a sweep over x."""
    order = np.argsort(x, kind="stable")
    stop = np.searchsorted(x[order], x[order] + reach, side="right")
    out = []
    for k in range(len(order)):
        near = order[k + 1 : stop[k]]
        if len(near):
            i = order[k]
            d = np.hypot(x[near] - x[i], y[near] - y[i])
            out += [(float(v), int(min(i, j)), int(max(i, j))) for v, j in zip(d, near, strict=True) if v <= reach]
    return sorted(out)


def link(x: np.ndarray, y: np.ndarray, reach: float, cap: float, seed: list | None = None) -> list[int]:
    """Group (position of a member) of each point; ``seed`` has a label per point, equal labels start together.

    The sequential rule as it stands, which ``capped_linkage`` is held against.
    """
    root = list(range(len(x)))
    box = [[x[i], y[i], x[i], y[i]] for i in range(len(x))]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def union(i: int, j: int, limit: float) -> None:
        i, j = sorted((find(i), find(j)))
        if i == j:
            return
        a, b = box[i], box[j]
        wide = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
        if np.hypot(wide[2] - wide[0], wide[3] - wide[1]) > limit:
            return
        root[j], box[i] = i, wide

    first: dict = {}
    for i, label in enumerate(seed if seed is not None else []):
        union(first.setdefault(label, i), i, np.inf)
    for _, i, j in close_pairs(x, y, reach):
        union(i, j, cap)
    return [find(i) for i in range(len(x))]


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of components up to GROUP_ROWS, and of larger ones (None if there are none)."""
    large = materialise(rows.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_ROWS).select("component"), "large")
    if not large.limit(1).count():
        release(large)
        return rows, None
    return rows.join(large, "component", "left_anti"), rows.join(large, "component", "left_semi")


def _link_clusters(one: list, two: list, box_one: list, box_two: list, cap: float) -> list[tuple]:
    """(cluster, smallest cluster it is joined with, box) of pairs of clusters that come in order; joined ones only."""
    root, box = {}, {}
    for label, corners in zip([*one, *two], [*box_one, *box_two], strict=True):
        root[label], box[label] = label, corners
    grown = set()

    def find(i):  # noqa: ANN001, ANN202
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(one, two, strict=True):
        i, j = sorted((find(i), find(j)))
        if i == j:
            continue
        a, b = box[i], box[j]
        both = [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])]
        wide, tall = both[2] - both[0], both[3] - both[1]
        if math.sqrt(wide * wide + tall * tall) <= cap:
            root[j], box[i] = i, both
            grown.add(i)
    ends = ((label, find(label)) for label in root)
    return [(label, end, *box[end]) for label, end in ends if end in grown]


BOX = ("w", "s", "e", "n")


def capped_linkage(points: DataFrame, reach: float, cap: float, seed: str | None = None) -> DataFrame:
    """``id, cluster`` of points ``id, x, y``; ``seed`` names a column of earlier clusters that stay together.

    ``cluster`` is the smallest id of the cluster. A point without neighbours is a cluster of its own.
    """
    if seed:
        start = points.select("id", "x", "y", F.coalesce(seed, "id").alias("seed"))
        boxes = start.groupBy("seed").agg(F.min("id").alias("cluster"), F.min("x").alias("w"), F.min("y").alias("s"), F.max("x").alias("e"), F.max("y").alias("n"))
        own = start.join(dealt(boxes), "seed").drop("seed")
    else:
        own = points.select("id", "x", "y", F.col("id").alias("cluster"), F.col("x").alias("w"), F.col("y").alias("s"), F.col("x").alias("e"), F.col("y").alias("n"))
    own, upto = materialise(own, "points"), 0.0
    while upto < reach:
        first = not upto
        upto = min(reach, _band(own, reach, ()) if first else upto * 1.5)
        pairs = materialise(_open_pairs(own if first else _open_points(own, upto, cap), upto, cap, first and not seed), "pairs")
        n = pairs.count()
        if n:
            grown = own.join(dealt(_joined(pairs, n, cap)), "cluster", "left")
            grown = grown.select("id", "x", "y", F.coalesce("into", "cluster").alias("cluster"), *[F.coalesce(f"{c}_", c).alias(c) for c in BOX])
            if upto < reach:
                grown = materialise(grown, "points")
                release(own)
                release(pairs)
            own = grown
    return own.select("id", "cluster")


def _diagonal(*names: str) -> Column:
    """The diagonal of the box around two boxes, whose columns are named by patterns."""
    low, high = ({c: f(*[n.format(c) for n in names]) for c in BOX} for f in (F.least, F.greatest))
    wide, tall = high["e"] - low["w"], high["n"] - low["s"]
    return F.sqrt(wide * wide + tall * tall)


def _open_points(own: DataFrame, upto: float, cap: float) -> DataFrame:
    """The points of clusters that meet another in a cell nearby with which they keep within the cap."""
    placed = point_cells(own, upto * (1 + 1e-9))
    cells = placed.groupBy("cluster", "cx", "cy").agg(*[F.first(c).alias(c) for c in BOX]).withColumns({"at_x": F.col("cx"), "at_y": F.col("cy")})
    met = meetings(cells, "cluster", ["at_x", "at_y", *BOX]).where(_diagonal("u_{}", "v_{}") <= cap)
    sides = [met.select(F.col(f"{e}_cluster").alias("cluster"), F.col(f"{e}_at_x").alias("cx"), F.col(f"{e}_at_y").alias("cy")) for e in "uv"]
    return placed.join(dealt(sides[0].unionByName(sides[1]).distinct()), ["cluster", "cx", "cy"], "left_semi").drop("cx", "cy")


def _open_pairs(own: DataFrame, upto: float, cap: float, single: bool) -> DataFrame:
    """``ca, cb``, their boxes and ``d, a, b``: the first pair of points of any two clusters that keep within the cap.

    Of the pairs of two clusters the first decides: what is refused once stays refused, as boxes only grow. ``single``: every
    point is a cluster.
    """
    if single:
        met = pairs_within(own, "id", upto, carry=("x", "y"))
        sides = [F.col(f"{'x' if c in 'we' else 'y'}_{e}").alias(f"{c}_{e}") for e in "ab" for c in BOX]
        met = met.select(F.col("a").alias("ca"), F.col("b").alias("cb"), "d", "a", "b", *sides)
        return met.where(_diagonal("{}_a", "{}_b") <= cap)
    met = pairs_within(own, "id", upto, (), ("cluster",), ("cluster", *BOX)).where(_diagonal("{}_a", "{}_b") <= cap)
    swap = F.col("cluster_a") > F.col("cluster_b")
    sides = [F.when(swap, F.col(f"{c}_{f}")).otherwise(F.col(f"{c}_{e}")).alias(f"{c}_{e}") for e, f in ("ab", "ba") for c in BOX]
    ends = [F.least("cluster_a", "cluster_b").alias("ca"), F.greatest("cluster_a", "cluster_b").alias("cb")]
    least = met.select(*ends, F.struct("d", "a", "b", *sides).alias("p")).groupBy("ca", "cb").agg(F.min("p").alias("p"))
    return least.select("ca", "cb", "p.*")


def _joined(pairs: DataFrame, n: int, cap: float) -> DataFrame:
    """``cluster, into, w_, s_, e_, n_`` of the clusters that ``n`` pairs join: the smallest of the cluster and its box."""
    kind = dict(pairs.dtypes)["ca"]

    def run(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
        ends = [batch.column(c).to_pylist() for c in ("ca", "cb")]
        boxes = [np.column_stack([batch.column(f"{c}_{e}").to_numpy() for c in BOX]).tolist() for e in "ab"]
        rows = [row for i, j in zip(bounds[:-1], bounds[1:], strict=True) for row in _link_clusters(*[column[i:j] for column in (*ends, *boxes)], cap)]
        columns = list(zip(*rows, strict=True)) or [()] * (2 + len(BOX))
        types = [batch.schema.field("ca").type] * 2 + [pa.float64()] * len(BOX)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["cluster", "into", *[f"{c}_" for c in BOX]])

    text = ", ".join([f"cluster {kind}, into {kind}", *[f"{c}_ double" for c in BOX]])
    if n <= GROUP_ROWS:
        return by_group(pairs.withColumn("component", F.lit(0)), "component", ["d", "a", "b"], run, text)
    groups = connected_components(pairs, "ca", "cb")
    rows = materialise(pairs.join(groups, pairs["ca"] == groups["node"]).drop("node"), "members")
    small, large = _split(rows)
    done = by_group(small, "component", ["d", "a", "b"], run, text)
    return done if large is None else done.unionByName(_linked_in_rounds(large, cap))


def _first(d: str, a: str, b: str) -> Column:
    return F.struct(F.col(d).alias("d"), F.col(a).alias("a"), F.col(b).alias("b"))


def _settled(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs (with a struct ``p`` that orders them) that come first at both of their ends."""
    sides = pairs.select(F.col(a).alias("end"), "p").unionByName(pairs.select(F.col(b).alias("end"), "p"))
    first = sides.groupBy("end").agg(F.min("p").alias("least"))
    one, two = (first.select(F.col("end").alias(e), F.col("least").alias(n)) for e, n in ((a, "la"), (b, "lb")))
    return pairs.join(dealt(one), a).join(dealt(two), b).where((F.col("p") == F.col("la")) & (F.col("p") == F.col("lb"))).drop("la", "lb")


def _linked_in_rounds(rows: DataFrame, cap: float) -> DataFrame:
    """What ``_joined`` returns, of huge components."""
    sides = [rows.select(F.col(f"c{e}").alias("cluster"), *[F.col(f"{c}_{e}").alias(c) for c in BOX]) for e in "ab"]
    boxes = materialise(sides[0].unionByName(sides[1]).groupBy("cluster").agg(*[F.first(c).alias(c) for c in BOX]), "boxes")
    label = materialise(boxes.select("cluster", F.col("cluster").alias("into")), "label")
    pairs = materialise(rows.select("ca", "cb", _first("d", "a", "b").alias("p")), "pairs")
    while pairs.limit(1).count():
        low, high = (boxes.select(*[F.col(c).alias(f"{c}{k}") for c in BOX], F.col("cluster").alias(f"c{k}")) for k in "ab")
        met = _settled(pairs, "ca", "cb").join(low, "ca").join(high, "cb")
        settled = materialise(met.select("ca", "cb", (_diagonal("{}a", "{}b") <= cap).alias("good")), "settled")
        renamed = settled.where("good").select(F.col("cb").alias("old"), F.col("ca").alias("new"))

        def named(rows: DataFrame, column: str, renamed: DataFrame = renamed) -> DataFrame:
            side = renamed.withColumnRenamed("old", column)
            return rows.join(side, column, "left").withColumn(column, F.coalesce("new", column)).drop("new")

        left = pairs.join(settled.select("ca", "cb"), ["ca", "cb"], "left_anti")
        left = named(named(left, "ca"), "cb").where("ca <> cb").select(F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb"), "p")
        following = materialise(left.groupBy("ca", "cb").agg(F.min("p").alias("p")), "pairs")
        labels = materialise(named(label, "into").select("cluster", "into"), "label")
        grown = named(boxes, "cluster").groupBy("cluster").agg(F.min("w").alias("w"), F.min("s").alias("s"), F.max("e").alias("e"), F.max("n").alias("n"))
        grown = materialise(grown, "boxes")
        for table in (pairs, label, boxes, settled):
            release(table)
        pairs, label, boxes = following, labels, grown
    return label.join(boxes.select(F.col("cluster").alias("into"), *[F.col(c).alias(f"{c}_") for c in BOX]), "into").select("cluster", "into", *[f"{c}_" for c in BOX])


def greedy_match(pairs: DataFrame) -> DataFrame:
    """Of pairs ``a, b, d`` those that closest-first matching takes, each end at most once; ties by (a, b)."""
    kinds = dict(pairs.dtypes)
    schema = f"a {kinds['a']}, b {kinds['b']}, d double"

    def run(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        keep = np.zeros(batch.num_rows, bool)
        for i, j in zip(bounds[:-1], bounds[1:], strict=True):
            used: set = set()
            for k in range(i, j):
                if a[k] not in used and b[k] not in used:
                    keep[k] = True
                    used |= {a[k], b[k]}
        return batch.select(["a", "b", "d"]).filter(pa.array(keep))

    left = materialise(pairs.select("a", "b", F.col("d").cast("double").alias("d")), "left")
    done: list[DataFrame] = []
    while True:
        groups = connected_components(left.select("a", "b"))
        small, large = _split(left.join(groups, left["a"] == groups["node"]).drop("node"))
        done.append(by_group(small, "component", ["d", "a", "b"], run, schema))
        if large is None:
            break
        taken = materialise(_settled(large.select("a", "b", "d", _first("d", "a", "b").alias("p")), "a", "b").select("a", "b", "d"), "taken")
        done.append(taken)
        used = taken.select(F.explode(F.array("a", "b")).alias("end"))
        rest = large.select("a", "b", "d")
        for end in ("a", "b"):
            rest = rest.join(used.withColumnRenamed("end", end), end, "left_anti")
        left = materialise(rest.select("a", "b", "d"), "left")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _band(points: DataFrame, reach: float, keys: tuple[str, ...]) -> float:
    """The distance up to which points have NEIGHBOURS others on average, by the crowding of cells; at most ``reach``."""
    cells = point_cells(points, reach).groupBy("cx", "cy", *keys).agg(F.count(F.lit(1)).cast("double").alias("n"))
    row = cells.agg(F.sum("n").alias("all"), F.sum(F.col("n") * (F.col("n") - 1)).alias("met")).first()
    return reach if not row["met"] else min(reach, reach * math.sqrt(NEIGHBOURS * row["all"] / (math.pi * row["met"])))


def greedy_match_within(points: DataFrame, reach: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """``greedy_match`` of all pairs of points (``id, x, y``) at most ``reach`` apart with equal ``keys``, not all of them made."""
    left, upto, out = points.select("id", "x", "y", *keys), 0.0, None
    while upto < reach:
        upto = min(reach, max(_band(left, reach, keys), upto * 1.5))
        taken = materialise(greedy_match(pairs_within(left, "id", upto, keys)), "taken")
        out = taken if out is None else out.unionByName(taken)
        if upto < reach:
            used = taken.select(F.explode(F.array("a", "b")).alias("id"))
            rest = materialise(left.join(dealt(used), "id", "left_anti"), "left")
            release(left)
            left = rest
    return out
