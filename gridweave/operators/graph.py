"""Connected components as alternating star contractions.

Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and Beyond") move every edge towards
the smallest identifier of its component. Each round is one aggregation and one join over the remaining edges; the number
of rounds grows with the logarithm of the node count, not with the diameter. A hub with very many edges stays cheap: the
minimum is combined before the shuffle and the join is a plain equi-join that adaptive execution can split. Whether a round
changed anything is observed while it is written, without another pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridweave.plans.storage import dealt, materialise, release

MAX_ROUNDS = 60


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(dealt(least, rows), "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("a"), F.least("u", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(dealt(least, rows), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and their number and a sum of their hashes."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    out = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashes.alias("h")), "edges")
    return out, (seen.get["n"], seen.get["h"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label the nodes of an undirected graph.

    ``edges`` has two columns of one orderable type. Null ends and self-loops are ignored, so a node with no other
    neighbour is absent from the result; join it back with ``coalesce``. Returns ``node, component`` with one row per
    node that has an edge; ``component`` is the smallest node of its component (the node itself included).
    """
    current, state = _stored(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where("a <> b")
        .distinct()
    )
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        following, reached = _stored(_small_star(_large_star(current, state[0]), state[0]))
        release(current)
        current = following
        if reached == state:
            break
        state = reached
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return dealt(current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots), state[0])
