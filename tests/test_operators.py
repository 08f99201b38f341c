import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridweave.operators import spatial
from gridweave.operators.graph import connected_components
from gridweave.operators.linkage import capped_linkage, greedy_match, link
from gridweave.operators.spatial import nearest_within, pairs_within
from gridweave.plans.powerflow import linear_flow_report


def components(pairs):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_connected_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 40)]
    rows = [*pairs, (5, 5), (None, 3), (7, None), *pairs[:10]]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {k: v for k, v in components([p for p in pairs if p[0] != p[1]]).items()}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def points(n, seed, size):
    rng = random.Random(seed)
    return [(i, rng.uniform(-size, size), rng.uniform(-size, size)) for i in range(n)]


def test_distance_joins(spark):
    rows = points(150, 1, 1000)
    df = spark.createDataFrame(rows, "id long, x double, y double")
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if np.hypot(a[1] - b[1], a[2] - b[2]) <= 150}
    assert {(r.a, r.b) for r in pairs_within(df, "id", 150.0).collect()} == want
    others = df.withColumnRenamed("id", "o")
    got = {r.id: r.o for r in nearest_within(df, "id", others.where("o % 3 = 0"), "o", 400.0).collect()}
    for i, x, y in rows:
        near = min(((np.hypot(x - u, y - v), j) for j, u, v in rows if j % 3 == 0 and np.hypot(x - u, y - v) <= 400), default=None)
        assert got.get(i) == (near[1] if near else None)


def test_capped_linkage_equals_the_sequential_rule(spark):
    rows = points(200, 2, 800)
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r.id: r.cluster for r in capped_linkage(df, 120.0, 300.0).collect()}
    whole = link(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 120.0, 300.0)
    assert got == {i: whole[i] for i in range(len(rows))}
    seeded = df.join(spark.createDataFrame(list(got.items()), "id long, seed long"), "id")
    again = {r.id: r.cluster for r in capped_linkage(seeded, 200.0, 500.0, "seed").collect()}
    assert again == dict(enumerate(link(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 200.0, 500.0, [got[i] for i in range(len(rows))])))


def test_greedy_match(spark):
    pairs = [(1, 2, 1.0), (2, 3, 0.5), (3, 4, 2.0), (5, 6, 1.0), (5, 7, 1.0)]
    got = sorted(tuple(r) for r in greedy_match(spark.createDataFrame(pairs, "a long, b long, d double")).collect())
    assert got == [(2, 3, 0.5), (5, 6, 1.0)]


def test_power_flow(spark):
    lines = [("l1", "a", "b", 1.0, 400.0), ("l2", "b", "c", 2.0, 400.0), ("l3", "a", "c", 1.0, 400.0), ("l4", "x", "y", 1.0, 400.0)]
    buses = spark.createDataFrame([(b,) for b in "abcxy"], "bus_id string")
    row = linear_flow_report(buses, spark.createDataFrame(lines, "line_id string, bus0 string, bus1 string, x_ohm double, voltage_kv double")).first()
    assert row.buses == 3 and row.branches == 3 and row.max_residual_mw < 1e-8
    assert row.injected_mw == pytest.approx(row.withdrawn_mw)


def test_ranked(spark):
    from gridweave.operators.ranking import ranked

    rng = random.Random(8)
    rows = [(i, rng.randrange(20)) for i in range(500)]
    got = ranked(spark.createDataFrame(rows, "id long, v long").repartition(7), "n", "v", "id").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert sorted(r.n for r in got) == list(range(500))
    assert ranked(spark.createDataFrame([], "id long"), "n", "id").count() == 0


@pytest.mark.parametrize("size", [500, 160])
def test_rounds_equal_the_sequential_rules(spark, monkeypatch, size):
    """Components above the bound of a task, up to all points in one, are settled in rounds with the same result."""
    from gridweave.operators import linkage

    rows = points(70, size, size)
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    df = spark.createDataFrame(rows, "id long, x double, y double")
    pairs = pairs_within(df, "id", 120.0)
    seeds = [i - i % 3 if i < 30 else i for i in range(len(rows))]
    seeded = df.withColumn("seed", F.when(F.col("id") < 30, F.col("id") - F.col("id") % 3).otherwise(F.col("id")))
    want = sorted(tuple(r) for r in greedy_match(pairs).collect())
    monkeypatch.setattr(linkage, "GROUP_ROWS", 5)
    assert sorted(tuple(r) for r in greedy_match(pairs).collect()) == want
    whole = link(x, y, 120.0, 300.0)
    assert {r.id: r.cluster for r in capped_linkage(df, 120.0, 300.0).collect()} == dict(enumerate(whole))
    assert {r.id: r.cluster for r in capped_linkage(seeded, 120.0, 300.0, "seed").collect()} == dict(enumerate(link(x, y, 120.0, 300.0, seeds)))


def test_whole_groups():
    import pyarrow as pa

    from gridweave.operators.groups import whole_groups

    rng = random.Random(3)
    keys = sorted(rng.choices("abcdefg", k=200))
    cuts = sorted(rng.sample(range(201), 30))
    batches = [pa.record_batch({"k": keys[i:j], "n": list(range(i, j))}, schema=pa.schema([("k", pa.string()), ("n", pa.int64())])) for i, j in zip([0, *cuts], [*cuts, 200])]
    got = []
    for batch, bounds in whole_groups(iter(batches), "k"):
        for i, j in zip(bounds[:-1], bounds[1:]):
            assert len(set(batch.column("k").to_pylist()[i:j])) == 1
            got.append((batch.column("k")[i].as_py(), batch.column("n").to_pylist()[i:j]))
    assert got == [(k, [i for i, x in enumerate(keys) if x == k]) for k in sorted(set(keys))]


def test_running_sums(spark):
    from gridweave.operators.ranking import running_sums

    rng = random.Random(9)
    rows = [(i, rng.randrange(9)) for i in range(300)]
    got = {r.id: r.s for r in running_sums(spark.createDataFrame(rows, "id long, v long").repartition(5), "s", "v", "id").collect()}
    assert got == dict(enumerate(itertools.accumulate(v for _, v in rows)))


def test_nearest_looks_further_only_where_nothing_is_near(spark, monkeypatch):
    points = spark.createDataFrame([(i, float(x), 0.0) for i, x in enumerate((0, 500, 2400, 9000, 30000))], "id long, x double, y double")
    others = spark.createDataFrame([(i, float(x), 0.0) for i, x in enumerate((1, 1, 900, 4000, 19000))], "bus long, x double, y double")
    seen, nearest = [], spatial._nearest
    monkeypatch.setattr(spatial, "_nearest", lambda left, *rest: (seen.append(left.count()), nearest(left, *rest))[1])
    found = {r["id"]: (r["bus"], r["d"]) for r in spatial.nearest_within(points, "id", others, "bus", 10_000.0).collect()}
    assert found == {0: (0, 1.0), 1: (2, 400.0), 2: (2, 1500.0), 3: (3, 5000.0)}
    assert seen == [5, 3, 2]


def test_matching_in_bands_equals_matching_of_all_pairs(spark, monkeypatch):
    from gridweave.operators import linkage

    rows = [(i, float(round(x)), float(round(y)), i % 2) for i, x, y in points(120, 4, 60)]
    df = spark.createDataFrame(rows, "id long, x double, y double, g int")
    pairs = sorted((np.hypot(p[1] - q[1], p[2] - q[2]), p[0], q[0]) for p, q in itertools.combinations(rows, 2) if p[3] == q[3])
    used, want = set(), []
    for d, a, b in pairs:
        if d <= 60 and not {a, b} & used:
            used |= {a, b}
            want.append((a, b, d))
    seen, within = [], linkage.pairs_within
    monkeypatch.setattr(linkage, "pairs_within", lambda *args: (seen.append(args[2]), within(*args))[1])
    assert sorted(tuple(r) for r in linkage.greedy_match_within(df, 60.0, ("g",)).collect()) == sorted(want)
    assert len(seen) > 1 and seen[-1] == 60.0


def test_linkage_in_bands_equals_linkage_of_all_pairs(spark, monkeypatch):
    from gridweave.operators import linkage

    rows = [(i, float(round(x)), float(round(y))) for i, x, y in points(150, 6, 60)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    seen, within = [], linkage.pairs_within
    monkeypatch.setattr(linkage, "pairs_within", lambda *args, **more: (seen.append((args[0].count(), args[2])), within(*args, **more))[1])
    got = {r.id: r.cluster for r in capped_linkage(df, 40.0, 50.0).collect()}
    assert got == dict(enumerate(link(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), 40.0, 50.0)))
    assert len(seen) > 1 and seen[-1][1] == 40.0 and seen[-1][0] < seen[0][0] == len(rows)
