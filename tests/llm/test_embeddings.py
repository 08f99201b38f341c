import numpy as np
import pytest

from gridweave.llm import embeddings as E


def brute(rows):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = [(i, v / np.linalg.norm(v)) for i, v in good]
    links, root = {}, list(range(len(unit)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(unit)):
        for b in range(a):
            if len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.9:
                links[a] = links.get(a, 0) + 1
                links[b] = links.get(b, 0) + 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    least = {}
    for k, (i, _) in enumerate(unit):
        least[find(k)] = min(least.get(find(k), i), i)
    out = {i: (0, i, i is not None) for i, _ in rows}
    for k, (i, _) in enumerate(unit):
        out[i] = (links.get(k, 0), least[find(k)], least[find(k)] == i)
    return out


def clustered(seed, groups, noise):
    rng = np.random.default_rng(seed)
    rows = []
    for size in groups:
        centre = rng.standard_normal(32)
        rows += [(centre + noise * rng.standard_normal(32)).astype(np.float32).tolist() for _ in range(size)]
    return [(i, v) for i, v in enumerate(rows)]


@pytest.mark.parametrize("hot", [4096, 20])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(E, "HOT", hot)
    rows = clustered(1, [1] * 200 + [2] * 20 + [60, 90], 0.05)
    rows += [(1000, rows[5][1]), (1001, rows[5][1]), (2000, None), (2001, []), (2002, [0.0] * 32), (2003, [float("nan")] * 32), (2004, [1.0, None]), (2005, [float("inf")] * 32), (2006, [3.0] * 7), (2007, [1.5] * 7), (None, [1.0] * 32)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS size", "1 AS codes")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in E.op6_query(df).collect()}
    assert got == brute(rows)
    assert E.op6_query(df.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((1500, 64))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = 0.901
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, cosine * base + (1 - cosine**2) ** 0.5 * side]))]
    got = E.op6_query(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).agg({"n_links": "sum"}).first()[0]
    assert 0.93 <= got / 3000 <= 1.0


def test_collisions_are_windows():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((5, 24)), rng.standard_normal((40, 24))
    assert (E.collisions(a, b) == (np.abs(a[:, None, :] - b[None, :, :]) <= E.WINDOW).sum(axis=2)).all()
