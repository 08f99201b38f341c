"""Linear power flow as a structural probe of a backbone: does the network carry balanced injections without a residual?"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.operators.graph import connected_components
from gridweave.plans.storage import materialise

#: A backbone is solved in one task; larger ones are refused, not cut. (All buses of 220 kV and more on Earth are fewer.)
MAX_BUSES = 2_000_000
REPORT = "buses long, branches long, injected_mw double, withdrawn_mw double, max_flow_mw double, max_residual_mw double, iterations int"


def within_buses(edges: DataFrame, buses: DataFrame) -> DataFrame:
    """Edges with both ends in the set."""
    out = edges
    for e in ("bus0", "bus1"):
        out = out.join(buses.select(F.col("bus_id").alias(e)).distinct(), e, "left_semi")
    return out


def largest_component(buses: DataFrame, edges: DataFrame) -> DataFrame:
    """``bus_id`` of the component with most buses; of equal ones that of the smallest label."""
    labels = connected_components(within_buses(edges, buses), "bus0", "bus1")
    best = labels.groupBy("component").count().orderBy(F.desc("count"), "component").limit(1)
    return labels.join(best.select("component"), "component", "left_semi").select(F.col("node").alias("bus_id"))


def conjugate_gradient(a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int, rhs: np.ndarray, tolerance: float = 1e-12) -> tuple[np.ndarray, int]:
    """Potentials of a weighted graph Laplacian for balanced injections, Jacobi-preconditioned."""
    diagonal = np.bincount(a, weight, n) + np.bincount(b, weight, n)

    def multiply(x: np.ndarray) -> np.ndarray:
        flow = weight * (x[a] - x[b])
        return np.bincount(a, flow, n) - np.bincount(b, flow, n)

    x, r = np.zeros(n), rhs.copy()
    z = r / diagonal
    p, rz = z.copy(), float(r @ z)
    goal = tolerance * max(float(np.abs(rhs).max()), 1e-300)
    for step in range(1, 20 * n + 100):
        q = multiply(p)
        alpha = rz / float(p @ q)
        x += alpha * p
        r -= alpha * q
        if np.abs(r).max() <= goal:
            return x, step
        z = r / diagonal
        following = float(r @ z)
        p = z + following / rz * p
        rz = following
    raise RuntimeError(f"no solution after {step} steps: residual {np.abs(r).max():.3g} MW")


def solve(branches: pd.DataFrame, injections: int = 400, limit_mw: float = 10.0, seed: int = 1) -> pd.DataFrame:
    """Seeded injections at random buses, balanced, and the report of the flow they cause."""
    names, index = np.unique(np.concatenate([branches["bus0"], branches["bus1"]]), return_inverse=True)
    n = len(names)
    a, b = index[: len(branches)], index[len(branches) :]
    keep = a != b
    kv = branches["voltage_kv"].to_numpy(float)[keep]
    weight = kv**2 / branches["x_ohm"].to_numpy(float)[keep]
    a, b = a[keep], b[keep]
    rng = np.random.default_rng(seed)
    rhs = np.zeros(n)
    chosen = rng.choice(n, min(injections, n), replace=False)
    rhs[chosen] = rng.uniform(-limit_mw, limit_mw, len(chosen))
    rhs[chosen] -= rhs[chosen].mean()
    angle, steps = conjugate_gradient(a, b, weight, n, rhs)
    flow = weight * (angle[a] - angle[b])
    residual = np.abs(np.bincount(a, flow, n) - np.bincount(b, flow, n) - rhs).max()
    row = (n, len(a), float(rhs[rhs > 0].sum()), float(-rhs[rhs < 0].sum()), float(np.abs(flow).max()), float(residual), int(steps))
    return pd.DataFrame([row], columns=[c.split()[0] for c in REPORT.split(", ")])


def linear_flow_report(buses: DataFrame, lines: DataFrame, seed: int = 1) -> DataFrame:
    """Solve the largest component of ``lines`` (``bus0, bus1, x_ohm, voltage_kv``) over ``buses``: one report row."""
    lines = materialise(within_buses(lines, buses).where("x_ohm > 0"), "backbone")
    inside = materialise(within_buses(lines, largest_component(buses, lines)), "largest")
    parallel = inside.groupBy(F.least("bus0", "bus1").alias("bus0"), F.greatest("bus0", "bus1").alias("bus1"), "voltage_kv")
    merged = parallel.agg((1 / F.sum(1 / F.col("x_ohm"))).alias("x_ohm"))
    if inside.select("bus0").distinct().count() > MAX_BUSES:
        raise ValueError(f"a backbone above {MAX_BUSES} buses is not solved in one task")
    return merged.groupBy(F.lit(0).alias("all")).applyInPandas(lambda rows: solve(rows, seed=seed), REPORT)
