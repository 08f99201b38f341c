"""Comparison of the network with an authoritative source: length, coverage, matched stations, verdict."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.functions import geometry as G
from gridweave.functions import tags as T
from gridweave.operators.linkage import greedy_match
from gridweave.operators.spatial import pairs_within, path_cells
from gridweave.plans.patch import append_common


def route_km_by_class(lines: DataFrame) -> DataFrame:
    """``kv, km`` by voltage class on the ellipsoid, without classes of 0.05 km or less."""

    def km(lons: pd.Series, lats: pd.Series) -> pd.Series:
        return pd.Series([G.geodesic_length(np.column_stack([a, b])) / 1000 for a, b in zip(lons, lats, strict=True)])

    rows = lines.withColumn("km", F.pandas_udf(km, "double")("lons", "lats"))
    return rows.groupBy(T.voltage_class(F.col("voltage_kv")).alias("kv")).agg(F.sum("km").alias("km")).where("km > 0.05")


def coverage(lines: DataFrame, others: DataFrame, radius: float, by_class: bool = False) -> DataFrame:
    """``total_m, covered_m, share`` of ``lines`` within ``radius`` of ``others``; ``key, voltage_kv, xs, ys`` in metres.

    With ``by_class`` only others of a matching voltage class cover; a line without a voltage is then left out.
    """
    ours = lines.where("voltage_kv is not null") if by_class else lines
    size = max(1000.0, radius)
    near = path_cells(ours, size, radius, ["key"]).join(path_cells(others.withColumnRenamed("key", "other"), size, 0.0, ["other"]), ["cx", "cy"]).select("key", "other").distinct()
    theirs = others.select(F.col("key").alias("other"), F.col("voltage_kv").alias("okv"), F.struct("xs", "ys").alias("path"))
    met = near.join(theirs, "other")
    if by_class:
        met = met.join(ours.select("key", "voltage_kv"), "key").where(T.classes_match(T.voltage_class(F.col("voltage_kv")), T.voltage_class(F.col("okv"))))
    grouped = ours.select("key", "xs", "ys").join(met.groupBy("key").agg(F.collect_list("path").alias("paths")), "key", "left")

    def measure(xs: pd.Series, ys: pd.Series, paths: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, own in zip(xs, ys, paths, strict=True):
            line = np.column_stack([a, b])
            covered = G.covered_length(line, [np.column_stack([p["xs"], p["ys"]]) for p in own], radius) if own is not None else 0.0
            out.append((G.length(line), covered))
        return pd.DataFrame(out, columns=["total", "covered"])

    rows = grouped.withColumn("m", F.pandas_udf(measure, "total double, covered double")("xs", "ys", "paths"))
    return rows.agg(F.sum("m.total").alias("total_m"), F.sum("m.covered").alias("covered_m"), (F.sum("m.covered") / F.sum("m.total")).alias("share"))


def station_match(auth: DataFrame, ours: DataFrame, radius: float) -> DataFrame:
    """``a, b, d``: authoritative points with their nearest of ours within ``radius``, closest first, each used once.

    All equally near ones compete; there is no second choice. Inputs are ``id, x, y`` in metres.
    """
    both = auth.select(F.concat(F.lit("a:"), F.col("id").cast("string")).alias("id"), "x", "y").unionByName(ours.select(F.concat(F.lit("b:"), F.col("id").cast("string")).alias("id"), "x", "y"))
    pairs = pairs_within(both, "id", radius).where("a like 'a:%' and b like 'b:%'")
    least = pairs.groupBy("a").agg(F.min("d").alias("least"))
    nearest = pairs.join(least, "a").where("d <= least").select("a", "b", "d")
    found = greedy_match(nearest)
    return found.select(F.substring("a", 3, 1_000_000).alias("a"), F.substring("b", 3, 1_000_000).alias("b"), "d")


def compare(ours: DataFrame, auth: DataFrame, our_points: DataFrame, auth_points: DataFrame, licence: str, geometry: bool = True) -> dict:
    """Coverages both ways, matched stations and the verdict for a region."""
    shares = {}
    for name, (a, b) in {"auth_in_ours": (auth, ours), "ours_in_auth": (ours, auth)}.items():
        for radius in (250.0, 500.0):
            shares[f"{name}_{radius:.0f}m"] = coverage(a, b, radius).first()["share"]
    shares["auth_in_ours_250m_class"] = coverage(auth, ours, 250.0, True).first()["share"]
    matches = {}
    for radius in (250.0, 500.0):
        row = station_match(auth_points, our_points, radius).agg(F.count(F.lit(1)).alias("n"), F.percentile("d", 0.5).alias("median")).first()
        matches[f"stations_{radius:.0f}m"] = row["n"]
        matches[f"median_offset_{radius:.0f}m"] = row["median"]
    spark = ours.sparkSession
    a, o = shares["auth_in_ours_250m"] or 0.0, shares["ours_in_auth_250m"] or 0.0
    verdict = spark.range(1).select(T.verdict(F.lit(licence), F.lit(geometry), F.lit(a), F.lit(o)).alias("v")).first()["v"]
    return shares | matches | {"verdict": verdict}


def gap_fill(candidates: DataFrame, ours: DataFrame, radius: float = 150.0, step: float = 50.0, most: float = 0.4) -> DataFrame:
    """Candidate lines (``key, xs, ys``) of which less than ``most`` of the samples every ``step`` metres lie near ours."""

    def samples(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(xs, ys, strict=True):
            path = np.column_stack([a, b])
            out.append([G.point_at(path, s).tolist() for s in np.arange(0.0, G.length(path) + 1e-9, step)])
        return pd.Series(out)

    points = candidates.select("key", F.posexplode(F.pandas_udf(samples, "array<array<double>>")("xs", "ys")).alias("n", "p"))
    points = points.select("key", "n", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y"))
    size = 500.0
    cells = path_cells(ours.withColumnRenamed("key", "other"), size, radius, ["other"])
    met = points.withColumn("cx", F.floor(F.col("x") / size)).withColumn("cy", F.floor(F.col("y") / size)).join(cells, ["cx", "cy"])
    met = met.join(ours.select(F.col("key").alias("other"), "xs", "ys"), "other")

    def away(x: pd.Series, y: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([G.foot(np.column_stack([a, b]), np.array([u, v]))[1] for u, v, a, b in zip(x, y, xs, ys, strict=True)])

    near = met.where(F.pandas_udf(away, "double")("x", "y", "xs", "ys") <= radius).select("key", "n").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("near"))
    all_ = points.groupBy("key").agg(F.count(F.lit(1)).alias("samples"))
    share = all_.join(near, "key", "left").select("key", (F.coalesce("near", F.lit(0)) / F.col("samples")).alias("covered"))
    return candidates.join(share.where(F.col("covered") < most), "key")


def fused(lines: DataFrame, additions: DataFrame, marker: str) -> DataFrame:
    """``lines`` with ``additions`` appended on the common columns, each marked in ``qa_flags`` with where it comes from.

    Nothing is added to lines that already carry the marker, so a second run changes nothing.
    """
    done = lines.where(F.array_contains(T.semicolon_parts(F.col("qa_flags")), marker)).limit(1).count()
    if done:
        return lines
    flags = T.semicolon_parts(F.col("qa_flags")) if "qa_flags" in additions.columns else F.array().cast("array<string>")
    marked = additions.withColumn("qa_flags", F.array_join(F.array_union(flags, F.array(F.lit(marker))), ";"))
    return append_common(lines, marked)
