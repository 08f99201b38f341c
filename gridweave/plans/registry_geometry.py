"""Queries of the geometry kernels and SQL geometry functions over shapes whose measures follow from a key."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import geometry as G
from gridweave.functions import measure as M
from gridweave.functions import sql
from gridweave.plans import compare, validate
from gridweave.plans import synthetic as S
from gridweave.plans.registry import query
from gridweave.sources import gpkg

KEY_SQL = "cell AS (SELECT c_custkey AS k FROM customer)"


def nth() -> Column:
    """The key of a cell."""
    return F.col("k")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))


def _doubles(*values: Column | float) -> Column:
    return F.array(*[(v if isinstance(v, Column) else F.lit(v)).cast("double") for v in values])


LONLAT_SQL = "ends AS (SELECT k, CAST(k % 100 AS DOUBLE) AS lon0, CAST(k * 7 % 120 AS DOUBLE) - 60 AS lat0, CAST(k % 17 AS DOUBLE) / 8 + 0.01 AS dlon, CAST(k % 11 AS DOUBLE) / 10 AS dlat FROM cell)"
#: Vincenty's inverse formula with a fixed number of steps.
VINCENTY_SQL = (
    f"WITH RECURSIVE {KEY_SQL}, {LONLAT_SQL}, u AS (SELECT k, radians(dlon) AS l, atan((1 - f) * tan(radians(lat0))) AS u0, atan((1 - f) * tan(radians(lat0 + dlat))) AS u1, f FROM ends, (SELECT 1 / CAST(298.257223563 AS DOUBLE) AS f)), "
    "step AS (SELECT 0 AS n, k, l, u0, u1, f, l AS lam FROM u UNION ALL SELECT n + 1, k, l, u0, u1, f, l + (1 - c) * f * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) FROM ("
    "SELECT *, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS c FROM (SELECT *, CASE WHEN ca > 1e-15 THEN cs - 2 * sin(u0) * sin(u1) / ca ELSE 0 END AS cm FROM (SELECT *, 1 - sa * sa AS ca FROM ("
    "SELECT *, atan2(ss, cs) AS sg, cos(u0) * cos(u1) * sin(lam) / ss AS sa FROM (SELECT *, sqrt(pow(cos(u1) * sin(lam), 2) + pow(cos(u0) * sin(u1) - sin(u0) * cos(u1) * cos(lam), 2)) AS ss, sin(u0) * sin(u1) + cos(u0) * cos(u1) * cos(lam) AS cs FROM step WHERE n < 8))))) ), "
    "last AS (SELECT *, cos(u0) * cos(u1) * sin(lam) / ss AS sa, atan2(ss, cs) AS sg FROM (SELECT *, sqrt(pow(cos(u1) * sin(lam), 2) + pow(cos(u0) * sin(u1) - sin(u0) * cos(u1) * cos(lam), 2)) AS ss, sin(u0) * sin(u1) + cos(u0) * cos(u1) * cos(lam) AS cs FROM step WHERE n = 8)), "
    "sums AS (SELECT *, CASE WHEN ca > 1e-15 THEN cs - 2 * sin(u0) * sin(u1) / ca ELSE 0 END AS cm, ca * (1 / pow(1 - f, 2) - 1) AS q FROM (SELECT *, 1 - sa * sa AS ca FROM last)), "
    "ab AS (SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS ga, q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS gb FROM sums) "
    "SELECT k, round(6378137 * (1 - f) * ga * (sg - gb * ss * (cm + gb / 4 * (cs * (2 * cm * cm - 1) - gb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))), 3) AS metres FROM ab"
)


@query(VINCENTY_SQL)
def geodesic_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(lons: pd.Series, lats: pd.Series) -> pd.Series:
        return pd.Series([G.geodesic_length(np.column_stack([a, b])) for a, b in zip(lons, lats, strict=True)])

    lon, lat = (nth() % 100).cast("double"), (nth() * 7 % 120).cast("double") - 60
    rows = _cells(spark, sf_dir).withColumn("lons", F.array(lon, lon + (nth() % 17).cast("double") / 8 + 0.01)).withColumn("lats", F.array(lat, lat + (nth() % 11).cast("double") / 10))
    return rows.select("k", F.round(F.pandas_udf(run, "double")("lons", "lats"), 3).alias("metres"))


AUTHALIC_SQL = "((1 - e2) * (sin({0}) / (1 - e2 * pow(sin({0}), 2)) - ln((1 - sqrt(e2) * sin({0})) / (1 + sqrt(e2) * sin({0}))) / (2 * sqrt(e2))))"
LAEA_SQL = (
    f"WITH {KEY_SQL}, shape AS (SELECT f * (2 - f) AS e2, radians(52) AS phi0 FROM (SELECT 1 / CAST(298.257222101 AS DOUBLE) AS f)), "
    f"base AS (SELECT *, {AUTHALIC_SQL.format('(pi() / 2)')} AS qp, {AUTHALIC_SQL.format('phi0')} AS q0 FROM shape), "
    "consts AS (SELECT *, 6378137 * sqrt(qp / 2) AS rq, asin(q0 / qp) AS b0 FROM base), more AS (SELECT *, 6378137 * cos(phi0) / (sqrt(1 - e2 * pow(sin(phi0), 2)) * rq * cos(b0)) AS d FROM consts), "
    f"spot AS (SELECT k, more.*, radians(CAST(k % 60 AS DOUBLE) - 20 - 10) AS l, asin({AUTHALIC_SQL.format('radians(35 + CAST(k % 30 AS DOUBLE) + 0.5)')} / qp) AS b FROM cell, more), "
    "scaled AS (SELECT *, rq * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(l))) AS s FROM spot) "
    "SELECT k, round(4321000 + s * d * cos(b) * sin(l), 3) AS x, round(3210000 + s / d * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(l)), 3) AS y, CAST(k % 60 AS DOUBLE) - 20 AS lon, 35 + CAST(k % 30 AS DOUBLE) + 0.5 AS lat FROM scaled"
)


@query(LAEA_SQL)
def metric_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees to the metric system and back."""

    def run(lon: pd.Series, lat: pd.Series) -> pd.DataFrame:
        forward, inverse = G.projection("EPSG:3035")
        xy = forward(np.column_stack([lon, lat]))
        back = inverse(xy)
        return pd.DataFrame({"x": xy[:, 0], "y": xy[:, 1], "lon": back[:, 0], "lat": back[:, 1]})

    rows = _cells(spark, sf_dir).withColumn("p", F.pandas_udf(run, "x double, y double, lon double, lat double")((nth() % 60).cast("double") - 20, (nth() % 30).cast("double") + 35.5))
    return rows.select("k", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"), F.round("p.lon", 6).alias("lon"), F.round("p.lat", 6).alias("lat"))


@query(f"WITH {KEY_SQL} SELECT k, CAST(2 * (k % 50 + 1 + k % 7 + 1) AS DOUBLE) AS metres, CAST((k % 50 + 1) * (k % 7 + 1) AS DOUBLE) AS area FROM cell")
def planar_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = nth() % 50 + 1, nth() % 7 + 1
    rows = _cells(spark, sf_dir).withColumn("xs", _doubles(0, w, w, 0, 0)).withColumn("ys", _doubles(0, 0, h, h, 0))
    return rows.select("k", M.planar_length(F.col("xs"), F.col("ys")).alias("metres"), M.ring_area(F.col("xs"), F.col("ys")).alias("area"))


@query(f"WITH {KEY_SQL} SELECT k, CAST(k % 90 + 5 AS DOUBLE) AS along, CAST(k % 20 AS DOUBLE) AS away, CAST(100 AS DOUBLE) AS x, CAST(k % 50 AS DOUBLE) AS y, CAST(k % 90 + 5 + 40 AS DOUBLE) AS piece FROM cell WHERE k % 50 <> 99")
def linear_referencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest place on a bent path, the place at a distance along it, and the piece between two distances."""
    bent = np.array([(0.0, 0.0), (100.0, 0.0), (100.0, 100.0)])

    def run(x: pd.Series, y: pd.Series, s: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, along in zip(x, y, s, strict=True):
            foot, away = G.foot(bent, np.array([a, b]))
            out.append((foot, away, *G.point_at(bent, along), G.length(G.piece(bent, 0.0, foot + 40))))
        return pd.DataFrame(out, columns=["along", "away", "x", "y", "piece"])

    made = F.pandas_udf(run, "along double, away double, x double, y double, piece double")
    rows = _cells(spark, sf_dir).withColumn("r", made((nth() % 90 + 5).cast("double"), -(nth() % 20).cast("double"), (nth() % 50 + 100).cast("double")))
    return rows.select("k", *[F.round(f"r.{c}", 6).alias(c) for c in ("along", "away", "x", "y", "piece")])


@query(f"WITH {KEY_SQL} SELECT k, CAST(CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 2 ELSE 3 END AS INTEGER) AS n_paths, CAST(CASE WHEN k % 3 = 2 THEN 31 ELSE 30 END AS DOUBLE) AS metres FROM cell")
def joined_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts in any direction: one path, two with a gap, three where a fourth end meets."""

    def run(kinds: pd.Series) -> pd.DataFrame:
        out = []
        for kind in kinds:
            parts = [np.array([(10.0, 0.0), (0.0, 0.0)]), np.array([(10.0, 0.0), (20.0, 0.0)]), np.array([(20.0, 0.0), (30.0, 0.0)])]
            if kind == 1:
                parts[2] = parts[2] + (5.0, 0.0)
            if kind == 2:
                parts = [parts[0], parts[1], np.array([(10.0, 0.0), (10.0, 11.0)])]
            found = G.joined(parts)
            out.append((len(found), sum(map(G.length, found))))
        return pd.DataFrame(out, columns=["n", "metres"])

    rows = _cells(spark, sf_dir).withColumn("r", F.pandas_udf(run, "n int, metres double")((nth() % 3).cast("int")))
    return rows.select("k", F.col("r.n").alias("n_paths"), F.col("r.metres").alias("metres"))


@query(
    f"WITH {KEY_SQL}, b AS (SELECT k, 10 + k % 40 AS a FROM cell) SELECT k, CAST(20 + 10 - greatest(0, least(30, a + 10) - greatest(10, a)) AS DOUBLE) AS covered, CAST(100 - (20 + 10 - greatest(0, least(30, a + 10) - greatest(10, a))) AS DOUBLE) AS rest, "
    "k % 100 BETWEEN 10 AND 30 OR k % 100 BETWEEN a AND a + 10 AS point_inside FROM b WHERE k % 100 NOT IN (10, 30) AND k % 100 NOT IN (a, a + 10)"
)
def line_against_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of a path inside the union of two rectangles and outside it, and whether a point is inside."""

    def run(a: pd.Series, p: pd.Series) -> pd.DataFrame:
        path, out = np.array([(0.0, 5.0), (100.0, 5.0)]), []
        for start, x in zip(a, p, strict=True):
            rings = [np.array([(w, 0.0), (e, 0.0), (e, 10.0), (w, 10.0), (w, 0.0)]) for w, e in ((10.0, 30.0), (start, start + 10.0))]
            inside = G.inside_intervals(path, rings)
            rest = G.outside_intervals(100.0, inside)
            out.append((sum(t - s for s, t in inside), sum(t - s for s, t in rest), any(G.inside(r, np.array([[x, 5.0]]))[0] for r in rings)))
        return pd.DataFrame(out, columns=["covered", "rest", "point_inside"])

    a, p = (10 + nth() % 40).cast("double"), (nth() % 100).cast("double")
    rows = _cells(spark, sf_dir).where(~p.isin(10.0, 30.0) & (p != a) & (p != a + 10)).withColumn("r", F.pandas_udf(run, "covered double, rest double, point_inside boolean")(a, p))
    return rows.select("k", F.round("r.covered", 6).alias("covered"), F.round("r.rest", 6).alias("rest"), "r.point_inside")


@query(
    f"WITH {KEY_SQL}, b AS (SELECT k, CAST(k % 8 * 40 AS DOUBLE) AS d, CAST(k % 300 AS DOUBLE) AS a FROM cell), r AS (SELECT *, CASE WHEN d <= 250 THEN sqrt(62500 - d * d) END AS reach FROM b) "
    "SELECT k, round(CASE WHEN reach IS NULL THEN 0 ELSE least(1000, a + 200 + reach) - greatest(0, a - reach) END, 3) AS covered FROM r WHERE d <> 250"
)
def covered_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of a path lies within 250 m of a parallel one."""

    def run(d: pd.Series, a: pd.Series) -> pd.Series:
        path = np.array([(0.0, 0.0), (1000.0, 0.0)])
        return pd.Series([G.covered_length(path, [np.array([(x, y), (x + 200.0, y)])], 250.0) for y, x in zip(d, a, strict=True)])

    rows = _cells(spark, sf_dir).withColumn("m", F.pandas_udf(run, "double")((nth() % 8 * 40).cast("double"), (nth() % 300).cast("double")))
    return rows.select("k", F.round("m", 3).alias("covered"))


@query(f"WITH {KEY_SQL}, b AS (SELECT k, CAST(k % 8 * 40 AS DOUBLE) AS d FROM cell), n AS (SELECT count(*) AS lines, count(*) FILTER (WHERE d <= 250) AS near FROM b) SELECT CAST(lines * 1000 AS DOUBLE) AS total_m, CAST(near * 1000 AS DOUBLE) AS covered_m, round(CAST(near AS DOUBLE) / lines, 9) AS share FROM n")
def coverage_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of one network within 250 m of another: parallel lines far from all others."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 5000
    ours = cells.select(F.concat(F.lit("o"), nth().cast("string")).alias("key"), F.lit(110.0).alias("voltage_kv"), _doubles(0, 1000).alias("xs"), F.array(y, y).alias("ys"))
    off = y + (nth() % 8 * 40).cast("double")
    theirs = cells.select(F.concat(F.lit("t"), nth().cast("string")).alias("key"), F.lit(110.0).alias("voltage_kv"), _doubles(-500, 1500).alias("xs"), F.array(off, off).alias("ys"))
    out = compare.coverage(ours, theirs, 250.0)
    return out.select(F.round("total_m", 3).alias("total_m"), F.round("covered_m", 3).alias("covered_m"), F.round("share", 9).alias("share"))


@query(f"WITH {KEY_SQL}, n AS (SELECT count(*) AS lines, count(*) FILTER (WHERE k % 3 = 0) AS near FROM cell WHERE k % 5 <> 0) SELECT CAST(lines * 1000 AS DOUBLE) AS total_m, CAST(near * 1000 AS DOUBLE) AS covered_m, round(CAST(near AS DOUBLE) / lines, 9) AS share FROM n")
def coverage_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only lines of a matching voltage class cover, and lines without a voltage are left out."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 5000
    kv = F.when(nth() % 5 == 0, F.lit(None)).otherwise(110.0).cast("double")
    ours = cells.select(F.concat(F.lit("o"), nth().cast("string")).alias("key"), kv.alias("voltage_kv"), _doubles(0, 1000).alias("xs"), F.array(y, y).alias("ys"))
    theirs = cells.select(F.concat(F.lit("t"), nth().cast("string")).alias("key"), F.when(nth() % 3 == 0, 115.0).otherwise(220.0).alias("voltage_kv"), _doubles(-500, 1500).alias("xs"), F.array(y, y).alias("ys"))
    out = compare.coverage(ours, theirs, 250.0, by_class=True)
    return out.select(F.round("total_m", 3).alias("total_m"), F.round("covered_m", 3).alias("covered_m"), F.round("share", 9).alias("share"))


@query(f"WITH {KEY_SQL}, r AS (SELECT k, sqrt(CAST(k % 9 + 60 AS DOUBLE) * (k % 9 + 60) + CAST(k % 13 AS DOUBLE) * (k % 13)) AS n FROM cell) SELECT k, round((k % 9 + 60) / n, 9) AS ux, round((k % 13) / n, 9) AS uy FROM r")
def outward_unit_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction from an end to the first vertex at least 50 m away; a nearer vertex does not count."""

    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([G.outward(np.array([(0.0, 0.0), (0.0, 20.0), (a, b), (999.0, 0.0)]), True, 50.0) for a, b in zip(x, y, strict=True)], columns=["ux", "uy"])

    rows = _cells(spark, sf_dir).withColumn("u", F.pandas_udf(run, "ux double, uy double")((nth() % 9 + 60).cast("double"), (nth() % 13).cast("double")))
    return rows.select("k", F.round("u.ux", 9).alias("ux"), F.round("u.uy", 9).alias("uy"))


@query(f"WITH {KEY_SQL}, c AS (SELECT k, CAST(k % 40 + 10 AS DOUBLE) AS n FROM cell) SELECT k, round((n * n / 2 + 20 * 10) / (n + 20), 6) AS x, round((20 * 5) / (n + 20), 6) AS y, n / 2 AS pole_x, n / 2 AS pole_y, CAST(4 AS INTEGER) AS hull_points FROM c")
def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length-weighted centre of two paths, pole of inaccessibility of a square, corners of a hull."""

    def run(n: pd.Series) -> pd.DataFrame:
        out = []
        for side in n:
            centre = G.line_centroid([np.array([(0.0, 0.0), (side, 0.0)]), np.array([(0.0, 5.0), (20.0, 5.0)])])
            square = np.array([(0.0, 0.0), (side, 0.0), (side, side), (0.0, side), (0.0, 0.0)])
            out.append((*centre, *G.pole(square), len(G.hull(np.concatenate([square, [(side / 2, side / 3)]]))) - 1))
        return pd.DataFrame(out, columns=["x", "y", "px", "py", "hull"])

    # Half a millisecond a row, of which a file of a few MB holds a million: dealt out by number, else one task has them all.
    cells = _cells(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism)
    rows = cells.withColumn("r", F.pandas_udf(run, "x double, y double, px double, py double, hull int")((nth() % 40 + 10).cast("double")))
    return rows.select("k", F.round("r.x", 6).alias("x"), F.round("r.y", 6).alias("y"), F.col("r.px").alias("pole_x"), F.col("r.py").alias("pole_y"), F.col("r.hull").alias("hull_points"))


@query(f"WITH {KEY_SQL} SELECT k, CAST(k % 90 AS DOUBLE) AS min_x, CAST(k % 40 AS DOUBLE) AS min_y, CAST(k % 90 AS DOUBLE) + 1.5 AS max_x, CAST(k % 40 AS DOUBLE) + 2 AS max_y, 'LINESTRING' AS kind, 4326 AS srid, false AS empty, true AS assignable FROM cell")
def sql_geometry_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql.register(spark)
    lon, lat = (nth() % 90).cast("double"), (nth() % 40).cast("double")
    rows = _cells(spark, sf_dir).withColumn("lons", F.array(lon + 1.5, lon, lon + 1)).withColumn("lats", F.array(lat, lat + 2, lat + 1))
    return gpkg.with_geometry(rows, "LineString").selectExpr(
        "k", "ST_MinX(geom) AS min_x", "ST_MinY(geom) AS min_y", "ST_MaxX(geom) AS max_x", "ST_MaxY(geom) AS max_y", "ST_GeometryType(geom) AS kind", "ST_SRID(geom) AS srid", "ST_IsEmpty(geom) AS empty",
        "GPKG_IsAssignable('LINESTRING', ST_GeometryType(geom)) AS assignable",
    )


@query(f"WITH {KEY_SQL} SELECT k % 50 AS g, count(*) AS n, count(DISTINCT k % 7) AS shapes FROM cell GROUP BY 1")
def geometry_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes told apart by the digest of their bytes."""
    lon = (nth() % 7).cast("double")
    rows = _cells(spark, sf_dir).select((nth() % 50).alias("g"), F.array(lon, lon + 1).alias("lons"), _doubles(1, 2).alias("lats"))
    return gpkg.with_geometry(rows, "LineString").groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.md5("geom")).alias("shapes"))


@query(f"WITH {KEY_SQL}, spot AS (SELECT k, CAST(k % 11 * 30 AS DOUBLE) AS d FROM cell) SELECT CAST(k AS VARCHAR) AS line_id, 0 AS \"end\", CASE WHEN d <= 100 THEN 0 ELSE least(d - 100, abs(400 - d)) END AS metres FROM spot")
def internal_ends_to_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each end to the nearest footprint: its own station's, or another's that is nearer."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 20_000
    ends = cells.select(nth().cast("string").alias("line_id"), F.concat(F.lit("s"), nth().cast("string")).alias("station_id"), F.lit(0).alias("end"), (nth() % 11 * 30).cast("double").alias("x"), (y + 50).alias("y"))

    def ring(station: str, w: float, e: float) -> DataFrame:
        return cells.select(F.concat(F.lit(station), nth().cast("string")).alias("pid"), F.concat(F.lit(station), nth().cast("string")).alias("station_id"), _doubles(w, e, e, w, w).alias("px"), F.array(y, y, y + 100, y + 100, y).alias("py"))

    found = validate.nearest_footprints(ends, ring("s", 0, 100).unionByName(ring("t", 400, 500)))
    return found.select("line_id", "end", F.round("metres", 3).alias("metres"))


@query(
    f"WITH {KEY_SQL} SELECT CAST(CASE WHEN k % 2 = 0 THEN 110 ELSE 220 END AS INTEGER) AS kv, round(count(*) * 6378137 * pi() / 180 / 1000, 3) AS km FROM cell GROUP BY 1"
)
def route_km_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one degree on the equator, by voltage class; a class of a few metres is left out."""
    kv = F.when(nth() % 2 == 0, 110.2).otherwise(219.8)
    lines = _cells(spark, sf_dir).select(kv.alias("voltage_kv"), F.array(nth().cast("double") % 90, nth().cast("double") % 90 + 1).alias("lons"), _doubles(0, 0).alias("lats"))
    short = spark.range(1).select(F.lit(400.0).alias("voltage_kv"), _doubles(0, 0.0001).alias("lons"), _doubles(0, 0).alias("lats"))
    return compare.route_km_by_class(lines.unionByName(short)).select("kv", F.round("km", 3).alias("km"))
