"""Smaller inputs: country polygons, frequency scrapes, job manifests, cached regions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import geometry as G
from gridweave.functions import tags as T
from gridweave.sources import gpkg

MANIFEST = "job string, status string, elements long, bytes long, finished timestamp"


AREA = "array<struct<ring:array<array<double>>,holes:array<array<array<double>>>>>"


def _rings(kind: str, coords: list) -> list:
    """(outer ring, holes) of a polygon or of each of its parts."""
    parts = [coords] if kind == "Polygon" else [c[1] if isinstance(c, tuple) else c for c in coords] if kind == "MultiPolygon" else []
    return [{"ring": [list(p) for p in rings[0]], "holes": [[list(p) for p in r] for r in rings[1:]]} for rings in parts]


def read_countries(spark: SparkSession, path: str, field: str, layer: str | None = None) -> DataFrame:
    """``country, ring, holes`` of a GeoJSON or GeoPackage file: one row per outer ring."""
    if path.endswith(".gpkg"):
        rows = gpkg.read_layer(spark, path, layer or gpkg.layers(path)[0])
        blob = next(n for n, t in rows.dtypes if t == "binary")

        def decode(blobs: pd.Series) -> pd.Series:
            return pd.Series([_rings(*G.from_wkb(G.from_gpkg(bytes(b))[1])[:2]) for b in blobs])

        found = rows.select(F.col(field).cast("string").alias("country"), F.pandas_udf(decode, AREA)(blob).alias("areas"))
        return found.select("country", F.explode("areas").alias("a")).select("country", "a.ring", "a.holes")
    shape = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    features = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)["features"]).alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    single = F.array(F.from_json(text, "array<array<array<double>>>"))
    multiple = F.from_json(text, "array<array<array<array<double>>>>")
    parts = F.when(kind == "Polygon", single).when(kind == "MultiPolygon", multiple)
    part = features.select(F.col("f.properties")[field].alias("country"), F.explode(parts).alias("p"))
    return part.select("country", F.get("p", F.lit(0)).alias("ring"), F.slice("p", 2, F.greatest(F.size("p"), F.lit(1))).alias("holes"))


def read_scrape(spark: SparkSession, path: str) -> DataFrame:
    """``osm_id, frequency, voltage, operator`` of pipe-separated lines ``type|id|frequency|voltage|operator``."""
    parts = F.split("value", "\\|")
    rows = spark.read.text(path).where(F.size(parts) >= 5)
    names = ("frequency", "voltage", "operator")
    return rows.select(F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))).alias("osm_id"), *[F.trim(F.get(parts, F.lit(i + 2))).alias(n) for i, n in enumerate(names)])


def append_manifest(entries: DataFrame, path: str) -> None:
    """``job, status, elements, bytes`` entries with the time of writing."""
    entries.select("job", "status", F.col("elements").cast("long"), F.col("bytes").cast("long"), F.current_timestamp().alias("finished")).write.mode("append").parquet(path)


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The table at ``path``, made and written first if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if refresh or not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries of ``append_manifest``; none where nothing is written yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return spark.read.schema(MANIFEST).parquet(path) if exists else spark.createDataFrame([], MANIFEST)


def in_country(rows: DataFrame, code: str, grid_hz: float | None = None) -> DataFrame:
    """Rows whose semicolon-separated ``countries`` have the code as a whole token; with ``grid_hz`` only that frequency.

    A missing frequency counts as the grid's.
    """
    found = rows.where(F.col("countries").contains(code) & F.array_contains(T.semicolon_parts(F.col("countries")), code))
    return found if grid_hz is None else found.where(F.coalesce("frequency_hz", F.lit(grid_hz)) == grid_hz)


def one_per_station(buses: DataFrame) -> DataFrame:
    """Of the buses of a station that of the highest voltage; of equal ones that of the smallest id."""
    row = F.struct(*[c for c in buses.columns if c != "station_id"])
    return buses.groupBy("station_id").agg(F.min_by(row, F.struct(-F.col("voltage_kv"), "bus_id")).alias("r")).select("station_id", "r.*").select(*buses.columns)
