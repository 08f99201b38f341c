"""Geometry functions for SQL over GeoPackage blobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridweave.functions import geometry as G


def _decoded(blob) -> tuple | None:  # noqa: ANN001
    if blob is None:
        return None
    srs, wkb = G.from_gpkg(bytes(blob))
    kind, coords, _ = G.from_wkb(wkb)
    return srs, kind, coords


def _edge(index: int):  # noqa: ANN202
    def run(blobs: pd.Series) -> pd.Series:
        out = []
        for b in blobs:
            x = _decoded(b)
            out.append(G.bounds(x[1], x[2])[index] if x and x[2] else None)
        return pd.Series(out, dtype=float)

    return F.pandas_udf(run, "double")


def _empty(blobs: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else not _decoded(b)[2] for b in blobs], dtype=object)


def _kind(blobs: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else _decoded(b)[1].upper() for b in blobs], dtype=object)


def _srs(blobs: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else _decoded(b)[0] for b in blobs], dtype=object)


def _assignable(expected: pd.Series, actual: pd.Series) -> pd.Series:
    return pd.Series([e is not None and a is not None and (e.upper() in ("GEOMETRY", a.upper())) for e, a in zip(expected, actual, strict=True)])


def register(spark: SparkSession) -> None:
    """ST_MinX, ST_MinY, ST_MaxX, ST_MaxY, ST_IsEmpty, ST_GeometryType, ST_SRID and GPKG_IsAssignable."""
    for index, name in enumerate(("ST_MinX", "ST_MinY", "ST_MaxX", "ST_MaxY")):
        spark.udf.register(name, _edge(index))
    spark.udf.register("ST_IsEmpty", F.pandas_udf(_empty, "boolean"))
    spark.udf.register("ST_GeometryType", F.pandas_udf(_kind, "string"))
    spark.udf.register("ST_SRID", F.pandas_udf(_srs, "int"))
    spark.udf.register("GPKG_IsAssignable", F.pandas_udf(_assignable, "boolean"))
