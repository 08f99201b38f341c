"""GeoPackage files: a layer as a DataFrame, and tables as layers of a new file.

A GeoPackage is one SQLite file, so a layer is read in row ranges by tasks that can open the path, and a file is assembled
on the driver from rows that stream in partition by partition. It is an exchange format; tables at rest are Parquet.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridweave.functions import geometry as G

_KINDS = {"INTEGER": "bigint", "MEDIUMINT": "bigint", "BOOLEAN": "bigint", "REAL": "double", "DOUBLE": "double", "BLOB": "binary"}
_SQL = {"string": "TEXT", "double": "REAL", "float": "REAL", "bigint": "INTEGER", "int": "INTEGER", "boolean": "BOOLEAN", "binary": "BLOB"}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def layers(path: str) -> list[str]:
    with _open(path) as con:
        return [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents ORDER BY table_name")]


def _columns(path: str, layer: str) -> list[tuple[str, str]]:
    with _open(path) as con:
        geometry = {r[0] for r in con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", [layer])}
        rows = con.execute(f'PRAGMA table_info("{layer}")').fetchall()
    return [(r[1], "binary" if r[1] in geometry else _KINDS.get(r[2].upper().split("(")[0], "string")) for r in rows]


class LayerReader(DataSourceReader):
    def __init__(self, path: str, layer: str, names: list[str], parts: int) -> None:
        self.path, self.layer, self.names, self.parts = path, layer, names, parts

    def partitions(self) -> list[InputPartition]:
        with _open(self.path) as con:
            low, high = con.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [InputPartition((s, s + step)) for s in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        low, high = partition.value
        listed = ", ".join(f'"{n}"' for n in self.names)
        with _open(self.path) as con:
            yield from con.execute(f'SELECT {listed} FROM "{self.layer}" WHERE rowid >= ? AND rowid < ?', [low, high])


class LayerSource(DataSource):
    """``spark.read.format("gpkg")`` with options ``path``, ``layer`` and ``parts``."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {k}" for n, k in _columns(self.options["path"], self.options["layer"]))

    def reader(self, schema) -> LayerReader:  # noqa: ANN001, ARG002
        names = [n for n, _ in _columns(self.options["path"], self.options["layer"])]
        return LayerReader(self.options["path"], self.options["layer"], names, int(self.options.get("parts", 8)))


def read_layer(spark: SparkSession, path: str, layer: str, parts: int = 8) -> DataFrame:
    spark.dataSource.register(LayerSource)
    return spark.read.format("gpkg").option("path", path).option("layer", layer).option("parts", parts).load()


def geometry_wkb(blob: Column) -> Column:
    """WKB of a GeoPackage geometry, by the envelope code of its header."""
    flags = F.conv(F.hex(F.substring(blob, 4, 1)), 16, 10).cast("int")
    code = F.shiftright(flags, 1).bitwiseAND(F.lit(7))
    skip = F.when(code == 0, 8).when(code == 1, 40).when(code.isin(2, 3), 56).otherwise(72)
    return F.when(F.hex(F.substring(blob, 1, 2)) == "4750", F.substring(blob, skip + 1, F.octet_length(blob)))


def with_bounds(rows: DataFrame, column: str = "geom") -> DataFrame:
    """Adds ``min_x, min_y, max_x, max_y`` of GeoPackage geometries."""
    def run(blobs: pd.Series) -> pd.DataFrame:
        out = [G.bounds(*G.from_wkb(G.from_gpkg(bytes(b))[1])[:2]) if b is not None else (None,) * 4 for b in blobs]
        return pd.DataFrame(out, columns=["min_x", "min_y", "max_x", "max_y"]).astype(float)

    return rows.withColumn("b", F.pandas_udf(run, "min_x double, min_y double, max_x double, max_y double")(column)).select("*", "b.*").drop("b")


def with_geometry(rows: DataFrame, kind: str, srs: int = 4326) -> DataFrame:
    """Adds ``geom``, a GeoPackage blob with envelope, from ``lons, lats`` (``lon, lat`` for points), which go."""
    names = ("lon", "lat") if kind == "Point" else ("lons", "lats")

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            coords = [x, y] if kind == "Point" else list(zip(x, y, strict=True))
            low_x, low_y, high_x, high_y = G.bounds(kind, [coords] if kind == "Polygon" else coords)
            out.append(G.to_gpkg(G.to_wkb(kind, coords), srs, (low_x, high_x, low_y, high_y)))
        return pd.Series(out)

    return rows.withColumn("geom", F.pandas_udf(run, "binary")(*names)).drop(*names)


_START = """
PRAGMA application_id = 1196444487;
PRAGMA user_version = 10300;
CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now')), min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
CREATE TABLE gpkg_geometry_columns (table_name TEXT NOT NULL, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL, PRIMARY KEY (table_name, column_name));
INSERT INTO gpkg_spatial_ref_sys VALUES ('Undefined cartesian', -1, 'NONE', -1, 'undefined', NULL), ('Undefined geographic', 0, 'NONE', 0, 'undefined', NULL), ('WGS 84 geodetic', 4326, 'EPSG', 4326, 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433]]', NULL);
"""


def write_layers(path: str, tables: dict[str, tuple[DataFrame, str | None]]) -> None:
    """A new file of layers: name to (DataFrame, geometry kind), or (DataFrame, None) for a table without geometry.

    Rows stream through the driver, one partition at a time; the file appears under its name when it is whole.
    """
    part = f"{path}.part"
    if os.path.exists(part):
        os.remove(part)
    con = sqlite3.connect(part)
    try:
        con.executescript(_START)
        for name, (rows, kind) in tables.items():
            made = with_geometry(rows, kind) if kind else rows
            columns = [(n, "BLOB" if n == "geom" else _SQL.get(t, "TEXT")) for n, t in made.dtypes]
            listed = ", ".join(f'"{n}" {t}' for n, t in columns)
            con.execute(f'CREATE TABLE "{name}" (fid INTEGER PRIMARY KEY AUTOINCREMENT, {listed})')
            marks = ", ".join("?" for _ in columns)
            head = ", ".join(f'"{n}"' for n, _ in columns)
            values = (tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in made.toLocalIterator())
            con.executemany(f'INSERT INTO "{name}" ({head}) VALUES ({marks})', values)
            con.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, ?, ?, ?)", [name, "features" if kind else "attributes", name, 4326 if kind else None])
            if kind:
                con.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', ?, 4326, 0, 0)", [name, kind.upper()])
        con.commit()
    finally:
        con.close()
    os.replace(part, path)
