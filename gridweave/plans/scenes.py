"""Drawn scenes over the driver tables: one per customer, far from the others, each a closed form of the customer's key.

A scene holds a few conductors and footprints in metres; what a topology rule makes of it follows from the key, so SQL can
state the expected result without any geometry.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 10_000
PER_ROW = 400

#: Scenes in SQL: key and origin.
SCENE_SQL = f"scene AS (SELECT c_custkey AS k, CAST(c_custkey % {PER_ROW} AS DOUBLE) * {SIDE} AS x0, CAST(c_custkey // {PER_ROW} AS DOUBLE) * {SIDE} AS y0 FROM customer)"

Number = float | Column


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, x0, y0``."""
    key = F.col("c_custkey")
    column, row = (key % PER_ROW).cast("double") * SIDE, F.floor(key / PER_ROW).cast("double") * SIDE
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(key.alias("k"), column.alias("x0"), row.alias("y0"))


def on_map(cells: DataFrame) -> DataFrame:
    """The scenes closer together, where EPSG:3035 has degrees for them: rows of 1,500 scenes, room for nine million."""
    x, y = (F.col("k") % 1500) * 4_000 + 1_321_000, F.floor(F.col("k") / 1500) * 1_000 + 210_000
    return cells.withColumn("x0", x.cast("double")).withColumn("y0", y.cast("double"))


def number(n: int) -> Column:
    """Element number of the n-th thing in a scene."""
    return F.col("k") * 10 + n


def _axis(origin: str, values: list[Number]) -> Column:
    return F.array(*[F.col(origin) + (v if isinstance(v, Column) else F.lit(float(v))) for v in values])


def _value(v: object) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def conductor(cells: DataFrame, n: int, points: list[tuple[Number, Number]], when: Column | None = None, kv: Number = 110.0, circuits: Column | int = 1, hz: Number = 50.0) -> DataFrame:
    """The n-th element of the scenes where ``when`` holds, as a record of the topology stages."""
    text = F.lit(None).cast("string")
    element = F.concat(F.lit("way/"), number(n).cast("string"))
    rows = cells if when is None else cells.where(when)
    return rows.select(
        F.format_string("way/%020d/000/000", number(n)).alias("key"), element.alias("osm_id"), F.array(element).alias("contains"), F.lit(1).alias("n_ways_merged"),
        _value(kv).cast("double").alias("voltage_kv"), _value(circuits).cast("int").alias("n_circuits"), F.lit("tagged").alias("circuits_source"),
        F.lit("overhead_line").alias("construction_type"), F.lit("osm_power_line").alias("construction_source"), F.lit(False).alias("under_construction"),
        _value(hz).cast("double").alias("frequency_hz"), F.lit("osm_frequency_tag_50").alias("frequency_source"), text.alias("name"), text.alias("ref"), text.alias("operator"),
        F.lit("").alias("countries"), F.array().cast("array<string>").alias("qa"), _axis("x0", [p[0] for p in points]).alias("xs"), _axis("y0", [p[1] for p in points]).alias("ys"),
    )


def footprint(cells: DataFrame, n: int, box: tuple[Number, Number, Number, Number], when: Column | None = None, name: Column | str | None = None, operator: Column | str | None = None, building: Column | bool = False) -> DataFrame:
    """A rectangle (west, south, east, north) as a record of the site stages."""
    w, s, e, t = box
    rows = cells if when is None else cells.where(when)
    return rows.select(
        F.format_string("way/%020d", number(n)).alias("pid"), F.concat(F.lit("way/"), number(n).cast("string")).alias("osm_id"), _value(name).cast("string").alias("name"),
        _value(operator).cast("string").alias("operator"), _value(building).alias("under_construction"), F.lit("").alias("countries"),
        _axis("x0", [w, e, e, w, w]).alias("px"), _axis("y0", [s, s, t, t, s]).alias("py"),
    )


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
