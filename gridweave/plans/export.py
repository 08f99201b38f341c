"""Sinks of a network: partitioned Parquet, GeoPackage layers, GeoJSON lines, attribute tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions.tags import TRANSFORMER_BANDS
from gridweave.plans.build import Network
from gridweave.sources.gpkg import write_layers

_DEFAULTS = "https://github.com/PyPSA/pypsa-eur/blob/master/config/config.default.yaml"
_TYPES = "https://github.com/e2nIEE/pandapower/blob/v3.1.2/pandapower/std_types.py"
#: What each transformer band selects. Then, in our words, what its numbers rest on, and where that is stated.
SELECTORS = {
    "R1": ("lo>=200", "reactance: default of the open European model; rating and resistance assumed", _DEFAULTS),
    "R2": ("100<=lo<200 and hi>=330", "standard type 160 MVA 380/110 kV; rating for parallel units assumed", _TYPES),
    "R3": ("100<=lo<200 and 200<=hi<330", "standard type 100 MVA 220/110 kV; rating for parallel units assumed", _TYPES),
    "R4": ("100<=lo<200 and hi<200", "reactance: default of the open European model; no standard type has such a ratio", _DEFAULTS),
    "R5": ("lo<100 and hi>=200", "carried over from the 110/20 kV standard types", _TYPES),
    "R6": ("lo<100 and hi<200", "carried over from the 110/20 kV standard types", _TYPES),
}


def typing_rule(spark: SparkSession) -> DataFrame:
    """``band, selector, s_nom_mva, x_pu, r_pu, basis, source_url`` as text: six bands and two remarks."""
    rows = [(b, SELECTORS[b][0], f"{s:g}", f"{x:g}", f"{r:g}", *SELECTORS[b][1:]) for b, s, x, r in TRANSFORMER_BANDS]
    rows.append(("ALT", "s_nom_pypsa_eur_mva (separate column, all rows)", "", "", "", "largest sum of line ratings at either bus, rounded up; x_pu and r_pu refer to s_nom_mva and must be scaled if this is used instead", _DEFAULTS))
    rows.append(("NOTE", "x,r are per-unit on the transformer own s_nom (PyPSA Transformer convention)", "", "", "", "ratios below 1.095 are probably tagging artefacts", _TYPES))
    return spark.createDataFrame(rows, "band string, selector string, s_nom_mva string, x_pu string, r_pu string, basis string, source_url string")


def build_metadata(spark: SparkSession, config: Config, network: Network) -> DataFrame:
    """``key, value``."""
    rows = [("metric_crs", config.metric_crs), ("voltage_floor_kv", f"{config.voltage_floor_kv:g}"), ("grid_frequency_hz", f"{config.grid_frequency_hz:g}"), ("layers", ";".join(map(str, network.layers)))]
    stamp = spark.range(1).select(F.lit("built_utc").alias("key"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("value"))
    return spark.createDataFrame(rows, "key string, value string").unionByName(stamp)


def write_parquet(network: Network, path: str) -> None:
    """Every table below ``path``; lines and buses by layer."""
    network.lines.write.partitionBy("layer").mode("overwrite").parquet(f"{path}/line")
    for name, table in (("site", network.buses), ("line_internal_to_station", network.internals), ("dc_link", network.dc), ("transformer", network.transformers), ("station_cluster", network.clusters), ("substation_footprint", network.footprints)):
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def topology_layers(network: Network) -> dict[str, tuple[DataFrame, str | None]]:
    """Layers of the topology file: lines by layer, buses by kind, the rest once each."""
    out: dict[str, tuple[DataFrame, str | None]] = {}
    names = sorted(r["layer"] for r in network.lines.select("layer").distinct().collect())  # a few dozen
    for name in names:
        out[name] = (network.lines.where(F.col("layer") == name).drop("layer"), "LineString")
    out["site"] = (network.buses.where("node_type = 'substation'").drop("severed_from", "component_incl_dc", "bus_point_source"), "Point")
    out["junction_node"] = (network.buses.where("node_type = 'junction'").drop("severed_from", "component_incl_dc", "bus_point_source"), "Point")
    out["line_internal_to_station"] = (network.internals.drop("station_id", "qa_flags"), "LineString")
    out["dc_link"] = (network.dc, "LineString")
    out["transformer"] = (network.transformers, None)
    out["station_cluster"] = (network.clusters, None)
    out["substation_footprint"] = (network.footprints.drop("station_id"), "Polygon")
    return out


def graph_layers(network: Network) -> dict[str, tuple[DataFrame, str | None]]:
    """Layers of the graph file: all lines and all buses."""
    return {"ac_line_all": (network.lines.drop("layer"), "LineString"), "site_all": (network.buses.drop("bus_point_source"), "Point")}


def write_geopackages(network: Network, config: Config, topology: str, graph: str) -> None:
    spark = network.lines.sparkSession
    tables = topology_layers(network) | {"v23_typing_rule": (typing_rule(spark), None), "build_metadata": (build_metadata(spark, config, network), None)}
    write_layers(topology, tables)
    write_layers(graph, graph_layers(network))


def write_report(rows: DataFrame, path: str) -> None:
    """A small table (totals, hard checks) as one JSON file of a row per line below ``path``."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def geojson_lines(rows: DataFrame, kind: str, keep: list[str]) -> DataFrame:
    """``value``: a GeoJSON feature per row with the properties ``keep``; ready for ``write.text``."""
    if kind == "Point":
        coordinates = F.array("lon", "lat")
    else:
        coordinates = F.arrays_zip(F.col("lons").alias("x"), F.col("lats").alias("y"))
        coordinates = F.transform(coordinates, lambda p: F.array(p["x"], p["y"]))
    shape = F.struct(F.lit(kind).alias("type"), (F.array(coordinates) if kind == "Polygon" else coordinates).alias("coordinates"))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*keep).alias("properties"), shape.alias("geometry"))).alias("value"))
