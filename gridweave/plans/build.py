"""The build: raw elements to the tables of a network model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions import measure as M
from gridweave.functions import tags as T
from gridweave.operators.spatial import box_cells, point_cells
from gridweave.plans import network as N
from gridweave.plans import parse as P
from gridweave.plans import topology as O
from gridweave.plans.storage import materialise
from gridweave.sources.elements import read_elements

#: The output columns, in order.
LINE = (
    "line_id osm_id contains line_label line_label_source ref operator bus0 bus1 start_point end_point start_lat start_lon end_lat end_lon "
    "route_start_substation route_end_substation component voltage_kv n_circuits circuits_source line_type i_nom_ka s_nom_mva r_ohm x_ohm "
    "construction_type construction_source under_construction length_conductor_m connector0_m connector1_m countries n_ways_merged qa_flags "
    "frequency_hz frequency_source"
).split()
SITE = (
    "bus_id station_id node_type voltage_kv station_name operator countries degree n_lines connected_line_ids station_voltages_kv n_sub_polygons "
    "osm_substation_ids component frequency_hz frequency_source"
).split()
SITE_ALL = [*SITE, "severed_from", "component_incl_dc"]
INTERNAL = "line_id osm_id contains ref operator voltage_kv n_circuits construction_type construction_source under_construction countries".split()
DC = "osm_id name voltage_kv bus0 bus1 start_point end_point start_lat start_lon end_lat end_lon countries qa_flags frequency_hz frequency_source component p_nom_mw status p_nom_source".split()
TRANSFORMER = (
    "transformer_id station_id station_name bus0 bus1 voltage0_v voltage1_v inferred component voltage0_kv voltage1_kv frequency_hz frequency_source "
    "s_nom_mva x_pu r_pu s_nom_pypsa_eur_mva parameters_source"
).split()
CLUSTER = "station_id station_name operator countries n_buses voltages_kv n_lines n_sub_polygons osm_substation_ids component".split()
FOOTPRINT = "osm_id name operator voltage_kv countries area_m2 under_construction".split()


@dataclass
class Network:
    """Tables of a build; geometry columns ``lons, lats`` (or ``lon, lat``) follow the named ones."""

    lines: DataFrame
    buses: DataFrame
    internals: DataFrame
    dc: DataFrame
    transformers: DataFrame
    clusters: DataFrame
    footprints: DataFrame
    layers: list[int]


def _flat(rows: DataFrame) -> DataFrame:
    """Set-valued columns as sorted text."""
    for name, source in (("contains", "contains"), ("qa_flags", "qa")):
        if source in rows.columns:
            rows = rows.withColumn(name, F.array_join(F.array_sort(F.array_distinct(source)), ";"))
    return rows


def build(spark: SparkSession, source: str | DataFrame, config: Config, countries: DataFrame | None = None) -> Network:
    """Run every stage. ``source``: a folder of NDJSON files or a DataFrame of elements; ``countries``: ``country, ring``."""
    raw = read_elements(spark, source) if isinstance(source, str) else source
    conductors, stations, dc = P.records(raw, config)
    rows = P.with_traction(P.with_countries(conductors, config, countries), config)
    rows = materialise(P.projected(rows, config).drop("lons", "lats", "tag_country"), "metric")
    ringed = stations.withColumn("lons", F.transform("ring", lambda p: F.get(p, F.lit(0)))).withColumn("lats", F.transform("ring", lambda p: F.get(p, F.lit(1))))
    areas = P.with_countries(ringed.withColumn("key", F.col("osm_id")).withColumn("tag_country", F.lit("")), config, countries)
    polygons = materialise(O.polygon_rows(P.projected(areas, config)).drop("key", "tag_country"), "polygons")

    rows = O.merge_chains(rows, config)
    rows = O.join_ends(rows, polygons, config)
    rows = O.snap_split(rows, config)
    sites, polygons = O.build_sites(polygons, rows, config)
    spans, internals = O.clip(rows, polygons, config)
    spans, internals = O.assign_ends(spans, internals, polygons, config)
    spans, junctions = O.cluster_junctions(spans, config)
    buses = O.build_buses(spans, internals, sites, junctions, polygons, config)
    spans, internals = O.sweep_self_loops(spans, internals, config)
    spans = O.dissolve_junctions(spans, config)
    spans, internals = O.sweep_self_loops(spans, internals, config)
    if config.merge_across_components:
        spans, buses = O.merge_across_components(spans, buses, config)
    return finish(spans, internals, buses, polygons, sites, P.projected(dc, config), config)


def finish(spans: DataFrame, internals: DataFrame, buses: DataFrame, polygons: DataFrame, sites: DataFrame, dc: DataFrame, config: Config) -> Network:
    """Attributes and output tables of a topology."""
    spark = spans.sparkSession
    lines = N.with_electrical(N.with_line_ids(N.attach_connectors(spans, buses, config)), config)
    used = lines.select(F.explode(F.array("bus0", "bus1")).alias("bus_id")).distinct()
    buses = materialise(buses.join(used, "bus_id", "left_semi").withColumn("p", N.to_degrees(config, F.col("x"), F.col("y"))).select("*", "p.lon", "p.lat").drop("p"), "buses")
    lines = materialise(lines, "lines")
    trafos = N.transformers(buses, lines, config)
    ratings = N.read_ratings(spark, config.dc_ratings_csv) if config.dc_ratings_csv else None
    links = N.dc_links(dc, buses, config, ratings)
    ends = ["bus0", "bus1"]
    ac = lines.select(*ends).unionByName(trafos.select(*ends))
    metres = lines.select(*ends, F.col("length_conductor_m").alias("metres"))
    parts = N.ranked_components(buses, ac, metres)
    with_dc = N.ranked_components(buses, ac.unionByName(links.select(*ends)), metres)
    lines = N.with_component(lines, parts)
    lines = lines.withColumn("qa", T.add_flag(F.col("qa"), "not_in_main_component", F.col("component") != 0))
    buses = N.with_degrees(buses, lines, trafos.select(*ends).unionByName(links.select(*ends)))
    buses = buses.join(parts, "bus_id", "left").join(with_dc.withColumnRenamed("component", "component_incl_dc"), "bus_id", "left")
    areas = polygons.groupBy("station_id").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(T.semicolon_parts(F.col("countries")))))), ";").alias("countries"))
    buses = buses.join(areas, "station_id", "left").withColumn("countries", F.coalesce("countries", F.lit(""))).withColumn("frequency_source", F.lit("inherited_from_lines"))
    buses = materialise(buses, "buses")
    lines = materialise(_flat(N.with_labels(lines, buses)), "lines")
    layers = N.promoted_voltages(lines, config)
    lines = lines.withColumn("layer", T.layer_name(F.col("voltage_kv"), F.col("frequency_hz"), layers, config))

    number = F.row_number().over(W.partitionBy("osm_id").orderBy("order", "key")) - 1
    inner = N.paths_to_degrees(internals, config).withColumn("line_id", F.concat(F.col("osm_id"), F.lit("~in"), number.cast("string")))
    links = N.with_component(_flat(N.paths_to_degrees(links.drop("lons", "lats"), config)), with_dc).withColumn("countries", F.lit(""))
    at = buses.select("bus_id", "lat", "lon", F.coalesce("station_name", F.when(F.col("node_type") == "substation", "unnamed substation").otherwise("junction")).alias("point"))
    for e, n in ((0, "start"), (1, "end")):
        links = links.join(at.select(F.col("bus_id").alias(f"bus{e}"), F.col("point").alias(f"{n}_point"), F.round("lat", 6).alias(f"{n}_lat"), F.round("lon", 6).alias(f"{n}_lon")), f"bus{e}", "left")
    trafos = N.with_component(trafos, parts)
    cluster = buses.where("node_type = 'substation'").groupBy("station_id").agg(
        F.first("station_name").alias("station_name"), F.first("operator").alias("operator"), F.first("countries").alias("countries"), F.count(F.lit(1)).cast("int").alias("n_buses"),
        F.first("station_voltages_kv").alias("voltages_kv"), F.sum("n_lines").cast("int").alias("n_lines"), F.first("n_sub_polygons").alias("n_sub_polygons"),
        F.first("osm_substation_ids").alias("osm_substation_ids"), F.min("component").alias("component"),
    )
    prints = polygons.withColumn("area_m2", M.ring_area(F.col("px"), F.col("py")))
    return Network(
        lines.select(*LINE, "layer", "lons", "lats"),
        buses.select(*SITE_ALL, "lon", "lat", "bus_point_source"),
        _flat(inner).select(*INTERNAL, "station_id", "qa_flags", "lons", "lats"),
        links.select(*DC, "lons", "lats"),
        trafos.select(*TRANSFORMER),
        cluster.select(*CLUSTER),
        prints.select(*FOOTPRINT, "station_id", "lons", "lats"),
        layers,
    )
