"""Elements to conductor, substation and DC records: one record per element, part and voltage."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions import geometry as G
from gridweave.functions import tags as T
from gridweave.plans.storage import materialise
from gridweave.sources.elements import latest, usable

PATHS = "array<array<array<double>>>"


def _paths(column: pd.Series) -> list[list[np.ndarray]]:
    return [[np.array([list(p) for p in part]) for part in parts] for parts in column]


def _joined_parts(parts: pd.Series) -> pd.Series:
    return pd.Series([[p.tolist() for p in G.joined(own)] for own in _paths(parts)])


def _footprints(rings: pd.Series) -> pd.DataFrame:
    found = [G.footprint(own) for own in _paths(rings)]
    return pd.DataFrame({"ring": [f[0].tolist() if f else None for f in found], "used_hull": [f[1] if f else None for f in found]})


def within_scope(points: Column, box: tuple[float, float, float, float] | None, closed: bool = False) -> Column:
    """Whether a path, or with ``closed`` the area in a ring, meets the box (south, west, north, east); true without a scope.

    Bounds decide where they can: only a path that has vertices outside and bounds that overlap is tested exactly.
    """
    if box is None:
        return F.lit(True)
    lon, lat = F.transform(points, lambda p: F.get(p, F.lit(0))), F.transform(points, lambda p: F.get(p, F.lit(1)))
    south, west, north, east = box
    overlap = (F.array_max(lon) >= west) & (F.array_min(lon) <= east) & (F.array_max(lat) >= south) & (F.array_min(lat) <= north)
    vertex = F.exists(points, lambda p: F.get(p, F.lit(0)).between(west, east) & F.get(p, F.lit(1)).between(south, north))
    edge = np.array([(west, south), (east, south), (east, north), (west, north), (west, south)], float)

    def meets(paths: pd.Series) -> pd.Series:
        out = []
        for points in paths:
            path = np.array([list(p) for p in points]) if points is not None else np.zeros((0, 2))
            out.append(len(path) > 1 and bool(G.crossings(path, edge) or (closed and G.inside(path, edge[:1])[0])))
        return pd.Series(out, dtype=bool)

    unclear = F.when(overlap & ~vertex, points)
    return F.coalesce(overlap & (vertex | F.pandas_udf(meets, "boolean")(unclear)), F.lit(False))


def element_key(oid: str = "oid") -> Column:
    """An element id that sorts by kind and number as text."""
    key = T.element_key(F.col(oid))
    return F.format_string("%s/%020d", key["kind"], key["number"])


def substations(elements: DataFrame, config: Config) -> DataFrame:
    """``osm_id, name, operator, voltage_kv, under_construction, ring, used_hull`` in degrees."""
    rows = elements.where("power = 'substation'")
    members = F.transform(F.filter("members", lambda m: F.size(m["geometry"]) >= 2), lambda m: m["geometry"])
    rings = F.when(F.col("type") == "way", F.array("geometry")).otherwise(members).cast(PATHS)
    built = F.pandas_udf(_footprints, "ring array<array<double>>, used_hull boolean")
    rows = rows.withColumn("rings", rings).where("size(rings) > 0 and size(rings[0]) >= 2").withColumn("f", built("rings"))
    tags = F.col("tags")
    out = rows.where("f.ring is not null").select(
        F.col("oid").alias("osm_id"),
        tags["name"].alias("name"),
        tags["operator"].alias("operator"),
        T.largest_voltage_kv(tags).alias("voltage_kv"),
        T.under_construction(tags).alias("under_construction"),
        "f.ring",
        "f.used_hull",
    )
    return out.where(within_scope(F.col("ring"), config.scope_bbox, closed=True))


def relations(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, superseded): conductor relations that stand for their ways, and the ids that they replace.

    A relation whose parts join into one path replaces its member ways. Any other is dropped if one of its ways is there,
    else its strands are kept. Relations of the same member ways and voltage tag are one corridor: the smallest id
    survives with as many circuits, and is marked ambiguous where circuits, cables or operator differ.
    """
    ways = elements.where("type = 'way' and power <> 'substation' and size(geometry) >= 2").select("oid")
    rows = elements.where("type = 'relation' and power <> 'substation'")
    parts = F.transform(F.filter("members", lambda m: F.size(m["geometry"]) >= 2), lambda m: m["geometry"]).cast(PATHS)
    named = F.filter("members", lambda m: (m["type"] == "way") & m["ref"].isNotNull())
    members = F.transform(named, lambda m: F.concat(F.lit("way/"), m["ref"].cast("string")))
    rows = rows.withColumn("parts", parts).withColumn("ways", members).where("size(parts) > 0")
    rows = rows.withColumn("parts", F.pandas_udf(_joined_parts, PATHS)("parts"))
    rows = materialise(rows.select("oid", element_key().alias("key"), "tags", "parts", "ways"), "relations")
    merging = F.size("parts") == 1
    present = rows.where(~merging).select("oid", F.explode("ways").alias("way")).join(ways, F.col("way") == ways["oid"], "left_semi").select("oid").distinct()
    stand = rows.where(merging).unionByName(rows.where(~merging).join(present, "oid", "left_anti"))
    tags = F.col("tags")
    group = stand.where("size(ways) > 0").groupBy(F.array_sort("ways").alias("corridor"), tags["voltage"].alias("voltage"))
    distinct = [F.count_distinct(F.coalesce(tags[k], F.lit("\0"))) for k in ("circuits", "cables", "operator")]
    groups = group.agg(
        F.min(F.struct("key", "oid")).alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set("oid")).alias("oids"),
        (F.greatest(*distinct) > 1).alias("ambiguous"),
    ).where("n > 1")
    groups = groups.select(F.col("first.oid").alias("oid"), F.col("n").cast("int").alias("duplicates"), F.array_except("oids", F.array("first.oid")).alias("absorbed"), "ambiguous")
    dropped = groups.select(F.explode("absorbed").alias("oid"))
    kept = stand.join(dropped, "oid", "left_anti").join(groups, "oid", "left")
    superseded = rows.where(merging).select(F.explode("ways").alias("oid")).unionByName(dropped).distinct()
    kinds = elements.select(F.col("oid").alias("way"), T.construction(F.col("tags"))["kind"].alias("kind"), F.size("tags").alias("n_tags")).where("n_tags > 0")
    member_kinds = kept.select("oid", F.explode("ways").alias("way")).join(kinds, "way").groupBy("oid").agg(F.array_sort(F.collect_set("kind")).alias("member_kinds"))
    return kept.join(member_kinds, "oid", "left"), superseded


def records(raw: DataFrame, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conductors, substations, dc): stored records with paths in degrees (``lons, lats`` and rings)."""
    elements = materialise(usable(latest(raw)), "elements")
    kept, superseded = relations(elements)
    ways = elements.where("type = 'way' and power <> 'substation' and size(geometry) >= 2").join(superseded, "oid", "left_anti")
    none = F.lit(None)
    single = ways.select(
        "oid", "tags", F.array("geometry").cast(PATHS).alias("parts"), none.cast("int").alias("duplicates"), none.cast("array<string>").alias("absorbed"),
        none.cast("boolean").alias("ambiguous"), none.cast("array<string>").alias("member_kinds"),
    )
    every = single.unionByName(kept.select(*single.columns))
    every = every.select("*", F.posexplode("parts").alias("part", "path")).drop("parts").where(within_scope(F.col("path"), config.scope_bbox))
    tags = F.col("tags")
    every = every.withColumn("dc", T.is_dc(tags) | F.col("oid").isin(list(config.force_dc_ids) or [""]))
    every = every.withColumn("lons", F.transform("path", lambda p: F.get(p, F.lit(0)))).withColumn("lats", F.transform("path", lambda p: F.get(p, F.lit(1))))
    dc = every.where("dc").select(
        F.col("oid").alias("osm_id"), "part", element_key().alias("key"), tags["name"].alias("name"), tags["operator"].alias("operator"),
        T.largest_voltage_kv(tags).alias("voltage_kv"), T.under_construction(tags).alias("under_construction"), "lons", "lats",
    )
    kv = every.where("not dc").withColumn("kvs", T.voltages(tags, config.voltage_floor_kv)).withColumn("count", F.size("kvs"))
    kv = kv.withColumn("v", F.explode("kvs")).withColumn("kv", F.col("v.kv"))
    index, count = F.col("v.index"), F.col("count")
    circuits, made, hz = T.circuits(tags, count, index), T.construction(tags, F.col("member_kinds")), T.frequency(tags, F.col("kv"), count, index, config)
    kv = kv.withColumn("c", circuits).withColumn("m", made).withColumn("f", hz).where("f.hz <> 0")
    flags = T.add_flag(F.array_sort("f.flags"), "circuit_count_element_level_ambiguous", F.col("ambiguous"))
    standard = [float(v) for v in config.standard_voltages_kv]
    if standard:
        flags = T.add_flag(flags, "nonstandard_voltage", ~F.col("kv").isin(standard))
    flags = T.add_flag(flags, "under_construction", T.under_construction(tags))
    conductors = kv.select(
        F.concat_ws("/", element_key(), F.format_string("%03d", index), F.format_string("%03d", "part")).alias("key"),
        F.col("oid").alias("osm_id"),
        F.array_union(F.array("oid"), F.coalesce("absorbed", F.array().cast("array<string>"))).alias("contains"),
        F.lit(1).alias("n_ways_merged"),
        F.col("kv").alias("voltage_kv"),
        F.greatest(F.col("c.n"), F.coalesce("duplicates", F.lit(1))).alias("n_circuits"),
        F.when(F.col("duplicates").isNotNull(), "duplicate_relation_group_collapsed").otherwise(F.col("c.source")).alias("circuits_source"),
        F.col("m.kind").alias("construction_type"),
        F.col("m.source").alias("construction_source"),
        T.under_construction(tags).alias("under_construction"),
        F.col("f.hz").alias("frequency_hz"),
        F.col("f.source").alias("frequency_source"),
        tags["name"].alias("name"),
        tags["ref"].alias("ref"),
        tags["operator"].alias("operator"),
        F.coalesce(tags["addr:country"], tags["country"], F.lit("")).alias("tag_country"),
        flags.alias("qa"),
        "lons",
        "lats",
    )
    return materialise(conductors, "conductors"), materialise(substations(elements, config), "substations"), materialise(dc, "dc")


def with_countries(rows: DataFrame, config: Config, polygons: DataFrame | None = None) -> DataFrame:
    """Adds ``countries``, sorted and joined by semicolons, from the configured source.

    ``polygons`` (``country, ring`` and optionally ``holes``) are joined on one-degree cells and tested exactly: a path counts
    for a country if it meets the ring's area and does not lie inside a hole.
    """
    if config.country_source == "none":
        return rows.withColumn("countries", F.lit(""))
    if config.country_source == "osm_tag":
        return rows.withColumn("countries", F.col("tag_country"))
    from gridweave.operators.spatial import box_cells, path_cells

    lon, lat = F.transform("ring", lambda p: F.get(p, F.lit(0))), F.transform("ring", lambda p: F.get(p, F.lit(1)))
    holes = polygons if "holes" in polygons.columns else polygons.withColumn("holes", F.lit(None).cast(PATHS))
    ringed = holes.select("country", "holes", lon.alias("rx"), lat.alias("ry"))
    areas = box_cells(ringed, 1.0, 0.0, F.array_min("rx"), F.array_min("ry"), F.array_max("rx"), F.array_max("ry"))
    paths = path_cells(rows.select("key", F.col("lons").alias("xs"), F.col("lats").alias("ys")), 1.0, 0.0, ["key"])

    def touches(xs: pd.Series, ys: pd.Series, rx: pd.Series, ry: pd.Series, holes: pd.Series) -> pd.Series:
        out = []
        for a, b, c, d, inner in zip(xs, ys, rx, ry, holes, strict=True):
            path, ring = np.column_stack([a, b]), np.column_stack([c, d])
            met = bool(G.inside(ring, path[:1])[0] or G.crossings(path, ring))
            gaps = [np.array([list(p) for p in hole]) for hole in inner] if met and inner is not None else []
            out.append(met and not any(G.inside(gap, path[:1])[0] and not G.crossings(path, gap) for gap in gaps))
        return pd.Series(out)

    met = paths.join(areas, ["cx", "cy"]).select("key", "country", "rx", "ry", "holes").dropDuplicates(["key", "country", "rx", "ry"])
    met = met.join(rows.select("key", "lons", "lats"), "key").where(F.pandas_udf(touches, "boolean")("lons", "lats", "rx", "ry", "holes"))
    found = met.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("country")), ";").alias("countries"))
    return rows.join(found, "key", "left").withColumn("countries", F.coalesce("countries", F.lit("")))


def with_traction(rows: DataFrame, config: Config) -> DataFrame:
    """Frequency by operator, where the tags are silent."""
    by = T.traction_by_operator(F.col("voltage_kv"), F.col("frequency_source"), F.col("countries"), F.col("operator"), config.traction)
    return (
        rows.withColumn("by", by)
        .withColumn("qa", F.when(F.col("by"), F.array_remove("qa", "frequency_assumed_ac")).otherwise(F.col("qa")))
        .withColumn("frequency_hz", F.when(F.col("by"), config.traction.frequency_hz).otherwise(F.col("frequency_hz")))
        .withColumn("frequency_source", F.when(F.col("by"), "operator_inferred").otherwise(F.col("frequency_source")))
        .drop("by")
    )


def projected(rows: DataFrame, config: Config, x: str = "lons", y: str = "lats") -> DataFrame:
    """Adds ``xs, ys`` in the metric CRS for coordinate columns in degrees."""
    crs = config.metric_crs

    def run(lons: pd.Series, lats: pd.Series) -> pd.DataFrame:
        forward, _ = G.projection(crs)
        sizes = [len(v) for v in lons]
        flat = forward(np.column_stack([np.concatenate(lons.to_list()), np.concatenate(lats.to_list())])) if len(lons) else np.zeros((0, 2))
        cuts = np.cumsum(sizes)[:-1]
        return pd.DataFrame({"xs": np.split(flat[:, 0], cuts) if sizes else [], "ys": np.split(flat[:, 1], cuts) if sizes else []})

    return rows.withColumn("m", F.pandas_udf(run, "xs array<double>, ys array<double>")(x, y)).select("*", "m.xs", "m.ys").drop("m")
