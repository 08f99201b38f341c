"""Queries of the topology stages: each runs a shipped stage over drawn scenes whose result SQL states in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions import measure as M
from gridweave.plans import network as N
from gridweave.plans import topology as O
from gridweave.plans.registry import CONFIG, query
from gridweave.plans.scenes import SCENE_SQL, conductor, footprint, on_map, scenes, together



def nth() -> Column:
    """The key of a scene."""
    return F.col("k")


def metres() -> Column:
    return F.round(M.planar_length(F.col("xs"), F.col("ys")), 3)


def _id(n: int) -> str:
    return f"'way/' || CAST(k * 10 + {n} AS VARCHAR)"


def _rows(*selects: str) -> str:
    return f"WITH {SCENE_SQL} " + " UNION ALL ".join(selects)


def _meeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two conductors that share an end: straight on, folded back, of different circuits, or joined by a third."""
    cells, case = scenes(spark, sf_dir), nth() % 4
    back = nth() % 8 == 4
    first = conductor(cells, 1, [(0, 0), (1000, 0)])
    ahead = conductor(cells, 2, [(1000, 0), (2000, 0)], (case == 0) & ~back)
    reverse = conductor(cells, 2, [(2000, 0), (1000, 0)], (case == 0) & back)
    folded = conductor(cells, 2, [(1000, 0), (200, 600)], case == 1)
    other = conductor(cells, 2, [(1000, 0), (2000, 0)], case == 2, circuits=2)
    tee = together(conductor(cells, 2, [(1000, 0), (2000, 0)], case == 3), conductor(cells, 3, [(1000, 0), (1000, 700)], case == 3))
    return together(first, ahead, reverse, folded, other, tee)


@query(
    _rows(
        f"SELECT {_id(1)} AS osm_id, 2 AS n_ways, {_id(1)} || ';' || {_id(2)} AS contains, CAST(2000 AS DOUBLE) AS metres FROM scene WHERE k % 4 = 0",
        f"SELECT {_id(1)}, 1, {_id(1)}, 1000 FROM scene WHERE k % 4 <> 0",
        f"SELECT {_id(2)}, 1, {_id(2)}, 1000 FROM scene WHERE k % 4 <> 0",
        f"SELECT {_id(3)}, 1, {_id(3)}, 700 FROM scene WHERE k % 4 = 3",
    )
)
def merge_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.merge_chains(_meeting(spark, sf_dir), CONFIG)
    return rows.select("osm_id", F.col("n_ways_merged").alias("n_ways"), F.array_join("contains", ";").alias("contains"), metres().alias("metres"))


@query(_rows(f"SELECT {_id(1)} AS a, 1 AS a_end, {_id(2)} AS b, CASE WHEN k % 8 = 4 THEN 1 ELSE 0 END AS b_end FROM scene WHERE k % 4 = 0"))
def endpoint_coincidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends that alone share a point, head-on, with equal parameters."""
    links = O.chain_links(_meeting(spark, sf_dir), CONFIG)
    name = lambda c: F.concat(F.lit("way/"), F.split(c, "/")[1].cast("long").cast("string"))
    return links.select(name("a").alias("a"), "a_end", name("b").alias("b"), "b_end")


GAP_SQL = "gap AS (SELECT k, CAST(10 + (k % 20) * 10 AS DOUBLE) AS g, k % 7 = 0 AS other_kv, k % 5 = 0 AS at_station FROM scene)"
CLOSED_SQL = "NOT other_kv AND NOT at_station"


@query(
    f"WITH {SCENE_SQL}, {GAP_SQL} SELECT {_id(1)} AS osm_id, 1000 + CASE WHEN {CLOSED_SQL} AND g <= 50 THEN g / 2 WHEN {CLOSED_SQL} AND g <= 150 THEN g ELSE 0 END AS metres, "
    f"CASE WHEN {CLOSED_SQL} AND g > 50 AND g <= 150 THEN 'end_bridged_synthetic_vertex' ELSE '' END AS qa FROM gap "
    f"UNION ALL SELECT {_id(2)}, 1000 + CASE WHEN {CLOSED_SQL} AND g <= 50 THEN g / 2 ELSE 0 END, '' FROM gap"
)
def end_to_end_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, gap = scenes(spark, sf_dir), (10 + (nth() % 20) * 10).cast("double")
    kv = F.when(nth() % 7 == 0, 220.0).otherwise(110.0)
    rows = together(conductor(cells, 1, [(0, 0), (1000, 0)]), conductor(cells, 2, [(gap + 1000, 0), (gap + 2000, 0)], kv=kv))
    stations = footprint(cells, 5, (1000, 100, 1200, 200), nth() % 5 == 0)
    out = O.join_ends(rows, stations, CONFIG)
    return out.select("osm_id", metres().alias("metres"), F.array_join("qa", ";").alias("qa"))


TEE_SQL = "tee AS (SELECT k, CAST(500 + (k % 10) * 100 AS DOUBLE) AS x, CAST((k % 6) * 10 AS DOUBLE) AS d, (k % 6) * 10 <= 25 AND k % 7 <> 0 AND k % 9 <> 0 AS cut FROM scene)"


@query(
    f"WITH {SCENE_SQL}, {TEE_SQL} SELECT {_id(1)} AS osm_id, 0 AS part, CASE WHEN cut THEN x ELSE 2000 END AS metres FROM tee UNION ALL SELECT {_id(1)}, 1, 2000 - x FROM tee WHERE cut "
    f"UNION ALL SELECT {_id(2)}, 0, CASE WHEN cut THEN 1000 WHEN k % 9 = 0 THEN round(sqrt(pow(1000, 2) + pow(100 - d, 2)), 3) ELSE 1000 - d END FROM tee"
)
def snap_split_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends near the inside of another conductor cut it, unless the voltage differs or they run nearly parallel."""
    cells = scenes(spark, sf_dir)
    x, d = (500 + (nth() % 10) * 100).cast("double"), ((nth() % 6) * 10).cast("double")
    kv = F.when(nth() % 7 == 0, 220.0).otherwise(110.0)
    slanted = nth() % 9 == 0
    rows = together(
        conductor(cells, 1, [(0, 0), (2000, 0)]),
        conductor(cells, 2, [(x, d), (F.when(slanted, x + 1000).otherwise(x), F.when(slanted, 100.0).otherwise(1000.0))], kv=kv),
    )
    out = O.snap_split(rows, CONFIG)
    part = F.when(F.size(F.split("key", "/")) > 4, F.element_at(F.split("key", "/"), -1).cast("int")).otherwise(0)
    return out.select("osm_id", part.alias("part"), metres().alias("metres"))


SITE_SQL = "site AS (SELECT k, 50 + (k % 5) * 50 AS g, 50 + (k % 5) * 50 <= 150 AS one FROM scene)"
SITES_SQL = (
    f"WITH {SCENE_SQL}, {SITE_SQL}, found AS (SELECT k, k * 10 + 1 AS least, {_id(1)} || ';' || {_id(2)} AS ids, 2 AS n, CASE WHEN k % 3 = 0 THEN 'West' ELSE 'East' END AS name, 'first' AS operator, k % 2 = 0 AS building FROM site WHERE one "
    f"UNION ALL SELECT k, k * 10 + 1, {_id(1)}, 1, 'West', 'first', true FROM site WHERE NOT one UNION ALL SELECT k, k * 10 + 2, {_id(2)}, 1, CASE WHEN k % 3 = 0 THEN NULL ELSE 'East' END, 'second', k % 2 = 0 FROM site WHERE NOT one) "
)


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, g = scenes(spark, sf_dir), (50 + (nth() % 5) * 50).cast("double")
    east = F.when(nth() % 3 != 0, "East")
    areas = together(
        footprint(cells, 1, (0, 0, 100, 100), name="West", operator="first", building=True),
        footprint(cells, 2, (g + 100, 0, g + 250, 100), name=east, operator="second", building=nth() % 2 == 0),
    )
    wires = conductor(cells, 3, [(50, 50), (g + 150, 50)], nth() % 2 == 1)
    return O.build_sites(areas, wires, CONFIG)[0]


@query(SITES_SQL + "SELECT ids AS osm_substation_ids, n AS n_sub_polygons, name AS station_name, operator, building AS under_construction FROM found")
def build_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints within reach of each other are one site: named by the largest named one, owned by the first."""
    return _sites(spark, sf_dir).select("osm_substation_ids", "n_sub_polygons", "station_name", "operator", "under_construction")


@query(SITES_SQL + "SELECT 'st' || lpad(CAST(row_number() OVER (ORDER BY least) AS VARCHAR), 7, '0') AS station_id, ids AS osm_substation_ids FROM found")
def station_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations are numbered in the order of their smallest element."""
    return _sites(spark, sf_dir).select("station_id", "osm_substation_ids")


@query(f"WITH {SCENE_SQL}, {SITE_SQL} SELECT {_id(1)} AS a, {_id(2)} AS b FROM site WHERE one")
def polygon_pairs_within_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, g = scenes(spark, sf_dir), (50 + (nth() % 5) * 50).cast("double")
    areas = together(footprint(cells, 1, (0, 0, 100, 100), name="West"), footprint(cells, 2, (g + 100, 0, g + 250, 100), name="East"))
    edges = O.site_edges(areas, conductor(cells, 3, [(50, 50), (g + 150, 50)]), CONFIG)
    name = lambda c: F.concat(F.lit("way/"), F.split(c, "/")[1].cast("long").cast("string"))
    return edges.select(name("a").alias("a"), name("b").alias("b"))


def _crossing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A conductor through, into, within or past a footprint, or through two."""
    cells, case = scenes(spark, sf_dir), nth() % 5
    y = F.when(case == 3, 500.0).otherwise(50.0)
    start, end = F.when(case == 1, 40.0).when(case == 2, 10.0).otherwise(-1000.0), F.when(case == 2, 90.0).otherwise(1500.0)
    areas = together(footprint(cells, 1, (0, 0, 100, 100), name="West"), footprint(cells, 2, (600, 0, 700, 100), case == 4, name="East"))
    return conductor(cells, 3, [(start, y), (end, y)]), areas


CROSSED_SQL = (
    "crossed AS (SELECT k, 0 AS place, 'inside' AS kind, CAST(CASE k % 5 WHEN 1 THEN 60 WHEN 2 THEN 80 ELSE 100 END AS DOUBLE) AS metres FROM scene WHERE k % 5 <> 3 UNION ALL SELECT k, 1, 'inside', 100 FROM scene WHERE k % 5 = 4 "
    "UNION ALL SELECT k, 0, 'outside', 1000 FROM scene WHERE k % 5 IN (0, 4) UNION ALL SELECT k, 1, 'outside', 1400 FROM scene WHERE k % 5 IN (0, 1) UNION ALL SELECT k, 0, 'outside', 2500 FROM scene WHERE k % 5 = 3 "
    "UNION ALL SELECT k, 1, 'outside', 500 FROM scene WHERE k % 5 = 4 UNION ALL SELECT k, 2, 'outside', 800 FROM scene WHERE k % 5 = 4)"
)


@query(f"WITH {SCENE_SQL}, {CROSSED_SQL} SELECT {_id(3)} AS osm_id, kind, metres FROM crossed")
def clip_conductors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, areas = _crossing(spark, sf_dir)
    _, polygons = O.build_sites(areas, rows, CONFIG)
    spans, internals = O.clip(rows, polygons, CONFIG)
    return together(*[t.select("osm_id", F.lit(kind).alias("kind"), metres().alias("metres")) for t, kind in ((spans, "outside"), (internals, "inside"))])


@query(f"WITH {SCENE_SQL} SELECT {_id(3)} AS osm_id, {_id(1)} AS polygon FROM scene WHERE k % 5 <> 3 UNION ALL SELECT {_id(3)}, {_id(2)} FROM scene WHERE k % 5 = 4")
def conductor_polygon_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = O.crossing_pairs(*_crossing(spark, sf_dir))
    name = lambda c: F.concat(F.lit("way/"), F.split(c, "/")[1].cast("long").cast("string"))
    return pairs.select(name("key").alias("osm_id"), name("pid").alias("polygon"))


def _approaches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(spans, polygons): spans that start at a fence, near it, beyond its reach, or lie at one station with both ends."""
    cells, case = scenes(spark, sf_dir), nth() % 5
    start = F.when(case == 1, 200.0).when(case == 2, 400.0).otherwise(100.0)
    end = F.when(case == 3, 120.0).when(case == 4, 180.0).otherwise(3000.0)
    areas = footprint(cells, 1, (0, 0, 100, 100), name="Yard").withColumn("station_id", F.concat(F.lit("st"), F.split("osm_id", "/")[1]))
    spans = conductor(cells, 2, [(start, 50), (end, 50)]).withColumn("order", F.lit(0.0))
    return spans, areas


STATION = "'st' || CAST(k * 10 + 1 AS VARCHAR)"


@query(
    f"WITH {SCENE_SQL} SELECT {_id(2)} AS osm_id, CASE WHEN k % 5 = 2 THEN NULL ELSE {STATION} END AS site0, CAST(NULL AS VARCHAR) AS site1, false AS internal, CASE WHEN k % 5 = 4 THEN 'approach_conductor_end_freed' ELSE '' END AS qa FROM scene WHERE k % 5 <> 3 "
    f"UNION ALL SELECT {_id(2)}, {STATION}, NULL, true, 'switchyard_jumper_self_loop' FROM scene WHERE k % 5 = 3"
)
def assign_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, areas = _approaches(spark, sf_dir)
    none = spans.withColumn("station_id", F.lit(None).cast("string")).limit(0)
    kept, inner = O.assign_ends(spans, none, areas, CONFIG)
    flags = F.array_join("qa", ";").alias("qa")
    one = kept.select("osm_id", "site0", "site1", F.lit(False).alias("internal"), flags)
    return one.unionByName(inner.select("osm_id", F.col("station_id").alias("site0"), F.lit(None).cast("string").alias("site1"), F.lit(True).alias("internal"), flags))


@query(f"WITH {SCENE_SQL} SELECT {_id(2)} AS osm_id, CAST(CASE k % 5 WHEN 1 THEN 100 WHEN 2 THEN 300 ELSE 0 END AS DOUBLE) AS d FROM scene WHERE k % 5 <> 2")
def nearest_site_of_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, areas = _approaches(spark, sf_dir)
    tips = O.ends(spans, CONFIG.gates.outward_sample, ("osm_id",)).where("end = 0")
    return O.near_polygon(tips, areas, CONFIG.gates.site_catchment, ["osm_id"]).select("osm_id", F.round("d", 3).alias("d"))


def _free(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spans whose ends lie g metres apart in a row, g from 5 to 45; the middle one is the medoid."""
    cells, g = scenes(spark, sf_dir), (5 + (nth() % 5) * 10).cast("double")
    rows = together(
        conductor(cells, 1, [(0, 0), (0, 1000)]), conductor(cells, 2, [(g, 0), (g, -1000)]), conductor(cells, 3, [(g * 2, 0), (2000, 0)]),
    )
    none = F.lit(None).cast("string")
    return rows.withColumn("order", F.lit(0.0)).withColumn("site0", none).withColumn("site1", none)


@query(
    f"WITH {SCENE_SQL}, near AS (SELECT k, CAST(5 + (k % 5) * 10 AS DOUBLE) AS g FROM scene) "
    f"SELECT {_id(1)} AS osm_id, {_id(1)} AS shared_with, g AS x, round(sqrt(g * g + 1000000), 3) AS metres FROM near UNION ALL SELECT {_id(2)}, {_id(1)}, g, 1000 FROM near UNION ALL SELECT {_id(3)}, {_id(1)}, g, 2000 - g FROM near"
)
def cluster_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free ends near each other become one junction at their medoid and move onto it."""
    spans, junctions = O.cluster_junctions(_free(spark, sf_dir), CONFIG)
    first = spans.groupBy("node0").agg(F.min("osm_id").alias("shared_with"))
    placed = spans.join(first, "node0").join(junctions.select(F.col("node_id").alias("node0"), "x"), "node0")
    cell = F.floor((F.split("osm_id", "/")[1].cast("long")) / 10)
    return placed.select("osm_id", "shared_with", F.round(F.col("x") - (cell % 400) * 10_000, 3).alias("x"), metres().alias("metres"))


@query(f"WITH {SCENE_SQL} SELECT 'jn' || lpad(CAST(row_number() OVER (ORDER BY x, y) AS VARCHAR), 7, '0') AS node_id, x, y FROM (SELECT x0 AS x, y0 AS y FROM scene UNION ALL SELECT x0 + 500, y0 FROM scene)")
def junction_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junctions are numbered by position."""
    none = F.lit(None).cast("string")
    rows = conductor(scenes(spark, sf_dir), 1, [(0, 0), (500, 0)]).withColumn("order", F.lit(0.0)).withColumn("site0", none).withColumn("site1", none)
    return O.cluster_junctions(rows, CONFIG)[1].select("node_id", "x", "y")


def _noded(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(spans, internals, sites, junctions, polygons): a station and a junction in each scene."""
    areas = footprint(cells, 1, (0, 0, 100, 100), name="Yard", operator="owner")
    sites, polygons = O.build_sites(areas, conductor(cells, 9, [(3000, 3000), (3100, 3000)]), CONFIG)
    station = polygons.select(F.floor(F.split("osm_id", "/")[1].cast("long") / 10).alias("k"), "station_id")
    spans = conductor(cells, 2, [(100, 50), (2000, 50)]).withColumn("k", F.floor(F.split("osm_id", "/")[1].cast("long") / 10)).join(station, "k")
    spans = spans.withColumn("order", F.lit(0.0)).withColumn("node0", F.col("station_id")).withColumn("node1", F.format_string("jn%07d", "k")).drop("k", "station_id")
    bars = conductor(cells, 3, [(20, 30), (60, 30)], nth() % 2 == 0).withColumn("k", F.floor(F.split("osm_id", "/")[1].cast("long") / 10)).join(station, "k")
    junctions = cells.select(F.format_string("jn%07d", "k").alias("node_id"), (F.col("x0") + 2010).alias("x"), (F.col("y0") + 50).alias("y"))
    return spans, bars.drop("k"), sites, junctions, polygons


BUS_SQL = (
    "station AS (SELECT *, 'st' || lpad(CAST(row_number() OVER (ORDER BY k) AS VARCHAR), 7, '0') AS st, 'jn' || lpad(CAST(k AS VARCHAR), 7, '0') AS jn FROM scene)"
)


@query(
    f"WITH {SCENE_SQL}, {BUS_SQL} SELECT st || '_110kV' AS bus_id, 'substation' AS node_type, CASE WHEN k % 2 = 0 THEN 'busbar_centroid' ELSE 'pole_of_inaccessibility' END AS source, 'Yard' AS station_name, x0 + CASE WHEN k % 2 = 0 THEN 40 ELSE 50 END AS x, y0 + CASE WHEN k % 2 = 0 THEN 30 ELSE 50 END AS y FROM station "
    "UNION ALL SELECT jn || '_110kV', 'junction', 'junction_medoid', NULL, x0 + 2010, y0 + 50 FROM station"
)
def build_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, bars, sites, junctions, polygons = _noded(scenes(spark, sf_dir))
    buses = O.build_buses(spans, bars, sites, junctions, polygons, CONFIG)
    return buses.select("bus_id", "node_type", F.col("bus_point_source").alias("source"), "station_name", F.round("x", 0).alias("x"), F.round("y", 0).alias("y"))


@query(
    f"WITH {SCENE_SQL}, {BUS_SQL} SELECT {_id(2)} AS osm_id, st || '_110kV' AS bus0, jn || '_110kV' AS bus1, CAST(4 AS INTEGER) AS n_points, true AS connected0, true AS connected1 FROM station"
)
def attach_connectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans, bars, sites, junctions, polygons = _noded(on_map(scenes(spark, sf_dir)))
    out = N.attach_connectors(spans, O.build_buses(spans, bars, sites, junctions, polygons, CONFIG), CONFIG)
    return out.select("osm_id", "bus0", "bus1", F.size("lons").alias("n_points"), (F.col("connector0_m") > 0).alias("connected0"), (F.col("connector1_m") > 0).alias("connected1"))


@query(
    f"WITH {SCENE_SQL} SELECT {_id(1)} AS osm_id, k % 3 = 0 AS internal, CASE WHEN k % 3 <> 0 THEN '' WHEN k % 2 = 0 THEN 'long_self_loop' ELSE 'micro_self_loop' END AS qa, CASE WHEN k % 3 = 0 AND k % 4 < 2 THEN 'st' || CAST(k AS VARCHAR) END AS station_id FROM scene"
)
def sweep_self_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    reach = F.when(nth() % 2 == 0, 1500.0).otherwise(300.0)
    rows = conductor(scenes(spark, sf_dir), 1, [(0, 0), (reach, 0)])
    key = F.floor(F.split("osm_id", "/")[1].cast("long") / 10)
    node = F.concat(F.when(key % 4 < 2, "st").otherwise("jn"), key.cast("string"))
    rows = rows.withColumn("node0", node).withColumn("node1", F.when(key % 3 == 0, node).otherwise("jn-other"))
    none = rows.withColumn("station_id", F.lit(None).cast("string")).limit(0)
    spans, inner = O.sweep_self_loops(rows, none, CONFIG)
    flags = F.array_join("qa", ";").alias("qa")
    one = spans.select("osm_id", F.lit(False).alias("internal"), flags, F.lit(None).cast("string").alias("station_id"))
    return one.unionByName(inner.select("osm_id", F.lit(True).alias("internal"), flags, "station_id"))


@query(
    f"WITH {SCENE_SQL} SELECT {_id(1)} AS osm_id, 'a' || CAST(k AS VARCHAR) AS node0, 'c' || CAST(k AS VARCHAR) AS node1, CAST(2000 AS DOUBLE) AS metres FROM scene WHERE k % 2 = 0 "
    f"UNION ALL SELECT {_id(1)}, 'a' || CAST(k AS VARCHAR), 'b' || CAST(k AS VARCHAR), 1000 FROM scene WHERE k % 2 = 1 UNION ALL SELECT {_id(1)}, 'b' || CAST(k AS VARCHAR), 'c' || CAST(k AS VARCHAR), 1000 FROM scene WHERE k % 2 = 1 "
    f"UNION ALL SELECT {_id(2)}, 'b' || CAST(k AS VARCHAR), 'd' || CAST(k AS VARCHAR), 500 FROM scene WHERE k % 2 = 1"
)
def dissolve_junctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two spans of an element are fused at a junction that only they meet; a third element keeps them apart."""
    cells = scenes(spark, sf_dir)

    def span(n: int, part: int, a: str, b: str, points: list, when=None) -> DataFrame:  # noqa: ANN001
        rows = conductor(cells, n, points, when)
        key = F.floor(F.split("osm_id", "/")[1].cast("long") / 10).cast("string")
        rows = rows.withColumn("key", F.concat_ws("/", "key", F.lit(f"{part:03d}"))).withColumn("order", F.lit(float(part)))
        return rows.withColumn("node0", F.concat(F.lit(a), key)).withColumn("node1", F.concat(F.lit(b), key))

    rows = together(
        span(1, 0, "a", "b", [(0, 0), (1000, 0)]), span(1, 1, "b", "c", [(1000, 0), (2000, 0)]), span(2, 0, "b", "d", [(1000, 0), (1000, 500)], nth() % 2 == 1),
    )
    out = O.dissolve_junctions(rows, CONFIG)
    return out.select("osm_id", "node0", "node1", metres().alias("metres"))


@query(
    f"WITH {SCENE_SQL} SELECT 'b' || CAST(k AS VARCHAR) AS bus_id, CASE WHEN (k % 5) * 100 <= 300 AND k % 7 <> 0 THEN 'a' ELSE 'b' END || CAST(k AS VARCHAR) AS merged_into FROM scene"
)
def merge_across_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junctions within 300 m of each other become one where nothing else connects them."""
    cells, d = scenes(spark, sf_dir), ((nth() % 5) * 100).cast("double")
    tied = nth() % 7 == 0

    def span(n: int, a: str, b: str, points: list, when=None) -> DataFrame:  # noqa: ANN001
        key = F.floor(F.split("osm_id", "/")[1].cast("long") / 10).cast("string")
        return conductor(cells, n, points, when).withColumn("node0", F.concat(F.lit(a), key)).withColumn("node1", F.concat(F.lit(b), key))

    spans = together(
        span(1, "a", "p", [(0, 0), (0, 2000)]), span(2, "b", "q", [(d, 0), (d, -2000)]), span(3, "p", "q", [(0, 2000), (0, -2000)], tied),
    )
    at = {"a": (F.lit(0.0), F.lit(0.0)), "b": (d, F.lit(0.0)), "p": (F.lit(0.0), F.lit(2000.0)), "q": (d, F.lit(-2000.0))}
    buses = together(
        *[
            cells.select(F.concat(F.lit(n), nth().cast("string"), F.lit("_110kV")).alias("bus_id"), F.concat(F.lit(n), nth().cast("string")).alias("node_id"), F.lit("junction").alias("node_type"), F.lit(110.0).alias("voltage_kv"), F.lit(50.0).alias("frequency_hz"), (F.col("x0") + x).alias("x"), (F.col("y0") + y).alias("y"))
            for n, (x, y) in at.items()
        ]
    )
    out, _ = O.merge_across_components(spans, buses, CONFIG)
    own = out.where(F.col("osm_id").endswith("2"))
    key = F.floor(F.split("osm_id", "/")[1].cast("long") / 10).cast("string")
    return own.select(F.concat(F.lit("b"), key).alias("bus_id"), F.col("node0").alias("merged_into"))
