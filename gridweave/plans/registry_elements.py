"""Queries of sources, sinks and record parsing: elements made from the driver tables, written, read and parsed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.config import Config, from_mapping
from gridweave.functions import tags as T
from gridweave.plans import export, harvest
from gridweave.plans import network as N
from gridweave.plans import parse as P
from gridweave.plans import synthetic as S
from gridweave.plans import validate as V
from gridweave.plans.registry import CONFIG, EXPLODED, POSITIONAL, query
from gridweave.plans.storage import fresh_path
from gridweave.sources import elements as E
from gridweave.sources import gpkg, tables

POINT = "array<array<double>>"
MEMBERS = "array<struct<type:string,ref:bigint,role:string,geometry:array<array<double>>>>"


def part_key() -> Column:
    return F.col("p_partkey")


def _path(*points: tuple[Column | float, Column | float]) -> Column:
    value = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("double")
    return F.array(*[F.array(value(x), value(y)) for x, y in points])


def _tags(**tags: Column | str) -> Column:
    return F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v))])


def _way(number: Column, tags: Column, geometry: Column) -> list[Column]:
    """Columns of an element that is a way."""
    return [
        F.concat(F.lit("way/"), number.cast("string")).alias("oid"), F.lit("way").alias("type"), number.cast("long").alias("id"), tags.alias("tags"), geometry.alias("geometry"),
        F.lit(None).cast(MEMBERS).alias("members"), F.lit(1).alias("size"), F.lit("f").alias("file"),
    ]


def _one_file(lines: DataFrame, target: str) -> None:
    """Lines (``value``) as one text file of that name."""
    spark = lines.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    lines.coalesce(1).write.text(f"{target}.part")
    files = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in files.listStatus(hadoop.Path(f"{target}.part")) if s.getPath().getName().startswith("part-"))
    files.rename(part, hadoop.Path(target))
    files.delete(hadoop.Path(f"{target}.part"), True)


@query("SELECT 'way/' || CAST(p_partkey AS VARCHAR) AS oid, 2 + CAST(p_partkey % 2 = 0 AS INTEGER) AS n_tags, CAST(2 + p_partkey % 3 AS INTEGER) AS n_points, CAST(p_partkey AS DOUBLE) / 8 AS first_lon FROM part")
def ndjson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements written as NDJSON and read back, with blank lines among them."""
    path = f"{fresh_path(spark, 'elements')}/raw"
    base = {"power": F.lit("line"), "voltage": F.lit("110000")}
    tags = F.when(part_key() % 2 == 0, _tags(**base, name=F.concat(F.lit('a "b" é '), part_key().cast("string")))).otherwise(_tags(**base))
    points = F.transform(F.sequence(F.lit(0), (part_key() % 3 + 1).cast("int")), lambda i: F.array(part_key().cast("double") / 8 + i, F.lit(50.0)))
    rows = S.table(spark, sf_dir, "part").select(*_way(part_key(), tags, points))
    E.write_elements(rows, path)
    _one_file(spark.range(5).select(F.lit("  ").alias("value")), f"{path}/blank.ndjson")
    if not E.readable(spark, path):
        raise ValueError("what was written cannot be read")
    read = E.read_elements(spark, path)
    return read.select("oid", F.size("tags").alias("n_tags"), F.size("geometry").alias("n_points"), F.get(F.get("geometry", F.lit(0)), F.lit(0)).alias("first_lon"))


@query("SELECT row_number() OVER (ORDER BY r_name) - 1 AS number, r_name || '.ndjson' AS name FROM region")
def listed_element_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files below a folder in the order of their paths."""
    path = fresh_path(spark, "listing")
    for row in S.table(spark, sf_dir, "region").collect():  # five
        _one_file(spark.range(1).select(F.lit("{}").alias("value")), f"{path}/{row['r_name']}.ndjson")
    return E.listed_files(spark, path).select("number", F.element_at(F.split("file", "/"), -1).alias("name"))


@query("SELECT 'way/' || CAST(p_partkey AS VARCHAR) AS oid, CASE WHEN p_partkey % 3 = 1 THEN 'b' ELSE 'a' END AS file, CAST(CASE WHEN p_partkey % 3 = 1 THEN 30 WHEN p_partkey % 3 = 2 THEN 20 ELSE 10 END AS INTEGER) AS size FROM part")
def longest_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of an element's copies the longest; of equally long ones that of the first file."""
    parts = S.table(spark, sf_dir, "part")
    base = parts.select(*_way(part_key(), _tags(power="line"), _path((0, 0), (1, 1)))).drop("size", "file").withColumn("k", F.col("id") % 3)
    copies = base.withColumn("file", F.explode(F.array(*map(F.lit, "cba"))))
    b = F.col("file") == "b"
    size = F.when(F.col("k") == 0, 10).when(F.col("k") == 1, F.when(b, 30).otherwise(10)).otherwise(F.when(b, 10).otherwise(20))
    return E.latest(copies.withColumn("size", size).drop("k")).select("oid", "file", "size")





@query(
    f"WITH e AS (SELECT p_partkey AS k, {S.pick_sql('p_partkey', ['line', ' Busbar', 'cable', 'bay'])} AS power FROM part) "
    "SELECT 'relation/' || CAST(k AS VARCHAR) AS oid, lower(trim(power)) AS power, CAST(CASE WHEN k % 3 = 0 THEN 2 ELSE 3 END AS INTEGER) AS n_members FROM e WHERE k % 4 IN (0, 2)"
)
def usable_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without equipment inside stations, and without members in roles that are not conductors."""
    members = F.transform(F.array(*map(F.lit, ["", "outer", "Tower "])), lambda r: F.struct(F.lit("way").alias("type"), F.lit(1).cast("long").alias("ref"), F.when((r == "Tower ") & (part_key() % 3 != 0), "inner").otherwise(r).alias("role"), F.lit(None).cast(POINT).alias("geometry")))
    power = S.pick(part_key(), ["line", " Busbar", "cable", "bay"])
    rows = S.table(spark, sf_dir, "part").select(F.concat(F.lit("relation/"), part_key().cast("string")).alias("oid"), F.lit("relation").alias("type"), part_key().alias("id"), _tags(power=power).alias("tags"), F.lit(None).cast(POINT).alias("geometry"), members.alias("members"))
    return E.usable(rows).select("oid", "power", F.size("members").alias("n_members"))


@query("SELECT 'way/' || CAST(p_partkey AS VARCHAR) AS oid, round(p_partkey / CAST(7 AS DOUBLE), 7) AS lon, round(p_retailprice / 3, 7) AS lat FROM part WHERE p_partkey % 5 <> 0")
def normalised_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates to seven places; ways of one point go."""
    lon, lat = part_key() / F.lit(7.0), F.col("p_retailprice") / 3
    points = F.when(part_key() % 5 == 0, _path((lon, lat))).otherwise(_path((lon, lat), (1, 1)))
    rows = E.normalised(S.table(spark, sf_dir, "part").select(*_way(part_key(), _tags(power="line"), points)))
    first = F.get("geometry", F.lit(0))
    return rows.select("oid", F.get(first, F.lit(0)).alias("lon"), F.get(first, F.lit(1)).alias("lat"))


@query("WITH e AS (SELECT p_partkey, CAST(p_partkey % 50 AS DOUBLE) / 10 + 0.05 AS t FROM part) SELECT p_partkey, t > 1 AND t < 3 AS open_path, t > 1 AND t < 3 AS closed_area FROM e")
def scope_intersects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagonals and thin triangles against a box that their bounds overlap: they count only where they meet it."""
    t, box = (part_key() % 50).cast("double") / 10 + 0.05, (0.0, 0.0, 1.0, 1.0)
    rows = S.table(spark, sf_dir, "part").withColumn("path", _path((-1, t), (t, -1))).withColumn("ring", _path((-1, t), (t, -1), (t + 0.01, -1), (-1, t)))
    return rows.select("p_partkey", P.within_scope(F.col("path"), box).alias("open_path"), P.within_scope(F.col("ring"), box, closed=True).alias("closed_area"))


def _tagged_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.tagged(spark, sf_dir)
    return rows.select(*_way(part_key(), F.col("tags"), _path((part_key() % 90, 50), (part_key() % 90, 51))))


@query(
    POSITIONAL + f", num2 AS (SELECT v.p_partkey, v.idx, v.kv, {S.NUMBER_SQL.format('c')} AS c, {S.NUMBER_SQL.format('w')} AS w FROM pos v JOIN tag t ON t.p_partkey = v.p_partkey WHERE coalesce(t.frequency, '') <> '0') "
    "SELECT 'way/' || CAST(p_partkey AS VARCHAR) AS osm_id, kv AS voltage_kv, CAST(CASE WHEN c >= 1 THEN floor(c) WHEN w >= 3 THEN floor(w / 3) ELSE 1 END AS INTEGER) AS n_circuits FROM num2"
)
def conductor_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per way and voltage, without direct current."""
    return P.records(_tagged_ways(spark, sf_dir), CONFIG)[0].select("osm_id", "voltage_kv", "n_circuits")


@query(
    EXPLODED + f", every AS (SELECT o.p_partkey, max({S.NUMBER_SQL.format('part')}) / 1000 AS kv FROM one o GROUP BY 1) "
    "SELECT 'way/' || CAST(t.p_partkey AS VARCHAR) AS osm_id, CAST(round_even(kv, 0) AS INTEGER) AS voltage_kv FROM tag t LEFT JOIN every e ON t.p_partkey = e.p_partkey WHERE t.frequency = '0'"
)
def direct_current_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways whose every frequency is zero, with their largest voltage."""
    return P.records(_tagged_ways(spark, sf_dir), CONFIG)[2].select("osm_id", "voltage_kv")


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ways and a relation of them per customer: joining, broken with its ways there, broken without, or doubled."""
    k = F.col("c_custkey")
    rows = S.table(spark, sf_dir, "customer")
    gap = F.when((k % 4).isin(1, 2), 0.5).otherwise(0.0)
    one, two = _path((0, 0), (1, 0)), _path((gap + 1, 0), (2, 0))
    tags = _tags(power="line", voltage="110000")
    first, second = rows.where(k % 4 != 2).select(*_way(k * 10 + 1, tags, one)), rows.where(k % 4 != 2).select(*_way(k * 10 + 2, tags, two))

    def member(n: int, path: Column) -> Column:
        return F.struct(F.lit("way").alias("type"), (k * 10 + n).cast("long").alias("ref"), F.lit("").alias("role"), path.alias("geometry"))

    def relation(n: int, where: Column, **more: str) -> DataFrame:
        number = k * 10 + n
        own = _tags(route="power", voltage="110000", **more)
        return rows.where(where).select(
            F.concat(F.lit("relation/"), number.cast("string")).alias("oid"), F.lit("relation").alias("type"), number.cast("long").alias("id"), own.alias("tags"), F.lit(None).cast(POINT).alias("geometry"),
            F.array(member(1, one), member(2, two)).cast(MEMBERS).alias("members"), F.lit(1).alias("size"), F.lit("f").alias("file"),
        )

    return first.unionByName(second).unionByName(relation(5, F.lit(True), circuits="1")).unionByName(relation(6, k % 4 == 3, circuits="2"))


@query(
    "SELECT 'relation/' || CAST(c_custkey * 10 + 5 AS VARCHAR) AS osm_id, CAST(1 AS INTEGER) AS n_circuits, 'tagged' AS circuits_source, 1 AS contains, false AS ambiguous FROM customer WHERE c_custkey % 4 = 0 "
    "UNION ALL SELECT 'way/' || CAST(c_custkey * 10 + n AS VARCHAR), 1, 'assumed_single_circuit', 1, false FROM customer, (VALUES (1), (2)) v(n) WHERE c_custkey % 4 = 1 "
    "UNION ALL SELECT 'relation/' || CAST(c_custkey * 10 + 5 AS VARCHAR), 1, 'tagged', 1, false FROM customer, (VALUES (1), (2)) v(n) WHERE c_custkey % 4 = 2 "
    "UNION ALL SELECT 'relation/' || CAST(c_custkey * 10 + 5 AS VARCHAR), 2, 'duplicate_relation_group_collapsed', 2, true FROM customer WHERE c_custkey % 4 = 3"
)
def relations_and_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation stands for its ways where it joins; relations of equal ways are one corridor."""
    rows = P.records(_routes(spark, sf_dir), CONFIG)[0]
    return rows.select("osm_id", "n_circuits", "circuits_source", F.size("contains").alias("contains"), F.array_contains("qa", "circuit_count_element_level_ambiguous").alias("ambiguous"))


@query(
    "SELECT 'way/' || CAST(c_custkey AS VARCHAR) AS osm_id, CASE c_custkey % 3 WHEN 0 THEN c_name END AS name, CAST(110 AS INTEGER) AS voltage_kv, c_custkey % 4 = 1 AS used_hull, c_custkey % 5 = 0 AS under_construction FROM customer WHERE c_custkey % 4 <> 3"
)
def substation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints: a closed ring as it is, the hull of an open one, none without area."""
    k = F.col("c_custkey")
    square = _path((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    shape = F.when(k % 4 == 1, _path((0, 0), (1, 0), (1, 1), (0, 1))).when(k % 4 == 3, _path((0, 0), (1, 1))).otherwise(square)
    tags = F.map_filter(_tags(power="substation", voltage="66000;110000", name=F.when(k % 3 == 0, F.col("c_name")), construction=F.when(k % 5 == 0, "yes")), lambda _, v: v.isNotNull())
    rows = E.usable(S.table(spark, sf_dir, "customer").select(*_way(k, tags, shape)))
    return P.substations(rows, CONFIG).select("osm_id", "name", "voltage_kv", "used_hull", "under_construction")


COUNTRY = Config(voltage_floor_kv=50, metric_crs="EPSG:3035", areas=("all",), country_source="polygons", country_polygons="-")


@query(
    "WITH e AS (SELECT c_custkey, CAST(c_custkey % 40 AS DOUBLE) / 2 + 0.1 AS x FROM customer), m AS (SELECT *, x < 10 AND NOT (x > 4 AND x + 0.5 < 6) AS a, x + 0.5 > 10 AS b FROM e) "
    "SELECT c_custkey, CASE WHEN a AND b THEN 'AA;BB' WHEN a THEN 'AA' WHEN b THEN 'BB' ELSE '' END AS countries FROM m"
)
def countries_of_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths and country polygons, one of which has a hole, read from GeoJSON."""
    square = lambda w, e, s, n: f"[[{w},{s}],[{e},{s}],[{e},{n}],[{w},{n}],[{w},{s}]]"
    feature = lambda name, kind, text: f'{{"type":"Feature","properties":{{"ISO":"{name}"}},"geometry":{{"type":"{kind}","coordinates":{text}}}}}'
    text = '{"type":"FeatureCollection","features":[%s,%s]}' % (feature("AA", "Polygon", f"[{square(0, 10, 0, 10)},{square(4, 6, 4, 6)}]"), feature("BB", "MultiPolygon", f"[[{square(10, 21, 0, 10)}]]"))
    path = fresh_path(spark, "countries")
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(path)
    x = (F.col("c_custkey") % 40).cast("double") / 2 + 0.1
    rows = S.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("key"), F.lit("").alias("tag_country"), F.array(x, x + 0.5).alias("lons"), F.array(F.lit(5.0), F.lit(5.0)).alias("lats"))
    return P.with_countries(rows, COUNTRY, tables.read_countries(spark, path, "ISO")).select("c_custkey", "countries")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 1 AND c_custkey % 2 = 0")
def country_and_frequency_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A country code as a whole token, grid frequency only."""
    k = F.col("c_custkey")
    rows = S.table(spark, sf_dir, "customer").select("c_custkey", S.pick(k, ["NOR", "NO;SE", "SE;FINO"]).alias("countries"), F.when(k % 4 == 0, F.lit(None)).when(k % 2 == 0, 50.0).otherwise(16.7).cast("double").alias("frequency_hz"))
    return tables.in_country(rows, "NO", 50.0).select("c_custkey")


def _csv(spark: SparkSession, rows: DataFrame, head: str, first: str = "") -> str:
    """A one-file CSV of the lines in ``value`` below its heading."""
    path = fresh_path(spark, "csv")
    lines = rows.select("value", F.lit(1).alias("n")).unionByName(spark.createDataFrame([(t, 0) for t in (first, head) if t], "value string, n int"))
    lines.coalesce(1).sortWithinPartitions("n", F.when(F.col("value").startswith("#"), 0).otherwise(1)).select("value").write.text(path)
    return path


@query("SELECT 'way/' || CAST(s_suppkey AS VARCHAR) AS osm_id, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey * 10 AS DOUBLE) END AS p_nom_mw, CASE WHEN s_suppkey % 2 = 0 THEN 'operational' ELSE 'planned' END AS status FROM supplier")
def dc_ratings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings by ``fid``; a rating that is no number is none."""
    k = F.col("s_suppkey")
    value = F.concat_ws(",", F.concat(F.lit("way/"), k.cast("string")), F.when(k % 4 == 0, "n/a").otherwise((k * 10).cast("string")), F.when(k % 2 == 0, "operational").otherwise("planned"))
    path = _csv(spark, S.table(spark, sf_dir, "supplier").select(value.alias("value")), "fid,p_nom_mw,status")
    return N.read_ratings(spark, path).select("osm_id", "p_nom_mw", "status")


@query("SELECT CAST(n_nationkey * 10 + 7 AS INTEGER) AS kv, CAST(n_nationkey AS DOUBLE) / 4 AS published_km FROM nation")
def benchmark_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    value = F.concat_ws(",", (k * 10 + 7).cast("string"), (k / 4).cast("string"))
    path = _csv(spark, S.table(spark, sf_dir, "nation").select(value.alias("value")), "voltage_kv,published_km", "# published route lengths")
    return V.read_benchmark(spark, path)


@query("SELECT 'way/' || CAST(s_suppkey AS VARCHAR) AS osm_id, '16.7' AS frequency, CAST(s_suppkey AS VARCHAR) AS voltage, s_name AS operator FROM supplier WHERE s_suppkey % 3 <> 0")
def frequency_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-separated lines; those of fewer than five fields are no data."""
    k = F.col("s_suppkey").cast("string")
    value = F.when(F.col("s_suppkey") % 3 == 0, F.concat_ws("|", F.lit("way"), k, F.lit("50"))).otherwise(F.concat_ws("|", F.lit("way"), k, F.lit(" 16.7"), k, F.col("s_name"), F.lit("more")))
    path = fresh_path(spark, "scrape")
    S.table(spark, sf_dir, "supplier").select(value.alias("value")).write.text(path)
    return tables.read_scrape(spark, path)


@query("SELECT s_suppkey AS key, s_name AS name, CAST(s_suppkey AS DOUBLE) / 4 AS lon, CAST(s_suppkey AS DOUBLE) / 8 AS lat, CAST(21 AS INTEGER) AS wkb_bytes FROM supplier")
def geopackage_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer of points written to a GeoPackage and read back in row ranges."""
    import os

    path = fresh_path(spark, "layers").removeprefix("file:").replace("//", "/") + ".gpkg"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    rows = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("key"), F.col("s_name").alias("name"), (F.col("s_suppkey") / 4).alias("lon"), (F.col("s_suppkey") / 8).alias("lat"))
    gpkg.write_layers(path, {"plant": (rows, "Point")})
    read = gpkg.with_bounds(gpkg.read_layer(spark, path, "plant"))
    return read.select("key", "name", F.col("min_x").alias("lon"), F.col("max_y").alias("lat"), F.octet_length(gpkg.geometry_wkb(F.col("geom"))).alias("wkb_bytes"))


@query(
    "SELECT '{\"type\":\"Feature\",\"properties\":{\"name\":\"' || s_name || '\",\"key\":' || CAST(s_suppkey AS VARCHAR) || '},\"geometry\":{\"type\":\"LineString\",\"coordinates\":[[' || CAST(s_suppkey / CAST(4 AS DOUBLE) AS VARCHAR) || ',1.5],[2.5,' || CAST(s_suppkey / CAST(8 AS DOUBLE) AS VARCHAR) || ']]}}' AS value FROM supplier"
)
def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as GeoJSON features with chosen columns only."""
    k = F.col("s_suppkey")
    rows = S.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), k.alias("key"), "s_acctbal", F.array(k / 4, F.lit(2.5)).alias("lons"), F.array(F.lit(1.5), k / 8).alias("lats"))
    return export.geojson_lines(rows, "LineString", ["name", "key"])


@query(
    "SELECT * FROM (VALUES ('R1', 'lo>=200', '2000', '0.1', '0.0025', true), ('R2', '100<=lo<200 and hi>=330', '500', '0.122', '0.0025', true), ('R3', '100<=lo<200 and 200<=hi<330', '300', '0.12', '0.0026', true), ('R4', '100<=lo<200 and hi<200', '300', '0.1', '0.0025', true), "
    "('R5', 'lo<100 and hi>=200', '200', '0.16', '0.004', true), ('R6', 'lo<100 and hi<200', '120', '0.16', '0.004', true), ('ALT', 's_nom_pypsa_eur_mva (separate column, all rows)', '', '', '', true), ('NOTE', 'x,r are per-unit on the transformer own s_nom (PyPSA Transformer convention)', '', '', '', true)) t(band, selector, s_nom_mva, x_pu, r_pu, based)"
)
def typing_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    based = (F.length("basis") > 0) & F.col("source_url").startswith("https://")
    return export.typing_rule(spark).select("band", "selector", "s_nom_mva", "x_pu", "r_pu", based.alias("based"))


PLAN = from_mapping({"voltage_floor_kv": 50, "high_pass_kv": 110, "metric_crs": "EPSG:3035", "areas": ["NO"], "bboxes": [[50.0, 3.0, 60.0, 11.0]], "chunk_degrees": 5.0})


@query(
    "WITH scope AS (SELECT 'NO' AS name UNION ALL SELECT printf('box00_r%02d_c%02d', r, c) FROM (VALUES (0), (1)) a(r), (VALUES (0), (1)) b(c)) "
    "SELECT name || '_' || pass AS job, pass, low_v, high_v FROM scope, (VALUES ('conductors_high', 110000, NULL), ('conductors_low', 50000, 110000), ('substations', NULL, NULL), ('dc', NULL, NULL)) p(pass, low_v, high_v)"
)
def harvest_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """Scopes times passes with disjoint voltage bands."""
    return harvest.jobs(spark, PLAN).select("job", "pass", "low_v", "high_v")


@query(
    "SELECT n_name AS area, '[out:json][timeout:900];' || chr(10) || 'area[\"ISO3166-1\"=\"' || n_name || '\"]->.scope;' || chr(10) || '(' || chr(10) || '  way[\"power\"=\"substation\"](area.scope);' || chr(10) || '  relation[\"power\"=\"substation\"](area.scope);' || chr(10) || ');' || chr(10) || 'out geom;' AS stations, "
    "'[out:json][timeout:900];' || chr(10) || '(' || chr(10) || '  way[\"power\"~\"^(line|cable)$\"][\"frequency\"=\"0\"](1,2,3.5,' || CAST(n_nationkey + 4 AS VARCHAR) || ');' || chr(10) || '  relation[\"route\"=\"power\"][\"frequency\"=\"0\"](1,2,3.5,' || CAST(n_nationkey + 4 AS VARCHAR) || ');' || chr(10) || ');' || chr(10) || 'out geom;' AS dc FROM nation"
)
def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect()  # 25
    made = [(r.n_name, harvest.substation_query({"area": r.n_name}), harvest.dc_query({"bbox": (1.0, 2.0, 3.5, float(r.n_nationkey + 4))})) for r in rows]
    return spark.createDataFrame(made, "area string, stations string, dc string")


BANDS = [(50_000, 100_000), (110_000, 220_000), (100_000, None), (9_500, 120_001), (200_000, 200_001)]
VOLT_SQL = "volt AS (SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS v, CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE '20000; ' || CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) END AS tag FROM orders)"


@query(
    f"WITH {VOLT_SQL}, band AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {lo}, {hi or 10_000_000})" for i, (lo, hi) in enumerate(BANDS)) + ") b(band, lo, hi)) "
    "SELECT o_orderkey, CAST(band AS INTEGER) AS band, (v >= lo AND v < hi) OR (o_orderkey % 2 <> 0 AND 20000 >= lo AND 20000 < hi) AS by_pattern, (v >= lo AND v < hi) OR (o_orderkey % 2 <> 0 AND 20000 >= lo AND 20000 < hi) AS by_value FROM volt, band"
)
def voltage_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags in a band by the pattern that is sent to servers, and by value."""
    v = F.rint("o_totalprice").cast("long").cast("string")  # halves to the even number, as SQL's cast
    rows = S.table(spark, sf_dir, "orders").withColumn("tag", F.when(F.col("o_orderkey") % 2 == 0, v).otherwise(F.concat(F.lit("20000; "), v)))
    each = F.array(*[F.struct(F.lit(i).alias("band"), F.col("tag").rlike(harvest.voltage_pattern(lo, hi)).alias("by_pattern"), harvest.voltage_in(F.col("tag"), lo, hi).alias("by_value")) for i, (lo, hi) in enumerate(BANDS)])
    return rows.select("o_orderkey", F.explode(each).alias("b")).select("o_orderkey", "b.*")


@query("SELECT c_name AS job FROM customer WHERE c_custkey % 3 <> 0")
def jobs_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs without a good entry in the manifest; a failed one is to be done again."""
    k, path = F.col("c_custkey"), fresh_path(spark, "manifest")
    rows = S.table(spark, sf_dir, "customer").select(F.col("c_name").alias("job"), "c_custkey")
    status = F.when(k % 3 == 0, "ok").otherwise("failed")
    tables.append_manifest(rows.where(k % 3 != 1).select("job", status.alias("status"), F.lit(1).alias("elements"), F.lit(10).alias("bytes")), path)
    return harvest.pending(rows.select("job"), tables.read_manifest(spark, path))


@query(EXPLODED + f", every AS (SELECT p_partkey, max({S.NUMBER_SQL.format('part')}) / 1000 AS kv FROM one GROUP BY 1) SELECT t.p_partkey, CAST(round_even(kv, 0) AS INTEGER) AS kv FROM tag t LEFT JOIN every e ON t.p_partkey = e.p_partkey")
def largest_tagged_voltage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tagged(spark, sf_dir).select("p_partkey", T.largest_voltage_kv(F.col("tags")).alias("kv"))
