"""Queries over the driver tables, one per operator, with the SQL that an independent engine checks them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.config import Config, Traction
from gridweave.functions import measure as M
from gridweave.functions import tags as T
from gridweave.operators.graph import connected_components
from gridweave.operators.linkage import capped_linkage, greedy_match_within
from gridweave.operators.spatial import distance, nearest_within, overlapping_boxes, pairs_within
from gridweave.plans import network as N
from gridweave.plans import synthetic as S
from gridweave.plans.storage import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

CONFIG = Config(voltage_floor_kv=50, metric_crs="EPSG:3035", areas=("all",), traction=Traction(enabled=True, operators=("rail",)))


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


NUMBER = S.NUMBER_SQL.format("part")
EXPLODED = (
    f"WITH {S.TAG_SQL}, parts AS (SELECT p_partkey, {S.PARTS_SQL.format('voltage')} AS ps FROM tag WHERE voltage IS NOT NULL), "
    "one AS (SELECT p_partkey, unnest(ps) AS part, unnest(range(len(ps))) AS idx FROM parts), "
    f"num AS (SELECT p_partkey, idx, part, ({NUMBER}) / 1000 AS kv FROM one), "
    "kept AS (SELECT *, row_number() OVER (PARTITION BY p_partkey, kv ORDER BY idx) AS rn FROM num WHERE kv >= 50 - 1e-9), "
    "volt AS (SELECT p_partkey, idx, kv, count(*) OVER (PARTITION BY p_partkey) AS n FROM kept WHERE rn = 1) "
)


def _volts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.tagged(spark, sf_dir).withColumn("kvs", T.voltages(F.col("tags"), 50.0)).withColumn("n", F.size("kvs"))
    return rows.select("p_partkey", "tags", "n", F.explode("kvs").alias("v")).select("p_partkey", "tags", "n", F.col("v.kv").alias("kv"), F.col("v.index").alias("idx"))


@query(
    f"WITH {S.TAG_SQL}, parts AS (SELECT p_partkey, {S.PARTS_SQL.format('voltage')} AS ps FROM tag WHERE voltage IS NOT NULL) "
    "SELECT p_partkey, CAST(unnest(range(len(ps))) AS INTEGER) AS idx, unnest(ps) AS part FROM parts"
)
def tag_split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.tagged(spark, sf_dir)
    return rows.select("p_partkey", F.posexplode(T.semicolon_parts(F.col("tags")["voltage"])).alias("idx", "part"))


@query(f"WITH {S.TAG_SQL}, one AS (SELECT p_partkey, voltage AS part FROM tag) SELECT p_partkey, {NUMBER} AS volts FROM one")
def parse_float_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tagged(spark, sf_dir).select("p_partkey", T.parse_number(F.col("tags")["voltage"]).alias("volts"))


@query(EXPLODED + "SELECT p_partkey, CAST(idx AS INTEGER) AS idx, kv, CAST(n AS INTEGER) AS n FROM volt")
def voltage_floor_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _volts(spark, sf_dir).select("p_partkey", "idx", "kv", "n")


def _positional_sql(name: str) -> str:
    ps = S.PARTS_SQL.format(f"t.{name}")
    return f"CASE WHEN t.{name} IS NULL THEN NULL WHEN len({ps}) = v.n AND v.n > 1 THEN list_extract({ps}, v.idx + 1) WHEN len({ps}) = 1 THEN list_extract({ps}, 1) ELSE t.{name} END"


POSITIONAL = EXPLODED + f", pos AS (SELECT v.p_partkey, v.idx, v.kv, {_positional_sql('circuits')} AS c, {_positional_sql('cables')} AS w, {_positional_sql('frequency')} AS f FROM volt v JOIN tag t ON t.p_partkey = v.p_partkey) "


@query(POSITIONAL + "SELECT p_partkey, CAST(idx AS INTEGER) AS idx, c AS circuits, w AS cables, f AS frequency FROM pos")
def positional_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _volts(spark, sf_dir)
    return rows.select("p_partkey", "idx", *[T.positional(F.col("tags"), k, F.col("n"), F.col("idx")).alias(k) for k in ("circuits", "cables", "frequency")])


@query(
    POSITIONAL
    + f", nums AS (SELECT p_partkey, idx, {S.NUMBER_SQL.format('c')} AS c, {S.NUMBER_SQL.format('w')} AS w FROM pos) "
    "SELECT p_partkey, CAST(idx AS INTEGER) AS idx, CAST(CASE WHEN c >= 1 THEN floor(c) WHEN w >= 3 THEN floor(w / 3) ELSE 1 END AS INTEGER) AS n_circuits, "
    "CASE WHEN c >= 1 THEN 'tagged' WHEN w >= 3 THEN 'derived_from_cables_tag' ELSE 'assumed_single_circuit' END AS circuits_source FROM nums"
)
def circuits_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _volts(spark, sf_dir).withColumn("c", T.circuits(F.col("tags"), F.col("n"), F.col("idx")))
    return rows.select("p_partkey", "idx", F.col("c.n").alias("n_circuits"), F.col("c.source").alias("circuits_source"))


@query(
    f"WITH {S.TAG_SQL} SELECT p_partkey, CASE WHEN location = 'underground' THEN 'underground_cable' WHEN location = 'submarine' THEN 'submarine_cable' WHEN location = 'overhead' THEN 'overhead_line' "
    "WHEN power = 'cable' THEN 'underground_cable' WHEN power IN ('line', 'minor_line') THEN 'overhead_line' ELSE 'unknown' END AS construction_type, "
    "CASE WHEN location IN ('underground', 'submarine', 'overhead') THEN 'osm_location_tag' WHEN power = 'cable' THEN 'osm_power_cable' WHEN power IN ('line', 'minor_line') THEN 'osm_power_line' ELSE 'not_tagged' END AS construction_source, "
    "COALESCE(power, '') = 'construction' AS under_construction FROM tag"
)
def construction_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.tagged(spark, sf_dir).withColumn("m", T.construction(F.col("tags")))
    return rows.select("p_partkey", F.col("m.kind").alias("construction_type"), F.col("m.source").alias("construction_source"), T.under_construction(F.col("tags")).alias("under_construction"))


@query(
    POSITIONAL
    + "SELECT p_partkey, CAST(idx AS INTEGER) AS idx, CASE WHEN f IN ('16.7', '16.67') AND kv <= 132 THEN CAST(16.7 AS DOUBLE) WHEN f = '0' THEN CAST(0 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END AS frequency_hz, "
    "CASE WHEN f IS NULL THEN 'no_frequency_tag' WHEN f = '50;16.7' THEN 'osm_mixed_50;16.7_kept_50' WHEN f IN ('16.7', '16.67') AND kv > 132 THEN 'osm_frequency_tag_traction_overridden_ehv_gate' "
    "WHEN f IN ('16.7', '16.67') THEN 'osm_frequency_tag' WHEN f = '50' THEN 'osm_frequency_tag_50' WHEN f = '0' THEN 'osm_frequency_tag_0_dc' ELSE 'nonstandard_frequency_tag_kept_grid' END AS frequency_source, "
    "CASE WHEN f IS NULL THEN 'frequency_assumed_ac' WHEN f = '50;16.7' THEN 'shared_tower_mixed_frequency_kept_grid' WHEN f IN ('16.7', '16.67') AND kv > 132 THEN 'frequency_tag_conflict_ehv' "
    "WHEN f IN ('16.7', '16.67', '50', '0') THEN '' ELSE 'nonstandard_frequency_tag_kept_50' END AS flags FROM pos"
)
def frequency_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _volts(spark, sf_dir).withColumn("f", T.frequency(F.col("tags"), F.col("kv"), F.col("n"), F.col("idx"), CONFIG))
    return rows.select("p_partkey", "idx", F.col("f.hz").alias("frequency_hz"), F.col("f.source").alias("frequency_source"), F.array_join("f.flags", ";").alias("flags"))


ANCHORS = ", ".join(f"(CAST({a} AS DOUBLE), CAST({r} AS DOUBLE), CAST({x} AS DOUBLE), CAST({i} AS DOUBLE), '{n}')" for a, r, x, i, n in T.LINE_TYPES)
TYPE_SQL = (
    f"anchor(a, r, x, i, name) AS (VALUES {ANCHORS}), kvs AS (SELECT DISTINCT kv FROM {{0}}), "
    "typed AS (SELECT kv, a, r, x, i, name, row_number() OVER (PARTITION BY kv ORDER BY abs(a - kv), a) AS rn FROM kvs, anchor) "
)
PRICED = "price AS (SELECT p_partkey, CAST(p_size AS DOUBLE) * 9 + 40 AS kv FROM part)"


@query(
    f"WITH {PRICED}, {TYPE_SQL.format('price')} SELECT p_partkey, a AS anchor_kv, name AS line_type, abs(a - p.kv) > 5 AS proxy FROM price p JOIN typed t ON p.kv = t.kv AND rn = 1"
)
def line_type_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "part").withColumn("t", T.line_type(F.col("p_size").cast("double") * 9 + 40))
    return rows.select("p_partkey", F.col("t.anchor").alias("anchor_kv"), F.col("t.name").alias("line_type"), F.col("t.proxy").alias("proxy"))


@query(
    f"WITH {S.LINE_SQL}, {TYPE_SQL.format('line')} SELECT line_id, r * (metres / 1000) / n_circuits AS r_ohm, x * (metres / 1000) / n_circuits AS x_ohm, i AS i_nom_ka, "
    "sqrt(CAST(3 AS DOUBLE)) * l.kv * i * n_circuits AS s_nom_mva FROM line l JOIN typed t ON l.kv = t.kv AND rn = 1"
)
def electrical_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.lines(spark, sf_dir).withColumn("t", T.line_type(F.col("kv")))
    rows = rows.withColumn("e", T.electrical(F.col("kv"), F.col("n_circuits"), F.col("metres"), F.col("t")))
    return rows.select("line_id", "e.r_ohm", "e.x_ohm", "e.i_nom_ka", "e.s_nom_mva")


BAND_SQL = "CASE WHEN lo >= 200 THEN 'R1' WHEN lo >= 100 AND hi >= 330 THEN 'R2' WHEN lo >= 100 AND hi >= 200 THEN 'R3' WHEN lo >= 100 THEN 'R4' WHEN hi >= 200 THEN 'R5' ELSE 'R6' END"


@query(
    f"WITH pair AS (SELECT l_orderkey, l_linenumber, {S.pick_sql('l_partkey', S.KVS)} AS a, {S.pick_sql('l_suppkey', S.KVS)} AS b FROM lineitem), sorted AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM pair) "
    f"SELECT {BAND_SQL} AS band, count(*) AS n, max(hi / lo) AS ratio FROM sorted WHERE lo < hi GROUP BY 1"
)
def transformer_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = S.pick(F.col("l_partkey"), S.KVS), S.pick(F.col("l_suppkey"), S.KVS)
    rows = S.table(spark, sf_dir, "lineitem").select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi")
    rows = rows.withColumn("band", T.transformer_band(F.col("lo"), F.col("hi"))["band"])
    return rows.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("hi") / F.col("lo")).alias("ratio"))


@query(
    "SELECT p_partkey, lower(trim(p_name)) <> '' AND lower(trim(p_brand)) <> '' AND NOT contains(lower(trim(p_name)), lower(trim(p_brand))) AND NOT contains(lower(trim(p_brand)), lower(trim(p_name))) AS conflict FROM part"
)
def name_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "part").select("p_partkey", T.names_conflict(F.col("p_name"), F.col("p_brand")).alias("conflict"))


@query("SELECT l_orderkey, l_linenumber, abs(l_quantity * 8 - l_discount * 4000) <= greatest(CAST(10 AS DOUBLE), greatest(l_quantity * 8, l_discount * 4000) * 0.08) AS same FROM lineitem")
def volt_class_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("l_quantity") * 8, F.col("l_discount") * 4000
    return S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.classes_match(a, b).alias("same"))


HAVERSINE_SQL = "2 * 6371008.8 * asin(sqrt(least(1, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"


@query(f"WITH {S.BUS_SQL}, {S.LINE_SQL} SELECT line_id, round({HAVERSINE_SQL}, 3) AS metres FROM line l JOIN bus a ON a.bus_id = l.bus0 JOIN bus b ON b.bus_id = l.bus1")
def haversine_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    buses = S.buses(spark, sf_dir)
    a, b = (buses.select(F.col("bus_id").alias(f"bus{e}"), F.col("lon").alias(f"lon{e}"), F.col("lat").alias(f"lat{e}")) for e in (0, 1))
    rows = S.lines(spark, sf_dir).join(a, "bus0").join(b, "bus1")
    path = M.haversine_length(F.array("lon0", "lon1"), F.array("lat0", "lat1"))
    return rows.select("line_id", F.round(path, 3).alias("metres"))


@query(f"WITH {S.LINE_SQL} SELECT CAST(trunc(kv) AS INTEGER) AS kv, count(*) AS n_spans, round(sum(metres) / 1000, 3) AS route_km, round(sum(metres * n_circuits) / 1000, 3) AS circuit_km FROM line GROUP BY 1")
def route_km_by_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import voltage_table

    rows = S.lines(spark, sf_dir).select(F.col("kv").alias("voltage_kv"), F.col("metres").alias("length_conductor_m"), "n_circuits", F.lit(50.0).alias("frequency_hz"))
    return voltage_table(rows, CONFIG.traction.frequency_hz).select("kv", "n_spans", F.round("km", 3).alias("route_km"), F.round("circuit_km", 3).alias("circuit_km"))


PUBLISHED = [(v, 1000.0 * (i + 1)) for i, v in enumerate((66, 110, 220, 236, 400, 750))]
PUBLISHED_SQL = "published(kv, published_km) AS (VALUES " + ", ".join(f"({v}, CAST({k} AS DOUBLE))" for v, k in PUBLISHED) + ")"


@query(
    f"WITH {S.LINE_SQL}, {PUBLISHED_SQL}, ours AS (SELECT CAST(trunc(kv) AS INTEGER) AS kv, round(sum(metres) / 1000, 3) AS our_km FROM line GROUP BY 1) "
    "SELECT p.kv, published_km, coalesce(our_km, CAST(0 AS DOUBLE)) AS our_km, round((coalesce(our_km, CAST(0 AS DOUBLE)) / published_km - 1) * 100, 2) AS delta_pct FROM published p LEFT JOIN ours o ON p.kv = o.kv"
)
def benchmark_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import benchmark_table

    published = spark.createDataFrame(PUBLISHED, "kv int, published_km double")
    return benchmark_table(S.lines(spark, sf_dir).select(F.col("kv").alias("voltage_kv"), F.col("metres").alias("length_conductor_m")), published)


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the smallest event of their island as ``component``."""
    chain = S.event_chain(spark, sf_dir)
    labels = connected_components(chain.select("event_id", "before"), "event_id", "before")
    return chain.join(labels, chain["event_id"] == labels["node"], "left").withColumn("component", F.coalesce("component", "event_id")).drop("node")


@query(f"WITH {S.ISLAND_SQL} SELECT event_id, component FROM island")
def connected_component_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(spark, sf_dir).select("event_id", "component")


@query(f"WITH {S.ISLAND_SQL} SELECT event_id, component AS cluster FROM island")
def single_linkage_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncapped linkage of the events of each user on the line of time, in whole microseconds, which doubles hold exactly."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2000-01-01 00:00:00', ts)").cast("double")
    reach = S.GAP_HOURS * 3600e6
    # Users lie apart on the other axis, so their number takes no digits from the time.
    points = S.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), micros.alias("x"), (F.col("user_id") * 4 * reach).alias("y"))
    return capped_linkage(points, reach, float("inf")).select(F.col("id").alias("event_id"), "cluster")


@query(f"WITH {S.ISLAND_SQL}, sums AS (SELECT component, sum(value) AS v FROM island GROUP BY 1) SELECT count(*) AS n_components, round(100 * max(v) / sum(v), 6) AS largest_pct FROM sums")
def largest_component_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _component_stats(spark, sf_dir)
    return sums.agg(F.count(F.lit(1)).alias("n_components"), F.round(F.max("share_pct"), 6).alias("largest_pct"))


def _component_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import component_stats

    return component_stats(_components(spark, sf_dir).select("component", F.col("value").alias("length_conductor_m"), F.lit(110.0).alias("voltage_kv")))


@query(f"WITH {S.ISLAND_SQL} SELECT component, count(*) AS n, round(sum(value), 3) AS total FROM island GROUP BY 1 ORDER BY sum(value) DESC, component LIMIT 5")
def top5_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _component_stats(spark, sf_dir).orderBy(F.desc("km"), "component").limit(5)
    return sums.select("component", F.col("n_spans").alias("n"), F.round(F.col("km") * 1000, 3).alias("total"))


@query(
    f"WITH {S.ISLAND_SQL}, w AS (SELECT component, round(sum(value), 6) AS v FROM island WHERE before IS NOT NULL GROUP BY 1), r AS (SELECT c.component, row_number() OVER (ORDER BY coalesce(v, 0) DESC, CAST(c.component AS VARCHAR)) - 1 AS rk FROM (SELECT component, min(CAST(event_id AS VARCHAR)) AS least FROM island GROUP BY 1) c LEFT JOIN w ON c.component = w.component) "
    "SELECT event_id, CAST(rk AS INTEGER) AS component FROM island JOIN (SELECT c.component, row_number() OVER (ORDER BY coalesce(v, 0) DESC, least) - 1 AS rk FROM (SELECT component, min(CAST(event_id AS VARCHAR)) AS least FROM island GROUP BY 1) c LEFT JOIN w ON c.component = w.component) x ON island.component = x.component"
)
def component_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.event_chain(spark, sf_dir).select(F.col("event_id").cast("string").alias("bus_id"), F.col("before").cast("string").alias("other"), "event_id", "value")
    edges = rows.where("other is not null").select(F.col("bus_id").alias("bus0"), F.col("other").alias("bus1"), F.col("value").cast("decimal(18,6)").alias("metres"))
    ranked = N.ranked_components(rows, edges, edges.withColumn("metres", F.col("metres").cast("decimal(18,6)")))
    return rows.join(ranked, "bus_id").select("event_id", "component")


@query("SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1 HAVING count(*) > 4")
def fragments_over_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import fragments

    rows = S.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("osm_id"), F.col("l_quantity").alias("length_conductor_m"))
    return fragments(rows, 4).select(F.col("osm_id").alias("l_orderkey"), "n", F.col("metres").alias("quantity"))


@query(
    "WITH r AS (SELECT l_returnflag AS flag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) "
    "SELECT flag, max(n) AS n, max(CASE WHEN i = n // 2 THEN v END) AS median, max(CASE WHEN i = CAST(floor(n * 0.95) AS BIGINT) THEN v END) AS p95, max(CASE WHEN i = CAST(floor(n * 0.99) AS BIGINT) THEN v END) AS p99, max(v) AS most FROM r GROUP BY 1"
)
def nearest_rank_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import nearest_ranks

    rows = S.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("v"))
    return nearest_ranks(rows, "v", ["flag"])


@query(
    f"WITH {S.BUS_SQL}, {S.LINE_SQL}, m AS (SELECT metres, {HAVERSINE_SQL} AS drawn FROM line l JOIN bus a ON a.bus_id = l.bus0 JOIN bus b ON b.bus_id = l.bus1) "
    "SELECT count(*) AS n, count(*) FILTER (WHERE abs(metres - drawn) / drawn > 0.001) AS over_limit, round(max(abs(metres - drawn) / drawn), 6) AS worst FROM m WHERE drawn > 0"
)
def length_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import length_report

    buses = S.buses(spark, sf_dir)
    a, b = (buses.select(F.col("bus_id").alias(f"bus{e}"), F.col("lon").alias(f"lon{e}"), F.col("lat").alias(f"lat{e}")) for e in (0, 1))
    rows = S.lines(spark, sf_dir).join(a, "bus0").join(b, "bus1").select(F.col("metres").alias("length_conductor_m"), F.array("lon0", "lon1").alias("lons"), F.array("lat0", "lat1").alias("lats"), F.lit(0.0).alias("connector0_m"), F.lit(0.0).alias("connector1_m"))
    return length_report(rows)


PROMOTED_SQL = "promoted AS (SELECT CAST(round(kv) AS INTEGER) AS v, count(*) AS n FROM line GROUP BY 1 HAVING count(*) >= 50)"


@query(f"WITH {S.LINE_SQL}, {PROMOTED_SQL} SELECT v AS kv, n FROM promoted")
def layer_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.lines(spark, sf_dir).select(F.col("kv").alias("voltage_kv"), F.lit(50.0).alias("frequency_hz"))
    kept = N.promoted_voltages(rows, CONFIG)
    return rows.where(F.col("voltage_kv").isin([float(v) for v in kept])).groupBy(F.col("voltage_kv").cast("int").alias("kv")).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"WITH {S.LINE_SQL} SELECT CASE WHEN n_circuits = 3 THEN 'line_16_7Hz' WHEN kv IN (110, 220, 400) THEN 'line_' || CAST(CAST(kv AS INTEGER) AS VARCHAR) || 'kV' ELSE 'line_other_kV' END AS layer, count(*) AS n FROM line GROUP BY 1"
)
def layer_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    hz = F.when(F.col("n_circuits") == 3, 16.7).otherwise(50.0)
    return S.lines(spark, sf_dir).groupBy(T.layer_name(F.col("kv"), hz, [110, 220, 400], CONFIG).alias("layer")).agg(F.count(F.lit(1)).alias("n"))


#: Points of the spatial queries: customers on a plane, in metres.
PLANE_SQL = "spot AS (SELECT c_custkey AS id, CAST(c_custkey * 7919 % 100003 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 99991 AS DOUBLE) AS y, c_nationkey AS g, c_acctbal AS v FROM customer)"


def _spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return S.table(spark, sf_dir, "customer").select(key.alias("id"), (key * 7919 % 100003).cast("double").alias("x"), (key * 104729 % 99991).cast("double").alias("y"), F.col("c_nationkey").alias("g"), F.col("c_acctbal").alias("v"))


METRES_SQL = "sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))"


@query(f"WITH {PLANE_SQL} SELECT p.id AS a, q.id AS b, round({METRES_SQL}, 3) AS d FROM spot p JOIN spot q ON p.id < q.id AND {METRES_SQL} <= 4000")
def within_radius_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_within(_spots(spark, sf_dir), "id", 4000.0).select("a", "b", F.round("d", 3).alias("d"))


@query(f"WITH {PLANE_SQL} SELECT p.id AS a, q.id AS b, round({METRES_SQL}, 3) AS d FROM spot p JOIN spot q ON p.id < q.id AND p.g = q.g AND {METRES_SQL} <= 5000")
def within_radius_pairs_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs_within(_spots(spark, sf_dir), "id", 5000.0, ("g",)).select("a", "b", F.round("d", 3).alias("d"))


SUPPLIER_SQL = "plant AS (SELECT s_suppkey AS bus, CAST(s_suppkey * 5501 % 100003 AS DOUBLE) AS x, CAST(s_suppkey * 7307 % 99991 AS DOUBLE) AS y FROM supplier)"


@query(
    f"WITH {PLANE_SQL}, {SUPPLIER_SQL}, near AS (SELECT p.id, q.bus, {METRES_SQL} AS d, row_number() OVER (PARTITION BY p.id ORDER BY {METRES_SQL}, q.bus) AS rn FROM spot p JOIN plant q ON {METRES_SQL} <= 10000) "
    "SELECT id, bus, round(d, 3) AS d, d > 2000 AS far FROM near WHERE rn = 1"
)
def nearest_bus_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    plants = S.table(spark, sf_dir, "supplier").select(key.alias("bus"), (key * 5501 % 100003).cast("double").alias("x"), (key * 7307 % 99991).cast("double").alias("y"))
    near = nearest_within(_spots(spark, sf_dir), "id", plants, "bus", CONFIG.gates.dc_max_converter)
    return near.select("id", "bus", F.round("d", 3).alias("d"), (F.col("d") > CONFIG.gates.dc_far).alias("far"))


@query(
    f"WITH {PLANE_SQL}, box AS (SELECT id, x AS x0, y AS y0, x + 2000 + abs(v) / 2 AS x1, y + 2500 + abs(v) / 3 AS y1 FROM spot) "
    "SELECT p.id AS a, q.id AS b FROM box p JOIN box q ON p.id < q.id AND p.x0 <= q.x1 AND q.x0 <= p.x1 AND p.y0 <= q.y1 AND q.y0 <= p.y1"
)
def polygon_bbox_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.abs("v")
    boxes = _spots(spark, sf_dir).select("id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + 2000 + size / 2).alias("x1"), (F.col("y") + 2500 + size / 3).alias("y1"))
    return overlapping_boxes(boxes, "id", 2000.0)


@query(f"WITH {PLANE_SQL} SELECT p.id AS a, q.id AS b, round({METRES_SQL}, 3) AS d FROM spot p JOIN spot q ON p.id < q.id AND p.g <> q.g AND {METRES_SQL} <= 4000")
def bus_pairs_cross_component(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import close_bus_pairs

    rows = _spots(spark, sf_dir).select(F.col("id").alias("bus_id"), "x", "y", F.lit(110.0).alias("voltage_kv"), F.lit(50.0).alias("frequency_hz"), F.col("g").alias("component"))
    return close_bus_pairs(rows, 4000.0).select("a", "b", F.round("d", 3).alias("d"))


@query(
    f"WITH {S.LINE_SQL}, g AS (SELECT elem, bus0, bus1, count(*) AS n, max(n_circuits) AS hi, min(n_circuits) AS lo, count(DISTINCT metres) AS shapes FROM line GROUP BY 1, 2, 3 HAVING count(*) > 1) "
    "SELECT elem, bus0, bus1, n, CASE WHEN shapes = 1 AND hi = lo THEN 'collapse' ELSE 'flag' END AS action FROM g"
)
def dup_group_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.patch import duplicate_groups

    rows = S.lines(spark, sf_dir).withColumnsRenamed({"elem": "osm_id"}).withColumn("shape", F.col("metres"))
    return duplicate_groups(rows).select(F.col("osm_id").alias("elem"), "bus0", "bus1", "n", "action")


@query(f"WITH {S.BUS_SQL}, {S.LINE_SQL}, known AS (SELECT bus_id FROM bus WHERE kv < 300) SELECT line_id, e AS bus_id FROM (SELECT line_id, bus0 AS e FROM line UNION ALL SELECT line_id, bus1 FROM line) WHERE e NOT IN (SELECT bus_id FROM known)")
def unresolved_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import unresolved_ends

    return unresolved_ends(S.lines(spark, sf_dir), S.buses(spark, sf_dir).where("kv < 300")).select("line_id", "bus_id")


@query(f"WITH {S.BUS_SQL}, {S.LINE_SQL} SELECT line_id, bus0, bus1 FROM line WHERE bus0 IN (SELECT bus_id FROM bus WHERE kv >= 220) AND bus1 IN (SELECT bus_id FROM bus WHERE kv >= 220)")
def backbone(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.powerflow import within_buses

    return within_buses(S.lines(spark, sf_dir), S.buses(spark, sf_dir).where("kv >= 220")).select("line_id", "bus0", "bus1")


@query(
    "WITH a AS (SELECT o_orderkey AS k, o_orderpriority AS v FROM orders), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderpriority END AS v FROM orders WHERE o_totalprice > 1000) "
    "SELECT 'only_left' AS side, k, v FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'only_right', k, v FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"
)
def both_ways_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.patch import differences

    orders = S.table(spark, sf_dir, "orders")
    a = orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("v"))
    b = orders.where("o_totalprice > 1000").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderstatus") == "F", "closed").otherwise(F.col("o_orderpriority")).alias("v"))
    return differences(a, b)


@query("SELECT 'customer' AS layer, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part")
def union_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.patch import united

    def layer(name: str, key: str, title: str) -> DataFrame:
        return S.table(spark, sf_dir, name).select(F.col(key).alias("key"), F.col(title).alias("name"))

    return united({"customer": layer("customer", "c_custkey", "c_name"), "supplier": layer("supplier", "s_suppkey", "s_name"), "part": layer("part", "p_partkey", "p_name")})


STATION_SQL = f"st AS (SELECT DISTINCT c_nationkey AS node, {S.pick_sql('c_custkey', S.KVS)} AS kv FROM customer)"


@query(
    f"WITH {STATION_SQL}, adj AS (SELECT node, kv AS lo, lead(kv) OVER (PARTITION BY node ORDER BY kv) AS hi FROM st) SELECT CAST(node AS VARCHAR) AS node_id, lo, hi, {BAND_SQL} AS band FROM adj WHERE hi IS NOT NULL"
)
def adjacent_voltage_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("node_id"), S.pick(F.col("c_custkey"), S.KVS).alias("voltage_kv")).distinct()
    buses = rows.select("node_id", "voltage_kv", F.lit(50.0).alias("frequency_hz"), F.lit("substation").alias("node_type"), F.concat_ws("_", "node_id", "voltage_kv").alias("bus_id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    pairs = N.adjacent_voltages(buses)
    return pairs.select("node_id", F.col("voltage_kv").alias("lo"), F.col("voltage_kv1").alias("hi"), T.transformer_band(F.col("voltage_kv"), F.col("voltage_kv1"))["band"].alias("band"))


@query(
    "WITH o AS (SELECT l_orderkey AS e, l_linenumber AS p, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber) - 1 AS i FROM lineitem) "
    "SELECT e AS elem, p AS pos, CASE WHEN n > 1 THEN CAST(e AS VARCHAR) || ':' || CAST(i AS VARCHAR) ELSE CAST(e AS VARCHAR) END AS line_id FROM o"
)
def line_id_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("osm_id"), F.col("l_extendedprice").alias("order"), F.col("l_linenumber").alias("key"), F.col("l_orderkey").alias("elem"))
    return N.with_line_ids(rows).select("elem", F.col("key").alias("pos"), "line_id")


@query(
    f"WITH {S.BUS_SQL}, {S.LINE_SQL}, side AS (SELECT bus0 AS b, bus1 AS o, line_id FROM line UNION ALL SELECT bus1, bus0, line_id FROM line), sums AS (SELECT b, count(DISTINCT o) AS degree, count(*) AS n_lines, md5(string_agg(DISTINCT line_id, ';' ORDER BY line_id)) AS ids FROM side GROUP BY 1) "
    "SELECT bus_id, CAST(coalesce(degree, 0) AS INTEGER) AS degree, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, ids AS line_ids_md5 FROM bus LEFT JOIN sums ON b = bus_id"
)
def bus_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    buses = S.buses(spark, sf_dir).select("bus_id", F.col("bus_id").alias("node_id"), F.col("kv").alias("voltage_kv"))
    lines = S.lines(spark, sf_dir)
    out = N.with_degrees(buses, lines, lines.select("bus0", "bus1").limit(0))
    return out.select("bus_id", "degree", "n_lines", F.md5("connected_line_ids").alias("line_ids_md5"))


@query(
    f"WITH {S.LINE_SQL}, {TYPE_SQL.format('line')}, rated AS (SELECT bus0, bus1, sqrt(CAST(3 AS DOUBLE)) * l.kv * i * n_circuits AS s FROM line l JOIN typed t ON l.kv = t.kv AND rn = 1) "
    "SELECT b AS bus_id, round(sum(s), 3) AS mva, CAST(ceil(round(sum(s), 3)) AS BIGINT) AS ceil_mva FROM (SELECT bus0 AS b, s FROM rated UNION ALL SELECT bus1, s FROM rated) GROUP BY 1"
)
def incident_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.lines(spark, sf_dir).withColumn("t", T.line_type(F.col("kv"))).withColumn("s_nom_mva", T.electrical(F.col("kv"), F.col("n_circuits"), F.col("metres"), F.col("t"))["s_nom_mva"])
    out = N.incident_capacity(rows.withColumn("frequency_hz", F.lit(50.0)), CONFIG)
    return out.select("bus_id", F.round("mva", 3).alias("mva"), F.ceil(F.round("mva", 3)).alias("ceil_mva"))


TRACE_SQL = (
    f"WITH {S.ISLAND_SQL}, named AS (SELECT *, CASE WHEN event_type IN ('purchase', 'click') THEN event_type END AS st FROM island), "
    "seen AS (SELECT *, first_value(st IGNORE NULLS) OVER (PARTITION BY component ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead, "
    "last_value(st IGNORE NULLS) OVER (PARTITION BY component ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS behind FROM named) "
    "SELECT CAST(s.event_id AS VARCHAR) AS line_id, 0 AS \"end\", coalesce(p.behind, 'unknown') AS label FROM seen s JOIN seen p ON s.before = p.event_id UNION ALL "
    "SELECT CAST(event_id AS VARCHAR), 1, coalesce(ahead, 'unknown') FROM seen WHERE before IS NOT NULL"
)


@query(TRACE_SQL)
def pass_through_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = S.event_chain(spark, sf_dir)
    station = F.col("event_type").isin("purchase", "click")
    buses = chain.select(F.col("event_id").cast("string").alias("bus_id"), F.when(station, "substation").otherwise("junction").alias("node_type"), F.when(station, F.col("event_type")).alias("station_name"))
    spans = chain.where("before is not null").select(F.col("event_id").cast("string").alias("line_id"), F.col("before").cast("string").alias("bus0"), F.col("event_id").cast("string").alias("bus1"))
    return N.traced_labels(spans, buses)


@query(
    "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'blocked-licence' WHEN p_size % 5 = 0 THEN 'metadata-only' WHEN a >= 0.97 AND o >= 0.97 THEN 'keep-osm' WHEN a >= 0.90 AND o < 0.95 THEN 'fuse' ELSE 'partial' END AS verdict "
    "FROM (SELECT *, CAST(p_partkey % 100 AS DOUBLE) / 100 AS a, CAST((p_partkey * 7) % 100 AS DOUBLE) / 100 AS o FROM part)"
)
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    licence = F.when(F.col("p_size") % 7 == 0, "no").otherwise("yes")
    return S.table(spark, sf_dir, "part").select("p_partkey", T.verdict(licence, F.col("p_size") % 5 != 0, (key % 100).cast("double") / 100, (key * 7 % 100).cast("double") / 100).alias("verdict"))


@query(
    "WITH b AS (SELECT c_custkey AS id, CAST(c_custkey % 4 = 0 AS BOOLEAN) AS mixed FROM customer) SELECT CAST(id AS VARCHAR) AS bus_id, CAST(NULL AS VARCHAR) AS severed_from FROM b UNION ALL SELECT CAST(id AS VARCHAR) || '_16_7Hz', CAST(id AS VARCHAR) FROM b WHERE mixed"
)
def sever_bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.patch import sever_buses

    key = F.col("c_custkey")
    customers = S.table(spark, sf_dir, "customer")
    buses = customers.select(key.cast("string").alias("bus_id"), F.lit(50.0).alias("frequency_hz"), F.lit(None).cast("string").alias("severed_from"))
    hz = F.when(key % 4 == 0, 16.7).otherwise(50.0)
    spans = customers.select(F.concat(F.lit("a"), key).alias("line_id"), key.cast("string").alias("bus0"), F.lit(None).cast("string").alias("bus1"), F.lit(50.0).alias("frequency_hz"))
    spans = spans.unionByName(customers.select(F.concat(F.lit("b"), key).alias("line_id"), key.cast("string").alias("bus0"), F.lit(None).cast("string").alias("bus1"), hz.alias("frequency_hz")))
    return sever_buses(buses, spans, 50.0)[0].select("bus_id", "severed_from")


@query(
    f"WITH {S.BUS_SQL}, {S.LINE_SQL} SELECT 'unresolved_bus' AS name, CAST((SELECT count(*) FROM line WHERE bus0 NOT IN (SELECT bus_id FROM bus)) + (SELECT count(*) FROM line WHERE bus1 NOT IN (SELECT bus_id FROM bus)) AS BIGINT) AS value "
    "UNION ALL SELECT 'self_loop', (SELECT count(*) FROM line WHERE bus0 = bus1) UNION ALL SELECT 'missing_length', (SELECT count(*) FROM line WHERE metres IS NULL OR metres <= 0)"
)
def integrity_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridweave.plans.validate import unresolved_ends

    lines, buses = S.lines(spark, sf_dir), S.buses(spark, sf_dir)
    lost = unresolved_ends(lines, buses).agg(F.count(F.lit(1)).alias("value")).select(F.lit("unresolved_bus").alias("name"), "value")
    sums = lines.agg(F.count_if(F.col("bus0") == F.col("bus1")).alias("self_loop"), F.count_if(F.coalesce(F.col("metres") <= 0, F.lit(True))).alias("missing_length"))
    return lost.unionByName(sums.unpivot([], ["self_loop", "missing_length"], "name", "value"))


@query(None)
def capped_linkage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-dependent clusters of customers on the plane; tests hold the rule against a sequential version."""
    return capped_linkage(_spots(spark, sf_dir), 1500.0, 4000.0)


@query(None)
def greedy_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closest-first one-to-one pairs of customers of one nation."""
    return greedy_match_within(_spots(spark, sf_dir), 5000.0, ("g",))


@query(
    f"WITH RECURSIVE {S.BUS_SQL}, {S.LINE_SQL}, strong AS (SELECT bus_id FROM bus WHERE kv >= 220), edge AS (SELECT bus0, bus1, kv FROM line WHERE bus0 IN (SELECT bus_id FROM strong) AND bus1 IN (SELECT bus_id FROM strong)), "
    "side AS (SELECT DISTINCT bus0 AS a, bus1 AS b FROM edge UNION SELECT DISTINCT bus1, bus0 FROM edge), reach(b) AS (SELECT a FROM (SELECT a FROM side GROUP BY a ORDER BY count(*) DESC, a LIMIT 1) UNION SELECT s.b FROM side s JOIN reach r ON s.a = r.b) "
    "SELECT (SELECT count(*) FROM reach) AS buses, (SELECT count(*) FROM (SELECT DISTINCT bus0, bus1, kv FROM edge WHERE bus0 IN (SELECT b FROM reach))) AS branches, true AS balanced, true AS solved"
)
def network_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear power flow on the largest part of the synthetic backbone: does it carry balanced injections without a residual?"""
    from gridweave.plans.powerflow import linear_flow_report

    buses = S.buses(spark, sf_dir).select("bus_id", F.col("kv").alias("voltage_kv"), F.lit(50.0).alias("frequency_hz"))
    lines = S.lines(spark, sf_dir).withColumn("t", T.line_type(F.col("kv")))
    lines = lines.withColumn("x_ohm", T.electrical(F.col("kv"), F.col("n_circuits"), F.col("metres"), F.col("t"))["x_ohm"]).select("line_id", "bus0", "bus1", "x_ohm", F.col("kv").alias("voltage_kv"))
    out = linear_flow_report(buses.where("voltage_kv >= 220"), lines)
    balanced = F.abs(F.col("injected_mw") - F.col("withdrawn_mw")) < 1e-6
    return out.select("buses", "branches", balanced.alias("balanced"), (F.col("max_residual_mw") < 1e-6).alias("solved"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route length per voltage with the number of components of the synthetic grid."""
    lines = S.lines(spark, sf_dir)
    labels = connected_components(lines, "bus0", "bus1")
    joined = lines.join(labels, lines["bus0"] == labels["node"])
    return joined.groupBy(F.col("kv").cast("int").alias("kv")).agg(
        F.count(F.lit(1)).alias("n_spans"), F.round(F.sum("metres") / 1000, 3).alias("route_km"), F.count_distinct("component").alias("n_components"),
    )
