"""Queries of network attributes, patches, validation and comparison over tables made from the driver tables."""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.config import Config, Traction
from gridweave.functions import tags as T
from gridweave.plans import build as B
from gridweave.plans import compare, patch
from gridweave.plans import network as N
from gridweave.plans import synthetic as S
from gridweave.plans import validate as V
from gridweave.plans.registry import CONFIG, query
from gridweave.plans.registry_elements import _path, _tags, _way
from gridweave.plans.storage import fresh_path, kept, materialise
from gridweave.sources import tables

KEY_SQL = "cell AS (SELECT c_custkey AS k FROM customer)"


def nth() -> Column:
    """The key of a cell."""
    return F.col("k")


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))


def _name(letter: str, key: Column | None = None) -> Column:
    return F.concat(F.lit(letter), (nth() if key is None else key).cast("string"))


# Scalars ---------------------------------------------------------------------------------------------------------------

RAIL = Traction(enabled=True, operators=("DB Energie", "SNCF", "ÖBB"), countries=("DE", "FR"), strict_operator_tokens=True)
OPERATORS = ["DB Energie", "db energie; SNCF", "SNCF Reseau", "SNCFX", "Grid; DB Energie", "Sncf"]


@query(
    f"WITH {KEY_SQL}, o AS (SELECT k, {S.pick_sql('k', OPERATORS)} AS op, {S.pick_sql('(k // 6)', ['DE', 'DE;FR', 'DE;PL', ''])} AS land, {S.pick_sql('(k // 24)', [110.0, 132.0, 220.0])} AS kv, k % 5 <> 0 AS silent FROM cell) "
    "SELECT k, op IN ('DB Energie', 'db energie; SNCF', 'SNCF Reseau', 'Sncf') AS by_name, silent AND kv <= 132 AND land IN ('DE', 'DE;FR') AND op IN ('DB Energie', 'db energie; SNCF', 'SNCF Reseau', 'Sncf') AS traction FROM o"
)
def operator_traction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Railway operators by token: a short name must be the token or its first word."""
    operator, land, kv = S.pick(nth(), OPERATORS), S.pick(F.floor(nth() / 6).cast("long"), ["DE", "DE;FR", "DE;PL", ""]), S.pick(F.floor(nth() / 24).cast("long"), [110.0, 132.0, 220.0])
    source = F.when(nth() % 5 == 0, "osm_frequency_tag_50").otherwise("no_frequency_tag")
    return _cells(spark, sf_dir).select("k", T.operator_is_traction(operator, RAIL).alias("by_name"), T.traction_by_operator(kv, source, land, operator, RAIL).alias("traction"))


@query("WITH e AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN 'way' ELSE 'relation' END AS kind FROM part) SELECT kind || '/' || CAST(k AS VARCHAR) AS osm_id, row_number() OVER (ORDER BY kind, k) - 1 AS place FROM e")
def element_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element ids in the order of kind and number, which is not that of the text."""
    from gridweave.operators.ranking import ranked

    key = F.col("p_partkey")
    rows = S.table(spark, sf_dir, "part").select(F.concat(F.when(key % 2 == 0, "way/").otherwise("relation/"), key.cast("string")).alias("osm_id"))
    return ranked(rows.withColumn("e", T.element_key(F.col("osm_id"))), "place", "e").select("osm_id", "place")


@query("SELECT p_partkey, CAST(round_even(p_retailprice / 7 * 100, 0) AS BIGINT) AS x, CAST(round_even(-p_retailprice / 3 * 100, 0) AS BIGINT) AS y FROM part")
def endpoint_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return S.table(spark, sf_dir, "part").select("p_partkey", T.endpoint_key(price / 7, -price / 3).alias("e")).select("p_partkey", "e.x", "e.y")


TEXTS = [(110.0, "110"), (66.5, "66.5"), (0.75, "0.75"), (33.333333, "33.3333"), (132.0000001, "132"), (25.05, "25.05")]


@query(
    f"WITH {KEY_SQL}, t AS (SELECT k, {S.pick_sql('k', [t for _, t in TEXTS])} AS kv, {S.pick_sql('(k // 6)', [50.0, 16.7])} AS hz FROM cell) SELECT k, kv AS voltage_text, 'n' || CAST(k AS VARCHAR) || '_' || kv || 'kV' || CASE WHEN hz = 50 THEN '' ELSE '_16_7Hz' END AS bus_id FROM t"
)
def bus_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kv, hz = S.pick(nth(), [v for v, _ in TEXTS]), S.pick(F.floor(nth() / 6).cast("long"), [50.0, 16.7])
    return _cells(spark, sf_dir).select("k", T.voltage_text(kv).alias("voltage_text"), T.bus_id(_name("n"), kv, hz, CONFIG).alias("bus_id"))


@query("SELECT l_orderkey, l_linenumber, 'way/' || CAST(l_orderkey AS VARCHAR) || CASE WHEN l_linenumber % 3 = 2 THEN 'x' ELSE '' END AS base FROM lineitem")
def base_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    text = F.concat(_name("way/", F.col("l_orderkey")), F.when(n % 3 == 0, F.concat(F.lit(":"), n.cast("string"))).when(n % 3 == 1, F.concat(F.lit("-"), n.cast("string"))).otherwise("x"))
    return S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.base_id(text).alias("base"))


@query(f"WITH {KEY_SQL} SELECT k, CASE WHEN k % 3 = 0 THEN 'a;b' WHEN k % 3 = 1 THEN 'a' ELSE 'a;b' END AS added, CASE WHEN k % 2 = 0 THEN 'a;x' ELSE 'a' END AS joined FROM cell")
def flag_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags are sorted sets: what is there is not added twice, and null adds nothing."""
    before = F.when(nth() % 3 == 2, F.array(F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("a")))
    added = F.array_join(F.array_sort(T.add_flag(before, "b", nth() % 3 != 1)), ";")
    return _cells(spark, sf_dir).select("k", added.alias("added"), patch.flagged(F.lit("a"), F.when(nth() % 2 == 0, "x")).alias("joined"))


# Patches ---------------------------------------------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the synthetic grid with the columns that patches touch."""
    rows = S.lines(spark, sf_dir)
    hz = F.when(F.col("n_circuits") == 3, 16.7).otherwise(50.0)
    return rows.select("line_id", F.col("elem").cast("string").alias("osm_id"), "bus0", "bus1", F.col("kv").alias("voltage_kv"), "n_circuits", F.col("metres").alias("length_conductor_m"), hz.alias("frequency_hz"), F.lit("none").alias("frequency_source"), F.lit("").alias("qa_flags"), F.lit(0).alias("component"))


HZ_SQL = "CASE WHEN n_circuits = 3 THEN CAST(16.7 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END"


@query(
    f"WITH {S.LINE_SQL}, g AS (SELECT elem, bus0, bus1, count(*) AS n, max(n_circuits) = min(n_circuits) AND count(DISTINCT pos % 2) = 1 AS same FROM line GROUP BY 1, 2, 3), r AS (SELECT l.line_id, g.n, g.same, row_number() OVER (PARTITION BY l.elem, l.bus0, l.bus1 ORDER BY l.line_id) AS place FROM line l JOIN g ON g.elem = l.elem AND g.bus0 = l.bus0 AND g.bus1 = l.bus1) "
    "SELECT line_id, CASE WHEN n = 1 THEN '' WHEN same THEN 'duplicate_circuit_rows_collapsed_' || CAST(n AS VARCHAR) || 'to1' ELSE 'circuit_count_element_level_ambiguous' END AS qa_flags FROM r WHERE n = 1 OR NOT same OR place = 1"
)
def collapsed_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pos = F.split("line_id", ":")[1].cast("int")
    return patch.collapse_duplicates(_lines(spark, sf_dir).withColumn("shape", pos % 2)).select("line_id", "qa_flags")


@query(f"WITH {S.LINE_SQL} SELECT line_id, CASE WHEN pos % 2 = 0 THEN elem ELSE 0 END AS component, CASE WHEN pos % 2 = 0 THEN 'new' END AS owner FROM line")
def propagated_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of one store carried to another by key; rows that it lacks keep theirs."""
    rows = _lines(spark, sf_dir)
    source = rows.where(F.split("line_id", ":")[1].cast("int") % 2 == 0).select("line_id", F.col("osm_id").cast("long").alias("component"), F.lit("new").alias("owner"))
    return patch.propagated(rows.withColumn("component", F.col("component").cast("long")), source, "line_id", ["component", "owner"]).select("line_id", "component", "owner")


@query(f"WITH {KEY_SQL}, t AS (SELECT k, {S.pick_sql('k', S.KVS)} AS a, {S.pick_sql('(k // 8)', S.KVS)} AS b FROM cell), s AS (SELECT *, least(a, b) AS lo, greatest(a, b) AS hi FROM t) SELECT k, CASE WHEN lo >= 200 THEN 'R1' WHEN lo >= 100 AND hi >= 330 THEN 'R2' WHEN lo >= 100 AND hi >= 200 THEN 'R3' WHEN lo >= 100 THEN 'R4' WHEN hi >= 200 THEN 'R5' ELSE 'R6' END AS band, hi < 1.095 * lo AS artefact, a AS voltage0_kv FROM s")
def typed_by_voltage_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transformer parameters, typed once for each pair of voltages."""
    rows = _cells(spark, sf_dir).select("k", S.pick(nth(), S.KVS).alias("voltage0_kv"), S.pick(F.floor(nth() / 8).cast("long"), S.KVS).alias("voltage1_kv"), F.lit(None).cast("double").alias("x_pu"))
    out = patch.typed_transformers(rows)
    return out.select("k", F.substring(F.split("parameters_source", ":")[1], 1, 2).alias("band"), F.col("parameters_source").contains("artifact").alias("artefact"), "voltage0_kv")


@query(f"WITH {S.LINE_SQL} SELECT 'line_' || CAST(CAST(kv AS INTEGER) AS VARCHAR) || 'kV' || CASE WHEN n_circuits = 3 THEN '_16_7Hz' ELSE '' END AS layer, count(*) AS n FROM line WHERE kv IN (110, 132) GROUP BY 1")
def traction_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traction rows of each layer in a layer of their own."""
    rows = _lines(spark, sf_dir)
    split = patch.split_traction({f"line_{kv}kV": rows.where(F.col("voltage_kv") == kv) for kv in (110, 132)}, 16.7)
    return patch.layer_counts(patch.united(split))


@query(
    f"WITH {KEY_SQL}, p AS (SELECT k, 1000 + (k % 5) * 100 AS stated, CASE WHEN k % 7 = 0 THEN 1990 ELSE 0 END AS connector FROM cell), d AS (SELECT *, 6371008.8 * pi() / 180 / 50 AS drawn FROM p) "
    "SELECT k, CASE WHEN abs(drawn - stated - connector) <= 0.1 * (stated + connector) THEN CAST(stated AS DOUBLE) WHEN drawn - connector < greatest(drawn * 0.05, 5) THEN CAST(stated AS DOUBLE) ELSE round(drawn - connector, 1) END AS metres, "
    "CASE WHEN abs(drawn - stated - connector) <= 0.1 * (stated + connector) THEN '' WHEN drawn - connector < greatest(drawn * 0.05, 5) THEN 'length_geometry_conflict_unresolved' ELSE 'length_recomputed_from_geometry' END AS qa_flags, "
    "round(CASE WHEN abs(drawn - stated - connector) <= 0.1 * (stated + connector) OR drawn - connector < greatest(drawn * 0.05, 5) THEN 1 ELSE (drawn - connector) / stated END, 6) AS r_ohm FROM d"
)
def recomputed_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    stated = (1000 + (nth() % 5) * 100).cast("double")
    rows = _cells(spark, sf_dir).select(
        "k", stated.alias("length_conductor_m"), F.when(nth() % 7 == 0, 1990.0).otherwise(0.0).alias("connector0_m"), F.lit(None).cast("double").alias("connector1_m"), F.lit(1.0).alias("r_ohm"), F.lit(2.0).alias("x_ohm"), F.lit("").alias("qa_flags"),
        F.array(F.lit(0.0), F.lit(0.02)).alias("lons"), F.array(F.lit(0.0), F.lit(0.0)).alias("lats"),
    )
    return patch.recompute_lengths(rows).select("k", F.col("length_conductor_m").alias("metres"), "qa_flags", F.round("r_ohm", 6).alias("r_ohm"))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(buses, edges): three buses per key, the third of another frequency for every third."""
    cells = _cells(spark, sf_dir)
    hz = F.when(nth() % 3 == 0, 16.7).otherwise(50.0)
    buses = cells.select(F.explode(F.array(F.struct(_name("a").alias("bus_id"), F.lit(50.0).alias("frequency_hz")), F.struct(_name("b").alias("bus_id"), hz.alias("frequency_hz")), F.struct(_name("c").alias("bus_id"), F.lit(50.0).alias("frequency_hz")))).alias("s")).select("s.*")
    edges = cells.select(_name("t").alias("transformer_id"), _name("a").alias("bus0"), _name("b").alias("bus1"))
    return buses, edges


@query(f"WITH {KEY_SQL} SELECT 't' || CAST(k AS VARCHAR) AS transformer_id, 'bridging' AS kind FROM cell WHERE k % 3 = 0 UNION ALL SELECT 't' || CAST(k AS VARCHAR), 'kept' FROM cell WHERE k % 3 <> 0")
def frequency_bridges(spark: SparkSession, sf_dir: str) -> DataFrame:
    buses, edges = _mixed(spark, sf_dir)
    one = patch.bridging_edges(edges, buses).select("transformer_id", F.lit("bridging").alias("kind"))
    return one.unionByName(patch.without_bridging(edges, buses).select("transformer_id", F.lit("kept").alias("kind")))


@query(f"WITH {KEY_SQL} SELECT 'a' || CAST(k AS VARCHAR) AS bus_id FROM cell UNION ALL SELECT 'b' || CAST(k AS VARCHAR) FROM cell")
def unused_buses_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    buses, edges = _mixed(spark, sf_dir)
    return patch.drop_unused_buses(buses, edges).select("bus_id")


@query(
    f"WITH {KEY_SQL} SELECT 'b' || CAST(k AS VARCHAR) AS bus_id, 'b' || CAST(k AS VARCHAR) AS end_of FROM cell WHERE k % 4 > 1 UNION ALL SELECT 'z' || CAST(k AS VARCHAR), 'z' || CAST(k AS VARCHAR) FROM cell WHERE k % 4 = 0 UNION ALL SELECT NULL, 'c' || CAST(k AS VARCHAR) FROM cell WHERE k % 4 = 1 "
    "UNION ALL SELECT 'a' || CAST(k AS VARCHAR), NULL FROM cell UNION ALL SELECT 'c' || CAST(k AS VARCHAR), NULL FROM cell"
)
def retagged_buses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bus renamed, or merged into one that exists; the ends of lines follow."""
    buses, edges = _mixed(spark, sf_dir)
    names = _cells(spark, sf_dir).where(nth() % 4 < 2).select(_name("b").alias("bus_id"), F.when(nth() % 4 == 0, _name("z")).otherwise(_name("c")).alias("new_id"))
    out, spans = patch.retag_buses(buses, edges, names)
    ends = spans.select(F.col("bus1").alias("end_of"))
    both = out.select("bus_id").join(ends, F.col("bus_id") == F.col("end_of"), "full")
    merged = F.col("end_of").startswith("c")
    return both.where(~F.coalesce(merged, F.lit(False))).unionByName(both.where(merged).select(F.lit(None).cast("string").alias("bus_id"), "end_of")).unionByName(both.where(merged).select("bus_id", F.lit(None).cast("string").alias("end_of")))


@query(f"WITH {S.LINE_SQL} SELECT line_id, CASE WHEN elem % 10 = 0 THEN 'line_moved' ELSE 'line_old' END AS layer FROM line")
def moved_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumn("layer", F.lit("line_old"))
    moves = rows.where(F.col("osm_id").endswith("0")).select("osm_id", F.lit("line_moved").alias("layer")).distinct()
    return patch.move_layer(rows, moves).select("line_id", "layer")


@query(f"WITH {S.LINE_SQL} SELECT line_id, CASE WHEN elem % 10 = 0 THEN 'dc' ELSE 'ac' END AS side, CASE WHEN elem % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE {HZ_SQL} END AS frequency_hz FROM line")
def lines_to_dc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines handed over to the table of DC links on the columns that both have."""
    rows = _lines(spark, sf_dir)
    dc = rows.select("line_id", "frequency_hz", F.lit(None).cast("double").alias("p_nom_mw")).limit(0)
    ac, links = patch.to_dc(rows, dc, rows.where(F.col("osm_id").endswith("0")).select("osm_id").distinct())
    return ac.select("line_id", F.lit("ac").alias("side"), "frequency_hz").unionByName(links.select("line_id", F.lit("dc").alias("side"), "frequency_hz"))


@query("SELECT c_custkey AS key, c_name AS name, CAST(NULL AS DOUBLE) AS extra FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def appended_on_common_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return patch.append_common(patch.add_column(c, "extra", "double"), s)


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_name END AS name FROM customer")
def rows_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return patch.rewritten(rows, rows.where("key % 4 = 0").withColumn("name", F.lit("new")), "key")


@query("SELECT 1 AS step, 'applied' AS what, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS n UNION ALL SELECT 2, 'applied before', 0 UNION ALL SELECT 3, 'refused', 0 UNION ALL SELECT 4, 'history', 1 UNION ALL SELECT 5, 'dry', (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0)")
def patch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch applied once; again it does nothing; one whose check fails is not published, and a dry run is not entered."""
    root = fresh_path(spark, "store")
    S.table(spark, sf_dir, "customer").select("c_custkey").write.parquet(f"{root}/v1/site")
    half = lambda t: {"site": t["site"].where("c_custkey % 2 = 0")}
    good = lambda t: {"odd": t["site"].where("c_custkey % 2 = 1")}
    first = patch.apply(spark, root, patch.Patch("v2", "half", half, good), ["site"], "v1")
    rows = [(1, "applied", spark.read.parquet(f"{first}/site").count())]
    rows.append((2, "applied before" if patch.apply(spark, root, patch.Patch("v2", "half", half, good), ["site"], "v1") is None else "applied", 0))
    try:
        patch.apply(spark, root, patch.Patch("v3", "none", lambda t: {}, good), ["site"], "v1")
        rows.append((3, "applied", 0))
    except patch.InvariantBroken:
        rows.append((3, "refused", 0))
    dry = patch.apply(spark, root, patch.Patch("v4", "half", half, good), ["site"], "v1", dry_run=True)
    rows += [(4, "history", patch.history(spark, root).count()), (5, "dry", spark.read.parquet(f"{dry}/site").count())]
    return spark.createDataFrame(rows, "step int, what string, n long")


@query(
    f"WITH {S.BUS_SQL}, {S.LINE_SQL}, inside AS (SELECT bus_id FROM bus WHERE lat BETWEEN 36 AND 66 AND lon BETWEEN -9 AND 40) SELECT 'bus' AS what, count(*) AS n FROM inside UNION ALL SELECT 'line', count(*) FROM line WHERE bus0 IN (SELECT bus_id FROM inside) AND bus1 IN (SELECT bus_id FROM inside) "
    "UNION ALL SELECT 'transformer', count(*) FROM inside UNION ALL SELECT 'footprint', count(*) FROM inside"
)
def pruned_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buses outside a box go from every table, with whatever ends or begins at one."""
    buses, lines = S.buses(spark, sf_dir), S.lines(spark, sf_dir)
    trafos = buses.select(F.col("bus_id").alias("bus0"), F.col("bus_id").alias("bus1"))
    prints = buses.select(F.array("lon").alias("lons"), F.array("lat").alias("lats"))
    kept, spans, more = patch.prune_scope(buses, lines, (36.0, -9.0, 66.0, 40.0), {"transformer": trafos, "footprint": prints})
    counts = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("what"), "n") for n, t in (("bus", kept), ("line", spans), *more.items())]
    from gridweave.plans.scenes import together

    return together(*counts)


@query(f"WITH {KEY_SQL} SELECT k FROM cell WHERE k % 5 = 0 OR k % 7 = 0 OR (k % 3 = 0 AND k % 11 <> 0)")
def status_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DC links with an unknown status, a rating out of range, or a rating without its source."""
    status = F.when(nth() % 5 == 0, "mystery").otherwise("operational")
    rated = F.when(nth() % 7 == 0, 30_000.0).when(nth() % 11 == 0, F.lit(None)).otherwise(500.0).cast("double")
    rows = _cells(spark, sf_dir).select("k", status.alias("status"), rated.alias("p_nom_mw"), F.when(nth() % 3 == 0, "unknown").otherwise("survey").alias("p_nom_source"))
    return patch.status_violations(rows, T.DC_STATUS).select("k")


SCRAPED = ["16.7", "16,67;16.7", "50;16.7", "0", "50", "60", ""]


@query(
    f"WITH {KEY_SQL}, s AS (SELECT k, {S.pick_sql('k', SCRAPED)} AS f, {S.pick_sql('(k // 7)', [110.0, 220.0])} AS kv, k % 4 = 3 AS unknown, k % 3 = 0 AS rail FROM cell) "
    "SELECT k, CASE WHEN unknown OR f = '' THEN CASE WHEN rail AND kv <= 132 THEN CAST(16.7 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END WHEN f LIKE '16%' AND kv <= 132 THEN 16.7 WHEN f = '0' THEN 0 ELSE 50 END AS frequency_hz, "
    "CASE WHEN unknown OR f = '' THEN CASE WHEN rail AND kv <= 132 THEN 'operator_inferred' ELSE 'no_frequency_tag' END WHEN f LIKE '16%' AND kv <= 132 THEN 'osm_frequency_tag' WHEN f LIKE '16%' THEN 'osm_frequency_tag_traction_overridden_ehv_gate' WHEN f = '50;16.7' THEN 'osm_mixed_kept_grid' WHEN f = '0' THEN 'osm_frequency_tag_0_dc' WHEN f = '50' THEN 'osm_frequency_tag_50' ELSE 'nonstandard_frequency_tag_kept_grid' END AS frequency_source FROM s"
)
def frequency_from_scrape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies by element, by the element before a suffix, and by contained elements."""
    cells = _cells(spark, sf_dir)
    element = _name("way/")
    lines = cells.select(
        "k", F.when(nth() % 4 == 0, element).otherwise("way/none").alias("osm_id"), F.when(nth() % 4 == 1, F.concat(element, F.lit(":2"))).otherwise(_name("line")).alias("line_id"), F.when(nth() % 4 == 2, F.concat(F.lit("way/none;"), element)).otherwise("").alias("contains"),
        S.pick(F.floor(nth() / 7).cast("long"), [110.0, 220.0]).alias("voltage_kv"), F.lit("").alias("countries"), F.when(nth() % 3 == 0, "Rail One").otherwise("Grid").alias("operator"), F.lit("").alias("qa_flags"),
    )
    scrape = cells.where(nth() % 4 != 3).select(element.alias("osm_id"), S.pick(nth(), SCRAPED).alias("frequency"))
    out = patch.frequency_by_scrape(lines, scrape, Traction(enabled=True, operators=("rail",)), 50.0)
    return out.select("k", "frequency_hz", "frequency_source")


@query(f"WITH {S.LINE_SQL} SELECT count(*) + 500 AS lines, 500 AS marked, count(*) + 500 AS again FROM line")
def fused_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additions marked with their source; a second run adds nothing."""
    lines = _lines(spark, sf_dir)
    more = spark.range(500).select(F.concat(F.lit("new/"), F.col("id")).alias("line_id"), F.lit("gap").alias("qa_flags"))
    one = compare.fused(lines, more, "fused_v24")
    two = compare.fused(one, more, "fused_v24")
    marked = F.count_if(F.col("qa_flags") == "gap;fused_v24")
    return one.agg(F.count(F.lit(1)).alias("lines"), marked.cast("int").alias("marked")).crossJoin(two.agg(F.count(F.lit(1)).alias("again")))


@query(f"WITH {KEY_SQL} SELECT 'c' || CAST(k AS VARCHAR) AS key, CASE k % 4 WHEN 0 THEN CAST(0 AS DOUBLE) ELSE round(CAST(7 AS DOUBLE) / 21, 9) END AS covered FROM cell WHERE k % 4 IN (0, 1)")
def gap_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of which less than two fifths of the samples lie near lines that are there."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 5000
    ends = lambda a, b: F.array(F.lit(float(a)), F.lit(float(b)))
    ours_to = F.when(nth() % 4 == 1, 175.0).when(nth() % 4 == 2, 400.0).otherwise(900.0)
    candidates = cells.select(_name("c").alias("key"), ends(0, 1000).alias("xs"), F.array(y, y).alias("ys"))
    off = y + F.when(nth() % 4 == 0, 200.0).otherwise(0.0)
    ours = cells.select(_name("o").alias("key"), F.array(F.lit(-100.0), ours_to).alias("xs"), F.array(off, off).alias("ys"))
    return compare.gap_fill(candidates, ours).select("key", F.round("covered", 9).alias("covered"))


@query(f"WITH {KEY_SQL} SELECT CAST(k AS VARCHAR) AS a, 'n' || CAST(k AS VARCHAR) AS b, CAST(k % 5 * 60 + 10 AS DOUBLE) AS d FROM cell WHERE k % 5 * 60 + 10 <= 250")
def station_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of two sources within 250 m, each used once, with a second one a little farther off."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 5000
    d = (nth() % 5 * 60 + 10).cast("double")
    auth = cells.select(nth().cast("string").alias("id"), F.lit(0.0).alias("x"), y.alias("y"))
    ours = cells.select(_name("n").alias("id"), d.alias("x"), y.alias("y")).unionByName(cells.select(_name("f").alias("id"), -d - 5, y).toDF("id", "x", "y"))
    return compare.station_match(auth, ours, 250.0)


@query(f"WITH {KEY_SQL}, d AS (SELECT CAST(k % 5 * 60 + 10 AS DOUBLE) AS d FROM cell) SELECT count(*) AS n, round(quantile_cont(d, 0.5), 6) AS median_offset FROM d WHERE d <= 250")
def median_station_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = station_matching(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.percentile("d", 0.5), 6).alias("median_offset"))


# Network attributes and validation -------------------------------------------------------------------------------------


@query("SELECT c_nationkey AS station_id, arg_max(c_custkey, c_custkey % 97 * 1000000 - c_custkey) AS bus_id, max(c_custkey % 97) AS voltage_kv FROM customer GROUP BY 1")
def one_bus_per_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("station_id"), F.col("c_custkey").alias("bus_id"), (F.col("c_custkey") % 97).alias("voltage_kv"))
    return tables.one_per_station(rows)


@query(
    f"WITH b AS (SELECT c_custkey, c_nationkey % 7 AS st, {S.pick_sql('(c_custkey // 3)', [110.0, 220.0, 400.0])} AS kv FROM customer), l AS (SELECT st, string_agg(CAST(CAST(kv AS INTEGER) AS VARCHAR), ';' ORDER BY kv) AS kvs FROM (SELECT DISTINCT st, kv FROM b) GROUP BY 1) SELECT c_custkey AS bus_id, kvs AS station_voltages_kv FROM b JOIN l ON b.st = l.st"
)
def station_voltage_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = S.table(spark, sf_dir, "customer").select(key.alias("bus_id"), (F.col("c_nationkey") % 7).alias("station_id"), S.pick(F.floor(key / 3).cast("long"), [110.0, 220.0, 400.0]).alias("voltage_kv"))
    return patch.station_voltages(rows).select("bus_id", "station_voltages_kv")


@query(f"WITH {S.LINE_SQL}, s AS (SELECT elem % 7 AS component, count(*) AS n_spans, sum(metres) / 1000 AS km, coalesce(sum(metres) FILTER (WHERE kv >= 220), 0) / 1000 AS km_ge220 FROM line GROUP BY 1) SELECT component, n_spans, round(km, 3) AS km, round(km_ge220, 3) AS km_ge220, round(km / (SELECT sum(km) FROM s) * 100, 6) AS share_pct FROM s")
def component_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumn("component", F.col("osm_id").cast("long") % 7)
    out = V.component_stats(rows)
    return out.select("component", "n_spans", F.round("km", 3).alias("km"), F.round("km_ge220", 3).alias("km_ge220"), F.round("share_pct", 6).alias("share_pct"))


@query(f"WITH {S.LINE_SQL} SELECT CAST(trunc(kv) AS INTEGER) AS kv, round(sum(metres) / 1000, 3) AS km, round(sum(metres * n_circuits) / 1000, 3) AS circuit_km FROM line WHERE n_circuits <> 3 GROUP BY 1")
def voltage_table_without_traction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.voltage_table(_lines(spark, sf_dir), 16.7).select("kv", F.round("km", 3).alias("km"), F.round("circuit_km", 3).alias("circuit_km"))


@query(f"WITH {S.LINE_SQL} SELECT CAST(elem % 11 AS VARCHAR) AS countries, round(sum(metres) / 1000, 3) AS km FROM line WHERE n_circuits = 3 GROUP BY 1 ORDER BY sum(metres) DESC LIMIT 8")
def traction_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).withColumn("countries", (F.col("osm_id").cast("long") % 11).cast("string"))
    return V.traction_km_by_country(rows, 16.7).select("countries", F.round("km", 3).alias("km"))


@query(f"WITH {KEY_SQL} SELECT 's' || CAST(k AS VARCHAR) AS station_id, CAST(2 AS BIGINT) AS n, round(6371008.8 * radians(CAST(k % 9 + 1 AS DOUBLE) / 100), 3) AS metres FROM cell WHERE k % 2 = 0")
def site_extents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box diagonals of stations of several footprints, here along a meridian."""
    lat = (nth() % 9 + 1).cast("double") / 100
    rows = _cells(spark, sf_dir).select(_name("s").alias("station_id"), F.explode(F.sequence(F.lit(1), F.when(nth() % 2 == 0, 2).otherwise(1))).alias("part"), lat.alias("lat"))
    rows = rows.select("station_id", F.array(F.lit(5.0), F.lit(5.0)).alias("lons"), F.array(F.lit(0.0), F.when(F.col("part") == 2, F.col("lat")).otherwise(0.0)).alias("lats"))
    return V.site_extents(rows).select("station_id", "n", F.round("metres", 3).alias("metres"))


@query(
    f"WITH {KEY_SQL}, s AS (SELECT k, CASE WHEN k % 4 = 3 THEN CAST(0 AS DOUBLE) ELSE CAST(100 + k % 50 + 0.4 AS DOUBLE) END AS mva0, CASE WHEN k % 4 = 3 THEN CAST(0 AS DOUBLE) ELSE CAST(200 - k % 50 AS DOUBLE) END AS mva1 FROM cell) "
    "SELECT 's' || CAST(k AS VARCHAR) || '_110_400' AS transformer_id, CAST(CASE WHEN k % 4 = 3 THEN 500 ELSE ceil(greatest(mva0, mva1)) END AS DOUBLE) AS mva, CAST(500 AS DOUBLE) AS s_nom_mva, 'typing_rule_v23:R2' || CASE WHEN k % 4 = 3 THEN ';alt_snom_fallback_banded_no_incident_ac_lines' ELSE '' END AS source FROM s"
)
def transformers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per neighbouring voltages, rated by the lines at its buses or else by its band."""
    cells = _cells(spark, sf_dir)
    buses = cells.select(_name("s").alias("node_id"), F.explode(F.array(F.lit(110.0), F.lit(400.0))).alias("voltage_kv"))
    buses = buses.select("node_id", F.col("node_id").alias("station_id"), F.lit("Yard").alias("station_name"), F.lit("substation").alias("node_type"), "voltage_kv", F.lit(50.0).alias("frequency_hz"), F.concat_ws("_", "node_id", F.col("voltage_kv").cast("int").cast("string")).alias("bus_id"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    some = cells.where(nth() % 4 != 3)
    low = some.select(F.concat(_name("s"), F.lit("_110")).alias("bus0"), _name("far").alias("bus1"), F.lit(50.0).alias("frequency_hz"), (100 + nth() % 50 + 0.4).cast("double").alias("s_nom_mva"))
    high = some.select(F.concat(_name("s"), F.lit("_400")).alias("bus0"), _name("off").alias("bus1"), F.lit(50.0).alias("frequency_hz"), (200 - nth() % 50).cast("double").alias("s_nom_mva"))
    rail = cells.select(F.concat(_name("s"), F.lit("_110")).alias("bus0"), _name("rail").alias("bus1"), F.lit(16.7).alias("frequency_hz"), F.lit(9999.0).alias("s_nom_mva"))
    out = N.transformers(buses, low.unionByName(high).unionByName(rail), CONFIG)
    return out.select("transformer_id", F.col("s_nom_pypsa_eur_mva").alias("mva"), "s_nom_mva", F.col("parameters_source").alias("source"))


@query(
    f"WITH {KEY_SQL} SELECT 'way/' || CAST(k AS VARCHAR) AS osm_id, 'a' || CAST(k AS VARCHAR) AS bus0, CASE WHEN k % 3 <> 2 THEN 'b' || CAST(k AS VARCHAR) END AS bus1, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN 'converter_far' ELSE 'converter_unattached' END AS qa, CASE WHEN k % 5 = 0 THEN CAST(k AS DOUBLE) END AS p_nom_mw, CASE WHEN k % 5 = 0 THEN 'operational' ELSE 'unknown' END AS status FROM cell"
)
def dc_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terminals at the nearest bus within 10 km, flagged beyond 2 km, with ratings where there are any."""
    cells, y = _cells(spark, sf_dir), nth().cast("double") * 50_000
    off = F.when(nth() % 3 == 0, 100.0).when(nth() % 3 == 1, 5000.0).otherwise(12_000.0)
    records = cells.select(_name("way/").alias("osm_id"), F.lit(0).alias("part"), _name("k").alias("key"), F.array(F.lit(0.0), F.lit(20_000.0)).alias("xs"), F.array(y, y).alias("ys"))
    buses = cells.select(_name("a").alias("bus_id"), F.lit(-50.0).alias("x"), y.alias("y")).unionByName(cells.select(_name("b").alias("bus_id"), (off + 20_000).alias("x"), y.alias("y")))
    ratings = cells.where(nth() % 5 == 0).select(_name("way/").alias("osm_id"), nth().cast("double").alias("p_nom_mw"), F.lit("operational").alias("status"), F.lit("survey").alias("p_nom_source"), F.lit("").alias("qa_flags"))
    out = N.dc_links(records, buses, CONFIG, ratings)
    return out.select("osm_id", "bus0", "bus1", F.array_join("qa", ";").alias("qa"), "p_nom_mw", "status")


# Order-dependent rules ---------------------------------------------------------------------------------------------------

ROW_SQL = "gaps AS (SELECT k, CAST(10 + k % 7 AS DOUBLE) AS d1, CAST(10 + k % 5 AS DOUBLE) AS d2, CAST(10 + k % 3 AS DOUBLE) AS d3 FROM cell)"


def _rows_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four points in a row per key, with three gaps of 10 to 16 m."""
    one, two, three = ((10 + nth() % m).cast("double") for m in (7, 5, 3))
    places = F.array(F.lit(0.0), one, one + two, one + two + three)
    rows = _cells(spark, sf_dir).select("k", F.posexplode(places).alias("n", "x"))
    return rows.select((nth() * 10 + F.col("n")).alias("id"), "x", (nth() * 1000).cast("double").alias("y"))


@query(
    f"WITH {KEY_SQL}, {ROW_SQL}, t AS (SELECT *, k * 10 AS a, k * 10 + 1 AS b, k * 10 + 2 AS c, k * 10 + 3 AS e, CASE WHEN d2 < d1 AND d2 <= d3 THEN 2 ELSE 1 END AS pick FROM gaps) "
    "SELECT b AS a, c AS b, d2 AS d FROM t WHERE pick = 2 UNION ALL SELECT a, b, d1 FROM t WHERE pick = 1 UNION ALL SELECT c, e, d3 FROM t WHERE pick = 1"
)
def greedy_matching_in_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closest first, each point once; of equally close pairs that of the smaller ids."""
    from gridweave.operators.linkage import greedy_match
    from gridweave.operators.spatial import pairs_within

    return greedy_match(pairs_within(_rows_of_points(spark, sf_dir), "id", 16.5))


@query(
    f"WITH {KEY_SQL}, {ROW_SQL}, t AS (SELECT *, d2 < d1 AND d2 <= d3 AS mid, 25 AS cap FROM gaps), c AS (SELECT k, CASE WHEN mid AND d1 <= d3 AND d2 + d1 <= cap THEN [0, 0, 0, 3] WHEN mid AND d1 <= d3 AND d2 + d3 <= cap THEN [0, 1, 1, 1] WHEN mid AND d3 < d1 AND d2 + d3 <= cap THEN [0, 1, 1, 1] "
    "WHEN mid AND d3 < d1 AND d2 + d1 <= cap THEN [0, 0, 0, 3] WHEN mid THEN [0, 1, 1, 3] WHEN d1 <= d2 AND d3 < d2 THEN [0, 0, 2, 2] WHEN d1 <= d2 AND d1 + d2 <= cap THEN [0, 0, 0, 3] WHEN d1 <= d2 THEN [0, 0, 2, 2] WHEN d2 + d3 <= cap THEN [0, 1, 1, 1] ELSE [0, 0, 2, 2] END AS g FROM t) "
    "SELECT k * 10 + n AS id, k * 10 + list_extract(g, n + 1) AS cluster FROM c, (VALUES (0), (1), (2), (3)) v(n)"
)
def capped_linkage_in_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closest first, but no cluster wider than 25 m: of four points in a row two or three stay together."""
    from gridweave.operators.linkage import capped_linkage

    return capped_linkage(_rows_of_points(spark, sf_dir), 16.5, 25.0)


@query("SELECT * FROM (VALUES ('voltage_floor_kv', '63'), ('metric_crs', 'EPSG:3577'), ('traction.max_voltage_kv', '110'), ('traction.operators', 'Rail One;Rail Two'), ('gates.site_merge', '200'), ('gates.site_fence', '30'), ('no area', 'refused'), ('unknown source', 'refused')) v(name, value)")
def configuration(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: ARG001
    """A configuration from a mapping, with defaults, and two that are refused."""
    from gridweave.config import from_mapping

    base = {"voltage_floor_kv": 63, "metric_crs": "EPSG:3577", "areas": ["AU"]}
    c = from_mapping(base | {"traction": {"enabled": True, "max_voltage_kv": 110, "operators": ["Rail One", "Rail Two"]}, "gates": {"site_merge": 200}})
    rows = [("voltage_floor_kv", f"{c.voltage_floor_kv:g}"), ("metric_crs", c.metric_crs), ("traction.max_voltage_kv", f"{c.traction.max_voltage_kv:g}"), ("traction.operators", ";".join(c.traction.operators))]
    rows += [("gates.site_merge", f"{c.gates.site_merge:g}"), ("gates.site_fence", f"{c.gates.site_fence:g}")]
    for name, wrong in (("no area", base | {"areas": []}), ("unknown source", base | {"country_source": "hearsay"})):
        try:
            from_mapping(wrong)
            rows.append((name, "taken"))
        except ValueError:
            rows.append((name, "refused"))
    return spark.createDataFrame(rows, "name string, value string")


@query("SELECT count(*) AS n, 1 AS made FROM customer")
def cached_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made once and read from then on."""
    path, calls = fresh_path(spark, "cache"), []

    def make() -> DataFrame:
        calls.append(1)
        return S.table(spark, sf_dir, "customer").select("c_custkey")

    tables.cached(spark, path, make)
    return tables.cached(spark, path, make).agg(F.count(F.lit(1)).alias("n")).withColumn("made", F.lit(len(calls)))


@query(f"WITH {S.LINE_SQL} SELECT CAST(trunc(kv) AS INTEGER) AS kv, count(*) AS n_spans FROM line GROUP BY 1")
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as JSON and read back."""
    from gridweave.plans.export import write_report

    path = fresh_path(spark, "report")
    write_report(V.voltage_table(_lines(spark, sf_dir).withColumn("frequency_hz", F.lit(50.0)), 16.7).select("kv", "n_spans"), path)
    return spark.read.schema("kv int, n_spans long").json(path)


# The whole build -------------------------------------------------------------------------------------------------------

WORLD = Config(voltage_floor_kv=50, metric_crs="EPSG:3035", areas=("all",), layer_voltages_kv=(110, 220))
#: Places of the drawn world: 200 columns of 0.2 degrees by 3,000 rows of 0.01 degrees (1.1 km), all on the map.
ROW, ROWS = 200, 3000


def _world(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements: per supplier two stations of two voltages, a line between them, and a bar inside the first."""
    k = F.col("s_suppkey")
    rows = S.table(spark, sf_dir, "supplier")
    place = F.when(k < ROW * ROWS, k).otherwise(F.raise_error(F.lit("no place on the map for so many suppliers")).cast("long"))
    lon, lat = (k % ROW).cast("double") * 0.2 - 10, F.floor(place / ROW).cast("double") * 0.01 + 35

    def box(n: int, west: float, name: str) -> DataFrame:
        w, e = lon + west, lon + west + 0.001
        ring = _path((w, lat), (e, lat), (e, lat + 0.001), (w, lat + 0.001), (w, lat))
        return rows.select(*_way(k * 10 + n, _tags(power="substation", voltage="110000;220000", name=F.concat(F.lit(name), k.cast("string"))), ring))

    def line(n: int, volts: str, *points: tuple) -> DataFrame:
        return rows.select(*_way(k * 10 + n, _tags(power="line", voltage=volts, circuits="2"), _path(*points)))

    y = lat + 0.0005
    parts = [
        box(1, 0.0, "West "), box(2, 0.1, "East "), line(3, "110000", (lon + 0.0005, y), (lon + 0.05, y), (lon + 0.1005, y)), line(4, "220000", (lon + 0.0005, y + 0.0002), (lon + 0.1005, y + 0.0002)),
        line(5, "110000", (lon + 0.0002, lat + 0.0002), (lon + 0.0008, lat + 0.0002)),
    ]
    from gridweave.plans.scenes import together

    return together(*parts)


_BUILT: dict[tuple[str, str], B.Network] = {}


def _built(spark: SparkSession, sf_dir: str) -> B.Network:
    """The network of the drawn world, built and stored once for the queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    tables = [f.name for f in fields(B.Network) if f.name != "layers"]
    if key not in _BUILT or not all(kept(getattr(_BUILT[key], name)) for name in tables):
        made = B.build(spark, _world(spark, sf_dir), WORLD)
        _BUILT[key] = replace(made, **{name: materialise(getattr(made, name), name) for name in tables})
    return _BUILT[key]


WORLD_SQL = "unit AS (SELECT s_suppkey AS k FROM supplier)"


@query(
    f"WITH {WORLD_SQL}, l AS (SELECT k, 3 AS n, 110 AS kv FROM unit UNION ALL SELECT k, 4, 220 FROM unit) SELECT 'way/' || CAST(k * 10 + n AS VARCHAR) AS line_id, CAST(kv AS DOUBLE) AS voltage_kv, CAST(2 AS INTEGER) AS n_circuits, 'line_' || CAST(kv AS VARCHAR) || 'kV' AS layer, "
    "'West ' || CAST(k AS VARCHAR) AS start_point, 'East ' || CAST(k AS VARCHAR) AS end_point, 'West ' || CAST(k AS VARCHAR) || ' - East ' || CAST(k AS VARCHAR) AS line_label FROM l"
)
def built_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage from raw elements to lines with labels and layers."""
    lines = _built(spark, sf_dir).lines
    return lines.select("line_id", "voltage_kv", "n_circuits", "layer", "start_point", "end_point", "line_label")


@query(
    f"WITH {WORLD_SQL}, s AS (SELECT k, 1 AS n, 'West ' AS name FROM unit UNION ALL SELECT k, 2, 'East ' FROM unit) SELECT 'way/' || CAST(k * 10 + n AS VARCHAR) AS osm_substation_ids, name || CAST(k AS VARCHAR) AS station_name, 2 AS n_buses, '110;220' AS voltages_kv, CAST(2 AS INTEGER) AS n_lines FROM s"
)
def built_station_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up of stations over their buses."""
    clusters = _built(spark, sf_dir).clusters
    return clusters.select("osm_substation_ids", "station_name", "n_buses", "voltages_kv", "n_lines")


@query(f"WITH {WORLD_SQL} SELECT 'way/' || CAST(k * 10 + 3 AS VARCHAR) || '~in' || i AS line_id FROM unit, (VALUES ('0'), ('1')) v(i) UNION ALL SELECT 'way/' || CAST(k * 10 + 4 AS VARCHAR) || '~in' || i FROM unit, (VALUES ('0'), ('1')) v(i) UNION ALL SELECT 'way/' || CAST(k * 10 + 5 AS VARCHAR) || '~in0' FROM unit")
def built_internals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments inside stations, numbered within their element."""
    return _built(spark, sf_dir).internals.select("line_id")


@query(
    f"WITH {WORLD_SQL}, n AS (SELECT count(*) AS n FROM unit) SELECT 'spans' AS name, CAST(2 * n AS DOUBLE) AS value FROM n UNION ALL SELECT 'buses', 4 * n FROM n UNION ALL SELECT 'station_buses', 4 * n FROM n UNION ALL SELECT 'transformers', 2 * n FROM n UNION ALL SELECT 'internals', 5 * n FROM n UNION ALL SELECT 'components', n FROM n UNION ALL SELECT 'dc_links', 0 FROM n"
)
def built_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a network, with edges of lines and transformers making its components."""
    out = V.summary(_built(spark, sf_dir))
    return out.where(~F.col("name").isin("route_km", "circuit_km", "connector_km"))


@query("SELECT name, true AS passed FROM (VALUES ('close_bus_pairs'), ('internal_ends_p95_m'), ('fragmented_elements'), ('unresolved_bus'), ('self_loop'), ('null_geometry'), ('transformer_parameter_missing'), ('nonpositive_parameter'), ('mixed_frequency_transformer'), ('length_mismatch'), ('wide_sites'), ('long_connectors')) v(name)")
def built_hard_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.hard_checks(_built(spark, sf_dir), WORLD).select("name", "passed")


@query(
    f"WITH {WORLD_SQL}, n AS (SELECT count(*) AS n FROM unit) SELECT 'line_110kV' AS layer, n AS rows_written FROM n UNION ALL SELECT 'line_220kV', n FROM n UNION ALL SELECT 'site', 4 * n FROM n UNION ALL SELECT 'junction_node', 0 FROM n UNION ALL SELECT 'line_internal_to_station', 5 * n FROM n UNION ALL SELECT 'dc_link', 0 FROM n "
    "UNION ALL SELECT 'transformer', 2 * n FROM n UNION ALL SELECT 'station_cluster', 2 * n FROM n UNION ALL SELECT 'substation_footprint', 2 * n FROM n UNION ALL SELECT 'v23_typing_rule', 8 FROM n UNION ALL SELECT 'ac_line_all', 2 * n FROM n UNION ALL SELECT 'site_all', 4 * n FROM n"
)
def exported_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layered files of a network, written and read back."""
    import os

    from gridweave.plans import export
    from gridweave.plans.scenes import together
    from gridweave.sources import gpkg

    folder = fresh_path(spark, "layers").removeprefix("file:").replace("//", "/")
    os.makedirs(folder, exist_ok=True)
    files = [f"{folder}/topology.gpkg", f"{folder}/graph.gpkg"]
    export.write_geopackages(_built(spark, sf_dir), WORLD, *files)
    found = [gpkg.read_layer(spark, f, name).agg(F.count(F.lit(1)).alias("rows_written")).select(F.lit(name).alias("layer"), "rows_written") for f in files for name in gpkg.layers(f) if name != "build_metadata"]
    return together(*found)
