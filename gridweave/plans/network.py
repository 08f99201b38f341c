"""Attributes of the finished network: connectors, electrical values, transformers, DC links, components, labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions import geometry as G
from gridweave.functions import measure as M
from gridweave.functions import tags as T
from gridweave.operators.graph import connected_components
from gridweave.operators.ranking import ranked
from gridweave.operators.spatial import nearest_within
from gridweave.plans.storage import materialise, release


def to_degrees(config: Config, x: Column, y: Column) -> Column:
    """``struct<lon, lat>`` of metric points."""
    crs = config.metric_crs

    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        _, inverse = G.projection(crs)
        out = inverse(np.column_stack([x.to_numpy(float), y.to_numpy(float)]))
        return pd.DataFrame({"lon": out[:, 0], "lat": out[:, 1]})

    return F.pandas_udf(run, "lon double, lat double")(x, y)


def paths_to_degrees(rows: DataFrame, config: Config) -> DataFrame:
    """Adds ``lons, lats`` for ``xs, ys``."""
    crs = config.metric_crs

    def run(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        _, inverse = G.projection(crs)
        cuts = np.cumsum([len(v) for v in xs])[:-1]
        flat = inverse(np.column_stack([np.concatenate(xs.to_list()), np.concatenate(ys.to_list())])) if len(xs) else np.zeros((0, 2))
        return pd.DataFrame({"lons": np.split(flat[:, 0], cuts) if len(xs) else [], "lats": np.split(flat[:, 1], cuts) if len(xs) else []})

    return rows.withColumn("deg", F.pandas_udf(run, "lons array<double>, lats array<double>")("xs", "ys")).select("*", "deg.lons", "deg.lats").drop("deg")


def attach_connectors(spans: DataFrame, buses: DataFrame, config: Config) -> DataFrame:
    """Adds ``bus0, bus1``, lengths of conductor and connectors in metres, and the drawn path in degrees.

    A connector is the straight piece from an end to its bus, zero within a centimetre; the conductor is measured before
    the connectors are added.
    """
    out = paths_to_degrees(spans, config).withColumn("length_conductor_m", M.haversine_length(F.col("lons"), F.col("lats")))
    placed = buses.withColumn("p", to_degrees(config, F.col("x"), F.col("y"))).select("bus_id", "x", "y", "p.lon", "p.lat")
    for e, at in ((0, F.lit(0)), (1, F.size("xs") - 1)):
        side = placed.select(*[F.col(c).alias(f"{c}{e}") for c in placed.columns])
        out = out.withColumn(f"bus{e}", F.when(F.col(f"node{e}").isNotNull(), T.bus_id(F.col(f"node{e}"), F.col("voltage_kv"), F.col("frequency_hz"), config)))
        out = out.join(side, F.col(f"bus{e}") == F.col(f"bus_id{e}"), "left").drop(f"bus_id{e}")
        x, y = F.get("xs", at), F.get("ys", at)
        gap = F.sqrt((x - F.col(f"x{e}")) ** 2 + (y - F.col(f"y{e}")) ** 2)
        drawn = F.coalesce(gap > 0.01, F.lit(False))
        metres = M.haversine(F.get("lons", at), F.get("lats", at), F.col(f"lon{e}"), F.col(f"lat{e}"))
        out = out.withColumn(f"drawn{e}", drawn).withColumn(f"connector{e}_m", F.when(drawn, metres).otherwise(0.0))
    long = (F.col("connector0_m") > config.gates.long_connector) | (F.col("connector1_m") > config.gates.long_connector)
    out = out.withColumn("qa", T.add_flag(F.col("qa"), "long_connector", long))
    for axis, one in (("lons", "lon"), ("lats", "lat")):
        before = F.when(F.col("drawn0"), F.array(f"{one}0")).otherwise(F.array().cast("array<double>"))
        after = F.when(F.col("drawn1"), F.array(f"{one}1")).otherwise(F.array().cast("array<double>"))
        out = out.withColumn(axis, F.concat(before, F.col(axis), after))
    drop = [f"{c}{e}" for c in ("x", "y", "lon", "lat", "drawn") for e in (0, 1)]
    return materialise(out.drop(*drop), "connected")


def with_line_ids(spans: DataFrame) -> DataFrame:
    """``line_id``: the element id, numbered where an element has several spans."""
    own = W.partitionBy("osm_id")
    number = F.row_number().over(own.orderBy("order", "key")) - 1
    many = F.count(F.lit(1)).over(own) > 1
    return spans.withColumn("line_id", F.when(many, F.concat_ws(":", "osm_id", number)).otherwise(F.col("osm_id")))


def with_electrical(spans: DataFrame, config: Config) -> DataFrame:
    kv = F.col("voltage_kv")
    out = spans.withColumn("t", T.line_type(kv, config.gates.proxy_tol_kv))
    metres = F.col("length_conductor_m") + F.col("connector0_m") + F.col("connector1_m")
    out = out.withColumn("e", T.electrical(kv, F.col("n_circuits"), metres, F.col("t")))
    proxy = F.array(F.concat(F.lit("line_type_proxy_"), T.voltage_text(F.col("t.anchor")), F.lit("kV")))
    flags = F.when(F.col("t.proxy"), F.array_sort(F.array_union("qa", proxy))).otherwise(F.col("qa"))
    return out.withColumn("qa", flags).select("*", F.col("t.name").alias("line_type"), "e.i_nom_ka", "e.s_nom_mva", "e.r_ohm", "e.x_ohm").drop("t", "e")


def incident_capacity(spans: DataFrame, config: Config) -> DataFrame:
    """``bus_id, mva``: rating of the grid lines at each bus."""
    grid = spans.where(F.col("frequency_hz") == config.grid_frequency_hz)
    return grid.select(F.explode(F.array("bus0", "bus1")).alias("bus_id"), "s_nom_mva").where("bus_id is not null").groupBy("bus_id").agg(F.sum("s_nom_mva").alias("mva"))


def adjacent_voltages(buses: DataFrame) -> DataFrame:
    """Neighbouring voltages at each station and frequency: low side as in ``buses``, high side with suffix ``1``."""
    order = W.partitionBy("node_id", "frequency_hz").orderBy("voltage_kv")
    high = [F.lead(c).over(order).alias(f"{c}1") for c in ("bus_id", "voltage_kv", "x", "y")]
    return buses.where("node_type = 'substation'").select("*", *high).where("bus_id1 is not null")


def transformers(buses: DataFrame, spans: DataFrame, config: Config) -> DataFrame:
    """One per adjacent voltage pair of a station and frequency; never across frequencies."""
    mva = incident_capacity(spans, config)
    low, high = F.col("voltage_kv"), F.col("voltage_kv1")
    rows = adjacent_voltages(buses).withColumn("b", T.transformer_band(low, high))
    rows = rows.join(mva.withColumnsRenamed({"mva": "mva0"}), "bus_id", "left").join(mva.select(F.col("bus_id").alias("bus_id1"), F.col("mva").alias("mva1")), "bus_id1", "left")
    most = F.ceil(F.greatest(F.coalesce("mva0", F.lit(0.0)), F.coalesce("mva1", F.lit(0.0)))).cast("double")
    source = F.concat(
        F.lit("typing_rule_v23:"), F.col("b.band"),
        F.when(most <= 0, ";alt_snom_fallback_banded_no_incident_ac_lines").otherwise(""),
        F.when(high / low < T.RATIO_ARTEFACT, ";ratio_lt_1p095_probable_voltage_tagging_artifact").otherwise(""),
    )
    return rows.select(
        F.concat_ws("_", "node_id", T.voltage_text(low), T.voltage_text(high)).alias("transformer_id"), "station_id", "station_name", F.col("bus_id").alias("bus0"), F.col("bus_id1").alias("bus1"),
        F.bround(low * 1000, 0).cast("int").alias("voltage0_v"), F.bround(high * 1000, 0).cast("int").alias("voltage1_v"), F.lit("voltage_pair_at_site").alias("inferred"),
        F.bround(low, 0).cast("int").alias("voltage0_kv"), F.bround(high, 0).cast("int").alias("voltage1_kv"), "frequency_hz", F.lit("inherited_from_buses").alias("frequency_source"),
        "b.s_nom_mva", "b.x_pu", "b.r_pu", F.when(most > 0, most).otherwise(F.col("b.s_nom_mva")).alias("s_nom_pypsa_eur_mva"), source.alias("parameters_source"), "x", "y", "x1", "y1",
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """DC ratings ``osm_id, p_nom_mw, status, p_nom_source, qa_flags``; ``fid`` stands in for a missing ``osm_id``."""
    rows = spark.read.option("header", True).csv(path)
    names = {"osm_id": ("osm_id", "fid"), "p_nom_mw": ("p_nom_mw",), "status": ("status",), "p_nom_source": ("p_nom_source", "p_nom_source_shipped"), "qa_flags": ("qa_flags", "qa_flag_added")}
    columns = []
    for name, known in names.items():
        own = next((c for c in known if c in rows.columns), None)
        if name == "osm_id" and own is None:
            raise ValueError(f"{path}: neither osm_id nor fid")
        columns.append((F.col(own) if own else F.lit(None).cast("string")).alias(name))
    return rows.select(*columns).withColumn("p_nom_mw", F.col("p_nom_mw").try_cast("double"))


def dc_links(records: DataFrame, buses: DataFrame, config: Config, ratings: DataFrame | None = None) -> DataFrame:
    """DC paths (metric ``xs, ys``) with the nearest bus at each terminal and their ratings.

    The nearest bus within the limit counts; without one the terminal stays unattached and is flagged.
    """
    g = config.gates
    rows = records.withColumn("key", F.concat_ws("/", "key", F.format_string("%03d", "part")))
    tips = rows.select("key", F.posexplode(F.array(F.struct(F.get("xs", F.lit(0)).alias("x"), F.get("ys", F.lit(0)).alias("y")), F.struct(F.element_at("xs", -1).alias("x"), F.element_at("ys", -1).alias("y")))).alias("end", "p"))
    tips = tips.select(F.concat_ws("#", "key", "end").alias("tip"), "key", "end", "p.x", "p.y")
    near = tips.join(nearest_within(tips, "tip", buses, "bus_id", g.dc_max_converter), "tip", "left")
    both = near.groupBy("key").agg(*[F.max(F.when(F.col("end") == e, F.col(c))).alias(f"{n}{e}") for e in (0, 1) for c, n in (("bus_id", "bus"), ("d", "d"))])
    out = rows.join(both, "key")
    qa = T.add_flag(F.array().cast("array<string>"), "converter_unattached", F.col("bus0").isNull() | F.col("bus1").isNull())
    qa = T.add_flag(qa, "converter_far", (F.coalesce("d0", F.lit(0.0)) > g.dc_far) | (F.coalesce("d1", F.lit(0.0)) > g.dc_far))
    out = out.withColumn("qa", qa)
    if ratings is not None:
        out = out.join(ratings, "osm_id", "left")
        out = out.withColumn("qa", F.array_sort(F.array_union("qa", T.semicolon_parts(F.col("qa_flags"))))).drop("qa_flags")
    else:
        out = out.withColumn("p_nom_mw", F.lit(None).cast("double")).withColumn("status", F.lit(None).cast("string")).withColumn("p_nom_source", F.lit(None).cast("string"))
    return materialise(
        out.withColumn("status", F.coalesce("status", F.lit("unknown"))).withColumn("p_nom_source", F.coalesce("p_nom_source", F.lit("unknown"))).withColumn("frequency_hz", F.lit(0.0)).withColumn("frequency_source", F.lit("dc_link_layer")).drop("d0", "d1"),
        "dc",
    )


def ranked_components(nodes: DataFrame, edges: DataFrame, weights: DataFrame) -> DataFrame:
    """``bus_id, component``: rank of each bus's component by descending weight, then lowest bus.

    ``edges`` and ``weights`` have ``bus0, bus1``; ``weights`` also ``metres``, counted at the first known end.
    """
    groups = connected_components(edges.where("bus0 is not null and bus1 is not null"), "bus0", "bus1")
    label = nodes.select("bus_id").join(groups, F.col("bus_id") == F.col("node"), "left").select("bus_id", F.coalesce("component", "bus_id").alias("root"))
    label = materialise(label, "labels")
    heavy = weights.select(F.coalesce("bus0", "bus1").alias("bus_id"), "metres").join(label, "bus_id").groupBy("root").agg(F.sum("metres").alias("metres"))
    sums = label.groupBy("root").agg(F.min("bus_id").alias("least")).join(heavy, "root", "left")
    numbered = ranked(sums, "number", F.desc(F.coalesce("metres", F.lit(0))), "least")
    return materialise(label.join(numbered.select("root", F.col("number").cast("int").alias("component")), "root").select("bus_id", "component"), "components")


def with_component(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Component of an edge: of its first bus, else of the second, else -1."""
    one, two = (components.select(F.col("bus_id").alias(f"bus{e}"), F.col("component").alias(f"c{e}")) for e in (0, 1))
    out = rows.join(one, "bus0", "left").join(two, "bus1", "left")
    return out.withColumn("component", F.coalesce("c0", "c1", F.lit(-1))).drop("c0", "c1")


def with_degrees(buses: DataFrame, spans: DataFrame, others: DataFrame) -> DataFrame:
    """Adds ``degree`` (distinct neighbours over all edges), ``n_lines`` (incident AC ends) and sorted line ids."""
    columns = ["bus0", "bus1"]
    edges = spans.select(*columns, "line_id").unionByName(others.select(*columns, F.lit(None).cast("string").alias("line_id")))
    sides = edges.select(F.explode(F.array(F.struct(F.col("bus0").alias("bus_id"), F.col("bus1").alias("other"), "line_id"), F.struct(F.col("bus1").alias("bus_id"), F.col("bus0").alias("other"), "line_id"))).alias("s")).select("s.*").where("bus_id is not null")
    sums = sides.groupBy("bus_id").agg(
        F.count_distinct("other").cast("int").alias("degree"),
        F.count("line_id").cast("int").alias("n_lines"),
        F.array_join(F.array_sort(F.collect_set("line_id")), ";").alias("connected_line_ids"),
    )
    volts = buses.groupBy("node_id").agg(F.array_sort(F.collect_set("voltage_kv")).alias("kvs"))
    volts = volts.select("node_id", F.array_join(F.transform("kvs", T.voltage_text), ";").alias("station_voltages_kv"))
    out = buses.join(sums, "bus_id", "left").join(volts, "node_id")
    ids = F.when(F.col("connected_line_ids") != "", F.col("connected_line_ids"))
    return out.withColumn("degree", F.coalesce("degree", F.lit(0))).withColumn("n_lines", F.coalesce("n_lines", F.lit(0))).withColumn("connected_line_ids", ids)


def traced_labels(spans: DataFrame, buses: DataFrame) -> DataFrame:
    """``line_id, end, label``: the station that each span end leads to through buses of two ends, by pointer doubling.

    A state is a span left through one of its ends. Its successor passes a junction bus of exactly two ends to the other
    span. A station names the state; any other bus, and a ring, give "unknown".
    """
    sides = spans.select("line_id", F.posexplode(F.array("bus0", "bus1")).alias("end", "bus_id"))
    known = sides.join(buses.select("bus_id", "node_type", "station_name"), "bus_id", "left")
    pairs = known.where("node_type = 'junction'").groupBy("bus_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line_id", "end")).alias("p"), F.max(F.struct("line_id", "end")).alias("q")).where("n = 2")
    state = F.concat_ws("#", "line_id", "end")
    station = F.when(F.col("node_type") == "substation", F.coalesce("station_name", F.lit("unnamed substation")))
    start = known.select(state.alias("state"), "line_id", "end", station.alias("label"))

    def hop(a: str, b: str) -> DataFrame:
        return pairs.select(F.concat_ws("#", f"{a}.line_id", f"{a}.end").alias("state"), F.concat_ws("#", f"{b}.line_id", (1 - F.col(f"{b}.end")).cast("string")).alias("to"))

    current = materialise(start.join(hop("p", "q").unionByName(hop("q", "p")), "state", "left"), "trace")
    for _ in range(40):
        if not current.where("label is null and to is not null").limit(1).count():
            break
        ahead = current.select(F.col("state").alias("to"), F.col("label").alias("further"), F.col("to").alias("beyond"))
        joined = current.join(ahead, "to", "left")
        moved = joined.select("state", "line_id", "end", F.coalesce("label", "further").alias("label"), F.when(F.coalesce("label", "further").isNull(), F.col("beyond")).alias("to"))
        following = materialise(moved, "trace")
        same = following.where("label is null and to is not null").count() == current.where("label is null and to is not null").count()
        release(current)
        current = following
        if same:
            break
    return current.select("line_id", "end", F.coalesce("label", F.lit("unknown")).alias("label"))


def with_labels(spans: DataFrame, buses: DataFrame) -> DataFrame:
    """End points by their own bus, end stations as traced, and a label from name, reference or route."""
    at = buses.withColumn("point", F.when(F.col("node_type") == "substation", F.coalesce("station_name", F.lit("unnamed substation"))).otherwise("junction"))
    at = at.select("bus_id", "point", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))
    traced = traced_labels(spans, buses).groupBy("line_id").agg(*[F.max(F.when(F.col("end") == e, F.col("label"))).alias(f"route_{n}_substation") for e, n in ((0, "start"), (1, "end"))])
    out = spans.join(traced, "line_id", "left")
    for e, n in ((0, "start"), (1, "end")):
        side = at.select(F.col("bus_id").alias(f"bus{e}"), F.col("point").alias(f"{n}_point"), F.col("lat").alias(f"{n}_lat"), F.col("lon").alias(f"{n}_lon"))
        out = out.join(side, f"bus{e}", "left")
    route = (F.col("route_start_substation") != "unknown") & (F.col("route_end_substation") != "unknown")
    label = F.when(F.col("name").isNotNull(), F.col("name")).when(F.col("ref").isNotNull(), F.col("ref")).when(route, F.concat_ws(" - ", "route_start_substation", "route_end_substation"))
    source = F.when(F.col("name").isNotNull(), "osm_name_tag").when(F.col("ref").isNotNull(), "osm_ref_tag").when(route, "derived_from_route_endpoints").otherwise("none_available")
    return out.withColumn("line_label", label).withColumn("line_label_source", source)


def promoted_voltages(spans: DataFrame, config: Config) -> list[int]:
    """Voltages with a layer of their own: those configured, and whole ones with enough grid spans. A few dozen at most."""
    whole = F.round("voltage_kv", 0).cast("int")
    counted = spans.where((F.abs(F.col("voltage_kv") - whole) < 1e-6) & (F.col("frequency_hz") != config.traction.frequency_hz)).groupBy(whole.alias("kv")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.where(F.col("n") >= config.layer_min_spans).collect()
    return sorted({*config.layer_voltages_kv, *(r["kv"] for r in rows)})
