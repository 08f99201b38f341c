"""Diagnostics of a finished network and the hard checks over them. Every diagnostic is one DataFrame."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions import geometry as G
from gridweave.functions import measure as M
from gridweave.operators.ranking import running_sums
from gridweave.operators.spatial import pairs_within
from gridweave.plans.build import Network
from gridweave.plans.storage import dealt, materialise
from gridweave.plans.topology import near_polygon


def fragments(lines: DataFrame, limit: int) -> DataFrame:
    """``osm_id, n, metres``: elements in more than ``limit`` pieces."""
    found = lines.groupBy("osm_id").agg(F.count(F.lit(1)).alias("n"), F.sum("length_conductor_m").alias("metres"))
    return found.where(F.col("n") > limit)


def close_bus_pairs(buses: DataFrame, reach: float) -> DataFrame:
    """``a, b, d``: buses of equal voltage and frequency within reach that no path connects (metric ``x, y``)."""
    return pairs_within(buses, "bus_id", reach, ("voltage_kv", "frequency_hz"), ("component",))


def nearest_ranks(rows: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Count, and the values at ranks n/2, 0.95 n and 0.99 n (from 0, rounded down), and the largest, per group.

    Ranks are exact. Equal values are counted first, and counts are added up over ranges of (keys, value), so neither a
    common value nor a group of a third of all rows ends up in one task.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    summed = running_sums(counted, "upto", "n", *keys, value)
    groups = summed.groupBy(*keys).agg(F.sum("n").alias("all"), F.min(F.col("upto") - F.col("n")).alias("before"))
    named = groups.withColumnsRenamed({k: f"{k}_" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    ranked = summed.join(named, same).withColumn("upto", F.col("upto") - F.col("before"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col(value)))

    share = {"median": F.floor(F.col("all") / 2), "p95": F.floor(F.col("all") * 0.95), "p99": F.floor(F.col("all") * 0.99)}
    return ranked.groupBy(*keys).agg(F.max("all").alias("n"), *[at(r).alias(n) for n, r in share.items()], F.max(value).alias("most"))


def component_stats(lines: DataFrame) -> DataFrame:
    """``component, km, km_ge220, share_pct`` by falling length."""
    km = F.sum("length_conductor_m") / 1000
    rows = lines.groupBy("component").agg(F.count(F.lit(1)).alias("n_spans"), km.alias("km"), (F.sum(F.when(F.col("voltage_kv") >= 220, F.col("length_conductor_m"))) / 1000).alias("km_ge220"))
    total = rows.agg(F.sum("km").alias("total_km"))
    return rows.crossJoin(F.broadcast(total)).select("component", "n_spans", "km", F.coalesce("km_ge220", F.lit(0.0)).alias("km_ge220"), (F.col("km") / F.col("total_km") * 100).alias("share_pct"))


def length_report(lines: DataFrame) -> DataFrame:
    """``n, over_limit, worst``: lengths of drawn paths (degrees) against conductor plus connectors, limit 0.1 %."""
    drawn = M.haversine_length(F.col("lons"), F.col("lats"))
    stated = F.col("length_conductor_m") + F.col("connector0_m") + F.col("connector1_m")
    rows = lines.select(drawn.alias("drawn"), stated.alias("stated")).where("drawn > 0").withColumn("off", F.abs(F.col("stated") - F.col("drawn")) / F.col("drawn"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("off") > 0.001).alias("over_limit"), F.round(F.max("off"), 6).alias("worst"))


def unresolved_ends(edges: DataFrame, buses: DataFrame) -> DataFrame:
    """``line_id, bus_id`` of ends that name no bus."""
    sides = edges.select("line_id", F.explode(F.array("bus0", "bus1")).alias("bus_id")).where("bus_id is not null")
    return sides.join(dealt(buses.select("bus_id")), "bus_id", "left_anti")


def voltage_table(lines: DataFrame, traction_hz: float) -> DataFrame:
    """``kv, n_spans, km, circuit_km`` by whole kV (cut off), without traction."""
    rows = lines.where(F.col("frequency_hz") != traction_hz).groupBy(F.col("voltage_kv").cast("int").alias("kv"))
    return rows.agg(F.count(F.lit(1)).alias("n_spans"), (F.sum("length_conductor_m") / 1000).alias("km"), (F.sum(F.col("length_conductor_m") * F.col("n_circuits")) / 1000).alias("circuit_km"))


def benchmark_table(lines: DataFrame, published: DataFrame) -> DataFrame:
    """``kv, published_km, our_km, delta_pct`` of every published voltage."""
    ours = lines.groupBy(F.col("voltage_kv").cast("int").alias("kv")).agg(F.round(F.sum("length_conductor_m") / 1000, 3).alias("our_km"))
    joined = published.join(ours, "kv", "left").withColumn("our_km", F.coalesce("our_km", F.lit(0.0)))
    return joined.select("kv", "published_km", "our_km", F.round((F.col("our_km") / F.col("published_km") - 1) * 100, 2).alias("delta_pct"))


def read_benchmark(spark, path: str) -> DataFrame:  # noqa: ANN001
    """``kv, published_km`` of a CSV with # comments."""
    rows = spark.read.option("header", True).option("comment", "#").csv(path)
    return rows.select(F.col("voltage_kv").cast("double").cast("int").alias("kv"), F.col("published_km").cast("double"))


def site_extents(footprints: DataFrame) -> DataFrame:
    """``station_id, n, metres``: box diagonal of stations of several footprints, on the sphere."""
    edges = [F.min(F.array_min("lons")).alias("w"), F.max(F.array_max("lons")).alias("e"), F.min(F.array_min("lats")).alias("s"), F.max(F.array_max("lats")).alias("n_")]
    rows = footprints.groupBy("station_id").agg(F.count(F.lit(1)).alias("n"), *edges).where("n > 1")
    return rows.select("station_id", "n", M.haversine(F.col("w"), F.col("s"), F.col("e"), F.col("n_")).alias("metres"))


def metric_buses(network: Network, config: Config) -> DataFrame:
    """Buses with ``x, y`` in the metric CRS."""
    crs = config.metric_crs

    def run(lon: pd.Series, lat: pd.Series) -> pd.DataFrame:
        out = G.projection(crs)[0](np.column_stack([lon, lat]))
        return pd.DataFrame({"x": out[:, 0], "y": out[:, 1]})

    return network.buses.withColumn("m", F.pandas_udf(run, "x double, y double")("lon", "lat")).select("*", "m.x", "m.y").drop("m")


def internal_end_distances(network: Network, config: Config) -> DataFrame:
    """``line_id, end, metres``: from each end of an internal segment to the nearest station footprint, zero inside.

    The own station's footprints bound the distance; only ends outside them are then held against all footprints within
    that bound, on a grid whose reach grows until it covers every bound.
    """
    crs = config.metric_crs

    def metric(lons: pd.Series, lats: pd.Series) -> pd.DataFrame:
        forward, _ = G.projection(crs)
        paths = [forward(np.column_stack([a, b])) for a, b in zip(lons, lats, strict=True)]
        return pd.DataFrame({"xs": [p[:, 0].tolist() for p in paths], "ys": [p[:, 1].tolist() for p in paths]})

    to_metric = F.pandas_udf(metric, "xs array<double>, ys array<double>")
    inner = network.internals.where("size(lons) > 1").withColumn("m", to_metric("lons", "lats"))
    first, last = (F.struct(F.element_at("m.xs", i).alias("x"), F.element_at("m.ys", i).alias("y")) for i in (1, -1))
    ends = materialise(inner.select("line_id", "station_id", F.posexplode(F.array(first, last)).alias("end", "p")).select("line_id", "station_id", "end", "p.x", "p.y"), "ends")
    rings = network.footprints.withColumn("m", to_metric("lons", "lats")).select("station_id", F.monotonically_increasing_id().alias("pid"), F.col("m.xs").alias("px"), F.col("m.ys").alias("py"))
    return nearest_footprints(ends, materialise(rings, "rings"))


def nearest_footprints(ends: DataFrame, rings: DataFrame, reach: float = 500.0) -> DataFrame:
    """``line_id, end, metres``: ends (``line_id, end, station_id, x, y``) to the nearest of rings ``pid, station_id, px, py``."""

    def away(x: pd.Series, y: pd.Series, px: pd.Series, py: pd.Series) -> pd.Series:
        return pd.Series([G.point_ring_distance(np.column_stack([a, b]), np.array([u, v])) for u, v, a, b in zip(x, y, px, py, strict=True)])

    own = ends.join(dealt(rings), "station_id").withColumn("m", F.pandas_udf(away, "double")("x", "y", "px", "py"))
    bound = ends.join(dealt(own.groupBy("line_id", "end").agg(F.min("m").alias("own"))), ["line_id", "end"], "left").select("line_id", "end", "x", "y", "own")
    bound = materialise(bound, "bounds")
    most = bound.agg(F.max("own")).first()[0]
    while most is not None and reach < most:
        reach *= 4
    outside = bound.where("own > 0 or own is null")
    near = near_polygon(outside, rings, reach, ["line_id", "end"]).groupBy("line_id", "end").agg(F.min("d").alias("near"))
    out = bound.join(dealt(near), ["line_id", "end"], "left").select("line_id", "end", F.least("own", "near").alias("metres"))
    return out.where("metres is not null")


def traction_km_by_country(lines: DataFrame, traction_hz: float, most: int = 8) -> DataFrame:
    """``countries, km`` of the traction lines, longest first."""
    rows = lines.where(F.col("frequency_hz") == traction_hz).groupBy("countries").agg((F.sum("length_conductor_m") / 1000).alias("km"))
    return rows.orderBy(F.desc("km"), "countries").limit(most)


def summary(network: Network) -> DataFrame:
    """``name, value`` of the network's totals."""
    lines = network.lines.agg(
        F.count(F.lit(1)).cast("double").alias("spans"), (F.sum("length_conductor_m") / 1000).alias("route_km"), (F.sum(F.col("length_conductor_m") * F.col("n_circuits")) / 1000).alias("circuit_km"),
        (F.sum(F.col("connector0_m") + F.col("connector1_m")) / 1000).alias("connector_km"),
    )
    buses = network.buses.agg(F.count(F.lit(1)).cast("double").alias("buses"), F.count_if(F.col("node_type") == "substation").cast("double").alias("station_buses"), F.count_distinct("component").cast("double").alias("components"))
    rest = [t.agg(F.count(F.lit(1)).cast("double").alias(n)) for n, t in (("transformers", network.transformers), ("dc_links", network.dc), ("internals", network.internals))]
    parts = [t.unpivot([], t.columns, "name", "value") for t in (lines, buses, *rest)]
    return reduce(DataFrame.unionByName, parts)


def hard_checks(network: Network, config: Config) -> DataFrame:
    """``name, value, limit, passed``: the conditions that a network must meet."""
    lines, trafos = network.lines, network.transformers

    def counted(name: str, rows: DataFrame, limit: float = 0.0) -> DataFrame:
        n = rows.agg(F.count(F.lit(1)).cast("double").alias("value"))
        return n.select(F.lit(name).alias("name"), "value", F.lit(float(limit)).alias("limit"), (F.col("value") <= limit).alias("passed"))

    def shared(name: str, rows: DataFrame, bad: Column, least: int, limit: float) -> DataFrame:
        """A share of bad rows, which counts from ``least`` rows on."""
        n = rows.agg(F.count(F.lit(1)).alias("n"), (F.count_if(bad) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("value"))
        return n.select(F.lit(name).alias("name"), "value", F.lit(limit).alias("limit"), ((F.col("n") < least) | (F.col("value") <= limit)).alias("passed"))

    ends = lines.select("line_id", "bus0", "bus1").unionByName(trafos.select(F.col("transformer_id").alias("line_id"), "bus0", "bus1"))
    unmeasured = length_report(lines).select(F.lit("length_mismatch").alias("name"), F.col("over_limit").cast("double").alias("value"), F.lit(0.0).alias("limit"), (F.col("over_limit") == 0).alias("passed"))
    pieces = fragments(lines, config.gates.fragment_flag).select("osm_id")
    inner = network.internals.groupBy("osm_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > config.gates.fragment_flag).select("osm_id")
    long = (F.col("connector0_m") > config.gates.long_connector) | (F.col("connector1_m") > config.gates.long_connector)
    pairs = close_bus_pairs(metric_buses(network, config), config.gates.junction_tol)
    inner_ends = nearest_ranks(internal_end_distances(network, config).withColumn("all_", F.lit(0)), "metres", ["all_"])
    far_ends = inner_ends.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.max("p95"), F.lit(0.0)).alias("value"))
    checks = [
        counted("close_bus_pairs", pairs),
        far_ends.select(F.lit("internal_ends_p95_m").alias("name"), "value", F.lit(50.0).alias("limit"), ((F.col("n") < 1000) | (F.col("value") <= 50)).alias("passed")),
        counted("fragmented_elements", pieces.unionByName(inner)),
        counted("unresolved_bus", unresolved_ends(ends, network.buses)),
        counted("self_loop", lines.where("bus0 = bus1")),
        counted("null_geometry", lines.where("lons is null or size(lons) < 2")),
        counted("transformer_parameter_missing", trafos.where("s_nom_mva is null or x_pu is null or r_pu is null")),
        counted("nonpositive_parameter", lines.where("r_ohm <= 0 or x_ohm <= 0 or s_nom_mva <= 0")),
        counted("mixed_frequency_transformer", _mixed(trafos, network.buses)),
        unmeasured,
        shared("wide_sites", site_extents(network.footprints), F.col("metres") > 1000, 100, 0.014),
        shared("long_connectors", lines, long, 5000, 0.00015),
    ]
    return reduce(DataFrame.unionByName, checks)


def _mixed(edges: DataFrame, buses: DataFrame) -> DataFrame:
    """Edges between buses of different frequencies."""
    one, two = (buses.select(F.col("bus_id").alias(f"bus{e}"), F.col("frequency_hz").alias(f"hz{e}")) for e in (0, 1))
    return edges.select("bus0", "bus1").join(dealt(one), "bus0").join(dealt(two), "bus1").where("hz0 <> hz1")
