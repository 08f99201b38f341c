"""Versioned rewrites of tables: compute, check, and only then publish. Nothing is changed in place."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.config import Traction
from gridweave.functions import measure as M
from gridweave.functions import tags as T

HISTORY = "version string, applied_at timestamp, notes string"


class InvariantBroken(RuntimeError):
    """A check failed: nothing was published."""


@dataclass
class Patch:
    """``run`` maps named tables to changed ones; ``checks`` map a name to a DataFrame that must be empty."""

    version: str
    notes: str
    run: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]
    checks: Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version, applied_at, notes`` of the patches applied below ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/patch_history")
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(HISTORY).parquet(f"{root}/patch_history") if exists else spark.createDataFrame([], HISTORY)


def apply(spark: SparkSession, root: str, patch: Patch, tables: list[str], base: str, dry_run: bool = False) -> str | None:
    """Apply ``patch`` to the tables of version ``base``; the path of the new version, or None if it was applied before.

    The new version is written beside the old one, checked as written, and entered in the history last; a version that is
    not in the history does not exist. A failed check raises and leaves the history as it was. A dry run stops there.
    """
    if history(spark, root).where(F.col("version") == patch.version).limit(1).count():
        return None
    target = f"{root}/{patch.version}"
    before = {t: spark.read.parquet(f"{root}/{base}/{t}") for t in tables}
    for name, table in (before | patch.run(before)).items():
        table.write.mode("overwrite").parquet(f"{target}/{name}")
    after = {t: spark.read.parquet(f"{target}/{t}") for t in before}
    broken = {n: c for n, rows in patch.checks(after).items() if (c := rows.count())}
    if broken:
        raise InvariantBroken(", ".join(f"{n}: {c}" for n, c in sorted(broken.items())))
    if not dry_run:
        row = spark.range(1).select(F.lit(patch.version).alias("version"), F.current_timestamp().alias("applied_at"), F.lit(patch.notes).alias("notes"))
        row.write.mode("append").parquet(f"{root}/patch_history")
    return target


def add_column(table: DataFrame, name: str, kind: str) -> DataFrame:
    return table if name in table.columns else table.withColumn(name, F.lit(None).cast(kind))


def append_common(table: DataFrame, more: DataFrame) -> DataFrame:
    """Rows of ``more`` added on the columns of ``table``; columns that it lacks are null."""
    return table.unionByName(more.select(*[c for c in table.columns if c in more.columns]), allowMissingColumns=True)


def rewritten(table: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``table`` with the rows of ``changed`` in place of those of equal key."""
    return table.join(changed.select(key), key, "left_anti").unionByName(changed.select(*table.columns))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, repeats counted; ``side`` says which."""
    left, right = a.exceptAll(b), b.exceptAll(a)
    return left.select(F.lit("only_left").alias("side"), "*").unionByName(right.select(F.lit("only_right").alias("side"), "*"))


def duplicate_groups(spans: DataFrame) -> DataFrame:
    """``osm_id, bus0, bus1, n, action`` of repeated spans: collapse where shape and circuits agree, else flag."""
    groups = spans.groupBy("osm_id", "bus0", "bus1").agg(F.count(F.lit(1)).alias("n"), F.max("n_circuits").alias("most"), F.min("n_circuits").alias("least"), F.count_distinct("shape").alias("shapes"))
    action = F.when((F.col("shapes") == 1) & (F.col("most") == F.col("least")), "collapse").otherwise("flag")
    return groups.where("n > 1").select("osm_id", "bus0", "bus1", "n", action.alias("action"))


def collapse_duplicates(spans: DataFrame) -> DataFrame:
    """``spans`` (with ``shape`` and ``qa_flags``) without repeated rows of one element between the same buses.

    Where shape and circuits agree the row of smallest ``line_id`` stays and says how many it stands for; where they do not,
    all stay and are flagged.
    """
    group = ["osm_id", "bus0", "bus1"]
    order = W.partitionBy(*group).orderBy("line_id")
    groups = duplicate_groups(spans).select(*[F.col(c).alias(f"{c}_") for c in group], "n", "action")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in group]
    rows = spans.withColumn("place", F.row_number().over(order)).join(groups, same, "left")
    flag = F.when(F.col("action") == "collapse", F.concat(F.lit("duplicate_circuit_rows_collapsed_"), F.col("n").cast("string"), F.lit("to1")))
    flag = flag.when(F.col("action") == "flag", "circuit_count_element_level_ambiguous")
    kept = rows.where((F.coalesce("action", F.lit("")) != "collapse") | (F.col("place") == 1))
    return kept.withColumn("qa_flags", flagged(F.col("qa_flags"), flag)).select(*spans.columns)


def flagged(flags: Column, flag: Column) -> Column:
    """Semicolon-separated flags with another one, unless it is null or there already."""
    every = F.array_union(T.semicolon_parts(flags), F.array(flag))
    return F.array_join(F.filter(every, lambda f: f.isNotNull()), ";")


def propagated(layer: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``layer`` with ``columns`` as ``source`` has them for equal ``key``; rows that it lacks stay, missing columns come.

    Of several rows of a key in ``source`` the greatest counts, so no row of the layer is doubled.
    """
    for c in columns:
        if c not in layer.columns:
            layer = layer.withColumn(c, F.lit(None).cast(source.schema[c].dataType))
    news = source.groupBy(F.col(key).alias("key_")).agg(F.max(F.struct(*columns)).alias("new_"))
    joined = layer.join(news, F.col(key) == F.col("key_"), "left")
    out = [F.when(F.col("new_").isNotNull(), F.col(f"new_.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in layer.columns]
    return joined.select(*out)


def typed_transformers(transformers: DataFrame) -> DataFrame:
    """Parameters of every transformer by its pair of voltages, each pair typed once, whichever side is the higher."""
    low, high = F.least("voltage0_kv", "voltage1_kv"), F.greatest("voltage0_kv", "voltage1_kv")
    pairs = transformers.select(low.alias("low_"), high.alias("high_")).distinct().withColumn("b", T.transformer_band(F.col("low_"), F.col("high_")))
    source = F.concat(F.lit("typing_rule_v23:"), F.col("b.band"), F.when(F.col("high_") < T.RATIO_ARTEFACT * F.col("low_"), ";ratio_lt_1p095_probable_voltage_tagging_artifact").otherwise(""))
    pairs = pairs.select("low_", "high_", "b.s_nom_mva", "b.x_pu", "b.r_pu", source.alias("parameters_source"))
    names = ("s_nom_mva", "x_pu", "r_pu", "parameters_source")
    plain = transformers.drop(*names)
    return plain.join(pairs, (low == F.col("low_")) & (high == F.col("high_")), "left").drop("low_", "high_")


def split_traction(layers: dict[str, DataFrame], traction_hz: float) -> dict[str, DataFrame]:
    """Line layers with their traction rows moved to a layer of the same columns, named by voltage and frequency."""
    out = {name: rows.where(F.coalesce(F.col("frequency_hz") != traction_hz, F.lit(True))) for name, rows in layers.items()}
    suffix = f"_{traction_hz:g}Hz".replace(".", "_")
    return out | {name + suffix: rows.where(F.col("frequency_hz") == traction_hz) for name, rows in layers.items()}


def sever_buses(buses: DataFrame, spans: DataFrame, grid_hz: float) -> tuple[DataFrame, DataFrame]:
    """(buses, spans): a bus that spans of a second frequency end at is cloned for them, and they move to the clone."""
    suffix = F.concat(F.lit("_"), F.regexp_replace(F.format_string("%s", F.col("hz")), "\\.", "_"), F.lit("Hz"))
    used = spans.select(F.explode(F.array("bus0", "bus1")).alias("bus_id"), F.col("frequency_hz").alias("hz")).where("bus_id is not null").where(F.col("hz") != grid_hz).distinct()
    own = buses.select("bus_id", F.col("frequency_hz").alias("bus_hz"))
    moved = used.join(own, "bus_id").where("hz <> bus_hz").select("bus_id", "hz", F.concat("bus_id", suffix).alias("new_id"))
    clones = buses.drop("severed_from", "frequency_hz").join(moved, "bus_id")
    clones = clones.withColumn("severed_from", F.col("bus_id")).withColumn("bus_id", F.col("new_id")).withColumn("frequency_hz", F.col("hz")).select(*buses.columns)
    out = spans
    for e in ("bus0", "bus1"):
        side = moved.select(F.col("bus_id").alias(e), F.col("hz").alias("frequency_hz"), "new_id")
        out = out.join(side, [e, "frequency_hz"], "left").withColumn(e, F.coalesce("new_id", e)).drop("new_id")
    return buses.unionByName(clones), out.select(*spans.columns)


def bridging_edges(edges: DataFrame, buses: DataFrame) -> DataFrame:
    """Edges between buses of different frequencies."""
    one, two = (buses.select(F.col("bus_id").alias(f"bus{e}"), F.col("frequency_hz").alias(f"hz{e}")) for e in (0, 1))
    return edges.join(one, "bus0").join(two, "bus1").where("hz0 <> hz1").select(*edges.columns)


def without_bridging(edges: DataFrame, buses: DataFrame) -> DataFrame:
    """Inferred edges that weld frequencies together are dropped."""
    return edges.join(bridging_edges(edges, buses).select("transformer_id"), "transformer_id", "left_anti")


def move_layer(lines: DataFrame, moves: DataFrame) -> DataFrame:
    """``moves``: ``osm_id, layer`` of lines that belong elsewhere."""
    return lines.join(moves.withColumnRenamed("layer", "layer_"), "osm_id", "left").withColumn("layer", F.coalesce("layer_", "layer")).select(*lines.columns)


def retag_buses(buses: DataFrame, spans: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``names``: ``bus_id, new_id``. A bus is renamed, or merged into the bus that has the new id."""
    out = spans
    for e in ("bus0", "bus1"):
        out = out.join(names.select(F.col("bus_id").alias(e), "new_id"), e, "left").withColumn(e, F.coalesce("new_id", e)).drop("new_id")
    known = buses.select(F.col("bus_id").alias("new_id"), F.lit(True).alias("known"))
    renamed = buses.join(names, "bus_id").join(known, "new_id", "left").where("known is null").withColumn("bus_id", F.col("new_id")).select(*buses.columns)
    return buses.join(names.select("bus_id"), "bus_id", "left_anti").unionByName(renamed.dropDuplicates(["bus_id"])), out.select(*spans.columns)


def drop_unused_buses(buses: DataFrame, *edges: DataFrame) -> DataFrame:
    used = edges[0].select("bus0", "bus1")
    for more in edges[1:]:
        used = used.unionByName(more.select("bus0", "bus1"))
    return buses.join(used.select(F.explode(F.array("bus0", "bus1")).alias("bus_id")).distinct(), "bus_id", "left_semi")


def to_dc(lines: DataFrame, dc: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines of ``ids`` (``osm_id``) become DC links on the common columns."""
    moved = lines.join(ids.select("osm_id"), "osm_id", "left_semi").withColumn("frequency_hz", F.lit(0.0)).withColumn("frequency_source", F.lit("dc_link_layer"))
    return lines.join(ids.select("osm_id"), "osm_id", "left_anti"), append_common(dc, moved)


def recompute_lengths(lines: DataFrame, tolerance: float = 0.10, least_m: float = 200.0) -> DataFrame:
    """Lengths that are off by more than the tolerance are measured again, with resistance and reactance in proportion.

    Stated lengths (with connectors) up to ``least_m`` stay as they are. Where the connectors leave less than a twentieth of
    the drawn path, or than five metres, nothing is changed and ``qa_flags`` names the conflict.
    """
    connectors = F.coalesce("connector0_m", F.lit(0.0)) + F.coalesce("connector1_m", F.lit(0.0))
    rows = lines.withColumn("drawn", M.haversine_length(F.col("lons"), F.col("lats"))).withColumn("stated", F.col("length_conductor_m") + connectors)
    rows = rows.withColumn("off", (F.col("stated") > least_m) & (F.abs(F.col("drawn") - F.col("stated")) > tolerance * F.col("stated")))
    rows = rows.withColumn("new", F.col("drawn") - connectors).withColumn("conflict", F.col("off") & (F.col("new") < F.greatest(F.col("drawn") * 0.05, F.lit(5.0))))
    change = F.col("off") & ~F.col("conflict") & (F.col("length_conductor_m") > 0)
    ratio = F.when(change, F.col("new") / F.col("length_conductor_m")).otherwise(1.0)
    rows = rows.withColumn("ratio", ratio).withColumn("r_ohm", F.col("r_ohm") * F.col("ratio")).withColumn("x_ohm", F.col("x_ohm") * F.col("ratio"))
    if "qa_flags" in lines.columns:
        flag = F.when(F.col("conflict"), "length_geometry_conflict_unresolved").when(change, "length_recomputed_from_geometry")
        rows = rows.withColumn("qa_flags", flagged(F.col("qa_flags"), flag))
    return rows.withColumn("length_conductor_m", F.when(change, F.round("new", 1)).otherwise(F.col("length_conductor_m"))).select(*lines.columns)


def frequency_by_scrape(lines: DataFrame, scrape: DataFrame, traction: Traction, grid_hz: float) -> DataFrame:
    """Frequencies of ``lines`` (``osm_id, line_id, contains, voltage_kv, countries, operator, qa_flags``) from scraped tags.

    A line is matched by its element, the element before its suffix and every element it contains. Order of evidence:
    traction tag (kept at grid frequency and flagged above the traction voltage), mixed tag, zero (flagged as DC), grid tag,
    any other tag, then the operator: every token a traction operator, within voltage and countries. Without evidence the
    line keeps the grid frequency.
    """
    keys = F.array_distinct(F.concat(F.array("osm_id", T.base_id(F.col("line_id"))), T.semicolon_parts(F.col("contains"))))
    tags = lines.select("line_id", F.explode(keys).alias("osm_id")).join(scrape, "osm_id")
    value = F.regexp_replace("frequency", ",", ".")
    parts = F.filter(T.semicolon_parts(value), lambda p: p != "")
    known = F.exists(parts, lambda p: p.startswith("16.6") | p.startswith("16.7"))
    only = F.forall(parts, lambda p: p.startswith("16.6") | p.startswith("16.7"))
    zero = F.forall(parts, lambda p: F.coalesce(T.parse_number(p) == 0, F.lit(False)))
    grid = F.forall(parts, lambda p: F.coalesce(T.parse_number(p) == grid_hz, F.lit(False)))
    seen = tags.where(F.size(parts) > 0).groupBy("line_id").agg(
        F.bool_or(only).alias("traction"), F.bool_or(known & ~only).alias("mixed"), F.bool_or(zero).alias("zero"), F.bool_or(grid).alias("grid"), F.lit(True).alias("tagged"),
    )
    rows = lines.join(seen, "line_id", "left")
    low = F.col("voltage_kv") <= traction.max_voltage_kv
    by_operator = T.traction_by_operator(F.col("voltage_kv"), F.when(F.col("tagged").isNull(), "no_frequency_tag").otherwise("tagged"), F.col("countries"), F.col("operator"), traction)
    cases = [
        (F.col("traction") & low, traction.frequency_hz, "osm_frequency_tag", None),
        (F.col("traction"), grid_hz, "osm_frequency_tag_traction_overridden_ehv_gate", "frequency_tag_conflict_ehv"),
        (F.col("mixed"), grid_hz, "osm_mixed_kept_grid", "shared_tower_mixed_frequency_kept_grid"),
        (F.col("zero"), 0.0, "osm_frequency_tag_0_dc", "dc_tag_on_ac_layer"),
        (F.col("grid"), grid_hz, f"osm_frequency_tag_{int(grid_hz)}", None),
        (F.col("tagged"), grid_hz, "nonstandard_frequency_tag_kept_grid", "nonstandard_frequency_tag_kept"),
        (by_operator, traction.frequency_hz, "operator_inferred", None),
    ]
    hz, source, flag = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, h, s, f in reversed(cases):
        good = F.coalesce(condition, F.lit(False))
        hz, source = F.when(good, F.lit(float(h))).otherwise(hz), F.when(good, F.lit(s)).otherwise(source)
        flag = F.when(good, F.lit(f).cast("string")).otherwise(flag)
    flags = F.array_distinct(F.concat(T.semicolon_parts(F.col("qa_flags")), F.when(flag.isNotNull(), F.array(flag)).otherwise(F.array().cast("array<string>"))))
    out = rows.withColumn("qa_flags", F.array_join(F.array_sort(flags), ";")).withColumn("frequency_hz", F.coalesce(hz, F.lit(grid_hz)))
    return out.withColumn("frequency_source", F.coalesce(source, F.lit("no_frequency_tag"))).drop("traction", "mixed", "zero", "grid", "tagged")


def station_voltages(buses: DataFrame) -> DataFrame:
    """Buses with ``station_voltages_kv`` written anew from the voltages at their station."""
    kvs = buses.groupBy("station_id").agg(F.array_sort(F.collect_set("voltage_kv")).alias("kvs"))
    kvs = kvs.select("station_id", F.array_join(F.transform("kvs", T.voltage_text), ";").alias("station_voltages_kv"))
    return buses.drop("station_voltages_kv").join(kvs, "station_id").select(*dict.fromkeys([*buses.columns, "station_voltages_kv"]))


def united(layers: dict[str, DataFrame]) -> DataFrame:
    """Layers of the same columns as one table; ``layer`` says which."""
    named = [rows.select(F.lit(name).alias("layer"), "*") for name, rows in layers.items()]
    return reduce(DataFrame.unionByName, named)


def layer_counts(lines: DataFrame) -> DataFrame:
    """``layer, n``."""
    return lines.groupBy("layer").agg(F.count(F.lit(1)).alias("n"))


def prune_scope(buses: DataFrame, lines: DataFrame, box: tuple[float, float, float, float], others: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame] | tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Without buses outside (south, west, north, east) and the lines that reach out of the box.

    Lines go by their drawn ends (``start_lon`` and so on) where they have them, else by their buses. ``others`` are further
    tables: those with ``bus0, bus1`` lose the rows at a bus that goes, those with ``bus_id`` that bus, those with paths
    (``lons, lats``) the rows that begin outside; they are then returned as a third value. A line that stays and names a bus
    that goes is an error: the query fails and names it.
    """
    south, west, north, east = box

    def inside(lon: Column, lat: Column) -> Column:
        return lat.between(south, north) & lon.between(west, east)

    gone = buses.where(~inside(F.col("lon"), F.col("lat"))).select("bus_id")

    def away(rows: DataFrame, *ends: str) -> DataFrame:
        for e in ends:
            rows = rows.join(gone.withColumnRenamed("bus_id", e), e, "left_anti")
        return rows

    drawn = all(c in lines.columns for c in ("start_lon", "start_lat", "end_lon", "end_lat"))
    if drawn:
        kept = lines.where(inside(F.col("start_lon"), F.col("start_lat")) & inside(F.col("end_lon"), F.col("end_lat")))
        lost = kept.join(gone.select(F.col("bus_id").alias("bus0"), F.lit(True).alias("lost0")), "bus0", "left").join(gone.select(F.col("bus_id").alias("bus1"), F.lit(True).alias("lost1")), "bus1", "left")
        broken = F.coalesce("lost0", F.lit(False)) | F.coalesce("lost1", F.lit(False))
        named = F.raise_error(F.concat(F.lit("a line inside the scope ends at a bus outside it: "), F.col("line_id")))
        kept = lost.withColumn("line_id", F.when(broken, named.cast("string")).otherwise(F.col("line_id")))
    else:
        kept = away(lines, "bus0", "bus1")
    found = away(buses, "bus_id"), kept.select(*lines.columns)
    if others is None:
        return found
    more = {}
    for name, rows in others.items():
        if "bus0" in rows.columns:
            more[name] = away(rows, "bus0", "bus1").select(*rows.columns)
        elif "bus_id" in rows.columns:
            more[name] = away(rows, "bus_id").select(*rows.columns)
        else:
            more[name] = rows.where(inside(F.get("lons", F.lit(0)), F.get("lats", F.lit(0))))
    return *found, more


def status_violations(dc: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """DC links whose status is unknown to the vocabulary, whose rating is out of range, or rated without a source."""
    bad = ~F.col("status").isin(*vocabulary) | (F.col("p_nom_mw") <= 0) | (F.col("p_nom_mw") > 20_000) | (F.col("p_nom_mw").isNotNull() & (F.coalesce("p_nom_source", F.lit("unknown")) == "unknown"))
    return dc.where(F.coalesce(bad, F.lit(False)))
