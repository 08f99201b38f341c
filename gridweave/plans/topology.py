"""From conductors and substation footprints to spans, sites, nodes and buses.

Paths are ``xs, ys`` in metres; ``key`` orders records. Every stage is a DataFrame of candidate pairs found by an equi-join,
an exact test in an Arrow batch, and, where the rule depends on order, a grouped kernel over an independent component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.functions import geometry as G
from gridweave.functions import measure as M
from gridweave.functions import tags as T
from gridweave.operators.graph import connected_components
from gridweave.operators.groups import by_group
from gridweave.operators.linkage import capped_linkage, greedy_match
from gridweave.operators.ranking import ranked
from gridweave.operators.spatial import box_cells, pairs_within, path_cells, point_cells
from gridweave.plans.storage import dealt, materialise

PATH = "xs array<double>, ys array<double>"
CELL = 500.0


class LengthLost(RuntimeError):
    """A rebuilt path is shorter or longer than the gates allow."""


def _path(xs, ys) -> np.ndarray:  # noqa: ANN001
    return np.column_stack([xs, ys])


def ends(rows: DataFrame, sample: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, end, x, y, ux, uy`` and ``keep``: both ends of every path with their inward unit vectors."""

    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(xs, ys, strict=True):
            path = _path(a, b)
            out.append([[*path[0], *G.outward(path, True, sample)], [*path[-1], *G.outward(path, False, sample)]])
        return pd.Series(out)

    both = rows.select("key", *keep, F.pandas_udf(run, "array<array<double>>")("xs", "ys").alias("e"))
    one = both.select("key", *keep, F.posexplode("e").alias("end", "v"))
    return one.select("key", "end", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(("x", "y", "ux", "uy"))], *keep)


def _dot(a: str, b: str) -> Column:
    return F.col(f"{a}.ux") * F.col(f"{b}.ux") + F.col(f"{a}.uy") * F.col(f"{b}.uy")


def chain_links(rows: DataFrame, config: Config) -> DataFrame:
    """``a, a_end, b, b_end``: ends of two different conductors of equal parameters that alone share a point, head-on."""
    params = F.struct("voltage_kv", "n_circuits", "frequency_hz", "construction_type", "under_construction")
    tips = ends(rows.withColumn("params", params), config.gates.outward_sample, ("params",))
    at = tips.groupBy(T.endpoint_key(F.col("x"), F.col("y")).alias("at"))
    item = F.struct("key", "end", "ux", "uy", "params")
    met = at.agg(F.count(F.lit(1)).alias("n"), F.min(item).alias("a"), F.max(item).alias("b")).where("n = 2")
    good = (F.col("a.key") != F.col("b.key")) & (F.col("a.params") == F.col("b.params")) & (_dot("a", "b") < config.gates.cos_continue_max)
    return met.where(good).select(F.col("a.key").alias("a"), F.col("a.end").alias("a_end"), F.col("b.key").alias("b"), F.col("b.end").alias("b_end"))


def _walk(keys: list[str], links: dict[tuple[str, int], tuple[str, int]]) -> list[list[tuple[str, bool]]]:
    """Maximal chains of (key, forward) in key order; a ring starts where it closes."""
    used: set[str] = set()
    out = []
    for key in keys:
        if key in used:
            continue
        at, end, seen = key, 0, {key}
        while (before := links.get((at, end))) and before[0] not in seen:
            at, end = before[0], 1 - before[1]
            seen.add(at)
        chain, leave = [], 1 - end
        while True:
            used.add(at)
            chain.append((at, leave == 1))
            following = links.get((at, leave))
            if not following or following[0] in used:
                break
            at, leave = following[0], 1 - following[1]
        out.append(chain)
    return out


def merge_chains(rows: DataFrame, config: Config) -> DataFrame:
    """Conductors fused along head-on links; attributes are those of the member of smallest key."""
    links = materialise(chain_links(rows, config), "links")
    groups = connected_components(links).select(F.col("node").alias("key"), "component")
    both = links.select(F.col("a").alias("key"), F.col("a_end").alias("end"), F.struct("b", "b_end").alias("to"))
    both = both.unionByName(links.select(F.col("b").alias("key"), F.col("b_end").alias("end"), F.struct(F.col("a").alias("b"), F.col("a_end").alias("b_end")).alias("to")))
    sides = both.groupBy("key").agg(F.max(F.when(F.col("end") == 0, F.col("to"))).alias("to0"), F.max(F.when(F.col("end") == 1, F.col("to"))).alias("to1"))
    members = rows.join(groups, "key").join(sides, "key")
    wide = members.select("component", "key", "contains", "qa", "xs", "ys", F.col("to0.b").alias("k0"), F.col("to0.b_end").alias("e0"), F.col("to1.b").alias("k1"), F.col("to1.b_end").alias("e1"))
    keep = config.gates.length_retention

    def fuse(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key").set_index("key")
        links = {}
        for row in part.itertuples():
            if isinstance(row.k0, str):
                links[row.Index, 0] = (row.k0, int(row.e0))
            if isinstance(row.k1, str):
                links[row.Index, 1] = (row.k1, int(row.e1))
        out = []
        for chain in _walk(list(part.index), links):
            pieces = [_path(part.at[k, "xs"], part.at[k, "ys"])[:: 1 if forward else -1] for k, forward in chain]
            path = np.concatenate([pieces[0], *(p[1:] for p in pieces[1:])])
            before, after = sum(map(G.length, pieces)), G.length(path)
            if before > 0 and not keep <= after / before <= 2 - keep:
                raise LengthLost(f"chain of {chain[0][0]}: {before:.1f} m became {after:.1f} m")
            own = [k for k, _ in chain]
            contains = sorted({c for k in own for c in part.at[k, "contains"]})
            qa = sorted({f for k in own for f in part.at[k, "qa"]})
            out.append((min(own), contains, qa, len(set(contains)), path[:, 0].tolist(), path[:, 1].tolist()))
        return pd.DataFrame(out, columns=["key", "contains", "qa", "n_ways_merged", "xs", "ys"])

    fused = wide.groupBy("component").applyInPandas(fuse, f"key string, contains array<string>, qa array<string>, n_ways_merged int, {PATH}")
    kept = rows.drop("contains", "qa", "n_ways_merged", "xs", "ys").join(fused, "key").select(*rows.columns)
    return materialise(rows.join(groups, "key", "left_anti").unionByName(kept), "chains")


def near_polygon(points: DataFrame, polygons: DataFrame, reach: float, key: list[str]) -> DataFrame:
    """``key..., pid, d``: polygons (``pid, px, py`` rings) within reach of points (``key..., x, y``), zero inside."""
    left = point_cells(points.select(*key, "x", "y"), CELL)
    right = box_cells(polygons.select("pid", "px", "py"), CELL, reach, F.array_min("px"), F.array_min("py"), F.array_max("px"), F.array_max("py"))

    def away(x: pd.Series, y: pd.Series, px: pd.Series, py: pd.Series) -> pd.Series:
        return pd.Series([G.point_ring_distance(_path(a, b), np.array([u, v])) for u, v, a, b in zip(x, y, px, py, strict=True)])

    met = left.join(dealt(right), ["cx", "cy"]).withColumn("d", F.pandas_udf(away, "double")("x", "y", "px", "py"))
    return met.where(F.col("d") <= reach).select(*key, "pid", "d")


def edited(rows: DataFrame, edits: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Move or append ends: ``edits`` are ``key, end, x, y, append, flag`` (flag may be null)."""
    item = F.struct("end", "x", "y", "append", "flag")
    grouped = edits.groupBy("key").agg(F.array_sort(F.collect_list(item)).alias("edits"))

    def run(xs: pd.Series, ys: pd.Series, edits: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, own in zip(xs, ys, edits, strict=True):
            path = _path(a, b)
            for e in own if own is not None else ():
                p = np.array([[e["x"], e["y"]]])
                if e["append"]:
                    path = np.concatenate([p, path]) if e["end"] == 0 else np.concatenate([path, p])
                else:
                    path = path.copy()
                    path[0 if e["end"] == 0 else -1] = p
            out.append((path[:, 0].tolist(), path[:, 1].tolist()))
        return pd.DataFrame(out, columns=["xs", "ys"])

    joined = rows.join(dealt(grouped), "key", "left")
    flags = F.filter(F.transform(F.coalesce("edits", F.array().cast("array<struct<end:int,x:double,y:double,append:boolean,flag:string>>")), lambda e: e["flag"]), lambda f: f.isNotNull())
    done = joined.withColumn("p", F.pandas_udf(run, PATH)("xs", "ys", "edits")).withColumn("qa", F.array_sort(F.array_union("qa", flags)))
    return done.withColumn("xs", F.col("p.xs")).withColumn("ys", F.col("p.ys")).select(*(columns or rows.columns))


def join_ends(rows: DataFrame, polygons: DataFrame, config: Config) -> DataFrame:
    """End-to-end pass: head-on ends of equal voltage and frequency across a gap, both away from stations.

    Closest first, each end once. Within ``ee_move_max`` both tips move to the midpoint; a wider gap is bridged by a vertex
    added to the first conductor, which is flagged.
    """
    g = config.gates
    tips = ends(rows, g.outward_sample, ("voltage_kv", "frequency_hz")).withColumn("tip", F.concat_ws("#", "key", "end"))
    near = near_polygon(tips, polygons, g.site_catchment, ["tip"]).select("tip").distinct()
    free = materialise(tips.join(near, "tip", "left_anti"), "tips")
    pairs = pairs_within(free, "tip", g.ee_tol_free, ("voltage_kv", "frequency_hz")).where("d > 0.01")
    one = free.select(F.col("tip").alias("a"), F.struct("key", "end", "x", "y", "ux", "uy").alias("p"))
    two = free.select(F.col("tip").alias("b"), F.struct("key", "end", "x", "y", "ux", "uy").alias("q"))
    full = pairs.join(one, "a").join(two, "b").where((F.col("p.key") != F.col("q.key")) & (_dot("p", "q") < g.cos_continue_max))
    full = materialise(full, "gaps")
    taken = greedy_match(full).select("a", "b").join(full, ["a", "b"])
    close = F.col("d") <= g.ee_move_max
    middle_x, middle_y = (F.col("p.x") + F.col("q.x")) / 2, (F.col("p.y") + F.col("q.y")) / 2
    none = F.lit(None).cast("string")
    edits = taken.select(
        F.explode(
            F.array(
                F.struct(F.col("p.key").alias("key"), F.col("p.end").alias("end"), F.when(close, middle_x).otherwise(F.col("q.x")).alias("x"), F.when(close, middle_y).otherwise(F.col("q.y")).alias("y"), (~close).alias("append"), F.when(close, none).otherwise(F.lit("end_bridged_synthetic_vertex")).alias("flag"), F.lit(True).alias("use")),
                F.struct(F.col("q.key").alias("key"), F.col("q.end").alias("end"), middle_x.alias("x"), middle_y.alias("y"), F.lit(False).alias("append"), none.alias("flag"), close.alias("use")),
            )
        ).alias("e")
    ).select("e.*").where("use")
    return materialise(edited(rows, edits), "joined")


def snap_split(rows: DataFrame, config: Config) -> DataFrame:
    """Ends within ``junction_tol`` of the inside of another conductor of equal voltage and frequency move onto it and cut it.

    The nearest foot counts, of equally near ones that of the smallest key; nearly parallel meetings are refused. All feet
    are found on the paths as they were before the pass.
    """
    g = config.gates
    tips = ends(rows, g.outward_sample, ("voltage_kv", "frequency_hz"))
    cells = path_cells(rows, CELL, g.junction_tol, ["key", "voltage_kv", "frequency_hz"]).withColumnRenamed("key", "target")
    met = point_cells(tips, CELL).join(cells, ["cx", "cy", "voltage_kv", "frequency_hz"]).where("key <> target")
    met = met.join(rows.select(F.col("key").alias("target"), F.col("xs").alias("tx"), F.col("ys").alias("ty")), "target")
    tol = g.junction_tol

    def foot(x: pd.Series, y: pd.Series, ux: pd.Series, uy: pd.Series, tx: pd.Series, ty: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, u, v, px, py in zip(x, y, ux, uy, tx, ty, strict=True):
            path = _path(px, py)
            s, d = G.foot(path, np.array([a, b]))
            total = G.length(path)
            if d > tol or not tol < s < total - tol:
                out.append((None,) * 5)
                continue
            at = G.point_at(path, s)
            t = G.point_at(path, min(total, s + tol)) - G.point_at(path, max(0.0, s - tol))
            n = np.hypot(*t)
            angle = float(np.degrees(np.arccos(np.clip(abs((t / n) @ np.array([-u, -v])), 0, 1)))) if n > 0 else 90.0
            out.append((s, d, at[0], at[1], angle))
        return pd.DataFrame(out, columns=["s", "d", "fx", "fy", "angle"]).astype(float)

    made = F.pandas_udf(foot, "s double, d double, fx double, fy double, angle double")
    met = met.withColumn("f", made("x", "y", "ux", "uy", "tx", "ty")).where("f.d is not null and not isnan(f.d)")
    best = met.groupBy("key", "end").agg(F.min(F.struct("f.d", "target", "f.s", "f.fx", "f.fy", "f.angle")).alias("b"))
    best = materialise(best.where(F.col("b.angle") >= g.parallel_reject_deg).select("key", "end", "b.*"), "feet")
    moves = best.select("key", "end", F.col("fx").alias("x"), F.col("fy").alias("y"), F.lit(False).alias("append"), F.lit(None).cast("string").alias("flag"))
    cuts = best.groupBy("target").agg(F.array_sort(F.collect_set("s")).alias("cuts")).withColumnRenamed("target", "key")
    moved = edited(rows, moves).join(cuts, "key", "left")

    def split(xs: pd.Series, ys: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for a, b, own in zip(xs, ys, cuts, strict=True):
            path = _path(a, b)
            places = [0.0, *sorted(own), G.length(path)] if own is not None else None
            parts = [path] if places is None else [G.piece(path, s, t) for s, t in zip(places[:-1], places[1:], strict=True) if t - s > 1e-9]
            out.append([[p[:, 0].tolist(), p[:, 1].tolist()] for p in parts])
        return pd.Series(out)

    parts = moved.withColumn("parts", F.pandas_udf(split, "array<array<array<double>>>")("xs", "ys", "cuts"))
    parts = parts.withColumn("of", F.size("parts")).select("*", F.posexplode("parts").alias("place", "part"))
    key = F.when(F.col("of") > 1, F.concat_ws("/", "key", F.format_string("%03d", "place"))).otherwise(F.col("key"))
    out = parts.withColumn("key", key).withColumn("xs", F.get("part", F.lit(0))).withColumn("ys", F.get("part", F.lit(1)))
    return materialise(out.select(*rows.columns), "split")


def polygon_rows(substations: DataFrame) -> DataFrame:
    """Substations with ``pid`` (ordered) and ring ``px, py`` in metres (columns ``xs, ys``)."""
    key = T.element_key(F.col("osm_id"))
    return substations.withColumn("pid", F.format_string("%s/%020d", key["kind"], key["number"])).withColumnsRenamed({"xs": "px", "ys": "py"})


def crossing_pairs(rows: DataFrame, polygons: DataFrame) -> DataFrame:
    """``key, pid``: conductors and the polygons that they touch."""
    paths = path_cells(rows, CELL, 0.0, ["key"])
    areas = box_cells(polygons.select("pid", "px", "py"), CELL, 0.0, F.array_min("px"), F.array_min("py"), F.array_max("px"), F.array_max("py"))

    def touches(xs: pd.Series, ys: pd.Series, px: pd.Series, py: pd.Series) -> pd.Series:
        out = []
        for a, b, c, d in zip(xs, ys, px, py, strict=True):
            path, ring = _path(a, b), _path(c, d)
            out.append(bool(G.inside(ring, path[:1])[0] or G.crossings(path, ring)))
        return pd.Series(out)

    met = paths.join(areas.select("pid", "cx", "cy"), ["cx", "cy"]).select("key", "pid").distinct()
    met = met.join(rows.select("key", "xs", "ys"), "key").join(polygons.select("pid", "px", "py"), "pid")
    return met.where(F.pandas_udf(touches, "boolean")("xs", "ys", "px", "py")).select("key", "pid")


def site_edges(polygons: DataFrame, rows: DataFrame, config: Config) -> DataFrame:
    """``a, b``: polygons near each other, or tied by a conductor that hardly leaves them and no conflict of names."""
    g = config.gates
    shape = polygons.select("pid", "px", "py")
    size = 1000.0

    def boxed(reach: float) -> DataFrame:
        return box_cells(shape, size, reach, F.array_min("px"), F.array_min("py"), F.array_max("px"), F.array_max("py"))

    def gap(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series) -> pd.Series:
        return pd.Series([G.ring_distance(_path(a, b), _path(c, d)) for a, b, c, d in zip(ax, ay, bx, by, strict=True)])

    gap_of = F.pandas_udf(gap, "double")
    near = boxed(g.site_merge).select(F.col("pid").alias("a"), "cx", "cy").join(boxed(0.0).select(F.col("pid").alias("b"), "cx", "cy"), ["cx", "cy"])
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    one, two = (shape.select(F.col("pid").alias(n), F.col("px").alias(f"{n}x"), F.col("py").alias(f"{n}y")) for n in "ab")
    close = near.join(one, "a").join(two, "b").where(gap_of("ax", "ay", "bx", "by") <= g.site_merge).select("a", "b")

    hits = materialise(crossing_pairs(rows, polygons), "hits")
    tied = hits.select("key", F.col("pid").alias("a")).join(hits.select("key", F.col("pid").alias("b")), "key").where("a < b")
    names = polygons.select("pid", "name")
    tied = tied.join(names.select(F.col("pid").alias("a"), F.col("name").alias("an")), "a").join(names.select(F.col("pid").alias("b"), F.col("name").alias("bn")), "b")
    tied = tied.where(~T.names_conflict(F.col("an"), F.col("bn"))).join(one, "a").join(two, "b").join(rows.select("key", "xs", "ys"), "key")

    def left_over(xs: pd.Series, ys: pd.Series, ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series) -> pd.Series:
        out = []
        for x, y, a, b, c, d in zip(xs, ys, ax, ay, bx, by, strict=True):
            path = _path(x, y)
            out.append(G.length(path) - sum(t - s for s, t in G.inside_intervals(path, [_path(a, b), _path(c, d)])))
        return pd.Series(out)

    tied = tied.where(F.pandas_udf(left_over, "double")("xs", "ys", "ax", "ay", "bx", "by") <= g.bridge_outside_max)
    return close.unionByName(tied.where(gap_of("ax", "ay", "bx", "by") <= g.bridge_gap_max).select("a", "b")).distinct()


def build_sites(polygons: DataFrame, rows: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(sites, polygons with ``station_id``). Stations are numbered in the order of their smallest element."""
    groups = connected_components(site_edges(polygons, rows, config))
    placed = polygons.join(groups, polygons["pid"] == groups["node"], "left").withColumn("site", F.coalesce("component", "pid")).drop("node", "component")

    # Shifted to its first corner, as products of large coordinates would lose digits.
    placed = placed.withColumn("sx", F.transform("px", lambda v: v - F.get("px", F.lit(0)))).withColumn("sy", F.transform("py", lambda v: v - F.get("py", F.lit(0))))
    placed = materialise(placed.withColumn("area", M.ring_area(F.col("sx"), F.col("sy"))).drop("sx", "sy"), "placed")
    named, owned = F.col("name").isNotNull(), F.col("operator").isNotNull()
    sites = placed.groupBy("site").agg(
        F.min_by("name", F.when(named, F.struct(-F.col("area"), F.col("pid")))).alias("station_name"),
        F.min_by("operator", F.when(owned, F.col("pid"))).alias("operator"),
        F.count(F.lit(1)).cast("int").alias("n_sub_polygons"),
        F.array_join(F.array_sort(F.collect_list("osm_id")), ";").alias("osm_substation_ids"),
        F.bool_and("under_construction").alias("under_construction"),
        F.max_by(F.struct("px", "py"), F.struct("area", "pid")).alias("largest"),
    )
    sites = ranked(sites, "number", "site").withColumn("station_id", F.format_string("st%07d", F.col("number") + 1))
    sites = materialise(sites.drop("number"), "sites")
    return sites, materialise(placed.join(sites.select("site", "station_id"), "site").drop("site"), "polygons")


def clip(rows: DataFrame, polygons: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(spans, internals): conductors cut at the perimeters of stations; parts inside carry ``station_id``.

    A part inside overlapping stations belongs to the one nearest its midpoint. Nothing is lost: lengths are compared.
    """
    hits = crossing_pairs(rows, polygons).join(polygons.select("pid", "station_id", "px", "py"), "pid")
    areas = hits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("station_id", "pid", "px", "py"))).alias("areas"))
    keep = config.gates.length_retention

    def cut(xs: pd.Series, ys: pd.Series, areas: pd.Series) -> pd.Series:
        out = []
        for a, b, own in zip(xs, ys, areas, strict=True):
            path = _path(a, b)
            if own is None:
                out.append([(None, 0.0, path[:, 0].tolist(), path[:, 1].tolist())])
                continue
            rings = [(r["station_id"], _path(r["px"], r["py"])) for r in own]
            total, along, found = G.length(path), G.stations(path), []
            covered = G.inside_intervals(path, [ring for _, ring in rings], along)
            alone = rings[0][0] if len({station for station, _ in rings}) == 1 else None
            for s, t in covered:
                middle = G.point_at(path, (s + t) / 2, along)
                station = alone or min(rings, key=lambda r: (G.point_ring_distance(r[1], middle), r[0]))[0]
                part = G.piece(path, s, t, along)
                found.append((station, s, part[:, 0].tolist(), part[:, 1].tolist()))
            for s, t in G.outside_intervals(total, covered):
                part = G.piece(path, s, t, along)
                found.append((None, s, part[:, 0].tolist(), part[:, 1].tolist()))
            got = sum(G.length(_path(x, y)) for _, _, x, y in found)
            if total > 0 and got < keep * total:
                raise LengthLost(f"clip kept {got:.1f} of {total:.1f} m")
            out.append(found)
        return pd.Series([[dict(zip(("station_id", "order", "xs", "ys"), f, strict=True)) for f in own] for own in out])

    part = "array<struct<station_id:string,order:double,xs:array<double>,ys:array<double>>>"
    joined = rows.join(areas, "key", "left").withColumn("parts", F.pandas_udf(cut, part)("xs", "ys", "areas"))
    parts = joined.select(*[c for c in rows.columns if c not in ("xs", "ys")], F.posexplode("parts").alias("place", "p"))
    parts = parts.withColumn("key", F.concat_ws("/", "key", F.format_string("p%03d", "place"))).select("*", "p.*").drop("p", "place")
    parts = materialise(parts, "parts")
    return parts.where("station_id is null").drop("station_id"), parts.where("station_id is not null")


def assign_ends(spans: DataFrame, internals: DataFrame, polygons: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(spans with ``site0, site1``, internals): which station an end belongs to; null for a free end.

    Within the fence tolerance an end is at the station, within the catchment it is a candidate. Candidates that meet at a
    point outside become free where one of their spans has its other end at a fence. A span with both ends at one station
    frees its far end, if far enough out, and is a jumper inside the station otherwise.
    """
    g = config.gates
    tips = ends(spans, g.outward_sample).withColumn("id", F.concat_ws("#", "key", "end"))
    near = near_polygon(tips, polygons, g.site_catchment, ["id"]).join(polygons.select("pid", "station_id"), "pid")
    best = near.groupBy("id").agg(F.min(F.struct("d", "station_id")).alias("b"))
    tips = tips.join(best, "id", "left").select("id", "key", "end", "x", "y", F.col("b.station_id").alias("site"), F.col("b.d").alias("d"))
    tips = materialise(tips.withColumn("fence", F.coalesce(F.col("d") <= g.site_fence, F.lit(False))), "tips")
    other = tips.select("key", (1 - F.col("end")).alias("end"), F.col("fence").alias("other_fence"))
    open_ends = tips.where("site is not null and not fence").join(other, ["key", "end"])
    clusters = capped_linkage(open_ends.select("id", "x", "y"), g.junction_tol, g.max_cluster)
    met = open_ends.join(clusters, "id").groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.bool_or("other_fence").alias("anchored"), F.collect_list("id").alias("ids"))
    freed = met.where("n > 1 and anchored").select(F.explode("ids").alias("id"), F.lit(True).alias("freed"))
    tips = tips.join(freed, "id", "left").withColumn("freed", F.coalesce("freed", F.lit(False)))
    tips = tips.withColumn("site", F.when(~F.col("freed"), F.col("site")))
    both = tips.groupBy("key").agg(*[F.max(F.when(F.col("end") == e, F.col(c))).alias(f"{c}{e}") for e in (0, 1) for c in ("site", "d", "freed")])
    wide = spans.join(both, "key")
    same = F.coalesce(F.col("site0") == F.col("site1"), F.lit(False))
    far = F.when(F.col("d0") >= F.col("d1"), 0).otherwise(1)
    reach = F.greatest("d0", "d1") >= g.free_end_min
    wide = wide.withColumn("jumper", same & ~reach).withColumn("far", F.when(same & reach, far).otherwise(-1))
    qa = T.add_flag(F.col("qa"), "end_freed_to_junction_outside_fence", F.col("freed0") | F.col("freed1"))
    qa = T.add_flag(qa, "approach_conductor_end_freed", F.col("far") >= 0)
    qa = T.add_flag(qa, "switchyard_jumper_self_loop", F.col("jumper"))
    wide = materialise(wide.withColumn("qa", qa), "assigned")
    jumpers = wide.where("jumper").withColumn("station_id", F.col("site0")).select(*internals.columns)
    kept = wide.where("not jumper").withColumn("site0", F.when(F.col("far") != 0, F.col("site0"))).withColumn("site1", F.when(F.col("far") != 1, F.col("site1")))
    return kept.drop("d0", "d1", "freed0", "freed1", "jumper", "far"), internals.unionByName(jumpers)


def cluster_junctions(spans: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """(spans with ``node0, node1``, junctions ``node_id, x, y``): free ends clustered, near ones moved onto the medoid."""
    g = config.gates
    tips = ends(spans, g.outward_sample).withColumn("id", F.concat_ws("#", "key", "end"))
    sites = spans.select("key", F.posexplode(F.array("site0", "site1")).alias("end", "site"))
    free = materialise(tips.join(sites.where("site is null"), ["key", "end"]).select("id", "key", "end", "x", "y"), "free")
    first = capped_linkage(free, g.junction_tol, g.max_cluster).withColumnRenamed("cluster", "seed")
    second = capped_linkage(free.join(dealt(first), "id"), g.junction_ext, g.ext_max_cluster, "seed")
    limit = g.cluster_pair_limit

    def middle(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
        points = np.column_stack([batch.column("x").to_numpy(), batch.column("y").to_numpy()])
        first = np.array(bounds[:-1])
        best = np.array([i + G.medoid(points[i:j], limit) for i, j in zip(bounds[:-1], bounds[1:], strict=True)])
        columns = [batch.column("cluster").take(pa.array(first)), *(pa.array(points[at, axis]) for at in (best, first) for axis in (0, 1))]
        return pa.record_batch(columns, ["cluster", "mx", "my", "fx", "fy"])

    members = free.join(dealt(second), "id")
    centres = by_group(members.select("cluster", "id", "x", "y"), "cluster", ["id"], middle, "cluster string, mx double, my double, fx double, fy double")
    centres = ranked(centres, "number", F.round("fx", 2), F.round("fy", 2), "cluster")
    centres = materialise(centres.withColumn("node_id", F.format_string("jn%07d", F.col("number") + 1)), "junctions")
    placed = members.join(centres, "cluster")
    near = F.sqrt((F.col("x") - F.col("mx")) ** 2 + (F.col("y") - F.col("my")) ** 2) <= g.junction_move_max
    placed = materialise(placed.select("key", "end", "node_id", "mx", "my", near.alias("near")), "ends")
    moves = placed.where("near").select("key", "end", F.col("mx").alias("x"), F.col("my").alias("y"), F.lit(False).alias("append"), F.lit(None).cast("string").alias("flag"))
    nodes = placed.groupBy("key").agg(*[F.max(F.when(F.col("end") == e, F.col("node_id"))).alias(f"jn{e}") for e in (0, 1)])
    out = edited(spans, moves).join(dealt(nodes), "key", "left")
    for e in (0, 1):
        out = out.withColumn(f"node{e}", F.coalesce(f"site{e}", f"jn{e}"))
    return materialise(out.drop("jn0", "jn1", "site0", "site1"), "noded"), centres.select("node_id", F.col("mx").alias("x"), F.col("my").alias("y"))


def build_buses(spans: DataFrame, internals: DataFrame, sites: DataFrame, junctions: DataFrame, polygons: DataFrame, config: Config) -> DataFrame:
    """A bus per node, voltage and frequency that a span ends at.

    At a station: the centroid of that voltage's internal segments if it lies inside, else the pole of inaccessibility of
    the largest footprint. Elsewhere: the junction's medoid. A traction bus names the grid bus it was severed from.
    """
    used = spans.select(F.explode(F.array("node0", "node1")).alias("node_id"), "voltage_kv", "frequency_hz").where("node_id is not null").distinct()
    used = used.withColumn("bus_id", T.bus_id(F.col("node_id"), F.col("voltage_kv"), F.col("frequency_hz"), config))
    bars = internals.groupBy(F.col("station_id").alias("node_id"), "voltage_kv").agg(F.array_sort(F.collect_list(F.struct("key", "xs", "ys"))).alias("bars"))
    areas = polygons.groupBy(F.col("station_id").alias("node_id")).agg(F.collect_list(F.struct("px", "py")).alias("areas"))
    at = used.join(sites.select(F.col("station_id").alias("node_id"), "station_name", "operator", "n_sub_polygons", "osm_substation_ids", "largest"), "node_id", "left")
    at = at.join(bars, ["node_id", "voltage_kv"], "left").join(areas, "node_id", "left").join(junctions, "node_id", "left")

    def place(largest: pd.DataFrame, areas: pd.Series, bars: pd.Series, x: pd.Series, y: pd.Series) -> pd.DataFrame:
        out = []
        for i in range(len(x)):
            if areas[i] is None:
                out.append((x[i], y[i], "junction_medoid"))
                continue
            source, point = "pole_of_inaccessibility", None
            if bars[i] is not None:
                centre = G.line_centroid([_path(b["xs"], b["ys"]) for b in bars[i]])
                if any(G.inside(_path(r["px"], r["py"]), centre[None, :])[0] for r in areas[i]):
                    source, point = "busbar_centroid", centre
            if point is None:
                point = G.pole(_path(largest["px"][i], largest["py"][i]))
            out.append((point[0], point[1], source))
        return pd.DataFrame(out, columns=["x", "y", "source"])

    done = at.withColumn("p", F.pandas_udf(place, "x double, y double, source string")("largest", "areas", "bars", "x", "y"))
    station = F.col("areas").isNotNull()
    buses = done.select(
        "bus_id", "node_id", F.col("node_id").alias("station_id"), F.when(station, "substation").otherwise("junction").alias("node_type"), "voltage_kv", "frequency_hz", "station_name", "operator",
        F.coalesce("n_sub_polygons", F.lit(0)).alias("n_sub_polygons"), "osm_substation_ids", "p.x", "p.y", F.col("p.source").alias("bus_point_source"),
    )
    grid = buses.where(F.col("frequency_hz") == config.grid_frequency_hz).select("node_id", "voltage_kv", F.col("bus_id").alias("grid_bus"))
    out = buses.join(grid, ["node_id", "voltage_kv"], "left")
    severed = F.when(F.col("frequency_hz") == config.traction.frequency_hz, F.col("grid_bus"))
    return materialise(out.withColumn("severed_from", severed).drop("grid_bus"), "buses")


def sweep_self_loops(spans: DataFrame, internals: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Spans that end at one node twice become internals, flagged by their length."""
    loop = F.coalesce(F.col("node0") == F.col("node1"), F.lit(False))
    rows = spans.withColumn("loop", loop)
    gone = rows.where("loop").withColumn("m", M.planar_length(F.col("xs"), F.col("ys")))
    long = F.col("m") >= config.gates.self_loop_keep_flag
    flag = F.array(F.when(long, "long_self_loop").otherwise("micro_self_loop"))
    gone = gone.withColumn("qa", F.array_sort(F.array_union("qa", flag)))
    gone = gone.withColumn("station_id", F.when(F.col("node0").startswith("st"), F.col("node0")))
    return rows.where("not loop").drop("loop"), internals.unionByName(gone.select(*internals.columns))


def dissolve_junctions(spans: DataFrame, config: Config) -> DataFrame:
    """Spans of one element, voltage and frequency fused through junctions that nothing else meets.

    At each such junction ends are paired most opposite first; an element whose length would change is left as it was.
    """
    keep = config.gates.length_retention
    sample, most = config.gates.outward_sample, config.gates.cos_continue_max
    tips = spans.select(F.explode(F.array("node0", "node1")).alias("node"), "osm_id", "voltage_kv", "frequency_hz").where("node is not null and node not like 'st%'")
    owner = F.struct("osm_id", "voltage_kv", "frequency_hz")
    free = tips.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min(owner).alias("low"), F.max(owner).alias("high")).where("n > 1 and low = high")
    touched = free.select("low.*").distinct()
    nodes = free.groupBy("low").agg(F.array_sort(F.collect_list("node")).alias("free")).select("low.*", "free")
    group = ["osm_id", "voltage_kv", "frequency_hz"]
    rows = spans.join(nodes, group).select(*group, "free", "key", "order", "qa", "node0", "node1", "xs", "ys")

    def fuse(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("key").set_index("key")
        free = set(part["free"].iloc[0])
        paths = {k: _path(x, y) for k, x, y in zip(part.index, part["xs"], part["ys"], strict=True)}
        at: dict[str, list[tuple[str, int]]] = {}
        for k in part.index:
            for e in (0, 1):
                if part.at[k, f"node{e}"] in free:
                    at.setdefault(part.at[k, f"node{e}"], []).append((k, e))
        links = {}
        for tips in at.values():
            while len(tips) > 1:
                k, e = tips.pop(0)
                u = G.outward(paths[k], e == 0, sample)
                dots = [(float(u @ G.outward(paths[j], f == 0, sample)), n) for n, (j, f) in enumerate(tips)]
                dot, n = min(dots)
                if dot < most:
                    other = tips.pop(n)
                    links[k, e], links[other] = other, (k, e)
        out, before, after = [], 0.0, 0.0
        for chain in _walk(list(part.index), links):
            pieces = [paths[k][:: 1 if forward else -1] for k, forward in chain]
            if any(np.hypot(*(p[-1] - q[0])) > 1 for p, q in zip(pieces[:-1], pieces[1:], strict=True)):
                return part.reset_index()[["key", "order", "qa", "node0", "node1", "xs", "ys"]]
            path = np.concatenate([pieces[0], *(p[1:] for p in pieces[1:])])
            before, after = before + sum(map(G.length, pieces)), after + G.length(path)
            own = [k for k, _ in chain]
            nodes = [part.at[k, f"node{(0 if e == forward else 1)}"] for (k, forward), e in ((chain[0], True), (chain[-1], False))]
            qa = sorted({f for k in own for f in part.at[k, "qa"]})
            out.append((min(own), part.loc[own, "order"].min(), qa, *nodes, path[:, 0].tolist(), path[:, 1].tolist()))
        if before > 0 and not keep <= after / before <= 2 - keep:
            return part.reset_index()[["key", "order", "qa", "node0", "node1", "xs", "ys"]]
        return pd.DataFrame(out, columns=["key", "order", "qa", "node0", "node1", "xs", "ys"])

    fused = rows.groupBy(*group).applyInPandas(fuse, f"key string, order double, qa array<string>, node0 string, node1 string, {PATH}")
    changed = spans.drop("order", "qa", "node0", "node1", "xs", "ys").join(fused, "key").select(*spans.columns)
    return materialise(spans.join(touched, group, "left_anti").unionByName(changed), "dissolved")


def merge_across_components(spans: DataFrame, buses: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Optional: junction buses of equal voltage and frequency near each other become one if nothing else connects them.

    The bus of smallest id stays; the ends of the others get connectors to it. Off by default.
    """
    g = config.gates
    named = spans
    for e in (0, 1):
        named = named.withColumn(f"bus{e}", F.when(F.col(f"node{e}").isNotNull(), T.bus_id(F.col(f"node{e}"), F.col("voltage_kv"), F.col("frequency_hz"), config)))
    parts = connected_components(named.where("bus0 is not null and bus1 is not null"), "bus0", "bus1")
    free = buses.where("node_type = 'junction'")
    label = free.select("bus_id", "x", "y", "voltage_kv", "frequency_hz").join(parts, F.col("bus_id") == F.col("node"), "left").withColumn("part", F.coalesce("component", "bus_id"))
    label = materialise(label.drop("node", "component"), "labels")
    pairs = pairs_within(label, "bus_id", g.cross_component_merge, ("voltage_kv", "frequency_hz"))
    one, two = (label.select(F.col("bus_id").alias(n), F.col("part").alias(f"p{n}")) for n in "ab")
    groups = connected_components(pairs.join(one, "a").join(two, "b").where("pa <> pb"))
    ids = buses.select("bus_id", "node_id", "voltage_kv", "frequency_hz")
    target = ids.select(F.col("bus_id").alias("component"), F.col("node_id").alias("new_node"))
    moved = materialise(groups.where("node <> component").join(ids, F.col("node") == F.col("bus_id")).join(target, "component").select("bus_id", "node_id", "voltage_kv", "frequency_hz", "new_node"), "moved")
    out = spans
    for e in (0, 1):
        side = moved.select(F.col("node_id").alias(f"node{e}"), "voltage_kv", "frequency_hz", "new_node")
        out = out.join(side, [f"node{e}", "voltage_kv", "frequency_hz"], "left")
        out = out.withColumn("qa", T.add_flag(F.col("qa"), "merged_across_components", F.col("new_node").isNotNull())).withColumn(f"node{e}", F.coalesce("new_node", f"node{e}")).drop("new_node")
    return materialise(out.select(*spans.columns), "merged"), buses.join(moved.select("bus_id"), "bus_id", "left_anti")
