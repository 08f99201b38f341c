"""Scalar functions over element tags, as Column expressions: no Python runs per row.

``tags`` is a ``map<string,string>`` column. Positional tags hold one value per voltage, separated by semicolons; ``count``
is the number of voltages kept and ``index`` the place of one in the raw voltage tag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridweave.config import Config, Traction

#: Member roles that are not conductors.
EXCLUDED_ROLES = (
    "substation", "station", "converter", "terminal", "portal", "pylon", "tower", "support", "label", "transformer", "switch",
    "compensator", "plant", "generator",
)
#: DC link states.
DC_STATUS = ("operational", "partially_operational", "under_construction", "planned", "decommissioned", "unknown")
#: Anchor kV, ohm/km, ohm/km, kA, conductor type.
LINE_TYPES = [
    (50, 0.306, 0.35, 0.35, "94-AL1/15-ST1A 20.0"),
    (63, 0.306, 0.35, 0.35, "94-AL1/15-ST1A 20.0"),
    (66, 0.306, 0.35, 0.35, "94-AL1/15-ST1A 20.0"),
    (90, 0.1571, 0.4, 0.535, "184-AL1/30-ST1A 110.0"),
    (110, 0.1571, 0.4, 0.535, "184-AL1/30-ST1A 110.0"),
    (132, 0.1188, 0.39, 0.645, "243-AL1/39-ST1A 110.0"),
    (150, 0.1188, 0.39, 0.645, "243-AL1/39-ST1A 110.0"),
    (220, 0.06, 0.301, 1.29, "Al/St 240/40 2-bundle 220.0"),
    (300, 0.04, 0.265, 1.935, "Al/St 240/40 3-bundle 300.0"),
    (330, 0.04, 0.265, 1.935, "Al/St 240/40 3-bundle 300.0"),
    (380, 0.03, 0.246, 2.58, "Al/St 240/40 4-bundle 380.0"),
    (400, 0.03, 0.246, 2.58, "Al/St 240/40 4-bundle 380.0"),
    (500, 0.03, 0.246, 2.58, "Al/St 240/40 4-bundle 380.0"),
    (750, 0.013, 0.276, 4.16, "Al/St 560/50 4-bundle 750.0"),
]
#: Band, MVA, x in pu, r in pu.
TRANSFORMER_BANDS = [
    ("R1", 2000.0, 0.100, 0.0025),
    ("R2", 500.0, 0.122, 0.0025),
    ("R3", 300.0, 0.120, 0.0026),
    ("R4", 300.0, 0.100, 0.0025),
    ("R5", 200.0, 0.160, 0.0040),
    ("R6", 120.0, 0.160, 0.0040),
]
RATIO_ARTEFACT = 1.095


def semicolon_parts(value: Column) -> Column:
    """Trimmed, non-empty parts; null gives an empty array."""
    parts = F.filter(F.transform(F.split(value, ";"), lambda p: F.trim(p)), lambda p: p != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def parse_number(value: Column) -> Column:
    """A plain number with an optional suffix kv, mv or v in any case; blanks and underscores ignored; else null."""
    text = F.regexp_replace(F.lower(value), "[ _]", "")
    scale = F.when(text.endswith("kv"), 1e3).when(text.endswith("mv"), 1e6).otherwise(1.0)
    number = F.regexp_replace(text, "(kv|mv|v)$", "").try_cast("double")
    return F.when(~F.isnan(number), number * scale)


def voltages(tags: Column, floor_kv: float) -> Column:
    """``array<struct<kv, index>>`` of the distinct voltages of at least the floor, in tag order with their raw place."""
    raw = F.transform(semicolon_parts(tags["voltage"]), lambda p, i: F.struct((parse_number(p) / 1000).alias("kv"), i.alias("index")))
    kept = F.filter(raw, lambda v: v["kv"] >= floor_kv - 1e-9)
    seen = F.transform(kept, lambda v: v["kv"])
    return F.filter(kept, lambda v, i: F.array_position(seen, v["kv"]) == i + 1)


def largest_voltage_kv(tags: Column) -> Column:
    """Largest tagged voltage in whole kV, halves to even; null without one."""
    values = F.filter(F.transform(semicolon_parts(tags["voltage"]), parse_number), lambda v: v.isNotNull())
    return F.bround(F.array_max(values) / 1000, 0).cast("int")


def positional(tags: Column, key: str, count: Column, index: Column) -> Column:
    """The value of a voltage: its own where the tag has one per voltage, the only one, or else the tag as it stands."""
    parts = semicolon_parts(tags[key])
    size = F.size(parts)
    return F.when((size == count) & (count > 1), F.get(parts, index)).when(size == 1, F.get(parts, F.lit(0))).otherwise(tags[key])


def circuits(tags: Column, count: Column, index: Column) -> Column:
    """``struct<n, source>``: circuits tagged, or a third of the cables or wires, or one."""
    tagged, cables, wires = (parse_number(positional(tags, k, count, index)) for k in ("circuits", "cables", "wires"))

    def found(n: Column, source: str) -> Column:
        return F.struct(n.cast("int").alias("n"), F.lit(source).alias("source"))

    return (
        F.when(tagged >= 1, found(F.floor(tagged), "tagged"))
        .when(cables >= 3, found(F.floor(cables / 3), "derived_from_cables_tag"))
        .when(wires >= 3, found(F.floor(wires / 3), "derived_from_wires_tag"))
        .otherwise(found(F.lit(1), "assumed_single_circuit"))
    )


def construction(tags: Column, member_kinds: Column | None = None) -> Column:
    """``struct<kind, source>`` by location, tunnel, power, then the kinds of member ways."""
    location, tunnel, power = (F.lower(F.trim(F.coalesce(tags[k], F.lit("")))) for k in ("location", "tunnel", "power"))

    def found(kind, source: str) -> Column:  # noqa: ANN001
        kind = F.lit(kind) if isinstance(kind, str) else kind
        return F.struct(kind.alias("kind"), F.lit(source).alias("source"))

    out = (
        F.when(location == "underground", found("underground_cable", "osm_location_tag"))
        .when(location.isin("underwater", "submarine"), found("submarine_cable", "osm_location_tag"))
        .when(location.isin("overhead", "surface"), found("overhead_line", "osm_location_tag"))
        .when(tunnel.isin("yes", "building_passage", "culvert"), found("underground_cable", "osm_tunnel_tag"))
        .when(power == "cable", found("underground_cable", "osm_power_cable"))
        .when(power.isin("line", "minor_line"), found("overhead_line", "osm_power_line"))
    )
    if member_kinds is not None:
        kinds = F.array_distinct(F.filter(member_kinds, lambda k: k != "unknown"))
        out = out.when(F.size(kinds) == 1, found(F.get(kinds, F.lit(0)), "derived_from_member_ways")).when(F.size(kinds) > 1, found("mixed", "derived_from_member_ways"))
    return out.otherwise(found("unknown", "not_tagged"))


def _g(value: float) -> str:
    return f"{value:g}"


def frequency(tags: Column, kv: Column, count: Column, index: Column, config: Config) -> Column:
    """``struct<hz, source, flags>``; a tag that cannot be trusted keeps the grid frequency and is flagged."""
    grid, traction = config.grid_frequency_hz, config.traction
    parts = semicolon_parts(positional(tags, "frequency", count, index))
    known = list(traction.frequency_tags)
    any_traction, all_traction = F.exists(parts, lambda p: p.isin(known)), F.forall(parts, lambda p: p.isin(known))
    value = parse_number(F.get(parts, F.lit(0)))
    kept = f"nonstandard_frequency_tag_kept_{_g(grid)}"

    def found(hz: float, source, *flags: str) -> Column:  # noqa: ANN001
        source = F.lit(source) if isinstance(source, str) else source
        return F.struct(F.lit(float(hz)).alias("hz"), source.alias("source"), F.array(*map(F.lit, flags)).cast("array<string>").alias("flags"))

    mixed = F.concat(F.lit("osm_mixed_"), F.array_join(parts, ";"), F.lit(f"_kept_{_g(grid)}"))
    out = F.when(F.size(parts) == 0, found(grid, "no_frequency_tag", "frequency_assumed_ac"))
    out = out.when((F.size(parts) > 1) & any_traction, found(grid, mixed, "shared_tower_mixed_frequency_kept_grid"))
    if traction.enabled:
        out = out.when(all_traction & (kv > traction.max_voltage_kv), found(grid, "osm_frequency_tag_traction_overridden_ehv_gate", "frequency_tag_conflict_ehv"))
        out = out.when(all_traction, found(traction.frequency_hz, "osm_frequency_tag"))
    else:
        out = out.when(all_traction, found(grid, "traction_disabled_in_config_kept_grid", kept))
    out = out.when(F.abs(value - grid) < 1e-6, found(grid, f"osm_frequency_tag_{int(grid)}"))
    out = out.when(value == 0, found(0.0, "osm_frequency_tag_0_dc"))
    return out.otherwise(found(grid, "nonstandard_frequency_tag_kept_grid", kept))


def is_dc(tags: Column) -> Column:
    """Every frequency part is zero, and there is one."""
    parts = semicolon_parts(tags["frequency"])
    return (F.size(parts) > 0) & F.forall(parts, lambda p: F.coalesce(parse_number(p) == 0, F.lit(False)))


def operator_is_traction(operator: Column, traction: Traction) -> Column:
    """Every operator token names a railway network."""
    tokens = F.transform(semicolon_parts(operator), lambda t: F.lower(t))
    names = [o.lower() for o in traction.operators]
    if not names:
        return F.lit(False)

    def known(token: Column) -> Column:
        tests = []
        for name in names:
            if traction.strict_operator_tokens and len(name) <= 4:
                tests.append((token == name) | token.startswith(f"{name} "))
            else:
                tests.append(token.contains(name))
        return reduce(Column.__or__, tests)

    return (F.size(tokens) > 0) & F.forall(tokens, known)


def traction_by_operator(kv: Column, source: Column, countries: Column, operator: Column, traction: Traction) -> Column:
    """Whether the operator decides for traction: only where no frequency is tagged, within voltage and countries."""
    if not traction.enabled:
        return F.lit(False)
    out = (source == "no_frequency_tag") & (kv <= traction.max_voltage_kv) & operator_is_traction(operator, traction)
    if traction.countries:
        own = semicolon_parts(countries)
        out &= (F.size(own) > 0) & (F.size(F.array_except(own, F.array(*map(F.lit, traction.countries)))) == 0)
    return F.coalesce(out, F.lit(False))


def under_construction(tags: Column) -> Column:
    keys = ("construction", "construction:power", "proposed", "proposed:power")
    planned = reduce(Column.__or__, [F.coalesce(tags[k], F.lit("")) != "" for k in keys])
    return (F.coalesce(tags["power"], F.lit("")) == "construction") | planned | (F.coalesce(tags["location:transition"], F.lit("")) == "construction")


def element_key(element_id: Column) -> Column:
    """Order of element ids: kind, then number."""
    parts = F.split(element_id, "/")
    return F.struct(F.get(parts, F.lit(0)).alias("kind"), F.get(parts, F.lit(1)).try_cast("long").alias("number"))


def base_id(line_id: Column) -> Column:
    return F.regexp_replace(line_id, "[:-]\\d+$", "")


def endpoint_key(x: Column, y: Column) -> Column:
    """Centimetre grid point, halves to even."""
    return F.struct(F.bround(x * 100, 0).cast("long").alias("x"), F.bround(y * 100, 0).cast("long").alias("y"))


def voltage_text(kv: Column) -> Column:
    """Whole kV as an integer, else up to six significant digits."""
    whole = F.abs(kv - F.round(kv, 0)) < 1e-6
    general = F.regexp_replace(F.regexp_replace(F.format_string("%.6g", kv.cast("double")), "0+$", ""), "\\.$", "")
    return F.when(whole, F.round(kv, 0).cast("long").cast("string")).otherwise(general)


def bus_id(node: Column, kv: Column, hz: Column, config: Config) -> Column:
    suffix = F.when(F.abs(hz - config.grid_frequency_hz) < 1e-6, F.lit("")).otherwise(F.concat(F.lit("_"), F.regexp_replace(voltage_text(hz), "\\.", "_"), F.lit("Hz")))
    return F.concat(node, F.lit("_"), voltage_text(kv), F.lit("kV"), suffix)


def layer_name(kv: Column, hz: Column, voltages_kv: list[int], config: Config) -> Column:
    """Traction lines have a layer of their own; listed voltages each have one; the rest share one."""
    whole = F.round(kv, 0).cast("int")
    listed = (F.abs(kv - whole) < 1e-6) & whole.isin(list(voltages_kv) or [-1])
    traction = F.abs(hz - config.traction.frequency_hz) < 1e-6
    name = "line_" + _g(config.traction.frequency_hz).replace(".", "_") + "Hz"
    return F.when(traction, name).when(listed, F.concat(F.lit("line_"), whole.cast("string"), F.lit("kV"))).otherwise("line_other_kV")


def names_conflict(a: Column, b: Column) -> Column:
    """Both named, and neither name contains the other."""
    x, y = (F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in (a, b))
    return (x != "") & (y != "") & ~x.contains(y) & ~y.contains(x)


def line_type(kv: Column, proxy_tol: float = 5.0) -> Column:
    """``struct<anchor, r_km, x_km, i_ka, name, proxy>`` of the nearest anchor voltage; of equally near ones the lower."""
    anchors = F.array(*[F.struct(F.lit(float(a)).alias("anchor"), F.lit(r).alias("r_km"), F.lit(x).alias("x_km"), F.lit(i).alias("i_ka"), F.lit(n).alias("name")) for a, r, x, i, n in LINE_TYPES])
    ranked = F.array_min(F.transform(anchors, lambda t: F.struct(F.abs(t["anchor"] - kv).alias("d"), t["anchor"].alias("anchor"), t["r_km"].alias("r_km"), t["x_km"].alias("x_km"), t["i_ka"].alias("i_ka"), t["name"].alias("name"))))
    return F.struct(*[ranked[c].alias(c) for c in ("anchor", "r_km", "x_km", "i_ka", "name")], (ranked["d"] > proxy_tol).alias("proxy"))


def electrical(kv: Column, circuits_: Column, length_m: Column, kind: Column) -> Column:
    """``struct<r_ohm, x_ohm, i_nom_ka, s_nom_mva>`` of a span with parallel circuits."""
    km = length_m / 1000
    return F.struct(
        (kind["r_km"] * km / circuits_).alias("r_ohm"),
        (kind["x_km"] * km / circuits_).alias("x_ohm"),
        kind["i_ka"].alias("i_nom_ka"),
        (F.sqrt(F.lit(3.0)) * kv * kind["i_ka"] * circuits_).alias("s_nom_mva"),
    )


def transformer_band(low_kv: Column, high_kv: Column) -> Column:
    """``struct<band, s_nom_mva, x_pu, r_pu>`` by the lower and the higher voltage."""
    made = [F.struct(F.lit(b).alias("band"), F.lit(s).alias("s_nom_mva"), F.lit(x).alias("x_pu"), F.lit(r).alias("r_pu")) for b, s, x, r in TRANSFORMER_BANDS]
    return (
        F.when(low_kv >= 200, made[0])
        .when((low_kv >= 100) & (high_kv >= 330), made[1])
        .when((low_kv >= 100) & (high_kv >= 200), made[2])
        .when(low_kv >= 100, made[3])
        .when(high_kv >= 200, made[4])
        .otherwise(made[5])
    )


def voltage_class(kv: Column) -> Column:
    return F.bround(kv, 0).cast("int")


def classes_match(a: Column, b: Column) -> Column:
    """Voltage classes within 10 kV or 8 % of the larger; an unknown class matches nothing."""
    return F.abs(a - b) <= F.greatest(F.lit(10.0), F.greatest(a, b) * 0.08)


def add_flag(flags: Column, flag: str, condition: Column) -> Column:
    """Sorted flag array with ``flag`` where the condition holds."""
    return F.when(F.coalesce(condition, F.lit(False)), F.array_sort(F.array_union(flags, F.array(F.lit(flag))))).otherwise(flags)


def verdict(licence: Column, has_geometry: Column, a: Column, o: Column) -> Column:
    """What to do with an authoritative source: ``a`` its share found in ours, ``o`` the share of ours found in it."""
    return (
        F.when(licence.isin("no", "unclear"), "blocked-licence")
        .when(~has_geometry, "metadata-only")
        .when((a >= 0.97) & (o >= 0.97), "keep-osm")
        .when((a >= 0.90) & (o < 0.95), "fuse")
        .otherwise("partial")
    )
