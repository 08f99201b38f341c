"""The build on the drawn cases: what each rule makes of its plot."""

import json
from dataclasses import fields

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.config import from_mapping
from gridweave.functions import geometry as G
from gridweave.functions import measure as M
from gridweave.plans import build as B
from gridweave.plans import export, validate
from gridweave.plans.storage import materialise
from gridweave.sources import gpkg
from tests import grid_fixture
from tests.grid_fixture import GATE


@pytest.fixture(scope="module")
def config():
    return from_mapping(grid_fixture.CONFIG)


@pytest.fixture(scope="module")
def sheet(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    made = grid_fixture.write(str(folder))
    made.folder = str(folder)
    return made


@pytest.fixture(scope="module")
def network(spark, config, sheet):
    """Stored, so that the many tests need not finish the build again."""
    made = B.build(spark, sheet.folder, config)
    return B.Network(**{f.name: materialise(t, f.name) if isinstance(t := getattr(made, f.name), DataFrame) else t for f in fields(made)})


@pytest.fixture(scope="module")
def lines(network):
    return network.lines.toPandas()


@pytest.fixture(scope="module")
def buses(network):
    return network.buses.toPandas().set_index("bus_id")


@pytest.fixture(scope="module")
def of(lines, sheet):
    """Rows of a named element."""
    return lambda name: lines[lines.osm_id == sheet.names[name]].sort_values("line_id")


def flagged(rows, flag):
    return {i for i, q in zip(rows.osm_id, rows.qa_flags) if flag in q.split(";")}


def ends(rows):
    return set(rows.bus0) | set(rows.bus1)


def test_columns_come_in_their_order(network):
    assert network.lines.columns == [*B.LINE, "layer", "lons", "lats"]
    assert [len(c) for c in (B.LINE, B.SITE, B.SITE_ALL, B.DC, B.TRANSFORMER)] == [37, 16, 18, 19, 18]
    assert network.transformers.columns == B.TRANSFORMER and network.clusters.columns == B.CLUSTER


def test_ways_in_a_row_become_one(of, sheet):
    row = of("row_a")
    assert row.n_ways_merged.tolist() == [3]
    assert set(row.contains.iloc[0].split(";")) == {sheet.names[n] for n in ("row_a", "row_b", "row_c")}
    assert of("row_b").empty and of("row_c").empty


def test_a_fold_back_stays_apart(of):
    assert of("fold_a").n_ways_merged.tolist() == of("fold_b").n_ways_merged.tolist() == [1]
    assert ends(of("fold_a")) & ends(of("fold_b"))


def test_a_spur_cuts_the_flank_it_reaches(of, buses):
    assert len(of("flank")) == 2 and len(of("aloof")) == 1
    shared = set.intersection(*(set(r) for r in of("flank")[["bus0", "bus1"]].to_numpy()))
    assert len(shared) == 1 and shared < ends(of("spur"))
    assert buses.loc[shared.pop(), "degree"] == 3
    assert not ends(of("aloof")) & ends(of("flank"))


def test_gaps(of, lines, sheet):
    assert ends(of("closed_a")) & ends(of("closed_b")) and ends(of("bridged_a")) & ends(of("bridged_b"))
    assert not ends(of("open_a")) & ends(of("open_b"))
    assert of("closed_a").length_conductor_m.iloc[0] == pytest.approx(2000 + GATE.ee_move_max * 0.35, rel=0.01)
    assert flagged(lines, "end_bridged_synthetic_vertex") == {sheet.names["bridged_a"]}


def test_kinds_of_construction(of):
    assert of("buried").construction_type.tolist() == ["underground_cable"] and of("overhead").construction_type.tolist() == ["overhead_line"]
    assert ends(of("buried")) & ends(of("overhead"))


def test_one_way_of_two_voltages(of, lines, sheet):
    own = of("corridor")
    assert sorted(own.voltage_kv) == [110, 380] and set(own.n_circuits) == {2} and set(own.circuits_source) == {"derived_from_cables_tag"}
    assert set(own.start_point) == {"Quarry"} and set(own.end_point) == {"Mill"}
    assert sheet.names["steel"] not in set(lines.osm_id)


def test_railway_power(of, lines, buses, sheet):
    rail = lines[lines.frequency_hz == 16.7]
    assert set(rail.osm_id) == {sheet.names["rail_tagged"], sheet.names["rail_owned"]}
    assert of("rail_owned").frequency_source.tolist() == ["operator_inferred"] and set(rail.layer) == {"line_16_7Hz"}
    severed = buses[buses.severed_from.notna()]
    assert len(severed) == 1 and severed.severed_from.iloc[0] in ends(of("beside_rail"))


def test_direct_current(network, sheet, lines):
    rows = network.dc.collect()
    assert [r.osm_id for r in rows] == [sheet.names["direct"]] and sheet.names["direct"] not in set(lines.osm_id)
    assert rows[0].p_nom_mw is None and rows[0].status == rows[0].p_nom_source == "unknown" and rows[0].frequency_hz == 0


def test_what_is_planned_stays_and_is_flagged(lines, sheet):
    assert flagged(lines, "under_construction") == {sheet.names["planned"]}


def test_relations(lines, sheet):
    there = set(lines.osm_id)
    assert sheet.names["joint"] in there and not {sheet.names["joint_a"], sheet.names["joint_b"]} & there
    assert sheet.names["torn"] not in there and {sheet.names["torn_a"], sheet.names["torn_b"]} <= there


def test_sites(network, sheet):
    found = {frozenset(r.osm_substation_ids.split(";")) for r in network.footprints.groupBy("station_id").agg(F.array_join(F.collect_list("osm_id"), ";").alias("osm_substation_ids")).collect()}
    twin = frozenset(sheet.names[n] for n in ("North yard", "Twin yard"))
    assert twin in found and frozenset([sheet.names["Lone yard"]]) in found and len(found) == 5


def test_ends_around_a_yard(lines, network, sheet):
    freed = flagged(lines, "end_freed_to_junction_outside_fence")
    assert freed == {sheet.names[n] for n in ("entry", "from_west", "from_south")}
    assert flagged(lines, "approach_conductor_end_freed") == {sheet.names["stub"]}
    inner = {r.osm_id for r in network.internals.collect()}
    assert sheet.names["bus_bar"] in inner and sheet.names["bus_bar"] not in set(lines.osm_id)


def test_a_side_loop_is_swept_and_its_line_made_whole(of, network, sheet):
    assert len(of("whole")) == 1
    loops = {r.osm_id for r in network.internals.where("qa_flags like '%micro_self_loop%'").collect()}
    assert sheet.names["loop"] in loops


def test_transformers(network):
    rows = network.transformers.collect()
    assert {(r.voltage0_kv, r.voltage1_kv) for r in rows} == {(110, 380)} and len(rows) == 2
    assert all((r.s_nom_mva, r.x_pu, r.r_pu) == (500.0, 0.122, 0.0025) and r.parameters_source.startswith("typing_rule_v23:R2") for r in rows)


def test_nothing_drawn_is_lost(network, sheet):
    got = network.lines.agg(F.sum("length_conductor_m")).first()[0] + network.internals.agg(F.sum(M.haversine_length(F.col("lons"), F.col("lats")))).first()[0]
    left_out = {sheet.names[n] for n in ("joint_a", "joint_b", "torn", "direct", "steel")}
    total = 0.0
    for e in sheet.elements:
        if e["tags"].get("power") == "substation" or f"{e['type']}/{e['id']}" in left_out:
            continue
        paths = [e["geometry"]] if e["type"] == "way" else [m["geometry"] for m in e["members"]]
        total += sum(G.haversine_length(np.array(p)) for p in paths) * len(e["tags"]["voltage"].split(";"))
    assert 0.999 <= got / total <= 1.01


def test_hard_checks_pass(network, config):
    assert all(r.passed for r in validate.hard_checks(network, config).collect())


def _first(network, column):
    return F.col(column) == network.lines.orderBy("line_id").first()[column]


#: One fault each, and the check that must find it.
FAULTS = {
    "unresolved_bus": lambda n: {"lines": n.lines.withColumn("bus0", F.when(_first(n, "line_id"), "nowhere").otherwise(F.col("bus0")))},
    "self_loop": lambda n: {"lines": n.lines.withColumn("bus1", F.when(_first(n, "line_id"), F.col("bus0")).otherwise(F.col("bus1")))},
    "nonpositive_parameter": lambda n: {"lines": n.lines.withColumn("x_ohm", F.when(_first(n, "line_id"), 0.0).otherwise(F.col("x_ohm")))},
    "length_mismatch": lambda n: {"lines": n.lines.withColumn("length_conductor_m", F.when(_first(n, "line_id"), F.col("length_conductor_m") * 2).otherwise(F.col("length_conductor_m")))},
    "null_geometry": lambda n: {"lines": n.lines.withColumn("lons", F.when(_first(n, "line_id"), F.lit(None)).otherwise(F.col("lons")))},
    "transformer_parameter_missing": lambda n: {"transformers": n.transformers.withColumn("x_pu", F.lit(None).cast("double"))},
    "fragmented_elements": lambda n: {"lines": n.lines.withColumn("osm_id", F.lit("way/1"))},
    "mixed_frequency_transformer": lambda n: {"buses": n.buses.withColumn("frequency_hz", F.when(F.col("voltage_kv") == 110, 16.7).otherwise(50.0))},
    "close_bus_pairs": lambda n: {"buses": n.buses.unionByName(n.buses.where("node_type = 'junction'").limit(1).withColumn("bus_id", F.lit("ghost")).withColumn("component", F.lit(-7)))},
    "wide_sites": lambda n: {"footprints": n.footprints.crossJoin(n.footprints.sparkSession.range(200).withColumnRenamed("id", "copy")).withColumn("station_id", F.concat("station_id", F.col("copy").cast("string"))).drop("copy").unionByName(n.footprints.crossJoin(n.footprints.sparkSession.range(200).withColumnRenamed("id", "copy")).withColumn("station_id", F.concat("station_id", F.col("copy").cast("string"))).withColumn("lats", F.transform("lats", lambda v: v + 0.1)).drop("copy"))},
    "long_connectors": lambda n: {"lines": n.lines.crossJoin(n.lines.sparkSession.range(300).withColumnRenamed("id", "copy")).drop("copy").withColumn("connector0_m", F.lit(5000.0))},
    "internal_ends_p95_m": lambda n: {"internals": n.internals.crossJoin(n.internals.sparkSession.range(400).withColumnRenamed("id", "copy")).withColumn("line_id", F.concat("line_id", F.col("copy").cast("string"))).drop("copy").withColumn("lats", F.transform("lats", lambda v: v + 0.05))},
}


@pytest.mark.parametrize("name", sorted(FAULTS))
def test_each_hard_check_finds_its_fault(network, config, name):
    from dataclasses import replace

    failed = {r.name for r in validate.hard_checks(replace(network, **FAULTS[name](network)), config).collect() if not r.passed}
    assert name in failed


def test_geopackage_round_trip(spark, network, config, tmp_path):
    topology, graph = str(tmp_path / "t.gpkg"), str(tmp_path / "g.gpkg")
    export.write_geopackages(network, config, topology, graph)
    assert {"line_380kV", "line_16_7Hz", "site", "transformer", "v23_typing_rule", "build_metadata"} <= set(gpkg.layers(topology))
    back = gpkg.read_layer(spark, graph, "ac_line_all")
    assert back.count() == network.lines.count()
    bounded = gpkg.with_bounds(back).agg(F.min("min_x"), F.max("max_y")).first()
    direct = network.lines.agg(F.min(F.array_min("lons")), F.max(F.array_max("lats"))).first()
    assert bounded[0] == pytest.approx(direct[0]) and bounded[1] == pytest.approx(direct[1])
    assert back.select(F.octet_length(gpkg.geometry_wkb(F.col("geom"))).alias("n")).where("n is null").count() == 0


def test_merge_across_components_is_optional(spark, tmp_path):
    apart = GATE.cross_component_merge * 0.6
    sheet = grid_fixture.Sheet()
    sheet.next_plot()
    sheet.line("one", 150, [(0, 0), (4000, 0)])
    sheet.line("two", 150, [(4000, apart), (4000, 3500)])
    sheet.line("other", 220, [(4100, 0), (7000, 0)])
    (tmp_path / "few.ndjson").write_text("\n".join(json.dumps(e) for e in sheet.elements))
    for merge, parts in ((False, 3), (True, 2)):
        found = B.build(spark, str(tmp_path), from_mapping(grid_fixture.CONFIG | {"merge_across_components": merge}))
        rows = {r.osm_id: r for r in found.lines.collect()}
        one, two = rows[sheet.names["one"]], rows[sheet.names["two"]]
        assert len({r.component for r in rows.values()}) == parts and len(rows) == 3
        assert bool({one.bus0, one.bus1} & {two.bus0, two.bus1}) == merge
