"""Queries against their SQL where keys are large or values lie on a limit, as in tables of a gigabyte."""

import duckdb
import pytest

from gridweave.plans import all_queries as registry
from tests.test_queries import rows_of


def same(spark, folder, name, **tables):
    """Write ``tables`` (SQL that selects their rows) to ``folder`` and hold the query against its SQL there."""
    con = duckdb.connect()
    for table, sql in tables.items():
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet'")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    ours = registry.QUERIES[name](spark, str(folder))
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    cursor = con.execute(registry.ORACLE_SQL[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert len(want) > 0
    assert got == want


def test_voltage_bands_round_halves_to_even(spark, tmp_path):
    prices = "(120000.5), (200000.5), (9499.5), (109999.5), (99998.5), (120001.5)"
    same(spark, tmp_path, "voltage_bands", orders=f"SELECT row_number() OVER () * 2 AS o_orderkey, CAST(p AS DOUBLE) AS o_totalprice FROM (VALUES {prices}) t(p)")


def test_linkage_of_large_users_to_the_microsecond(spark, tmp_path):
    gaps = "SELECT u, t FROM (VALUES (1), (90007), (5000001)) a(u), (VALUES (0), (21600000000), (43200000001), (64800000000)) b(t)"
    events = f"SELECT row_number() OVER (ORDER BY u, t) AS event_id, TIMESTAMP '2024-01-01 00:00:00.000003' + to_microseconds(t) AS ts, CAST(u AS BIGINT) AS user_id, 'click' AS event_type, 1.0 AS value FROM ({gaps})"
    same(spark, tmp_path, "single_linkage_1d", events=events)


def test_connectors_of_far_scenes(spark, tmp_path):
    same(spark, tmp_path, "attach_connectors", customer="SELECT unnest([0, 1, 1501, 150000, 899998, 899999]) AS c_custkey")


WORLD = "SELECT unnest([0, 1, 199, 200, 201, 20_001, 59_999]) AS s_suppkey"


@pytest.mark.parametrize("name", ["built_lines", "built_station_clusters", "built_internals", "built_summary", "exported_layers"])
def test_built_world_of_many_suppliers(spark, tmp_path_factory, name):
    same(spark, tmp_path_factory.mktemp("world"), name, supplier=WORLD)


def test_overlapping_boxes_are_not_made_distinct(spark):
    plan = registry.QUERIES["polygon_bbox_overlap"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Aggregate" not in plan


def test_overlapping_boxes_of_far_keys(spark, tmp_path):
    # Keys 100003 or 99991 apart are level in x or in y, those of both on one point; of two equal keys neither is before the other.
    keys = ", ".join(str(k + x * 100003 + y * 99991 + both * 100003 * 99991) for k in (0, 9, 50000) for x in range(3) for y in range(3) for both in (0, 1))
    rows = f"(SELECT unnest([{keys}, 9, 9, -9, -100012, NULL]) AS k), (SELECT unnest([-999.99, 0, 4000, 9999.99, NULL]) AS v)"
    same(spark, tmp_path, "polygon_bbox_overlap", customer=f"SELECT CAST(k AS BIGINT) AS c_custkey, 1 AS c_nationkey, CAST(v AS DOUBLE) AS c_acctbal FROM {rows}")


def test_overlapping_boxes_meet_once(spark):
    from gridweave.operators.spatial import overlapping_boxes

    spans = [(low, low + long) for low in (-3, -1, 0, 2, 4) for long in (0, 1, 2, 7)]
    boxes = [(i, float(x0), float(y0), float(x1), float(y1)) for i, ((x0, x1), (y0, y1)) in enumerate((x, y) for x in spans for y in spans)]
    want = sorted((p[0], q[0]) for p in boxes for q in boxes if p[0] < q[0] and p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    found = overlapping_boxes(spark.createDataFrame(boxes, "id long, x0 double, y0 double, x1 double, y1 double"), "id", 2.0)
    assert sorted(map(tuple, found.collect())) == want


def test_overlapping_boxes_are_dealt_by_small_cells(spark):
    plan = registry.QUERIES["polygon_bbox_overlap"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [cell" in plan and "Broadcast" not in plan
    assert plan.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in plan


def test_footprints_are_not_broadcast(spark):
    plan = registry.QUERIES["internal_ends_to_footprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("name", ["capped_linkage_in_rows", "greedy_matching_in_rows"])
def test_linkage_of_large_tables_is_not_broadcast(spark, monkeypatch, name):
    from gridweave.plans import storage

    monkeypatch.setattr(storage, "BROADCAST_ROWS", 10)
    plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_stored_tables_are_dealt_by_their_rows(spark, monkeypatch):
    from gridweave.plans import storage

    monkeypatch.setattr(storage, "BROADCAST_ROWS", 10)
    for rows, join in ((10, "BroadcastHashJoin"), (11, "SortMergeJoin")):
        one, two = (storage.materialise(spark.range(rows)) for _ in "ab")
        plan = one.join(two.groupBy("id").count(), "id")._jdf.queryExecution().executedPlan().toString()
        assert join in plan


def test_distance_pairs_meet_in_half_of_the_cells(spark):
    from gridweave.operators.spatial import pairs_within

    spots = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in range(-6, 6, 3) for y in range(-6, 6, 3))], "id long, x double, y double")
    found = pairs_within(spots, "id", 3.0)
    assert found.count() == found.distinct().count() == 24
    exploded = found._jdf.queryExecution().optimizedPlan().toString()
    assert exploded.count("explode") == 1 and "sequence" not in exploded and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_unconnected_pairs_take_one_join(spark):
    from gridweave.plans.validate import close_bus_pairs

    rows = [(1, 0.0, 7), (2, 1.0, 7), (3, 2.0, 8), (4, 3.0, None)]
    buses = spark.createDataFrame(rows, "bus_id long, x double, component int").selectExpr("*", "0D AS y", "110D AS voltage_kv", "50D AS frequency_hz")
    found = close_bus_pairs(buses, 5.0)
    assert sorted((r.a, r.b) for r in found.collect()) == [(1, 3), (2, 3)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
