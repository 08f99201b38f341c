import json

from pyspark.sql import functions as F

from gridweave.config import Traction
from gridweave.functions import geometry as G
from gridweave.functions import sql
from gridweave.plans import patch
from gridweave.sources import gpkg, tables


def test_countries(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    other = [[5, 5], [6, 5], [6, 6], [5, 5]]
    features = [
        {"type": "Feature", "properties": {"ISO_A2": "AA"}, "geometry": {"type": "Polygon", "coordinates": [square, other]}},
        {"type": "Feature", "properties": {"ISO_A2": "BB"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [other]]}},
    ]
    path = tmp_path / "c.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = sorted((r.country, len(r.ring)) for r in tables.read_countries(spark, str(path), "ISO_A2").collect())
    assert got == [("AA", 5), ("BB", 4), ("BB", 5)]
    rows = spark.createDataFrame([("AA", [0.0, 2.0, 2.0, 0.0], [0.0, 0.0, 2.0, 0.0])], "ISO_A2 string, lons array<double>, lats array<double>")
    gpkg.write_layers(str(tmp_path / "c.gpkg"), {"countries": (rows, "Polygon")})
    assert [(r.country, len(r.ring)) for r in tables.read_countries(spark, str(tmp_path / "c.gpkg"), "ISO_A2").collect()] == [("AA", 4)]


def test_country_polygons_join(spark):
    from gridweave.config import Config
    from gridweave.plans.parse import with_countries

    config = Config(50, "EPSG:3035", areas=("x",), country_source="polygons", country_polygons="x")
    polygons = spark.createDataFrame([("AA", [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]), ("BB", [[2.0, 0.0], [4.0, 0.0], [4.0, 2.0], [2.0, 2.0], [2.0, 0.0]])], "country string, ring array<array<double>>")
    rows = spark.createDataFrame([("in", [0.5, 1.5], [1.0, 1.0]), ("over", [1.5, 2.5], [1.0, 1.0]), ("out", [9.0, 9.5], [1.0, 1.0])], "key string, lons array<double>, lats array<double>")
    got = {r.key: r.countries for r in with_countries(rows, config, polygons).collect()}
    assert got == {"in": "AA", "over": "AA;BB", "out": ""}


def test_scrape_sets_frequencies(spark, tmp_path):
    path = tmp_path / "s.txt"
    path.write_text("way|1|16,7|110000|x\nway|2|50;16.7|110000|\nway|3|0||\nway|4|16.7|220000|\nway|9|50|1|\nbroken|line\n")
    scrape = tables.read_scrape(spark, str(path))
    assert scrape.count() == 5
    rows = [("way/1", "way/1", "way/1", 110.0, "Rail", ""), ("way/2", "way/2", "way/2", 110.0, "Rail", ""), ("way/3", "way/3:0", "way/3", 110.0, "", ""), ("way/4", "way/4", "way/4", 220.0, "", "a"), ("way/5", "way/5", "way/5;way/9", 110.0, "rail", ""), ("way/6", "way/6", "way/6", 110.0, "Rail;RAIL net", "")]
    lines = spark.createDataFrame(rows, "osm_id string, line_id string, contains string, voltage_kv double, operator string, qa_flags string").withColumn("countries", F.lit("DE"))
    out = {r.osm_id: (r.frequency_hz, r.qa_flags) for r in patch.frequency_by_scrape(lines, scrape, Traction(True, operators=("rail",)), 50.0).collect()}
    assert out["way/1"] == (16.7, "") and out["way/2"] == (50.0, "shared_tower_mixed_frequency_kept_grid") and out["way/3"] == (0.0, "dc_tag_on_ac_layer")
    assert out["way/4"] == (50.0, "a;frequency_tag_conflict_ehv") and out["way/5"] == (50.0, "") and out["way/6"] == (16.7, "")


def test_manifest_and_cache(spark, tmp_path):
    path = str(tmp_path / "m")
    tables.append_manifest(spark.createDataFrame([("a", "ok", 3, 9)], "job string, status string, elements int, bytes int"), path)
    tables.append_manifest(spark.createDataFrame([("b", "failed", 0, 0)], "job string, status string, elements int, bytes int"), path)
    assert spark.read.parquet(path).count() == 2
    made = []

    def make():
        made.append(1)
        return spark.range(3)

    for _ in range(2):
        assert tables.cached(spark, str(tmp_path / "r"), make).count() == 3
    assert len(made) == 1
    rows = spark.createDataFrame([("FR;DE",), ("FRA",), ("",)], "countries string")
    assert tables.in_country(rows, "FR").count() == 1


def test_sql_functions(spark):
    sql.register(spark)
    line = G.to_gpkg(G.to_wkb("LineString", [[1.0, 2.0], [3.0, -1.0]]), 4326, (1.0, 3.0, -1.0, 2.0))
    spark.createDataFrame([(bytearray(line),), (None,)], "g binary").createOrReplaceTempView("shapes")
    rows = spark.sql("SELECT ST_MinX(g) a, ST_MaxX(g) b, ST_MinY(g) c, ST_MaxY(g) d, ST_GeometryType(g) k, ST_SRID(g) s, ST_IsEmpty(g) e, GPKG_IsAssignable('GEOMETRY', ST_GeometryType(g)) ok FROM shapes").collect()
    assert tuple(rows[0]) == (1.0, 3.0, -1.0, 2.0, "LINESTRING", 4326, False, True)
    assert rows[1].a is None and rows[1].k is None


def test_station_voltages_and_layer_counts(spark):
    buses = spark.createDataFrame([("s", "a", 400.0), ("s", "b", 66.5), ("t", "c", 110.0)], "station_id string, bus_id string, voltage_kv double")
    assert {r.bus_id: r.station_voltages_kv for r in patch.station_voltages(buses).collect()} == {"a": "66.5;400", "b": "66.5;400", "c": "110"}
    assert patch.layer_counts(spark.createDataFrame([("x",), ("x",)], "layer string")).first().n == 2
