import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from gridweave.config import Config, from_mapping
from gridweave.functions import tags as T
from gridweave.plans import compare, harvest, patch
from gridweave.sources import http
from gridweave.sources.elements import latest, normalised, read_elements, usable


def test_config():
    with pytest.raises(ValueError):
        from_mapping({"voltage_floor_kv": 50, "bboxes": [[0, 0, 1, 1]]})
    with pytest.raises(ValueError):
        Config(50, "EPSG:3035")
    config = from_mapping({"voltage_floor_kv": 50, "metric_crs": "EPSG:3035", "areas": ["FR"], "traction": {"grid_frequency_hz": 60}})
    assert config.grid_frequency_hz == 60 and config.layer_min_spans == 50


def test_numbers(spark):
    cases = {"400 kV": 400e3, "1_000": 1000.0, "2MV": 2e6, "110v": 110.0, "nan": None, "x": None, "1e5": 1e5, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.n for r in df.select("v", T.parse_number(F.col("v")).alias("n")).collect()} == cases


def test_text_of_voltages(spark):
    df = spark.createDataFrame([(400.0,), (66.5,), (16.7,), (0.38,)], "v double")
    assert [r.t for r in df.select(T.voltage_text(F.col("v")).alias("t")).collect()] == ["400", "66.5", "16.7", "0.38"]


def test_elements(spark, tmp_path):
    rows = [
        {"type": "way", "id": 1, "tags": {"power": "line"}, "geometry": [[0.123456789, 1], [1, 1]]},
        {"type": "way", "id": 1, "tags": {"power": "line", "voltage": "110000"}, "geometry": [[0, 0], [1, 1]]},
        {"type": "way", "id": 2, "tags": {"power": "busbar"}, "geometry": [[0, 0], [1, 1]]},
        {"type": "way", "id": 3, "tags": {}, "geometry": [[0, 0]]},
    ]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.ndjson").write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    got = read_elements(spark, str(tmp_path))
    assert got.count() == 4
    kept = {r.oid: r for r in usable(latest(got)).collect()}
    assert set(kept) == {"way/1", "way/3"} and kept["way/1"].tags["voltage"] == "110000"
    assert normalised(got).count() == 3
    (tmp_path / "b.ndjson").write_text("{broken\n")
    with pytest.raises(Exception, match="not an element"):
        read_elements(spark, str(tmp_path)).select("oid").collect()


def test_harvest(spark):
    config = Config(50, "EPSG:3035", bboxes=((0, 0, 10, 7),), areas=("FR",), chunk_degrees=5.0)
    planned = harvest.jobs(spark, config)
    assert planned.count() == 5 * 4
    done = spark.createDataFrame([("FR_dc", "ok", 1, 2, "t"), ("FR_substations", "failed", 0, 0, "t")], "job string, status string, elements int, bytes int, finished string")
    assert harvest.pending(planned, done).count() == 19
    text = harvest.query_text(planned.where("job = 'FR_conductors_low'").first().asDict())
    assert "area.scope" in text and "out geom" in text
    df = spark.createDataFrame([("110000",), ("20000;400000",), ("x",), (None,), ("99999",)], "v string")
    assert [r.k for r in df.select(harvest.voltage_in(F.col("v"), 100000).alias("k")).collect()] == [True, True, False, False, False]


def test_fetch_retries():
    class Answer:
        def __init__(self, data):
            self.data = data

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

        def read(self):
            return self.data

    answers = [urllib.error.HTTPError("u", 429, "busy", {}, None), Answer(b"{cut"), Answer(b'{"elements": [{"type": "way", "id": 1, "geometry": [{"lon": 1, "lat": 2}]}]}')]
    asked, waits = [], []

    def opener(url, _):
        asked.append(url)
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    data = http.fetch(["a", "b"], b"", opener=opener, sleep=waits.append)
    assert asked == ["a", "b", "a"] and len(waits) == 2
    assert list(http.elements_of(data)) == [("way", 1, {}, [[1, 2]], [])]
    with pytest.raises(urllib.error.HTTPError):
        http.fetch(["a"], b"", opener=lambda *_: (_ for _ in ()).throw(urllib.error.HTTPError("u", 400, "bad", {}, None)), sleep=waits.append)


def test_patch(spark, tmp_path):
    root = str(tmp_path)
    spark.range(5).withColumn("v", F.col("id") * 2).write.parquet(f"{root}/v1/t")

    def run(tables):
        return {"t": patch.add_column(tables["t"], "n", "string").withColumn("v", F.col("v") + 1)}

    good = patch.Patch("v2", "add one", run, lambda t: {"negative": t["t"].where("v < 0")})
    bad = patch.Patch("v3", "breaks", run, lambda t: {"any": t["t"]})
    assert patch.apply(spark, root, good, ["t"], "v1", dry_run=True) and patch.history(spark, root).count() == 0
    assert patch.apply(spark, root, good, ["t"], "v1") == f"{root}/v2"
    assert patch.apply(spark, root, good, ["t"], "v1") is None
    with pytest.raises(patch.InvariantBroken, match="any: 5"):
        patch.apply(spark, root, bad, ["t"], "v2")
    assert [r.version for r in patch.history(spark, root).collect()] == ["v2"]
    assert spark.read.parquet(f"{root}/v1/t").agg(F.sum("v")).first()[0] == 20


def test_patch_operators(spark):
    lines = spark.createDataFrame([("w1", "a", "b", 50.0, "line_x"), ("w2", "b", "c", 16.7, "line_x")], "osm_id string, bus0 string, bus1 string, frequency_hz double, layer string")
    buses = spark.createDataFrame([("a", 50.0, None), ("b", 50.0, None), ("c", 16.7, None)], "bus_id string, frequency_hz double, severed_from string")
    new_buses, moved = patch.sever_buses(buses, lines, 50.0)
    assert {r.bus_id: r.severed_from for r in new_buses.collect()}["b_16_7Hz"] == "b"
    assert {r.osm_id: r.bus0 for r in moved.collect()} == {"w1": "a", "w2": "b_16_7Hz"}
    merged, spans = patch.retag_buses(buses, lines, spark.createDataFrame([("a", "b"), ("c", "z")], "bus_id string, new_id string"))
    assert sorted(r.bus_id for r in merged.collect()) == ["b", "z"] and {r.bus0 for r in spans.collect()} == {"b"}
    assert {r.layer for r in patch.move_layer(lines, spark.createDataFrame([("w1", "line_y")], "osm_id string, layer string")).collect()} == {"line_x", "line_y"}
    assert sorted(r.bus_id for r in patch.drop_unused_buses(buses, lines.where("osm_id = 'w1'")).collect()) == ["a", "b"]


def test_comparison(spark):
    schema = "key string, voltage_kv double, xs array<double>, ys array<double>"
    ours = spark.createDataFrame([("o1", 110.0, [0.0, 10000.0], [0.0, 0.0])], schema)
    auth = spark.createDataFrame([("a1", 110.0, [0.0, 5000.0], [100.0, 100.0]), ("a2", 400.0, [0.0, 5000.0], [50.0, 50.0]), ("a3", 110.0, [0.0, 5000.0], [9000.0, 9000.0])], schema)
    assert compare.coverage(auth, ours, 250.0).first()["share"] == pytest.approx(2 / 3)
    assert compare.coverage(auth, ours, 250.0, True).first()["share"] == pytest.approx(1 / 3)
    assert [r.key for r in compare.gap_fill(auth, ours).collect()] == ["a3"]
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 30.0, 0.0)], "id long, x double, y double")
    b = spark.createDataFrame([(9, 10.0, 0.0), (8, 200.0, 0.0)], "id long, x double, y double")
    assert [(r.a, r.b) for r in compare.station_match(a, b, 250.0).collect()] == [("1", "9")]
    report = compare.compare(ours, auth, b, a, "yes")
    assert report["verdict"] == "partial" and report["stations_250m"] == 1
