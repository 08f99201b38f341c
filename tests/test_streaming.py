import json

from gridweave.streaming import harvest


def test_files_are_taken_once(spark, tmp_path):
    raw, target, check = (str(tmp_path / n) for n in ("raw", "table", "check"))
    (tmp_path / "raw").mkdir()
    first = {"type": "way", "id": 1, "tags": {"power": "line"}, "geometry": [[0, 0], [1, 1]]}
    (tmp_path / "raw" / "a.ndjson").write_text(json.dumps(first) + "\n")
    for _ in range(2):
        harvest.keep_latest(harvest.element_stream(spark, raw), target, check).awaitTermination()
    longer = first | {"tags": {"power": "line", "voltage": "110000"}}
    (tmp_path / "raw" / "b.ndjson").write_text(json.dumps(longer) + "\n" + json.dumps(first | {"id": 2}) + "\n")
    harvest.keep_latest(harvest.element_stream(spark, raw), target, check).awaitTermination()
    rows = {r.oid: r.tags for r in harvest.current(spark, target).collect()}
    assert set(rows) == {"way/1", "way/2"} and rows["way/1"]["voltage"] == "110000"
    assert spark.read.parquet(target).count() == 3
