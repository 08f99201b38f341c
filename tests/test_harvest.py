"""Patterns as a POSIX matcher reads them, copies of elements, and a harvest that fails, resumes and mends itself."""

import io
import json
import random
import subprocess

import pytest

from gridweave.config import from_mapping
from gridweave.plans import harvest
from gridweave.sources import elements as E
from gridweave.sources import http
from gridweave.sources.tables import read_manifest


def extended_grep(pattern, lines):
    """Line numbers that ``grep -E`` matches."""
    done = subprocess.run(["grep", "-nE", pattern], input="\n".join(lines) + "\n", capture_output=True, text=True, check=False)
    return {int(line.split(":", 1)[0]) - 1 for line in done.stdout.splitlines()}


@pytest.mark.parametrize(("low", "high"), [(50_000, 100_000), (110_000, 220_000), (100_000, None), (1, 10), (7, 8), (999, 1001), (220_000, 220_001), (10, 1_000_000), (65_999, 66_101)])
def test_bands_in_posix_expressions(low, high):
    rng = random.Random(low)
    top = harvest.TOP_VOLTS + 1 if high is None else high
    values = {v for edge in (low, top) for v in range(max(edge - 12, 1), edge + 12)} | {rng.randrange(1, 10 ** rng.randrange(1, 8)) for _ in range(3000)}
    values = sorted(v for v in values if v <= harvest.TOP_VOLTS)
    lines = [f"{v}" if i % 3 else f"5; {v} ;x" for i, v in enumerate(values)]
    inside = lambda v: low <= v < top
    want = {i for i, v in enumerate(values) if inside(v) or (i % 3 == 0 and inside(5))}
    assert extended_grep(harvest.voltage_pattern(low, high), lines) == want
    assert "(?" not in harvest.voltage_pattern(low, high)


def test_equally_long_copies_take_the_first_file(spark, tmp_path):
    def line(number, name):
        return json.dumps({"type": "way", "id": number, "tags": {"power": "line", "name": name}, "geometry": [[0, 0], [1, 1]]})

    for file, names in (("b", ("late", "longer name")), ("a", ("soon", "short")), ("c", ("last", "longest of all names"))):
        (tmp_path / f"{file}.ndjson").write_text("\n".join([line(1, names[0]), "", line(2, names[1])]) + "\n")
    got = {r.oid: r.tags["name"] for r in E.latest(E.read_elements(spark, str(tmp_path))).collect()}
    assert got == {"way/1": "soon", "way/2": "longest of all names"}
    assert [r.file.rsplit("/", 1)[1] for r in E.listed_files(spark, str(tmp_path)).orderBy("number").collect()] == ["a.ndjson", "b.ndjson", "c.ndjson"]


def test_waiting_for_a_slot():
    answers = [b"Rate limit: 2\nSlot available after: soon, in 40 seconds.", b"Slot available after: now, in 3 seconds.", b"2 slots available now."]
    asked, slept = [], []

    def opener(url):
        asked.append(url)
        return io.BytesIO(answers[len(asked) - 1])

    assert http.wait_for_slot("https://a.example/api/interpreter", opener, slept.append) == 30.0
    assert asked == ["https://a.example/api/status"] * 3 and slept == [15.0, 15.0]

    def broken(url):
        raise OSError(url)

    assert http.wait_for_slot("https://a.example/api/interpreter", broken, slept.append) == 0.0
    assert http.wait_for_slot("https://b.example/x", lambda url: io.BytesIO(answers[0]), slept.append, longest=45.0) == 45.0


def test_a_harvest_fails_resumes_and_mends(spark, tmp_path):
    config = from_mapping({"voltage_floor_kv": 50, "metric_crs": "EPSG:3035", "areas": ["NO"]})
    folder, calls = str(tmp_path), []
    way = {"type": "way", "id": 7, "tags": {"power": "line"}, "geometry": [{"lon": 1.123456789, "lat": 2.0}, {"lon": 3.0, "lat": 4.0}]}
    point = {"type": "way", "id": 8, "tags": {}, "geometry": [{"lon": 1.0, "lat": 2.0}]}

    def fetch(text, broken=("substation",)):
        calls.append(text)
        if any(b in text for b in broken):
            raise RuntimeError("no answer")
        return json.dumps({"elements": [way, point]}).encode()

    assert harvest.run(spark, config, folder, fetch) == ["NO_substations"]
    status = {r.job: (r.status, r.elements) for r in read_manifest(spark, f"{folder}/manifest").collect()}
    assert status["NO_substations"] == ("failed", None) and status["NO_dc"] == ("ok", 1) and len(calls) == 4
    assert not (tmp_path / "elements" / "NO_substations").exists()
    rows = E.read_elements(spark, f"{folder}/elements/NO_dc").collect()
    assert [r.oid for r in rows] == ["way/7"] and rows[0].geometry[0] == [1.1234568, 2.0]
    # What is done is not fetched again; the failed job is, and so is one whose file is damaged.
    damaged = next((tmp_path / "elements" / "NO_dc").glob("*.ndjson"))
    damaged.write_text("{half a line\n")
    for crc in (tmp_path / "elements" / "NO_dc").glob(".*.crc"):
        crc.unlink()
    calls.clear()
    assert harvest.run(spark, config, folder, lambda text: fetch(text, ())) == [] and len(calls) == 2
    assert E.readable(spark, f"{folder}/elements/NO_dc")
    calls.clear()
    assert harvest.run(spark, config, folder, fetch) == [] and not calls


def test_an_answer_without_elements_is_an_error(spark):
    with pytest.raises(ValueError):
        E.from_answer(spark, b'{"remark": "timed out"}')
