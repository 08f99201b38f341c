"""A Spark data source for paged or queried HTTP endpoints: one task, polite, with retries over mirrors."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def fetch(mirrors: list[str], body: bytes, tries: int = 6, pause: float = 8.0, longest: float = 300.0, opener: Callable | None = None, sleep: Callable = time.sleep) -> bytes:
    """The first good answer: mirrors in turn, waits that double up to ``longest`` with jitter; the last error if none.

    429 and 5xx answers, broken connections and truncated JSON are tried again; other answers are final.
    """
    opener = opener or (lambda url, data: urllib.request.urlopen(urllib.request.Request(url, data, {"Accept-Encoding": "gzip"}), timeout=1000))
    last: Exception | None = None
    for k in range(tries):
        if k:
            sleep(min(longest, pause * 2 ** (k - 1)) * (0.5 + random.random()))
        try:
            with opener(mirrors[k % len(mirrors)], body) as answer:
                data = answer.read()
            if data[:2] == b"\x1f\x8b":
                import gzip

                data = gzip.decompress(data)
            json.loads(data)
            return data
        except urllib.error.HTTPError as e:
            if e.code != 429 and e.code < 500:
                raise
            last = e
        except (OSError, ValueError, EOFError) as e:
            last = e
    raise RuntimeError(f"no answer after {tries} tries") from last


def wait_for_slot(mirror: str, opener: Callable | None = None, sleep: Callable = time.sleep, pause: float = 15.0, longest: float = 600.0) -> float:
    """Seconds waited until the mirror's status page names a free slot.

    A mirror without a status page is not waited for; after ``longest`` seconds the request is tried all the same.
    """
    opener = opener or (lambda url: urllib.request.urlopen(url, timeout=30))
    waited = 0.0
    while waited < longest:
        try:
            with opener(mirror.rsplit("/", 1)[0] + "/status") as answer:
                status = answer.read().decode("utf-8", "replace").lower()
        except (OSError, ValueError):
            return waited
        if "available now" in status or "slots available" in status or "slot available after" not in status:
            return waited
        sleep(pause)
        waited += pause
    return waited


def elements_of(data: bytes) -> Iterator[tuple]:
    """(type, id, tags, geometry, members) rows of an answer."""

    def path(points: list | None) -> list | None:
        return [[p["lon"], p["lat"]] for p in points if p] if points else None

    for e in json.loads(data).get("elements", []):
        members = [(m.get("type"), m.get("ref"), m.get("role"), path(m.get("geometry"))) for m in e.get("members", [])]
        yield e["type"], e["id"], e.get("tags") or {}, path(e.get("geometry")), members


class QueryReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        """One partition: requests are made one after another, whatever the cluster's size."""
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:  # noqa: ARG002
        mirrors = self.options["mirrors"].split(",")
        pause = float(self.options.get("pause", 8))
        for k, text in enumerate(json.loads(self.options["queries"])):
            if k:
                time.sleep(pause)
            wait_for_slot(mirrors[0])
            yield from elements_of(fetch(mirrors, urllib.parse.urlencode({"data": text}).encode()))


class QuerySource(DataSource):
    """``spark.read.format("map_query")`` with options ``mirrors`` (comma-separated), ``queries`` (JSON list), ``pause``."""

    @classmethod
    def name(cls) -> str:
        return "map_query"

    def schema(self) -> str:
        from gridweave.sources.elements import SCHEMA

        return SCHEMA

    def reader(self, schema) -> QueryReader:  # noqa: ANN001, ARG002
        return QueryReader(dict(self.options))


class FeatureReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:  # noqa: ARG002
        """Pages of features until one is not full."""
        url, size, start = self.options["url"], int(self.options.get("page", 1000)), 0
        while True:
            query = urllib.parse.urlencode({"where": "1=1", "outFields": "*", "f": "geojson", "resultOffset": start, "resultRecordCount": size})
            rows = json.loads(fetch([f"{url}?{query}"], b"")).get("features", [])
            for f in rows:
                yield json.dumps(f.get("properties") or {}), json.dumps(f.get("geometry"))
            if len(rows) < size:
                return
            start += size


class FeatureSource(DataSource):
    """``spark.read.format("feature_pages")`` with options ``url`` and ``page``: properties and geometry as JSON."""

    @classmethod
    def name(cls) -> str:
        return "feature_pages"

    def schema(self) -> str:
        return "properties string, geometry string"

    def reader(self, schema) -> FeatureReader:  # noqa: ANN001, ARG002
        return FeatureReader(dict(self.options))
