import hashlib

from pyspark.sql import functions as F

from gridweave.llm import warc
from gridweave.plans.storage import fresh_path

INNER = "x" * 200 + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + "y" * 50
ROWS = [
    (1, "http://a\r\nEvil: 1", "é" * 80), (2, None, "é" * 80), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "u", INNER), (8, "u", INNER),
    (None, "u", "é" * 80), (9, "u", "WARC/1.1\r\n" * 30), (1, "again", "é" * 80), (10, "u", "a\r\n\r\n" * 40), (11, "ü", "z" * 300_000), (None, "u", "only unnamed " * 20),
]


def brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and i != first[b]
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS size")
        got = warc.op10_query(df)
        assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)
        pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
        assert sorted((tuple(r) for r in warc.op10_query(pages).collect()), key=str) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert warc.op10_query(df.limit(0)).count() == 0


def test_records_inside_payloads_are_rejected(spark):
    path = fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path)
    found = warc.candidates(spark, path)
    reached = warc.reachable(found).join(found.select("file", "at"), ["file", "at"], "left_semi")
    assert reached.count() == len(ROWS) and found.count() > len(ROWS)


def test_chains_by_joins_are_chains_in_a_task(spark, monkeypatch):
    path = fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(ROWS, "page_id long, url string, html string"), path)
    found = warc.candidates(spark, path)
    want = sorted((r.file, r.at) for r in warc.on_chain(found).collect())
    assert len(want) == len(ROWS)
    for most in (0, 3):
        monkeypatch.setattr(warc, "FILE_RECORDS", most)
        assert sorted((r.file, r.at) for r in warc.on_chain(found).collect()) == want


def test_chains():
    import random

    import numpy as np

    rng = random.Random(2)
    for _ in range(200):
        at = sorted(rng.sample(range(60), rng.randrange(1, 20)))
        to = [rng.choice([-1, rng.randrange(70), *at]) for _ in at]
        to = [t if t > a else -1 for a, t in zip(at, to)]
        want, here = set(), 0
        while here in at:
            want.add(here)
            here = to[at.index(here)]
        got = warc.chained(np.array(at), np.array(to))
        assert {a for a, g in zip(at, got) if g} == want


def test_a_changed_payload_fails(spark):
    import pytest

    path, other = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([(1, "u", "good payload")], "page_id long, url string, html string"), path)
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "good payload\r\n\r\n$", "evil payload").alias("value"))
    text.write.option("lineSep", warc.END).text(other)
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archives(spark, other).collect()
