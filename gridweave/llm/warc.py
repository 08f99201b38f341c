"""WARC archives: written by Spark's text sink, read back by boundary-chain verification.

Writing. One record per page: an HTTP response whose payload is the UTF-8 html. Of records with equal payloads of at least
REVISIT_BYTES bytes the one of the smallest page_id is a ``response``, the others are ``revisit`` records that refer to it
and carry no payload. The digest groups are formed on narrow rows; only the groups with more than one page are joined back
to the payloads. Files are rotated at RECORDS_PER_FILE records.

Reading. Archives are read by Spark's splittable text source with the version line as separator, so a large archive is read
by many tasks. Each piece after a separator is a candidate record; its place is the sum of what lies before it in the file
(within the split, plus the splits before). A task states for each candidate the offset of its successor from its header.
Text that looks like a version line may stand in a payload, so a candidate proves nothing by itself: starting from offset
zero, the candidates on the chain of successors are found by pointer jumping (each round follows jumps of doubled length from
the offsets reached so far, so the rounds grow with the logarithm of the records in a file) and all others are rejected. The
candidates of a file, narrow rows without payloads, meet in one task; those of a file with more than FILE_RECORDS of them are
jumped over in rounds of joins instead.
A payload that held a version line was cut by the separator and is put together again from its pieces.

Defined results: null html is an empty payload; a null url has no target line, and line breaks in a url are removed; a null
page_id is kept as an unnamed record, is never referred to, and is a response unless a named page has its payload; rows
that repeat the smallest page_id are all responses; pages of any length are written whole; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.operators.groups import by_group
from gridweave.plans.storage import fresh_path, materialise, release

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT_BYTES = 100
RECORDS_PER_FILE = 2048
#: Candidates of a file that one task takes, some 250 bytes each.
FILE_RECORDS = 1_000_000
DATE = "2024-01-01T00:00:00Z"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def typed(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, size, refers_to``; refers_to is null for responses."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = materialise(groups.where("n > 1 and first_id is not null").select("digest", "first_id"), "digests")
    again = F.col("first_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    return rows.join(shared, "digest", "left").withColumn("refers_to", F.when(again, F.col("first_id"))).drop("first_id")


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("unnamed")), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record(rows: DataFrame) -> Column:
    """A record without its version line's predecessor and without the closing line breaks, which the sink writes."""
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(HTTP_HEAD), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    length = F.lit(len(HTTP_HEAD)) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    return F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]+", "")),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Bytes", F.col("size").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write the pages as WARC files below ``path``, a folder that does not exist yet."""
    rows = typed(pages)
    rows.select(record(rows).alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _field(name: str) -> Column:
    found = F.regexp_extract("header", rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(found != "", found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, number, value``: what stands between separators; numbers ascend within a split."""
    read = spark.read.option("lineSep", VERSION).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("number"), "value")


def _placed(pieces: DataFrame) -> DataFrame:
    """Rows with ``size`` and with ``place``, the offset of their piece in the file."""
    within = W.partitionBy("file", "split").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    rows = pieces.withColumn("before", F.coalesce(F.sum(F.col("size") + len(VERSION)).over(within), F.lit(0)))
    splits = pieces.groupBy("file", "split").agg(F.sum(F.col("size") + len(VERSION)).alias("all"))
    ahead = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("all").over(ahead), F.lit(0)).alias("base"))
    return rows.join(splits, ["file", "split"]).withColumn("place", F.col("base") + F.col("before")).drop("base", "before", "number")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate record, stored: its offset ``at``, successor ``to``, header fields and the digest of its piece."""
    rows = _pieces(spark, path).withColumn("size", F.octet_length("value").cast("long"))
    rows = rows.withColumn("header", F.substring_index("value", END, 1)).withColumn("head", F.octet_length("header") + len(END))
    rows = rows.withColumn("length", _field("Content-Length").try_cast("long"))
    body = F.expr("substring(cast(value as binary), cast(head + 1 as int), cast(length as int))")
    payload = _after_http_head(body)
    rows = rows.withColumn("whole", F.coalesce(F.col("size") >= F.col("head") + F.col("length"), F.lit(False)))
    narrow = rows.select(
        "file",
        "split",
        "number",
        "size",
        "head",
        "length",
        "whole",
        _field("WARC-Type").alias("kind"),
        _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Refers-To").alias("refers"),
        _field("WARC-Payload-Digest").alias("stated"),
        _field("X-Payload-Bytes").try_cast("long").alias("stated_bytes"),
        F.when(F.col("whole"), F.sha2(payload, 256)).alias("digest"),
        F.when(F.col("whole"), F.octet_length(payload).cast("long")).alias("bytes"),
    )
    placed = _placed(narrow).where(F.col("place") > 0).withColumn("at", F.col("place") - len(VERSION))
    following = F.col("place") + F.col("head") + F.col("length") + len(END)
    return materialise(placed.withColumn("to", F.when(F.col("length") >= 0, following)), "candidates")


def _after_http_head(body: Column) -> Column:
    """The payload of an HTTP message: binary after the first empty line."""
    head = F.octet_length(F.substring_index(body.cast("string"), END, 1)) + len(END)
    return F.substring(body, head + 1, F.octet_length(body))


def chained(at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which of a file's candidates (sorted offsets, successor offsets or -1) lie on the chain from offset zero."""
    n = len(at)
    place = np.minimum(np.searchsorted(at, to), n - 1)
    jump = np.append(np.where(at[place] == to, place, n), n)
    reached = np.zeros(n + 1, bool)
    reached[0] = n > 0 and at[0] == 0
    before = -1
    while reached.sum() != before:
        before = reached.sum()
        reached[jump[reached]] = True
        reached[n] = False
        jump = jump[jump]
    return reached[:n]


def _chain_task(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
    at = batch.column("at").to_numpy()
    to = batch.column("to").fill_null(-1).to_numpy()
    keep = np.concatenate([chained(at[i:j], to[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)])
    return batch.filter(pa.array(keep))


def on_chain(found: DataFrame) -> DataFrame:
    """The candidates on their file's chain of successors from offset zero."""
    sizes = found.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FILE_RECORDS).select("file")
    large = materialise(sizes, "large")
    if not large.limit(1).count():
        return by_group(found, "file", ["at"], _chain_task, found.schema)
    small = by_group(found.join(large, "file", "left_anti").select(*found.columns), "file", ["at"], _chain_task, found.schema)
    rest = found.join(large, "file", "left_semi")
    return small.unionByName(rest.join(reachable(rest), ["file", "at"], "left_semi").select(*found.columns))


def reachable(found: DataFrame) -> DataFrame:
    """``file, at`` of the candidates on the chain of successors from offset zero, by joins."""
    starts = materialise(found.where("at = 0").select("file", "at"), "reached")
    jumps = materialise(found.where("to is not null").select("file", "at", "to"), "jumps")
    count = starts.count()
    while True:
        ahead = starts.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = materialise(starts.unionByName(ahead).distinct(), "reached")
        now = reached.count()
        release(starts)
        starts = reached
        if now == count:
            release(jumps)
            return starts
        count = now
        second = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("next"))
        longer = materialise(jumps.join(second, ["file", "to"]).select("file", "at", F.col("next").alias("to")), "jumps")
        release(jumps)
        jumps = longer


def _reassembled(spark: SparkSession, path: str, cut: DataFrame, found: DataFrame) -> DataFrame:
    """``file, at, digest, bytes`` of records whose payload a separator cut."""
    inner = found.select("file", F.col("place").alias("piece"))
    own = cut.select("file", "at", "place", "head", "length", "to")
    spans = own.join(inner, "file").where((F.col("piece") >= F.col("place")) & (F.col("piece") < F.col("to")))
    values = _placed(_pieces(spark, path).withColumn("size", F.octet_length("value").cast("long")))
    joined = spans.join(values.select("file", F.col("place").alias("piece"), F.col("value").cast("binary").alias("raw")), ["file", "piece"])
    parts = joined.groupBy("file", "at", "head", "length").agg(F.array_sort(F.collect_list(F.struct("piece", "raw"))).alias("parts"))
    line = F.aggregate("parts", F.lit(None).cast("binary"), lambda acc, p: F.when(acc.isNull(), p["raw"]).otherwise(F.concat(acc, F.lit(VERSION).cast("binary"), p["raw"])))
    body = F.substring(line, (F.col("head") + 1).cast("int"), F.col("length").cast("int"))
    payload = _after_http_head(body)
    return parts.select("file", "at", F.sha2(payload, 256).alias("digest_"), F.octet_length(payload).cast("long").alias("bytes_"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, payload_digest, payload_bytes, refers_to`` of every record of the archives.

    Digest and size of a response are those of the payload as read; a record whose payload is not what its header states
    fails the query.
    """
    found = candidates(spark, path)
    kept = materialise(on_chain(found), "records")
    cut = kept.where("not whole")
    if cut.limit(1).count():
        mended = _reassembled(spark, path, cut, found)
        kept = kept.join(mended, ["file", "at"], "left").withColumn("digest", F.coalesce("digest", "digest_")).withColumn("bytes", F.coalesce("bytes", "bytes_"))
    response = F.col("kind") == "response"
    stated = F.regexp_extract("stated", "^sha256:(.*)$", 1)
    wrong = response & (F.coalesce(F.col("digest"), F.lit("")) != stated)
    digest = F.when(wrong, F.raise_error(F.concat(F.lit("payload differs from its digest: "), "record_id"))).otherwise(stated)

    def page(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:page:(.*)>$", 1).try_cast("long")

    return kept.select(
        page("record_id").alias("page_id"),
        F.when(response, F.col("bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("kind").alias("record_type"),
        page("refers").alias("refers_to"),
    )


def op10_query(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
