"""Raw map elements: newline-delimited JSON, one way or relation per line."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.functions.tags import EXCLUDED_ROLES
from gridweave.operators.ranking import ranked
from gridweave.sources.http import elements_of

SCHEMA = (
    "type string, id bigint, tags map<string,string>, geometry array<array<double>>, "
    "members array<struct<type:string,ref:bigint,role:string,geometry:array<array<double>>>>"
)
#: Equipment inside stations, not part of the network.
INTERNAL_POWER = ("busbar", "bay")


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """``oid, type, tags, geometry, members, size, file``: all ``*.ndjson`` files below ``path``.

    Blank lines are skipped; a line that is not JSON fails the query and names its file and the line itself. (A task reads
    a part of a file and cannot know the line's number in it.)
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson").text(path)
    return parsed_lines(lines.select("value", F.col("_metadata.file_path").alias("file")))


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Elements of lines ``value, file``, of a table or a stream; fails on a line that is not an element."""
    parsed = lines.where(F.trim("value") != "").withColumn("e", F.from_json("value", SCHEMA, {"mode": "PERMISSIVE"}))
    bad = F.raise_error(F.concat(F.lit("not an element: "), F.col("file"), F.lit(": "), F.substring("value", 1, 200)))
    kind = F.when(F.col("e.type").isNull() | F.col("e.id").isNull(), bad).otherwise(F.col("e.type"))
    return parsed.select(
        F.concat_ws("/", kind, F.col("e.id").cast("string")).alias("oid"),
        "e.type",
        F.coalesce("e.tags", F.create_map().cast("map<string,string>")).alias("tags"),
        "e.geometry",
        "e.members",
        F.length("value").alias("size"),
        "file",
    )


def latest(elements: DataFrame) -> DataFrame:
    """One row per element: its longest copy, of equally long ones that of the first file, there the first as text."""
    row = F.struct(*[c for c in elements.columns if c != "oid"])
    text = F.to_json(F.struct("tags", "geometry", "members"))
    return elements.groupBy("oid").agg(F.min_by(row, F.struct(-F.col("size"), "file", text)).alias("r")).select("oid", "r.*")


def usable(elements: DataFrame) -> DataFrame:
    """Without station equipment; members without excluded roles; adds ``power``."""
    power = F.lower(F.trim(F.coalesce(F.col("tags")["power"], F.lit(""))))
    roles = F.filter("members", lambda m: ~F.lower(F.trim(F.coalesce(m["role"], F.lit("")))).isin(*EXCLUDED_ROLES))
    return elements.withColumn("power", power).where(~F.col("power").isin(*INTERNAL_POWER)).withColumn("members", roles)


def normalised(elements: DataFrame, digits: int = 7) -> DataFrame:
    """Coordinates rounded; ways and members of fewer than two points lose their geometry; such ways are dropped."""

    def clean(geometry):  # noqa: ANN001, ANN202
        rounded = F.transform(geometry, lambda p: F.transform(p, lambda v: F.round(v, digits)))
        return F.when(F.size(geometry) >= 2, rounded)

    members = F.transform("members", lambda m: m.withField("geometry", clean(m["geometry"])))
    out = elements.withColumn("geometry", clean(F.col("geometry"))).withColumn("members", members)
    return out.where((F.col("type") != "way") | F.col("geometry").isNotNull())


def from_answer(spark: SparkSession, data: bytes) -> DataFrame:
    """The elements of a server's answer, normalised. An answer without a list of elements is an error."""
    if not isinstance(json.loads(data).get("elements"), list):
        raise ValueError("the answer has no elements")
    return normalised(spark.createDataFrame(list(elements_of(data)), SCHEMA))


def write_elements(elements: DataFrame, path: str) -> tuple[int, int]:
    """Write elements as NDJSON files below ``path``, which appear when all are whole: (elements, characters).

    Spark's committer writes beside the target and renames, so a failed write leaves no file that a reader would take.
    """
    value = F.to_json(F.struct("type", "id", "tags", "geometry", "members"))
    elements.select(value.alias("value")).write.mode("overwrite").option("lineSep", "\n").text(f"{path}.part")
    spark = elements.sparkSession
    lines = spark.read.text(f"{path}.part")
    row = lines.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("size")).first()
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    part, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.part", path))
    for k, status in enumerate(sorted((s.getPath().toString() for s in files.listStatus(part) if s.getPath().getName().startswith("part-")))):
        files.rename(spark._jvm.org.apache.hadoop.fs.Path(status), spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part/{k:05d}.ndjson"))
    files.delete(target, True)
    if not files.rename(part, target):
        raise OSError(f"cannot move {path}.part to {path}")
    return row["n"], row["size"]


def readable(spark: SparkSession, path: str) -> bool:
    """Whether there are files at ``path`` and each of their lines is an element."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return False
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson").text(path).where(F.trim("value") != "")
    element = F.from_json("value", SCHEMA)
    return not lines.where(element["type"].isNull() | element["id"].isNull()).limit(1).count()


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``number, file``: the ``*.ndjson`` files below ``path`` in order of their paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.ndjson").load(path).select(F.col("path").alias("file"))
    return ranked(files, "number", "file").select("number", "file")
