"""Planning and texts of map queries, which jobs are still to do, and the run that does them. Fetching is in ``sources.http``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.config import Config
from gridweave.sources.elements import from_answer, readable, write_elements
from gridweave.sources.tables import append_manifest, read_manifest

#: Voltages a harvested tag can have, in volts.
TOP_VOLTS = 9_999_999


def _digits(low: int, high: int, rest: int) -> str:
    """A digit from ``low`` to ``high``, then ``rest`` digits of any kind."""
    one = str(low) if low == high else f"[{low}-{high}]"
    return one + ("" if rest == 0 else "[0-9]" if rest == 1 else f"[0-9]{{{rest}}}")


def _range(low: str, high: str) -> list[str]:
    """Alternatives for the numbers from ``low`` to ``high``, both of one width."""
    if not low:
        return [""]
    a, b, rest = int(low[0]), int(high[0]), len(low) - 1
    if a == b:
        return [low[0] + tail for tail in _range(low[1:], high[1:])]
    whole_low, whole_high = low[1:] == "0" * rest, high[1:] == "9" * rest
    out = [] if whole_low else [low[0] + tail for tail in _range(low[1:], "9" * rest)]
    first, last = a + (not whole_low), b - (not whole_high)
    if first <= last:
        out.append(_digits(first, last, rest))
    return out + ([] if whole_high else [high[0] + tail for tail in _range("0" * rest, high[1:])])


def voltage_pattern(low: int, high: int | None = None) -> str:
    """A regular expression for a semicolon-separated voltage tag with a value in [low, high) volts.

    Plain alternatives only: the servers' expressions are POSIX extended and know no lookahead.
    """
    top = TOP_VOLTS if high is None else high - 1
    parts: list[str] = []
    for width in range(len(str(low)), len(str(top)) + 1):
        least, most = max(low, 10 ** (width - 1)), min(top, 10**width - 1)
        parts += _range(str(least), str(most)) if least <= most else []
    return f"(^|;) *({'|'.join(parts)}) *(;|$)"


def voltage_in(voltage: Column, low: int, high: int | None = None) -> Column:
    """The same test on values: some part of the tag is a whole number of volts in the range."""
    parts = F.transform(F.split(voltage, ";"), lambda p: F.trim(p).try_cast("long"))
    return F.coalesce(F.exists(parts, lambda v: (v >= low) & (v <= TOP_VOLTS if high is None else v < high)), F.lit(False))


def scope_clause(scope: dict) -> str:
    """Where to look: an area by name or a box (south, west, north, east)."""
    if scope.get("area"):
        return "(area.scope)"
    return "({})".format(",".join(f"{v:g}" for v in scope["bbox"]))


def _head(scope: dict, timeout: int) -> str:
    area = f'area["ISO3166-1"="{scope["area"]}"]->.scope;\n' if scope.get("area") else ""
    return f"[out:json][timeout:{timeout}];\n{area}"


def conductor_query(scope: dict, low: int, high: int | None = None, timeout: int = 900) -> str:
    where, pattern = scope_clause(scope), voltage_pattern(low, high)
    ways = f'  way["power"~"^(line|cable|minor_line|construction)$"]["voltage"~"{pattern}"]{where};\n'
    routes = f'  relation["route"="power"]["voltage"~"{pattern}"]{where};\n'
    return f"{_head(scope, timeout)}(\n{ways}{routes});\nout geom;"


def substation_query(scope: dict, timeout: int = 900) -> str:
    where = scope_clause(scope)
    return f'{_head(scope, timeout)}(\n  way["power"="substation"]{where};\n  relation["power"="substation"]{where};\n);\nout geom;'


def dc_query(scope: dict, timeout: int = 900) -> str:
    where = scope_clause(scope)
    return f'{_head(scope, timeout)}(\n  way["power"~"^(line|cable)$"]["frequency"="0"]{where};\n  relation["route"="power"]["frequency"="0"]{where};\n);\nout geom;'


def tiles(spark: SparkSession, config: Config, degrees: float | None = None) -> DataFrame:
    """``name, area, bbox``: areas as they are, boxes cut into tiles of ``degrees``."""
    size = degrees or config.chunk_degrees
    areas = spark.createDataFrame([(a, a) for a in config.areas], "name string, area string").withColumn("bbox", F.lit(None).cast("array<double>"))
    boxes = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(config.bboxes)], "box int, s double, w double, n double, e double")
    for low, high, name in (("s", "n", "row"), ("w", "e", "col")):
        boxes = boxes.withColumn(name, F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(high) - F.col(low)) / size - 1e-9).cast("int") - 1))))
    south, west = F.col("s") + F.col("row") * size, F.col("w") + F.col("col") * size
    cut = boxes.select(
        F.format_string("box%02d_r%02d_c%02d", "box", "row", "col").alias("name"), F.lit(None).cast("string").alias("area"),
        F.array(south, west, F.least(south + size, F.col("n")), F.least(west + size, F.col("e"))).alias("bbox"),
    )
    return areas.unionByName(cut)


def jobs(spark: SparkSession, config: Config) -> DataFrame:
    """``job, pass, area, bbox, low_v, high_v``: each scope with disjoint voltage bands, stations, and DC."""
    floor, high = int(config.voltage_floor_kv * 1000), int(config.high_pass_kv * 1000)
    bands = [("conductors_high", high, None), ("conductors_low", floor, high)] if floor < high else [("conductors", floor, None)]
    passes = spark.createDataFrame([*bands, ("substations", None, None), ("dc", None, None)], "pass string, low_v int, high_v int")
    return tiles(spark, config).join(F.broadcast(passes)).select(F.concat_ws("_", "name", "pass").alias("job"), "pass", "area", "bbox", "low_v", "high_v")


def query_text(job: dict) -> str:
    scope = {"area": job["area"], "bbox": job["bbox"]}
    if job["pass"] == "substations":
        return substation_query(scope)
    return dc_query(scope) if job["pass"] == "dc" else conductor_query(scope, job["low_v"], job["high_v"])


def pending(planned: DataFrame, manifest: DataFrame) -> DataFrame:
    """Jobs without a successful entry in ``manifest`` (``job, status, elements, bytes, finished``)."""
    return planned.join(manifest.where("status = 'ok'").select("job"), "job", "left_anti")


def run(spark: SparkSession, config: Config, folder: str, fetch: Callable[[str], bytes]) -> list[str]:
    """Do the jobs that are not done, one after another, and return the names of those that failed.

    A job is done if the manifest says so and every line of its file is an element. ``fetch`` takes a query's text to the
    server's answer. A failed job is entered in the manifest as failed and leaves no file, so an empty file always means
    that nothing is there.
    """
    failed = []
    done = {r["job"] for r in read_manifest(spark, f"{folder}/manifest").where("status = 'ok'").select("job").distinct().collect()}
    for row in jobs(spark, config).orderBy("job").collect():  # a few hundred
        job = row.asDict()
        target = f"{folder}/elements/{job['job']}"
        if job["job"] in done and readable(spark, target):
            continue
        try:
            elements = from_answer(spark, fetch(query_text(job)))
        except (OSError, ValueError, RuntimeError):
            failed.append(job["job"])
            append_manifest(spark.createDataFrame([(job["job"], "failed", None, None)], "job string, status string, elements long, bytes long"), f"{folder}/manifest")
            continue
        count, size = write_elements(elements, target)
        append_manifest(spark.createDataFrame([(job["job"], "ok", count, size)], "job string, status string, elements long, bytes long"), f"{folder}/manifest")
    return failed
