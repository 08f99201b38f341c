"""Intermediate tables in the folder that driver and executors share.

Iterative plans and tables that are read more than once are written as Parquet below ``spark.checkpoint.dir`` and read
back. That cuts the lineage and survives the loss of any executor, which a cached or locally checkpointed table does not.
Tables that are done with are deleted by ``release``, or at the end of a ``released`` scope.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: A table of more rows is never broadcast: it is built in the driver, where it takes many times the size of its files.
BROADCAST_ROWS = 100_000

_OWN: dict[str, str] = {}
_SCOPES: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session. Without the setting a local master gets a temporary folder; a cluster none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = tempfile.mkdtemp(prefix="gridweave-")
        folder = _OWN[context.applicationId]
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gridweave/{name}-{uuid.uuid4().hex}"


@contextmanager
def released() -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end, but for those marked to stay."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for table in _SCOPES.pop():
            release(table)


def dealt(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, joined by dealing both sides out whatever the size of its files, unless ``rows`` are known to be few."""
    return df if rows is not None and rows <= BROADCAST_ROWS else df.hint("merge")


def materialise(df: DataFrame, name: str = "table", stay: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written files, ``dealt`` by their rows."""
    spark = df.sparkSession
    path, seen = fresh_path(spark, name), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    out = dealt(spark.read.schema(df.schema).parquet(path), seen.get["rows"])
    out._gridweave_path = path
    if _SCOPES and not stay:
        _SCOPES[-1].append(out)
    return out


def kept(df: DataFrame) -> bool:
    """Whether the files that ``materialise`` wrote for ``df`` are still there."""
    path = getattr(df, "_gridweave_path", None)
    if path is None:
        return False
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def release(df: DataFrame | None) -> None:
    """Delete what ``materialise`` wrote for ``df``; nothing may read it afterwards."""
    path = getattr(df, "_gridweave_path", None)
    if path is None:
        return
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
