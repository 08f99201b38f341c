"""Hot groups cut into blocks, so that no task holds more than two blocks of a group.

A group above ``most`` rows is dealt into blocks by a hash of its rows; every pair of blocks, and so every pair of rows, meets
in a task of its own. Group sizes are estimated from one row in ``every`` (by hash, the same rows each time): the estimate
decides how rows are dealt, never which rows meet. The table of hot groups is stored, so that its true size decides how it
is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.plans.storage import materialise, release


def in_blocks(rows: DataFrame, keys: list[str], row: str, most: int, every: int = 1) -> DataFrame:
    """``rows`` with ``i, j``: the pair of blocks of its group that a row is sent to, once for each block of the group."""
    seen = rows if every == 1 else rows.where(F.pmod(F.xxhash64(row, F.lit(2)), F.lit(every)) == 0)
    sizes = seen.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) * every / most).cast("int").alias("blocks"))
    hot = materialise(sizes.where("blocks > 1"), "hot")
    if not hot.limit(1).count():
        release(hot)
        return rows.withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    placed = rows.join(hot, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64(row, F.lit(1)), "blocks").cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with")).drop("blocks", "block", "with")


#: Rows of the table that ``split_rows`` ships at most, whatever its input.
SLOTS = 1 << 20


def split_rows(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key of ``keys``, rows that surely have none), without moving either.

    The low bits of the keys, at most SLOTS of them, are shipped to every task. The more keys, the more rows of other keys
    come back in the first part; with very many it is all rows, and the caller's join then does all the work.
    """
    slot = F.pmod(F.col(key), F.lit(SLOTS)).cast("int").alias("__slot")
    slots = F.broadcast(keys.select(slot).distinct())
    marked = rows.withColumn("__slot", slot)
    return marked.join(slots, "__slot", "left_semi").drop("__slot"), marked.join(slots, "__slot", "left_anti").drop("__slot")
