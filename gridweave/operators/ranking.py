"""Row numbers and running sums over a total order without a single-task window.

Rows are dealt by ranges of the order and sorted in each; a row's number is its place in its range plus the sizes of the
ranges before it. What is summed up centrally is one count per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridweave.plans.storage import materialise

_LOW = (1 << 33) - 1


def ranked(rows: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """``rows`` with ``name``: their number from 0 in ``order``, which must leave no ties."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    stored = materialise(dealt, "ranges")
    part = F.shiftright("__row", 33)
    sizes = stored.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    ahead = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__base"))
    joined = stored.withColumn("__part", part).join(F.broadcast(bases), "__part")
    return joined.withColumn(name, F.col("__base") + F.col("__row").bitwiseAND(F.lit(_LOW))).drop("__part", "__base", "__row")


def running_sums(rows: DataFrame, name: str, amount: str, *order: str | Column) -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` up to and including their own, in ``order``, which must leave no ties.

    As in ``ranked``, rows are dealt by ranges; sums within a range need only that range, and one sum per range is carried on.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id())
    stored = materialise(dealt.withColumn("__part", F.shiftright("__row", 33)), "ranges")
    sizes = stored.groupBy("__part").agg(F.sum(amount).alias("__n"))
    ahead = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__base"))
    own = F.sum(amount).over(W.partitionBy("__part").orderBy("__row").rowsBetween(W.unboundedPreceding, 0))
    return stored.withColumn("__own", own).join(F.broadcast(bases), "__part").withColumn(name, F.col("__base") + F.col("__own")).drop("__part", "__base", "__own", "__row")
