"""Places in an order that no single task has to know: Spark's range partitioning, and what
partitions carry over to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A monotonically increasing id holds the partition above so many bits.
_BITS = 33


def in_order(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows with `_part` and `_place`: the range partition a row stands in, and its place
    from 0 among the rows of its keys, ordered by `order`, which should have no ties.

    The sorted rows are checkpointed, as places must not change between their uses; no more than
    one row a partition and key is counted.
    """
    ordered = df.orderBy(*keys, *order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _BITS)
    heads = ordered.groupBy(*keys, part.alias("_part")).agg(F.min("_id").alias("_head"), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*keys, "_part", "_head", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = ordered.withColumn("_part", part).alias("o").join(heads.alias("h"), (F.col("o._part") == F.col("h._part")) & _same(keys))
    return at.select(*(F.col(f"o.`{c}`") for c in df.columns), F.col("o._part").alias("_part"), (F.col("_id") - F.col("_head") + F.col("_before")).alias("_place"))


def running_max(placed: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Adds the largest `value` of a row and all rows before it, to rows from in_order.

    Windows end at range partitions; what earlier partitions of the same keys reach is carried over.
    """
    tops = placed.groupBy(*keys, "_part").agg(F.max(value).alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(*keys, "_part", F.max("_top").over(before).alias("_carried"))
    within = Window.partitionBy(*keys, "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = placed.withColumn("_own", F.max(value).over(within))
    at = own.alias("o").join(tops.alias("h"), (F.col("o._part") == F.col("h._part")) & _same(keys))
    return at.select(*(F.col(f"o.`{c}`") for c in placed.columns), F.greatest("_own", "_carried").alias(name))


def _same(keys: list[str]):  # noqa: ANN202
    return F.expr(" and ".join(["true", *(f"o.`{k}` <=> h.`{k}`" for k in keys)]))
