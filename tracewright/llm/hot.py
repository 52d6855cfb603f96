"""Joins by key in which no key's rows have to meet in one task.

Adaptive execution splits hot keys of a join by itself where both sides are dealt for it; `dealt`
sees to that. Where that isn't enough, as the result must not be dealt by key at all, a key that holds more than one in HOT_KEYS of all rows is hot; there are fewer than HOT_KEYS such
keys, whatever the data. What the other side has for them is broadcast, one row a key, so their
rows stay where they are; the rest is dealt by key as usual.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 10_000


def dealt(entries: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Entries joined to `side`, a row a key, by a long key; inner.

    What is known of the partitioning of `side` is forgotten, so that the join deals both sides
    and adaptive execution can split the hot ones among entries.
    """
    anew = side.select(F.col(key).bitwiseXOR(F.lit(0).cast("long")).alias(key), *(c for c in side.columns if c != key))
    return entries.hint("merge").join(anew, key)


def limit_of(rows: int) -> int:
    """The count beyond which a key is hot."""
    return max(2, rows // HOT_KEYS)


def marked(entries: DataFrame, hot: DataFrame, keys: tuple[str, ...] = ("key",)) -> DataFrame:
    """Entries with `hot`, whether their keys are among the hot ones."""
    few = F.broadcast(hot.select(*keys, F.lit(True).alias("hot")))
    return entries.join(few, [*keys], "left").withColumn("hot", F.coalesce("hot", F.lit(False)))


def beside(entries: DataFrame, side: DataFrame, hot: DataFrame, keys: tuple[str, ...] = ("key",)) -> DataFrame:
    """Entries (keys, hot, ...) with what `side`, a row a key, has for their keys; inner."""
    few = F.broadcast(side.join(F.broadcast(hot.select(*keys)), [*keys], "left_semi"))
    return entries.filter("hot").join(few, [*keys]).unionByName(entries.filter("not hot").join(side, [*keys]))
