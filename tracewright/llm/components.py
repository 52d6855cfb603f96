"""Connected components of a link table: union-find in partitions, stars between them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut
from .hot import dealt

_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links contracted by union-find: each node once, with its smallest mate."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    out = [(x, find(x)) for x in parent]
    out = [(x, r) for x, r in out if x != r]
    for i in range(0, len(out), 50_000):
        part = out[i : i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], schema=_LINKS)


def _with_least(rows: DataFrame, value: Column) -> DataFrame:
    """Rows (a, b) with `low`, the least `value` of their a."""
    return dealt(rows, cut(rows.groupBy("a").agg(F.min(value).alias("low"))), "a")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) of longs; root is its component's smallest.

    Partitions contract their links first. Then each round gives every node its smallest
    neighbour, so trees flatten into stars; a hot node costs a partial minimum and a join that
    adaptive execution can split. Nothing is collected. No links, no rows.
    """
    part = lambda d: d.mapInArrow(_forest, "a long, b long")
    links = cut(part(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")))
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a node's larger neighbours, and itself, go to its smallest one
        sent = _with_least(both, F.least("a", "b")).select(F.when(F.col("b") > F.col("a"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("low").alias("b")).filter("a <> b")
        sent = cut(sent.distinct())
        # of several smaller neighbours the smallest stays, and the others go to it
        near = _with_least(sent, F.col("b")).select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
        new = cut(near)
        n, different = new.agg(F.count("*"), F.count_distinct("a")).first()
        rooted = new.select("a").join(new.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
        links = new
        if rooted and n == different:
            roots = links.select(F.col("b").alias("node")).distinct()
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
