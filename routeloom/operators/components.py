"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize


def _print(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _lowest(edges: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest node among u and its neighbours.

    Joined on a digest of u that no partitioning in place satisfies, so both sides
    get exchanges of their own, which adaptive execution splits at busy nodes.
    """
    key = F.xxhash64(F.col("u"), F.lit(1))
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(key.alias("k"), F.col("u").alias("w"), F.least("u", "m").alias("m"))
    near = edges.select("u", "v", key.alias("nk"))
    return near.join(low.hint("merge"), (F.col("nk") == F.col("k")) & (F.col("u") == F.col("w"))).select("u", "v", "m")


def _in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same by union-find over all batches; the smaller root always wins."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for b in batches:
        for a, c in zip(b["u"].tolist(), b["v"].tolist()):
            a, c = find(a), find(c)
            up[max(a, c)] = min(a, c)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "root": [find(x) for x in nodes]}, dtype="int64")


def components(edges: DataFrame, name: str = "components", small: int = 0) -> DataFrame:
    """(node, root) of every node in ``edges`` (a long, b long): root is the smallest node reachable.

    Ends when a round changes nothing; the number of rounds grows with the
    logarithm of the size of a component, and each round is one write.  Up to
    ``small`` edges, which are counted first, are one task's work.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialize(e, f"{name}-edges")
    seen = _print(e)
    if 0 < seen[0] <= small:
        return e.coalesce(1).mapInPandas(_in_one_task, "node long, root long")
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        far = _lowest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        near = _lowest(far.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        ends = F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))
        e = near.select(ends.alias("e")).select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct()
        e = materialize(e, f"{name}-round")
        now = _print(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
