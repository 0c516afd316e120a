"""Digest trees of releases: which rows differ, without reading what is equal.

A table's rows are dealt by a digest of their key into leaves; a leaf's digest is the
sum of its rows' digests, that of a node above one of its sixteen children's.  Two
trees are compared from the root down, level by level, and only below nodes that
differ; then only the rows of leaves that differ are read.  The tree of a release is a
small table that can be kept beside it.

Leaves depend on keys alone, so trees of two releases have the same shape whatever
changed.  Rows are summed where they are, so no row moves and none is sorted.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize
from .release import row_text

#: Rows of a leaf, about.
LEAF_ROWS = 4_096
MAX_DEPTH = 8


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    return min(MAX_DEPTH, max(1, math.ceil(math.log(max(rows, 1) / leaf_rows, 16)) if rows > leaf_rows else 1))


def leaf_of(keys: list[str], depth: int) -> Column:
    return F.substring(F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})), 1, depth)


def tree(df: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """(level, node, n_rows, digest): level ``depth`` has the leaves, level 0 the root."""
    h = F.md5(row_text(df))
    sums = [F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)]
    at = materialize(df.select(leaf_of(keys, depth).alias("node"), h.alias("h")).groupBy("node").agg(F.count(F.lit(1)).alias("n_rows"), F.sha2(F.concat_ws("-", *sums), 256).alias("digest")), "digest-leaves")
    levels = [at.select(F.lit(depth).alias("level"), "node", "n_rows", "digest")]
    for level in range(depth - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.concat_ws(":", "node", "digest")))
        up = levels[-1].groupBy(F.substring("node", 1, level).alias("up")).agg(F.sum("n_rows").alias("n_rows"), F.sha2(F.array_join(children, ","), 256).alias("digest"))
        levels.append(up.select(F.lit(level).alias("level"), F.col("up").alias("node"), "n_rows", "digest"))
    return reduce(DataFrame.unionByName, levels)


def differing_leaves(one: DataFrame, two: DataFrame, depth: int) -> DataFrame:
    """(node) of leaves that two trees of that depth don't share, found from the root down."""
    differ = None
    for level in range(depth + 1):
        a, b = (t.filter(F.col("level") == level).select("node", F.col("digest").alias(n)) for t, n in ((one, "a"), (two, "b")))
        if differ is not None:
            a, b = (x.withColumn("up", F.substring("node", 1, level - 1)).join(differ.withColumnRenamed("node", "up"), "up", "left_semi").drop("up") for x in (a, b))
        differ = materialize(a.join(b, "node", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node"), "digest-differ")
        if differ.isEmpty():
            return differ
    return differ


def row_differences(one: DataFrame, two: DataFrame, keys: list[str], depth: int | None = None, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """The keys whose rows differ, with ``difference``: added, lost, repeated (the same rows, other numbers of them) or changed.

    ``trees``: those of the two tables for the same keys and depth, if they are kept.
    """
    depth = depth or depth_for(max(one.count(), two.count()))
    trees = trees or (tree(one, keys, depth), tree(two, keys, depth))
    leaves = differing_leaves(*trees, depth)

    def rows(df: DataFrame, n: str) -> DataFrame:
        near = df.withColumn("__h", F.md5(row_text(df))).withColumn("__leaf", leaf_of(keys, depth)).join(leaves, F.col("__leaf") == F.col("node"), "left_semi")
        return near.groupBy(*keys, "__h").agg(F.count(F.lit(1)).alias(n))

    a, b = rows(one, "__a").alias("a"), rows(two, "__b").alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]) & (F.col("a.__h") == F.col("b.__h"))
    both = a.join(b, same, "full_outer").select(*[F.when(F.col("__a").isNull(), F.col(f"b.`{k}`")).otherwise(F.col(f"a.`{k}`")).alias(k) for k in keys], "__a", "__b")
    each = both.groupBy(*keys).agg(F.sum("__a").alias("a"), F.sum("__b").alias("b"), F.bool_and(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("shared"), F.bool_or(~F.col("__a").eqNullSafe(F.col("__b"))).alias("differ"))
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "lost").when(F.col("shared"), "repeated").otherwise("changed")
    return each.filter("differ").select(*keys, kind.alias("difference"))
