"""Digest trees: what differs between two tables, by key."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from routeloom.operators import digest_tree as D

SCHEMA = "k long, g string, v double"


def slow(one, two):
    out = {}
    for key in {r[:2] for r in one + two}:
        a, b = (Counter(r for r in t if r[:2] == key) for t in (one, two))
        if a != b:
            out[key] = "added" if not a else "lost" if not b else "repeated" if set(a) == set(b) else "changed"
    return out


def altered(rows, seed):
    rng = random.Random(seed)
    out = []
    for r in rows:
        x = rng.random()
        out += [] if x < 0.02 else [r, r] if x < 0.04 else [(*r[:2], -1.0)] if x < 0.06 else [r, (*r[:2], 7.5)] if x < 0.07 else [r]
    return out + [(10**6 + i, "new", None) for i in range(5)]


@pytest.mark.parametrize("depth", [1, 2, 3, None])
def test_differences_by_key(spark, depth):
    rows = [(i // 2, "ab"[i % 2] if i % 11 else None, float(i % 7) if i % 5 else None) for i in range(800)]
    rows += rows[:20]
    other = altered(rows, 3)
    a, b = (spark.createDataFrame(x, SCHEMA).repartition(n) for x, n in ((rows, 3), (other, 5)))
    got = {(r.k, r.g): r.difference for r in D.row_differences(a, b, ["k", "g"], depth).collect()}
    assert got == slow(rows, other) and set(got.values()) == {"added", "lost", "repeated", "changed"}
    assert D.row_differences(a, a.repartition(7), ["k", "g"], depth).collect() == []


def test_trees_tell_where_to_look(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("v"))
    other = df.withColumn("v", F.when(F.col("k") == 777, -1).otherwise(F.col("v")))
    one, two = D.tree(df, ["k"], 3), D.tree(other, ["k"], 3)
    assert {r.level: r["count"] for r in one.groupBy("level").count().collect()} == {0: 1, 1: 16, 2: 256, 3: one.filter("level = 3").count()}
    assert one.filter("level = 0").first().n_rows == 20_000
    assert D.differing_leaves(one, two, 3).count() == 1
    assert {r.k: r.difference for r in D.row_differences(df, other, ["k"], 3, (one, two)).collect()} == {777: "changed"}
    empty = df.limit(0)
    assert D.row_differences(empty, empty, ["k"]).collect() == []
    assert {r.difference for r in D.row_differences(empty, df.limit(3), ["k"]).collect()} == {"added"}
    assert [D.depth_for(n) for n in (0, 10, 5_000, 70_000, 10**12)] == [1, 1, 1, 2, 7]
