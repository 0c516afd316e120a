"""The boundary index against ray casting over all edges."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.operators import boundary as B

RINGS = "pts array<struct<x:double,y:double>>"


def edges_of(rings):
    return np.array([(*a, *b) for r in rings for a, b in zip(r, [*r[1:], r[0]])], dtype=float)


def distance(x, y, e):
    x1, y1, x2, y2 = e.T
    t = np.clip(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2 + 1e-300), 0, 1)
    return np.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)).min()


def slow(points, rings, buffer_m=0.0):
    e = edges_of(rings)
    x1, y1, x2, y2 = e.T
    out = []
    for i, x, y in points:
        with np.errstate(divide="ignore", invalid="ignore"):
            hits = ((y1 > y) != (y2 > y)) & (x < x1 + (y - y1) * (x2 - x1) / (y2 - y1))
        if hits.sum() % 2 or (buffer_m > 0 and distance(x, y, e) <= buffer_m):
            out.append(i)
    return out


def star(rng, cx, cy, low, high, n):
    return [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k, r in enumerate(rng.uniform(low, high) for _ in range(n))]


def table(spark, rings):
    return spark.createDataFrame([([{"x": float(x), "y": float(y)} for x, y in r],) for r in rings], RINGS)


def found(spark, points, shape, buffer_m=0.0):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in points], "id long, x double, y double")
    return sorted(r.id for r in B.clip(df, shape, buffer_m).collect())


CASES = {
    "star with holes, islands and a second part": lambda rng: [star(rng, 0, 0, 50, 100, 400), star(rng, 0, 0, 20, 45, 90), star(rng, 0, 0, 5, 15, 30), star(rng, 250, 40, 3, 60, 200)],
    "whole numbers": lambda rng: [[(0, 0), (10, 0), (10, 4), (6, 4), (6, 6), (10, 6), (10, 10), (0, 10)], [(2, 2), (4, 2), (4, 4), (2, 4)]],
    "comb": lambda rng: [[(0, 0), *[p for i in range(60) for p in ((i * 2 + 1, 90), (i * 2 + 2, 3))], (121, 0)]],
    "sliver": lambda rng: [[(0, 0), (1000, 1), (1000, 1.5), (0, 0.25)]],
    "triangle": lambda rng: [[(0.1, 0.2), (70.3, 11.9), (20.5, 66.6)]],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("buffer_m", [0.0, 0.7, 30.0])
def test_equals_ray_casting(spark, name, buffer_m):
    rng = random.Random(name)
    rings = CASES[name](rng)
    e = edges_of(rings)
    box = e[:, ::2].min() - 3, e[:, ::2].max() + 3, e[:, 1::2].min() - 3, e[:, 1::2].max() + 3
    points = [(i, rng.uniform(*box[:2]), rng.uniform(*box[2:])) for i in range(600)]
    points += [(600 + i, round(x) + 0.5, round(y) + 0.5) for i, x, y in points[:200]]
    # On lines through vertices, where a careless count goes wrong, but not on the boundary itself.
    points += [(800 + k, x, y + 0.37) for k, (x, y) in enumerate(p for r in rings for p in r)][:200]
    points += [(1000 + k, x + 0.37, y) for k, (x, y) in enumerate(p for r in rings for p in r)][:200]
    points = [p for p in points if distance(*p[1:], e) > 1e-9]
    assert found(spark, points, table(spark, rings), buffer_m) == slow(points, rings, buffer_m)


def test_rings_as_vertices_are_the_same(spark):
    rng = random.Random(2)
    rings = [star(rng, 0, 0, 5, 10, 40), star(rng, 0, 0, 1, 4, 25)]
    v = spark.createDataFrame([(i, k, x, y) for i, r in enumerate(rings) for k, (x, y) in enumerate(r)], "ring int, k int, x double, y double").repartition(3)
    assert sorted(B.vertex_edges(v).collect()) == sorted(B.ring_edges(table(spark, rings)).collect())
    closed = [[*r, r[0]] for r in rings]
    assert sorted(B.ring_edges(table(spark, closed)).collect()) == sorted(B.ring_edges(table(spark, rings)).collect())


def test_nulls_clashes_and_nothing(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 9.0, 9.0), (1, 1.0, 1.0)], "id long, x double, y double")
    more = points.withColumns({c: F.lit("c") for c in ("row", "col", "inside", "edges", "x1", "cells")})
    out = B.clip(more, [(0, 0), (2, 0), (2, 2), (0, 2)])
    assert out.columns == more.columns and [r.id for r in out.collect()] == [1, 1]
    for rings in ([], [[(0, 0), (1, 1)]], [[(1, 1), (1, 1), (1, 1)]]):
        assert B.clip(points, table(spark, rings)).collect() == []
    assert B.clip(points.limit(0), [(0, 0), (2, 0), (2, 2)]).collect() == []


def test_a_hundred_thousand_vertices(spark):
    """Some 300 edges a point would take minutes row by row; here a point meets the edges of one cell."""
    rng = random.Random(4)
    rings = [star(rng, 0, 0, 80, 100, 80_000), *[star(rng, 12 * i - 50, 0, 3, 5, 2_000) for i in range(10)]]
    v = spark.createDataFrame([(i, k, x, y) for i, r in enumerate(rings) for k, (x, y) in enumerate(r)], "ring int, k int, x double, y double")
    index = B.boundary(B.vertex_edges(v))
    points = spark.range(200_000).select("id", (F.rand(1) * 220 - 110).alias("x"), (F.rand(2) * 220 - 110).alias("y")).cache()
    began = time.monotonic()
    got = {r.id for r in index.clip(points).collect()}
    assert time.monotonic() - began < 60
    some = [tuple(r) for r in points.limit(400).collect()]
    assert [i for i, _, _ in some if i in got] == slow(some, rings)
    sizes = index.cells.select(F.size("edges").alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert sizes[1] < 20 * 100_000


def test_places_on_edges_are_where_the_expression_puts_them(spark):
    """Whole places on slanted edges and at vertices: the ray's expression decides, not a grid's rounding."""
    ring = [(100.0, 100.0), (1200.0, 250.0), (900.0, 800.0), (1300.0, 1400.0), (150.0, 1100.0)]
    on = {(round(a + (c - a) * k / g), round(b + (d - b) * k / g)) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]) for g in [math.gcd(int(c - a), int(d - b))] for k in range(g + 1)}
    places = sorted({(x + i, y) for x, y in on for i in (-1, 0, 1)})
    want = []
    for n, (x, y) in enumerate(places):
        hits = [(y1 > y) != (y2 > y) and x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1)) for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])]
        want += [n] if sum(hits) % 2 else []
    assert len(on) > 100 and found(spark, [(n, x, y) for n, (x, y) in enumerate(places)], ring) == want
    corner = [(0, 1200.0 + 30, 250.0 - 40), (1, 1200.0 + 30, 250.0 - 40.001), (2, 1300.0 + 48, 1400.0 + 14), (3, 100.0 - 40, 100.0 - 30)]
    assert found(spark, corner, ring, 50.0) == [0, 2, 3]


def dense(n):
    """A ring whose edges are long and lie close together, so that many pass through each place."""
    rng = random.Random(n)
    return [star(rng, 0, 0, 60, 100, n)]


@pytest.mark.parametrize("buffer_m", [0.0, 3.0])
def test_long_edges_are_held_a_few_times(spark, buffer_m):
    """Small cells that each held all edges through them would hold an edge of this ring some sixteen times, or more."""
    rings = dense(6_000)
    index = B.boundary(B.ring_edges(table(spark, rings)), buffer_m)
    assert index.cells.select(F.sum(F.size("edges"))).first()[0] < 6 * 6_000
    rng = random.Random(5)
    points = [(i, rng.uniform(-110, 110), rng.uniform(-110, 110)) for i in range(1_500)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    assert sorted(r.id for r in index.clip(df).collect()) == slow(points, rings, buffer_m)


def test_full_cells_are_made_smaller_and_points_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(B, "GROUP_EDGES", 300)
    monkeypatch.setattr(B, "GROUP_POINTS", 7)
    monkeypatch.setattr(B, "FEW", 50)
    rings = dense(1_000)
    rng = random.Random(6)
    points = [(i, rng.uniform(-110, 110), rng.uniform(-110, 110)) for i in range(800)]
    for buffer_m in (0.0, 2.0):
        assert found(spark, points, table(spark, rings), buffer_m) == slow(points, rings, buffer_m)
