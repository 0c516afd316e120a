"""Paths through an overlay of cells against the plain search, ties included."""

import heapq
import random

import pytest
from pyspark.sql import functions as F

from routeloom.operators import overlay, paths

ARCS = "arc_id string, from_node string, to_node string, time_u long, distance_u long"


def grid(width, seed=1, drop=0.1):
    """A grid with arcs both ways, few different costs, so that many paths tie, and some arcs missing."""
    rng = random.Random(seed)
    out = []
    for i in range(width):
        for j in range(width):
            for k, m in ((i + 1, j), (i, j + 1)):
                if k < width and m < width:
                    for a, b in (((i, j), (k, m)), ((k, m), (i, j))):
                        if rng.random() >= drop:
                            out.append((f"a{rng.randrange(10**6):06d}-{len(out)}", "%d_%d" % a, "%d_%d" % b, rng.choice((1, 1, 2)), rng.choice((5, 5, 6))))
    return out


def carrying(arcs, source, blocked=(), limit=None):
    """Dijkstra over (time, distance, arc ids) as they are."""
    out = {}
    for arc, f, to, t, d in arcs:
        out.setdefault(f, []).append((to, t, d, arc))
    done, heap = {}, [(0, 0, (), source)]
    while heap:
        t, d, p, node = heapq.heappop(heap)
        if node in done:
            continue
        done[node] = (t, d, p)
        if node in blocked and node != source:
            continue
        for to, dt, dd, arc in out.get(node, ()):
            if to not in done and (limit is None or t + dt <= limit):
                heapq.heappush(heap, (t + dt, d + dd, (*p, arc), to))
    return done


def places(spark, width):
    return spark.createDataFrame([(f"{i}_{j}", float(i), float(j)) for i in range(width) for j in range(width)], "node string, x double, y double")


def table(spark, rows, name):
    return spark.createDataFrame([(r,) for r in rows], f"{name} string")


def test_plain_search_is_the_carrying_one():
    for seed in range(4):
        arcs = grid(9, seed)
        adjacent = {}
        for arc, f, to, t, d in arcs:
            adjacent.setdefault(f, []).append((to, t, d, arc))
        for blocked in ((), ("4_4", "2_3", "3_3")):
            assert paths.search(adjacent, "4_4", frozenset(blocked)) == carrying(arcs, "4_4", blocked)
        assert paths.search(adjacent, "0_0", limit=7) == carrying(arcs, "0_0", limit=7)


@pytest.mark.parametrize("max_arcs", [overlay.MAX_OVERLAY_ARCS, 600, 1])
def test_equal_to_the_search(spark, max_arcs):
    """One level, several, and an overlay that is never small enough and is walked by joins."""
    width = 14 if max_arcs == 1 else 24
    arcs = grid(width, 7)
    rng = random.Random(3)
    marks = [f"{rng.randrange(width)}_{rng.randrange(width)}" for _ in range(9)]
    df = spark.createDataFrame(arcs, ARCS)
    cells = overlay.quad_cells(places(spark, width), 20)
    got = paths.by_overlay(df, cells, table(spark, marks[:4], "source"), table(spark, marks[2:], "node"), max_arcs=max_arcs).collect()
    want = {(s, n): v for s in set(marks[:4]) for n, v in carrying(arcs, s).items() if n in marks[2:]}
    assert {(r.source, r.node): (r.time_u, r.distance_u, tuple(r.arc_ids)) for r in got} == want and len(got) == len(want)


def test_stops_blockers_and_limit(spark):
    width = 16
    arcs = grid(width, 5)
    rng = random.Random(9)
    marks = sorted({f"{rng.randrange(width)}_{rng.randrange(width)}" for _ in range(12)})
    df, cells = spark.createDataFrame(arcs, ARCS), overlay.quad_cells(places(spark, width), 30)
    sources, ends = table(spark, marks, "source"), table(spark, marks, "node")
    got = paths.by_overlay(df, cells, sources, ends, stops=ends).collect()
    want = {(s, n): v for s in marks for n, v in carrying(arcs, s, marks).items() if n in marks}
    assert {(r.source, r.node): (r.time_u, r.distance_u, tuple(r.arc_ids)) for r in got} == want
    mine = {marks[0]: marks[3:9], marks[1]: marks[5:7]}
    blockers = spark.createDataFrame([(s, n) for s, v in mine.items() for n in v], "source string, node string")
    got = paths.by_overlay(df, cells, sources.limit(3), ends, blockers=blockers, limit=14).collect()
    want = {(s, n): v for s in marks[:3] for n, v in carrying(arcs, s, mine.get(s, ()), 14).items() if n in marks}
    assert {(r.source, r.node): (r.time_u, r.distance_u, tuple(r.arc_ids)) for r in got} == want


def test_large_graphs_take_the_overlay(spark, monkeypatch):
    arcs = grid(12, 2)
    df = spark.createDataFrame(arcs, ARCS).select("arc_id", "from_node", "to_node", (F.col("time_u") / 1e6).alias("time_min"), (F.col("distance_u") / 1e6).alias("distance_m"))
    marks = ["0_0", "5_7", "11_11", "3_2"]
    cells = overlay.quad_cells(places(spark, 12), 25)
    who = spark.createDataFrame([(f"T{m}", m, "active") for m in marks], "terminal_id string, truck_anchor_id string, truck_service_status string")
    plain = [sorted(map(tuple, x.collect())) for x in (paths.shortest_paths(df, table(spark, marks, "source"), targets=table(spark, marks, "node")), *paths.logical_network(df, who))]
    monkeypatch.setattr(paths, "MAX_SHARED_ARCS", 10)
    monkeypatch.setattr(paths, "relax", None)
    large = [sorted(map(tuple, x.collect())) for x in (paths.shortest_paths(df, table(spark, marks, "source"), targets=table(spark, marks, "node"), cells=cells), *paths.logical_network(df, who, cells=cells))]
    assert plain == large and all(plain)


def test_cells_are_no_larger_than_stated(spark):
    rng = random.Random(1)
    spots = [(f"n{i}", rng.gauss(0, 1) ** 3, rng.random()) for i in range(2000)] + [(f"m{i}", 0.5, 0.5) for i in range(5)]
    nodes = spark.createDataFrame(spots, "node string, x double, y double")
    got = overlay.quad_cells(nodes, 50)
    assert got.count() == len(spots) and got.select("node").distinct().count() == len(spots)
    assert got.groupBy("cell").count().agg(F.max("count")).first()[0] <= 50
    assert overlay.quad_cells(nodes, 10_000).select("cell").distinct().count() == 1
    assert overlay.quad_cells(nodes.limit(0), 5).collect() == []


def test_large_overlays_are_not_collected(spark, monkeypatch):
    """With more arcs than the driver should hold the overlay is walked by joins, and where most nodes are kept no level is added."""
    arcs = grid(14, 3)
    marks = [f"{i}_{j}" for i in range(0, 14, 2) for j in range(0, 14, 2)]
    monkeypatch.setattr(overlay, "search_shared", None)
    made = []
    level = overlay.level
    monkeypatch.setattr(overlay, "level", lambda *a: made.append(1) or level(*a))
    cells = overlay.quad_cells(places(spark, 14), 20)
    got = paths.by_overlay(spark.createDataFrame(arcs, ARCS), cells, table(spark, marks, "source"), table(spark, marks, "node"), limit=4, max_arcs=50).collect()
    want = {(s, n): v for s in marks for n, v in carrying(arcs, s, limit=4).items() if n in marks}
    assert {(r.source, r.node): (r.time_u, r.distance_u, tuple(r.arc_ids)) for r in got} == want and len(made) == 1
    assert overlay.MAX_OVERLAY_ARCS <= 200_000
