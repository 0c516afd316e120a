"""Strongly connected components and the gate of every Depot, against plain reachability."""

import random

import pytest
from pyspark.sql import functions as F

from routeloom.operators import overlay, paths, strong


def slow(arcs):
    nodes = sorted({n for a in arcs for n in a})
    out = {}
    for a, b in arcs:
        out.setdefault(a, set()).add(b)

    def reach(n):
        seen, todo = {n}, [n]
        while todo:
            for t in out.get(todo.pop(), ()):
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return seen

    r = {n: reach(n) for n in nodes}
    return {n: min(m for m in r[n] if n in r[m]) for n in nodes}


def mixed(width, seed, share):
    rng = random.Random(seed)
    arcs = []
    for i in range(width):
        for j in range(width):
            for k, m in ((i + 1, j), (i, j + 1)):
                if k < width and m < width:
                    a, b = f"{i:02d}_{j:02d}", f"{k:02d}_{m:02d}"
                    arcs += [x for x in ((a, b), (b, a)) if rng.random() < share]
    return arcs


def run(spark, arcs, cells, small):
    got = strong.strong_components(spark.createDataFrame(arcs, "from_node string, to_node string"), cells, small).collect()
    assert len(got) == len({r.node for r in got})
    return {r.node: r.root for r in got}


@pytest.mark.parametrize("share", [0.3, 0.55, 0.8])
@pytest.mark.parametrize("small", [strong.SMALL, 40])
def test_equal_to_reachability(spark, share, small):
    arcs = mixed(14, int(share * 100), share)
    places = spark.createDataFrame([(f"{i:02d}_{j:02d}", float(i), float(j)) for i in range(14) for j in range(14)], "node string, x double, y double")
    assert run(spark, arcs, overlay.quad_cells(places, 12), small) == slow(arcs)


def test_colours_are_the_same(spark):
    arcs = mixed(6, 3, 0.6) + [("x", "y"), ("y", "x"), ("z", "z")]
    assert run(spark, arcs, None, 1) == slow(arcs)


def test_long_chain_and_long_ring(spark):
    """Ten thousand arcs in a row, that few rounds of joins would follow; closed, all are one."""
    n = 10_000
    chain = [(f"{i:05d}", f"{i + 1:05d}") for i in range(n)]
    cells = spark.range(n + 1).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("node"), (F.floor(F.col("id") / 300) + 1024).alias("cell"))
    assert run(spark, chain, cells, 100) == {f"{i:05d}": f"{i:05d}" for i in range(n + 1)}
    ring = [*chain, (f"{n:05d}", f"{0:05d}"), ("side", "00500"), ("09000", "way")]
    more = cells.unionByName(spark.createDataFrame([("side", 1025), ("way", 1030)], "node string, cell long"))
    assert run(spark, ring, more, 100) == {**{f"{i:05d}": "00000" for i in range(n + 1)}, "side": "side", "way": "way"}


def test_gate_of_every_depot(spark):
    arcs = mixed(8, 5, 0.7)
    rng = random.Random(6)
    snaps = [(f"T{i:02d}", f"{rng.randrange(8):02d}_{rng.randrange(8):02d}" if i else None, rng.random() < 0.8) for i in range(40)] + [("far", "nowhere", True)]
    df = spark.createDataFrame(snaps, "terminal_id string, truck_anchor_id string, distance_covered boolean")
    table = spark.createDataFrame([(f"a{i}", *a) for i, a in enumerate(arcs)], "arc_id string, from_node string, to_node string")
    root = slow(arcs)
    place = {t: (root.get(n, n), bool(c and n)) for t, n, c in snaps}
    every = {r.depot_terminal_id: r for r in paths.assess_depots(df, table, df.select("terminal_id")).collect()}
    bad = {d: {r.terminal_id for r in paths.inaccessible(df, table, d).collect()} for d in ("T00", "T05", "T11", "far")}
    assert len(every) == len(snaps)
    for d, (home, attached) in place.items():
        want = {t for t, (r, ok) in place.items() if t != d and not (ok and attached and r == home)}
        assert bad.get(d, want) == want and every[d].inaccessible_count == len(want) and every[d].demand_denominator == len(snaps) - 1
        assert every[d].depot_attached == attached and every[d].qualified == (attached and 100 * len(want) < 20 * (len(snaps) - 1))
    one = paths.assess(df, table, "T05").first()
    assert {k: one[k] for k in ("inaccessible_count", "depot_attached", "qualified")} == {k: every["T05"][k] for k in ("inaccessible_count", "depot_attached", "qualified")}
