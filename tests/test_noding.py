"""Noding on a grid: overlaps, near misses and moved crossings, against exact fractions."""

import random
from collections import Counter
from fractions import Fraction as Q
from itertools import combinations

import pytest

from routeloom.operators import roads as R

SCHEMA = "source_id string, grade_key string, road_class string, oneway string, pts array<struct<x:double,y:double>>"
HALF = Q(1, 2) * (1 + Q(1, 10**6))


def table(spark, streets):
    return spark.createDataFrame([(n, g, c, o, [{"x": float(x), "y": float(y)} for x, y in p]) for n, g, c, o, p in streets], SCHEMA)


def crossing(p, q):
    """Where two straight pieces cross, exactly; nothing if they are parallel."""
    (ax, ay), (bx, by), (cx, cy), (dx, dy) = *p, *q
    d = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    if d == 0:
        return None
    t, u = Q((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx), d), Q((cx - ax) * (by - ay) - (cy - ay) * (bx - ax), d)
    return (ax + t * (bx - ax), ay + t * (by - ay)) if 0 <= t <= 1 and 0 <= u <= 1 else None


def passes(piece, spot):
    (ax, ay), (bx, by), (x, y) = *piece, spot
    dx, dy = bx - ax, by - ay
    box = min(ax, bx) - HALF <= x <= max(ax, bx) + HALF and min(ay, by) - HALF <= y <= max(ay, by) + HALF
    return box and abs(dx * (y - ay) - dy * (x - ax)) <= HALF * (abs(dx) + abs(dy))


def exact(streets):
    """The set of straight pieces by grade after snap rounding to whole numbers.

    None if a crossing lies half way between two, or so near to an end that it counts as that end.
    """
    out = set()
    for grade in {s[1] for s in streets}:
        pieces = [(s[4][i], s[4][i + 1]) for s in streets if s[1] == grade for i in range(len(s[4]) - 1)]
        hot = {p for piece in pieces for p in piece}
        for p, q in combinations(pieces, 2):
            c = crossing(p, q)
            if c:
                if any(abs(v - round(v)) > Q(499, 1000) for v in c):
                    return None
                if any(0 < max(abs(c[0] - e[0]), abs(c[1] - e[1])) < 2 for e in (*p, *q)):
                    return None
                hot.add((round(c[0]), round(c[1])))
        for a, b in pieces:
            way = lambda s: (b[0] - a[0]) * (s[0] - a[0]) + (b[1] - a[1]) * (s[1] - a[1])  # noqa: E731, B023
            on = sorted((s for s in hot if passes((a, b), s)), key=way)
            out |= {(grade, *sorted(x)) for x in zip(on, on[1:])}
    return out


def pieces_of(segments):
    got = [(r.grade_key, *sorted(((p.x, p.y), (q.x, q.y)))) for r in segments for p, q in zip(r.pts, r.pts[1:])]
    return [(g, tuple(map(round, a)), tuple(map(round, b))) for g, a, b in got]


def random_streets(seed):
    """Streets that often share a line, a vertex or a part."""
    rng = random.Random(seed)
    spot = lambda: (rng.randrange(0, 500) * 3, rng.randrange(0, 500) * 3)
    out = []
    for i in range(9):
        p, q = spot(), spot()
        if out and rng.random() < 0.5:  # along an earlier street, from and to other places
            (ax, ay), (bx, by) = rng.choice(out)[4][:2]
            k, m = rng.sample(range(-1, 5), 2)
            p, q = (ax + k * (bx - ax) // 3, ay + k * (by - ay) // 3), (ax + m * (bx - ax) // 3, ay + m * (by - ay) // 3)
        line = [p, q] + [spot() for _ in range(rng.randrange(0, 2))]
        line = [x for k, x in enumerate(line) if k == 0 or x != line[k - 1]]
        if len(line) > 1:
            out.append((f"s{i}", "0" if rng.random() < 0.8 else "1", "residential", "no", line))
    return out


def test_random_overlapping_streets(spark):
    tried = 0
    for seed in range(12):
        streets = random_streets(seed)
        want = exact(streets)
        if want is None:
            continue
        got = pieces_of(R.noded_segments(table(spark, streets), cell_m=300.0, precision_m=1.0).collect())
        assert set(got) == want, seed
        assert max(Counter(got).values()) == 1, seed
        for (g, *p), (h, *q) in combinations(want, 2):
            c = crossing(p, q) if g == h else None
            assert c is None or (c in p or c in q), "pieces meet in nodes alone"
        tried += 1
    assert tried >= 6


def test_overlap_becomes_one_edge(spark):
    streets = [
        ("a", "0", "residential", "yes", [(0, 0), (100, 0)]),
        ("b", "0", "secondary", "yes", [(70, 0), (30, 0)]),
        ("c", "0", "residential", "yes", [(60, 0), (140, 0)]),
        ("d", "1", "residential", "no", [(0, 0), (100, 0)]),
    ]
    rows = R.noded_segments(table(spark, streets)).collect()
    got = {(r.grade_key, r.pts[0].x, r.pts[-1].x): (r.source_id, r.road_class, r.oneway) for r in rows}
    assert got == {
        ("0", 0.0, 30.0): ("a", "residential", "yes"), ("0", 30.0, 60.0): ("a", "secondary", "no"), ("0", 60.0, 70.0): ("a", "secondary", "no"), ("0", 70.0, 100.0): ("a", "residential", "yes"),
        ("0", 100.0, 140.0): ("c", "residential", "yes"), ("1", 0.0, 100.0): ("d", "residential", "no"),
    }
    _, edges = R.build_graph(R.noded_segments(table(spark, streets)))
    assert edges.count() == 6 and edges.filter("grade_key = '0'").groupBy().sum("length_m").first()[0] == pytest.approx(140)


def test_crossings_moved_to_the_grid_make_no_new_ones(spark):
    """Three streets through nearly one place: each goes through the nodes that it passes."""
    streets = [("a", "0", "residential", "no", [(0, 0), (101, 100)]), ("b", "0", "residential", "no", [(0, 99), (100, 3)]), ("c", "0", "residential", "no", [(51, 0), (49, 100)]), ("d", "0", "residential", "no", [(0, 50), (100, 51)])]
    got = pieces_of(R.noded_segments(table(spark, streets), precision_m=1.0).collect())
    assert len(set(got)) == len(got) > 8
    for (_, *p), (_, *q) in combinations(got, 2):
        c = crossing(p, q)
        assert c is None or (c in p and c in q)
    assert {s[4][k] for s in streets for k in (0, -1)} <= {p for _, *x in got for p in x}


def test_a_road_that_turns_back_on_itself(spark):
    streets = [("a", "0", "residential", "no", [(0, 0), (50, 0), (20, 0), (20, 30)])]
    got = pieces_of(R.noded_segments(table(spark, streets), precision_m=1.0).collect())
    assert sorted(got) == [("0", (0, 0), (20, 0)), ("0", (20, 0), (20, 30)), ("0", (20, 0), (50, 0))]


def test_vertices_of_one_road_alone_are_no_nodes(spark):
    streets = [("a", "0", "residential", "no", [(0, 0), (10, 5), (20, 0), (30, 5)]), ("b", "1", "residential", "no", [(10, 5), (10, 50)])]
    rows = R.noded_segments(table(spark, streets)).collect()
    assert sorted((r.segment_id, len(r.pts)) for r in rows) == [("a:0", 4), ("b:0", 2)]
