"""Near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.llm import embedding_dedup as E

SCHEMA = "vec_id long, label int, embedding array<float>"


def slow(rows, cosine=0.93):
    """{vec_id: (links, component)} by comparing all; vec_ids are distinct."""
    good = [(i, k, np.array(v, np.float64)) for i, k, v in rows if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i, _, _ in rows}
    for k, d in {(k, len(v)) for _, k, v in good}:
        ids = [i for i, x, v in good if x == k and len(v) == d]
        u = np.array([v / np.linalg.norm(v) for _, x, v in good if x == k and len(v) == d])
        for a, b in zip(*np.nonzero(np.triu(u @ u.T >= cosine, 1))):
            near[ids[a]].add(ids[b])
            near[ids[b]].add(ids[a])
    out, seen = {}, {}
    for i in sorted(near):
        todo = [] if i in seen else [i]
        while todo:
            x = todo.pop()
            if seen.setdefault(x, i) == i and x not in out:
                out[x] = (len(near[x]), i)
                todo += near[x] - out.keys()
    return out


def directions(rng, n, d=64):
    x = rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1)[:, None]


def around(rng, center, angle, n):
    """Unit vectors at an angle from a center."""
    r = directions(rng, n, len(center))
    r -= (r @ center)[:, None] * center
    r /= np.linalg.norm(r, axis=1)[:, None]
    return math.cos(angle) * center + math.sin(angle) * r


def sample(seed=0):
    rng = np.random.default_rng(seed)
    parts = [(1, directions(rng, 300)), (2, directions(rng, 100))]
    parts += [(1, around(rng, directions(rng, 1)[0], 0.005, 150)), (1, around(rng, directions(rng, 1)[0], 0.03, 80))]
    parts += [(2, around(rng, directions(rng, 1)[0], 0.2, 40)), (2, np.repeat(directions(rng, 1), 50, 0))]
    rows = [(lab, v.tolist()) for lab, m in parts for v in m]
    rng.shuffle(rows)
    return [(i * 3 + 1, lab, v) for i, (lab, v) in enumerate(rows)]


def result(spark, rows, **how):
    got = E.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), **how).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    return {r.vec_id: (r.n_links, r.component_id) for r in got}


@pytest.mark.parametrize("list_rows", [E.LIST_ROWS, 7])
def test_equals_all_pairs(spark, list_rows):
    rows = sample()
    want, got = slow(rows), result(spark, rows, list_rows=list_rows)
    assert got.keys() == want.keys() and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    tight = [i for i, (n, _) in want.items() if n >= 49]
    assert len(tight) > 250 and all(got[i] == want[i] for i in tight)


def test_classes_at_the_threshold_are_settled_by_vector(spark):
    """Two tight groups whose leaders are apart by about the linking angle: some of their vectors link."""
    rng = np.random.default_rng(5)
    a = directions(rng, 1)[0]
    b = around(rng, a, math.acos(0.93), 1)[0]
    rows = [(i, 1, v.tolist()) for i, v in enumerate(np.vstack([around(rng, a, 0.02, 60), around(rng, b, 0.02, 60)]))]
    want, got = slow(rows), result(spark, rows)
    counts = {n for n, _ in want.values()}
    assert len(counts) > 10 and {c for _, c in want.values()} == {0}
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values()) and all(got[i][0] <= want[i][0] for i in want)


def test_open_classes_give_exact_counts(spark):
    """Classes made by hand, so that every pair between them is left open."""
    rng = np.random.default_rng(6)
    a = directions(rng, 1)[0]
    vectors = np.vstack([around(rng, a, 0.05, 20), around(rng, around(rng, a, math.acos(0.93), 1)[0], 0.05, 20)])
    member = spark.createDataFrame([(i, 0 if i < 20 else 20, v.tolist(), 1 + i % 3) for i, v in enumerate(vectors)], "pid long, cid long, embedding array<double>, copies long")
    got = {(r.x, r.y, r.nx, r.ny) for r in E.settle(spark.createDataFrame([(0, 20)], "a long, b long"), member, 0.93).collect()}
    assert got == {(i, j, 1 + i % 3, 1 + j % 3) for i in range(20) for j in range(20, 40) if vectors[i] @ vectors[j] >= 0.93} and 0 < len(got) < 400


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(7)
    a = directions(rng, 1500)
    b = np.vstack([around(rng, v, math.acos(0.931), 1) for v in a])
    rows = [(i, i % 5, v.tolist()) for i, v in enumerate(np.stack([a, b], 1).reshape(-1, 64))]
    rows = [(i, (i // 2) % 5, v) for i, _, v in rows]
    want, got = slow(rows), result(spark, rows)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in want.values()) > 2000


def test_nulls_lengths_repeated_rows_and_empty(spark):
    u = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, u), (2, 1, [2.0, 4.0, 6.0]), (3, 1, [1.0, 2.0]), (4, None, u), (5, 1, None), (6, 1, []), (7, 1, [0.0] * 3), (8, 1, [1.0, nan, 3.0]), (9, 1, [1.0, inf, 3.0]), (10, 1, [1.0, None, 3.0]), (11, 2, u), (12, 1, [-1.0, -2.0, -3.0]), (13, 1, [1e30, 2e30, 3e30]), (14, 1, [1e-30, 2e-30, 3e-30])]
    assert result(spark, rows) == slow(rows)
    again = [(1, 1, u), (1, 1, u), (None, 1, u), (None, 1, [0.0, 1.0, 0.0]), (2, 1, [0.0, 1.0, 0.0]), (None, None, u), (3, 3, u), (3, 3, [3.0, -1.0, 0.5])]
    df = spark.createDataFrame(again, SCHEMA).withColumns({c: F.lit("x") for c in ("PID", "cid", "Ka", "low", "copies", "N_Links", "text", "pivots")})
    got = sorted(map(str, map(tuple, E.near_vectors(df).collect())))
    assert got == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, 2, False), (2, 1, 2, True), (None, 0, None, True), (3, 0, 3, True), (3, 0, 3, True)]))
    assert E.near_vectors(df.limit(0)).collect() == []


def test_lists_look_at_each_pair_that_shares_two_pivots_once():
    rng = np.random.default_rng(8)
    u = np.vstack([directions(rng, 300, 16), np.repeat(directions(rng, 4, 16), 90, 0) + 0.2 * directions(rng, 360, 16)])
    u = E.unit(u)
    points = E.pivots(64, 16)
    e = np.zeros(len(u), E.entry(16))
    e["id"], e["total"], e["pivots"] = np.arange(len(u)), 1, np.sort(E.nearest(u, points), axis=1)
    e["step"], e["vector"] = E.encode(u)
    assert np.abs(E.decode(e["step"], e["vector"], 16) - u).max() <= e["step"].max() * 0.51
    angle, count = math.acos(0.9), np.zeros(len(u), np.int64)
    for p in np.unique(e["pivots"][:, : E.PREFIX - 1]):
        held = np.flatnonzero((e["pivots"][:, : E.PREFIX - 1] == p).any(axis=1))
        for blocks in (1, 3):
            done = np.zeros(len(held), np.int64)
            for b in range(blocks):
                for c in range(b, blocks):
                    s = np.flatnonzero((held % blocks == b) | (held % blocks == c))
                    links = E.list_links(e[held[s]], held[s] % blocks, b != c, p, 16, angle)
                    done[s] += links.count
                    for i, j in links.open:
                        np.add.at(done, s[i], 1)
                        np.add.at(done, s[j], 1)
            if blocks == 1:
                once = done
        assert (once == done).all()
        count[held] += once
    shared = (e["pivots"][:, None, :, None] == e["pivots"][None, :, None, :]).any(axis=3).sum(axis=2)
    near = u @ u.T >= math.cos(angle) - 1e-3
    assert (count >= ((u @ u.T >= math.cos(angle)) & (shared >= 2)).sum(axis=1) - 1).all() and (count <= (near & (shared >= 2)).sum(axis=1) - 1).all() and count.max() > E.MATRIX > 0
