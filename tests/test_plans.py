"""The registered network queries over small tables, against brute force."""

import heapq
import math
import random
from itertools import combinations

from routeloom.operators import service, strong
from routeloom.plans import queries as Q
from routeloom.sources.profile import demo_profile

SUPPLIERS = [*range(130), 1_000_000, 1_000_002, 1_000_004]


def suppliers(spark, tmp_path):
    spark.createDataFrame([(k,) for k in SUPPLIERS], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_every_supplier_has_legs_corridors_and_costs(spark, tmp_path):
    sf = suppliers(spark, tmp_path)
    place = {f"C{k:06d}": (k * 37 % 101 * 50.0, k * 53 % 97 * 50.0, k % 9 * 10.0) for k in SUPPLIERS}
    net = {f"C{k:06d}": f"W{k // 40 * 2 + k % 2}" for k in SUPPLIERS}
    pairs = [(a, b) for a in place for b in place if net[a] == net[b]]
    n = {w: list(net.values()).count(w) for w in net.values()}
    assert len(place) == len(SUPPLIERS) and max(n.values()) == 20

    raw = {(r.payload, r.anchor_terminal, r.customer): r.distance_m for r in Q.drone_raw_legs(spark, sf).collect()}
    far = {(a, b): math.hypot(place[b][0] - place[a][0] - 30, place[b][1] - place[a][1] + 40) for a, b in pairs}
    assert set(raw) == {(p, *ab) for ab in pairs for p in ("full", "empty")}
    assert all(abs(d - far[a, b]) < 1e-5 for (_, a, b), d in raw.items())

    flat = [(r.payload, r.origin, r.destination) for r in Q.drone_centroid_legs(spark, sf).collect()]
    assert sorted(flat) == sorted((p, a, b) for a, b in pairs for p in ("full", "empty") if a != b)
    assert {r.network_id: (r.n_corridors, r.n_customers) for r in Q.drone_corridors(spark, sf).collect()} == {w: (k * k + k * (k - 1) // 2, k) for w, k in n.items()}

    d = demo_profile()["drone"]

    def energy(a, b, payload):
        z0, z1 = (place[a][2], place[b][2]) if payload == "full" else (place[b][2], place[a][2])
        top = max(z0, z1) + 5 + d["clearance_m"]
        kw = lambda phase: d[f"{payload}_{phase}_kw"] / 3600
        return (top - z0) / d["climb_m_s"] * kw("climb") + (top - z1) / d["descend_m_s"] * kw("descend") + far[a, b] / d["cruise_m_s"] * kw("cruise")

    costs = Q.drone_costs(spark, sf).collect()
    assert len(costs) == 2 * len(pairs) and all(abs(r.energy_kwh - energy(r.anchor_terminal, r.customer, r.payload)) < 2e-6 for r in costs)
    trips = Q.drone_round_trips(spark, sf).collect()
    assert len(trips) == len(pairs) and all(abs(r.round_trip_kwh - energy(r.anchor_terminal, r.customer, "full") - energy(r.anchor_terminal, r.customer, "empty")) < 2e-6 for r in trips)


def best_cover(pairs):
    """{demand: site} of the best set, by listing all sets of growing size; pairs: {(site, demand): (time, population)}."""
    sites, demands = sorted({s for s, _ in pairs}), sorted({d for _, d in pairs})
    for k in range(1, len(sites) + 1):
        found = []
        for chosen in combinations(sites, k):
            pick = {d: min((pairs[s, d][0], s) for s in chosen if (s, d) in pairs) for d in demands if any((s, d) in pairs for s in chosen)}
            if len(pick) == len(demands):
                found.append((sum(t * pairs[s, d][1] for d, (t, s) in pick.items()), chosen, {d: s for d, (_, s) in pick.items()}))
        if found:
            return min(found, key=lambda f: f[:2])[2]


def test_service_queries_consider_every_terminal(spark, tmp_path):
    spark.createDataFrame([(k, k % 5) for k in range(25)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    rng = random.Random(3)
    spark.createDataFrame([(i, rng.randrange(25)) for i in range(200)], "c_custkey int, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    sf = str(tmp_path)
    out = {}
    for a in Q.arcs(spark, sf).collect():
        out.setdefault(a.from_node, []).append((a.to_node, round(a.time_min * 10**6), round(a.distance_m * 10**6)))
    weight = {f"N{r.k:02d}": float(r.w) for r in Q.B.rows(spark, sf, Q.B.TERMINALS).collect()}
    near = {}
    for s in weight:
        best, queue = {}, [(0, 0, s)]
        while queue:
            t, d, x = heapq.heappop(queue)
            if x not in best:
                best[x] = (t, d)
                for y, dt, dd in out[x]:
                    heapq.heappush(queue, (t + dt, d + dd, y))
        near |= {(s, x): (t / 1e6, d / 1e6) for x, (t, d) in best.items() if t <= 2_500_000 and d <= 2_400_000_000}

    got = {(r.site, r.demand): (r.time_min, r.distance_m) for r in Q.service_pairs(spark, sf).collect()}
    assert len(weight) == 25 and got == near
    assert sorted((r.site, r.n_demands, r.catchment_population, r.local_population, r.weighted_time) for r in Q.service_catchments(spark, sf).collect()) == [(n, 1, w, w, 0.0) for n, w in sorted(weight.items())]
    want = best_cover({k: (t, weight[k[1]]) for k, (t, _) in near.items()})
    assert {r.demand: r.site for r in Q.microgrid_cover(spark, sf).collect()} == want and len(want) == 25


def test_exact_cover_of_more_than_24_sites(spark):
    rng = random.Random(8)
    for n in (26, 29):
        pop = {f"{i:02d}": float(rng.randrange(1, 9)) for i in range(n)}
        pairs = {(s, d): (float(rng.randrange(1, 6)) if s != d else 0.0, pop[d]) for s in pop for d in pop if s == d or rng.random() < 0.25}
        rows = spark.createDataFrame([(s, d, t, p) for (s, d), (t, p) in pairs.items()], "site string, demand string, time_min double, population double")
        got = service.min_site_cover(rows, spark.createDataFrame(list(pop.items()), "demand string, population double")).collect()
        assert {r["demand"]: r["site"] for r in got} == best_cover(pairs)


def one_way(spark, tmp_path, n):
    spark.createDataFrame([(k,) for k in range(n)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_strong_components_of_many_streets_go_by_cells(spark, tmp_path, monkeypatch):
    """Colouring takes a round for each arc of the longest way; with more streets than one task's work none of it may be needed."""
    sf = one_way(spark, tmp_path, 1_500)
    plain = strong.strong_components(Q.B.rows(spark, sf, Q.B.ONE_WAY_ARCS)).collect()
    monkeypatch.setattr(strong, "by_colours", None)
    monkeypatch.setattr(strong.strong_components, "__defaults__", (None, 300))
    monkeypatch.setattr(Q.overlay.quad_cells, "__defaults__", (60,))
    assert sorted(Q.strong_components(spark, sf).collect()) == sorted(plain) and len(plain) == 1_500
    assert 1 < len({r.root for r in plain}) < 1_500


def test_gate_names_the_terminals_it_fails(spark, tmp_path):
    spark.createDataFrame([(k, k % 5) for k in range(25)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(i, i * i % 25) for i in range(200)], "c_custkey int, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    gate = Q.source_gate(spark, str(tmp_path)).first()
    bad = sorted(r.terminal_id for r in Q.source_gate_inaccessible(spark, str(tmp_path)).collect())
    assert gate.inaccessible_ids == ",".join(bad) and gate.inaccessible_count == len(bad) > 0
