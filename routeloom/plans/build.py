"""Whole runs: raw tables to a mother release, and a mother to networks.

``run`` publishes create-only.  A mother is built once and may be reused by any
number of full runs; a full run searches paths anew in each scope.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..errors import GateError
from ..operators import drone, paths, population, release, roads, scenarios, service, terrain
from ..sources.profile import validate_profile
from ..workspace import materialize

MOTHER = ["terminals", "physical_edges", "arc_costs", "elevation_profiles", "road_source_assessment", "elevation_model", "elevation_grid"]
FROZEN = "registry/frozen_slopes"
#: Tables of a network that the checks read.
CHECKED = ["customers", "logical_arcs", "lineage", "demands", "microgrid", "backbone", "drone_raw_legs"]
SPEEDS = {"secondary": 60.0, "residential": 35.0}
SAMPLE_STEP_M = 50.0


def terminals(cells: DataFrame, profile: dict) -> DataFrame:
    """Customers and the Depot from population cells; ids come from places, not from row order."""
    d = profile["demand"]
    labelled = population.label_components(population.calibrate(population.above_threshold(cells, d.get("threshold", 0.0)), d["official_population"]))
    cell = d["cell_m"]
    x, y = (F.col("col") + 0.5) * cell, (F.col("row") + 0.5) * cell
    depot = (F.col("row") == d["depot_cell"][0]) & (F.col("col") == d["depot_cell"][1])
    nodes = labelled.groupBy("component").agg(F.sum("pop").alias("population"), (F.sum(F.col("pop") * x) / F.sum("pop")).alias("x_m"), (F.sum(F.col("pop") * y) / F.sum("pop")).alias("y_m"), F.bool_or(depot).alias("is_depot"))
    nodes = population.require_several(materialize(nodes, "terminals"))
    if nodes.filter("is_depot").count() != 1:
        raise GateError("the Depot's cell belongs to no component")
    return nodes.select(F.concat(F.lit("T"), F.col("component").cast("string")).alias("terminal_id"), "population", "x_m", "y_m", "is_depot")


def sample_points(edges: DataFrame, step_m: float = SAMPLE_STEP_M) -> DataFrame:
    """(edge_id, d, x, y) along each edge: its vertices and places between them no farther apart than a step."""
    seg = F.posexplode(F.expr("transform(sequence(0, size(pts) - 2), i -> struct(pts[i] as a, pts[i + 1] as b, i = size(pts) - 2 as last))"))
    s = edges.select("edge_id", "pts", seg.alias("i", "s")).withColumn("m", F.hypot(F.col("s.b.x") - F.col("s.a.x"), F.col("s.b.y") - F.col("s.a.y"))).filter("m > 0")
    before = F.expr("aggregate(sequence(0, i), 0d, (t, k) -> t + if(k = 0, 0d, sqrt(pow(pts[k].x - pts[k - 1].x, 2) + pow(pts[k].y - pts[k - 1].y, 2))))")
    n = F.ceil(F.col("m") / step_m)
    at = F.explode(F.sequence(F.lit(0), F.when(F.col("s.last"), n).otherwise(n - 1)))
    p = s.withColumn("before", before).withColumn("n", n).withColumn("k", at).withColumn("t", F.col("k") / F.col("n"))
    return p.select("edge_id", (F.col("before") + F.col("t") * F.col("m")).alias("d"), (F.col("s.a.x") + F.col("t") * (F.col("s.b.x") - F.col("s.a.x"))).alias("x"), (F.col("s.a.y") + F.col("t") * (F.col("s.b.y") - F.col("s.a.y"))).alias("y"))


def elevation_profiles(edges: DataFrame, dem: DataFrame, grid: dict, known: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Each edge's ground, sampled once for both directions.

    ``known``: edges and their profiles over the same ground; only edges that aren't
    among them, or lie otherwise, are sampled.
    """
    if known is not None:
        before = known[0].select("edge_id", F.col("pts").alias("before"))
        kept = materialize(edges.join(before, "edge_id").filter("pts = before").select("edge_id"), "edges-kept")
        names = ["edge_id", "sample_distances_m", "smoothed_elevations_m"]
        new = elevation_profiles(edges.join(kept, "edge_id", "left_anti"), dem, grid).select(*names)
        return known[1].select(*names).join(kept, "edge_id", "left_semi").unionByName(new)
    sampled = terrain.require_samples(materialize(terrain.sample_dem(sample_points(edges), dem, grid["x0"], grid["y0"], grid["cell_m"]), "samples"))
    each = sampled.groupBy("edge_id").agg(F.sort_array(F.collect_list(F.struct("d", "z"))).alias("p"))
    return each.select("edge_id", F.transform("p", lambda p: p["d"]).alias("sample_distances_m"), terrain.smooth(F.transform("p", lambda p: p["z"])).alias("smoothed_elevations_m"))


def arc_costs(edges: DataFrame, profiles: DataFrame, profile: dict) -> DataFrame:
    """Directed arcs with times, energies and climbs; the reverse arc reads the same profile backwards."""
    a = roads.directed_arcs(edges).join(terrain.profile_costs(profiles), "edge_id")
    back = F.col("arc_id").endswith("-")
    up, down = F.col("cumulative_ascent_m"), F.col("cumulative_descent_m")
    a = a.select("arc_id", "edge_id", "from_node", "to_node", "distance_m", "final_road_class", F.when(back, down).otherwise(up).alias("cumulative_ascent_m"), F.when(back, up).otherwise(down).alias("cumulative_descent_m"))
    return a.withColumn("time_min", fn.truck_minutes(F.col("distance_m"), F.col("final_road_class"), SPEEDS)).withColumn("truck_energy_kwh", fn.truck_energy(F.col("distance_m"), F.col("cumulative_ascent_m"), profile["truck"]))


def made_of(profile: dict, raw: dict) -> dict:
    """What a mother depends on: its settings, the grid, and the digests of its inputs."""
    inputs = {"population": raw["population"], "dem": raw["dem"], **{f"roads/{i}/{provider}/{licensed}": table for i, (provider, table, licensed) in enumerate(raw["roads"])}}
    hashes = {k: release.content_digest(v, k).first().digest for k, v in inputs.items()}
    settings = {k: profile[k] for k in ("demand", "roads", "truck")}
    return json.loads(json.dumps({"settings": settings, "grid": raw["grid"], "inputs": hashes}, sort_keys=True))


def mother_of(spark: SparkSession, profile: dict, raw: dict, root: str | None) -> tuple[dict[str, DataFrame], dict]:
    """(mother, note): that of ``root``'s release where it is made of the same, else a new one.

    A new one takes over the old one's profiles where the ground is the same and the edge, too.
    """
    own = made_of(profile, raw)
    if root is None:
        return build_mother(spark, profile, raw), {"reused": False, "made_of": own}
    old, _ = release.reuse_or_build(spark, f"{root}/registry/mother_network", MOTHER, dict)
    then = json.loads(release.read_text(spark, f"{root}/registry/mother_network/manifest.json")).get("made_of", {})
    if then == own:
        return old, {"reused": True, "made_of": own}
    same = then.get("grid") == own["grid"] and then.get("inputs", {}).get("dem") == own["inputs"]["dem"]
    known = (old["physical_edges"], old["elevation_profiles"]) if same else None
    mother = build_mother(spark, profile, raw, known)
    kept = mother["elevation_profiles"].join(old["physical_edges"].select("edge_id", F.col("pts").alias("p")), "edge_id").join(mother["physical_edges"].select("edge_id", "pts"), "edge_id").filter("p = pts").count() if same else 0
    return mother, {"reused": False, "profiles_reused": kept, "made_of": own}


def build_mother(spark: SparkSession, profile: dict, raw: dict, known: tuple[DataFrame, DataFrame] | None = None) -> dict[str, DataFrame]:
    """``raw``: population cells, dem cells, grid (x0, y0, cell_m) and road sources
    [(provider, roads, licence verified)], tried in order.  ``known``: see ``elevation_profiles``."""
    who = terminals(raw["population"], profile)
    depot = who.filter("is_depot").first().terminal_id
    services = who.select("terminal_id", F.col("x_m").alias("access_reference_x_m"), F.col("y_m").alias("access_reference_y_m"))
    rules = profile["roads"]
    tried, built = [], {}
    for provider, table, licensed in raw["roads"]:
        _, edges = roads.build_graph(roads.noded_segments(roads.open_roads(table)))
        edges, snaps = roads.insert_services(edges, services, rules["access_threshold_m"], junction_priority=rules.get("junction_priority", False))
        edges = materialize(roads.fill_secondary_gaps(edges, rules.get("gap_m", 750.0)), "edges")
        built[provider] = (edges, materialize(snaps, "snaps"))
        tried.append((provider, built[provider][1], roads.directed_arcs(edges), licensed))
        try:
            assessed = paths.choose_source(tried, depot, rules["max_inaccessible_percent"])
            break
        except GateError:
            if len(tried) == len(raw["roads"]):
                raise
    edges, snaps = built[assessed[-1]["provider"]]
    profiles = materialize(elevation_profiles(edges, raw["dem"], raw["grid"], known), "profiles")
    anchors = edges.select(F.explode(F.array(F.struct(F.col("from_node").alias("n"), F.element_at("pts", 1).alias("p")), F.struct(F.col("to_node").alias("n"), F.element_at("pts", -1).alias("p")))).alias("e")).groupBy("e.n").agg(F.min("e.p").alias("p"))
    placed = who.join(snaps, "terminal_id").join(anchors, F.col("truck_anchor_id") == F.col("n"), "left")
    ground = terrain.require_samples(terrain.sample_dem(who.select("terminal_id", F.col("x_m").alias("x"), F.col("y_m").alias("y")), raw["dem"], raw["grid"]["x0"], raw["grid"]["y0"], raw["grid"]["cell_m"]))
    placed = placed.join(ground.select("terminal_id", "z"), "terminal_id").select(
        "terminal_id", "population", "x_m", "y_m", "z", "is_depot", "truck_anchor_id", F.col("p.x").alias("anchor_x"), F.col("p.y").alias("anchor_y"), "distance_covered",
        F.when(F.col("distance_covered"), "active").otherwise("inaccessible").alias("truck_service_status"),
    )
    grid = spark.createDataFrame([tuple(float(raw["grid"][k]) for k in ("x0", "y0", "cell_m"))], "x0 double, y0 double, cell_m double")
    keep = ["attempt", "provider", "qualified", "demand_denominator", "inaccessible_count", "inaccessible_ratio", "depot_attached", "depot_terminal_id", "rule"]
    gate = spark.createDataFrame([tuple(r[k] for k in keep) for r in assessed], "attempt int, provider string, qualified boolean, demand_denominator long, inaccessible_count long, inaccessible_ratio double, depot_attached boolean, depot_terminal_id string, rule string")
    return {"terminals": materialize(placed, "placed"), "physical_edges": edges, "arc_costs": materialize(arc_costs(edges, profiles, profile), "arcs"), "elevation_profiles": profiles, "road_source_assessment": gate, "elevation_model": raw["dem"], "elevation_grid": grid}


def _grid(mother: dict[str, DataFrame]) -> dict:
    return mother["elevation_grid"].first().asDict()


def build_network(spark: SparkSession, mother: dict[str, DataFrame], scope: dict, profile: dict, reference: DataFrame | None) -> dict[str, DataFrame]:
    """One network: a scope (id, terminals or None for all, depot or None for the mother's).

    ``reference``: the frozen slopes that it is ranked against; without one, its own.
    """
    name = F.lit(scope["id"])
    who = mother["terminals"]
    if scope.get("terminals") is not None:
        who = who.join(spark.createDataFrame([(t,) for t in scope["terminals"]], "terminal_id string"), "terminal_id", "left_semi")
    if scope.get("depot") is not None:
        who = who.withColumn("is_depot", F.col("terminal_id") == scope["depot"])
    who = who.filter("truck_service_status = 'active'")
    if who.filter("is_depot").count() != 1:
        raise GateError(f"{scope['id']} must have exactly one active Depot")
    arcs = mother["arc_costs"]
    logical, lineage = paths.logical_network(arcs, who)
    logical, lineage = materialize(logical, "logical"), materialize(lineage, "lineage")
    costs = paths.lineage_costs(lineage, arcs).drop("distance_m", "time_min")
    edges_of = lineage.join(arcs.select("arc_id", "edge_id"), "arc_id").groupBy("contracted_logical_arc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "edge_id"))), lambda e: e["edge_id"]).alias("canonical_physical_edge_ids"))
    slopes = terrain.slope_features(logical.join(edges_of, "contracted_logical_arc_id"), mother["elevation_profiles"])
    slopes = materialize(slopes, "slopes")
    frozen = reference if reference is not None else materialize(terrain.freeze(slopes, "smean_percent"), "frozen-slopes")
    ranked = terrain.midrank_frozen(slopes, frozen, "smean_percent").drop("contracted_logical_connection_id")
    logical = logical.join(costs, "contracted_logical_arc_id").join(ranked, "contracted_logical_arc_id")

    e, demand = profile["energy"], who.filter("not is_depot")
    needs = demand.select("terminal_id", "population", fn.goods_kg(F.col("population"), e["kg_per_person"]).alias("goods_kg"), fn.household_energy_kwh(F.col("population"), e["household_size"], e["annual_household_kwh"]).alias("energy_kwh"))
    sites = who.select(F.col("truck_anchor_id").alias("source"))
    whole = paths.shortest_paths(arcs, sites, targets=sites.withColumnRenamed("source", "node"), max_minutes=service.MINUTES)
    at = who.select("terminal_id", F.col("truck_anchor_id").alias("anchor"))
    routes = whole.join(at.select(F.col("terminal_id").alias("site"), F.col("anchor").alias("source")), "source").join(at.select(F.col("terminal_id").alias("demand"), F.col("anchor").alias("node")), "node")
    routes = routes.select("site", "demand", (F.col("time_u") / 1e6).alias("time_min"), (F.col("distance_u") / 1e6).alias("distance_m"))
    people = demand.select(F.col("terminal_id").alias("demand"), "population")
    eligible = routes.join(people.select("demand"), "demand", "left_semi").join(people.select(F.col("demand").alias("site")), "site", "left_semi")
    assigned = materialize(service.min_site_cover(service.serviceable_pairs(eligible, people), people), "cover")

    c = who.select(name.alias("network_id"), "terminal_id", F.col("x_m").alias("x"), F.col("y_m").alias("y"), "anchor_x", "anchor_y")
    raw_legs, flat_legs = drone.raw_legs(c), drone.centroid_legs(c)
    pairs = drone.corridors(raw_legs.select("network_id", "origin", "destination", "distance_m").unionByName(flat_legs.select("network_id", "origin", "destination", "distance_m")))
    ground = drone.ground_along(pairs, c, profile["drone"].get("corridor_step_m", SAMPLE_STEP_M), mother["elevation_model"], _grid(mother))
    ground = ground.withColumn("z_max", F.col("z_max") + profile["drone"].get("corridor_margin_m", 0.0))
    legs, flat = (drone.cost_legs(drone.with_corridors(x, ground), profile["drone"]) for x in (raw_legs, flat_legs))

    s = profile["scenarios"]
    registry = scenarios.scenario_registry(spark.createDataFrame([(scope["id"],)], "network_id string"), s["enabled"], s.get("seed", 1))
    base = logical.select(name.alias("network_id"), F.col("contracted_logical_arc_id").alias("arc"), F.col("contracted_logical_connection_id").alias("connection"), "time_min", F.col("truck_energy_kwh").alias("energy_kwh"), F.col("midrank").alias("rank"))
    out = {
        "customers": who, "logical_arcs": logical, "lineage": lineage, "demands": needs, "microgrid": assigned, "backbone": paths.backbone(lineage, arcs), "drone_raw_legs": legs, "drone_centroid_legs": flat, "drone_corridors": ground,
        "frozen": frozen, "scenario_registry": registry, "scenario_arcs": scenarios.disrupted_arcs(base, registry, s.get("seed", 1)), "slopes": slopes,
    }
    return {k: v if "network_id" in v.columns else v.withColumn("network_id", name) for k, v in out.items()}


def violations(mother: dict[str, DataFrame], net: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The eleven checks as queries of violating rows."""
    who, arcs = net["customers"], mother["arc_costs"]
    sums = paths.lineage_costs(net["lineage"], arcs).select("contracted_logical_arc_id", F.col("time_min").alias("t"), F.col("distance_m").alias("d"))
    depots = who.groupBy("network_id").agg(F.count_if("is_depot").alias("n")).filter("n <> 1")
    legs = net["drone_raw_legs"].groupBy("network_id").agg(F.count(F.lit(1)).alias("legs")).join(who.groupBy("network_id").agg(F.count(F.lit(1)).alias("n")), "network_id")
    demands = net["demands"].select("network_id", F.col("terminal_id").alias("demand"), "population")
    served = net["microgrid"].groupBy("network_id", "demand").agg(F.count(F.lit(1)).alias("k"), F.sum("population").alias("served"))
    # The two arcs of an edge read one profile: what one climbs the other descends, and the one that climbs more needs more.
    way = lambda sign: arcs.filter(F.col("arc_id").endswith(sign)).select("edge_id", *[F.col(x).alias(f"{x}{sign}") for x in ("truck_energy_kwh", "cumulative_ascent_m", "cumulative_descent_m")])
    both = way("+").join(way("-"), "edge_id")
    up, kwh = F.col("`cumulative_ascent_m+`") - F.col("`cumulative_ascent_m-`"), F.col("`truck_energy_kwh+`") - F.col("`truck_energy_kwh-`")
    mirrored = (F.abs(F.col("`cumulative_ascent_m+`") - F.col("`cumulative_descent_m-`")) > 1e-6) | (F.abs(F.col("`cumulative_ascent_m-`") - F.col("`cumulative_descent_m+`")) > 1e-6)
    directional = both.filter(mirrored | ((F.abs(up) > 1e-6) & (up * kwh <= 0)) | ((F.abs(up) <= 1e-6) & (F.abs(kwh) > 1e-6))).select("edge_id")
    flat_kwh = directional.unionByName(arcs.filter("truck_energy_kwh <= 0 or cumulative_ascent_m < 0 or cumulative_descent_m < 0").select("edge_id"))
    places = mother["physical_edges"].select(F.explode(F.array(F.struct(F.col("from_node").alias("n"), F.element_at("pts", 1).alias("p")), F.struct(F.col("to_node").alias("n"), F.element_at("pts", -1).alias("p")))).alias("e")).select("e.n", "e.p.x", "e.p.y").groupBy("n").agg(F.min(F.struct("x", "y")).alias("p"))
    off = who.join(places, F.col("truck_anchor_id") == F.col("n"), "left").filter("n is null or abs(anchor_x - p.x) > 0.01 or abs(anchor_y - p.y) > 0.01 or x_m is null or y_m is null or x_m = 'NaN' or y_m = 'NaN'")
    return {
        "customer_coordinates": off,
        "depot_roles": depots,
        "directional_energy": flat_kwh,
        "microgrid_assignment_conservation": demands.join(served, ["network_id", "demand"], "full_outer").filter("coalesce(k, 0) <> 1 or abs(population - served) > 1e-9"),
        "no_synthetic_road_connectors": net["backbone"].join(mother["physical_edges"], "edge_id", "left_anti"),
        "population_conservation": who.join(mother["terminals"].select("terminal_id", F.col("population").alias("p")), "terminal_id", "left").filter("p is null or abs(p - population) > 1e-9"),
        "raw_drone_2NN_roles": legs.filter("legs <> 2 * n * n"),
        "real_source_lineage": mother["physical_edges"].filter("source_id is null"),
        "runtime_paths_active_only": net["logical_arcs"].select("network_id", F.explode(F.array("from_terminal", "to_terminal")).alias("terminal_id")).join(who.filter("truck_service_status = 'active'"), ["network_id", "terminal_id"], "left_anti"),
        "source_gate": mother["road_source_assessment"].groupBy().agg(F.max_by("qualified", "attempt").alias("q")).filter("not q"),
        "strict_lineage_and_cost_sums": net["logical_arcs"].join(sums, "contracted_logical_arc_id", "left").filter("t is null or abs(t - time_min) > 1e-6 or abs(d - distance_m) > 1e-6 or time_min <= 0 or from_terminal = to_terminal"),
    }


def run(spark: SparkSession, profile: dict, raw: dict, out: str, stage: str = "full", mother_root: str | None = None, reference_root: str | None = None) -> dict:
    """Builds and publishes a ``mother`` or a ``full`` release under ``out``; the manifest is returned.

    ``mother_root``: a release whose mother is used again if it is made of the same
    settings and inputs, and otherwise in what it shares.

    Slopes are ranked against a frozen table that is part of the release, with its
    digest in the manifest: that of ``reference_root``'s release, or else one made here.
    """
    validate_profile(profile)
    if release.exists(spark, out):
        raise GateError(f"{out} must be a new, unprotected path")
    used = release.input_registry(spark, profile.get("inputs", []))
    mother, how = mother_of(spark, profile, raw, mother_root)
    nested = {"registry/inputs": used, **{f"registry/mother_network/{k}": v for k, v in mother.items()}}
    if stage == "mother":
        return _publish(spark, nested, out, {"stage": stage, "mother": how})
    if reference_root is not None:
        (kept, _) = release.reuse_or_build(spark, reference_root, [FROZEN], dict)
        reference = kept[FROZEN]
    else:
        reference = build_network(spark, mother, {"id": "whole"}, profile, None)["frozen"].drop("network_id")
    nets = [build_network(spark, mother, scope, profile, reference) for scope in profile["scopes"]]
    tables = {k: reduce(DataFrame.unionByName, [n[k] for n in nets]) for k in nets[0] if k != "frozen"}
    counts = {"network_count": len(nets), "mother_terminals": mother["terminals"].count(), "scenario_count": tables["scenario_registry"].count(), "passed": True}
    return _publish(spark, nested | {FROZEN: reference} | {f"networks/{k}": v for k, v in tables.items()}, out, {"stage": stage, "mother": how, **counts}, lambda root: require_valid(spark, root))


def written(spark: SparkSession, root: str) -> tuple[dict[str, DataFrame], dict[str, dict[str, DataFrame]]]:
    """(mother, tables of each network) of a release's files."""
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    mother = {k: read(f"registry/mother_network/{k}") for k in MOTHER}
    tables = {k: read(f"networks/{k}") for k in CHECKED}
    names = [r.network_id for r in tables["customers"].select("network_id").distinct().orderBy("network_id").collect()]
    return mother, {n: {k: v.filter(F.col("network_id") == n) for k, v in tables.items()} for n in names}


def check_release(spark: SparkSession, root: str) -> dict[str, bool]:
    """Each check of a release by reading its files again: passed if no network has a violating row."""
    mother, nets = written(spark, root)
    found = [release.validate(violations(mother, net))["checks"] for net in nets.values()]
    return {k: all(c[k] for c in found) for k in found[0]}


def require_valid(spark: SparkSession, root: str) -> None:
    failed = sorted(k for k, ok in check_release(spark, root).items() if not ok)
    if failed:
        raise GateError(f"release checks failed: {failed}")


def _publish(spark: SparkSession, tables: dict, out: str, note: dict, check=None) -> dict:
    made = release.publish(spark, tables, out, note, check=check)
    inner = {k.rpartition("/")[2]: v for k, v in made["core_hashes"].items() if k.startswith("registry/mother_network/")}
    release.write_text(spark, f"{out}/registry/mother_network/manifest.json", json.dumps({"status": "published", "core_hashes": inner, "made_of": note["mother"]["made_of"]}))
    return made
