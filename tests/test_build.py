import hashlib
import json

import pytest
from pyspark.sql import functions as F

from routeloom.errors import GateError
from routeloom.operators import release
from routeloom.plans import build
from routeloom.sources import demo, profile, tables


def inputs(spark, access=None, licensed=None):
    roads = demo.roads(spark)
    sources = [("osm", roads.withColumn("access", F.lit(access).cast("string")), True)]
    if licensed:
        sources.append((licensed, roads, True))
    return {"population": demo.population(spark), "dem": demo.elevation(spark), "grid": {"x0": -100.0, "y0": 2100.0, "cell_m": 10.0}, "roads": sources}


def settings(spark):
    p = profile.demo_profile()
    ids = sorted(f"T{r.row * 2**31 + r.col}" for r in demo.population(spark).collect())
    depot = f"T{2 * 2**31 + 2}"
    p["scopes"] = [{"id": "full", "terminals": None}, {"id": "part", "terminals": [depot, *[i for i in ids if i != depot][:5]]}]
    return p


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    root = f"file://{tmp_path_factory.mktemp('release')}/one"
    return root, build.run(spark, settings(spark), inputs(spark), root)


def test_full_release(spark, full):
    root, note = full
    assert note["status"] == "published" and note["passed"]
    assert (note["network_count"], note["mother_terminals"], note["scenario_count"]) == (2, 9, 12)
    read = lambda n: spark.read.parquet(f"{root}/{n}")
    count = lambda n: {r.network_id: r["count"] for r in read(n).groupBy("network_id").count().collect()}
    assert count("networks/drone_raw_legs") == {"full": 162, "part": 72}
    assert count("networks/drone_centroid_legs") == {"full": 144, "part": 60}
    assert read("networks/demands").filter("network_id = 'full'").agg(F.sum("population")).first()[0] == pytest.approx(1040)
    arcs = read("registry/mother_network/arc_costs")
    assert arcs.count() == 2 * read("registry/mother_network/physical_edges").count()
    pair = arcs.groupBy("edge_id").agg(F.count_distinct("truck_energy_kwh").alias("n"))
    assert pair.filter("n = 2").count() > 0  # uphill costs more than down


#: What is spoiled in which table, and the one check that must see it.
FAULTS = {
    "customer_coordinates": ("customers", lambda d: d.withColumn("anchor_x", F.when(F.col("is_depot"), F.col("anchor_x") + 1).otherwise(F.col("anchor_x")))),
    "depot_roles": ("customers", lambda d: d.withColumn("is_depot", F.lit(True))),
    "directional_energy": ("arc_costs", lambda d: d.withColumn("truck_energy_kwh", F.when(F.col("arc_id").endswith("+"), 0.0).otherwise(F.col("truck_energy_kwh")))),
    "microgrid_assignment_conservation": ("microgrid", lambda d: d.filter(F.col("demand") != d.agg(F.min("demand")).first()[0])),
    "no_synthetic_road_connectors": ("backbone", lambda d: d.unionByName(d.limit(1).withColumn("edge_id", F.lit("made up")))),
    "population_conservation": ("customers", lambda d: d.withColumn("population", F.col("population") + F.when(F.col("is_depot"), 5.0).otherwise(0.0))),
    "raw_drone_2NN_roles": ("drone_raw_legs", lambda d: d.unionByName(d.limit(1))),
    "real_source_lineage": ("physical_edges", lambda d: d.withColumn("source_id", F.when(F.col("length_m") < 0, F.col("source_id")))),
    "runtime_paths_active_only": ("logical_arcs", lambda d: d.withColumn("to_terminal", F.lit("elsewhere"))),
    "source_gate": ("road_source_assessment", lambda d: d.withColumn("qualified", F.lit(False))),
    "strict_lineage_and_cost_sums": ("lineage", lambda d: d.filter("position > 0")),
}


@pytest.mark.parametrize("name", FAULTS)
def test_each_check_sees_its_fault_in_the_files(spark, full, name):
    """The published files pass; with one table spoiled that check fails and no other does."""
    mother, nets = build.written(spark, full[0])
    table, spoil = FAULTS[name]
    mother = {k: spoil(v) if k == table else v for k, v in mother.items()}
    net = {k: spoil(v) if k == table else v for k, v in nets["full"].items()}
    found = release.validate(build.violations(mother, net))["checks"]
    assert [k for k, ok in found.items() if not ok] == [name]


def test_a_release_that_fails_its_checks_is_not_published(spark, full, tmp_path, monkeypatch):
    assert all(build.check_release(spark, full[0]).values())
    monkeypatch.setattr(build, "violations", lambda mother, net: {"never": net["customers"]})
    p = settings(spark)
    p["scopes"] = p["scopes"][1:]
    with pytest.raises(GateError, match="never"):
        build.run(spark, p, inputs(spark), f"file://{tmp_path}/bad", mother_root=full[0], reference_root=full[0])
    assert not list(tmp_path.iterdir())


def test_repeat_is_equal_and_mother_is_reused(spark, full, tmp_path):
    root, note = full
    again = build.run(spark, settings(spark), inputs(spark), f"file://{tmp_path}/two", mother_root=root)
    assert again["mother"]["reused"] and not note["mother"]["reused"]
    assert again["core_hashes"] == note["core_hashes"]
    with pytest.raises(GateError, match="new, unprotected"):
        build.run(spark, settings(spark), inputs(spark), root)


def test_what_changed_is_built_again_and_nothing_else(spark, full, tmp_path):
    """Other drones: the same mother.  One road moved: the profiles of all edges that stayed.  Other ground: none."""
    root, note = full
    p = settings(spark)
    p["scopes"] = p["scopes"][1:]
    p["drone"]["cruise_m_s"] = p["drone"]["cruise_m_s"] + 1
    assert build.mother_of(spark, p, inputs(spark), root)[1]["reused"]
    raw = inputs(spark)
    provider, roads, licensed = raw["roads"][0]
    moved = F.transform("pts", lambda q: F.struct((q["x"] + 3).alias("x"), (q["y"] + 2).alias("y")))
    raw["roads"] = [(provider, roads.withColumn("pts", F.when(F.col("source_id") == "road0", moved).otherwise(F.col("pts"))), licensed)]
    mother, how = build.mother_of(spark, p, raw, root)
    edges, old = mother["physical_edges"], spark.read.parquet(f"{root}/registry/mother_network/physical_edges")
    assert not how["reused"] and 0 < how["profiles_reused"] < edges.count()
    fresh = build.elevation_profiles(edges, raw["dem"], raw["grid"])
    assert sorted(map(str, mother["elevation_profiles"].select(fresh.columns).collect())) == sorted(map(str, fresh.collect()))
    assert edges.exceptAll(old.select(edges.columns)).count() > 0
    raw["dem"] = raw["dem"].withColumn("z", F.col("z") + 1)
    assert build.mother_of(spark, p, raw, root)[1]["profiles_reused"] == 0


def test_slopes_are_ranked_against_a_kept_table(spark, full, tmp_path):
    """A later release of one scope alone, ranked against the table of the first one."""
    root, note = full
    p = settings(spark)
    p["scopes"] = p["scopes"][1:]
    later = build.run(spark, p, inputs(spark), f"file://{tmp_path}/later", mother_root=root, reference_root=root)
    assert later["core_hashes"][build.FROZEN] == note["core_hashes"][build.FROZEN]
    rank = lambda r, k: {x.contracted_logical_arc_id: x.midrank for x in spark.read.parquet(f"{r}/networks/logical_arcs").filter(F.col("network_id") == k).collect()}
    assert rank(f"{tmp_path}/later", "part") == rank(root, "part")
    kept = spark.read.parquet(f"{root}/{build.FROZEN}")
    slopes = sorted(r.smean_percent for r in spark.read.parquet(f"{root}/networks/slopes").filter("network_id = 'full'").collect())
    assert sorted((r.value, r.n, r.below) for r in kept.collect()) == sorted({(v, slopes.count(v), sum(x < v for x in slopes)) for v in slopes})


def test_failed_gate_leaves_nothing_and_fallback_works(spark, tmp_path):
    out = f"file://{tmp_path}/fail"
    with pytest.raises(GateError, match="licensed_local_source_required"):
        build.run(spark, settings(spark), inputs(spark, "private"), out, stage="mother")
    assert not list(tmp_path.iterdir())
    note = build.run(spark, settings(spark), inputs(spark, "private", "LOCAL"), out, stage="mother")
    rows = spark.read.parquet(f"{out}/registry/mother_network/road_source_assessment").orderBy("attempt").collect()
    assert note["status"] == "published" and [(r.provider, r.qualified) for r in rows] == [("osm", False), ("LOCAL", True)]


def test_inputs_are_registered_with_licence_and_digest(spark, full, tmp_path):
    data = b"cells" * 50_000
    (tmp_path / "cells.bin").write_bytes(data)
    digest = hashlib.sha256(data).hexdigest()
    p = settings(spark)
    p["inputs"] = [{"role": "population", "path": f"file://{tmp_path}/cells.bin", "licence": "CC BY 4.0", "provider": "demo", "redistribution_permitted": True, "sha256": digest}, {"role": "dem", "path": f"file://{tmp_path}/cells.bin"}]
    note = build.run(spark, p, inputs(spark), f"file://{tmp_path}/out", stage="mother", mother_root=full[0])
    rows = {r.role: r for r in spark.read.parquet(f"{tmp_path}/out/registry/inputs").collect()}
    assert (rows["population"].sha256, rows["population"].n_bytes, rows["population"].licence, rows["population"].redistribution_permitted) == (digest, len(data), "CC BY 4.0", True)
    assert rows["dem"].licence is None and not rows["dem"].redistribution_permitted and "registry/inputs" in note["core_hashes"]
    for wrong, text in (({"sha256": "0" * 64}, "not the file"), ({"path": f"file://{tmp_path}/none"}, "missing")):
        p["inputs"][0] = p["inputs"][0] | wrong
        with pytest.raises(GateError, match=text):
            build.run(spark, p, inputs(spark), f"file://{tmp_path}/two", stage="mother", mother_root=full[0])


def test_missing_setting(spark, tmp_path):
    p = settings(spark)
    p["energy"]["annual_household_kwh"] = None
    with pytest.raises(GateError, match="annual_household_kwh"):
        build.run(spark, p, inputs(spark), f"file://{tmp_path}/x")


def test_csv_and_geojson(spark, tmp_path):
    prof = spark.createDataFrame([("e", [0.0, 1.5], [2.0, 3.0])], "edge_id string, sample_distances_m array<double>, smoothed_elevations_m array<double>")
    tables.with_json_arrays(prof).write.option("header", True).csv(f"{tmp_path}/p")
    assert tables.read_profiles_csv(spark, f"{tmp_path}/p").first() == prof.first()
    line = demo.roads(spark).limit(1).select(tables.geojson_line("pts", "source_id").alias("g")).first().g
    assert json.loads(line)["geometry"]["type"] == "LineString" and json.loads(line)["properties"]["source_id"] == "road0"
    with pytest.raises(Exception):
        tables.read_csv(spark, f"{tmp_path}/p", "arc").collect()
