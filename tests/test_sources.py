import json
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.errors import GateError
from routeloom.operators import population, release, roads
from routeloom.sources import demo, geotiff, profile, vector


def test_geotiff_round_trip(spark, tmp_path):
    grid = np.arange(20, dtype=float).reshape(4, 5)
    grid[1, 2] = -9999
    for compress in (False, True):
        f = tmp_path / f"{compress}.tif"
        f.write_bytes(geotiff.encode(grid, 1000.0, 2000.0, 100.0, -9999, compress))
        rows = {(r.row, r.col): r for r in geotiff.read_grid(spark, f"file://{f}").collect()}
        assert len(rows) == 20 and rows[1, 2].value is None and rows[0, 0].value == 0.0 and rows[3, 4].value == 19.0
        assert (rows[0, 0].x, rows[0, 0].y) == (1050.0, 1950.0)
    assert geotiff.read_grid(spark, f"file://{tmp_path}/True.tif", drop_nodata=True).count() == 19
    with pytest.raises(ValueError):
        geotiff.tags(b"II" + b"\0" * 20)


def test_population_from_a_raster(spark, tmp_path):
    grid = np.zeros((20, 20))
    for r in demo.population(spark).collect():
        grid[r.row, r.col] = r.pop
    (tmp_path / "p.tif").write_bytes(geotiff.encode(grid, 0, 2000, 100))
    cells = geotiff.read_grid(spark, f"file://{tmp_path}/p.tif").select("row", "col", F.col("value").alias("pop"))
    nodes = population.demand_nodes(cells, official_total=1080.0)
    assert nodes.count() == 9 and nodes.agg(F.sum("population")).first()[0] == pytest.approx(1080)


def test_geopackage_and_prepare(spark, tmp_path):
    lines = [({"name": f"r{i}", "oneway": "no"}, [(0.0, i * 100.0), (50.0, i * 100.0)]) for i in range(6)] + [({"name": "far", "oneway": "yes"}, [(900.0, 900.0), (901.0, 901.0)])]
    (tmp_path / "r.gpkg").write_bytes(vector.write_geopackage(lines, "roads"))
    df = vector.read_geopackage(spark, f"file://{tmp_path}/r.gpkg", "roads")
    assert df.count() == 7 and json.loads(df.filter("fid = 6").first().attributes)["name"] == "far"
    ring = [(-10.0, -10.0), (60.0, -10.0), (60.0, 510.0), (-10.0, 510.0)]
    assert vector.prepare(df, ring, f"file://{tmp_path}/out") == {"feature_count": 6}
    assert vector.prepare(df, ring, f"file://{tmp_path}/one", selector=("name", "r3")) == {"feature_count": 1}
    assert vector.prepare(df, ring, f"file://{tmp_path}/near", buffer_m=1000.0) == {"feature_count": 7}
    (tmp_path / "b.gpkg").write_bytes(vector.write_geopackage([({"id": 1}, [(0, 0), (1, 0), (1, 1), (0, 0)])], "boundary", polygon=True))
    assert len(vector.read_geopackage(spark, f"file://{tmp_path}/b.gpkg", "boundary").first().pts) == 4
    with pytest.raises(Exception, match="no layer"):
        vector.read_geopackage(spark, f"file://{tmp_path}/b.gpkg", "roads").collect()


def varint(n):
    out = b""
    while True:
        n, b = n >> 7, n & 0x7F
        out += bytes([b | (0x80 if n else 0)])
        if not n:
            return out


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def packed(values, signed=False):
    return b"".join(varint((v << 1) ^ (v >> 63) if signed else v) for v in values)


def delta(values):
    return [b - a for a, b in zip([0, *values], values)]


def test_osm_pbf(spark, tmp_path):
    strings = field(1, b"") + field(1, b"highway") + field(1, b"primary") + field(1, b"oneway") + field(1, b"-1") + field(1, b"building")
    ids, lats, lons = [7, 3, 9], [-410000000, -410001000, -410002000], [1740000000, 1740001000, 1740002000]
    dense = field(1, packed(delta(ids), True)) + field(8, packed(delta(lats), True)) + field(9, packed(delta(lons), True))
    way = field(1, 100) + field(2, packed([1, 3])) + field(3, packed([2, 4])) + field(8, packed(delta([9, 7, 3]), True))
    house = field(1, 101) + field(2, packed([5])) + field(3, packed([4])) + field(8, packed(delta([9, 7]), True))
    block = field(1, strings) + field(2, field(2, dense)) + field(2, field(3, way) + field(3, house))
    blob = field(2, len(block)) + field(3, zlib.compress(block))
    head = field(1, b"OSMData") + field(3, len(blob))
    top = field(1, b"OSMHeader") + field(3, 2)
    (tmp_path / "x.osm.pbf").write_bytes(struct.pack(">I", len(top)) + top + field(1, b"") + struct.pack(">I", len(head)) + head + blob)
    rows = vector.read_osm_pbf(spark, f"file://{tmp_path}/x.osm.pbf").collect()
    assert len(rows) == 1 and rows[0].tags == {"highway": "primary", "oneway": "-1"}
    assert [(round(p.x, 4), round(p.y, 4)) for p in rows[0].pts] == [(174.0002, -41.0002), (174.0, -41.0), (174.0001, -41.0001)]


def test_demo_graph(spark):
    cut = roads.noded_segments(demo.roads(spark))
    nodes, edges = roads.build_graph(cut)
    assert (cut.count(), nodes.count()) == (24, 21)
    assert roads.directed_arcs(edges).count() == 48


def tables(spark):
    return {"nodes": spark.createDataFrame([("b", 2.0), ("a", 1.5)], "id string, x double"), "empty": spark.createDataFrame([], "id string")}


def test_publish_is_create_only_and_fails_clean(spark, tmp_path):
    root = f"file://{tmp_path}/release"
    first = release.publish(spark, tables(spark), root)
    assert first["status"] == "published" and set(first["core_hashes"]) == {"nodes", "empty"}
    with pytest.raises(GateError, match="new, unprotected"):
        release.publish(spark, tables(spark), root)
    second = release.publish(spark, {k: v.repartition(3) for k, v in tables(spark).items()}, root + "2", fmt="csv")
    assert second["core_hashes"] == first["core_hashes"]
    text = [p for p in (tmp_path / "release2/nodes").glob("*.csv")]
    assert len(text) == 1 and text[0].read_text() == "id,x\na,1.5\nb,2.0\n"

    def fails():
        raise GateError("gate")

    with pytest.raises(GateError, match="gate"):
        release.publish(spark, tables(spark) | {"bad": fails}, root + "3")
    assert not list(tmp_path.glob("release3*"))


def test_mother_reuse(spark, tmp_path):
    root = f"file://{tmp_path}/mother"
    release.publish(spark, tables(spark), root)
    got, reused = release.reuse_or_build(spark, root, ["nodes"], lambda: pytest.fail("built"))
    assert reused and got["nodes"].count() == 2
    assert release.reuse_or_build(spark, None, ["nodes"], lambda: tables(spark))[1] is False
    with pytest.raises(GateError):
        release.reuse_or_build(spark, root, ["roads"], dict)


def test_digests_and_comparison(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "")], "a int, b string")
    d = lambda x: release.content_digest(x, "t").first().digest
    assert d(df) == d(df.repartition(4)) != d(df.distinct())
    assert d(df) != d(df.fillna(""))
    one = spark.createDataFrame([("t", "1"), ("registry/x", "2"), ("u", "3")], "table string, digest string")
    two = spark.createDataFrame([("t", "1"), ("registry/x", "9"), ("u", "4"), ("v", "5")], "table string, digest string")
    assert {r.table for r in release.differences(release.science_keys(one), release.science_keys(two)).collect()} == {"u", "v"}


def test_bundle_of_a_published_release(spark, tmp_path):
    root, raw = f"file://{tmp_path}/release", tmp_path / "raw"
    raw.mkdir()
    (raw / "a.tif").write_bytes(b"1" * 1000)
    (raw / "b.gpkg").write_bytes(b"2")
    inputs = [{"path": f"file://{raw}/a.tif", "role": "dem", "redistribution_permitted": True}, {"path": f"file://{raw}/b.gpkg", "role": "roads", "redistribution_permitted": False}]
    with pytest.raises(GateError, match="no manifest"):
        release.bundle(spark, root, inputs, f"file://{tmp_path}/x.zip", True)
    release.publish(spark, tables(spark), root, fmt="csv")
    got = release.bundle(spark, root, inputs, f"file://{tmp_path}/x.zip", True)
    assert got["omitted_input_count"] == 1
    with zipfile.ZipFile(tmp_path / "x.zip") as z:
        names = z.namelist()
        assert got["members"] == len(names) and z.read("inputs/dem/a.tif") == b"1" * 1000
        assert {"release/manifest.json", "DATASET_BUNDLE_MANIFEST.json"} < set(names) and any(n.startswith("release/nodes/") for n in names)
        assert not any("gpkg" in n for n in names)
        assert [i["role"] for i in json.loads(z.read("DATASET_BUNDLE_MANIFEST.json"))["omitted_inputs"]] == ["roads"]
    with pytest.raises(GateError, match="new, unprotected"):
        release.bundle(spark, root, inputs, f"file://{tmp_path}/x.zip", True)
    assert release.bundle(spark, root, inputs, f"file://{tmp_path}/y.zip", False)["omitted_input_count"] == 2
    import shutil

    shutil.rmtree(tmp_path / "release/nodes")
    with pytest.raises(GateError, match="nodes"):
        release.bundle(spark, root, inputs, f"file://{tmp_path}/z.zip", True)
    assert sorted(p.name for p in tmp_path.iterdir() if p.suffix == ".zip") == ["x.zip", "y.zip"]
    df = spark.createDataFrame([(i["path"], i["redistribution_permitted"]) for i in inputs], "path string, redistribution_permitted boolean")
    assert [r.path for r in release.omitted_inputs(df).collect()] == [inputs[1]["path"]]


def test_profile_file(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps(profile.demo_profile(), indent=2))
    assert profile.validate_profile(profile.read_profile(spark, f"file://{tmp_path}/p.json"))["synthetic"]


def test_streaming_gate(spark, tmp_path):
    from routeloom.streaming import windowed_gate

    rows = [("2024-01-01 00:10:00", "a", True), ("2024-01-01 00:20:00", "b", False), ("2024-01-01 05:00:00", "c", True), ("2024-01-01 09:00:00", "d", True)]
    df = spark.createDataFrame(rows, "ts string, terminal_id string, distance_covered boolean").withColumn("ts", F.to_timestamp("ts"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = windowed_gate(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"))
    q = stream.writeStream.format("memory").queryName("gate").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {r.n: (r.uncovered, r.qualified) for r in spark.table("gate").collect()}
    assert got[2] == (1, False)
