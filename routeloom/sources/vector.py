"""GeoPackage layers and OSM PBF extracts as tables.  Files are read by Spark and decoded by executors."""

from __future__ import annotations

import json
import sqlite3
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import GateError
from ..operators.boundary import Boundary, Ring, clip

PTS = "array<struct<x:double,y:double>>"


# -- GeoPackage ------------------------------------------------------------------


def _wkb(data: bytes, at: int = 0) -> tuple[list[list[tuple[float, float]]], int]:
    """Point lists of a well-known binary geometry: its points, lines or rings."""
    order = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if kind & 0x20000000:
        at += 4
    dims = 2 + bool(kind & 0x80000000 or 1000 <= kind % 0x10000000 < 2000 or 3000 <= kind % 0x10000000) + bool(kind & 0x40000000 or kind % 0x10000000 >= 2000)
    base = (kind & 0x0FFFFFFF) % 1000

    def points(at: int, n: int) -> tuple[list[tuple[float, float]], int]:
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
        return [(flat[i], flat[i + 1]) for i in range(0, len(flat), dims)], at + 8 * dims * n

    if base == 1:
        p, at = points(at, 1)
        return [p], at
    (n,) = struct.unpack_from(order + "I", data, at)
    at += 4
    if base == 2:
        p, at = points(at, n)
        return [p], at
    out = []
    for _ in range(n):
        if base == 3:
            (k,) = struct.unpack_from(order + "I", data, at)
            p, at = points(at + 4, k)
            out.append(p)
        else:
            parts, at = _wkb(data, at)
            out += parts
    return out, at


def geopackage_rows(data: bytes, layer: str) -> Iterator[tuple[dict, list[list[tuple[float, float]]]]]:
    """(attributes, point lists) of each feature of a layer."""
    db = sqlite3.connect(":memory:")
    db.deserialize(data)
    db.row_factory = sqlite3.Row
    found = db.execute("select column_name from gpkg_geometry_columns where table_name = ?", (layer,)).fetchone()
    if found is None:
        raise GateError(f"no layer {layer}")
    geometry = found[0]
    for row in db.execute('select * from "' + layer.replace('"', '""') + '"'):
        blob = row[geometry]
        if blob is None:
            continue
        skip = 8 + (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7]
        yield {k: row[k] for k in row.keys() if k != geometry}, _wkb(bytes(blob), skip)[0]


def read_geopackage(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """(path, fid, part, attributes, pts): a row for each line or ring; attributes as JSON text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                rows = []
                for i, (attributes, parts) in enumerate(geopackage_rows(bytes(data), layer)):
                    text = json.dumps({k: v for k, v in attributes.items() if not isinstance(v, bytes)}, sort_keys=True)
                    rows += [(name, i, k, text, [{"x": x, "y": y} for x, y in p]) for k, p in enumerate(parts)]
                yield pd.DataFrame(rows, columns=["path", "fid", "part", "attributes", "pts"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"path string, fid int, part int, attributes string, pts {PTS}")


def write_geopackage(features: list[tuple[dict, list[tuple[float, float]]]], layer: str, polygon: bool = False, srs: int = 2193) -> bytes:
    """A layer of lines or one-ring polygons, small enough for the driver."""
    db = sqlite3.connect(":memory:")
    names = sorted({k for a, _ in features for k in a})
    db.execute("create table gpkg_geometry_columns (table_name text, column_name text, geometry_type_name text, srs_id int, z int, m int)")
    db.execute("create table gpkg_contents (table_name text, data_type text, identifier text, srs_id int)")
    db.execute("insert into gpkg_geometry_columns values (?, 'geom', ?, ?, 0, 0)", (layer, "POLYGON" if polygon else "LINESTRING", srs))
    db.execute("insert into gpkg_contents values (?, 'features', ?, ?)", (layer, layer, srs))
    columns = "".join(f', "{n}"' for n in names)
    db.execute(f'create table "{layer}" (fid integer primary key, geom blob{columns})')
    for a, pts in features:
        body = b"".join(struct.pack("<2d", *p) for p in pts)
        wkb = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", len(pts)) + body if polygon else struct.pack("<BII", 1, 2, len(pts)) + body
        db.execute(f'insert into "{layer}" (geom{columns}) values (?{", ?" * len(names)})', (b"GP\0\1" + struct.pack("<i", srs) + wkb, *[a.get(n) for n in names]))
    db.commit()
    return bytes(db.serialize())


# -- OSM PBF -----------------------------------------------------------------------


def _varint(data: bytes, at: int) -> tuple[int, int]:
    shift = out = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            v, at = _varint(data, at)
        elif key & 7 == 2:
            n, at = _varint(data, at)
            v, at = data[at : at + n], at + n
        else:
            n = {1: 8, 5: 4}[key & 7]
            v, at = data[at : at + n], at + n
        yield key >> 3, v


def _packed(data: bytes, signed: bool = False) -> list[int]:
    at, out = 0, []
    while at < len(data):
        v, at = _varint(data, at)
        out.append((v >> 1) ^ -(v & 1) if signed else v)
    return out


def _running(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def pbf_blocks(data: bytes) -> Iterator[bytes]:
    at = 0
    while at + 4 <= len(data):
        (n,) = struct.unpack_from(">I", data, at)
        head = dict(_fields(data[at + 4 : at + 4 + n]))
        at += 4 + n
        blob = dict(_fields(data[at : at + head[3]]))
        at += head[3]
        if head[1] == b"OSMData":
            yield blob[1] if 1 in blob else zlib.decompress(blob[3])


def pbf_elements(block: bytes) -> Iterator[tuple]:
    """('node', id, lon, lat) and ('way', id, tags, node ids)."""
    strings, groups, grain, lat0, lon0 = [], [], 100, 0, 0
    for k, v in _fields(block):
        if k == 1:
            strings = [s.decode("utf-8", "replace") for _, s in _fields(v)]
        elif k == 2:
            groups.append(v)
        elif k == 17:
            grain = v
        elif k == 19:
            lat0 = v
        elif k == 20:
            lon0 = v
    place = lambda v, zero: 1e-9 * (zero + grain * v)
    for g in groups:
        for k, v in _fields(g):
            if k == 1:
                f = dict(_fields(v))
                z = lambda n: (n >> 1) ^ -(n & 1)
                yield "node", z(f[1]), place(z(f[9]), lon0), place(z(f[8]), lat0)
            elif k == 2:
                f = dict(_fields(v))
                ids, lats, lons = (_running(_packed(f.get(i, b""), True)) for i in (1, 8, 9))
                for i, lat, lon in zip(ids, lats, lons):
                    yield "node", i, place(lon, lon0), place(lat, lat0)
            elif k == 3:
                f = dict(_fields(v))
                names, values = _packed(f.get(2, b"")), _packed(f.get(3, b""))
                yield "way", f[1], {strings[a]: strings[b] for a, b in zip(names, values)}, _running(_packed(f.get(8, b""), True))


def read_osm_pbf(spark: SparkSession, path: str, tag: str = "highway") -> DataFrame:
    """(way_id, tags, pts) of ways with ``tag``, in degrees and in order.

    Each file is decoded by one task, block by block; nodes meet their ways by a
    join, and only nodes that a kept way names are shuffled with it.
    """
    schema = "kind string, id long, lon double, lat double, tags map<string,string>, refs array<long>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["content"]:
                for block in pbf_blocks(bytes(data)):
                    rows = [(e[0], e[1], e[2], e[3], None, None) if e[0] == "node" else (e[0], e[1], None, None, e[2], e[3]) for e in pbf_elements(block) if e[0] == "node" or tag in e[2]]
                    yield pd.DataFrame(rows, columns=["kind", "id", "lon", "lat", "tags", "refs"])

    every = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)
    nodes = every.filter("kind = 'node'").select(F.col("id").alias("node"), "lon", "lat")
    ways = every.filter("kind = 'way'").select(F.col("id").alias("way_id"), "tags", "refs")
    at = ways.select("way_id", F.posexplode("refs").alias("i", "node")).join(nodes, "node")
    pts = at.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("i", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("p"))
    return ways.join(pts, "way_id").select("way_id", "tags", F.transform("p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("pts"))


def prepare(features: DataFrame, shape: DataFrame | Boundary | Ring, out: str, buffer_m: float = 0.0, selector: tuple[str, str] | None = None) -> dict:
    """Features with a vertex inside the boundary or its buffer, written as Parquet; the audit counts them.

    ``shape`` is a boundary's index, a table of rings (``read_geopackage`` gives one), or one ring's places.
    """
    df = features if selector is None else features.filter(F.get_json_object("attributes", f"$.{selector[0]}") == selector[1])
    ids = [c for c in df.columns if c != "pts"]
    inside = clip(df.select(*ids, F.explode("pts").alias("p")).select(*ids, F.col("p.x").alias("x"), F.col("p.y").alias("y")), shape, buffer_m).select(*ids).distinct()
    df.join(inside, ids, "left_semi").write.mode("errorifexists").parquet(out)
    return {"feature_count": df.sparkSession.read.parquet(out).count()}
