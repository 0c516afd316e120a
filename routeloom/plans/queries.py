"""One query for each operator of the model, over the bridge views, with the SQL that must agree with it."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import boundary, components, digest_tree, drone, overlay, paths, population, release, roads, scenarios, service, strong, terrain
from ..sources import geotiff, tables, vector
from ..sources.profile import demo_profile
from ..workspace import materialize, temporary, work_path
from . import bridges as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CFG = demo_profile()


def query(sql: str | None = None):
    """Registers a query under its function's name, and its SQL.

    A query that writes tables on the way gives its result as a table, too, and drops the others.
    """

    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            with temporary(spark) as made:
                out = f(spark, sf)
                if made:
                    out = materialize(out, f"query-{f.__name__}")
                    made.pop()
            return out

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = sql
        return run

    return add


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


# -- population ---------------------------------------------------------------

OFFICIAL = 10_000.0
_COMPONENTS = f"""
WITH RECURSIVE cell AS ({B.DENSE}),
t AS (SELECT sum(pop) AS total FROM cell),
k AS (SELECT CAST(r AS BIGINT) * 2147483648 + c AS id, r, c, pop * {OFFICIAL} / (SELECT total FROM t) AS pop FROM cell),
e AS (SELECT a.id AS a, b.id AS b FROM k a JOIN k b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1),
reach AS (SELECT id AS a, id AS b FROM k UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
lab AS (SELECT b AS id, min(a) AS component FROM reach GROUP BY b),
nodes AS (SELECT component, count(*) AS n_cells, sum(pop) AS population, sum(pop * (c + 0.5) * 100.0) / sum(pop) AS x_m, sum(pop * (r + 0.5) * 100.0) / sum(pop) AS y_m
          FROM k JOIN lab ON k.id = lab.id GROUP BY component)
"""


def dense_cells(spark: SparkSession, sf: str) -> DataFrame:
    return B.rows(spark, sf, B.DENSE).select(F.col("r").alias("row"), F.col("c").alias("col"), "pop")


@query(_COMPONENTS + "SELECT component, n_cells, round(population, 6) AS population, round(x_m, 6) AS x_m, round(y_m, 6) AS y_m FROM nodes")
def demand_components(spark: SparkSession, sf: str) -> DataFrame:
    """Threshold, calibration, 8-neighbour components, population and weighted centroid."""
    nodes = population.require_several(materialize(population.demand_nodes(dense_cells(spark, sf), official_total=OFFICIAL), "demand-nodes"))
    return nodes.select("component", "n_cells", *r6("population", "x_m", "y_m"))


@query(_COMPONENTS + "SELECT count(*) AS population_components_including_depot, count(*) FILTER (WHERE component <> (SELECT min(component) FROM nodes)) AS demand_nodes_excluding_depot, round(sum(population), 4) AS final_component_population_total FROM nodes")
def demand_audit(spark: SparkSession, sf: str) -> DataFrame:
    nodes = materialize(population.demand_nodes(dense_cells(spark, sf), official_total=OFFICIAL), "demand-nodes")
    depot = nodes.agg(F.min("component")).first()[0]
    return population.audit(nodes, depot).withColumn("final_component_population_total", F.round("final_component_population_total", 4))


@query(f"SELECT CAST(floor(r / 2) AS INTEGER) AS \"row\", CAST(floor(c / 2) AS INTEGER) AS col, sum(pop) AS pop FROM ({B.CELLS}) GROUP BY 1, 2")
def grid_resample_sum(spark: SparkSession, sf: str) -> DataFrame:
    return population.resample_sum(B.rows(spark, sf, B.CELLS).select(F.col("r").alias("row"), F.col("c").alias("col"), "pop"))


_WIDE = {"x0": -20.0, "y0": 4030.0, "cell_m": 130.0}


@query(f"""
WITH cell AS ({B.CELLS}), t AS (SELECT CAST(i AS INTEGER) AS i FROM (SELECT unnest(range(33)) AS i)),
w AS (SELECT t.i AS tr, u.i AS tc, pop, least((t.i + 1) * 130.0, r * 100.0 + 130.0) - greatest(t.i * 130.0, r * 100.0 + 30.0) AS h, least((u.i + 1) * 130.0, c * 100.0 + 120.0) - greatest(u.i * 130.0, c * 100.0 + 20.0) AS b FROM cell, t, t u)
SELECT tr AS "row", tc AS col, round(sum(pop * h * b / 10000), 6) AS pop FROM w WHERE h > 0 AND b > 0 GROUP BY 1, 2""")
def grid_resample_area(spark: SparkSession, sf: str) -> DataFrame:
    """100 m cells on a grid of 130 m that lies 20 m and 30 m off, by area."""
    cells = B.rows(spark, sf, B.CELLS).select(F.col("r").alias("row"), F.col("c").alias("col"), "pop")
    return population.resample_area(cells, {"x0": 0.0, "y0": 4000.0, "cell_m": 100.0}, _WIDE).withColumn("pop", F.round("pop", 6))


RING = [(100.0, 100.0), (1200.0, 250.0), (900.0, 800.0), (1300.0, 1400.0), (150.0, 1100.0)]
_SIDES = "SELECT * FROM (VALUES " + ", ".join(f"({a}, {b}, {c}, {d})" for (a, b), (c, d) in zip(RING, RING[1:] + RING[:1])) + ") s(x1, y1, x2, y2)"
_NEAREST = "sqrt(pow(x - (x1 + t * (x2 - x1)), 2) + pow(y - (y1 + t * (y2 - y1)), 2))"
_CLIP = f"""
WITH p AS ({B.CUSTOMER_POINTS}), s AS ({_SIDES}),
c AS (SELECT id, x, y, CASE WHEN (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1)) THEN 1 ELSE 0 END AS hit,
             greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t, x1, y1, x2, y2 FROM p, s)
SELECT id, x, y FROM c GROUP BY id, x, y HAVING sum(hit) % 2 = 1 OR min({_NEAREST}) <= """


@query(_CLIP + "50.0")
def boundary_buffer_clip(spark: SparkSession, sf: str) -> DataFrame:
    return population.clip(B.rows(spark, sf, B.CUSTOMER_POINTS).select("id", "x", "y"), RING, 50.0)


@query(_CLIP + "-1.0")
def boundary_clip(spark: SparkSession, sf: str) -> DataFrame:
    return population.clip(B.rows(spark, sf, B.CUSTOMER_POINTS).select("id", "x", "y"), RING)


_DETAIL = f"""
WITH p AS ({B.CUSTOMER_POINTS}), v AS ({B.RING_VERTICES}), m AS (SELECT ring, max(k) + 1 AS n FROM v GROUP BY ring),
s AS (SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN m ON a.ring = m.ring JOIN v b ON a.ring = b.ring AND b.k = (a.k + 1) % m.n),
c AS (SELECT id, x, y, CASE WHEN (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1)) THEN 1 ELSE 0 END AS hit,
             greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t, x1, y1, x2, y2 FROM p, s)
SELECT id, x, y FROM c GROUP BY id, x, y HAVING sum(hit) % 2 = 1 OR min({_NEAREST}) <= """


def detailed_boundary(spark: SparkSession, sf: str, buffer_m: float = 0.0) -> boundary.Boundary:
    """Rings with a vertex for every order, customer and part: an outer one, holes and an island."""
    return boundary.boundary(boundary.vertex_edges(B.rows(spark, sf, B.RING_VERTICES)), buffer_m)


@query(_DETAIL + "-1.0")
def boundary_detail_clip(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' points against a boundary that has as many vertices as the tables have orders, customers and parts."""
    return detailed_boundary(spark, sf).clip(B.rows(spark, sf, B.CUSTOMER_POINTS).select("id", "x", "y"))


@query(_DETAIL + "5.0")
def boundary_detail_buffer(spark: SparkSession, sf: str) -> DataFrame:
    return detailed_boundary(spark, sf, 5.0).clip(B.rows(spark, sf, B.CUSTOMER_POINTS).select("id", "x", "y"))


# -- scalars --------------------------------------------------------------------


@query("SELECT s_suppkey, CAST(CAST(round(CAST(s_suppkey AS DECIMAL(10,0)) * CAST('97.0383343707' AS DECIMAL(14,10)) * 2, 3) AS DECIMAL(24,3)) AS VARCHAR) AS goods_kg FROM supplier")
def goods_mass(spark: SparkSession, sf: str) -> DataFrame:
    df = B.rows(spark, sf, "SELECT s_suppkey, CAST(s_suppkey AS DECIMAL(10,0)) * CAST('97.0383343707' AS DECIMAL(14,10)) AS people FROM supplier")
    return df.select("s_suppkey", fn.goods_kg(F.col("people"), 2).alias("goods_kg"))


SPEEDS = {"secondary": 60.0, "residential": 35.0}
_T = CFG["truck"]


@query(f"SELECT arc_id, round(distance_m / 1000 * {_T['flat_kwh_per_km']} + (ak * 3.0) * {_T['mass_kg'] * _T['gravity_m_s2'] / (_T['uphill_efficiency'] * 3.6e6)}, 6) AS truck_energy_kwh, round(distance_m / 1000 / CASE WHEN ak % 2 = 0 THEN 60.0 ELSE 35.0 END * 60, 6) AS time_min FROM ({B.ARCS})")
def truck_costs(spark: SparkSession, sf: str) -> DataFrame:
    arcs = B.rows(spark, sf, B.ARCS)
    kind = F.when(F.col("ak") % 2 == 0, "secondary").otherwise("residential")
    return arcs.select("arc_id", fn.truck_energy(F.col("distance_m"), F.col("ak") * 3.0, _T).alias("truck_energy_kwh"), fn.truck_minutes(F.col("distance_m"), kind, SPEEDS).alias("time_min")).select("arc_id", *r6("truck_energy_kwh", "time_min"))


@query(f"SELECT terminal_id, round(w / 2.7 * 7000.0 / 8760 * 12.0 * 0.35, 6) AS energy_kwh FROM ({B.TERMINALS}) WHERE k <> 0")
def household_energy(spark: SparkSession, sf: str) -> DataFrame:
    e = CFG["energy"]
    t = B.rows(spark, sf, B.TERMINALS).filter("k <> 0")
    return t.select("terminal_id", F.round(fn.household_energy_kwh(F.col("w"), e["household_size"], e["annual_household_kwh"]), 6).alias("energy_kwh"))


@query("SELECT p_partkey, p_brand AS brand, 'a\"b\\' || p_type AS kind, CAST(NULL AS VARCHAR) AS nothing, CASE WHEN p_partkey % 2 = 0 THEN '-1' END AS oneway FROM part")
def hstore_tags(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.lit('"brand"=>"'), "p_brand", F.lit('", "kind"=>"a\\"b\\\\'), "p_type", F.lit('","nothing"=>NULL'), F.when(F.col("p_partkey") % 2 == 0, ',"oneway"=>"-1"').otherwise(""))
    tags = spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", fn.hstore(text).alias("t"))
    return tags.select("p_partkey", *[F.try_element_at("t", F.lit(k)).alias(k) for k in ("brand", "kind", "nothing", "oneway")])


@query("SELECT user_id, to_json(list(event_id ORDER BY event_id)) AS ids_json, len(list(event_id)) AS n FROM events GROUP BY user_id")
def json_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays to JSON text and back."""
    df = B.rows(spark, sf, "SELECT user_id, event_id FROM events").groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_list("event_id"))).alias("ids_json"))
    return df.withColumn("n", F.size(F.from_json("ids_json", "array<bigint>")).cast("long"))


@query("SELECT page_id, url, CASE WHEN url IS NULL THEN 'manual_download_required' WHEN regexp_matches(coalesce(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), ''), '(?i)(^|[&;])(ref|token)=') OR regexp_matches(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*@') THEN 'credential-bearing' ELSE 'dry_run' END AS status FROM pages")
def download_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The gate on credential-bearing URLs, with ``ref`` standing for a credential's name."""
    df = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    bad = fn.has_credentials(F.col("url"), "ref|token")
    return df.withColumn("status", F.when(F.col("url").isNull(), "manual_download_required").when(bad, "credential-bearing").otherwise("dry_run"))


#: A catalogue of all pages: some without a URL, some with a user in it, some whose host is not among the allowed ones.
_CATALOGUE = """
SELECT 'page/' || CAST(page_id AS STRING) AS role, page_id % 3 AS kind, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
       CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id % 11 = 5 THEN replace(url, '://', '://user@') ELSE url END END AS download_url FROM pages"""


@query(f"""
SELECT role, CASE WHEN download_url IS NULL THEN 'manual_download_required' WHEN regexp_matches(download_url, '^[a-z]+://[^/?#]*@') THEN 'credential-bearing'
       WHEN kind = 2 AND host <> 'example.org' THEN 'host_not_allowed' ELSE 'dry_run' END AS status FROM ({_CATALOGUE})""")
def download_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """The plan for a catalogue with allowed hosts: none stated, the page's own, or another."""
    hosts = F.when(F.col("kind") == 1, F.array("host")).when(F.col("kind") == 2, F.array(F.lit("example.org")))
    return release.download_plan(B.rows(spark, sf, _CATALOGUE).withColumn("allowed_hosts", hosts)).select("role", "status")


# -- terrain ---------------------------------------------------------------------


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    pts = B.rows(spark, sf, B.PROFILE_POINTS)
    each = pts.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("i", "d", "z"))).alias("p"))
    return each.select(F.col("user_id").cast("string").alias("edge_id"), F.transform("p", lambda p: p["d"].cast("double")).alias("sample_distances_m"), terrain.smooth(F.transform("p", lambda p: p["z"])).alias("smoothed_elevations_m"))


_SMOOTH = f"""
WITH p AS ({B.PROFILE_POINTS}),
s AS (SELECT user_id, i, d, avg(z) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS z FROM p),
g AS (SELECT user_id, i, d, z, z - lag(z) OVER (PARTITION BY user_id ORDER BY i) AS dz, d - lag(d) OVER (PARTITION BY user_id ORDER BY i) AS dx FROM s)
"""


@query(_SMOOTH + "SELECT CAST(user_id AS VARCHAR) AS edge_id, count(*) AS n, round(sum(z), 5) AS z_sum, round(coalesce(sum(greatest(dz, 0)), 0), 5) AS ascent, round(coalesce(sum(greatest(-dz, 0)), 0), 5) AS descent, round(coalesce(sum(greatest(-dz, 0)), 0), 5) AS ascent_back FROM g GROUP BY user_id")
def elevation_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Three-point smoothing, cumulative ascent and descent, and the reverse profile's ascent."""
    p = profiles(spark, sf)
    z = F.col("smoothed_elevations_m")
    costs = p.select("edge_id", F.size(z).cast("long").alias("n"), F.round(F.aggregate(z, F.lit(0.0), lambda a, b: a + b), 5).alias("z_sum"), F.round(terrain.ascent(z), 5).alias("ascent"), F.round(terrain.descent(z), 5).alias("descent"), terrain.ascent(F.reverse(z)).alias("b"))
    return costs.withColumn("ascent_back", F.round("b", 5)).drop("b")


@query(_SMOOTH + """, e AS (SELECT user_id, max(abs(dz) / dx * 100) AS smax, sum(abs(dz)) AS climb, sum(dx) AS run FROM g GROUP BY user_id HAVING count(*) > 1)
SELECT 'L' || CAST(user_id % 10 AS VARCHAR) AS contracted_logical_arc_id, 'K' || CAST(user_id % 10 AS VARCHAR) AS contracted_logical_connection_id, round(max(smax), 5) AS smax_percent, round(sum(climb) / sum(run) * 100, 5) AS smean_percent FROM e GROUP BY user_id % 10""")
def slope_features(spark: SparkSession, sf: str) -> DataFrame:
    """Slopes within edges along logical arcs of many edges."""
    p = profiles(spark, sf).filter(F.size("sample_distances_m") > 1)
    group = (F.col("edge_id").cast("long") % 10).cast("string")
    lineage = p.groupBy(F.concat(F.lit("L"), group).alias("contracted_logical_arc_id"), F.concat(F.lit("K"), group).alias("contracted_logical_connection_id")).agg(F.collect_list("edge_id").alias("canonical_physical_edge_ids"))
    out = terrain.slope_features(lineage, p)
    return out.withColumn("smax_percent", F.round("smax_percent", 5)).withColumn("smean_percent", F.round("smean_percent", 5))


@query("SELECT c_custkey, c_acctbal, round((SELECT (count(*) FILTER (WHERE s_acctbal < c_acctbal) + 0.5 * count(*) FILTER (WHERE s_acctbal = c_acctbal)) / count(*) FROM supplier), 9) AS midrank FROM customer")
def midrank(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of values in a frozen reference that need not hold them."""
    values = B.rows(spark, sf, "SELECT c_custkey, c_acctbal FROM customer")
    reference = B.rows(spark, sf, "SELECT s_acctbal AS c_acctbal FROM supplier")
    return terrain.midrank(values, reference, "c_acctbal").withColumn("midrank", F.round("midrank", 9))


_DEM = f"SELECT r, c, CASE WHEN pop % 7 = 0 THEN NULL ELSE pop END AS z FROM ({B.CELLS})"


@query(f"""
WITH dem AS ({_DEM}), p AS (SELECT id, x * 0.3 AS x, y * 0.3 AS y FROM ({B.CUSTOMER_POINTS})),
f AS (SELECT id, x, y, x / 10.0 - 0.5 AS fc, (400.0 - y) / 10.0 - 0.5 AS fr FROM p),
k AS (SELECT f.*, i, j, floor(fr) + i AS rr, floor(fc) + j AS cc, (CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) AS w
      FROM f, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j)),
m AS (SELECT id, count(dem.r) AS n, count(z) AS nz, sum(w * z) AS z FROM k LEFT JOIN dem ON dem.r = rr AND dem.c = cc GROUP BY id)
SELECT id, CASE WHEN n < 4 THEN 'interpolation margin' WHEN nz < 4 THEN 'nodata' ELSE 'ok' END AS status, CASE WHEN nz = 4 THEN round(z, 6) END AS z FROM m""")
def dem_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    dem = B.rows(spark, sf, _DEM).select(F.col("r").alias("row"), F.col("c").alias("col"), "z")
    pts = B.rows(spark, sf, B.CUSTOMER_POINTS).select("id", (F.col("x") * 0.3).alias("x"), (F.col("y") * 0.3).alias("y"))
    return terrain.sample_dem(pts, dem, 0.0, 400.0, 10.0).select("id", "status", F.round("z", 6).alias("z"))


# -- roads -------------------------------------------------------------------------


def streets(spark: SparkSession, sf: str) -> DataFrame:
    point = lambda i: F.struct(F.col(f"x{i}").cast("double").alias("x"), F.col(f"y{i}").cast("double").alias("y"))
    return B.rows(spark, sf, B.STREETS).select("source_id", "k", "grade_key", "road_class", "oneway", "access", F.array(point(1), point(2), point(3)).alias("pts"))


def street_graph(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return roads.build_graph(roads.noded_segments(roads.open_roads(streets(spark, sf))))


def placed_services(spark: SparkSession, sf: str) -> DataFrame:
    points = B.rows(spark, sf, B.PLACED_POINTS)
    return points.select(F.col("id").cast("string").alias("terminal_id"), F.col("x").cast("double").alias("access_reference_x_m"), F.col("y").cast("double").alias("access_reference_y_m"))


#: Each pair of pieces of one grade by the textbook's formula; a place within 1.5 mm of an end is that end.
#: ``c`` has the places inside streets, ``n`` the streets with their number of edges.
_CUTS = f"""
WITH g AS ({B.PIECES}),
w AS (SELECT p.source_id AS ps, q.source_id AS qs, p.seq AS pn, q.seq AS qn, p.ax, p.ay, p.bx - p.ax AS px, p."by" - p.ay AS py, q.bx - q.ax AS qx, q."by" - q.ay AS qy, q.ax - p.ax AS dx, q.ay - p.ay AS dy
      FROM g p JOIN g q ON p.grade_key = q.grade_key AND p.source_id < q.source_id),
v AS (SELECT *, (dx * qy - dy * qx) / (px * qy - py * qx) AS t, (dx * py - dy * px) / (px * qy - py * qx) AS u, 0.0015 / sqrt(px * px + py * py) AS et, 0.0015 / sqrt(qx * qx + qy * qy) AS eu FROM w WHERE px * qy - py * qx <> 0),
x AS (SELECT ps, qs, ax + t * px AS x, ay + t * py AS y, pn + CASE WHEN abs(t) <= et THEN 0 WHEN abs(t - 1) <= et THEN 1 ELSE t END AS pc, qn + CASE WHEN abs(u) <= eu THEN 0 WHEN abs(u - 1) <= eu THEN 1 ELSE u END AS qc
      FROM v WHERE t BETWEEN -et AND 1 + et AND u BETWEEN -eu AND 1 + eu),
c AS (SELECT source_id, round(pos, 7) AS pos FROM (SELECT ps AS source_id, pc AS pos FROM x UNION ALL SELECT qs, qc FROM x) WHERE pos > 0 AND pos < 2 GROUP BY 1, 2),
k AS (SELECT source_id, count(*) AS n FROM c GROUP BY 1),
m AS (SELECT source_id, sum(sqrt((bx - ax) * (bx - ax) + ("by" - ay) * ("by" - ay))) AS length_m FROM g GROUP BY 1),
n AS (SELECT s.source_id, coalesce(k.n, 0) + 1 AS n_edges, length_m, road_class, oneway FROM ({B.STREETS}) s JOIN m ON s.source_id = m.source_id LEFT JOIN k ON s.source_id = k.source_id)
"""


@query(_CUTS + "SELECT source_id, n_edges, round(length_m, 2) AS length_m FROM n")
def road_noding(spark: SparkSession, sf: str) -> DataFrame:
    """Open streets cut at same-grade crossings; their length is kept but for the precision."""
    cut = roads.noded_segments(roads.open_roads(streets(spark, sf)))
    return cut.withColumn("m", roads.length_m()).groupBy("source_id").agg(F.count(F.lit(1)).alias("n_edges"), F.round(F.sum("m"), 2).alias("length_m"))


@query(_CUTS + """, ends AS (SELECT source_id, x1 AS x, y1 AS y FROM (%s) WHERE access IS NULL UNION ALL SELECT source_id, x3, y3 FROM (%s) WHERE access IS NULL),
met AS (SELECT DISTINCT round(x, 2) AS x, round(y, 2) AS y FROM x),
loose AS (SELECT * FROM ends WHERE NOT EXISTS (SELECT 1 FROM x WHERE abs(x.x - ends.x) < 0.01 AND abs(x.y - ends.y) < 0.01 AND source_id IN (ps, qs)))
SELECT (SELECT count(*) FROM met) + (SELECT count(*) FROM loose) AS n_nodes, (SELECT CAST(sum(n_edges) AS BIGINT) FROM n) AS n_edges""" % (B.STREETS, B.STREETS))
def road_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Streets that meet share one node: nodes are the places where they meet and the loose ends."""
    nodes, edges = street_graph(spark, sf)
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).join(edges.agg(F.count(F.lit(1)).alias("n_edges")))


@query(_CUTS + "SELECT source_id, CASE WHEN oneway = '-1' THEN 0 ELSE n_edges END AS n_forward, CASE WHEN oneway = 'yes' THEN 0 ELSE n_edges END AS n_reverse, road_class AS final_road_class FROM n")
def directed_graph(spark: SparkSession, sf: str) -> DataFrame:
    """Arcs by direction of the noded streets."""
    _, edges = street_graph(spark, sf)
    arcs = roads.directed_arcs(edges).join(edges.select("edge_id", "source_id"), "edge_id")
    return arcs.groupBy("source_id", "final_road_class").agg(F.count_if(F.col("arc_id").endswith("+")).alias("n_forward"), F.count_if(F.col("arc_id").endswith("-")).alias("n_reverse"))


_TO_PIECE = """greatest(0.0, least(1.0, ((x - ax) * (bx - ax) + (y - ay) * ("by" - ay)) / ((bx - ax) * (bx - ax) + ("by" - ay) * ("by" - ay))))"""


@query(f"""
WITH g AS ({B.PIECES}), p AS ({B.PLACED_POINTS}),
t AS (SELECT id, x, y, ax, ay, bx, "by", {_TO_PIECE} AS t FROM p, g),
m AS (SELECT id, min(sqrt(pow(x - (ax + t * (bx - ax)), 2) + pow(y - (ay + t * ("by" - ay)), 2))) AS d FROM t GROUP BY id)
SELECT CAST(id AS VARCHAR) AS terminal_id, d <= 60.0 AS distance_covered, CASE WHEN d <= 60.0 THEN round(d, 5) END AS distance_m FROM m""")
def service_snaps(spark: SparkSession, sf: str) -> DataFrame:
    """Services to their nearest place on a street, not noded here, within 60 m, ends included."""
    whole = roads.open_roads(streets(spark, sf)).withColumn("segment_id", F.col("source_id"))
    _, snaps = roads.insert_services(roads.build_graph(whole)[1], placed_services(spark, sf), 60.0)
    return snaps.select("terminal_id", "distance_covered", F.round("distance_m", 5).alias("distance_m"))


@query(_CUTS + "SELECT source_id, round(length_m, 1) AS length_m, true AS on_geometry FROM n")
def split_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Splitting edges at anchors keeps every metre on the streets: no point of a part is off its street's pieces."""
    out, _ = roads.insert_services(street_graph(spark, sf)[1], placed_services(spark, sf), 60.0)
    street = streets(spark, sf).select("source_id", F.col("pts").alias("street"))

    def near(p):
        pieces = F.sequence(F.lit(0), F.size("street") - 2)
        end = lambda i, axis: F.get("street", i)[axis]
        return F.exists(pieces, lambda i: fn.segment_distance(p["x"], p["y"], end(i, "x"), end(i, "y"), end(i + 1, "x"), end(i + 1, "y")) < 0.003)

    lying = out.join(street, "source_id").select("source_id", "length_m", F.forall("pts", near).alias("on"))
    return lying.groupBy("source_id").agg(F.round(F.sum("length_m"), 1).alias("length_m"), F.every("on").alias("on_geometry"))


_CHAIN = "SELECT 'G' || CAST(n_nationkey AS STRING) AS edge_id, 'V' || CAST(n_nationkey AS STRING) AS from_node, 'V' || CAST(n_nationkey + 1 AS STRING) AS to_node, CAST((n_nationkey * 377) % 1000 AS DOUBLE) AS length_m, CASE WHEN n_nationkey % 2 = 0 THEN 'secondary' ELSE 'residential' END AS final_road_class, n_nationkey AS k FROM nation WHERE n_nationkey % 5 <> 4"


@query(f"WITH e AS ({_CHAIN}), n AS (SELECT from_node AS v FROM e WHERE final_road_class = 'secondary' UNION SELECT to_node FROM e WHERE final_road_class = 'secondary') SELECT edge_id, CASE WHEN final_road_class = 'residential' AND length_m <= 750 AND from_node IN (SELECT v FROM n) AND to_node IN (SELECT v FROM n) THEN 'secondary' ELSE final_road_class END AS final_road_class FROM e")
def secondary_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return roads.fill_secondary_gaps(B.rows(spark, sf, _CHAIN)).select("edge_id", "final_road_class")


# -- paths ---------------------------------------------------------------------------


def arcs(spark: SparkSession, sf: str) -> DataFrame:
    return B.rows(spark, sf, B.ARCS)


def terminals(spark: SparkSession, sf: str) -> DataFrame:
    return B.rows(spark, sf, B.SERVED).select("terminal_id", F.col("node").alias("truck_anchor_id"), "truck_service_status", "region", "k")


def _paths_sql(anchors: str, blocked: str) -> str:
    """Best simple paths from each anchor, not passing ``blocked`` nodes; eight arcs reach all of a grid of 5 x 5, and more cost more."""
    return f"""
WITH RECURSIVE arc AS ({B.ARCS}), anchor AS ({anchors}),
walk AS (
  SELECT node AS source, node, CAST(0 AS BIGINT) AS t, CAST(0 AS BIGINT) AS d, CAST([] AS VARCHAR[]) AS ids, [node] AS seen FROM anchor
  UNION ALL
  SELECT source, to_node, t + CAST(round(time_min * 1000000) AS BIGINT), d + CAST(round(distance_m * 1000000) AS BIGINT), list_append(ids, arc_id), list_append(seen, to_node)
  FROM walk JOIN arc ON walk.node = arc.from_node
  WHERE NOT list_contains(seen, to_node) AND len(ids) < 8 AND (walk.node = source OR walk.node NOT IN (SELECT node FROM ({blocked})))),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, node ORDER BY t, d, ids) AS n FROM walk) WHERE n = 1)
"""


_EVERY = f"SELECT node FROM ({B.TERMINALS})"


@query(_paths_sql(_EVERY, "SELECT node FROM anchor WHERE false") + "SELECT source, node, t AS time_u, d AS distance_u, array_to_string(ids, ',') AS arc_ids FROM best")
def shortest_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Least time, then distance, then arc ids, from every node of the grid to every other."""
    out = paths.shortest_paths(arcs(spark, sf), B.rows(spark, sf, _EVERY).select(F.col("node").alias("source")))
    return out.withColumn("arc_ids", F.array_join("arc_ids", ","))


_ANCHORS = f"SELECT node FROM ({B.ACTIVE})"
_LOGICAL = _paths_sql(_ANCHORS, "SELECT node FROM anchor") + ", logical AS (SELECT 'T' || substr(source, 2) || '>' || 'T' || substr(node, 2) AS contracted_logical_arc_id, 'T' || least(substr(source, 2), substr(node, 2)) || '~' || 'T' || greatest(substr(source, 2), substr(node, 2)) AS contracted_logical_connection_id, t, d, ids FROM best WHERE source <> node AND node IN (SELECT node FROM anchor))\n"


@query(_LOGICAL + "SELECT contracted_logical_arc_id, contracted_logical_connection_id, round(t / 1e6, 6) AS time_min, round(d / 1e6, 6) AS distance_m, array_to_string(ids, ',') AS lineage FROM logical")
def logical_network(spark: SparkSession, sf: str) -> DataFrame:
    """Strict arcs between anchors that block one another."""
    logical, _ = paths.logical_network(arcs(spark, sf), terminals(spark, sf))
    return logical.select("contracted_logical_arc_id", "contracted_logical_connection_id", *r6("time_min", "distance_m"), F.array_join("canonical_directed_physical_arc_ids", ",").alias("lineage"))


@query(_LOGICAL + ", u AS (SELECT contracted_logical_arc_id, unnest(ids) AS arc_id FROM logical) SELECT contracted_logical_arc_id, round(sum(distance_m), 6) AS distance_m, round(sum(time_min), 6) AS time_min, count(*) AS n_arcs FROM u JOIN arc USING (arc_id) GROUP BY 1")
def lineage_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Logical costs summed again from the physical arcs."""
    a = arcs(spark, sf)
    _, lineage = paths.logical_network(a, terminals(spark, sf))
    return paths.lineage_costs(lineage, a).select("contracted_logical_arc_id", *r6("distance_m", "time_min"), "n_arcs")


@query(_LOGICAL + ", u AS (SELECT unnest(ids) AS arc_id FROM logical) SELECT DISTINCT edge_id FROM u JOIN arc USING (arc_id)")
def backbone_edges(spark: SparkSession, sf: str) -> DataFrame:
    a = arcs(spark, sf)
    _, lineage = paths.logical_network(a, terminals(spark, sf))
    return paths.backbone(lineage, a)


@query(_paths_sql(_EVERY, "SELECT node FROM anchor WHERE false") + "SELECT source, node, t AS time_u, d AS distance_u, array_to_string(ids, ',') AS arc_ids FROM best")
def paths_by_joins(spark: SparkSession, sf: str) -> DataFrame:
    """The same paths by relaxation, the way that graphs too large to send around go."""
    sources = B.rows(spark, sf, _EVERY).select(F.col("node").alias("source"))
    return paths.relax(paths.costed(arcs(spark, sf)), sources).withColumn("arc_ids", F.array_join("arc_ids", ","))


@query(_paths_sql(_ANCHORS, "SELECT node FROM anchor") + "SELECT source, node, t AS time_u, d AS distance_u, array_to_string(ids, ',') AS arc_ids FROM best WHERE source <> node AND node IN (SELECT node FROM anchor)")
def strict_paths_by_joins(spark: SparkSession, sf: str) -> DataFrame:
    """Strict paths by relaxation: anchors end each other's paths."""
    anchors = B.rows(spark, sf, _ANCHORS)
    found = paths.relax(paths.costed(arcs(spark, sf)), anchors.select(F.col("node").alias("source")), stops=anchors)
    return found.join(anchors, "node", "left_semi").filter("source <> node").withColumn("arc_ids", F.array_join("arc_ids", ",")).select("source", "node", "time_u", "distance_u", "arc_ids")


#: Within the limit from every terminal to every other, node by node: what is worse than what is known goes no farther.
_MINUTES = 9.0
_NEARBY = f"""
WITH RECURSIVE arc AS (SELECT arc_id, from_node, to_node, CAST(round(time_min * 1000000) AS BIGINT) AS dt, CAST(round(distance_m * 1000000) AS BIGINT) AS dd FROM ({B.GRID_ARCS}) g), term AS ({B.GRID_TERMINALS}),
best(source, node, t, d, ids) USING KEY (source, node) AS (
  SELECT node, node, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST([] AS VARCHAR[]) FROM term
  UNION
  SELECT x.source, x.node, x.m.t, x.m.d, x.m.ids FROM (
    SELECT b.source, arc.to_node AS node, min(struct_pack(t := b.t + dt, d := b.d + dd, ids := list_append(b.ids, arc_id))) AS m
    FROM best b JOIN arc ON b.node = arc.from_node WHERE b.t + dt <= {int(_MINUTES * 1_000_000)} GROUP BY b.source, arc.to_node) x
  LEFT JOIN recurring.best r ON r.source = x.source AND r.node = x.node
  WHERE r.source IS NULL OR x.m < struct_pack(t := r.t, d := r.d, ids := r.ids))
SELECT source, node, t AS time_u, d AS distance_u, array_to_string(ids, ',') AS arc_ids FROM best WHERE node IN (SELECT node FROM term)"""


def _grid(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Arcs, cells and terminals of the road grid."""
    return B.rows(spark, sf, B.GRID_ARCS), overlay.quad_cells(B.rows(spark, sf, B.GRID_NODES)), B.rows(spark, sf, B.GRID_TERMINALS)


@query(_NEARBY)
def grid_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Paths between nearby suppliers over a grid with a node for every order: sent around while it is small, by an overlay beyond."""
    a, cells, t = _grid(spark, sf)
    out = paths.shortest_paths(a, t.select(F.col("node").alias("source")), targets=t, max_minutes=_MINUTES, cells=cells)
    return out.withColumn("arc_ids", F.array_join("arc_ids", ","))


@query(_NEARBY)
def grid_paths_by_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """The same paths through the overlay, whatever the size."""
    a, cells, t = _grid(spark, sf)
    out = paths.by_overlay(paths.costed(a), cells, t.select(F.col("node").alias("source")), t, limit=int(_MINUTES * 1_000_000))
    return out.withColumn("arc_ids", F.array_join("arc_ids", ","))


_STRONG = f"""
WITH RECURSIVE arc AS ({B.ONE_WAY_ARCS}), node AS (SELECT from_node AS n FROM arc UNION SELECT to_node FROM arc),
reach AS (SELECT n AS a, n AS b FROM node UNION SELECT reach.a, arc.to_node FROM reach JOIN arc ON reach.b = arc.from_node)
SELECT x.a AS node, min(x.b) AS root FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a"""


@query(_STRONG)
def strong_components(spark: SparkSession, sf: str) -> DataFrame:
    """Which nodes of one-way streets reach one another: one task's work while they are few, by cells beyond."""
    return strong.strong_components(B.rows(spark, sf, B.ONE_WAY_ARCS), overlay.quad_cells(B.rows(spark, sf, B.ONE_WAY_NODES)))


@query(_STRONG)
def strong_components_by_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The same by cells, contracted until little is left."""
    return strong.strong_components(B.rows(spark, sf, B.ONE_WAY_ARCS), overlay.quad_cells(B.rows(spark, sf, B.ONE_WAY_NODES), 100), small=200)


#: Customers in chains and stars: each with one of larger key, if there is one.
_LINKS = "SELECT c_custkey AS a, c_custkey + 1 + (c_custkey * 7) % 13 AS b FROM customer WHERE c_custkey % 5 <> 0"


@query(f"""
WITH RECURSIVE e AS ({_LINKS}), twice AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT DISTINCT a AS n, a AS r FROM twice UNION SELECT reach.n, twice.b FROM reach JOIN twice ON reach.r = twice.a)
SELECT n AS node, min(r) AS root FROM reach GROUP BY n""")
def component_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Connected components by rounds of star contractions."""
    edges = B.rows(spark, sf, _LINKS).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    return components.components(edges, "component-rounds")


_SCOPE = f"SELECT node FROM ({B.ACTIVE}) WHERE k % 8 = 0"


@query(_paths_sql(_SCOPE, "SELECT node FROM anchor") + "SELECT 'T' || substr(source, 2) || '>' || 'T' || substr(node, 2) AS contracted_logical_arc_id, round(t / 1e6, 6) AS time_min, array_to_string(ids, ',') AS lineage FROM best WHERE source <> node AND node IN (SELECT node FROM anchor)")
def scope_slice(spark: SparkSession, sf: str) -> DataFrame:
    """A smaller scope's network, searched anew: anchors outside it no longer block."""
    t = terminals(spark, sf)
    logical, _ = paths.logical_network(arcs(spark, sf), t, t.filter("k % 8 = 0"))
    return logical.select("contracted_logical_arc_id", *r6("time_min"), F.array_join("canonical_directed_physical_arc_ids", ",").alias("lineage"))


#: One-way arcs only, so that forward and backward reach differ.
_ONEWAY = f"SELECT arc_id, edge_id, from_node, to_node, distance_m, time_min FROM ({B.ARCS}) WHERE (ak < bk AND (ak + bk) % 3 <> 0) OR (ak > bk AND (ak * bk) % 4 = 0)"
_SNAPS = f"SELECT terminal_id, node AS truck_anchor_id, k % 11 <> 10 AS distance_covered FROM ({B.TERMINALS})"


_GATE = f"""
WITH RECURSIVE arc AS ({_ONEWAY}), s AS ({_SNAPS}),
r AS (SELECT node AS a, node AS b FROM ({B.TERMINALS}) UNION SELECT r.a, to_node FROM r JOIN arc ON r.b = arc.from_node),
j AS (SELECT d.terminal_id AS depot, d.distance_covered AS attached, s.terminal_id, NOT (d.distance_covered AND s.distance_covered AND x.a IS NOT NULL AND y.a IS NOT NULL) AS bad
      FROM s d JOIN s ON s.terminal_id <> d.terminal_id LEFT JOIN r x ON x.a = d.truck_anchor_id AND x.b = s.truck_anchor_id LEFT JOIN r y ON y.b = d.truck_anchor_id AND y.a = s.truck_anchor_id),
g AS (SELECT count(*) AS demand_denominator, count(*) FILTER (WHERE bad) AS inaccessible_count, round(count(*) FILTER (WHERE bad) / count(*), 9) AS inaccessible_ratio, attached AS depot_attached,
             depot AS depot_terminal_id, 'osm' AS provider, attached AND 100 * count(*) FILTER (WHERE bad) < 20 * count(*) AS qualified FROM j GROUP BY depot, attached)
"""


@query(_GATE + """SELECT demand_denominator, inaccessible_count, (SELECT string_agg(terminal_id, ',' ORDER BY terminal_id) FROM j WHERE bad AND depot = 'T00') AS inaccessible_ids,
       inaccessible_ratio, depot_attached, depot_terminal_id, provider, qualified FROM g WHERE depot_terminal_id = 'T00'""")
def source_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage and mutual reachability with the Depot, against 20%, and the terminals that it can't use."""
    snaps, arcs = B.rows(spark, sf, _SNAPS), B.rows(spark, sf, _ONEWAY)
    out = paths.assess(snaps, arcs, "T00").withColumn("inaccessible_ratio", F.round("inaccessible_ratio", 9))
    ids = paths.inaccessible(snaps, arcs, "T00").agg(F.sort_array(F.collect_list("terminal_id")).alias("ids"))
    ids = ids.select(F.when(F.size("ids") > 0, F.array_join("ids", ",")).alias("inaccessible_ids"))
    return out.crossJoin(ids).select("demand_denominator", "inaccessible_count", "inaccessible_ids", "inaccessible_ratio", "depot_attached", "depot_terminal_id", "provider", "qualified")


@query(_GATE + "SELECT * FROM g")
def depot_gates(spark: SparkSession, sf: str) -> DataFrame:
    """The same with each terminal as the Depot, looked up in one set of components."""
    snaps = B.rows(spark, sf, _SNAPS)
    out = paths.assess_depots(snaps, B.rows(spark, sf, _ONEWAY), snaps)
    return out.withColumn("inaccessible_ratio", F.round("inaccessible_ratio", 9)).drop("rule")


@query(_GATE + "SELECT terminal_id FROM j WHERE bad AND depot = 'T00'")
def source_gate_inaccessible(spark: SparkSession, sf: str) -> DataFrame:
    """The terminals that the Depot can't use, as rows."""
    return paths.inaccessible(B.rows(spark, sf, _SNAPS), B.rows(spark, sf, _ONEWAY), "T00")


@query(f"WITH RECURSIVE arc AS ({_ONEWAY}), f AS (SELECT 'N00' AS node UNION SELECT to_node FROM f JOIN arc ON f.node = arc.from_node), b AS (SELECT 'N00' AS node UNION SELECT from_node FROM b JOIN arc ON b.node = arc.to_node) SELECT node FROM f INTERSECT SELECT node FROM b")
def mutual_reach(spark: SparkSession, sf: str) -> DataFrame:
    a = B.rows(spark, sf, _ONEWAY)
    return paths.reachable(a, "N00").intersect(paths.reachable(a, "N00", backward=True))


# -- service ----------------------------------------------------------------------------

_SITES = f"SELECT node FROM ({B.TERMINALS})"
_PAIRS = _paths_sql(_SITES, "SELECT node FROM anchor WHERE false") + f""",
dem AS (SELECT node AS demand, CAST(w AS DOUBLE) AS population FROM ({B.TERMINALS})),
pair AS (SELECT source AS site, node AS demand, round(t / 1e6, 6) AS time_min, round(d / 1e6, 6) AS distance_m FROM best WHERE node IN (SELECT node FROM anchor) AND t <= 2500000 AND d <= 2400000000)
"""


def _pairs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sources = B.rows(spark, sf, _SITES).select(F.col("node").alias("source"))
    demands = B.rows(spark, sf, B.TERMINALS).select(F.col("node").alias("demand"), F.col("w").cast("double").alias("population"))
    p = paths.shortest_paths(arcs(spark, sf), sources).join(demands.select(F.col("demand").alias("node")), "node", "left_semi")
    p = p.select(F.col("source").alias("site"), F.col("node").alias("demand"), F.round(F.col("time_u") / 1e6, 6).alias("time_min"), F.round(F.col("distance_u") / 1e6, 6).alias("distance_m"))
    return service.serviceable_pairs(p, demands, 2.5, 2400.0), demands


@query(_PAIRS + "SELECT site, demand, time_min, distance_m, population FROM pair JOIN dem USING (demand)")
def service_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Sites that reach a demand within both limits on one path."""
    return _pairs(spark, sf)[0].select("site", "demand", "time_min", "distance_m", "population")


@query()
def microgrid_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Fewest sites, then least population-weighted time, then ids.

    Without SQL, which would have to list all sets of 25 sites; tested by brute force.
    """
    pairs, demands = _pairs(spark, sf)
    return service.min_site_cover(pairs, demands)


@query(_PAIRS + """, a AS (SELECT demand, min(row(time_min, distance_m, site)) AS p FROM pair GROUP BY demand)
SELECT p[3] AS site, count(*) AS n_demands, sum(population) AS catchment_population, sum(CASE WHEN demand = p[3] THEN population ELSE 0 END) AS local_population, round(sum(population * p[1]), 6) AS weighted_time FROM a JOIN dem USING (demand) GROUP BY 1""")
def service_catchments(spark: SparkSession, sf: str) -> DataFrame:
    pairs, _ = _pairs(spark, sf)
    out = service.catchments(service.assign_nearest(pairs))
    return out.withColumn("weighted_time", F.round("weighted_time", 6))


# -- drones --------------------------------------------------------------------------------


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return B.rows(spark, sf, B.NETWORK_CUSTOMERS)


_RAW = f"""
WITH c AS ({B.NETWORK_CUSTOMERS}),
leg AS (SELECT a.network_id, p AS payload, a.terminal_id AS anchor_terminal, b.terminal_id AS customer, CASE WHEN p = 'full' THEN 'anchor:' || a.terminal_id ELSE 'customer:' || b.terminal_id END AS origin,
               CASE WHEN p = 'full' THEN 'customer:' || b.terminal_id ELSE 'anchor:' || a.terminal_id END AS destination, sqrt(pow(b.x - a.anchor_x, 2) + pow(b.y - a.anchor_y, 2)) AS distance_m, a.z AS za, b.z AS zb
        FROM c a JOIN c b ON a.network_id = b.network_id, (VALUES ('full'), ('empty')) v(p))
"""


@query(_RAW + "SELECT network_id, payload, anchor_terminal, customer, origin, destination, round(distance_m, 6) AS distance_m FROM leg")
def drone_raw_legs(spark: SparkSession, sf: str) -> DataFrame:
    """2 N^2 legs of each network."""
    return drone.raw_legs(customers(spark, sf)).withColumn("distance_m", F.round("distance_m", 6))


@query(f"SELECT a.network_id, p AS payload, a.terminal_id AS origin, b.terminal_id AS destination, round(sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)), 6) AS distance_m FROM ({B.NETWORK_CUSTOMERS}) a JOIN ({B.NETWORK_CUSTOMERS}) b ON a.network_id = b.network_id AND a.terminal_id <> b.terminal_id, (VALUES ('full'), ('empty')) v(p)")
def drone_centroid_legs(spark: SparkSession, sf: str) -> DataFrame:
    """2 N (N - 1) legs between customers."""
    return drone.centroid_legs(customers(spark, sf)).withColumn("distance_m", F.round("distance_m", 6))


@query(_RAW + f", mid AS (SELECT a.network_id, a.terminal_id AS o, b.terminal_id AS d FROM ({B.NETWORK_CUSTOMERS}) a JOIN ({B.NETWORK_CUSTOMERS}) b ON a.network_id = b.network_id AND a.terminal_id < b.terminal_id) SELECT network_id, (SELECT count(*) FROM leg WHERE leg.network_id = c.network_id AND payload = 'full') + (SELECT count(*) FROM mid WHERE mid.network_id = c.network_id) AS n_corridors, count(*) AS n_customers FROM c GROUP BY network_id")
def drone_corridors(spark: SparkSession, sf: str) -> DataFrame:
    """Corridors sampled once: N^2 to the anchors and N (N - 1) / 2 between customers."""
    c = customers(spark, sf)
    legs = drone.raw_legs(c).select("network_id", "origin", "destination", "distance_m").unionByName(drone.centroid_legs(c).select("network_id", "origin", "destination", "distance_m"))
    n = drone.corridors(legs).groupBy("network_id").agg(F.count(F.lit(1)).alias("n_corridors"))
    return n.join(c.groupBy("network_id").agg(F.count(F.lit(1)).alias("n_customers")), "network_id")


#: A grid over the networks' customers; cells without people are low ground.
_GROUND = f"SELECT CAST(i AS INT) AS r, CAST(j AS INT) AS c, coalesce(pop, 3.0) AS z FROM (SELECT explode(sequence(0, 39)) AS i) a CROSS JOIN (SELECT explode(sequence(0, 39)) AS j) b LEFT JOIN ({B.CELLS}) k ON k.r = i AND k.c = j"
_GRID = {"x0": -300.0, "y0": 5300.0, "cell_m": 150.0}


@query(_RAW + f""", dem AS (SELECT i AS r, j AS c, coalesce(pop, 3.0) AS z FROM (SELECT unnest(range(40)) AS i) a, (SELECT unnest(range(40)) AS j) b LEFT JOIN ({B.CELLS}) k ON k.r = i AND k.c = j),
pair AS (SELECT a.network_id, 'anchor:' || a.terminal_id AS end_a, 'customer:' || b.terminal_id AS end_b, a.anchor_x AS xa, a.anchor_y AS ya, b.x AS xb, b.y AS yb FROM c a JOIN c b ON a.network_id = b.network_id
         UNION ALL SELECT a.network_id, a.terminal_id, b.terminal_id, a.x, a.y, b.x, b.y FROM c a JOIN c b ON a.network_id = b.network_id AND a.terminal_id < b.terminal_id),
step AS (SELECT *, greatest(ceil(sqrt(pow(xb - xa, 2) + pow(yb - ya, 2)) / 100.0), 1) AS n FROM pair),
p AS (SELECT *, unnest(range(CAST(n AS BIGINT) + 1)) AS k FROM step),
f AS (SELECT network_id, end_a, end_b, k, n, (xa + k / n * (xb - xa) + 300.0) / 150.0 - 0.5 AS fc, (5300.0 - (ya + k / n * (yb - ya))) / 150.0 - 0.5 AS fr FROM p),
v AS (SELECT network_id, end_a, end_b, k, n, sum((CASE WHEN i = 1 THEN fr - floor(fr) ELSE 1 - (fr - floor(fr)) END) * (CASE WHEN j = 1 THEN fc - floor(fc) ELSE 1 - (fc - floor(fc)) END) * z) AS z
      FROM f, (VALUES (0), (1)) y(i), (VALUES (0), (1)) x(j), dem WHERE dem.r = floor(fr) + i AND dem.c = floor(fc) + j GROUP BY 1, 2, 3, 4, 5)
SELECT network_id, end_a, end_b, round(max(CASE WHEN k = 0 THEN z END), 4) AS z_a, round(max(CASE WHEN k = n THEN z END), 4) AS z_b, round(max(z), 4) AS z_max FROM v GROUP BY 1, 2, 3""")
def drone_corridor_ground(spark: SparkSession, sf: str) -> DataFrame:
    """The highest ground of each corridor, N^2 to the anchors and N (N - 1) / 2 between customers, sampled once."""
    c = customers(spark, sf)
    columns = ("network_id", "origin", "destination", "distance_m")
    pairs = drone.corridors(drone.raw_legs(c).select(*columns).unionByName(drone.centroid_legs(c).select(*columns)))
    dem = B.rows(spark, sf, _GROUND).select(F.col("r").alias("row"), F.col("c").alias("col"), "z")
    ground = drone.ground_along(pairs, c, 100.0, dem, _GRID)
    return ground.select("network_id", "end_a", "end_b", *[F.round(z, 4).alias(z) for z in ("z_a", "z_b", "z_max")])


_D = CFG["drone"]


def _power(phase: str) -> str:
    return f"(CASE WHEN payload = 'full' THEN {_D[f'full_{phase}_kw']} ELSE {_D[f'empty_{phase}_kw']} END)"


_COSTS = _RAW + f""", z AS (SELECT *, CASE WHEN payload = 'full' THEN za ELSE zb END AS z0, CASE WHEN payload = 'full' THEN zb ELSE za END AS z1, greatest(za, zb) + 5.0 + {_D['clearance_m']} AS top FROM leg),
ph AS (SELECT *, (top - z0) / {_D['climb_m_s']} AS up, (top - z1) / {_D['descend_m_s']} AS down, distance_m / {_D['cruise_m_s']} AS level FROM z),
cost AS (SELECT *, level * {_power('cruise')} / 3600 AS horizontal_energy_kwh, (up * {_power('climb')} + down * {_power('descend')}) / 3600 AS vertical_energy_kwh FROM ph)
"""
_USABLE = _D["nominal_battery_kwh"] * (1 - _D["reserve_share"])


def _costed(spark: SparkSession, sf: str) -> DataFrame:
    c = customers(spark, sf)
    ground = c.select("network_id", "terminal_id", "z")
    legs = drone.raw_legs(c)
    legs = legs.join(ground.select("network_id", F.col("terminal_id").alias("anchor_terminal"), F.col("z").alias("za")), ["network_id", "anchor_terminal"])
    legs = legs.join(ground.select("network_id", F.col("terminal_id").alias("customer"), F.col("z").alias("zb")), ["network_id", "customer"])
    full = F.col("payload") == "full"
    legs = legs.withColumn("z_from", F.when(full, F.col("za")).otherwise(F.col("zb"))).withColumn("z_to", F.when(full, F.col("zb")).otherwise(F.col("za"))).withColumn("z_max", F.greatest("za", "zb") + 5.0)
    return drone.cost_legs(legs, _D)


@query(_COSTS + f"SELECT network_id, payload, anchor_terminal, customer, round((up + down + level) / 60, 6) AS time_min, round(horizontal_energy_kwh, 6) AS horizontal_energy_kwh, round(vertical_energy_kwh, 6) AS vertical_energy_kwh, round(horizontal_energy_kwh + vertical_energy_kwh, 6) AS energy_kwh, horizontal_energy_kwh + vertical_energy_kwh <= {_USABLE} AS arc_energy_necessary_feasible FROM cost")
def drone_costs(spark: SparkSession, sf: str) -> DataFrame:
    """Three-phase flight energy and the reserve test of each leg alone."""
    return _costed(spark, sf).select("network_id", "payload", "anchor_terminal", "customer", *r6("time_min", "horizontal_energy_kwh", "vertical_energy_kwh", "energy_kwh"), "arc_energy_necessary_feasible")


@query(_COSTS + f"SELECT network_id, anchor_terminal, customer, round(sum(horizontal_energy_kwh + vertical_energy_kwh), 6) AS round_trip_kwh, sum(horizontal_energy_kwh + vertical_energy_kwh) <= {_USABLE} AS round_trip_feasible FROM cost GROUP BY 1, 2, 3")
def drone_round_trips(spark: SparkSession, sf: str) -> DataFrame:
    return drone.round_trips(_costed(spark, sf), _D).withColumn("round_trip_kwh", F.round("round_trip_kwh", 6))


# -- scenarios --------------------------------------------------------------------------------

_STATES = ", ".join(f"('{k}', {s}, {t}, {e})" for k, (s, t, e) in scenarios.STATES.items())
_REGISTRY = f"SELECT network_id, severity, draw, hit_share, time_factor, energy_factor, network_id || '-' || severity || '-' || CAST(draw AS VARCHAR) AS scenario_id FROM (SELECT DISTINCT network_id FROM ({B.NETWORK_CUSTOMERS})), (VALUES {_STATES}) s(severity, hit_share, time_factor, energy_factor), (VALUES (1), (2)) d(draw)"


def networks(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).select("network_id").distinct()


@query(_REGISTRY)
def scenario_registry(spark: SparkSession, sf: str) -> DataFrame:
    return scenarios.scenario_registry(networks(spark, sf)).drop("seed")


@query(f"SELECT * FROM ({_REGISTRY}) WHERE false")
def scenarios_disabled(spark: SparkSession, sf: str) -> DataFrame:
    return scenarios.scenario_registry(networks(spark, sf), enabled=False).drop("seed")


_RANKED = f"SELECT 'W' || CAST(ak % 2 AS STRING) AS network_id, arc_id AS arc, edge_id AS connection, time_min, distance_m / 1000 AS energy_kwh, ((ak * 7 + bk * 7) % 50) / 50.0 AS rank FROM ({B.ARCS})"


@query(f"""
WITH a AS ({_RANKED}), r AS ({_REGISTRY}),
j AS (SELECT r.scenario_id, a.network_id, arc, connection, CAST(CAST('0x' || substr(md5('1|' || connection || '|' || CAST(draw AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0 AS u,
             least(1.0, 2 * hit_share * rank) AS p, time_min, energy_kwh, time_factor, energy_factor FROM a JOIN r USING (network_id))
SELECT scenario_id, network_id, arc, connection, round(u, 9) AS uniform, u < p AS disrupted, round(CASE WHEN u < p THEN time_min * time_factor ELSE time_min END, 6) AS time_min, round(CASE WHEN u < p THEN energy_kwh * energy_factor ELSE energy_kwh END, 6) AS energy_kwh FROM j""")
def scenario_arcs(spark: SparkSession, sf: str) -> DataFrame:
    """One draw for a connection's two directions; disrupted costs by severity."""
    out = scenarios.disrupted_arcs(B.rows(spark, sf, _RANKED), scenarios.scenario_registry(networks(spark, sf)))
    return out.withColumn("uniform", F.round("uniform", 9)).withColumn("time_min", F.round("time_min", 6)).withColumn("energy_kwh", F.round("energy_kwh", 6))


# -- releases ---------------------------------------------------------------------------------


def _digest_sql(table: str, columns: list[str]) -> str:
    fields = ", ".join(f"{c} := {c}" for c in sorted(columns))
    parts = " || '-' || ".join(f"CAST(coalesce(sum(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)), 0) AS VARCHAR)" for i in range(4))
    return f"SELECT '{table}' AS \"table\", count(*) AS n_rows, sha256({parts}) AS digest FROM (SELECT md5(CAST(to_json(struct_pack({fields})) AS VARCHAR)) AS h FROM {table})"


_DIGESTED = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus"]}


def digests(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, columns in _DIGESTED.items():
        one = release.content_digest(spark.read.parquet(f"{sf}/{name}.parquet").select(columns), name)
        out = one if out is None else out.unionByName(one)
    return out


@query(" UNION ALL ".join(_digest_sql(k, v) for k, v in _DIGESTED.items()))
def release_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Order-free content digests of tables."""
    return digests(spark, sf)


@query(f"""
WITH one AS ({" UNION ALL ".join(_digest_sql(k, v) for k, v in _DIGESTED.items())}),
two AS (SELECT "table", CASE WHEN n_rows % 5 = 0 THEN 'changed' ELSE digest END AS digest FROM one WHERE n_rows < (SELECT max(n_rows) FROM one))
SELECT coalesce(one."table", two."table") AS "table", two.digest IS NOT NULL AS in_both FROM one FULL JOIN two ON one."table" = two."table" WHERE one.digest IS DISTINCT FROM two.digest""")
def run_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of which one changed tables and lacks the largest; registry paths don't count."""
    one = materialize(digests(spark, sf), "digests")
    largest = one.agg(F.max("n_rows")).first()[0]
    two = one.filter(F.col("n_rows") < largest).withColumn("digest", F.when(F.col("n_rows") % 5 == 0, "changed").otherwise(F.col("digest")))
    extra = one.limit(1).select(F.lit("registry/x").alias("table"), "digest")
    found = release.differences(release.science_keys(one.select("table", "digest").unionByName(extra)), release.science_keys(two.select("table", "digest")))
    return found.select("table", F.col("second").isNotNull().alias("in_both"))


#: The orders of a later release: some changed, some lost, some twice, some new.
_LATER = """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 5 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 991 <> 7
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 983 = 11
UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 977 = 13"""
_EARLIER = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


@query(f"""
WITH one AS (SELECT *, count(*) AS n FROM ({_EARLIER}) x GROUP BY ALL), two AS (SELECT *, count(*) AS n FROM ({_LATER}) x GROUP BY ALL),
j AS (SELECT coalesce(one.o_orderkey, two.o_orderkey) AS o_orderkey, one.n AS a, two.n AS b
      FROM one FULL JOIN two ON one.o_orderkey = two.o_orderkey AND one.o_custkey = two.o_custkey AND one.o_orderstatus = two.o_orderstatus AND one.o_orderpriority = two.o_orderpriority)
SELECT o_orderkey, CASE WHEN sum(a) IS NULL THEN 'added' WHEN sum(b) IS NULL THEN 'lost' WHEN bool_and(a IS NOT NULL AND b IS NOT NULL) THEN 'repeated' ELSE 'changed' END AS difference
FROM j GROUP BY o_orderkey HAVING bool_or(a IS DISTINCT FROM b)""")
def row_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that differ between two releases of all orders, found down their digest trees."""
    return digest_tree.row_differences(B.rows(spark, sf, _EARLIER), B.rows(spark, sf, _LATER), ["o_orderkey"])


_INPUTS = "SELECT 'pages/' || CAST(page_id AS STRING) AS path, 'raw' AS role, CASE WHEN page_id % 3 = 0 THEN true WHEN page_id % 3 = 1 THEN false END AS redistribution_permitted FROM pages"


@query(f"SELECT path, role FROM ({_INPUTS}) WHERE redistribution_permitted IS NOT TRUE")
def omitted_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return release.omitted_inputs(B.rows(spark, sf, _INPUTS)).select("path", "role")


@query("SELECT n_name AS name FROM nation WHERE n_nationkey % 5 = 0")
def missing_members(spark: SparkSession, sf: str) -> DataFrame:
    names = B.rows(spark, sf, "SELECT n_name AS name, n_nationkey AS k FROM nation")
    return release.missing_members(names, names.filter("k % 5 <> 0"))


@query(f"SELECT * FROM (SELECT 'terminals' AS counter, count(*) AS n FROM ({B.TERMINALS}) UNION ALL SELECT 'arcs', count(*) FROM ({B.ARCS}) UNION ALL SELECT 'edges', count(DISTINCT edge_id) FROM ({B.ARCS}) UNION ALL SELECT 'networks', count(DISTINCT network_id) FROM ({B.NETWORK_CUSTOMERS}))")
def run_counters(spark: SparkSession, sf: str) -> DataFrame:
    a = arcs(spark, sf)
    one = lambda name, df, c=F.count(F.lit(1)): df.agg(c.alias("n")).select(F.lit(name).alias("counter"), "n")
    return one("terminals", B.rows(spark, sf, B.TERMINALS)).unionByName(one("arcs", a)).unionByName(one("edges", a, F.count_distinct("edge_id"))).unionByName(one("networks", customers(spark, sf), F.count_distinct("network_id")))


def release_checks(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Violating rows of each check over the bridge release."""
    a, t, c = arcs(spark, sf), terminals(spark, sf), customers(spark, sf)
    logical, lineage = paths.logical_network(a, t)
    sums = paths.lineage_costs(lineage, a).select("contracted_logical_arc_id", F.col("time_min").alias("t"), F.col("distance_m").alias("d"))
    cells = dense_cells(spark, sf)
    total = cells.agg(F.sum("pop").alias("p"))
    legs, n = drone.raw_legs(c).groupBy("network_id").agg(F.count(F.lit(1)).alias("legs")), c.groupBy("network_id").agg(F.count(F.lit(1)).alias("n"))
    pairs, demands = _pairs(spark, sf)
    assigned = service.min_site_cover(pairs, demands)
    gate = paths.assess(t.select("terminal_id", "truck_anchor_id", F.lit(True).alias("distance_covered")), a, "T00")
    energy = a.select("edge_id", fn.truck_energy(F.col("distance_m"), F.lit(10.0), _T).alias("up"), fn.truck_energy(F.col("distance_m"), F.lit(0.0), _T).alias("flat"))
    return {
        "customer_coordinates": c.filter("x is null or y is null or (x = anchor_x and y = anchor_y)"),
        "depot_roles": t.agg(F.count_if(F.col("terminal_id") == "T00").alias("n")).filter("n <> 1"),
        "directional_energy": energy.filter("up <= flat or flat <= 0"),
        "microgrid_assignment_conservation": demands.join(assigned.groupBy("demand").agg(F.count(F.lit(1)).alias("k")), "demand", "left").filter("coalesce(k, 0) <> 1"),
        "no_synthetic_road_connectors": lineage.join(a, "arc_id", "left_anti"),
        "population_conservation": population.demand_nodes(cells).agg(F.sum("population").alias("q")).crossJoin(total).filter("abs(p - q) > 1e-6 * p"),
        "raw_drone_2NN_roles": legs.join(n, "network_id").filter("legs <> 2 * n * n"),
        "real_source_lineage": a.filter("edge_id is null"),
        "runtime_paths_active_only": logical.select("contracted_logical_arc_id", F.explode(F.array("from_terminal", "to_terminal")).alias("terminal_id")).join(t.filter("truck_service_status = 'active'"), "terminal_id", "left_anti"),
        "source_gate": gate.filter("not qualified"),
        "strict_lineage_and_cost_sums": logical.join(sums, "contracted_logical_arc_id", "left").filter("t is null or abs(t - time_min) > 1e-6 or abs(d - distance_m) > 1e-6 or time_min <= 0 or distance_m <= 0 or from_terminal = to_terminal"),
    }


@query("SELECT unnest(['customer_coordinates', 'depot_roles', 'directional_energy', 'microgrid_assignment_conservation', 'no_synthetic_road_connectors', 'population_conservation', 'raw_drone_2NN_roles', 'real_source_lineage', 'runtime_paths_active_only', 'source_gate', 'strict_lineage_and_cost_sums']) AS check_name, true AS passed")
def release_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Eleven checks, each passed if its query of violating rows is empty."""
    found = release.validate(release_checks(spark, sf))["checks"]
    return spark.createDataFrame(sorted(found.items()), "check_name string, passed boolean")


# -- files: written to the shared folder, read back ---------------------------------------------


@query(f"SELECT r AS \"row\", c AS col, pop AS value FROM ({B.CELLS})")
def geotiff_cells(spark: SparkSession, sf: str) -> DataFrame:
    """A raster of 40 x 40 cells through a GeoTIFF; cells without people are nodata."""
    grid = np.full((40, 40), -1.0)
    for r in B.rows(spark, sf, B.CELLS).collect():
        grid[r.r, r.c] = r["pop"]
    file = work_path(spark, "cells") + ".tif"
    release.write_bytes(spark, file, geotiff.encode(grid, 0.0, 4000.0, 100.0, -1.0, True))
    return geotiff.read_grid(spark, file, drop_nodata=True).select("row", "col", "value")


@query(f"SELECT source_id AS name, road_class, round(x1, 3) AS x1, round(y1, 3) AS y1, round(x3, 3) AS x3, round(y3, 3) AS y3 FROM ({B.STREETS})")
def geopackage_streets(spark: SparkSession, sf: str) -> DataFrame:
    """The streets through a GeoPackage layer with attributes."""
    lines = [({"name": r.source_id, "road_class": r.road_class}, [(p.x, p.y) for p in r.pts]) for r in streets(spark, sf).collect()]
    file = work_path(spark, "streets") + ".gpkg"
    release.write_bytes(spark, file, vector.write_geopackage(lines, "roads"))
    df = vector.read_geopackage(spark, file, "roads")
    named = F.from_json("attributes", "name string, road_class string")
    ends = {"x1": F.col("pts")[0]["x"], "y1": F.col("pts")[0]["y"], "x3": F.element_at("pts", -1)["x"], "y3": F.element_at("pts", -1)["y"]}
    return df.select(named.alias("a"), "pts").select("a.name", "a.road_class", *[F.round(v, 3).alias(k) for k, v in ends.items()])


@query("SELECT s_suppkey, s_name, s_acctbal, true AS same_digest FROM supplier")
def csv_release(spark: SparkSession, sf: str) -> DataFrame:
    """A published CSV table, sorted by its key into one file, read back under its schema with an equal digest."""
    df = B.rows(spark, sf, "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
    root = work_path(spark, "release")
    note = release.publish(spark, {"supplier": df}, root, fmt="csv", keys={"supplier": ["s_suppkey"]})
    back = tables.read_csv(spark, f"{root}/supplier", "s_suppkey bigint, s_name string, s_acctbal double")
    own = release.content_digest(df, "supplier").first().digest
    return back.withColumn("same_digest", F.lit(own == note["core_hashes"]["supplier"]))


@query("SELECT n_nationkey, n_name, true AS reused FROM nation")
def mother_reuse(spark: SparkSession, sf: str) -> DataFrame:
    """A published mother release, used again instead of built."""
    root = work_path(spark, "mother")
    release.publish(spark, {"nation": B.rows(spark, sf, "SELECT n_nationkey, n_name FROM nation")}, root)
    got, reused = release.reuse_or_build(spark, root, ["nation"], dict)
    return got["nation"].withColumn("reused", F.lit(reused))


_FALLBACK = f"SELECT terminal_id, node AS truck_anchor_id, k % 3 <> 1 AS distance_covered FROM ({B.TERMINALS})"


@query(f"""
SELECT attempt, provider, count(*) AS demand_denominator, count(*) FILTER (WHERE bad) AS inaccessible_count, 100 * count(*) FILTER (WHERE bad) < 20 * count(*) AS qualified
FROM (SELECT 1 AS attempt, 'osm' AS provider, k % 3 = 1 AS bad FROM ({B.TERMINALS}) WHERE k <> 0 UNION ALL SELECT 2, 'local', k % 11 = 10 FROM ({B.TERMINALS}) WHERE k <> 0) GROUP BY 1, 2""")
def source_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The first source fails its gate, the second one, of verified licence, is taken."""
    a = arcs(spark, sf)
    tried = paths.choose_source([("osm", B.rows(spark, sf, _FALLBACK), a, True), ("local", B.rows(spark, sf, _SNAPS), a, True)], "T00")
    keep = ("attempt", "provider", "demand_denominator", "inaccessible_count", "qualified")
    return spark.createDataFrame([tuple(r[k] for k in keep) for r in tried], "attempt int, provider string, demand_denominator long, inaccessible_count long, qualified boolean")


def _krueger() -> str:
    """Krueger's series for EPSG:2193 in SQL, of places named lon and lat."""
    f = 1 / 298.257222101
    n, e = f / (2 - f), math.sqrt(f * (2 - f))
    terms = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    x = " + ".join(["eta", *(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in enumerate(terms, 1))])
    y = " + ".join(["xi", *(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in enumerate(terms, 1))])
    return f"""
WITH p AS (SELECT c_custkey AS id, radians(172 + c_custkey % 300 / 100 - 173) AS d, sin(radians(-45 + c_custkey % 500 / 100)) AS s FROM customer),
t AS (SELECT id, d, sinh(atanh(s) - {e!r} * atanh({e!r} * s)) AS t FROM p),
u AS (SELECT id, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM t)
SELECT id, round(1600000 + {radius!r} * ({x}), 3) AS x, round(10000000 + {radius!r} * ({y}), 3) AS y FROM u"""


@query(_krueger())
def projection(spark: SparkSession, sf: str) -> DataFrame:
    """Degrees to the national grid's metres."""
    df = B.rows(spark, sf, "SELECT c_custkey AS id, 172 + c_custkey % 300 / 100 AS lon, -45 + c_custkey % 500 / 100 AS lat FROM customer")
    x, y = fn.transverse_mercator(F.col("lon").cast("double"), F.col("lat").cast("double"), **fn.NZTM)
    return df.select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))
