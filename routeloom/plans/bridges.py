"""Deterministic views that turn the driver's star schema into the model's relations.

They are this project's own and stand for no real place.  Each is one SQL text that
Spark and DuckDB both read, so queries and their oracles start from equal rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "pages")

CELLS = "SELECT CAST(l_partkey % 40 AS INT) AS r, CAST(l_suppkey % 40 AS INT) AS c, CAST(count(*) AS DOUBLE) AS pop FROM lineitem GROUP BY 1, 2"
#: Cells well above the mean: a few dozen components.
DENSE = f"SELECT r, c, pop FROM ({CELLS}) WHERE pop > (SELECT avg(pop) + 1.28 * stddev_pop(pop) FROM ({CELLS}))"
#: A 5 x 5 grid of terminals, a kilometre apart; T00 is the Depot.
TERMINALS = """
SELECT 'T' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS terminal_id, 'N' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS node, n_nationkey AS k,
       n_regionkey AS region, (n_nationkey % 5) * 1000.0 AS x, floor(n_nationkey / 5) * 1000.0 AS y, coalesce(w, 0) AS w
FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS w FROM customer GROUP BY 1) ON n_nationkey = c_nationkey"""
ARCS = f"""
SELECT 'A' || lpad(CAST(a.k AS STRING), 2, '0') || '-' || lpad(CAST(b.k AS STRING), 2, '0') AS arc_id,
       'E' || lpad(CAST(least(a.k, b.k) AS STRING), 2, '0') || '-' || lpad(CAST(greatest(a.k, b.k) AS STRING), 2, '0') AS edge_id,
       a.node AS from_node, b.node AS to_node, CAST(1000 + (a.w * 7 + b.w * 3 + a.k * 13 + b.k * 29) % 200 AS DOUBLE) AS distance_m,
       (10 + (a.w + b.w + a.k * b.k) % 3) / 10.0 AS time_min, a.k AS ak, b.k AS bk
FROM ({TERMINALS}) a JOIN ({TERMINALS}) b ON abs(a.x - b.x) + abs(a.y - b.y) = 1000"""
#: All terminals with their status: every fourth is active, an anchor whose paths others may not pass.
SERVED = f"SELECT *, CASE WHEN k % 4 = 0 THEN 'active' WHEN k % 4 = 1 THEN 'inaccessible' ELSE 'suspended' END AS truck_service_status FROM ({TERMINALS})"
ACTIVE = f"SELECT * FROM ({SERVED}) WHERE truck_service_status = 'active'"
#: A road grid with a node for every order: arcs both ways but for some, with few different costs, so that paths tie.
_SQUARE = "SELECT o_orderkey AS k, (SELECT count(*) FROM orders) AS n, (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) FROM orders) AS w FROM orders"
GRID_NODES = f"SELECT 'V' || CAST(k AS STRING) AS node, CAST(k % w AS DOUBLE) AS x, CAST(floor(k / w) AS DOUBLE) AS y FROM ({_SQUARE}) q"
_STEPS = f"SELECT k AS a, k + 1 AS b FROM ({_SQUARE}) q WHERE (k + 1) % w <> 0 AND k + 1 < n UNION ALL SELECT k, k + w FROM ({_SQUARE}) q WHERE k + w < n"
GRID_ARCS = f"""
SELECT 'R' || CAST(a AS STRING) || '>' || CAST(b AS STRING) AS arc_id, 'V' || CAST(a AS STRING) AS from_node, 'V' || CAST(b AS STRING) AS to_node,
       (10 + (a * 7 + b * 13) % 5) / 10.0 AS time_min, CAST(1000 + (a * 31 + b * 17) % 3 * 100 AS DOUBLE) AS distance_m
FROM (SELECT a, b FROM ({_STEPS}) s UNION ALL SELECT b, a FROM ({_STEPS}) s) e WHERE (a * 3 + b * 5) % 11 <> 0"""
#: A terminal for every supplier at a node of that grid.
GRID_TERMINALS = "SELECT DISTINCT 'V' || CAST(s_suppkey * 97 % (SELECT count(*) FROM orders) AS STRING) AS node FROM supplier"
#: One-way streets with a node for every customer, in rows that mostly run one way.
_PLACES = "SELECT c_custkey AS k, (SELECT count(*) FROM customer) AS n, (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) FROM customer) AS w FROM customer"
ONE_WAY_ARCS = f"""
SELECT 'V' || CAST(a AS STRING) AS from_node, 'V' || CAST(b AS STRING) AS to_node FROM (
  SELECT k AS a, k + 1 AS b FROM ({_PLACES}) q WHERE (k + 1) % w <> 0 AND k + 1 < n AND k * 7 % 10 < 7
  UNION ALL SELECT k + w, k FROM ({_PLACES}) q WHERE k + w < n AND k * 3 % 10 < 4
  UNION ALL SELECT k, k + w FROM ({_PLACES}) q WHERE k + w < n AND k * 13 % 10 < 3) e"""
ONE_WAY_NODES = f"SELECT 'V' || CAST(k AS STRING) AS node, CAST(k % w AS DOUBLE) AS x, CAST(floor(k / w) AS DOUBLE) AS y FROM ({_PLACES}) q"
PROFILE_POINTS = """
SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 10.0 AS d, value AS z,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events"""
#: Streets of two pieces in the map's own metres, two to four steps from the axes: even keys run along,
#: odd ones across; every third is one-way.  The piece between is bent by a few metres.
PLACE_X, PLACE_Y = "1300000.0 + 0.8 * {x} - 0.6 * {y}", "5002000.0 + 0.6 * {x} + 0.8 * {y}"
_STREET = """
SELECT 'S' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS source_id, n_nationkey AS k, CASE WHEN n_nationkey % 10 = 9 THEN '1' ELSE '0' END AS grade_key,
       CASE WHEN n_nationkey % 4 = 0 THEN 'secondary' ELSE 'residential' END AS road_class, CASE WHEN n_nationkey % 3 = 0 THEN 'yes' WHEN n_nationkey % 7 = 1 THEN '-1' ELSE 'no' END AS oneway,
       CASE WHEN n_nationkey = 11 THEN 'private' END AS access,
       CASE WHEN n_nationkey % 2 = 0 THEN 0.0 ELSE n_nationkey * 40.0 END AS x1, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 40.0 ELSE 0.0 END AS y1,
       CASE WHEN n_nationkey % 2 = 0 THEN 300.0 + n_nationkey * 30.0 ELSE n_nationkey * 40.0 + 13.0 END AS x3, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 40.0 + 17.0 ELSE 350.0 + n_nationkey * 20.0 END AS y3
FROM nation"""


def _placed(x: str, y: str, n: int) -> str:
    return f"round({PLACE_X.format(x=x, y=y)}, 3) AS x{n}, round({PLACE_Y.format(x=x, y=y)}, 3) AS y{n}"


STREETS = f"SELECT source_id, k, grade_key, road_class, oneway, access, {_placed('x1', 'y1', 1)}, {_placed('((x1 + x3) / 2 + 3.0)', '((y1 + y3) / 2 - 4.0)', 2)}, {_placed('x3', 'y3', 3)} FROM ({_STREET})"
#: The open streets' straight pieces.
PIECES = f"""
SELECT source_id, grade_key, 0 AS seq, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS "by" FROM ({STREETS}) WHERE access IS NULL
UNION ALL SELECT source_id, grade_key, 1, x2, y2, x3, y3 FROM ({STREETS}) WHERE access IS NULL"""
CUSTOMER_POINTS = "SELECT c_custkey AS id, (c_custkey * 37 % 1499) * 1.0 AS x, (c_custkey * 91 % 1493) * 1.0 AS y, c_nationkey AS nation FROM customer"
#: A boundary that grows with the tables, as rings of vertices: one round the points with an order at each vertex, 25 holes
#: with a customer at each, and an island with a part at each.
RING_VERTICES = """
SELECT ring, k, round(cx + radius * cos(2 * pi() * k / n), 6) AS x, round(cy + radius * sin(2 * pi() * k / n), 6) AS y FROM (
  SELECT 0 AS ring, o_orderkey AS k, 750.0 AS cx, 750.0 AS cy, 500 + 150 * sin(14 * pi() * o_orderkey / (SELECT count(*) FROM orders)) + (o_orderkey * 7919 % 101) / 2.0 AS radius, (SELECT count(*) FROM orders) AS n FROM orders
  UNION ALL
  SELECT 1 + h, k, 750.0 + 60.0 * (h % 5 - 2), 750.0 + 60.0 * (floor(h / 5) - 2), pi() * 0 + 12 + (c_custkey * 31 % 17) / 2.0, count(*) OVER (PARTITION BY h)
  FROM (SELECT CAST(c_custkey % 25 AS INT) AS h, CAST(floor(c_custkey / 25) AS BIGINT) AS k, c_custkey FROM customer) c
  UNION ALL
  SELECT 26, p_partkey, 1380.0, 1380.0, pi() * 0 + 40 + (p_partkey * 13 % 29) / 2.0, (SELECT count(*) FROM part) FROM part) v"""
#: The same points among the streets.
PLACED_POINTS = f"SELECT id, {PLACE_X.format(x='x', y='y')} AS x, {PLACE_Y.format(x='x', y='y')} AS y FROM ({CUSTOMER_POINTS})"
#: Every supplier, two networks for each forty keys: legs are quadratic in a network of twenty at most, and grow with the table.
NETWORK_CUSTOMERS = """
SELECT 'W' || CAST(CAST(floor(s_suppkey / 40) AS BIGINT) * 2 + s_suppkey % 2 AS STRING) AS network_id,
       'C' || lpad(CAST(s_suppkey AS STRING), CAST(greatest(6, length(CAST(s_suppkey AS STRING))) AS INT), '0') AS terminal_id, (s_suppkey * 37 % 101) * 50.0 AS x,
       (s_suppkey * 53 % 97) * 50.0 AS y, (s_suppkey * 37 % 101) * 50.0 + 30.0 AS anchor_x, (s_suppkey * 53 % 97) * 50.0 - 40.0 AS anchor_y, (s_suppkey % 9) * 10.0 AS z
FROM supplier"""


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A bridge's rows, from Parquet."""
    used = {t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", sql)}
    text = re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(TABLES)})\b", r"\1 {\2}", sql)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})
