"""Boundaries of any number of vertices, parts and holes, as an index of grid cells.

A cell holds some hundred edges, those that pass through it or within the buffer of it,
and is as wide as a mean edge at least; it is made smaller where that would be too many
for one group.  Each cell knows whether its lower right corner is inside.  A point meets
the edges of its cell: they tell which way its side differs from the corner's, and
whether one is within the buffer.  A cell's points and edges are one group of a task,
which halves the cell in memory until few edges are left to compare, so edges are
shuffled once and not for every small cell that they pass through.

Rings count by the even-odd rule: holes, islands in holes and separate parts need no
marks.  A ray to the right crosses an edge if ``x < x1 + (y - y1) * ((x2 - x1) / (y2 - y1))``
and one end alone is above, in the places as given: points on an edge fall on the side
that this expression says, whatever the grid.  Edges and incidences are tables; only the
count, box and length of the edges come to the driver, and cells without their edges
(one for some hundred edges) are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import materialize
from .roads import _cells

Ring = Sequence[tuple[float, float]]

#: Edges and points of one group, at most, as long as cells can be made smaller and points dealt out.
GROUP_EDGES, GROUP_POINTS = 1_000_000, 200_000
#: Comparisons of points and edges that aren't worth halving a cell for, and those done at once.
FEW, AT_ONCE = 100_000, 1_000_000


def ring_edges(shapes: DataFrame, pts: str = "pts") -> DataFrame:
    """(x1, y1, x2, y2) of rings, one in each row, closed where they aren't."""
    ends = F.expr(f"transform(sequence(0, size({pts}) - 1), i -> struct({pts}[i] AS a, {pts}[(i + 1) % size({pts})] AS b))")
    e = shapes.filter(F.size(pts) > 2).select(F.explode(ends).alias("e"))
    return e.select(F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).filter("x1 <> x2 or y1 <> y2")


def vertex_edges(vertices: DataFrame) -> DataFrame:
    """The same of rings as rows (ring, k, x, y) with k from 0 on; a ring of any size is never in one row."""
    place = lambda n: (F.col("x").alias(f"x{n}"), F.col("y").alias(f"y{n}"))
    k = F.col("k").cast("long")
    last = vertices.groupBy("ring").agg(F.max(k).alias("k"))
    first = vertices.filter("k = 0").select("ring", *place(2)).join(last, "ring").select("ring", "k", "x2", "y2")
    end = vertices.filter("k > 0").select("ring", (k - 1).alias("k"), *place(2)).unionByName(first)
    start = vertices.select("ring", k.alias("k"), *place(1))
    return start.join(end, ["ring", "k"]).select("x1", "y1", "x2", "y2").filter("x1 <> x2 or y1 <> y2")


class Edges:
    """Edges as arrays, and what the ray test and the distance need of them."""

    def __init__(self, x1, y1, x2, y2):
        self.x1, self.y1, self.x2, self.y2 = x1, y1, x2, y2

    def __len__(self) -> int:
        return len(self.x1)

    def take(self, some) -> Edges:
        return Edges(self.x1[some], self.y1[some], self.x2[some], self.y2[some])

    def near_box(self, x: float, y: float, u: float, v: float, pad: float) -> np.ndarray:
        """Whether an edge may come within ``pad`` of a box."""
        dx, dy = self.x2 - self.x1, self.y2 - self.y1
        reach = (np.abs(dy) * (u - x) + np.abs(dx) * (v - y)) / 2 + pad * np.hypot(dx, dy) * 1.000001
        off = np.abs(dx * ((y + v) / 2 - self.y1) - dy * ((x + u) / 2 - self.x1))
        inside = (np.maximum(self.x1, self.x2) >= x - pad) & (np.minimum(self.x1, self.x2) <= u + pad) & (np.maximum(self.y1, self.y2) >= y - pad) & (np.minimum(self.y1, self.y2) <= v + pad)
        return inside & (off <= reach)

    def crossed(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """Whether a ray to the right from each place (rows) crosses each edge (columns)."""
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = (self.x2 - self.x1) / (self.y2 - self.y1)
            return ((self.y1 > py) != (self.y2 > py)) & (px < self.x1 + (py - self.y1) * slope)

    def differs(self, px: np.ndarray, py: np.ndarray, x: float, y: float) -> np.ndarray:
        """Whether each place is on another side than the place x, y.

        The way leads straight to x and then up or down to y.  Ends to the right of that
        leg count for both of their edges, so in a whole ring they cancel; edges that don't
        meet the way add nothing.
        """
        out = np.empty(len(px), bool)
        step = max(1, AT_ONCE // max(1, len(self)))
        at = self.crossed(np.float64(x), np.float64(y))
        for i in range(0, len(px), step):
            a, b = px[i : i + step, None], py[i : i + step, None]
            c = self.crossed(a, b) ^ at
            for ex, ey in ((self.x1, self.y1), (self.x2, self.y2)):
                c ^= (ex > x) & ((ey > y) != (ey > b))
            out[i : i + step] = np.count_nonzero(c, axis=1) % 2 == 1
        return out

    def within(self, px: np.ndarray, py: np.ndarray, buffer_m: float) -> np.ndarray:
        """Whether each place is within the buffer of an edge."""
        out = np.empty(len(px), bool)
        step = max(1, AT_ONCE // max(1, len(self)))
        dx, dy = self.x2 - self.x1, self.y2 - self.y1
        square = dx * dx + dy * dy
        for i in range(0, len(px), step):
            a, b = px[i : i + step, None], py[i : i + step, None]
            t = np.clip(((a - self.x1) * dx + (b - self.y1) * dy) / square, 0.0, 1.0)
            p, q = a - (self.x1 + t * dx), b - (self.y1 + t * dy)
            out[i : i + step] = (np.sqrt(p * p + q * q) <= buffer_m).any(axis=1)
        return out


def in_cell(px: np.ndarray, py: np.ndarray, edges: Edges, box: tuple[float, float, float, float], corner: bool, buffer_m: float) -> np.ndarray:
    """Whether places in a box are inside or within the buffer, from the edges near it and the side of its lower right corner."""
    out = np.zeros(len(px), bool)
    margin = 1e-6 * (box[2] - box[0])
    pad, least = buffer_m + margin, (box[2] - box[0]) / (1 << 20)
    todo = [(np.arange(len(px)), edges, box, corner)]
    while todo:
        some, e, (x, y, u, v), side = todo.pop()
        if buffer_m > 0 and len(e) > 256:
            # Most of those that are near an edge are near one of any few.
            near = e.take(slice(None, None, len(e) // 64)).within(px[some], py[some], buffer_m)
            out[some[near]] = True
            some = some[~near]
        n = len(some)
        if not n:
            continue
        if n <= 4 or n * len(e) <= FEW or u - x < least:
            out[some] = e.differs(px[some], py[some], u, y) != side
            if buffer_m > 0:
                out[some] |= e.within(px[some], py[some], buffer_m)
            continue
        xm, ym = (x + u) / 2, (y + v) / 2
        right, up = px[some] > xm, py[some] > ym
        boxes = [(x, y, xm, ym), (xm, y, u, ym), (x, ym, xm, v), (xm, ym, u, v)]
        corners = e.differs(np.array([b[2] for b in boxes]), np.array([b[1] for b in boxes]), u, y) != side
        for k, b in enumerate(boxes):
            mine = some[(right == bool(k & 1)) & (up == bool(k & 2))]
            if len(mine):
                todo.append((mine, e.take(e.near_box(*b, pad)), b, bool(corners[k])))
    return out


@dataclass(frozen=True)
class Boundary:
    """Edges by the cells of a grid whose corner is x0, y0, and cells (row, col, inside, n) that have edges or are inside."""

    held: DataFrame
    tiles: DataFrame
    x0: float
    y0: float
    cell_m: float
    box: tuple[float, float, float, float]
    buffer_m: float

    @property
    def cells(self) -> DataFrame:
        """(row, col, inside, edges): the index with the edges of each cell in one row."""
        edges = self.held.groupBy("row", "col").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
        return self.tiles.select("row", "col", "inside").join(edges, ["row", "col"], "left").withColumn("edges", F.coalesce("edges", F.array().cast(edges.schema["edges"].dataType)))

    def clip(self, points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
        """Rows of ``points`` inside the boundary or within its buffer; a box comes first, so scans can prune."""
        b, x0, y0, cell = self.buffer_m, self.x0, self.y0, self.cell_m
        near = points.filter(F.col(x).between(self.box[0] - b, self.box[2] + b) & F.col(y).between(self.box[1] - b, self.box[3] + b))
        placed = near.withColumns({"__x": F.col(x).cast("double"), "__y": F.col(y).cast("double")})
        placed = placed.withColumns({"__col": F.floor((F.col("__x") - x0) / cell), "__row": F.floor((F.col("__y") - y0) / cell)})
        some = placed.groupBy("__row", "__col").agg(F.count(F.lit(1)).alias("__p"))
        tiles = self.tiles.select(F.col("row").alias("__row"), F.col("col").alias("__col"), F.col("inside").alias("__inside"), F.col("n").alias("__n"))
        tiles = materialize(tiles.join(some, ["__row", "__col"]).withColumn("__deals", F.ceil(F.col("__p") / GROUP_POINTS)).drop("__p"), "boundary-tiles")
        mine = placed.join(F.broadcast(tiles), ["__row", "__col"])
        names = [F.col(f"`{c}`") for c in points.columns]
        whole = mine.filter("__n = 0 and __inside").select(*names)
        keys = ["__row", "__col", "__deal"]
        left = mine.filter("__n > 0").withColumn("__deal", F.pmod(F.monotonically_increasing_id(), F.col("__deals"))).drop("__n", "__deals")
        edges = self.held.select(F.col("row").alias("__row"), F.col("col").alias("__col"), "x1", "y1", "x2", "y2")
        right = edges.join(F.broadcast(tiles.filter("__n > 0").select("__row", "__col", "__deals")), ["__row", "__col"])
        right = right.withColumn("__deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__deals") - 1))).drop("__deals")
        columns = points.columns

        def keep(key: tuple, p: pa.Table, e: pa.Table) -> pa.Table:
            if not len(p):
                return p.select(columns)
            row, col = key[0].as_py(), key[1].as_py()
            at = Edges(*[e.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")])
            box = (x0 + col * cell, y0 + row * cell, x0 + (col + 1) * cell, y0 + (row + 1) * cell)
            mask = in_cell(p.column("__x").to_numpy(), p.column("__y").to_numpy(), at, box, p.column("__inside")[0].as_py(), b)
            return p.filter(pa.array(mask)).select(columns)

        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(keep, near.schema)
        return found.unionByName(whole)


def boundary(edges: DataFrame, buffer_m: float = 0.0) -> Boundary:
    """The index of a boundary's edges (x1, y1, x2, y2)."""
    edges = materialize(edges.select(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]), "boundary-edges")
    spark = edges.sparkSession
    b = edges.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.least("x1", "x2")).alias("x"), F.min(F.least("y1", "y2")).alias("y"), F.max(F.greatest("x1", "x2")).alias("u"), F.max(F.greatest("y1", "y2")).alias("v"),
        F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length"),
    ).first()
    if not b.n:
        held = spark.createDataFrame([], "row long, col long, x1 double, y1 double, x2 double, y2 double")
        return Boundary(held, spark.createDataFrame([], "row long, col long, inside boolean, n long"), 0.0, 0.0, 1.0, (0.0, 0.0, 0.0, 0.0), 0.0)
    cell = max(16 * ((b.u - b.x) * (b.v - b.y) / b.n) ** 0.5, b.length / b.n, buffer_m)
    least = max(cell / 16, buffer_m)
    while True:
        # The corner lies off by parts of a cell that no round number is a multiple of, so places on cell sides are rare.
        x0, y0 = b.x - buffer_m - 0.041421356 * cell, b.y - buffer_m - 0.031830989 * cell
        ends = lambda n: F.struct((F.col(f"x{n}") - x0).alias("x"), (F.col(f"y{n}") - y0).alias("y"))
        held = edges.withColumns({"a": ends(1), "b": ends(2)}).withColumn("c", F.explode(_cells(cell, buffer_m + 1e-6 * cell)))
        held = held.select(F.col("c.j").alias("row"), F.col("c.i").alias("col"), "x1", "y1", "x2", "y2")
        sizes = materialize(held.groupBy("row", "col").agg(F.count(F.lit(1)).alias("n")), "boundary-sizes")
        if sizes.agg(F.max("n")).first()[0] <= GROUP_EDGES or cell / 2 < least:
            break
        cell /= 2
    rows, cols = (int((high - low + buffer_m) // cell) + 1 for low, high in ((y0, b.v), (x0, b.u)))
    line = F.lit(y0) + F.col("row") * cell
    low, high = (F.floor((f("y1", "y2") - y0) / cell) for f in (F.least, F.greatest))
    met = edges.withColumn("row", F.explode(F.sequence(low, high + 1))).filter((F.col("y1") > line) != (F.col("y2") > line))
    at = F.col("x1") + (line - F.col("y1")) * ((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))
    met = met.groupBy("row", F.floor((at - x0) / cell).alias("col")).agg(F.count(F.lit(1)).alias("crossed"))
    grid = spark.range(rows).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))).alias("col"))
    beyond = F.sum(F.coalesce("crossed", F.lit(0))).over(Window.partitionBy("row").orderBy(F.desc("col")).rowsBetween(Window.unboundedPreceding, -1))
    tiles = grid.join(met, ["row", "col"], "left").join(sizes, ["row", "col"], "left")
    tiles = tiles.select("row", "col", (F.coalesce(beyond, F.lit(0)) % 2 == 1).alias("inside"), F.coalesce("n", F.lit(0).cast("long")).alias("n")).filter("inside or n > 0")
    return Boundary(held, materialize(tiles, "boundary-cells"), x0, y0, cell, (b.x, b.y, b.u, b.v), buffer_m)


def clip(points: DataFrame, shape: DataFrame | Boundary | Ring, buffer_m: float = 0.0, x: str = "x", y: str = "y") -> DataFrame:
    """Rows inside the boundary or within ``buffer_m`` of it.

    ``shape``: an index, a table of rings (pts), or one ring's places.
    """
    if not isinstance(shape, Boundary):
        if not isinstance(shape, DataFrame):
            place = [{"x": float(a), "y": float(b)} for a, b in shape]
            shape = points.sparkSession.createDataFrame([(place,)], "pts array<struct<x:double,y:double>>")
        shape = boundary(ring_edges(shape), buffer_m)
    return shape.clip(points, x, y)
