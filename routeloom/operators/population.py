"""Population cells to demand components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import GateError
from .boundary import clip  # noqa: F401  cells and points are clipped alike
from .components import components

#: Adjacencies that one task labels; larger grids are labelled by rounds of joins.
SMALL_GRAPH = 200_000
#: Forward half of the eight neighbours: each adjacency once.
FORWARD = [(0, 1), (1, -1), (1, 0), (1, 1)]


def resample_sum(cells: DataFrame, factor: int = 2) -> DataFrame:
    """Aligned sum of ``factor`` x ``factor`` cells: keeps the total."""
    return cells.groupBy((F.floor(F.col("row") / factor)).cast("int").alias("row"), (F.floor(F.col("col") / factor)).cast("int").alias("col")).agg(F.sum("pop").alias("pop"))


def resample_area(cells: DataFrame, source: dict, target: dict) -> DataFrame:
    """Cells of one grid on another by the share of each cell's area: keeps the total.

    Grids: x0 and y0 of the upper left corner and cell_m; rows go down.  A cell meets
    only the target cells that it overlaps.
    """
    s, t = source["cell_m"], target["cell_m"]
    left = F.lit(source["x0"] - target["x0"]) + F.col("col") * s
    top = F.lit(target["y0"] - source["y0"]) + F.col("row") * s

    def overlaps(start: Column) -> Column:
        """(i, share): target cells along one axis and the share of the source cell in each."""
        last = F.ceil((start + s) / t) - 1
        each = F.sequence(F.floor(start / t), F.greatest(last, F.floor(start / t)))
        share = lambda i: (F.least((i + 1) * t, start + s) - F.greatest(i * t, start)) / s
        return F.filter(F.transform(each, lambda i: F.struct(i.cast("int").alias("i"), share(i).alias("share"))), lambda e: e["share"] > 0)

    parts = cells.select(F.explode(overlaps(top)).alias("r"), "col", "pop").select("r", F.explode(overlaps(left)).alias("c"), "pop")
    return parts.groupBy(F.col("r.i").alias("row"), F.col("c.i").alias("col")).agg(F.sum(F.col("pop") * F.col("r.share") * F.col("c.share")).alias("pop"))


def above_threshold(cells: DataFrame, threshold: float = 0.0) -> DataFrame:
    return cells.filter(F.col("pop") > threshold)


def calibrate(cells: DataFrame, official_total: float | None) -> DataFrame:
    """Cells scaled so that they sum to the official figure; without one they stay."""
    if official_total is None:
        return cells
    total = cells.agg(F.sum("pop").alias("__total"))
    return cells.crossJoin(F.broadcast(total)).withColumn("pop", F.col("pop") * F.lit(float(official_total)) / F.col("__total")).drop("__total")


def label_components(cells: DataFrame) -> DataFrame:
    """``cells`` with ``component``: the smallest cell key (row * 2^31 + col) among 8-connected cells.

    Neighbours meet by an equi-join on shifted coordinates, each adjacency once.
    """
    key = (F.col("row").cast("long") * F.lit(2**31) + F.col("col")).alias("key")
    keyed = cells.withColumn("key", key)
    shifts = F.explode(F.array(*[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in FORWARD]))
    near = keyed.select(F.col("key").alias("a"), "row", "col", shifts.alias("d")).select("a", (F.col("row") + F.col("d.dr")).alias("r"), (F.col("col") + F.col("d.dc")).alias("c"))
    edges = near.join(keyed.select(F.col("key").alias("b"), "row", "col"), (F.col("r") == F.col("row")) & (F.col("c") == F.col("col"))).select("a", "b")
    root = components(edges, "cells", small=SMALL_GRAPH)
    return keyed.join(root, F.col("key") == F.col("node"), "left").withColumn("component", F.coalesce("root", "key")).drop("node", "root", "key")


def demand_nodes(cells: DataFrame, cell_m: float = 100.0, official_total: float | None = None, threshold: float = 0.0) -> DataFrame:
    """Population, weighted centroid and size of each component of calibrated cells."""
    live = label_components(calibrate(above_threshold(cells, threshold), official_total))
    x, y = (F.col("col") + 0.5) * cell_m, (F.col("row") + 0.5) * cell_m
    return live.groupBy("component").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.sum("pop").alias("population"),
        (F.sum(F.col("pop") * x) / F.sum("pop")).alias("x_m"),
        (F.sum(F.col("pop") * y) / F.sum("pop")).alias("y_m"),
    )


def require_several(nodes: DataFrame) -> DataFrame:
    """The nodes, unless there is only one component, which is reported instead of used."""
    if nodes.limit(2).count() < 2:
        raise GateError("population threshold leaves a single component")
    return nodes


def audit(nodes: DataFrame, depot_component: int) -> DataFrame:
    """Counts with and without the Depot, and the total kept."""
    return nodes.agg(
        F.count(F.lit(1)).alias("population_components_including_depot"),
        F.count_if(F.col("component") != depot_component).alias("demand_nodes_excluding_depot"),
        F.sum("population").alias("final_component_population_total"),
    )
