"""Shortest paths on graphs that are too large to send around: an overlay of cells, in levels.

Nodes are dealt into cells.  In one pass each cell is searched by itself, from each of
its border nodes (ends of arcs between cells, and sources, targets and blockers): the
best path to another border node becomes one arc of the overlay, unless it passes a
border node, as then it is made of shorter overlay arcs.  Arcs between cells stay.  If
the overlay still has too many arcs, it is dealt into cells of sixteen and searched the
same way.  Then it is sent to all executors and each source is searched there (were it
too large for that on every level, paths would grow on it by joins, an overlay arc in
each), and the arcs of the paths found are replaced by what they stand for, level by
level.  The number of passes grows with the logarithm of the graph and not with the
arcs of a path.

Ties are those of the plain search: less time, then less distance, then the smaller
sequence of arc ids.  No overlay arc out of a node is the beginning of another one, so
sequences compare as their first arcs that differ, and the rank of an arc among those of
its node stands for it on the next level.

A cell is one task's work; ``quad_cells`` deals by place so that none has more nodes
than stated, however dense the graph is somewhere.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import materialize

#: Overlay arcs that are sent to every executor, at most (some 300 bytes each in the driver meanwhile).
MAX_OVERLAY_ARCS = 200_000
CELL_NODES = 1_000
DEPTH = 12
_PASS = "from_node string, to_node string, time_u long, distance_u long, parts array<string>"
PATHS = "source string, node string, time_u long, distance_u long, arc_ids array<string>"


class Tree:
    """Best paths from one node, as each node's last arc; blocked nodes are reached but not passed.

    ``out`` gives a node's arcs (to, time, distance, arc); arcs of one node compare as
    their ids do.  Paths are put together only where two are equally long.
    """

    def __init__(self, out: Callable[[object], Iterable[tuple]], source, blocked=frozenset(), limit: int | None = None):
        self.source = source
        self.done: dict = {}
        best, last, heap = {source: (0, 0)}, {source: [(None, None)]}, [(0, 0, 0, source)]
        n = 0
        while heap:
            t, d, _, node = heapq.heappop(heap)
            if node in self.done or best[node] != (t, d):
                continue
            choice = last.pop(node)
            before, arc = choice[0] if len(choice) == 1 else min(choice, key=lambda c: (*self.path(c[0]), c[1]))
            self.done[node] = (t, d, before, arc)
            if node in blocked and node != source:
                continue
            for to, dt, dd, arc in out(node):
                if to in self.done or (limit is not None and t + dt > limit):
                    continue
                key, old = (t + dt, d + dd), best.get(to)
                if old is None or key < old:
                    best[to], last[to] = key, [(node, arc)]
                    n += 1
                    heapq.heappush(heap, (*key, n, to))
                elif key == old:
                    last[to].append((node, arc))

    def path(self, node) -> tuple:
        out = []
        while node != self.source:
            _, _, node, arc = self.done[node]
            out.append(arc)
        return tuple(reversed(out))

    def beyond(self, marked) -> set:
        """Nodes whose path passes a marked one."""
        found = set()
        for node, (_, _, before, _) in self.done.items():
            if before is not None and before != self.source and (before in marked or before in found):
                found.add(node)
        return found


def interleave(i: Column, j: Column) -> Column:
    """The bits of i and j in turn: cells of a square are numbers in a row."""
    bits = [F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1)), 2 * b + k) for b in range(DEPTH) for k, v in enumerate((i, j))]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def quad_cells(nodes: DataFrame, max_nodes: int = CELL_NODES) -> DataFrame:
    """(node, cell) of places (node, x, y): the largest squares of at most ``max_nodes`` nodes, or the smallest there are.

    A cell's number without its last two bits is that of the square of four around it.
    """
    b = nodes.agg(F.min("x").alias("x"), F.min("y").alias("y"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side")).first()
    side = max(b.side or 0.0, 1e-9) * (1 + 1e-9) / (1 << DEPTH)
    at = lambda c, low: F.floor((F.col(c) - F.lit(low)) / side).cast("long")
    coded = nodes.select("node", (interleave(at("x", b.x), at("y", b.y)) + F.lit(1 << 2 * DEPTH)).alias("code"))
    counts = coded.groupBy("code").count()
    around = counts.select("code", "count", F.explode(F.expr(f"transform(sequence(0, {DEPTH}), s -> shiftright(code, 2 * s))")).alias("cell"))
    small = around.groupBy("cell").agg(F.sum("count").alias("n")).filter(F.col("n") <= max_nodes).select("cell")
    leaf = around.join(small, "cell", "left_semi").groupBy("code").agg(F.min("cell").alias("cell"))
    return coded.join(leaf, "code", "left").select("node", F.coalesce("cell", "code").alias("cell"))


def _cell_paths(limit: int | None):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {}
        arcs = rows[rows["to_node"].notna()].sort_values("arc_id")
        for f, to, t, d, arc in zip(arcs["from_node"], arcs["to_node"], arcs["time_u"], arcs["distance_u"], arcs["arc_id"]):
            out.setdefault(f, []).append((to, int(t), int(d), arc))
        marks = rows[rows["to_node"].isna()]
        border = set(marks["from_node"])
        hard = set(marks.loc[marks["hard"].astype(bool), "from_node"])
        found = []
        for source in sorted(border):
            if source not in out:
                continue
            tree = Tree(lambda n: out.get(n, ()), source, hard, limit)
            past = tree.beyond(border)
            found += [(source, n, *tree.done[n][:2], list(tree.path(n))) for n in tree.done if n in border and n not in past and n != source]
        return pd.DataFrame(found, columns=["from_node", "to_node", "time_u", "distance_u", "parts"])

    return run


def levels(weighed: DataFrame, cells: DataFrame, keep: DataFrame, limit: int | None, max_arcs: int) -> list[DataFrame]:
    """Overlays, each over the one before it, until one has ``max_arcs`` at most or larger cells no longer help.

    They don't once a third of the nodes are kept ones, which are on every level.
    """
    kept = keep.count()
    cells = materialize(cells.select("node", F.col("cell").cast("long").alias("cell")), "overlay-cells")
    out, arcs, size = [], weighed, None
    while True:
        made = level(arcs, cells, keep, limit)
        n = made.count()
        if size is not None and n > 0.8 * size:
            return out
        out, arcs, size = [*out, made], made.drop("parts"), n
        if n <= max_arcs or made.select("from_node").distinct().count() < 3 * kept:
            return out
        cells = cells.withColumn("cell", F.greatest(F.shiftright("cell", 4), F.lit(1).cast("long")))
        if cells.select("cell").distinct().limit(4).count() < 4:
            return out


def level(arcs: DataFrame, cells: DataFrame, keep: DataFrame, limit: int | None = None) -> DataFrame:
    """Overlay arcs (arc_id, from_node, to_node, time_u, distance_u, parts) over ``arcs``, of which each stands for some.

    ``cells`` (node, cell); ``keep`` (node, hard): nodes that stay, and whether no path but one from there passes them.
    """
    ends = [cells.select(F.col("node").alias(f"{e}_node"), F.col("cell").alias(f"{e}_cell")) for e in ("from", "to")]
    placed = materialize(arcs.join(ends[0], "from_node").join(ends[1], "to_node"), "overlay-arcs")
    inner, cross = placed.filter("from_cell = to_cell"), placed.filter("from_cell <> to_cell")
    border = cross.select(F.explode(F.array("from_node", "to_node")).alias("node")).select("node", F.lit(False).alias("hard"))
    marks = border.unionByName(keep.select("node", "hard")).groupBy("node").agg(F.max("hard").alias("hard")).join(cells, "node")
    none = lambda kind: F.lit(None).cast(kind)
    rows = inner.select(F.col("from_cell").alias("cell"), "from_node", "to_node", "time_u", "distance_u", "arc_id", F.lit(False).alias("hard")).unionByName(
        marks.select("cell", F.col("node").alias("from_node"), none("string").alias("to_node"), none("long").alias("time_u"), none("long").alias("distance_u"), none("string").alias("arc_id"), "hard")
    )
    through = rows.groupBy("cell").applyInPandas(_cell_paths(limit), _PASS)
    both = through.unionByName(cross.select("from_node", "to_node", "time_u", "distance_u", F.array("arc_id").alias("parts")))
    rank = F.row_number().over(Window.partitionBy("from_node").orderBy("parts"))
    named = both.withColumn("arc_id", F.concat_ws("|", F.lpad(rank.cast("string"), 9, "0"), "from_node"))
    return materialize(named.select("arc_id", "from_node", "to_node", "time_u", "distance_u", "parts"), "overlay")


class Shared:
    """Arcs as arrays: those of a node stand together, in the order of their ids."""

    def __init__(self, arcs: pd.DataFrame):
        arcs = arcs.sort_values(["from_node", "arc_id"])
        self.nodes = sorted(set(arcs["from_node"]) | set(arcs["to_node"]))
        self.number = {n: i for i, n in enumerate(self.nodes)}
        start = arcs["from_node"].map(self.number).to_numpy(np.int64)
        self.first = np.searchsorted(start, np.arange(len(self.nodes) + 1))
        self.to = arcs["to_node"].map(self.number).to_numpy(np.int32)
        self.time, self.distance = arcs["time_u"].to_numpy(np.int64), arcs["distance_u"].to_numpy(np.int64)

    def out(self, node: int) -> Iterable[tuple]:
        a, b = self.first[node], self.first[node + 1]
        return zip(self.to[a:b].tolist(), self.time[a:b].tolist(), self.distance[a:b].tolist(), range(a, b))

    def arc_id(self, arc: int) -> str:
        node = int(np.searchsorted(self.first, arc, side="right")) - 1
        return f"{arc - int(self.first[node]) + 1:09d}|{self.nodes[node]}"


def search_shared(top: DataFrame, sources: DataFrame, targets: DataFrame, blockers: DataFrame | None, stops: DataFrame | None, limit: int | None) -> DataFrame:
    spark = top.sparkSession
    graph = Shared(top.select("arc_id", "from_node", "to_node", "time_u", "distance_u").toPandas())
    shared = spark.sparkContext.broadcast(graph)
    plan = sources.select("source").distinct()
    if blockers is not None:
        plan = plan.join(blockers.groupBy("source").agg(F.collect_set("node").alias("blocked")), "source", "left")
    else:
        plan = plan.withColumn("blocked", F.lit(None).cast("array<string>"))
    every = stops is not None
    # Marks are nodes of the overlay, so these are no more than it has.
    here = spark.createDataFrame([(n,) for n in graph.nodes], "node string") if graph.nodes else targets.limit(0).select("node")
    wanted = spark.sparkContext.broadcast(frozenset(r.node for r in targets.select("node").distinct().join(here, "node", "left_semi").toLocalIterator()))
    barred = spark.sparkContext.broadcast(frozenset(graph.number[r.node] for r in stops.select("node").distinct().join(here, "node", "left_semi").toLocalIterator()) if every else frozenset())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = shared.value
        for b in batches:
            for source, blocked in zip(b["source"], b["blocked"]):
                start = g.number.get(source)
                if start is None:
                    continue
                mine = {g.number[n] for n in blocked if n in g.number} if blocked is not None else set()
                tree = Tree(g.out, start, barred.value | mine, limit)
                ends = [n for n in (g.nodes[i] for i in tree.done) if n in wanted.value and n != source]
                rows = [(source, n, *tree.done[g.number[n]][:2], [g.arc_id(a) for a in tree.path(g.number[n])]) for n in ends]
                yield pd.DataFrame(rows, columns=["source", "node", "time_u", "distance_u", "arc_ids"])

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return plan.repartition(n, "source").mapInPandas(run, PATHS)


def unpack(paths: DataFrame, arcs: DataFrame) -> DataFrame:
    """Paths whose arcs are replaced, in order, by the parts they stand for."""
    each = paths.select("source", "node", "time_u", "distance_u", F.posexplode("arc_ids").alias("i", "arc_id"))
    parts = each.join(arcs.select("arc_id", "parts"), "arc_id")
    whole = parts.groupBy("source", "node", "time_u", "distance_u").agg(F.sort_array(F.collect_list(F.struct("i", "parts"))).alias("p"))
    return whole.select("source", "node", "time_u", "distance_u", F.flatten(F.transform("p", lambda p: p["parts"])).alias("arc_ids"))
