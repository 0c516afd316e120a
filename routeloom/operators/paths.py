"""Reachability, shortest paths and strict logical networks over directed arcs.

Costs are compared as integers (millionths), so equal sums tie exactly: less time,
then less distance, then the lexicographically smaller sequence of arc ids.

While the arcs are within ``MAX_SHARED_ARCS`` (counted first) they are sent to all
executors and each source is searched there by one heap search.  Beyond that, paths
between stated nodes go through an overlay of cells (``overlay``); without cells, or
without stated ends, they grow by a relaxation loop of joins, a round for each arc.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import GateError
from ..workspace import materialize
from . import overlay, strong

#: Arcs that are sent to every executor, at most (about 300 bytes each there).
MAX_SHARED_ARCS = 400_000
PATHS = "source string, node string, time_u long, distance_u long, arc_ids array<string>"


def costed(arcs: DataFrame) -> DataFrame:
    micro = lambda c: F.round(F.col(c) * 1_000_000).cast("long")
    return arcs.select("arc_id", "from_node", "to_node", micro("time_min").alias("time_u"), micro("distance_m").alias("distance_u"))


def _share(arcs: DataFrame):
    """Adjacency as a broadcast, or None if there are too many arcs."""
    if arcs.limit(MAX_SHARED_ARCS + 1).count() > MAX_SHARED_ARCS:
        return None
    out: dict[str, list] = {}
    for r in arcs.toLocalIterator():
        out.setdefault(r.from_node, []).append((r.to_node, r.time_u, r.distance_u, r.arc_id))
    return arcs.sparkSession.sparkContext.broadcast(out)


def search(adjacent: dict[str, list], source: str, blocked: frozenset[str] | set[str] = frozenset(), limit: int | None = None, wanted: frozenset[str] | None = None) -> dict[str, tuple[int, int, tuple[str, ...]]]:
    """Best (time, distance, arc ids) of every (wanted) node within the time ``limit``; blocked nodes are reached but not passed."""
    tree = overlay.Tree(lambda n: adjacent.get(n, ()), source, blocked, limit)
    return {n: (t, d, tree.path(n)) for n, (t, d, _, _) in tree.done.items() if wanted is None or n in wanted}


def by_overlay(
    weighed: DataFrame, cells: DataFrame, sources: DataFrame, targets: DataFrame, blockers: DataFrame | None = None, stops: DataFrame | None = None, limit: int | None = None, max_arcs: int = overlay.MAX_OVERLAY_ARCS
) -> DataFrame:
    """(source, node, time_u, distance_u, arc_ids) from each of ``sources`` (source) to each of ``targets`` (node) that it reaches.

    ``cells`` (node, cell) has all nodes, a cell's number without its last bits that of a
    larger one.  ``blockers`` (source, node) and ``stops`` (node): nodes that the paths
    from that source, or from any other node, may end at but not pass.
    """
    ends = [(sources.select(F.col("source").alias("node")), False), (targets, False), (blockers, True), (stops, True)]
    keep = reduce(DataFrame.unionByName, [x.select("node", F.lit(hard).alias("hard")) for x, hard in ends if x is not None])
    keep = materialize(keep.groupBy("node").agg(F.max("hard").alias("hard")), "overlay-kept")
    levels = overlay.levels(weighed, cells, keep, limit, max_arcs)
    wanted = targets.select("node").distinct()
    if levels[-1].limit(max_arcs + 1).count() <= max_arcs:
        found = overlay.search_shared(levels[-1], sources, wanted, blockers, stops, limit)
    else:
        found = relax(levels[-1].drop("parts"), sources, blockers, stops, limit).join(wanted, "node", "left_semi").filter("source <> node")
    for up in reversed(levels):
        found = overlay.unpack(found, up)
    own = sources.select("source").distinct().join(wanted, F.col("source") == F.col("node"))
    zero = F.lit(0).cast("long")
    return found.unionByName(own.select("source", "node", zero.alias("time_u"), zero.alias("distance_u"), F.array().cast("array<string>").alias("arc_ids")))


def shortest_paths(
    arcs: DataFrame, sources: DataFrame, blockers: DataFrame | None = None, targets: DataFrame | None = None, max_minutes: float | None = None, cells: DataFrame | None = None
) -> DataFrame:
    """(source, node, time_u, distance_u, arc_ids) from each row of ``sources`` (source).

    ``blockers`` (source, node): nodes that paths from that source may end at but not pass.
    ``targets`` (node): the only ends that are returned.  A search goes no farther than
    ``max_minutes``.  ``cells`` (node, cell): how a graph too large to send is dealt.
    """
    weighed = costed(arcs)
    shared = _share(weighed)
    limit = None if max_minutes is None else round(max_minutes * 1_000_000)
    ends = None if targets is None else targets.select("node").distinct()
    if shared is None and ends is not None and cells is not None:
        return by_overlay(weighed, cells, sources, ends, blockers, limit=limit)
    if shared is None:
        found = relax(weighed, sources, blockers, limit=limit)
        return found if ends is None else found.join(ends, "node", "left_semi").select(found.columns)
    # Ends that aren't nodes of the shared arcs can only be sources themselves.
    wanted = None if ends is None else arcs.sparkSession.sparkContext.broadcast(frozenset(r.node for r in ends.join(_nodes(weighed, sources), "node", "left_semi").toLocalIterator()))
    stops = blockers.groupBy("source").agg(F.collect_set("node").alias("blocked")) if blockers is not None else None
    plan = sources.select("source").distinct()
    plan = plan.join(stops, "source", "left") if stops is not None else plan.withColumn("blocked", F.lit(None).cast("array<string>"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for source, blocked in zip(b["source"], b["blocked"]):
                found = search(shared.value, source, frozenset(blocked) if blocked is not None else frozenset(), limit, None if wanted is None else wanted.value)
                rows = [(source, n, t, d, list(p)) for n, (t, d, p) in found.items()]
                yield pd.DataFrame(rows, columns=["source", "node", "time_u", "distance_u", "arc_ids"])

    n = max(1, int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return plan.repartition(n, "source").mapInPandas(run, PATHS)


def _nodes(weighed: DataFrame, sources: DataFrame) -> DataFrame:
    return weighed.select(F.explode(F.array("from_node", "to_node")).alias("node")).unionByName(sources.select(F.col("source").alias("node"))).distinct()


def relax(weighed: DataFrame, sources: DataFrame, blockers: DataFrame | None = None, stops: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """The same paths by joining a frontier with the arcs until no path improves.

    ``stops`` (node): nodes that no path but one from there passes.
    """
    best = materialize(
        sources.select("source").distinct().select("source", F.col("source").alias("node"), F.lit(0).cast("long").alias("time_u"), F.lit(0).cast("long").alias("distance_u"), F.array().cast("array<string>").alias("arc_ids")),
        "paths",
    )
    frontier = best
    while not frontier.isEmpty():
        live = frontier
        if blockers is not None:
            live = frontier.join(blockers.select("source", "node"), ["source", "node"], "left_anti").unionByName(frontier.filter("source = node")).distinct()
        if stops is not None:
            live = live.join(stops.select(F.col("node").alias("stop")), F.col("node") == F.col("stop"), "left").filter("stop is null or source = node").drop("stop")
        step = live.join(weighed.withColumnsRenamed({"time_u": "dt", "distance_u": "dd"}), F.col("node") == F.col("from_node")).select(
            "source", F.col("to_node").alias("node"), (F.col("time_u") + F.col("dt")).alias("time_u"), (F.col("distance_u") + F.col("dd")).alias("distance_u"), F.concat("arc_ids", F.array("arc_id")).alias("arc_ids")
        )
        if limit is not None:
            step = step.filter(F.col("time_u") <= limit)
        cost = F.struct("time_u", "distance_u", "arc_ids")
        both = best.withColumn("old", F.lit(True)).unionByName(step.withColumn("old", F.lit(False)))
        # The old path wins a tie with itself, so that only improved nodes go on.
        won = both.groupBy("source", "node").agg(F.min(F.struct(cost.alias("c"), (~F.col("old")).alias("new"))).alias("w"))
        won = materialize(won.select("source", "node", "w.c.time_u", "w.c.distance_u", "w.c.arc_ids", "w.new"), "paths")
        best, frontier = won.drop("new"), won.filter("new").drop("new")
    return best


def reachable(arcs: DataFrame, start: str, backward: bool = False) -> DataFrame:
    """(node) reachable from ``start``, or from which it can be reached, itself included."""
    ends = ("to_node", "from_node") if backward else ("from_node", "to_node")
    spark = arcs.sparkSession
    shared = _share(arcs.select(F.col(ends[0]).alias("from_node"), F.col(ends[1]).alias("to_node"), F.lit(0).alias("time_u"), F.lit(0).alias("distance_u"), F.lit("").alias("arc_id")).distinct())
    if shared is not None:

        def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for source in b["node"]:
                    seen, todo = {source}, [source]
                    while todo:
                        for to, *_ in shared.value.get(todo.pop(), ()):
                            if to not in seen:
                                seen.add(to)
                                todo.append(to)
                    yield pd.DataFrame({"node": sorted(seen)})

        return spark.createDataFrame([(start,)], "node string").coalesce(1).mapInPandas(spread, "node string")
    pairs = arcs.select(F.col(ends[0]).alias("a"), F.col(ends[1]).alias("b")).distinct()
    seen = materialize(spark.createDataFrame([(start,)], "node string"), "reached")
    frontier = seen
    while True:
        new = frontier.join(pairs, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(seen, "node", "left_anti")
        new = materialize(new, "reached")
        if new.isEmpty():
            return seen
        seen, frontier = seen.unionByName(new), new


def _placed(snaps: DataFrame, arcs: DataFrame, cells: DataFrame | None) -> DataFrame:
    """(terminal_id, usable, root): whether a terminal's road is near enough, and its anchor's strong component."""
    root = strong.strong_components(arcs, cells)
    near = snaps.select("terminal_id", "truck_anchor_id", (F.coalesce("distance_covered", F.lit(False)) & F.col("truck_anchor_id").isNotNull()).alias("usable"))
    return near.join(root, F.col("truck_anchor_id") == F.col("node"), "left").select("terminal_id", "usable", F.coalesce("root", "truck_anchor_id").alias("root"))


def assess_depots(snaps: DataFrame, arcs: DataFrame, depots: DataFrame, percent: int = 20, provider: str = "osm", cells: DataFrame | None = None) -> DataFrame:
    """The road source's gate from each of ``depots`` (terminal_id): one row each.

    A terminal is usable if its road is near enough and it and the Depot reach each
    other.  The source qualifies if the Depot is attached and fewer than ``percent``
    in a hundred demand terminals are unusable, compared in integers.  Strong
    components are found once, and a Depot is looked up among them.
    """
    placed = materialize(_placed(snaps, arcs, cells), "gate-terminals")
    n = placed.count()
    together = placed.filter("usable").groupBy("root").agg(F.count(F.lit(1)).alias("together"))
    own = placed.join(depots.select("terminal_id").distinct(), "terminal_id", "left_semi").join(together, "root", "left")
    demand, usable = F.lit(n - 1).cast("long"), F.when(F.col("usable"), F.col("together") - 1).otherwise(0)
    out = own.select(demand.alias("demand_denominator"), (demand - usable).alias("inaccessible_count"), F.col("usable").alias("depot_attached"), F.col("terminal_id").alias("depot_terminal_id"))
    d, k = F.col("demand_denominator"), F.col("inaccessible_count")
    return out.select(
        "demand_denominator", "inaccessible_count", F.when(d > 0, k / d).otherwise(0.0).alias("inaccessible_ratio"), "depot_attached", "depot_terminal_id", F.lit(provider).alias("provider"),
        (F.col("depot_attached") & (100 * k < percent * d)).alias("qualified"), F.lit(f"inaccessible < {percent}% of demand and Depot attached").alias("rule"),
    )


def inaccessible(snaps: DataFrame, arcs: DataFrame, depot: str, cells: DataFrame | None = None) -> DataFrame:
    """(terminal_id): the terminals that are unusable from a Depot."""
    placed = materialize(_placed(snaps, arcs, cells), "gate-terminals")
    home = placed.filter((F.col("terminal_id") == depot) & F.col("usable")).select("root").distinct()
    met = placed.filter("usable").join(home, "root", "left_semi").select("terminal_id")
    return placed.filter(F.col("terminal_id") != depot).join(met, "terminal_id", "left_anti").select("terminal_id")


def assess(snaps: DataFrame, arcs: DataFrame, depot: str, percent: int = 20, provider: str = "osm", cells: DataFrame | None = None) -> DataFrame:
    """The gate from one Depot; which terminals it can't use is ``inaccessible``'s table."""
    if snaps.filter(F.col("terminal_id") == depot).isEmpty():
        raise GateError(f"no Depot terminal {depot}")
    return assess_depots(snaps, arcs, snaps.filter(F.col("terminal_id") == depot), percent, provider, cells)


def choose_source(candidates: list[tuple[str, DataFrame, DataFrame, bool]], depot: str, percent: int = 20) -> list[dict]:
    """Assessments of (provider, snaps, arcs, licence verified) in order, up to the first that qualifies.

    A later provider is tried only if the one before failed and its licence is verified.
    """
    rows = []
    for provider, snaps, arcs, licensed in candidates:
        if rows and not licensed:
            raise GateError(f"licence of {provider} is not verified")
        rows.append({"attempt": len(rows) + 1, **assess(snaps, arcs, depot, percent, provider).first().asDict()})
        if rows[-1]["qualified"]:
            return rows
    raise GateError("licensed_local_source_required")


def logical_network(arcs: DataFrame, terminals: DataFrame, scope: DataFrame | None = None, cells: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(logical arcs, lineage) between the active terminals of a scope.

    Paths end at the first other anchor they meet.  They are searched anew for the
    scope, as an anchor outside it blocks nothing.  Terminals that share an anchor
    stay apart and get no arc to one another.  Lineage has a row for each arc of a
    path, in order.  ``cells`` (node, cell): how a graph too large to send is dealt.
    """
    live = terminals.filter(F.col("truck_service_status") == "active").filter("truck_anchor_id is not null")
    if scope is not None:
        live = live.join(scope.select("terminal_id"), "terminal_id", "left_semi")
    anchors = live.select(F.col("truck_anchor_id").alias("source")).distinct()
    # Blockers are the other anchors; a search passes its own source, so one set serves all.
    weighed = costed(arcs)
    few = anchors.limit(MAX_SHARED_ARCS + 1).count() <= MAX_SHARED_ARCS
    shared = _share(weighed) if few else None
    if shared is not None:
        nodes = [r.source for r in anchors.collect()]
        blocked = arcs.sparkSession.sparkContext.broadcast(frozenset(nodes))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for source in b["source"]:
                    found = search(shared.value, source, blocked.value, wanted=blocked.value)
                    rows = [(source, n, t, d, list(p)) for n, (t, d, p) in found.items() if n != source]
                    yield pd.DataFrame(rows, columns=["source", "node", "time_u", "distance_u", "arc_ids"])

        paths = anchors.repartition(max(1, min(len(nodes), int(arcs.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "source").mapInPandas(run, PATHS)
    else:
        stops = anchors.select(F.col("source").alias("node"))
        found = relax(weighed, anchors, stops=stops) if cells is None else by_overlay(weighed, cells, anchors, stops, stops=stops)
        paths = found.join(stops, "node", "left_semi").filter("source <> node")
    a = live.select(F.col("terminal_id").alias("from_terminal"), F.col("truck_anchor_id").alias("source"))
    b = live.select(F.col("terminal_id").alias("to_terminal"), F.col("truck_anchor_id").alias("node"))
    logical = paths.join(a, "source").join(b, "node").select(
        F.concat_ws(">", "from_terminal", "to_terminal").alias("contracted_logical_arc_id"),
        F.concat_ws("~", F.least("from_terminal", "to_terminal"), F.greatest("from_terminal", "to_terminal")).alias("contracted_logical_connection_id"),
        "from_terminal", "to_terminal",
        (F.col("time_u") / 1e6).alias("time_min"), (F.col("distance_u") / 1e6).alias("distance_m"),
        F.col("arc_ids").alias("canonical_directed_physical_arc_ids"),
    )
    lineage = logical.select("contracted_logical_arc_id", F.posexplode("canonical_directed_physical_arc_ids").alias("position", "arc_id"))
    return logical, lineage


def lineage_costs(lineage: DataFrame, arcs: DataFrame) -> DataFrame:
    """Sums of the physical costs along each logical arc."""
    names = ["distance_m", "time_min", "truck_energy_kwh", "cumulative_ascent_m", "cumulative_descent_m"]
    have = [c for c in names if c in arcs.columns]
    return lineage.join(arcs.select("arc_id", *have), "arc_id").groupBy("contracted_logical_arc_id").agg(*[F.sum(c).alias(c) for c in have], F.count(F.lit(1)).alias("n_arcs"))


def backbone(lineage: DataFrame, arcs: DataFrame) -> DataFrame:
    """Distinct physical edges that any path uses."""
    return lineage.join(arcs.select("arc_id", "edge_id"), "arc_id").select("edge_id").distinct()
