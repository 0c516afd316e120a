"""Roads to a directed graph: noding, nodes and edges, service insertion, class gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import segment_distance, segment_fraction
from ..workspace import materialize

FORWARD_TAGS, REVERSE_TAGS = ("yes", "true", "1"), ("-1", "reverse")
#: Values of the access tag that close a road to service.
CLOSED_ACCESS = ("private", "no")
#: Road classes that count as secondary; all others are residential.
SECONDARY = ("motorway", "trunk", "primary", "secondary", "motorway_link", "trunk_link", "primary_link", "secondary_link")


def open_roads(roads: DataFrame) -> DataFrame:
    return roads.filter(~F.coalesce(F.lower("access"), F.lit("")).isin(*CLOSED_ACCESS))


def final_class(road_class: Column) -> Column:
    return F.when(F.lower(road_class).isin(*SECONDARY), "secondary").otherwise("residential")


def directions(oneway: Column) -> tuple[Column, Column]:
    """(forward allowed, reverse allowed)."""
    tag = F.coalesce(F.lower(oneway), F.lit("no"))
    return ~tag.isin(*REVERSE_TAGS), ~tag.isin(*FORWARD_TAGS)


def _segments(roads: DataFrame) -> DataFrame:
    """One row for each straight piece; ``seq`` counts from 0."""
    at = F.posexplode(F.expr("transform(sequence(0, size(pts) - 2), i -> struct(pts[i] as a, pts[i + 1] as b))"))
    return roads.filter(F.size("pts") >= 2).select("source_id", "grade_key", at.alias("seq", "s")).select("source_id", "grade_key", "seq", "s.a", "s.b")


def snapped(v: Column, precision_m: float) -> Column:
    scale = F.lit(1 / precision_m)
    return F.rint(v * scale) / scale


def _cells(cell_m: float, pad: float = 0.0) -> Column:
    """Grid cells that segment a-b passes through, or within ``pad`` of it: for each column of cells the
    rows between the heights at which it enters and leaves."""
    x1, x2 = F.least("a.x", "b.x") - pad, F.greatest("a.x", "b.x") + pad
    low, high = F.least("a.y", "b.y") - pad, F.greatest("a.y", "b.y") + pad
    slope = F.when(F.col("b.x") == F.col("a.x"), F.lit(None)).otherwise((F.col("b.y") - F.col("a.y")) / (F.col("b.x") - F.col("a.x")))
    reach = F.lit(pad) + F.lit(pad) * F.abs(slope)

    def column(i: Column) -> Column:
        at = [F.col("a.y") + slope * (F.greatest(F.least(i * cell_m + shift, x2), x1) - F.col("a.x")) for shift in (0.0, cell_m)]
        bottom = F.coalesce(F.greatest(F.least(*at) - reach, low), low)
        top = F.coalesce(F.least(F.greatest(*at) + reach, high), high)
        return F.transform(F.sequence(F.floor(bottom / cell_m), F.floor(top / cell_m)), lambda j: F.struct(i.alias("i"), j.alias("j")))

    return F.flatten(F.transform(F.sequence(F.floor(x1 / cell_m), F.floor(x2 / cell_m)), column))


def cuts(roads: DataFrame, cell_m: float = 500.0, precision_m: float = 0.001) -> DataFrame:
    """(source_id, grade_key, pos, x, y): places along a road (segment number plus fraction) where another piece
    of the same grade crosses or touches it, and the node there.

    Pieces meet by grid cell and grade, so only near ones are compared.  A crossing is
    worked out once, for both roads, in the cell that it lies in: its node is the end
    that touches, or the crossing on the precision grid, and both roads are cut at it.
    """
    s = _segments(roads).withColumn("cell", F.explode(_cells(cell_m, 2 * precision_m)))

    def side(n: str) -> DataFrame:
        return s.select("grade_key", "cell", F.struct(F.col("source_id").alias("id"), "seq").alias(n), F.col("a").alias(f"{n}0"), F.col("b").alias(f"{n}1"))

    pairs = side("p").join(side("q"), ["grade_key", "cell"]).filter("p < q and (p.id <> q.id or q.seq - p.seq > 1)")
    d = lambda v, w, axis: F.col(f"{w}.{axis}") - F.col(f"{v}.{axis}")
    cross = d("p0", "p1", "x") * d("q0", "q1", "y") - d("p0", "p1", "y") * d("q0", "q1", "x")
    t = (d("p0", "q0", "x") * d("q0", "q1", "y") - d("p0", "q0", "y") * d("q0", "q1", "x")) / cross
    u = (d("p0", "q0", "x") * d("p0", "p1", "y") - d("p0", "q0", "y") * d("p0", "p1", "x")) / cross
    met = pairs.filter(cross != 0).withColumn("t", t).withColumn("u", u)
    place = F.struct((F.col("p0.x") + F.col("t") * d("p0", "p1", "x")).alias("x"), (F.col("p0.y") + F.col("t") * d("p0", "p1", "y")).alias("y"))
    met = met.withColumn("at", place).filter((F.floor(F.col("at.x") / cell_m) == F.col("cell.i")) & (F.floor(F.col("at.y") / cell_m) == F.col("cell.j")))

    def end(fraction: str, n: str) -> Column:
        """0 or 1 where the place lies at that end, within the precision; the fraction where it lies between; else null."""
        near = F.lit(1.5 * precision_m) / F.hypot(d(f"{n}0", f"{n}1", "x"), d(f"{n}0", f"{n}1", "y"))
        f = F.col(fraction)
        return F.when(F.abs(f) <= near, 0.0).when(F.abs(f - 1) <= near, 1.0).when(f.between(0, 1), f)

    met = met.withColumn("t", end("t", "p")).withColumn("u", end("u", "q")).filter("t is not null and u is not null")
    grid = F.struct(snapped(F.col("at.x"), precision_m).alias("x"), snapped(F.col("at.y"), precision_m).alias("y"))
    ends = F.when(F.col("t") == 0, F.col("p0")).when(F.col("t") == 1, F.col("p1")).when(F.col("u") == 0, F.col("q0")).when(F.col("u") == 1, F.col("q1"))
    met = met.withColumn("node", F.coalesce(ends, grid))
    both = F.array(*[F.struct(F.col(f"{n}.id").alias("source_id"), (F.col(f"{n}.seq") + F.col(f)).alias("pos")) for n, f in (("p", "t"), ("q", "u"))])
    return met.select(F.explode(both).alias("c"), "grade_key", "node").select("c.source_id", "grade_key", "c.pos", "node.x", "node.y").distinct()


def hot_cuts(roads: DataFrame, met: DataFrame, cell_m: float = 500.0, precision_m: float = 0.001) -> DataFrame:
    """(source_id, pos, x, y): where a road passes the grid's pixel around a vertex or crossing of its grade.

    Crossings that are moved to the grid, and vertices of roads that lie along one another,
    are nodes of every road that comes so near to them, so no crossing is left between
    nodes and what overlaps has the same pieces.  A vertex that only its own road passes,
    once, is no node.  ``met``: the crossings (grade_key, x, y).
    """
    s = _segments(roads).withColumn("cell", F.explode(_cells(cell_m, 2 * precision_m)))
    spots = roads.select("grade_key", F.explode("pts").alias("p")).select("grade_key", "p.x", "p.y").unionByName(met.select("grade_key", "x", "y")).distinct()
    cell = F.struct(F.floor(F.col("x") / cell_m).alias("i"), F.floor(F.col("y") / cell_m).alias("j"))
    near = s.join(spots.withColumn("cell", cell), ["grade_key", "cell"])
    dx, dy, x, y = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y"), F.col("x"), F.col("y")
    half = precision_m / 2 * (1 + 1e-6)
    beside = lambda v, axis: v.between(F.least(f"a.{axis}", f"b.{axis}") - half, F.greatest(f"a.{axis}", f"b.{axis}") + half)
    across = F.abs(dx * (y - F.col("a.y")) - dy * (x - F.col("a.x"))) <= half * (F.abs(dx) + F.abs(dy))
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (dx * (x - F.col("a.x")) + dy * (y - F.col("a.y"))) / (dx * dx + dy * dy)))
    at = F.when((x == F.col("a.x")) & (y == F.col("a.y")), 0.0).when((x == F.col("b.x")) & (y == F.col("b.y")), 1.0).otherwise(along)
    hits = near.filter(beside(x, "x") & beside(y, "y") & across & ((dx != 0) | (dy != 0))).select("grade_key", "x", "y", F.struct("source_id", (F.col("seq") + at).alias("pos")).alias("c"))
    nodes = hits.groupBy("grade_key", "x", "y").agg(F.collect_set("c").alias("c")).filter(F.size("c") > 1)
    return nodes.select(F.explode("c").alias("c"), "x", "y").select("c.source_id", "c.pos", "x", "y")


def merge_overlaps(segments: DataFrame) -> DataFrame:
    """Straight segments of one grade between the same two nodes as one, that of the smallest id.

    It may be used in each direction that one of them may be used in, and is of a
    secondary class if one of them is.
    """
    p, q = F.element_at("pts", 1), F.element_at("pts", -1)
    straight = (F.size("pts") == 2) & (p != q)
    forward, reverse = directions(F.col("oneway"))
    flip = p > q
    lines = segments.filter(straight).withColumns({"__p": F.least(p, q), "__q": F.greatest(p, q), "__flip": flip, "__f": F.when(flip, reverse).otherwise(forward), "__r": F.when(flip, forward).otherwise(reverse)})
    own = F.struct("segment_id", "source_id", "road_class", "oneway", "pts", "__flip")
    best = F.min(F.struct((final_class(F.col("road_class")) != "secondary").alias("minor"), "road_class"))
    one = lines.groupBy("grade_key", "__p", "__q").agg(F.min(own).alias("o"), F.bool_or("__f").alias("f"), F.bool_or("__r").alias("r"), best.alias("b"), F.count(F.lit(1)).alias("n"))
    ahead, back = F.when(F.col("o.__flip"), F.col("r")).otherwise(F.col("f")), F.when(F.col("o.__flip"), F.col("f")).otherwise(F.col("r"))
    several = F.col("n") > 1
    merged = one.select(
        "o.segment_id", "o.source_id", "grade_key", F.when(several, F.col("b.road_class")).otherwise(F.col("o.road_class")).alias("road_class"),
        F.when(~several, F.col("o.oneway")).when(ahead & back, "no").when(ahead, "yes").otherwise("-1").alias("oneway"), "o.pts",
    )
    return segments.filter(~straight).unionByName(merged)


def noded_segments(roads: DataFrame, cell_m: float = 500.0, precision_m: float = 0.001) -> DataFrame:
    """Roads cut where they meet others of their grade: (segment_id, attributes, pts).

    Vertices are put on the precision grid first; two roads that meet share their node
    exactly, and a road that passes a node's pixel goes through the node, so moving
    crossings to the grid makes no new ones.  Pieces that lie along one another are cut
    at each other's vertices and become one.  No piece is invented.  A closed ring that
    meets nothing is cut at its start and at its middle vertex.
    """
    place = lambda p: F.struct(snapped(p["x"], precision_m).alias("x"), snapped(p["y"], precision_m).alias("y"))
    roads = roads.filter(F.size("pts") >= 2).withColumn("pts", F.transform("pts", place))
    kind = "array<struct<pos:double,x:double,y:double>>"
    met = materialize(cuts(roads, cell_m, precision_m), "road-cuts")
    every = met.select("source_id", "pos", "x", "y").unionByName(hot_cuts(roads, met, cell_m, precision_m))
    # A place found both ways has positions that differ by rounding; at a vertex the whole number is meant.
    each = every.groupBy("source_id", "x", "y", F.round("pos", 4).alias("near")).agg(F.min_by("pos", F.struct(F.abs(F.col("pos") - F.rint("pos")), "pos")).alias("pos"))
    found = each.groupBy("source_id").agg(F.collect_list(F.struct("pos", "x", "y")).alias("found"))
    last = (F.size("pts") - 1).cast("double")
    mark = lambda pos, p: F.struct(pos.alias("pos"), p["x"].alias("x"), p["y"].alias("y"))
    first, final = F.element_at("pts", 1), F.element_at("pts", -1)
    inner = F.filter(F.coalesce("found", F.array().cast(kind)), lambda c: (c["pos"] > 0) & (c["pos"] < last))
    ring = first.eqNullSafe(final)
    middle = F.floor(last / 2)
    half = F.array(mark(middle.cast("double"), F.get("pts", middle.cast("int")))).cast(kind)
    inner = F.when(ring & (F.size(inner) == 0) & (F.size("pts") > 3), half).otherwise(inner)
    marks = F.sort_array(F.array_distinct(F.concat(F.array(mark(F.lit(0.0), first)).cast(kind), inner, F.array(mark(last, final)).cast(kind))))
    runs = F.posexplode(F.expr("transform(sequence(0, size(marks) - 2), i -> struct(marks[i] as c0, marks[i + 1] as c1))"))
    out = roads.join(found, "source_id", "left").withColumn("marks", marks)
    out = out.select("*", runs.alias("part", "m"))
    point = lambda c: F.struct(F.col(f"{c}.x").alias("x"), F.col(f"{c}.y").alias("y"))
    between = F.expr("filter(pts, (p, i) -> i > m.c0.pos and i < m.c1.pos)")
    # Several roads may meet in one place at positions that differ by rounding: nothing lies between those.
    parts = out.select(
        F.concat_ws(":", "source_id", F.col("part").cast("string")).alias("segment_id"), "source_id", "grade_key", "road_class", "oneway",
        F.concat(F.array(point("m.c0")), between, F.array(point("m.c1"))).alias("pts"),
    ).filter(F.size(F.array_distinct("pts")) > 1)
    # A part that turns back on itself on the grid ends where it turns, so its two ways become one.
    turns = F.expr("filter(sequence(1, size(pts) - 1), i -> i < size(pts) - 1 and pts[i - 1] = pts[i + 1])")
    bounds = parts.withColumn("turns", F.concat(F.array(F.lit(0)), turns, F.array(F.size("pts") - 1)))
    legs = bounds.select("*", F.posexplode(F.expr("transform(sequence(0, size(turns) - 2), i -> slice(pts, turns[i] + 1, turns[i + 1] - turns[i] + 1))")).alias("leg", "leg_pts"))
    whole = F.when(F.size("turns") == 2, F.col("segment_id")).otherwise(F.concat_ws(".", "segment_id", F.col("leg").cast("string")))
    return merge_overlaps(legs.select(whole.alias("segment_id"), "source_id", "grade_key", "road_class", "oneway", F.col("leg_pts").alias("pts")))


def node_key(x: Column, y: Column, decimals: int = 6) -> Column:
    """A node's id is its rounded place: equal on every run and on every partitioning."""
    scale = F.lit(float(10**decimals))
    return F.concat_ws("_", F.round(x * scale).cast("long").cast("string"), F.round(y * scale).cast("long").cast("string"))


def length_m(pts: str = "pts") -> Column:
    return F.expr(f"aggregate(sequence(0, size({pts}) - 2), 0d, (s, i) -> s + sqrt(pow({pts}[i + 1].x - {pts}[i].x, 2) + pow({pts}[i + 1].y - {pts}[i].y, 2)))")


def build_graph(segments: DataFrame, decimals: int = 6) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of noded segments; the original class stays beside the final one."""
    forward, reverse = directions(F.col("oneway"))
    first, last = F.element_at("pts", 1), F.element_at("pts", -1)
    edges = segments.select(
        F.col("segment_id").alias("edge_id"), "source_id", "grade_key",
        node_key(first["x"], first["y"], decimals).alias("from_node"), node_key(last["x"], last["y"], decimals).alias("to_node"),
        length_m().alias("length_m"), F.col("road_class").alias("original_road_class"), final_class(F.col("road_class")).alias("final_road_class"),
        forward.alias("forward_allowed"), reverse.alias("reverse_allowed"), "pts",
    ).filter("length_m > 0")
    ends = edges.select(F.explode(F.array(F.struct(F.col("from_node").alias("node_id"), F.element_at("pts", 1).alias("p")), F.struct(F.col("to_node").alias("node_id"), F.element_at("pts", -1).alias("p")))).alias("e"))
    nodes = ends.groupBy("e.node_id").agg(F.min("e.p").alias("p")).select("node_id", "p.x", "p.y")
    return nodes, edges


def directed_arcs(edges: DataFrame) -> DataFrame:
    """Forward arcs and reverse arcs of the edges that allow them."""
    ahead = edges.filter("forward_allowed").select(F.concat("edge_id", F.lit("+")).alias("arc_id"), "edge_id", "from_node", "to_node", F.col("length_m").alias("distance_m"), "final_road_class")
    back = edges.filter("reverse_allowed").select(F.concat("edge_id", F.lit("-")).alias("arc_id"), "edge_id", F.col("to_node").alias("from_node"), F.col("from_node").alias("to_node"), F.col("length_m").alias("distance_m"), "final_road_class")
    return ahead.unionByName(back)


def nearest_edges(services: DataFrame, edges: DataFrame, reach_m: float) -> DataFrame:
    """Each service with its nearest edge within ``reach_m``: (terminal_id, edge_id, cut, distance_m, x, y).

    Services look into the cells around them, of the size of the reach; ties go to
    the smaller edge id and then to the earlier place.
    """
    s = _segments(edges.select(F.col("edge_id").alias("source_id"), F.lit("").alias("grade_key"), "pts"))
    s = s.select(F.col("source_id").alias("edge_id"), "seq", "a", "b", F.explode(_cells(reach_m)).alias("cell"))
    px, py = F.col("access_reference_x_m"), F.col("access_reference_y_m")
    near = F.transform(
        F.sequence(F.lit(-1), F.lit(1)),
        lambda i: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.struct((F.floor(px / reach_m) + i).alias("i"), (F.floor(py / reach_m) + j).alias("j"))),
    )
    look = services.select("terminal_id", px, py, F.explode(F.flatten(near)).alias("cell"))
    pairs = look.join(s, "cell")
    ends = (F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y"))
    t, d = segment_fraction(px, py, *ends), segment_distance(px, py, *ends)
    tried = pairs.withColumn("t", t).withColumn("d", d).filter(F.col("d") <= reach_m)
    place = F.struct("d", "edge_id", (F.col("seq") + F.col("t")).alias("cut"), (F.col("a.x") + F.col("t") * (F.col("b.x") - F.col("a.x"))).alias("x"), (F.col("a.y") + F.col("t") * (F.col("b.y") - F.col("a.y"))).alias("y"))
    best = tried.groupBy("terminal_id").agg(F.min(place).alias("p"))
    return best.select("terminal_id", "p.edge_id", "p.cut", F.col("p.d").alias("distance_m"), "p.x", "p.y")


def insert_services(edges: DataFrame, services: DataFrame, reach_m: float = 200.0, decimals: int = 6, junction_priority: bool = False) -> tuple[DataFrame, DataFrame]:
    """(edges split at the anchors, snaps).

    An anchor is the nearest place on a road, never off it; with
    ``junction_priority`` an end of that edge within reach is taken instead.  A
    service without a road within ``reach_m`` (inclusive) has no anchor.
    """
    near = nearest_edges(services, edges, reach_m).join(edges.select("edge_id", "from_node", "to_node", "pts"), "edge_id")
    near = near.join(services, "terminal_id")
    last = F.size("pts") - 1
    if junction_priority:
        px, py = F.col("access_reference_x_m"), F.col("access_reference_y_m")
        first_d = F.hypot(px - F.element_at("pts", 1)["x"], py - F.element_at("pts", 1)["y"])
        last_d = F.hypot(px - F.element_at("pts", -1)["x"], py - F.element_at("pts", -1)["y"])
        near = near.withColumn("cut", F.when((F.least(first_d, last_d) <= reach_m) & (first_d <= last_d), 0.0).when(F.least(first_d, last_d) <= reach_m, last.cast("double")).otherwise(F.col("cut")))
    anchor = F.when(F.col("cut") <= 0, F.col("from_node")).when(F.col("cut") >= last, F.col("to_node")).otherwise(node_key(F.col("x"), F.col("y"), decimals))
    near = near.withColumn("truck_anchor_id", anchor)
    snaps = services.select("terminal_id").join(near.select("terminal_id", "truck_anchor_id", "distance_m"), "terminal_id", "left")
    snaps = snaps.select("terminal_id", "truck_anchor_id", "distance_m", F.col("truck_anchor_id").isNotNull().alias("distance_covered"))
    inner = near.filter((F.col("cut") > 0) & (F.col("cut") < last)).groupBy("edge_id").agg(F.collect_set(F.struct("cut", "truck_anchor_id", F.struct("x", "y").alias("p"))).alias("found"))
    full = edges.join(inner, "edge_id", "left")
    ends = F.array(F.struct(F.lit(0.0).alias("cut"), F.col("from_node").alias("truck_anchor_id"), F.element_at("pts", 1).alias("p")))
    stop = F.array(F.struct(last.cast("double").alias("cut"), F.col("to_node").alias("truck_anchor_id"), F.element_at("pts", -1).alias("p")))
    kind = "array<struct<cut:double,truck_anchor_id:string,p:struct<x:double,y:double>>>"
    marks = F.sort_array(F.concat(ends.cast(kind), F.coalesce(F.col("found").cast(kind), F.array().cast(kind)), stop.cast(kind)))
    full = full.withColumn("marks", marks).withColumn("n_parts", F.size("marks") - 1)
    runs = F.posexplode(F.expr("transform(sequence(0, size(marks) - 2), i -> struct(marks[i] as c0, marks[i + 1] as c1))"))
    parts = full.select("*", runs.alias("part", "m"))
    pts = F.concat(F.array(F.col("m.c0.p")), F.expr("filter(pts, (p, i) -> i > m.c0.cut and i < m.c1.cut)"), F.array(F.col("m.c1.p")))
    keep = [c for c in edges.columns if c not in ("edge_id", "from_node", "to_node", "length_m", "pts")]
    out = parts.select(
        F.when(F.col("n_parts") == 1, F.col("edge_id")).otherwise(F.concat_ws("/", "edge_id", F.col("part").cast("string"))).alias("edge_id"),
        F.col("m.c0.truck_anchor_id").alias("from_node"), F.col("m.c1.truck_anchor_id").alias("to_node"), *keep, pts.alias("pts"),
    )
    return out.withColumn("length_m", length_m()).filter("from_node <> to_node or length_m > 0"), snaps


def fill_secondary_gaps(edges: DataFrame, limit_m: float = 750.0) -> DataFrame:
    """Residential edges up to the limit whose two ends both meet a secondary edge become secondary."""
    ends = edges.filter("final_road_class = 'secondary'").select(F.explode(F.array("from_node", "to_node")).alias("n")).distinct()
    out = edges.join(ends.select(F.col("n").alias("__a")), F.col("from_node") == F.col("__a"), "left").join(ends.select(F.col("n").alias("__b")), F.col("to_node") == F.col("__b"), "left")
    fills = (F.col("final_road_class") == "residential") & (F.col("length_m") <= limit_m) & F.col("__a").isNotNull() & F.col("__b").isNotNull()
    return out.withColumn("final_road_class", F.when(fills, "secondary").otherwise(F.col("final_road_class"))).drop("__a", "__b")
