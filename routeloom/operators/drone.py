"""Drone legs: road anchor to customer and back, and customer to customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import GateError
from ..functions import flight_cost
from ..workspace import materialize
from . import terrain

PAYLOADS = ("full", "empty")


def raw_legs(customers: DataFrame) -> DataFrame:
    """2 N^2 legs of each network: full from every anchor to every customer, empty back.

    ``customers``: (network_id, terminal_id, x, y, anchor_x, anchor_y).  The number of
    legs is the result itself; customers meet by network, not across networks.
    """
    a = customers.select("network_id", F.col("terminal_id").alias("anchor_terminal"), "anchor_x", "anchor_y")
    c = customers.select("network_id", F.col("terminal_id").alias("customer"), "x", "y")
    legs = a.join(c, "network_id").withColumn("payload", F.explode(F.array(*map(F.lit, PAYLOADS))))
    full = F.col("payload") == "full"
    return legs.select(
        "network_id", "payload", "anchor_terminal", "customer",
        F.when(full, F.concat(F.lit("anchor:"), "anchor_terminal")).otherwise(F.concat(F.lit("customer:"), "customer")).alias("origin"),
        F.when(full, F.concat(F.lit("customer:"), "customer")).otherwise(F.concat(F.lit("anchor:"), "anchor_terminal")).alias("destination"),
        F.hypot(F.col("x") - F.col("anchor_x"), F.col("y") - F.col("anchor_y")).alias("distance_m"),
    )


def centroid_legs(customers: DataFrame) -> DataFrame:
    """2 N (N - 1) candidate legs between customers of a network, both ways and both payloads."""
    a = customers.select("network_id", F.col("terminal_id").alias("origin"), F.col("x").alias("x0"), F.col("y").alias("y0"))
    b = customers.select("network_id", F.col("terminal_id").alias("destination"), "x", "y")
    pairs = a.join(b, "network_id").filter("origin <> destination")
    return pairs.withColumn("payload", F.explode(F.array(*map(F.lit, PAYLOADS)))).select("network_id", "payload", "origin", "destination", F.hypot(F.col("x") - F.col("x0"), F.col("y") - F.col("y0")).alias("distance_m"))


def corridors(legs: DataFrame) -> DataFrame:
    """One corridor for both directions and payloads of a pair: its ground is sampled once."""
    return legs.select("network_id", F.least("origin", "destination").alias("end_a"), F.greatest("origin", "destination").alias("end_b"), "distance_m").groupBy("network_id", "end_a", "end_b").agg(F.min("distance_m").alias("distance_m"))


def ends(customers: DataFrame) -> DataFrame:
    """(network_id, name, x, y) of every place that a leg starts or ends at, by its name there."""
    place = lambda name, x, y: F.struct(name.alias("name"), F.col(x).alias("x"), F.col(y).alias("y"))
    named = [place(F.concat(F.lit("anchor:"), "terminal_id"), "anchor_x", "anchor_y"), place(F.concat(F.lit("customer:"), "terminal_id"), "x", "y"), place(F.col("terminal_id"), "x", "y")]
    return customers.select("network_id", F.explode(F.array(*named)).alias("e")).select("network_id", "e.name", "e.x", "e.y")


def lines(pairs: DataFrame, customers: DataFrame, step_m: float) -> DataFrame:
    """(network_id, end_a, end_b, xa, ya, xb, yb, n): corridors with the places of their ends and their number of steps."""
    at = ends(customers)
    a = at.select("network_id", F.col("name").alias("end_a"), F.col("x").alias("xa"), F.col("y").alias("ya"))
    b = at.select("network_id", F.col("name").alias("end_b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    line = pairs.select("network_id", "end_a", "end_b").join(a, ["network_id", "end_a"]).join(b, ["network_id", "end_b"])
    return line.withColumn("n", F.greatest(F.ceil(F.hypot(F.col("xb") - F.col("xa"), F.col("yb") - F.col("ya")) / step_m), F.lit(1)))


def corridor_points(pairs: DataFrame, customers: DataFrame, step_m: float) -> DataFrame:
    """(network_id, end_a, end_b, k, n, x, y): places along each corridor, ends included, a step apart at most."""
    each = lines(pairs, customers, step_m).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n"))))
    t = F.col("k") / F.col("n")
    return each.select("network_id", "end_a", "end_b", "k", "n", (F.col("xa") + t * (F.col("xb") - F.col("xa"))).alias("x"), (F.col("ya") + t * (F.col("yb") - F.col("ya"))).alias("y"))


def ground_along(pairs: DataFrame, customers: DataFrame, step_m: float, dem: DataFrame, grid: dict) -> DataFrame:
    """``corridor_ground`` of the places of ``corridor_points``, none of which is shuffled or written.

    The elevation model is dealt into square tiles.  While these are few, each place
    meets its tile where it arises.  Beyond, a corridor is cut into the runs of its places
    on one tile (they follow one another, as it is straight), and runs are dealt by tile.
    """
    x0, y0, cell = grid["x0"], grid["y0"], grid["cell_m"]
    tiles = materialize(terrain.dem_tiles(dem), "dem-tiles")
    t = F.col("k") / F.col("n")
    x, y = F.col("xa") + t * (F.col("xb") - F.col("xa")), F.col("ya") + t * (F.col("yb") - F.col("ya"))
    # Row and column of a place among the cells' centres, with fractions.
    at = {"r": (F.lit(y0) - y) / cell - 0.5, "c": (x - x0) / cell - 0.5}
    line = lines(pairs, customers, step_m)
    each = line.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n")))).withColumns(at)
    each = each.withColumns({"tr": F.floor(F.floor("r") / terrain.TILE), "tc": F.floor(F.floor("c") / terrain.TILE)})
    if tiles.limit(terrain.FEW_TILES + 1).count() <= terrain.FEW_TILES:
        met = each.join(F.broadcast(tiles), ["tr", "tc"], "left")
    else:
        runs = each.groupBy(*line.columns, "tr", "tc").agg(F.min("k").alias("k0"), F.max("k").alias("k1"))
        met = runs.join(tiles, ["tr", "tc"], "left").withColumn("k", F.explode(F.sequence("k0", "k1"))).withColumns(at)
    status, z = terrain.tile_sample("cells", F.col("r"), F.col("c"), F.col("tr"), F.col("tc"))
    met = met.select("network_id", "end_a", "end_b", "n", "k", status.alias("status"), z.alias("z"))
    by = met.groupBy("network_id", "end_a", "end_b").agg(
        F.max(F.when(F.col("k") == 0, F.col("z"))).alias("z_a"), F.max(F.when(F.col("k") == F.col("n"), F.col("z"))).alias("z_b"), F.max("z").alias("z_max"),
        *[F.count_if(F.col("status") == s).alias(s) for s in terrain.BAD],
    )
    by = materialize(by, "corridors")
    counts = by.agg(*[F.sum(s).alias(s) for s in terrain.BAD]).first()
    for s in terrain.BAD:
        if counts[s]:
            raise GateError(f"{counts[s]} points: {s}")
    return by.drop(*terrain.BAD)


def corridor_ground(points: DataFrame, dem: DataFrame, grid: dict) -> DataFrame:
    """(network_id, end_a, end_b, z_a, z_b, z_max): ground at both ends and the highest of a corridor.

    A place outside the elevation model or on nodata is an error.
    """
    sampled = terrain.require_samples(terrain.sample_dem(points, dem, grid["x0"], grid["y0"], grid["cell_m"]))
    by = sampled.groupBy("network_id", "end_a", "end_b")
    return by.agg(F.max(F.when(F.col("k") == 0, F.col("z"))).alias("z_a"), F.max(F.when(F.col("k") == F.col("n"), F.col("z"))).alias("z_b"), F.max("z").alias("z_max"))


def with_corridors(legs: DataFrame, ground: DataFrame) -> DataFrame:
    """Legs with z_from, z_to and z_max of their corridor (network_id, end_a, end_b, z_a, z_b, z_max)."""
    keyed = legs.withColumn("end_a", F.least("origin", "destination")).withColumn("end_b", F.greatest("origin", "destination"))
    out = keyed.join(ground, ["network_id", "end_a", "end_b"])
    ahead = F.col("origin") == F.col("end_a")
    z = {"z_from": F.when(ahead, F.col("z_a")).otherwise(F.col("z_b")), "z_to": F.when(ahead, F.col("z_b")).otherwise(F.col("z_a"))}
    return out.withColumns(z).drop("end_a", "end_b", "z_a", "z_b")


def cost_legs(legs: DataFrame, cfg: dict) -> DataFrame:
    """Legs (distance_m, z_from, z_to, z_max, payload) with times, energies and the reserve test of each alone."""
    c = F.col
    return legs.withColumns(flight_cost(c("distance_m"), c("z_from"), c("z_to"), c("z_max"), c("payload"), cfg))


def round_trips(costed: DataFrame, cfg: dict) -> DataFrame:
    """Full out and empty back against the battery less its reserve."""
    usable = cfg["nominal_battery_kwh"] * (1 - cfg["reserve_share"])
    by = costed.groupBy("network_id", "anchor_terminal", "customer").agg(F.sum("energy_kwh").alias("round_trip_kwh"))
    return by.withColumn("round_trip_feasible", F.col("round_trip_kwh") <= F.lit(usable))
