"""Elevation: sampling, profiles, ascents, slopes and rank positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import GateError
from ..workspace import materialize


def sample_dem(points: DataFrame, dem: DataFrame, x0: float, y0: float, cell_m: float) -> DataFrame:
    """``points`` (id, x, y) with z and status: ok, interpolation margin or nodata.

    Bilinear over the four cell centres around a point; (x0, y0) is the upper left
    corner of cell (0, 0) and rows go down.  Each point meets its cells in one
    equi-join.  Zero is an elevation like any other; null is nodata.
    """
    c, r = (F.col("x") - x0) / cell_m - 0.5, (F.lit(y0) - F.col("y")) / cell_m - 0.5
    at = points.withColumn("__c", F.floor(c)).withColumn("__r", F.floor(r)).withColumn("__u", c - F.floor(c)).withColumn("__v", r - F.floor(r))
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    near = at.withColumn("__k", corner).withColumn("__row", F.col("__r") + F.col("__k.i")).withColumn("__col", F.col("__c") + F.col("__k.j"))
    weight = F.when(F.col("__k.i") == 1, F.col("__v")).otherwise(1 - F.col("__v")) * F.when(F.col("__k.j") == 1, F.col("__u")).otherwise(1 - F.col("__u"))
    grid = dem.select(F.col("row").cast("long").alias("__row"), F.col("col").cast("long").alias("__col"), "z", F.lit(1).alias("__there"))
    names = [F.col(x) for x in points.columns]
    met = near.select(*names, "__row", "__col", weight.alias("__w")).join(grid.withColumnRenamed("z", "__z"), ["__row", "__col"], "left")
    out = met.groupBy(*[F.col(x) for x in points.columns]).agg(F.count("__there").alias("__n"), F.count("__z").alias("__known"), F.sum(F.col("__w") * F.col("__z")).alias("z"))
    status = F.when(F.col("__n") < 4, "interpolation margin").when(F.col("__known") < 4, "nodata").otherwise("ok")
    return out.withColumn("status", status).withColumn("z", F.when(F.col("status") == "ok", F.col("z"))).drop("__n", "__known")


def require_samples(sampled: DataFrame) -> DataFrame:
    """The samples, unless one of them lies outside or on nodata."""
    bad = sampled.filter("status <> 'ok'").groupBy("status").count().orderBy("status").first()
    if bad is not None:
        raise GateError(f"{bad['count']} points: {bad['status']}")
    return sampled


#: Cells along a tile's side; a tile holds one more row and column, so that places between tiles have all four cells.
TILE = 64
#: Tiles that are broadcast, at most (about 100 KB each).
FEW_TILES = 64
#: What keeps a place from a sample.
BAD = ("interpolation margin", "nodata")


def dem_tiles(dem: DataFrame) -> DataFrame:
    """(tr, tc, cells): squares of the elevation model, cells row by row; null where there is none, z null for nodata."""
    r, c = F.col("row").cast("long"), F.col("col").cast("long")
    near = lambda v: F.when(v % TILE == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    each = dem.select(r.alias("r"), c.alias("c"), F.col("z").cast("double").alias("z")).withColumn("i", F.explode(near(F.col("r")))).withColumn("j", F.explode(near(F.col("c"))))
    each = each.withColumns({"tr": F.floor(F.col("r") / TILE) - F.col("i"), "tc": F.floor(F.col("c") / TILE) - F.col("j")})
    each = each.withColumn("k", (F.col("r") - F.col("tr") * TILE) * (TILE + 1) + F.col("c") - F.col("tc") * TILE)
    slots = each.select("tr", "tc").distinct().withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((TILE + 1) ** 2 - 1).cast("long"))))
    filled = slots.join(each.select("tr", "tc", "k", F.struct("z").alias("cell")), ["tr", "tc", "k"], "left")
    cells = F.sort_array(F.collect_list(F.struct("k", "cell")))
    return filled.groupBy("tr", "tc").agg(F.transform(cells, lambda e: e["cell"]).alias("cells"))


def tile_sample(cells: str, r: Column, c: Column, tr: Column, tc: Column) -> tuple[Column, Column]:
    """(status, z) as ``sample_dem`` has them, at a row and column of the grid, with fractions, that lie on tile tr, tc."""
    i, j = (F.floor(r) - tr * TILE).cast("int"), (F.floor(c) - tc * TILE).cast("int")
    four = [F.get(cells, (i + a) * (TILE + 1) + j + b) for a in (0, 1) for b in (0, 1)]
    u, v = c - F.floor(c), r - F.floor(r)
    z = sum(y * x * e["z"] for (y, x), e in zip([(1 - v, 1 - u), (1 - v, u), (v, 1 - u), (v, u)], four))
    missing, unknown = (reduce(lambda p, q: p | q, [t.isNull() for t in x]) for x in (four, [e["z"] for e in four]))
    return F.when(missing, BAD[0]).when(unknown, BAD[1]).otherwise("ok"), z


def smooth(z: Column) -> Column:
    """Mean of each value and its neighbours; the ends have one neighbour."""
    return F.transform(z, lambda v, i: (F.coalesce(F.get(z, i - 1), F.lit(0.0)) + v + F.coalesce(F.get(z, i + 1), F.lit(0.0))) / (1 + F.when(i > 0, 1).otherwise(0) + F.when(i < F.size(z) - 1, 1).otherwise(0)))


def steps(values: Column) -> Column:
    return F.transform(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), lambda v, i: v - F.get(values, i))


def ascent(z: Column) -> Column:
    return F.aggregate(steps(z), F.lit(0.0), lambda s, d: s + F.greatest(d, F.lit(0.0)))


def descent(z: Column) -> Column:
    return F.aggregate(steps(z), F.lit(0.0), lambda s, d: s + F.greatest(-d, F.lit(0.0)))


def strictly_increasing(d: Column) -> Column:
    return ~F.exists(steps(d), lambda s: s.isNull() | F.isnan(s) | (s <= 0))


def slope_metrics(profiles: DataFrame) -> DataFrame:
    """``profiles`` with smax_percent and smean_percent; distances that don't rise raise an error."""
    d, z = F.col("sample_distances_m"), F.col("smoothed_elevations_m")
    slopes = F.zip_with(steps(z), steps(d), lambda dz, dx: F.abs(dz) / dx * 100)
    climb = F.aggregate(steps(z), F.lit(0.0), lambda s, v: s + F.abs(v))
    run = F.element_at(d, -1) - F.element_at(d, 1)
    ok = strictly_increasing(d) & (F.size(d) == F.size(z)) & (F.size(d) > 1)
    stop = F.raise_error(F.concat(F.lit("GateError: profile distances must rise: "), F.to_json(F.struct("sample_distances_m")))).cast("double")
    return profiles.withColumn("smax_percent", F.when(ok, F.array_max(slopes)).otherwise(stop)).withColumn("smean_percent", F.when(ok, climb / run * 100).otherwise(stop))


def slope_features(lineage: DataFrame, profiles: DataFrame) -> DataFrame:
    """Largest and length-weighted mean slope of each logical arc, within its edges only.

    ``lineage``: (contracted_logical_arc_id, contracted_logical_connection_id,
    canonical_physical_edge_ids).  Steps between one edge's end and the next one's
    start don't count.
    """
    d, z = F.col("sample_distances_m"), F.col("smoothed_elevations_m")
    parts = slope_metrics(profiles).select("edge_id", "smax_percent", (F.element_at(d, -1) - F.element_at(d, 1)).alias("run"), F.aggregate(steps(z), F.lit(0.0), lambda s, v: s + F.abs(v)).alias("climb"))
    ids = ["contracted_logical_arc_id", "contracted_logical_connection_id"]
    each = lineage.select(*ids, F.explode("canonical_physical_edge_ids").alias("edge_id")).join(parts, "edge_id")
    return each.groupBy(*ids).agg(F.max("smax_percent").alias("smax_percent"), (F.sum("climb") / F.sum("run") * 100).alias("smean_percent"))


def reverse_profile(profiles: DataFrame) -> DataFrame:
    """The same profiles the other way: samples reversed, distances from the other end."""
    d = F.col("sample_distances_m")
    return profiles.withColumn("smoothed_elevations_m", F.reverse("smoothed_elevations_m")).withColumn("sample_distances_m", F.transform(F.reverse(d), lambda v: F.element_at(d, -1) - v))


def profile_costs(profiles: DataFrame) -> DataFrame:
    """Ascent and descent of each edge forwards; backwards they change places."""
    z = F.col("smoothed_elevations_m")
    return profiles.select("edge_id", ascent(z).alias("cumulative_ascent_m"), descent(z).alias("cumulative_descent_m"))


#: Ranges that distinct reference values are dealt to, so that no task ranks them all.
RANK_RANGES = 256


def _frozen(counts: DataFrame) -> DataFrame:
    """(range, value, n, below) of distinct values (value, n)."""
    edges = counts.agg(F.percentile_approx("value", [i / RANK_RANGES for i in range(1, RANK_RANGES)], 10_000)).first()[0]
    bounds = sorted(set(edges or []))
    cut = F.lit(bounds) if bounds else F.array().cast("array<double>")
    each = counts.withColumn("range", F.size(F.filter(cut, lambda b: b < F.col("value"))))
    before = lambda by: F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = each.groupBy("range").agg(F.sum("n").alias("n")).select("range", before(Window.orderBy("range")).alias("base"))
    return each.join(F.broadcast(base), "range").select("range", "value", "n", (F.col("base") + before(Window.partitionBy("range").orderBy("value"))).alias("below"))


def freeze(reference: DataFrame, column: str = "value") -> DataFrame:
    """The reference as a table that can be kept: (range, value, n, below), a row for each distinct value.

    ``below`` is the number of smaller values in the whole reference.  Values are cut
    into ranges by approximate quantiles and summed within each; only the sums of ranges
    (``RANK_RANGES`` rows at most) are broadcast.
    """
    return _frozen(reference.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")))


def extend_frozen(frozen: DataFrame, more: DataFrame, column: str = "value") -> DataFrame:
    """The table of the reference with more values: equal to one frozen from all of them."""
    new = more.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _frozen(frozen.select("value", "n").unionByName(new).groupBy("value").agg(F.sum("n").alias("n")))


def midrank_frozen(values: DataFrame, frozen: DataFrame, column: str = "value") -> DataFrame:
    """``values`` with midrank: (smaller + half of equal) / n against a frozen reference.

    Values need not occur in the reference; each meets the range it falls into.  An
    empty reference gives null.
    """
    ranges = frozen.groupBy("range").agg(F.min("value").alias("low"), F.min("below").alias("base"), F.sum("n").alias("n")).orderBy("range").collect()
    total, lows = sum(r.n for r in ranges), [float(r.low) for r in ranges]
    own = values.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("__v")).distinct()
    low = F.lit(lows) if lows else F.array().cast("array<double>")
    own = own.withColumn("__r", F.size(F.filter(low, lambda b: b <= F.col("__v"))) - 1)
    index = {r.range: i for i, r in enumerate(ranges)}
    number = F.create_map(*[F.lit(x) for pair in index.items() for x in pair]) if index else None
    known = frozen.select(F.col("value").alias("__v"), (number[F.col("range")] if number is not None else F.col("range")).cast("int").alias("__r"), "n", "below")
    none = F.lit(None).cast("long")
    each = known.unionByName(own.select("__v", F.col("__r").cast("int").alias("__r"), none.alias("n"), none.alias("below"))).groupBy("__r", "__v").agg(F.max("n").alias("n"), F.max("below").alias("below"))
    before = F.last(F.col("below") + F.col("n"), ignorenulls=True).over(Window.partitionBy("__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1))
    ranked = each.select("__v", (F.coalesce("below", before, F.lit(0)) + F.coalesce("n", F.lit(0)) / 2).alias("__place"))
    ranked = ranked.select("__v", (F.col("__place") / F.lit(float(total)) if total else F.lit(None).cast("double")).alias("midrank"))
    return values.join(ranked, values[column].cast("double") == F.col("__v"), "left").drop("__v")


def midrank(values: DataFrame, reference: DataFrame, column: str = "value") -> DataFrame:
    """``midrank_frozen`` against a reference that is frozen for the purpose."""
    return midrank_frozen(values, materialize(freeze(reference, column), "frozen-reference"), column)
