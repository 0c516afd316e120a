"""Service catchments: who can be served from where, and the fewest sites that serve all."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import GateError
from ..workspace import materialize
from .components import components

MINUTES, METRES = 45.0, 10_000.0


def within_limits(paths: DataFrame, minutes: float = MINUTES, metres: float = METRES) -> DataFrame:
    """Paths that keep both limits at once, ends included."""
    return paths.filter((F.col("time_min") <= minutes) & (F.col("distance_m") <= metres))


def serviceable_pairs(paths: DataFrame, demands: DataFrame, minutes: float = MINUTES, metres: float = METRES) -> DataFrame:
    """(site, demand, time_min, distance_m, population): a site serves itself without travel."""
    near = within_limits(paths, minutes, metres).select("site", "demand", "time_min", "distance_m")
    own = demands.select(F.col("demand").alias("site"), "demand", F.lit(0.0).alias("time_min"), F.lit(0.0).alias("distance_m"))
    return near.filter("site <> demand").unionByName(own).join(demands, "demand")


COVER = "demand string, site string, time_min double, population double"


def min_site_cover(pairs: DataFrame, demands: DataFrame) -> DataFrame:
    """The exact cover: fewest sites, then least population-weighted time, then smallest ids.

    Each demand goes to its quickest chosen site.  Sites and demands that no chain of
    pairs joins can't influence one another, so each such part is searched by itself,
    by branch and bound, on the executors; numbers, times and ids of the parts add up
    to those of the whole.  There is no limit on sites, and never an approximation;
    a part is one task's work, and its search can take long if it is large.
    """
    pairs = materialize(pairs.select("site", "demand", F.col("time_min").cast("double").alias("time_min"), F.col("population").cast("double").alias("population")), "cover-pairs")
    if not demands.join(pairs, "demand", "left_anti").isEmpty():
        raise GateError("a demand has no site within its limits")
    wanted = pairs.join(demands.select("demand"), "demand", "left_semi")
    part = components(wanted.select(F.xxhash64("site").alias("a"), F.xxhash64("demand").alias("b")), "cover-parts", SMALL_PARTS)
    own = F.xxhash64("demand")
    dealt = wanted.withColumn("n", own).join(part, F.col("n") == F.col("node"), "left").withColumn("part", F.coalesce("root", "n")).drop("n", "node", "root")
    return dealt.groupBy("part").applyInArrow(_cover_part, COVER)


#: Pairs whose parts are found in one task.
SMALL_PARTS = 200_000


def _cover_part(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cost: dict[str, dict[str, tuple[float, float]]] = {}
    for b in tables:
        for d, s, t, n in zip(*(b.column(c).to_pylist() for c in ("demand", "site", "time_min", "population"))):
            cost.setdefault(d, {})[s] = (t, n)
    wanted = sorted(cost)
    k, pick = 0, None
    while pick is None:
        k += 1
        pick = _best_cover(k, wanted, cost)
    cols = [wanted, [s for _, s in pick], [t for t, _ in pick], [cost[d][s][1] for d, (_, s) in zip(wanted, pick)]]
    kinds = [pa.string(), pa.string(), pa.float64(), pa.float64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["demand", "site", "time_min", "population"])


def _best_cover(k: int, wanted: list[str], cost: dict[str, dict[str, tuple[float, float]]]) -> list[tuple[float, str]] | None:
    """(time, site) of each demand in the best set of ``k`` sites, if no fewer serve all.

    Branches on the demand with fewest sites left, each branch without the sites of
    those before it, so no set comes twice.  A branch ends when the sites still to
    choose can't reach what is open, or when even the quickest sites left cost more
    than the best set.
    """
    reach: dict[str, int] = {}
    for i, d in enumerate(wanted):
        for s in cost[d]:
            reach[s] = reach.get(s, 0) | 1 << i
    quickest = [sorted((t, s) for s, (t, _) in cost[d].items()) for d in wanted]
    best: list = []

    def total(pick: list[tuple[float, str]]) -> float:
        return sum(t * cost[d][s][1] for d, (t, s) in zip(wanted, pick))

    def search(chosen: frozenset[str], barred: frozenset[str], open_: int) -> None:
        if not open_:
            pick = [next(p for p in row if p[1] in chosen) for row in quickest]
            found = (total(pick), sorted(chosen), pick)
            if not best or found[:2] < best[0][:2]:
                best[:] = [found]
            return
        left = k - len(chosen)
        sizes = sorted(((r & open_).bit_count() for s, r in reach.items() if s not in barred), reverse=True)
        if sum(sizes[:left]) < open_.bit_count():
            return
        if best:
            least = [next((p for p in row if p[1] not in barred), None) for row in quickest]
            if None in least or total(least) > best[0][0] + 1e-9 * abs(best[0][0]):
                return
        free = [[s for s in cost[d] if s not in barred] for i, d in enumerate(wanted) if open_ >> i & 1]
        for s in sorted(min(free, key=len), key=lambda s: (-(reach[s] & open_).bit_count(), s)):
            search(chosen | {s}, barred, open_ & ~reach[s])
            barred |= {s}

    search(frozenset(), frozenset(), (1 << len(wanted)) - 1)
    return best[0][2] if best else None


def assign_nearest(pairs: DataFrame) -> DataFrame:
    """Each demand with its quickest site, ties to the shorter and then the smaller id."""
    return pairs.groupBy("demand").agg(F.min(F.struct("time_min", "distance_m", "site")).alias("p"), F.max("population").alias("population")).select("demand", "p.site", "p.time_min", "p.distance_m", "population")


def catchments(assigned: DataFrame) -> DataFrame:
    """Local and served population of each site and its population-weighted time."""
    return assigned.groupBy("site").agg(
        F.count(F.lit(1)).alias("n_demands"),
        F.sum("population").alias("catchment_population"),
        F.sum(F.when(F.col("demand") == F.col("site"), F.col("population")).otherwise(0.0)).alias("local_population"),
        F.sum(F.col("population") * F.col("time_min")).alias("weighted_time"),
    )
