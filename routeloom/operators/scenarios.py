"""Generated road disruptions: common draws for a connection, severities, corrected cost multipliers.

The states and multipliers are this project's own and are experiments, not forecasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import uniform

#: Severity -> (share of connections hit at mean rank, time factor, energy factor).
STATES = {"mild": (0.10, 1.2, 1.1), "moderate": (0.25, 1.6, 1.25), "severe": (0.45, 2.5, 1.6)}
DRAWS = 2


def state_parameters(severity: str) -> dict:
    share, time, energy = STATES[severity]
    return {"hit_share": share, "time_factor": time, "energy_factor": energy}


def scenario_registry(networks: DataFrame, enabled: bool = True, seed: int = 1) -> DataFrame:
    """A row for each network, severity and draw; none if scenarios are off."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("severity"), F.lit(d).alias("draw"), F.lit(s).alias("hit_share"), F.lit(t).alias("time_factor"), F.lit(e).alias("energy_factor")) for k, (s, t, e) in STATES.items() for d in range(1, DRAWS + 1)]))
    out = networks.select("network_id", kinds.alias("k")).select("network_id", "k.*")
    out = out.withColumn("scenario_id", F.concat_ws("-", "network_id", "severity", F.col("draw").cast("string"))).withColumn("seed", F.lit(seed))
    return out if enabled else out.limit(0)


def disrupted_arcs(logical: DataFrame, registry: DataFrame, seed: int = 1) -> DataFrame:
    """Logical arcs in each scenario of their network.

    ``logical``: (network_id, arc, connection, time_min, energy_kwh, rank) with rank the
    slope's position in the frozen reference.  One draw decides a connection in both
    directions; steeper connections are likelier to be hit (twice the share times rank).
    """
    both = logical.join(registry.drop("seed"), "network_id")
    draw = uniform(seed, F.col("connection"), F.col("draw").cast("string"))
    hit = draw < F.least(F.lit(1.0), 2 * F.col("hit_share") * F.col("rank"))
    return both.withColumn("uniform", draw).withColumn("disrupted", hit).select(
        "scenario_id", "network_id", "arc", "connection", "uniform", "disrupted",
        F.when(F.col("disrupted"), F.col("time_min") * F.col("time_factor")).otherwise(F.col("time_min")).alias("time_min"),
        F.when(F.col("disrupted"), F.col("energy_kwh") * F.col("energy_factor")).otherwise(F.col("energy_kwh")).alias("energy_kwh"),
    )
