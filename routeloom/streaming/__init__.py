"""Streaming versions of per-record gates.  Batch is the model's own mode; these are an addition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_gate(snaps: DataFrame, window: str = "1 hour", late: str = "2 hours", percent: int = 20) -> DataFrame:
    """Coverage by window of a stream (ts, terminal_id, distance_covered).

    A window is qualified while fewer than ``percent`` in a hundred of its records are
    uncovered; records later than the watermark are dropped with the state they missed.
    """
    by = snaps.withWatermark("ts", late).groupBy(F.window("ts", window))
    out = by.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("distance_covered")).alias("uncovered"))
    return out.select("window.start", "window.end", "n", "uncovered", (100 * F.col("uncovered") < percent * F.col("n")).alias("qualified"))
