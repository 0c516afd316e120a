"""Synthetic demo inputs, always labelled as such: a grid of villages, streets through them, a sloping plain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import POINT


def population(spark: SparkSession) -> DataFrame:
    """Nine villages of one cell on a 3 x 3 grid within 20 x 20 cells; 540 people, 20 of them at the Depot in cell (2, 2)."""
    i = F.col("id")
    return spark.range(9).select((2 + 7 * (i / 3).cast("int")).cast("int").alias("row"), (2 + 7 * (i % 3)).cast("int").alias("col"), F.when(i == 0, 20.0).otherwise(65.0).alias("pop"))


def roads(spark: SparkSession) -> DataFrame:
    """Three streets along each direction, through the villages."""
    at = 250.0 + 700.0 * (F.col("id") % 3)
    across = F.col("id") < 3
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    end = lambda v: F.when(across, point(F.lit(v), at)).otherwise(point(at, F.lit(v)))
    return spark.range(6).select(
        F.concat(F.lit("road"), F.col("id").cast("string")).alias("source_id"), F.lit("0").alias("grade_key"),
        F.when(F.col("id") % 3 == 1, "secondary").otherwise("residential").alias("road_class"), F.lit("no").alias("oneway"),
        F.lit(None).cast("string").alias("access"), F.array(end(0.0), end(2000.0)).cast(f"array<{POINT}>").alias("pts"),
    )


def elevation(spark: SparkSession, n: int = 220, cell_m: float = 10.0) -> DataFrame:
    """A plain that rises to the east and rolls to the north; row 0 is its northern edge."""
    i = F.col("id")
    row, col = (i / n).cast("int"), (i % n).cast("int")
    return spark.range(n * n).select(row.alias("row"), col.alias("col"), (col * cell_m * 0.02 + F.sin(row / 15.0) * 5).alias("z"))
