"""CSV and JSON tables with declared schemas, and GeoJSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table; ``schema`` is DDL or the name of one in ``schemas``.  Rows that don't fit are an error."""
    ddl = getattr(schemas, schema.upper(), schema)
    return spark.read.schema(ddl).option("header", True).option("mode", "FAILFAST").csv(path)


def read_profiles_csv(spark: SparkSession, path: str) -> DataFrame:
    """Elevation profiles whose arrays are JSON text."""
    raw = read_csv(spark, path, "edge_id string, sample_distances_m_json string, smoothed_elevations_m_json string")
    return raw.select("edge_id", *[F.from_json(f"{c}_json", "array<double>").alias(c) for c in ("sample_distances_m", "smoothed_elevations_m")])


def with_json_arrays(df: DataFrame) -> DataFrame:
    """Array columns as JSON text under the name with _json, as CSV needs it."""
    names = {c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))}
    return df.select(*[F.to_json(c).alias(f"{c}_json") if c in names else F.col(c) for c in df.columns])


def geojson_line(pts: str, *properties: str) -> Column:
    """A LineString feature as text."""
    coordinates = F.transform(pts, lambda p: F.array(p["x"], p["y"]))
    geometry = F.struct(F.lit("LineString").alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*[F.col(p) for p in properties]).alias("properties"), geometry.alias("geometry")))
