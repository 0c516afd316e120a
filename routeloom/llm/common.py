"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import materialize, work_path  # noqa: F401  shared by the operators

#: ASCII white space as the contracts define it: space and \t \n \v \f \r.
ASCII_SPACE = "\\x20\\x09-\\x0D"
WORD_PATTERN = f"[^{ASCII_SPACE}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z; every other character stays.

    ``lower`` does the same on text that is ASCII throughout, many times faster.
    """
    ascii_only = F.length(col) == F.octet_length(col)
    return F.when(ascii_only, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id and text (null becomes empty) and the named columns, no others."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)


def others(df: DataFrame, made: Iterable[str]) -> list[str]:
    """Columns of ``df`` but those that an operator makes; names are equal whatever their case, as Spark has it."""
    names = {m.lower() for m in made}
    return [c for c in df.columns if c.lower() not in names]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
