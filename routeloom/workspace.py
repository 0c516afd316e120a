"""The folder that driver and executors share, and tables written to it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Drops a query's shuffle files as soon as it has been written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Paths of the tables that the innermost ``temporary`` of this thread has seen written.
_made: ContextVar[list[str] | None] = ContextVar("routeloom_tables", default=None)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; in local mode, where it is unset, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    made = getattr(spark.sparkContext, "_routeloom_shared", None)
    if made is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="routeloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        made = spark.sparkContext._routeloom_shared = f"file://{path}"
        spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/routeloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: its lineage and shuffle files end here."""
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    made = _made.get()
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder; nothing may read it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that ``materialize`` writes meanwhile are deleted at the end; take out of the list what stays."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for path in made:
            drop(spark, path)
