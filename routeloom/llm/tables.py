"""Fixed-size count tables summed over all map tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import pack, unpack

SCHEMA = "name string, block int, cells binary"
#: Blocks that a table is cut into, so that summing it is spread over as many groups.
BLOCKS = 256


def emit(tables: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's tables (integers, of any shape) as rows, blocks of zeros left out."""
    for name, table in tables.items():
        parts = np.array_split(table.reshape(-1), BLOCKS)
        kept = [(i, p) for i, p in enumerate(parts) if p.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(kept), pa.string()), pa.array([i for i, _ in kept], pa.int32()), pa.array([pack([p]) for _, p in kept], pa.binary())],
            ["name", "block", "cells"],
        )


def _sum(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for cell in b.column("cells"):
            (x,) = unpack(cell.as_buffer().to_pybytes())
            total = x.astype(np.int64) if total is None else total + x
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([pack([total])], pa.binary())], ["name", "block", "cells"])


#: Map tasks whose tables are summed to one before those of all are.
TOGETHER = 64


def collect(rows: DataFrame, size: int) -> dict[str, np.ndarray]:
    """The summed tables, flat; their size doesn't depend on the number of documents."""
    out: dict[str, np.ndarray] = {}
    bounds = np.cumsum([0, *[len(p) for p in np.array_split(np.empty(size, np.int8), BLOCKS)]])
    some = rows.withColumn("part", F.floor(F.spark_partition_id() / TOGETHER)).groupBy("name", "block", "part").applyInArrow(_sum, SCHEMA)
    for r in some.groupBy("name", "block").applyInArrow(_sum, SCHEMA).collect():
        (x,) = unpack(bytes(r.cells))
        out.setdefault(r.name, np.zeros(size, dtype=np.int64))[bounds[r.block] : bounds[r.block + 1]] = x
    return out


def fold(n: int) -> F.Column:
    """crc32 of doc_id as text, modulo n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))
