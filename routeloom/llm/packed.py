"""Packed numpy columns as binary cells, so that one shuffled row carries thousands of entries.

What one task has for one destination is a frame.  A sender writes one row for each
of at most ``FAN`` groups of destinations, with the frames of the whole group; beyond
so many destinations ``exchange`` routes the rows by group first, where the frames
of many senders for one destination join.  So rows stay long at any size: their
number grows with the data and not with senders times destinations.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Groups of destinations of one sender, and bytes that a router joins before it passes them on.
FAN, ROUTE_BYTES = 1024, 32 << 20
ROW = "to int, data binary"
_HEAD = struct.Struct("<iiBI")


class Frames:
    """Frames (destination, source, kind, payload) of one sender for ``n`` destinations, by group."""

    def __init__(self, n: int, fan: int | None = None):
        self.step = -(-n // (fan or FAN))
        self.held: dict[int, list[bytes]] = {}

    def add(self, to: int, source: int, kind: int, payload: bytes) -> None:
        self.held.setdefault(to // self.step, []).extend((_HEAD.pack(to, source, kind, len(payload)), payload))

    def record(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(self.held), pa.int32()), pa.array([b"".join(v) for v in self.held.values()], pa.binary())], ["to", "data"])
        self.held = {}
        return out


def frames(cells: Iterable[bytes]) -> Iterator[tuple[int, int, int, bytes]]:
    for data in cells:
        at = 0
        while at < len(data):
            to, source, kind, size = _HEAD.unpack_from(data, at)
            at += _HEAD.size + size
            yield to, source, kind, data[at - size : at]


def cells(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
    for b in batches:
        for x in b.column("data"):
            yield x.as_buffer().to_pybytes()


def exchange(rows: DataFrame, n: int, fan: int | None = None) -> DataFrame:
    """Rows (to, data) by group of destinations as rows by destination."""
    if n <= (fan or FAN):
        return rows

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = Frames(1, 1), 0
        for data in cells(batches):
            for to, source, kind, payload in frames([data]):
                out.add(to, source, kind, payload)
            size += len(data)
            if size >= ROUTE_BYTES:
                yield out.record()
                size = 0
        yield out.record()

    return rows.repartition("to").mapInArrow(route, ROW)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as bytes; each is stored byte plane by byte plane, which the shuffle's codec compresses."""
    out = [struct.pack("<I", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(struct.pack("<8sQ", a.dtype.str.encode(), len(a)))
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<I", data)
    at, out = 4, []
    for _ in range(n):
        kind, size = struct.unpack_from("<8sQ", data, at)
        at += 16
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        raw = np.frombuffer(data, dtype=np.uint8, count=size * dtype.itemsize, offset=at)
        at += size * dtype.itemsize
        out.append(np.ascontiguousarray(raw.reshape(dtype.itemsize, size).T).view(dtype).reshape(size))
    return out


def runs(*keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal keys in sorted arrays, and the length at the end."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, dtype=np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def split_by(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, row numbers) for each bucket that occurs; rows keep their order."""
    order = np.argsort(bucket, kind="stable")
    cut = runs(bucket[order])
    return [(int(bucket[order[a]]), order[a:b]) for a, b in zip(cut, cut[1:])]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over uint64."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))
