"""GeoTIFF grids as cell tables.  Files are read by Spark, so any store it knows will do."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: TIFF tags that are used.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, FORMAT, SCALE, TIEPOINT, NODATA = 322, 323, 324, 325, 339, 33550, 33922, 42113
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8}
_CODE = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
SCHEMA = "path string, row int, col int, x double, y double, value double"


def tags(data: bytes) -> tuple[str, dict]:
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    if struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    out = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        size = _SIZE.get(kind, 1) * count
        place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
        if kind == 2:
            out[tag] = data[place : place + count].rstrip(b"\0").decode("ascii", "replace")
        elif kind in _CODE:
            out[tag] = struct.unpack_from(f"{order}{count}{_CODE[kind]}", data, place)
    return order, out


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    """Band 1 as float64 with nodata as NaN, and {x0, y0, dx, dy}."""
    order, t = tags(data)
    w, h, bits = t[WIDTH][0], t[HEIGHT][0], t.get(BITS, (8,))[0]
    samples, packing, predictor = t.get(SAMPLES, (1,))[0], t.get(COMPRESSION, (1,))[0], t.get(PREDICTOR, (1,))[0]
    if packing not in (1, 8, 32946) or predictor not in (1, 2):
        raise ValueError(f"TIFF compression {packing} with predictor {predictor} isn't read")
    kind = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[t.get(FORMAT, (1,))[0]] }{bits // 8}")
    tiled = TILES in t
    tw, th = (t[TILE_WIDTH][0], t[TILE_HEIGHT][0]) if tiled else (w, t.get(STRIP_ROWS, (h,))[0])
    out = np.empty((h, w), dtype=np.float64)
    across = -(-w // tw)
    for i, (at, size) in enumerate(zip(t[TILES if tiled else STRIPS], t[TILE_BYTES if tiled else STRIP_BYTES])):
        raw = data[at : at + size]
        raw = zlib.decompress(raw) if packing != 1 else raw
        r, c = (i // across) * th, (i % across) * tw
        rows = th if tiled else min(th, h - r)
        block = np.frombuffer(raw, dtype=kind, count=rows * tw * samples).reshape(rows, tw, samples)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=kind)
        part = block[: h - r, : w - c, 0]
        out[r : r + part.shape[0], c : c + part.shape[1]] = part
    if str(t.get(NODATA, "")).strip():
        out[out == float(t[NODATA])] = np.nan
    scale, tie = t.get(SCALE, (1.0, 1.0, 0.0)), t.get(TIEPOINT, (0.0,) * 6)
    return out, {"x0": tie[3] - tie[0] * scale[0], "y0": tie[4] + tie[1] * scale[1], "dx": scale[0], "dy": scale[1]}


def encode(grid: np.ndarray, x0: float, y0: float, cell: float, nodata: float | None = None, compress: bool = False) -> bytes:
    """A one-strip float32 GeoTIFF."""
    data = np.ascontiguousarray(grid, dtype="<f4").tobytes()
    data = zlib.compress(data) if compress else data
    entries = [(WIDTH, 4, (grid.shape[1],)), (HEIGHT, 4, (grid.shape[0],)), (BITS, 3, (32,)), (COMPRESSION, 3, (8 if compress else 1,)), (STRIPS, 4, None), (SAMPLES, 3, (1,)), (STRIP_ROWS, 4, (grid.shape[0],)), (STRIP_BYTES, 4, (len(data),)), (FORMAT, 3, (3,)), (SCALE, 12, (cell, cell, 0.0)), (TIEPOINT, 12, (0.0, 0.0, 0.0, x0, y0, 0.0))]
    if nodata is not None:
        entries.append((NODATA, 2, str(nodata).encode() + b"\0"))
    extra, start = b"", 8 + 2 + 12 * len(entries) + 4
    sizes = [len(v) if k == 2 else (1 if v is None else len(v)) * _SIZE[k] for _, k, v in entries]
    strip = start + sum(s for s in sizes if s > 4)
    ifd = struct.pack("<H", len(entries))
    for (tag, kind, v), size in zip(entries, sizes):
        raw = struct.pack("<I", strip) if v is None else v if kind == 2 else struct.pack(f"<{len(v)}{_CODE[kind]}", *v)
        ifd += struct.pack("<HHI", tag, kind, len(v) if v is not None else 1)
        if size > 4:
            ifd += struct.pack("<I", start + len(extra))
            extra += raw
        else:
            ifd += raw.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8) + ifd + b"\0" * 4 + extra + data


def read_grid(spark: SparkSession, path: str, drop_nodata: bool = False) -> DataFrame:
    """Cells (path, row, col, x, y, value) of the GeoTIFF files under ``path``; nodata is null.

    A file is unpacked whole by one task, row blocks at a time leave it; tile a very
    large raster into files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                grid, g = decode(bytes(data))
                for r in range(0, len(grid), 256):
                    part = grid[r : r + 256]
                    row, col = np.indices(part.shape)
                    row, col, value = row.ravel() + r, col.ravel(), part.ravel()
                    keep = ~np.isnan(value) if drop_nodata else slice(None)
                    row, col, value = row[keep], col[keep], value[keep]
                    yield pd.DataFrame({"path": name, "row": row.astype("int32"), "col": col.astype("int32"), "x": g["x0"] + (col + 0.5) * g["dx"], "y": g["y0"] - (row + 0.5) * g["dy"], "value": pd.array(value, dtype="Float64") if not np.isnan(value).any() else [None if np.isnan(v) else v for v in value]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, SCHEMA)
