"""Repeated byte windows across documents by a depth-limited radix sort of suffixes.

A suffix matters only through its first ``window`` bytes.  Sorting every suffix of
the corpus by digits moves several times the corpus (measured, see the README), so
suffixes are packed first, and only those that packing leaves open are sorted one by
one:

1. Packing.  The *anchor* of a suffix is the smallest-hash 24-byte string inside its
   window.  Equal windows have equal anchors, and neighbouring suffixes mostly share
   one, so one entry stands for a run of about 13 suffixes.  It carries the hash of
   the anchor and that of the run's whole *context*, all bytes of its windows.  Runs
   whose anchor no other document has drop out.  Where an anchor has one context
   everywhere (the inside of copies) its windows are equal one by one, and the run is
   settled as a whole.
2. First digit.  The suffixes of runs whose anchor stands in two or more contexts (the
   edges of copies) are sorted by their first digit, bytes 0 to 24.
3. Second digit.  Groups that agree in the first digit are sorted by the second, bytes
   25 to 49.  Groups equal in both are exactly the repeated windows; in each, every
   suffix of a document that isn't the smallest is marked.

Digits, anchors and contexts are compared by 64-bit hashes (two for a window), so
groups stand in the order of hashes; anchors by 32 bits beyond those that deal them.

Scale.  Entries travel as packed numpy columns in frames (see ``packed``), about 20
bytes for 13 bytes of text.  A batch settles its own repeats first: it sends one entry
for each context and marks the others at once, and an anchor with several contexts in
a batch is sent as one flag.  So what reaches a reducer for one anchor, however
common, grows with the number of batches and not with that of documents.  Each
intermediate table is written to the shared folder, its shuffle files are dropped, and
texts meet their marks in a sort-merge join on document and text hash.

Defined results.  Null text counts as empty.  A null doc_id is smaller than every
other.  Rows that share a doc_id never mark each other; each is judged by its own
text.  Rows that repeat whole are all returned.  Texts shorter than the window lose
nothing; an empty table gives an empty result.  Only doc_id and text are read, so
other columns neither clash nor pass through.  A long text is hashed in pieces of
``PIECE`` bytes that overlap by a window; its asked windows in runs of ``ASKED``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table
from .packed import ROW, Frames, cells, exchange, frames, mix, pack, runs, split_by, unpack

WINDOW = 50
#: Text bytes hashed at once, and text bytes whose entries a batch settles among themselves.
CHUNK_BYTES, BATCH_BYTES = 1 << 20, 24 << 20
#: Text bytes for each bucket of the packed exchanges.
BUCKET_BYTES = 12 << 20
NULL_ID = np.iinfo(np.int64).min
#: Asked windows of a text that are hashed at once.
ASKED = 1 << 20
_U = np.uint64


def _loads(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a little-endian number."""
    return np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


def window_hash(words: np.ndarray, at: np.ndarray, window: int, seed: int) -> np.ndarray:
    """64-bit hashes of the windows that start at ``at``."""
    h = np.full(len(at), _U(seed))
    for step in [*range(0, window - 8, 8), window - 8]:
        h = mix(h ^ words[at + step]) + _U(0x9E3779B97F4A7C15)
    return h


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW):
    """Runs of windows that share an anchor: (document index, first, last start, anchor hash).

    ``buf`` holds the texts one after another, then eight bytes; ``starts`` and
    ``ends`` are their bounds.
    """
    k = 8 * max(1, window // 16)
    w = window - k + 1
    bits = max(1, int(np.ceil(np.log2(w))))
    words = _loads(buf)
    n = len(buf) - 8 - k + 1
    if n < w:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(_U)
    h = words[:n] * _U(0xC2B2AE3D27D4EB4F)
    for step in range(8, k, 8):
        h ^= h >> _U(29)
        h += words[step : step + n]
        h *= _U(0x9FB21C651E98DF25)
    h ^= h >> _U(32)
    h <<= _U(bits)  # the low bits take the offset within the span, so that ties go to the left
    span, low = 1, h
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:] + _U(span))
        span *= 2
    if span < w:
        rest = w - span
        low = np.minimum(low[: len(low) - rest], low[rest:] + _U(rest))
    doc = np.repeat(np.arange(len(starts)), np.maximum(ends - starts - window + 1, 0))
    if not len(doc):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(_U)
    count = np.maximum(ends - starts - window + 1, 0)
    first_of = np.cumsum(count) - count
    p = np.arange(len(doc)) - first_of[doc] + starts[doc]
    key = low[p]
    at = p + (key & _U((1 << bits) - 1)).astype(np.int64)
    cut = runs(doc, at)
    a, b = cut[:-1], cut[1:] - 1
    return doc[a], p[a], p[b], key[a] >> _U(bits)


class Batch:
    """Entries of one map batch."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.rows: list[int] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.bytes = 0

    def columns(self, n: int) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(n))
        return tuple(np.concatenate(x) for x in zip(*self.parts))

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.ids, dtype=np.int64), np.array(self.rows, dtype=np.int64)


def _id(x) -> int:
    return NULL_ID if x is None else x


def _doc_bucket(ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return (mix(ids.view(_U) * _U(3) ^ rows.view(_U)) % _U(n)).astype(np.int64)


def _record(rows: list[tuple[int, int, bytes]], n: int, fan: int | None) -> pa.RecordBatch:
    out = Frames(n, fan)
    for to, kind, payload in rows:
        out.add(to, 0, kind, payload)
    return out.record()


ENTRY, MARK, ASK = 0, 1, 2


def _to_docs(kind: int, doc: np.ndarray, first: np.ndarray, length: np.ndarray, ids, rows, n: int) -> list:
    """Marks or asks packed for the buckets of their documents."""
    if not len(doc):
        return []
    out = []
    for bucket, at in split_by(_doc_bucket(ids[doc], rows[doc], n)):
        used, local = np.unique(doc[at], return_inverse=True)
        out.append((bucket, kind, pack([ids[used], rows[used], local.astype(np.uint32), first[at].astype(np.uint32), length[at].astype(np.uint32)])))
    return out


def _entries(keys: list[np.ndarray], doc, first, length, bucket, ids, rows) -> list:
    out = []
    for b, at in split_by(bucket):
        used, local = np.unique(doc[at], return_inverse=True)
        out.append((b, ENTRY, pack([ids[used], rows[used], local.astype(np.uint32), first[at].astype(np.uint32), length[at].astype(np.uint8), *[k[at] for k in keys]])))
    return out


def settle_contexts(d, c, doc_id, flagged):
    """Over entries sorted by anchor, context, doc_id: which are marked, which must be asked for
    windows, which stand for their context alone (the only one of its anchor)."""
    n = len(d)
    cut = runs(d, c)
    size = np.diff(cut)
    low = np.repeat(doc_id[cut[:-1]], size)
    marked = doc_id > low
    dcut = runs(d)
    contexts = np.searchsorted(cut[:-1], dcut[1:]) - np.searchsorted(cut[:-1], dcut[:-1])
    flags = np.add.reduceat(flagged.astype(np.int64), dcut[:-1]) if n else np.zeros(0, dtype=np.int64)
    several = np.repeat((contexts > 1) | (flags > 0), np.diff(dcut))
    return marked, several & ~marked, ~several & ~marked


def _finish_contexts(batch: Batch, n_buckets: int) -> list:
    doc, first, length, d, c = batch.columns(5)
    batch.parts = []
    ids, rows = batch.documents()
    if not len(doc):
        return []
    order = np.lexsort((ids[doc], c, d))
    doc, first, length, d, c = (x[order] for x in (doc, first, length, d, c))
    marked, asked, alone = settle_contexts(d, c, ids[doc], np.zeros(len(doc), dtype=bool))
    out = _to_docs(MARK, doc[marked], first[marked], length[marked] + WINDOW, ids, rows, n_buckets)
    out += _to_docs(ASK, doc[asked], first[asked], length[asked], ids, rows, n_buckets)
    bucket = ((d >> _U(8)) % _U(n_buckets)).astype(np.int64)
    d32 = (mix(d) >> _U(32)).astype(np.uint32)
    # One flag for an anchor that has several contexts here.
    flag = np.flatnonzero(asked)
    flag = flag[np.unique(d[flag], return_index=True)[1]]
    at = np.concatenate([np.flatnonzero(alone), flag])
    size = length.astype(np.int64).copy()
    size[flag] = 255
    return out + _entries([d32[at], c[at]], doc[at], first[at], size[at], bucket[at], ids, rows)


def _rows_of(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        cols = [b.column(i) for i in range(b.num_columns)]
        for i in range(b.num_rows):
            yield [c[i] for c in cols]


#: Longest piece of a text that is hashed at once; pieces overlap by a window less one byte.
PIECE = 4 << 20


def _map_contexts(n_buckets: int, fan: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, held, size = Batch(), [], 0

        def hash_held() -> None:
            nonlocal held, size
            if not held:
                return
            buf = np.frombuffer(b"".join([x[0] for x in held]) + b"\0" * 8, dtype=np.uint8)
            ends = np.cumsum([len(x[0]) for x in held])
            starts = ends - [len(x[0]) for x in held]
            doc, p1, p2, d = anchors(buf, starts, ends)
            if len(doc):
                words = _loads(buf)
                c = mix(window_hash(words, p1, WINDOW, 11) * _U(3) + mix(window_hash(words, p2, WINDOW, 12) ^ (p2 - p1).astype(_U)))
                local = np.array([x[1] for x in held])[doc]
                shift = np.array([x[2] for x in held])[doc]
                batch.parts.append((local.astype(np.uint32), (p1 - starts[doc] + shift).astype(np.uint32), (p2 - p1).astype(np.uint8), d, c))
            batch.bytes += size
            held, size = [], 0

        for doc_id, row, text in _rows_of(batches):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if len(raw) < WINDOW:
                continue
            batch.ids.append(_id(doc_id.as_py()))
            batch.rows.append(row.as_py())
            for a in range(0, len(raw) - WINDOW + 1, PIECE):
                part = raw[a : a + PIECE + WINDOW - 1]
                held.append((part, len(batch.ids) - 1, a))
                size += len(part)
                if size >= CHUNK_BYTES:
                    hash_held()
            if batch.bytes >= BATCH_BYTES:
                hash_held()
                yield _record(_finish_contexts(batch, n_buckets), n_buckets, fan)
                batch = Batch()
        hash_held()
        yield _record(_finish_contexts(batch, n_buckets), n_buckets, fan)

    return run


def _gather(tables: Iterator[pa.RecordBatch] | list, width: int):
    """Entry columns of a bucket over one list of documents, and what only passes through."""
    ids, rows, cols, passing, base = [], [], [], [], 0
    for _, _, kind, data in frames(cells(tables)):
        if kind != ENTRY:
            passing.append((kind, data))
            continue
        a, b, local, *rest = unpack(data)
        ids.append(a)
        rows.append(b)
        cols.append((local.astype(np.int64) + base, *rest))
        base += len(a)
    if not cols:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), None, passing
    return np.concatenate(ids), np.concatenate(rows), [np.concatenate(x) for x in zip(*cols)], passing


def _reduce_contexts(n_buckets: int, fan: int | None = None):
    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = key[0].as_py()
        ids, rows, cols, passing = _gather(tables, 5)
        out = [(bucket, kind, data) for kind, data in passing]
        if cols is not None:
            doc, first, length, d, c = cols
            order = np.lexsort((ids[doc], c, d))
            doc, first, length, d, c = (x[order] for x in (doc, first, length, d, c))
            flagged = length == 255
            # A flag stands for other batches' contexts: it is itself neither marked nor asked.
            marked, asked, _ = settle_contexts(d, np.where(flagged, _U(0), c), np.where(flagged, NULL_ID, ids[doc]), flagged)
            marked, asked = marked & ~flagged, asked & ~flagged
            out += _to_docs(MARK, doc[marked], first[marked], length[marked].astype(np.int64) + WINDOW, ids, rows, n_buckets)
            out += _to_docs(ASK, doc[asked], first[asked], length[asked], ids, rows, n_buckets)
        yield _record(out, n_buckets, fan)

    return run


def _by_digits(doc, first, one, two, ids):
    """Entries sorted by first digit, second digit and document, and the bounds of the groups.

    Groups of the first digit that hold one document alone drop out before the second.
    """
    order = np.lexsort((ids[doc], one))
    cut = runs(one[order])
    several = ids[doc[order[cut[:-1]]]] != ids[doc[order[cut[1:] - 1]]] if len(order) else np.zeros(0, bool)
    order = order[np.repeat(several, np.diff(cut))]
    order = order[np.lexsort((ids[doc[order]], two[order], one[order]))]
    doc, first, one, two = (x[order] for x in (doc, first, one, two))
    return doc, first, runs(one, two)


def _reduce_windows(n_buckets: int, fan: int | None = None):
    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = key[0].as_py()
        ids, rows, cols, passing = _gather(tables, 5)
        out = [(bucket, kind, data) for kind, data in passing]
        if cols is not None:
            doc, first, _, one, two = cols
            doc, first, cut = _by_digits(doc, first, one, two, ids)
            marked = ids[doc] > np.repeat(ids[doc][cut[:-1]], np.diff(cut))
            out += _to_docs(MARK, doc[marked], first[marked], np.full(int(marked.sum()), WINDOW), ids, rows, n_buckets)
        yield _record(out, n_buckets, fan)

    return run


def merge_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [first, last) of sorted or unsorted ranges."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > last[:-1])
    at = np.flatnonzero(new)
    return first[at], last[np.append(at[1:] - 1, len(last) - 1)]


def _by_document(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks and asks of a bucket's documents, a row for each document."""
    found = {MARK: [], ASK: []}
    for _, _, kind, data in frames(cells(tables)):
        a, b, local, first, length = unpack(data)
        found[kind].append((a[local], b[local], first, length))
    by_row: dict[tuple[int, int], list] = {}
    for kind, parts in found.items():
        if not parts:
            continue
        ids, rows, first, length = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first, rows, ids))
        ids, rows, first, length = (x[order] for x in (ids, rows, first, length))
        cut = runs(ids, rows)
        for a, b in zip(cut, cut[1:]):
            x, y = first[a:b].astype(np.int64), length[a:b].astype(np.int64)
            if kind == MARK:
                s, e = merge_spans(x, x + y)
                x, y = s, e - s
            by_row.setdefault((int(ids[a]), int(rows[a])), [None, None])[kind - MARK] = pack([x.astype(np.uint32), y.astype(np.uint32)])
        del ids, rows, first, length
    keys = list(by_row)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([None if k[0] == NULL_ID else k[0] for k in keys], pa.int64()),
            pa.array([k[1] for k in keys], pa.int64()),
            pa.array([by_row[k][0] for k in keys], pa.binary()),
            pa.array([by_row[k][1] for k in keys], pa.binary()),
        ],
        ["__id", "__row", "marks", "asks"],
    )


_DOC = "__id long, __row long, marks binary, asks binary"


def _map_windows(n_buckets: int, fan: int | None = None):
    """Rows (doc_id, row, text, asks): the windows of the asked runs."""

    def finish(batch: Batch) -> list:
        doc, first, one, two = batch.columns(4)
        ids, rows = batch.documents()
        if not len(doc):
            return []
        # All of a group but its smallest document are marked here; that one is sent on.
        order = np.lexsort((ids[doc], two, one))
        doc, first, one, two = (x[order] for x in (doc, first, one, two))
        cut = runs(one, two)
        marked = ids[doc] > np.repeat(ids[doc][cut[:-1]], np.diff(cut))
        out = _to_docs(MARK, doc[marked], first[marked], np.full(int(marked.sum()), WINDOW), ids, rows, n_buckets)
        at = np.flatnonzero(~marked)
        bucket = ((one[at] >> _U(16)) % _U(n_buckets)).astype(np.int64)
        return out + _entries([one[at], two[at]], doc[at], first[at], np.zeros(len(at)), bucket, ids, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = Batch()
        for doc_id, row, text, asks in _rows_of(batches):
            raw = text.as_buffer().to_pybytes()
            first, length = (x.astype(np.int64) for x in unpack(asks.as_buffer().to_pybytes()))
            words = _loads(np.frombuffer(raw + b"\0" * 8, dtype=np.uint8))
            size = length + 1
            part = np.cumsum(size) // ASKED
            for a in np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist():
                own = part == part[a]
                n = size[own]
                at = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                batch.ids.append(_id(doc_id.as_py()))
                batch.rows.append(row.as_py())
                one, two = (window_hash(words, x, WINDOW // 2, seed) for x, seed in ((at, 21), (at + WINDOW // 2, 22)))
                batch.parts.append((np.full(len(at), len(batch.ids) - 1, dtype=np.uint32), at.astype(np.uint32), one, two))
                batch.bytes += len(at) * 32
                if batch.bytes >= BATCH_BYTES * 2:
                    yield _record(finish(batch), n_buckets, fan)
                    batch = Batch()
        yield _record(finish(batch), n_buckets, fan)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, marks): spans and the bytes that stay."""
    for b in batches:
        n_bytes, spans, kept = [], [], []
        for _, text, marks in _rows_of([b]):
            raw = text.as_buffer().to_pybytes()
            n_bytes.append(len(raw))
            if not marks.is_valid:
                spans.append([])
                kept.append(raw)
                continue
            first, length = (x.astype(np.int64).tolist() for x in unpack(marks.as_buffer().to_pybytes()))
            spans.append([{"a": x, "b": x + y} for x, y in zip(first, length)])
            at = [0, *[x + y for x, y in zip(first, length)]]
            kept.append(b"".join(raw[x:y] for x, y in zip(at, [*first, len(raw)])))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "spans", "kept"],
        )


def repeated_spans(df: DataFrame, fan: int | None = None) -> DataFrame:
    """(__id, __row, marks, asks): marked byte runs of each document that has any."""
    spark = df.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES)

    def grouped(rows: DataFrame, how, schema: str) -> DataFrame:
        return exchange(rows, n, fan).groupBy("to").applyInArrow(how, schema)

    entries = docs.mapInArrow(_map_contexts(n, fan), ROW)
    settled = grouped(entries, _reduce_contexts(n, fan), ROW)
    by_doc = materialize(grouped(settled, _by_document, _DOC), "suffix-contexts")
    asks = by_doc.filter(F.col("asks").isNotNull()).select("__id", "__row", "asks")
    same = docs["doc_id"].eqNullSafe(asks["__id"]) & (docs["row"] == asks["__row"])
    asked = docs.join(asks.hint("merge"), same).select("doc_id", "row", "text", "asks")
    windows = grouped(asked.mapInArrow(_map_windows(n, fan), ROW), _reduce_windows(n, fan), ROW)
    more = materialize(grouped(windows, _by_document, _DOC), "suffix-windows")

    both = by_doc.select("__id", "__row", "marks").unionByName(more.select("__id", "__row", "marks"))
    return both.filter(F.col("marks").isNotNull()).groupBy("__id", "__row").agg(F.collect_list("marks").alias("parts"))


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        merged = []
        for parts in b.column(2).to_pylist():
            got = [unpack(x) for x in parts]
            first = np.concatenate([x[0] for x in got]).astype(np.int64)
            last = first + np.concatenate([x[1] for x in got])
            s, e = merge_spans(first, last)
            merged.append(pack([s.astype(np.uint32), (e - s).astype(np.uint32)]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(merged, pa.binary())], ["__id", "__row", "marks"])


def drop_repeats(df: DataFrame, fan: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row of ``df``: byte runs that repeat 50 bytes of a
    document with a smaller id, and the bytes that stay."""
    marks = repeated_spans(df, fan).mapInArrow(_join_parts, "__id long, __row long, marks binary")
    marks = materialize(marks, "suffix-marks")
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    same = docs["doc_id"].eqNullSafe(marks["__id"]) & (docs["row"] == marks["__row"])
    joined = docs.join(marks.hint("merge"), same, "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, spans array<struct<a:long,b:long>>, kept binary")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents that repeat 50 bytes of a smaller doc_id are removed.

    Nulls, short texts, ties, repeated rows, empty tables and other columns: see the module.
    """
    out = drop_repeats(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
