import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from routeloom.llm import packed
from routeloom.llm import suffix_dedup as S


def brute(rows, n=50):
    """For each row: marked bytes, from the smallest document that holds each window."""
    low = {}
    for doc, text in rows:
        raw, key = (text or "").encode(), S._id(doc)
        for p in range(len(raw) - n + 1):
            w = raw[p : p + n]
            low[w] = min(low.get(w, key), key)
    out = []
    for doc, text in rows:
        raw, key = (text or "").encode(), S._id(doc)
        gone = bytearray(len(raw))
        for p in range(len(raw) - n + 1):
            if low[raw[p : p + n]] < key:
                gone[p : p + n] = b"\1" * n
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, parts=3, **sizes):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, row string").repartition(parts)
    df = df.withColumns({"Copies": F.lit("clash"), "batch": F.lit("clash"), "KEPT": F.lit("clash")})
    got = S.drop_repeats(df, **sizes).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, sum(s.b - s.a for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got),
        key=repr,
    )


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß ñ") for _ in range(rng.randrange(2, 9))) for _ in range(120)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randrange(6, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 8)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))))
        text = " ".join(parts)
        if rng.random() < 0.2:
            text = rng.choice(rows)[1] if rows else text
        if rng.random() < 0.2:
            a = rng.randrange(max(1, len(text)))
            text = text[a:] + "q" + text[:a]
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 400), (n + 3, "a" * 49), (n + 4, "a" * 51), (n + 5, "ab" * 300), (5, rows[3][1]), (5, rows[3][1]), (None, rows[8][1] + "zz")]
    return rows


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert result(spark, rows) == brute(rows)


def test_by_way_of_routers(spark):
    """Buckets in two groups, whose rows are routed on."""
    rows = corpus(3, 40)
    assert result(spark, rows, fan=2) == brute(rows)


def test_small_batches_and_pieces(spark, monkeypatch):
    rows = corpus(3, 30)
    # Local mode forks workers that import the module anew, so the mapper is driven directly here.
    monkeypatch.setattr(S, "PIECE", 100)
    monkeypatch.setattr(S, "CHUNK_BYTES", 300)
    monkeypatch.setattr(S, "BATCH_BYTES", 2000)
    monkeypatch.setattr(S, "ASKED", 40)

    def table(cols, names):
        return pa.RecordBatch.from_arrays(cols, names)

    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    keys = [hash((r[0], r[1])) % 10**9 for r in rows]
    batch = table([pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "row", "text"])

    def group(batches):
        by = {}
        for b in batches:
            for to, _, kind, data in packed.frames(packed.cells([b])):
                by.setdefault(to, []).append((to, kind, data))
        return {k: S._record(v, 3, None) for k, v in by.items()}

    def reduce(batches, how):
        return [x for k, v in group(batches).items() for x in how((pa.scalar(k),), iter([v]))]

    n = 3
    docs = reduce(reduce(S._map_contexts(n)(iter([batch])), S._reduce_contexts(n)), S._by_document)
    marks, asked = {}, []
    for d in docs:
        for r in d.to_pylist():
            if r["marks"]:
                marks.setdefault((r["__id"], r["__row"]), []).append(r["marks"])
            if r["asks"]:
                text = next(t for i, k, t in zip(ids, keys, texts) if (i, k) == (r["__id"], r["__row"]))
                asked.append((r["__id"], r["__row"], text, r["asks"]))
    cols = list(zip(*asked))
    ask = table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3], pa.binary())], ["a", "b", "c", "d"])
    for d in reduce(reduce(S._map_windows(n)(iter([ask])), S._reduce_windows(n)), S._by_document):
        for r in d.to_pylist():
            if r["marks"]:
                marks.setdefault((r["__id"], r["__row"]), []).append(r["marks"])
    got = []
    for i, k, t in zip(ids, keys, texts):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for cell in marks.get((i, k), []):
            for a, length in zip(*S.unpack(cell)):
                gone[a : a + length] = b"\1" * int(length)
        spans = sum(1 for x in range(len(raw)) if gone[x] and (x == 0 or not gone[x - 1]))
        got.append((i, len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()))
    assert sorted(got, key=repr) == brute(rows)


def test_digits_in_order():
    """Groups of one document drop out after the first digit; the others stand by both."""
    one, two = np.array([7, 5, 5, 5, 5, 9, 9], np.uint64), np.array([1, 4, 3, 4, 4, 8, 8], np.uint64)
    ids, doc = np.array([30, 10, 20], np.int64), np.array([0, 1, 2, 2, 0, 1, 1])
    got, first, cut = S._by_digits(doc, np.arange(7), one, two, ids)
    assert first.tolist() == [2, 1, 3, 4] and cut.tolist() == [0, 1, 4] and ids[got].tolist() == [20, 10, 20, 30]


COPY = "the copy of a text that stands in a great many documents, again"


def test_a_long_text_and_a_large_group_of_copies(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(400_000))
    rows = [(1, long[500_000:500_200]), (2, long), (3, long[:1_000_000] + "#" + long[1_000_000:])] + [(10 + i, COPY) for i in range(500)]
    got = {r[0]: r[1:4] for r in result(spark, rows)}
    assert got[1] == (200, 0, 0)
    assert got[2] == (len(long), 200, 1)
    assert got[3] == (len(long) + 1, len(long), 2)
    assert got[10][1] == 0 and all(got[10 + i] == (len(COPY), len(COPY), 1) for i in range(1, 500))


def test_empty_table(spark):
    assert result(spark, []) == []
