"""The two learned operators: against slow versions in plain Python, and on held-out rows."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from routeloom.llm import language_mixture as L
from routeloom.llm import quality_classifier as Q
from routeloom.llm.packed import unpack

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
TEXTS = ["Alpha beta, gamma;; 12 delta  beta", "", "x", "beta gamma\nAlpha ### ### beta é ü", "...", "the end 99 the end"]


def tokens(text):
    return [m.group() for m in re.finditer(rb"[A-Za-z\x80-\xff]+|[0-9]+|([^A-Za-z0-9\x80-\xff \t-\r])\1*", text)]


def hash_of(token):
    return int(Q.tokens_of(np.frombuffer(token + b"\n", dtype=np.uint8))[1][0])


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])


def table_of(batches):
    flat = np.zeros(Q.BUCKETS * Q.DIM, dtype=np.int64)
    bound = np.cumsum([0, *[len(p) for p in np.array_split(np.empty(len(flat), np.int8), Q.tables.BLOCKS)]])
    for b in batches:
        for block, cells in zip(b.column("block").to_pylist(), b.column("cells")):
            (x,) = unpack(cells.as_buffer().to_pybytes())
            flat[bound[block] : bound[block + 1]] += x
    return flat.reshape(Q.BUCKETS, Q.DIM)


def slow_table(texts):
    out = np.zeros((Q.BUCKETS, Q.DIM), dtype=np.int64)
    for text in texts:
        h = [hash_of(t) for t in tokens(text.encode())]
        for i, j in ((i, j) for i in range(len(h)) for j in range(len(h)) if 1 <= abs(i - j) <= Q.REACH):
            for shift in (40, 20):
                x = h[j] >> shift & 0xFFFFF
                out[h[i] % Q.BUCKETS, ((x >> 1) + (j - i) * Q.ROTATION) % Q.DIM] += (x & 1) * 2 - 1
    return out


def slow_features(text, vectors):
    v = [vectors[hash_of(t) % Q.BUCKETS].astype(float) for t in tokens(text.encode())]
    if not v:
        return np.zeros(Q.N_FEATURES)
    pairs = [a * b for a, b in zip(v, v[1:])] or [np.zeros(Q.DIM)]
    return np.concatenate([np.mean(v, axis=0), np.std(v, axis=0), np.mean(pairs, axis=0)])


def test_word_vectors_and_pooling_equal_loops():
    got = table_of(Q._count_neighbours(iter([batch(TEXTS)])))
    assert (got == slow_table(TEXTS)).all() and np.abs(got).sum() > 50
    vectors = np.random.default_rng(1).normal(size=(Q.BUCKETS, Q.DIM)).astype(np.float32)
    want = np.stack([slow_features(t, vectors) for t in TEXTS])
    assert np.allclose(Q.pooled(batch(TEXTS), vectors), want, atol=2e-3)


def test_long_texts_are_pooled_whole():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(4000))
    vectors = np.random.default_rng(1).normal(size=(Q.BUCKETS, Q.DIM)).astype(np.float32)
    whole, piece = Q.pooled(batch([text, "a b"]), vectors), Q.PIECE
    try:
        Q.PIECE = 700
        parts = Q.pooled(batch([text, "a b"]), vectors)
    finally:
        Q.PIECE = piece
    assert np.allclose(whole[:, : 2 * Q.DIM], parts[:, : 2 * Q.DIM], atol=2e-3)
    assert np.allclose(whole, parts, atol=0.1)


def area(score, label):
    pairs = [(a > b) + 0.5 * (a == b) for a, x in zip(score, label) if x for b, y in zip(score, label) if not y]
    return sum(pairs) / len(pairs)


@needs_data
def test_quality_on_held_out_rows(spark):
    rows = Q.op1_quality_classifier(spark, DATA).filter("held_out").join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").collect()
    assert len(rows) > 50
    assert area([r.score for r in rows], [r.quality for r in rows]) > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_training_rows_stay_under_their_bound(spark):
    n, f = 400, np.zeros(Q.N_FEATURES, np.float16)
    pooled = spark.createDataFrame([(i % 300, bytes((f + i).tobytes())) for i in range(n)], "doc_id long, features binary")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    every, _ = Q.train_rows(pooled, labels, 5, 10_000)
    some, y = Q.train_rows(pooled, labels, 5, 100)
    assert 250 < len(every) <= n and 20 < len(some) == len(y) <= 100


def slow_grams(text):
    folded = b"  " + b" ".join(bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode()).split()) + b"  "
    return [((int.from_bytes(folded[i : i + 4], "little") * 0x9E3779B1) & 0xFFFFFFFF) >> 16 for i in range(len(folded) - 3)]


def slow_mixture(text, counts):
    names = sorted(counts)
    total = {k: sum(counts[k].values()) + L.SMOOTH * L.CELLS for k in names}
    p = lambda k, g: (counts[k][g] + L.SMOOTH) / total[k]
    c = Counter(slow_grams(text))
    n = sum(c.values())

    def em(chosen):
        pi = {k: 1 / len(chosen) for k in chosen}
        for _ in range(L.ROUNDS):
            new = dict.fromkeys(chosen, 0.0)
            for g, m in c.items():
                whole = sum(pi[k] * p(k, g) for k in chosen)
                for k in chosen:
                    new[k] += m * pi[k] * p(k, g) / whole / n
            pi = new
        return pi

    first = em(names)
    order = sorted(names, key=lambda k: (-first[k], k))
    best, found = -math.inf, {}
    for size in range(1, len(order) + 1):
        pi = em(order[:size]) if size > 1 else {order[0]: 1.0}
        fit = sum(m * math.log(sum(pi[k] * p(k, g) for k in pi)) for g, m in c.items()) / 4 - L.PENALTY * (size - 1) * 0.5 * math.log(n)
        if fit <= best:
            break
        best, found = fit, pi
    return sorted(found.items(), key=lambda x: -x[1])


def test_mixtures_equal_loops(spark):
    rng = random.Random(4)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "aeioustr"}
    word = lambda k: "".join(rng.choice(letters[k]) for _ in range(rng.randrange(2, 7)))
    vocabulary = {k: [word(k) for _ in range(60)] for k in letters}
    say = lambda k, n: " ".join(rng.choice(vocabulary[k]) for _ in range(n))
    train = [(i, say(k, 80), k) for i, k in enumerate([*letters] * 6)]
    counts = L.language_counts(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    slow = {k: Counter(g for _, t, x in train if x == k for g in slow_grams(t)) for k in letters}
    assert {k: int(v.sum()) for k, v in counts.items()} == {k: sum(v.values()) for k, v in slow.items()}
    texts = [say("aa", 40), say("bb", 3), say("aa", 60) + " " + say("bb", 40), say("cc", 30) + " " + say("aa", 5), "zzz Q", "x"]
    model = L.Mixture(counts)
    for t in texts:
        got, want = model.infer(t.encode())[0], slow_mixture(t, slow)
        assert [k for k, _ in got] == [k for k, _ in want]
        assert np.allclose([v for _, v in got], [v for _, v in want], atol=1e-6)


@pytest.mark.parametrize("block", [2, 5])
def test_languages_in_blocks(spark, block):
    """More languages than one broadcast holds: the block that knows a text's language gives it the same answer."""
    rng = random.Random(11)
    letters = {f"l{i:02d}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñç", 7)) for i in range(11)}
    vocabulary = {k: ["".join(rng.choice(v) for _ in range(rng.randrange(3, 8))) for _ in range(50)] for k, v in letters.items()}
    say = lambda k, n: " ".join(rng.choice(vocabulary[k]) for _ in range(n))
    train = spark.createDataFrame([(i, say(k, 80), k) for i, k in enumerate([*letters] * 4)], "doc_id long, text string, lang string")
    rows = [(i, say(k, 60)) for i, k in enumerate(letters)] + [(50, say("l01", 60) + " " + say("l09", 50)), (51, None), (52, ""), (53, "123"), (54, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r for r in L.mixture_languages(df, train).collect()}
    got = {r.doc_id: r for r in L.mixture_languages(df, train, block).collect()}
    assert {i: r.lang_pred for i, r in got.items()} == {i: r.lang_pred for i, r in whole.items()} and [got[i].lang_pred for i in (51, 52, 53)] == ["und"] * 3
    assert {r.lang for r in got[50].languages} == {"l01", "l09"} and all(abs(got[i].score - whole[i].score) < 0.02 for i in got if i != 54)
    assert [got[i].lang_pred for i in range(11)] == [*letters]


@needs_data
def test_languages_of_held_out_rows(spark):
    rows = L.op5_language_mixture(spark, DATA).filter("held_out").join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").filter(F.length("text") > 0).collect()
    assert len(rows) > 100 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
