"""Quality scores: random-indexing word vectors, pooled, under a two-layer network.

1. Random indexing over all documents: every token has a sparse ternary index
   vector given by its hash; a token's word vector is the sum of the index vectors
   of its neighbours everywhere, two to each side, each permuted (rotated) by its
   place.  Word vectors are kept by hash bucket, so the table has a fixed size
   (``BUCKETS`` x ``DIM``) and is a sum over map tasks, of 4 MB each at most.
2. One pass pools the vectors of each whole text's tokens: their mean, their
   deviation, and the mean product of neighbours' vectors.  Nothing else is known
   of a text.
3. A two-layer numpy network learns from at most ``MAX_TRAIN`` labelled rows,
   taken by hash; a fifth of them is kept back to fit a temperature.
4. Features are scored by map.

Defined results.  Null and empty texts have zero features and get the network's
score for them.  Rows with a null label don't train, nor do rows without a doc_id;
without labels of both kinds all scores are the share of label 1 (0.5 if there are
none).  Repeated rows are each scored, and train once.  An empty table gives an
empty result.  Only doc_id and text are read, so other columns neither clash nor
pass through.  A text over ``PIECE`` bytes is taken in pieces, cut at white space
where there is some: whole, in bounded memory, but neighbours across a cut don't
count as such.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .common import documents, materialize, table
from .packed import mix

_U = np.uint64
BUCKETS, DIM = 1 << 14, 64
#: Neighbours to each side that make a word's vector, and how far a place rotates an index vector.
REACH, ROTATION = 2, 7
#: Labelled rows that the network learns from, at most.
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, BATCH = 32, 40, 256
THRESHOLD = 0.3
#: Bytes of text that are worked on at once, and how far a cut looks for white space.
PIECE, LOOK = 1 << 19, 1 << 16
N_FEATURES = 3 * DIM

#: Class of a byte: 0 space, 1 letter or non-ASCII, 3 digit, else a symbol by itself.
_KIND = np.array(
    [0 if c == 32 or 9 <= c <= 13 else 1 if 97 <= c <= 122 or 65 <= c <= 90 or c >= 128 else 3 if 48 <= c <= 57 else 16 + c for c in range(256)],
    dtype=np.uint8,
)
_SPACE = re.compile(rb"[ \t-\r]")


def tokens_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each token: a run of letters, of digits or of one symbol, case kept."""
    kind = _KIND[buf]
    edge = np.flatnonzero(np.append(True, kind[1:] != kind[:-1]))
    end = np.append(edge[1:], len(buf))
    # Position-weighted sums of a token's bytes.
    pos = np.arange(len(buf), dtype=np.uint64) - np.repeat(edge, end - edge).astype(_U)
    byte = mix((buf.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15) + pos * _U(0xC2B2AE3D27D4EB4F))
    total = np.concatenate([np.zeros(1, _U), np.cumsum(byte)])
    real = kind[edge] != 0
    return edge[real], mix(total[end[real]] - total[edge[real]])


def _pieces(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at + PIECE < len(raw):
        space = _SPACE.search(raw, at + PIECE, at + PIECE + LOOK)
        end = space.start() if space else at + PIECE + LOOK
        yield raw[at:end]
        at = end
    yield raw[at:]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each token, its hash, whether the next token stands in the same piece), chunk by chunk."""

    def tokens(rows: list[int], held: list[bytes]):
        start, word = tokens_of(np.frombuffer(b"\n".join([*held, b""]), dtype=np.uint8))
        piece = np.searchsorted(np.cumsum([len(x) + 1 for x in held]), start, side="right")
        return np.array(rows)[piece], word, np.append(piece[1:] == piece[:-1], False)

    rows, held, size = [], [], 0
    for i, text in enumerate(batch.column("text")):
        for raw in _pieces(text.as_buffer().to_pybytes() if text.is_valid else b""):
            rows.append(i)
            held.append(raw)
            size += len(raw)
            if size >= PIECE:
                yield tokens(rows, held)
                rows, held, size = [], [], 0
    if size:
        yield tokens(rows, held)


def _count_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(BUCKETS * DIM)
    for batch in batches:
        for _, word, near in _chunks(batch):
            at = (word % _U(BUCKETS)).astype(np.int64) * DIM
            index = []  # (dimension, sign) of the two places of each token's index vector
            for shift in (40, 20):
                x = (word >> _U(shift)) & _U(0xFFFFF)
                index.append(((x >> _U(1)).astype(np.int64), (x & _U(1)).astype(np.int64) * 2 - 1))
            cells, signs, together = [], [], near
            for far in range(1, REACH + 1):
                if len(word) <= far:
                    break
                together = near[:-far] if far == 1 else together[:-1] & near[far - 1 : len(word) - 1]
                for here, there, turn in ((slice(0, -far), slice(far, None), far), (slice(far, None), slice(0, -far), -far)):
                    for place, sign in index:
                        cells.append((at[here] + (place[there] + turn * ROTATION) % DIM)[together])
                        signs.append(sign[there][together])
            if cells:
                words += np.bincount(np.concatenate(cells), np.concatenate(signs), len(words))
    yield from tables.emit({"words": words.astype(np.int32)})


def word_vectors(df: DataFrame) -> np.ndarray:
    """Unit word vectors, by bucket, from the neighbours in all rows."""
    rows = documents(df).select("text").mapInArrow(_count_neighbours, tables.SCHEMA)
    flat = tables.collect(rows, BUCKETS * DIM).get("words", np.zeros(BUCKETS * DIM))
    m = flat.reshape(BUCKETS, DIM).astype(np.float64)
    m = np.sign(m) * np.log1p(np.abs(m))
    return (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(batch: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of the word vectors of each text, and the mean product of neighbours."""
    n = batch.num_rows
    sums, count, pairs = np.zeros((n, 3, DIM)), np.zeros(n), np.zeros(n)
    for row, word, near in _chunks(batch):
        if not len(word):
            continue
        v = vectors[(word % _U(BUCKETS)).astype(np.int64)]
        cut = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        at = row[cut]
        count[at] += np.diff(np.append(cut, len(row)))
        pairs[at] += np.add.reduceat(near.astype(np.int64), cut)
        sums[at, 0] += np.add.reduceat(v, cut, axis=0)
        sums[at, 1] += np.add.reduceat(v * v, cut, axis=0)
        v[:-1] *= v[1:]
        v[~near] = 0
        sums[at, 2] += np.add.reduceat(v, cut, axis=0)
    size = np.maximum(count, 1)[:, None]
    mean = sums[:, 0] / size
    return np.concatenate([mean, np.sqrt(np.maximum(sums[:, 1] / size - mean**2, 0)), sums[:, 2] / np.maximum(pairs, 1)[:, None]], axis=1)


def _pool(vectors):
    """Rows (doc_id, text) -> (doc_id, features: halves, as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = pooled(b, vectors.value).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.tobytes() for x in f], pa.binary())], ["doc_id", "features"])

    return run


def _matrix(cells) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.float16).reshape(-1, N_FEATURES).astype(np.float64)


class Network:
    """Standardised input, one hidden ReLU layer, a logit, and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.prior = float(y.mean()) if len(y) else 0.5
        self.fitted = len(y) >= 20 and 0 < y.sum() < len(y)
        self.temperature = 1.0
        if not self.fitted:
            return
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5 :]
        self.mean, self.scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-4
        d = x.shape[1]
        self.p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        self._train(self._norm(x[used]), y[used].astype(float), rng)
        self._calibrate(self._logit(self._norm(x[held])), y[held].astype(float))

    def _norm(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _logit(self, z: np.ndarray) -> np.ndarray:
        w, b, v, c = self.p
        return np.maximum(z @ w + b, 0) @ v + c[0]

    def _train(self, z: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        m, s = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(y))
            for a in range(0, len(y), BATCH):
                at = order[a : a + BATCH]
                w, b, v, c = self.p
                hidden = np.maximum(z[at] @ w + b, 0)
                err = (1 / (1 + np.exp(-np.clip(hidden @ v + c[0], -30, 30))) - y[at]) / len(at)
                back = np.outer(err, v) * (hidden > 0)
                grads = [z[at].T @ back + 1e-4 * w, back.sum(axis=0), hidden.T @ err + 1e-4 * v, np.array([err.sum()])]
                step += 1
                rate = 3e-3 * (1 - epoch / EPOCHS)
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    s[i] = 0.999 * s[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)

    def _calibrate(self, logit: np.ndarray, y: np.ndarray) -> None:
        """The temperature of lowest log loss on the rows kept back, by grid."""
        if len(y) < 5:
            return

        def loss(t: float) -> float:
            z = np.clip(logit / t, -30, 30)
            return float(np.mean(np.logaddexp(0, z) - y * z))

        self.temperature = min(np.exp(np.linspace(-1.5, 2.5, 81)), key=loss)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logit(self._norm(x)) / self.temperature, -30, 30)))


def train_rows(pooled_: DataFrame, labels: DataFrame, folds: int, max_train: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of distinct labelled rows outside fold 0: all, or a share by hash that makes ``max_train`` at most."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)").filter(tables.fold(folds) != 0)
    joined = materialize(known.join(pooled_, "doc_id").select("doc_id", "quality", "features").distinct(), "quality-train")
    n = joined.count()
    if n > max_train:
        # A little less than the share, so that the number of rows taken stays under the bound.
        cut = int(max(0.0, max_train - 4 * max_train**0.5) / n * 2**31)
        joined = joined.filter(F.pmod(F.xxhash64("doc_id", "quality", "features"), F.lit(2**31)) < cut).limit(max_train)
    rows = sorted((r.doc_id, r.quality, bytes(r.features)) for r in joined.collect())
    return _matrix([f for _, _, f in rows]), np.array([q for _, q, _ in rows], dtype=np.int64)


def quality_scores(df: DataFrame, labels: DataFrame, folds: int = 5, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score) for each row; rows of fold 0 never train."""
    vectors = df.sparkSession.sparkContext.broadcast(word_vectors(df))
    features = documents(df).mapInArrow(_pool(vectors), "doc_id long, features binary")
    features = materialize(features, "quality-features")
    net = Network(*train_rows(features, labels, folds, max_train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = _matrix([x.as_buffer().to_pybytes() for x in b.column("features")])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(net.score(f), pa.float64())], ["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (tables.fold(folds) == 0).alias("held_out"), "score")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from the labels outside the held-out fold.

    Nulls, empty and long texts, repeated rows, empty tables and other columns: see the module.
    """
    out = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
