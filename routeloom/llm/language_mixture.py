"""Language identification as multilingual mixture inference.

Counts of hashed byte 4-grams by language come from all training documents, as
fixed-size tables summed over map tasks.  For each document expectation-
maximisation estimates the proportions of the languages from its n-gram
likelihoods; languages enter the document's set in order of proportion while the
penalised likelihood rises.  The prediction is the language of largest
proportion in the set, its score that proportion.

Scale.  Two passes over the texts and no shuffle of them; what is shuffled is a
table for each language and task, what is broadcast the sum of them: 512 KB for
each language, ``BLOCK`` languages at once.  Where there are more, they are learned
and met block by block, in order of name: each block's pass keeps, beside the text, the
set that a document would get from that block with its n-grams' probabilities, and the
last one chooses among all of these.  A language that no document prefers within its
own block is none that it could be given among all.

Defined results.  ``und`` with score 0 for null texts and texts without a letter,
and for every text if nothing could be learned.  Ties go to the language that
sorts first.  Repeated rows are each learned from and each predicted; an empty table
gives an empty result.  Of the input only doc_id, text and lang are read, so other
columns neither clash nor pass through.  A text of any length is at most ``CELLS``
distinct n-grams.  There is no limit on languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables
from .bpe import slices
from .common import materialize, table

CELLS = 1 << 16
#: Languages of one broadcast, and tables that a map task holds before it passes them on.
BLOCK = 256
ROUNDS, SMOOTH = 12, 0.5
#: Each added language must gain this many times half the log of the number of n-grams, over
#: overlapping n-grams that carry about a quarter of their likelihood each.
PENALTY = 4.0
#: Letters lower-cased (A-Z), everything else that is ASCII one space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def grams(*texts: bytes) -> np.ndarray:
    """Hashed 4-grams of the words of each text, two spaces at its ends."""
    folded = [b"  " + b" ".join(t.translate(_FOLD).split()) + b"  " for t in texts]
    whole = b"".join(folded)
    x = np.ndarray((len(whole) - 3,), dtype="<u4", buffer=whole, strides=(1,))
    inside = np.ones(len(x), dtype=bool)
    ends = np.cumsum([len(f) for f in folded])[:-1]
    for back in (1, 2, 3):  # none reaches from one text into the next
        inside[ends - back] = False
    return ((x[inside] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for whole in batches:
        for b in slices(whole, "text", 1 << 20):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                by.setdefault(lang, []).append(text.as_buffer().to_pybytes())
            for lang, raw in by.items():
                got = np.bincount(grams(*raw), minlength=CELLS)
                counts[lang] = counts[lang] + got if lang in counts else got
                if len(counts) > BLOCK:
                    yield from tables.emit({k: v.astype(np.int64) for k, v in counts.items()})
                    counts = {}
    yield from tables.emit({k: v.astype(np.int64) for k, v in counts.items()})


def known(df: DataFrame) -> DataFrame:
    return df.select("text", "lang").filter("text is not null and lang is not null")


def language_counts(df: DataFrame) -> dict[str, np.ndarray]:
    """4-gram counts by language over all rows (text, lang) that have both."""
    return tables.collect(known(df).mapInArrow(_count, tables.SCHEMA), CELLS)


class Mixture:
    def __init__(self, counts: dict[str, np.ndarray]):
        self.names = sorted(counts)
        c = np.stack([counts[k] for k in self.names]).astype(np.float64) if counts else np.zeros((0, CELLS))
        p = (c + SMOOTH) / (c.sum(axis=1, keepdims=True) + SMOOTH * CELLS)
        self.p = np.ascontiguousarray(p.T)

    def infer(self, raw: bytes) -> tuple[list[tuple[str, float]], float]:
        """[(language, proportion)] of the selected set, largest first, and its log-likelihood."""
        p, c = self.likelihoods(raw)
        at, pi, best = self.choose(p, c)
        return [(self.names[i], float(v)) for i, v in zip(at, pi)], best

    def likelihoods(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each distinct n-gram of a text in each language, and how often it stands there."""
        g = np.sort(grams(raw), kind="stable")
        cut = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
        return self.p[g[cut[:-1]]], np.diff(cut).astype(np.float64)

    def choose(self, p: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Columns of the selected set, largest proportion first, their proportions, and the set's log-likelihood."""
        n = float(c.sum())
        pi = self._em(p, c, n)
        order = np.lexsort((np.arange(len(pi)), -pi))
        best, best_set, best_pi = -np.inf, order[:1], np.ones(1)
        for k in range(1, len(order) + 1):
            chosen = order[:k]
            q = self._em(p[:, chosen], c, n) if k > 1 else np.ones(1)
            fit = float(c @ np.log(p[:, chosen] @ q)) / 4 - PENALTY * (k - 1) * 0.5 * np.log(n)
            if fit <= best:
                break
            best, best_set, best_pi = fit, chosen, q
        at = np.lexsort((best_set, -best_pi))
        return best_set[at], best_pi[at], best

    def _em(self, p: np.ndarray, c: np.ndarray, n: float) -> np.ndarray:
        pi = np.full(p.shape[1], 1.0 / p.shape[1])
        for _ in range(ROUNDS):
            joint = p * pi
            pi = (c / joint.sum(axis=1)) @ joint / n
        return pi


_FOUND = "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def _found(ids: pa.Array, sets: list[list[tuple[str, float]]]) -> pa.RecordBatch:
    lang = [s[0][0] if s else "und" for s in sets]
    score = [min(1.0, max(0.0, s[0][1])) if s else 0.0 for s in sets]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    shares = pa.array([[{"lang": k, "share": v} for k, v in s] for s in sets], kind)
    return pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score, pa.float64()), shares], ["doc_id", "lang_pred", "score", "languages"])


def _judged(text: str | None) -> bool:
    return bool(text) and has_letter(text)


def predict_languages(df: DataFrame, counts: dict[str, np.ndarray]) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``languages`` (the selected set with proportions) for each row."""
    model = df.sparkSession.sparkContext.broadcast(Mixture(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            texts = b.column("text").to_pylist()
            yield _found(b.column("doc_id"), [m.infer(t.encode())[0] if m.names and _judged(t) else [] for t in texts])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


_HELD = pa.list_(pa.struct([("lang", pa.string()), ("p", pa.binary())]))


def _keep_best(counts: dict[str, np.ndarray], df: DataFrame) -> DataFrame:
    """``df`` (doc_id, text, held) with the set that one block's languages give added to ``held``."""
    model = df.sparkSession.sparkContext.broadcast(Mixture(counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                held = b.column("held").to_pylist()
                for mine, text in zip(held, b.column("text").to_pylist()):
                    if m.names and _judged(text):
                        p, c = m.likelihoods(text.encode())
                        mine += [{"lang": m.names[i], "p": p[:, i].tobytes()} for i in m.choose(p, c)[0]]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(held, _HELD)], ["doc_id", "text", "held"])

    return df.mapInArrow(run, "doc_id long, text string, held array<struct<lang:string,p:binary>>")


def _choose_among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    m = Mixture({})
    for b in batches:
        sets = []
        for text, held in zip(b.column("text").to_pylist(), b.column("held").to_pylist()):
            held = sorted(held, key=lambda h: h["lang"])
            if not held:
                sets.append([])
                continue
            p = np.stack([np.frombuffer(h["p"]) for h in held], axis=1)
            at, pi, _ = m.choose(p, np.unique(grams(text.encode()), return_counts=True)[1].astype(np.float64))
            sets.append([(held[i]["lang"], float(v)) for i, v in zip(at, pi)])
        yield _found(b.column("doc_id"), sets)


def mixture_languages(df: DataFrame, train: DataFrame, block: int = BLOCK) -> DataFrame:
    """``predict_languages`` of ``df`` with what the rows (text, lang) of ``train`` teach, however many languages they have."""
    names = sorted(r.lang for r in known(train).select("lang").distinct().toLocalIterator())
    if len(names) <= block:
        return predict_languages(df, language_counts(train))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.array().cast("array<struct<lang:string,p:binary>>").alias("held"))
    for a in range(0, len(names), block):
        counts = language_counts(train.filter(F.col("lang").isin(names[a : a + block])))
        rows = materialize(_keep_best(counts, rows), "language-block")
    return rows.mapInArrow(_choose_among, _FOUND)


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those outside the held-out fold.

    Nulls, texts without letters, ties, repeated rows, empty tables and other columns: see the module.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = mixture_languages(docs, docs.filter(tables.fold(4) != 2))
    return out.select("doc_id", (tables.fold(4) == 2).alias("held_out"), "lang_pred", "score")
