"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are normalised to words (A-Z lower-cased; a word is a run of letters,
digits and non-ASCII characters), cut into windows of 13 words, and every window
becomes one pattern of an automaton over word numbers.  Each document is
normalised the same way and scanned once; a match ends at a word index, which
maps to byte offsets of the original text.

Scale.  The scan is a map over documents: no shuffle.  The automaton is sent to
executors, so it holds at most ``MAX_ITEM_BYTES`` of item text.  A larger
benchmark stays a distributed table, dealt by hash into blocks whose sizes are
counted before any is fetched; each block is one scan whose hits alone are written,
its broadcast is released, and the hits of all blocks meet by document.  Word
ranges are merged before they are mapped to bytes, so all columns are the same
whatever the number of blocks.

Defined results.  Null or empty texts have no words and no hits.  Items without
words match nothing.  Items with equal windows all count, and repeated item rows
count once.  A null item_id stands as the empty string.  Repeated document rows
are judged separately, and rows of one doc_id by their own texts.  An empty
benchmark or an empty table of documents gives no hits or no rows.  Input columns
named like an added one, in any case, are replaced; all others pass through.  A
text is scanned whole in one call, in memory of about 100 bytes for a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import slices
from .common import fresh, materialize, others, table

WINDOW = 13
#: Text bytes of test items in one automaton (about 60 bytes of memory for each).
MAX_ITEM_BYTES = 1 << 20

_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
# The contract's word characters are code points outside \x00-\x2F, \x3A-\x60 and
# \x7B-\x7F; in UTF-8 that is these ASCII bytes and every byte from 0x80.


def normal_words(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


def word_spans(text: str) -> np.ndarray:
    """(start, end) byte offsets of each word in the original text."""
    raw = np.frombuffer(b" " + text.encode().translate(_WORD_BYTES) + b" ", dtype=np.uint8) != 0x20
    edge = np.flatnonzero(raw[1:] != raw[:-1])
    return edge.reshape(-1, 2)


class Scanner:
    """Automaton over word numbers for a list of (item id, text)."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        import ahocorasick

        self.vocabulary: dict[bytes, int] = {}
        patterns: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in normal_words(text or ""))
            if not words:
                continue
            for i in range(max(1, len(words) - window + 1)):
                patterns.setdefault(words[i : i + window], set()).add(item)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, owners in patterns.items():
            self.machine.add_word(key, (len(key), tuple(sorted(owners))))
        if patterns:
            self.machine.make_automaton()
        self.empty = not patterns

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, maximal hit ranges [start, end) in words, items found."""
        words = normal_words(text)
        if self.empty or not words:
            return len(words), [], set()
        get = self.vocabulary.get
        ranges: list[tuple[int, int]] = []
        found: set[str] = set()
        for end, (size, owners) in self.machine.iter(tuple([get(w, 0) for w in words])):
            found.update(owners)
            ranges.append((end + 1 - size, end + 1))
        return len(words), merge_ranges(ranges), found


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


@lru_cache(maxsize=2)
def _scanner(items: tuple[tuple[str, str], ...], window: int) -> Scanner:
    return Scanner(list(items), window)


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
#: What a scan gives: the number of words, hit ranges in words and in bytes of the original text, items found.
_COLUMNS = {"n_words": pa.int64(), "word_ranges": _RANGES, "byte_spans": _RANGES, "items": pa.list_(pa.string())}
_DDL = {"n_words": "long", "word_ranges": "array<struct<a:int,b:int>>", "byte_spans": "array<struct<a:int,b:int>>", "items": "array<string>"}
ADDED = (*_COLUMNS, "n_hit", "contaminated")


def _with(fields: list[T.StructField], names: Iterable[str]) -> T.StructType:
    return T.StructType([*fields, *T.StructType.fromDDL(", ".join(f"{n} {_DDL[n]}" for n in names)).fields])


def _pairs(ranges: Iterable[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"a": int(a), "b": int(b)} for a, b in ranges]


def _in_bytes(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    if not ranges:
        return []
    at = word_spans(text)
    return _pairs((at[a, 0], at[b - 1, 1]) for a, b in ranges)


def _scan(df: DataFrame, shared: Broadcast, window: int) -> DataFrame:
    """``df`` with the columns of a scan by the automaton of the shared items."""
    schema = _with(df.schema.fields, _COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(shared.value, window)
        for whole in batches:
            for batch in slices(whole, "text"):
                n, words, spans, items = [], [], [], []
                for text in batch.column("text").to_pylist():
                    count, ranges, found = scanner.scan(text or "")
                    n.append(count)
                    words.append(_pairs(ranges))
                    spans.append(_in_bytes(text, ranges))
                    items.append(sorted(found))
                new = [pa.array(v, t) for v, t in zip((n, words, spans, items), _COLUMNS.values())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return df.mapInArrow(run, schema)


def _join_blocks(df: DataFrame, ranges: str, items: str) -> DataFrame:
    """The word ranges and items of several scans (``ranges`` and ``items``: lists of them) as those of one."""
    kept = [f for f in df.schema.fields if f.name not in (ranges, items)]
    names = ("word_ranges", "byte_spans", "items")
    schema = _with(kept, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                words = [merge_ranges([(r["a"], r["b"]) for part in x or () for r in part]) for x in b.column(ranges).to_pylist()]
                spans = [_in_bytes(t, r) for t, r in zip(b.column("text").to_pylist(), words)]
                found = [sorted({i for part in x or () for i in part}) for x in b.column(items).to_pylist()]
                new = [pa.array(v, _COLUMNS[n]) for n, v in zip(names, ([_pairs(r) for r in words], spans, found))]
                yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], *new], names=schema.names)

    return df.mapInArrow(run, schema)


def item_blocks(benchmark: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """Distinct items with their ``block``, and the number of blocks.

    Blocks hold at most ``max_bytes`` of text each, or one item: their number doubles
    until the largest, as counted, does.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    items = benchmark.select(item, F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = F.octet_length("text") + 1
    n = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // max_bytes))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        over = dealt.groupBy("block").agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("k")).filter((F.col("size") > max_bytes) & (F.col("k") > 1))
        if not over.head(1):
            return dealt, n
        n *= 2


def _block(dealt: DataFrame, i: int) -> tuple[tuple[str, str], ...]:
    """The items of one block, of a size that has been counted."""
    return tuple(sorted((r.item_id, r.text) for r in dealt.filter(F.col("block") == i).collect()))


def decontaminate(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """``df`` with n_words, word_ranges, byte_spans (in the original UTF-8 text), items, n_hit and contaminated.

    A document is contaminated when it has a hit word and at least a twentieth of
    its words are hit.  Input columns of these names, in any case, are replaced.
    """
    context = df.sparkSession.sparkContext
    df = df.select(*[F.col(f"`{c}`") for c in others(df, ADDED)])
    dealt, n = item_blocks(benchmark, max_item_bytes)
    if n == 1:
        out = _scan(df, context.broadcast(_block(dealt, 0)), window)
    else:
        dealt = materialize(dealt, "bench-items")
        row = F.xxhash64(F.coalesce("text", F.lit("")))
        base = df.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), "text")
        hits = []
        for i in range(n):
            shared = context.broadcast(_block(dealt, i))
            hits.append(materialize(_scan(base, shared, window).filter(F.size("items") > 0).select("doc_id", "row", "word_ranges", "items"), "bench-hits"))
            shared.destroy()
        # Rows that repeat whole have equal hits: one of each is kept.
        key, ranges, items = (fresh(df, f"__bench_{x}") for x in ("row", "ranges", "items"))
        by_row = reduce(DataFrame.unionByName, hits).distinct().groupBy(F.col("doc_id").alias(f"{key}_id"), F.col("row").alias(key))
        by_row = by_row.agg(F.collect_list("word_ranges").alias(ranges), F.collect_list("items").alias(items))
        plain = df.columns
        counted = _scan(df, context.broadcast(()), window).select(*plain, "n_words")
        same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{key}_id")) & (row == F.col(key))
        out = _join_blocks(counted.join(by_row.hint("merge"), same, "left").select(*plain, "n_words", ranges, items), ranges, items)
    hit = F.aggregate("word_ranges", F.lit(0).cast("long"), lambda acc, r: acc + (r["b"] - r["a"]))
    out = out.withColumn("n_hit", hit)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(items: F.Column) -> F.Column:
    return F.sha2(F.array_join(items, ","), 256)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents hit by windows of 13 words of all benchmark items.

    Nulls, empty texts, equal items, repeated rows, empty tables and extra columns: see the module.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        digest(F.col("items")).alias("items_sha256"),
        "contaminated",
    )


OP9_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13 + 1, 1) + 1)) AS i FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS g FROM bs),
sizes AS (SELECT DISTINCT n FROM bg),
ds AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM ds),
m AS (SELECT DISTINCT doc_id, item_id, n, i FROM dg JOIN bg USING (n, g)),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS pos FROM m),
h AS (SELECT doc_id, count(*) AS n_hit FROM p GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN h ON dw.doc_id = h.doc_id LEFT JOIN it ON dw.doc_id = it.doc_id
"""
