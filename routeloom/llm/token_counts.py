"""Token counts through a digest cache.

The cache is a Parquet table (content digest, tokenizer digest, n_tokens).  Texts
are normalised, digested and joined to the stored counts; each distinct text
that is missing is encoded once and its count appended; then every document
takes its count from the cache.

Normalisation must not change the count.  For a tokenizer file whose normaliser
folds white space (``fold_space``) runs of ASCII white space become one space and
the ends are stripped; otherwise the text is taken as it is.

Scale.  Digests are shuffled, not texts, for the lookup and for choosing one
representative of each missing digest (a partial minimum, so thousands of copies
are a row for each map task).  Two texts of equal 64-bit row hash under one doc_id
are taken for one row.  Texts cross the network once, by doc_id and row hash, into
a sort-merge join, which spills, that keeps the representatives.  Copies of one text
meet again only in the last join, on digests, which adaptive execution splits.

Defined results.  Null counts as empty: no tokens.  Repeated rows and null ids
keep their rows.  ``over_limit`` is n_tokens > limit.  An empty table gives an
empty result and an empty cache.  Only doc_id and text are read, so other columns,
whatever they are called, neither clash nor pass through.  A text of any length is
one call of the library, which holds it whole.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import slices
from .common import documents, materialize, table, work_path

LIMIT = 2048
CACHE_SCHEMA = "content string, tokenizer string, n_tokens long"


@lru_cache(maxsize=4)
def tokenizer_digest(path: str) -> str:
    """Of the file's bytes and the library's version: either change misses the cache."""
    import sentencepiece
    import tokenizers

    version = tokenizers.__version__ if path.endswith(".json") else sentencepiece.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(version.encode() + b"\0" + f.read()).hexdigest()


def folds_space(path: str) -> bool:
    """Whether the file's normaliser replaces every run of white space by a space and its splitter drops it."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    replaced = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return replaced and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))


def content_digest(text: Column, fold_space: bool) -> Column:
    if fold_space:
        text = F.btrim(F.regexp_replace(text, r"[\t-\r ]+", " "))
    return F.sha2(text, 256)


@lru_cache(maxsize=2)
def _counter(path: str):
    if path.endswith(".json"):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        fast = getattr(t, "encode_batch_fast", t.encode_batch)
        return lambda texts: [len(e) for e in fast(texts, add_special_tokens=False)]
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]


def encode_counts(df: DataFrame, path: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 19):
                n = count(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return df.select("content", "text").mapInArrow(run, "content string, n_tokens long")


def cached_counts(df: DataFrame, path: str, cache_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit); the cache at ``cache_path`` grows by the misses."""
    spark = df.sparkSession
    version, fold = tokenizer_digest(path), folds_space(path)
    try:
        # Nothing is read before the new counts have been written.
        cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
        cache.isEmpty()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    known = cache.filter(F.col("tokenizer") == version).select("content", "n_tokens")

    row = F.xxhash64("text")
    docs = documents(df)
    # Digests are made once, and stand for the texts until the misses are encoded.
    keyed = docs.select("doc_id", row.alias("row"), F.octet_length("text").cast("long").alias("n_bytes"), content_digest(F.col("text"), fold).alias("content"))
    keyed = materialize(keyed, "token-digests")
    chosen = (
        keyed.groupBy("content")
        .agg(F.min(F.struct("doc_id", "row")).alias("first"))
        .join(known.select("content"), "content", "left_anti")
        .select("content", F.col("first.doc_id").alias("__id"), F.col("first.row").alias("__row"))
    )
    texts = docs.withColumn("row", row)
    same = texts["doc_id"].eqNullSafe(chosen["__id"]) & (texts["row"] == chosen["__row"])
    missing = texts.join(chosen.hint("merge"), same).select("content", "text")
    # Rows that repeat whole are each a representative; their count is appended once.
    fresh = encode_counts(missing, path).dropDuplicates(["content"]).select("content", F.lit(version).alias("tokenizer"), "n_tokens")
    fresh.write.mode("append").parquet(cache_path)

    # A count may stand twice where two runs appended at once.
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache_path)
        .filter(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.first("n_tokens").alias("n_tokens"))
        .select(F.reverse("content").alias("__key"), "n_tokens")
    )
    out = keyed.withColumn("__c", F.reverse("content")).join(counts.hint("merge"), F.col("__c") == F.col("__key"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under word_bpe_49k.json, through a cache that is empty at first.

    Nulls, repeated rows, empty tables, long texts and other columns: see the module.
    """
    import public_tokenizers as P

    cache = work_path(spark, "token-cache")
    return cached_counts(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"), cache)
