"""The corpus pipeline: five stages over ``documents``, each one operator of ``routeloom.llm``.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet to the
shared folder and read back as the next stage's docs.  All but the last return
the columns of ``documents``, extra ones included.  Near duplicates are judged on
five-word shingles at a similarity of 0.8.

Null text, empty text and empty tables: see the operators.  Of rows of one doc_id
and text near_duplicates keeps one, whatever their other columns: which one is not
defined.  Texts of one doc_id that don't link all stay; of those that do, and of all
texts of a group under its smallest doc_id, the one of smallest hash stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from routeloom.llm.bpe import encode_documents
from routeloom.llm.common import materialize, table
from routeloom.llm.decontaminate import decontaminate
from routeloom.llm.jaccard_join import jaccard_roots
from routeloom.llm.line_dedup import dedup_lines
from routeloom.llm.quality_rules import keep_documents
from routeloom.workspace import drop, temporary

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _through(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` over docs whose other columns have names that can't clash, then the old names."""
    hidden = {c: c if c in ("doc_id", "text") else f"__doc{i}" for i, c in enumerate(docs.columns)}
    out = operator(docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()]))
    return out.select(*[F.col(h).alias(c) for c, h in hidden.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return keep_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand elsewhere; n_chars follows the text."""
    out = _through(docs, lambda d: dedup_lines(d).drop("text").withColumnRenamed("kept_text", "text"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates, then of smallest text hash.

    Groups are those of the texts: texts that don't link all stay, under a null or a
    repeated id too, and so do all texts without shingles.
    """
    found = jaccard_roots(docs, words=5, percent=80)
    lowest = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    alone = F.when(F.col("root").isNull(), F.col("row"))
    first = lowest.groupBy("root", F.col("component_id").alias("__id"), alone.alias("__alone")).agg(F.min("row").alias("__row")).select("__id", "__row")

    def keep(d: DataFrame) -> DataFrame:
        keyed = d.withColumn("__text_row", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn("__no_text", F.col("text").isNull())
        same = keyed["doc_id"].eqNullSafe(first["__id"]) & (keyed["__text_row"] == first["__row"])
        return keyed.join(first.hint("merge"), same, "left_semi").dropDuplicates(["doc_id", "__text_row", "__no_text"])

    return _through(docs, keep)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    return _through(docs, lambda d: decontaminate(d, table(spark, sf_dir, "benchmark")).filter("not contaminated"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return encode_documents(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

#: SQL can't express byte-pair merging; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another; what a stage wrote on the way, and its input, goes when it is done."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with temporary(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
            own = made.pop()
        if last:
            drop(spark, last)
        last = own
    return docs
