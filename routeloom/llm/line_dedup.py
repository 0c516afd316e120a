"""Line deduplication over the whole corpus, in DataFrame functions only.

Lines are exploded as normalised keys, hashed, counted by distinct document,
and the lines of over-frequent keys are dropped and the rest put together by
position.

Scale.  Only (hash, doc_id) pairs are shuffled for the count, once for each
pair; the counts themselves are partial sums, so a line that stands in a third
of all documents reaches its reducer as one row for each map task.  The join
that finds the places of over-frequent hashes has exchanges on both sides that
adaptive execution splits where a hash is hot.  Texts are shuffled once, by
doc_id and text hash, into a sort-merge join that spills.  A text's lines are
split once and its dropped places are taken out of a sequence as a set, so a
document costs what its own lines cost, however many they are.

Defined results.  A null or empty text is one empty line.  Rows that share a
doc_id count as one document; null doc_ids count as one document, which never
keeps a line that another document holds.  A line that stands several times in
the document that keeps it stays each time.  Repeated rows are all returned.
An empty table gives an empty result.  Input columns named like an added one, in
any case, are replaced; all others pass through.  Keys are compared by 128 bits
of hash, and a row is told by its doc_id and 64 bits of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, others, table

#: What is stripped from both ends of a line before comparison.
STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(STRIPPED)))


def _keyed_lines(df: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row, pos, a, b) for each line whose key is long enough; a and b are 128 bits of its hash."""
    lines = df.select("doc_id", "row", F.posexplode(F.transform(F.split("text", "\n"), line_key)).alias("pos", "key"))
    return lines.filter(F.length("key") >= min_chars).select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("a"), F.xxhash64(F.lit("\x01"), F.col("key")).alias("b")
    )


def dropped_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, row, gone): for each row (doc_id, row, text) that loses lines their positions."""
    lines = _keyed_lines(df, min_chars)
    hot = (
        lines.groupBy("a", "b", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select(F.bitwise_not("a").alias("ra"), F.bitwise_not("b").alias("rb"), "keeper")
    )
    # Joined on the complements, which no partitioning in place satisfies: both sides get
    # exchanges of their own, which adaptive execution splits where a hash is hot.
    places = lines.select("doc_id", "row", "pos", F.bitwise_not("a").alias("a"), F.bitwise_not("b").alias("b"))
    found = places.join(hot.hint("merge"), (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb"))).filter(
        ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    )
    # Rows that repeat whole give each place several times.
    return found.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(df: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of ``df`` plus ``kept_text``, ``n_lines``, ``n_dropped``.

    Input columns of these names, in any case, are replaced.
    """
    names = others(df, ("kept_text", "n_lines", "n_dropped"))
    df = df.select(*[F.col(f"`{c}`") for c in names])
    text, row, lines, kept, gone = (fresh(df, f"__line_{x}") for x in ("text", "row", "all", "kept", "gone"))
    base = df.withColumn(text, F.coalesce("text", F.lit(""))).withColumn(row, F.xxhash64(text))
    keys = base.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(row).alias("row"), F.col(text).alias("text"))
    drops = dropped_lines(keys, min_chars, min_docs).select(F.col("doc_id").alias(f"{gone}_id"), F.col("row").alias(f"{gone}_row"), F.col("gone").alias(gone))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{gone}_id")) & (F.col(row) == F.col(f"{gone}_row"))
    joined = base.join(drops.hint("merge"), same, "left").withColumn(lines, F.split(text, "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    stays = F.transform(places, lambda i: F.get(F.col(lines), i))
    return joined.withColumn(kept, F.when(F.col(gone).isNull(), F.col(lines)).otherwise(stays)).select(
        *[F.col(f"`{c}`") for c in names],
        F.array_join(kept, "\n").alias("kept_text"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 code points or more found in three documents or more stay in the largest doc_id alone.

    Nulls, empty texts, ties, repeated rows, empty tables and extra columns: see the module.
    """
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.doc_id, pos, line, (hot.key IS NOT NULL AND hot.keeper <> k.doc_id) AS gone
      FROM k LEFT JOIN hot ON k.key = hot.key)
SELECT doc_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
