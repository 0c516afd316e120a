"""Source divergence audit: how far the sources of a language differ in the terms they use.

DuckDB does the counting inside tasks, Spark the dealing and merging.  Each map task
counts the terms of its texts in SQL, buffer by buffer, and joins its buffers' counts
before they are shuffled.  Shards are hashed by language and term, so all counts of a
term in a language meet in one, and a language or source that holds a third of the
rows is spread over all.  A shard's SQL adds the counts up and keeps terms of enough
documents.  Spark sums each group's total.  Then each shard's SQL, over kept terms
with their totals, gives partial sums for each pair of sources and the ten terms that
stand out most in each source, which Spark adds up and ranks.

Pair sums are over all kept terms, and most terms are missing from most sources.
With z(s) for the value p of a term that is missing from source s, a pair's sum is

    sum over terms in both     f(pa, pb) - f(pa, zb) - f(za, pb) + f(za, zb)
  + sum over terms in a        f(pa, zb), by the number of terms of each pa
  + sum over terms in b        f(za, pb)
  + (terms - terms in a - terms in b) f(za, zb)

so a shard works on sources that have a term and never on all sources of a language
for each term.  All values are whole numbers; sums don't depend on order or shards.

Scale.  Two shuffles of counts, none of texts.  A buffer holds ``TEXT_BYTES`` of text
(a longer text stands alone); counts held by a task are added up whenever
``HELD_ROWS`` have gathered, so memory is bounded by the distinct terms of a shard.
The second pass has a shard for each ``SHARD_ROWS`` kept counts, which are counted
first, and every shard gets a row for each group (language and source).  A shard's
result has a row for each pair of sources, as the audit's own result has.

Defined results.  Null text, lang and source are empty; an empty lang or source is a
value like others.  Each row is a document, so repeated rows count each.  Groups
without terms, or in languages without kept terms, stand in all pairs.  Equal values
are ranked by item.  An empty table gives an empty result.  Columns other than text,
lang and source are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import LOWER, UPPER, materialize, table

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Text of one call of DuckDB, counts that a task holds before it adds them up, and kept counts of a shard.
TEXT_BYTES, HELD_ROWS, SHARD_ROWS = 8 << 20, 1 << 20, 250_000
#: DuckDB's memory in a task; nothing is spilled to the executor's own disk.
MEMORY = "400MB"

COUNTS = "lang string, source string, term string, n long, docs long"
KEPT = "lang string, source string, term string, n long, first long"
FOUND = "lang string, source string, part string, item string, value long"

#: The empty term, which no text has, stands for each group that occurs.
_COUNT_TEXTS = f"""
WITH t AS (SELECT row, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM docs),
d AS (SELECT row, term, count(*) AS n FROM t GROUP BY row, term)
SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, count(*) AS docs FROM d JOIN docs USING (row) GROUP BY lang, source, term
UNION ALL SELECT DISTINCT lang, source, '', CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM docs"""

_ADD = "SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, CAST(sum(docs) AS BIGINT) AS docs FROM held GROUP BY lang, source, term"

_KEEP = """
WITH k AS (SELECT lang, term, min(source) AS one FROM held GROUP BY lang, term HAVING sum(docs) >= $least OR term = '')
SELECT lang, source, term, n, CAST(CASE WHEN source = one AND term <> '' THEN 1 ELSE 0 END AS BIGINT) AS first FROM held JOIN k USING (lang, term)"""

#: Rows with a term are counts, rows without one groups.
_SHARD = """
WITH r AS (SELECT * FROM shard WHERE term IS NOT NULL),
g AS (SELECT lang, source, z FROM shard WHERE term IS NULL),
t AS (SELECT lang, term, 1 + CAST((CAST($scale AS HUGEINT) * (sum(n) + 2)) // any_value(lang_total) AS BIGINT) AS q FROM r GROUP BY lang, term),
s AS (SELECT lang, count(*) AS terms FROM t GROUP BY lang),
h AS (SELECT lang, source, p, count(*) AS k FROM r GROUP BY lang, source, p),
own AS (SELECT lang, source, sum(k) AS terms FROM h GROUP BY lang, source),
one AS (SELECT h.lang, h.source AS a, g.source AS b, sum(k * f(p, z)) AS v FROM h JOIN g ON h.lang = g.lang AND h.source <> g.source GROUP BY 1, 2, 3),
two AS (SELECT x.lang, x.source AS a, y.source AS b, sum(f(x.p, y.p) - f(x.p, y.z) - f(x.z, y.p) + f(x.z, y.z)) AS v
        FROM r x JOIN r y ON x.lang = y.lang AND x.term = y.term AND x.source < y.source GROUP BY 1, 2, 3),
none AS (SELECT x.lang, x.source AS a, y.source AS b, f(x.z, y.z) * (s.terms - coalesce(m.terms, 0) - coalesce(o.terms, 0)) AS v
         FROM g x JOIN g y ON x.lang = y.lang AND x.source < y.source JOIN s ON s.lang = x.lang
         LEFT JOIN own m ON m.lang = x.lang AND m.source = x.source LEFT JOIN own o ON o.lang = y.lang AND o.source = y.source),
every AS (SELECT * FROM none UNION ALL SELECT * FROM two UNION ALL SELECT lang, least(a, b), greatest(a, b), v FROM one)
SELECT lang, a AS source, 'pair' AS part, b AS item, CAST(sum(v) AS BIGINT) AS value FROM every GROUP BY lang, a, b
UNION ALL
SELECT lang, source, 'term', term, value FROM (
  SELECT lang, source, term, f(p, q) AS value, row_number() OVER (PARTITION BY lang, source ORDER BY f(p, q) DESC, term) AS place FROM r JOIN t USING (lang, term) WHERE p > q)
WHERE place <= $top"""


def connect():
    """A DuckDB of one thread that lives in its task's memory."""
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
    con.execute("CREATE MACRO f(p, q) AS ((p - q) * (p - q)) // (p + q)")
    return con


def _run(con, sql: str, name: str, rows: pa.Table, **values: int) -> pa.Table:
    con.register(name, rows)
    out = con.sql(sql, params=values or None).to_arrow_table()
    con.unregister(name)
    return out


def _emit(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    yield from rows.to_batches(max_chunksize=1 << 16)


class Held:
    """Counts of a task, added up whenever many have gathered."""

    def __init__(self, con):
        self.con, self.parts, self.rows, self.least = con, [], 0, 0

    def add(self, part: pa.Table) -> bool:
        """Whether counts were added up just now."""
        self.parts.append(part)
        self.rows += part.num_rows
        if self.rows < HELD_ROWS + 2 * self.least:
            return False
        self.sum()
        return True

    def sum(self) -> pa.Table | None:
        if not self.parts:
            return None
        self.parts = [_run(self.con, _ADD, "held", pa.concat_tables(self.parts))]
        self.rows = self.least = self.parts[0].num_rows
        return self.parts[0]


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    con = connect()
    held = Held(con)
    for whole in batches:
        for b in slices(whole, "text", TEXT_BYTES):
            docs = pa.Table.from_batches([b]).append_column("row", pa.array(np.arange(b.num_rows)))
            if held.add(_run(con, _COUNT_TEXTS, "docs", docs)) and held.least > HELD_ROWS // 2:
                yield from _emit(held.parts.pop())
                held = Held(con)
    last = held.sum()
    if last is not None:
        yield from _emit(last)


def _keep(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connect()
        held = Held(con)
        for b in batches:
            held.add(pa.Table.from_batches([b]))
        whole = held.sum()
        if whole is not None:
            yield from _emit(_run(con, _KEEP, "held", whole, least=least))

    return run


def _shard(top: int, scale: int):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _emit(_run(connect(), _SHARD, "shard", pa.Table.from_batches(list(batches)), top=top, scale=scale))

    return run


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, first): occurrences of each kept term, and a row of the empty term for each group.

    ``first`` is 1 in one row of each term of a language.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*text).mapInArrow(_count_texts, COUNTS).repartition("lang", "term").mapInArrow(_keep(min_docs), KEPT)


def _share(n: str, scale: int) -> Column:
    """1 + floor(scale * (n + 2) / total) in whole numbers; null without kept terms."""
    return F.expr(f"CASE WHEN total > 0 THEN 1 + CAST({scale} AS DECIMAL(19,0)) * CAST({n} + 2 AS DECIMAL(18,0)) div total END")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, scale: int = SCALE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language by its distance.  Part ``term``:
    the ``top`` terms that a source has more of than its language.
    """
    counts = materialize(kept_counts(docs, min_docs), "divergence-counts")
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("first").alias("terms"))
    groups = counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n")).join(langs, "lang")
    total, lang_total = F.col("group_n") + 2 * F.col("terms"), F.col("lang_n") + 2 * F.col("terms")
    groups = groups.select("lang", "source", "terms", total.alias("total"), lang_total.alias("lang_total")).withColumn("z", _share("0", scale))
    groups = materialize(groups, "divergence-groups")

    shards = max(1, -(-counts.count() // shard_rows))
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard")
    rows = counts.filter("term <> ''").join(groups, ["lang", "source"]).select(
        shard, "lang", "source", "term", "n", _share("n", scale).alias("p"), "z", "lang_total"
    )
    none = F.lit(None)
    each = groups.filter("terms > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "lang", "source", none.cast("string").alias("term"), none.cast("long").alias("n"), none.cast("long").alias("p"), "z", none.cast("long").alias("lang_total")
    )
    found = rows.unionByName(each).groupBy("shard").applyInArrow(_shard(top, scale), FOUND)
    found = materialize(found, "divergence-shards")

    bare = groups.filter("terms = 0").select("lang", "source")
    other = bare.select(F.col("lang").alias("l"), F.col("source").alias("item"))
    empty = bare.join(other, (F.col("lang") == F.col("l")) & (F.col("source") < F.col("item"))).select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = found.filter("part = 'pair'").select("lang", "source", "item", "value").unionByName(empty).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.array(F.struct(F.col("source").alias("a"), F.col("item").alias("b")), F.struct(F.col("item").alias("a"), F.col("source").alias("b")))
    both = pairs.select("lang", "value", F.explode(ends).alias("e")).select("lang", F.col("e.a").alias("source"), F.lit("pair").alias("part"), F.col("e.b").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    terms = found.filter("part = 'term'").select("*", rank).filter(F.col("rank") <= top)
    return both.select("*", rank).unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between sources and the terms that set each apart, over all documents.

    Nulls, ties, repeated rows, groups without terms, empty tables and other columns: see the module.
    """
    return divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
own AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY 1, 2, 3),
grp AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY 1),
c AS (SELECT grp.lang, grp.source, kept.term, coalesce(own.n, 0) AS n, 1 + (1000000000 * (kept.n + 2)) // (v.n + 2 * v.v) AS q, v.v
      FROM grp JOIN kept ON grp.lang = kept.lang JOIN v ON v.lang = grp.lang LEFT JOIN own ON own.lang = grp.lang AND own.source = grp.source AND own.term = kept.term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2),
p AS (SELECT c.lang, c.source, term, n, CAST(q AS BIGINT) AS q, CAST(1 + (1000000000 * (n + 2)) // (total + 2 * v) AS BIGINT) AS p FROM c JOIN s ON c.lang = s.lang AND c.source = s.source),
m AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(m.value, 0) AS BIGINT) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
          UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every) WHERE part = 'pair' OR rank <= 10
"""
