"""Quality rules as a short-circuit cascade, in DataFrame functions only.

The measures of a text are computed inside its own row with array functions:
no explode, no shuffle, so a long document or a hot source costs what its own
characters cost.  Repeated word windows are found by sorting (window hash,
position) once and comparing neighbours.

Cascade.  On a random sample of about ``SAMPLE_ROWS`` rows each rule is evaluated
with the measures it needs between two readings of the executor's clock; what
it rejects is counted among the rows that the rules before it leave.  The order is
greedy: next comes the rule with the most rejections of what is left per
nanosecond.  ``keep_documents`` asks for the verdict alone, so a measure is worked
out inside the branch of its rule, and a document that a cheap rule rejects never
has the dear ones evaluated.  ``apply_rules`` also returns the measures, so there
only the rules beyond them are short-circuited.  Order changes the work alone: the
verdict is the conjunction of all rules.

Defined results.  A null or empty text has no words and fails the base rule, and
comes out as an empty text of ``apply_rules``.  Repeated rows are judged
separately; ties between rules go to the name that sorts first; an empty table
gives an empty result.  Input columns named like an added one, in any case, are
replaced; all others pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh, materialize, others, table

#: Rows, on average, on which costs and rejection rates of the rules are measured, and readings of each cost.
SAMPLE_ROWS, READINGS = 512, 3
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = (*MEASURES, "base_failed", "rejected_by", "kept")

Measure = Callable[[str], Column]


@dataclass(frozen=True)
class Rule:
    """``fails`` is over the text, given the measures it names."""

    name: str
    fails: Callable[[Column, Measure], Column]


#: The contract's base rules; a document that fails one is never kept.
BASE = [
    Rule("few_words", lambda t, m: m("n_words") < 50),
    Rule("repeat_words", lambda t, m: 100 * m("n_repeat_words") > 50 * m("n_words")),
]
#: The method's own rules, each an upper bound that ordinary prose stays far below.
OWN = [
    Rule("mean_word_length", lambda t, m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 15 * m("n_words"))),
    Rule("symbols_per_word", lambda t, m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("duplicate_lines", lambda t, m: 2 * m("n_dup_lines") > F.size(F.split(t, "\n"))),
    Rule("capitals", lambda t, m: 2 * F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")) > m("word_chars")),
    Rule("letters", lambda t, m: 2 * F.length(F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}]+", "")) < m("word_chars")),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{ASCII_SPACE}]+"), lambda w: w != "")


def measured(text: Column, words: Column) -> Measure:
    """Each measure as an expression over a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    made = {
        "n_words": lambda: F.size(words),
        "word_chars": lambda: F.length(F.array_join(words, "")),
        "n_symbols": lambda: F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": lambda: F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": lambda: repeat_words(words),
    }
    return lambda name: made[name]().cast("long")


def repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that is found twice or more in the array.

    A set of the windows' hashes tells whether any repeats; only then are they sorted.
    """
    last = F.size(words) - 2
    hashes = F.transform(F.slice(words, 1, F.greatest(last, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(F.transform(F.array(ordered), _covered)[0])

    # Bound once by a one-element array, so that nothing is worked out again for each reference.
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(F.transform(F.array(hashes), count)[0])


def _covered(ordered: Column) -> Column:
    """Words covered by those windows whose neighbour in (hash, position) order has the same hash."""

    def twice(x: Column, k: Column) -> Column:
        return F.get(ordered, k - 1)["h"].eqNullSafe(x["h"]) | F.get(ordered, k + 1)["h"].eqNullSafe(x["h"])

    return _cover(F.sort_array(F.transform(F.filter(ordered, twice), lambda x: x["i"])))


def _cover(starts: Column) -> Column:
    """Positions covered by windows of three words from ascending starts."""
    total = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(3), s - acc["last"])).cast("long").alias("n"), s.alias("last")
        ),
    )
    return total["n"]


def greedy_order(names: list[str], cost: dict[str, int], outcomes: list[tuple[dict[str, bool], int]]) -> list[str]:
    """Names by rejection per cost, each counted among the rows that the names before it leave.

    ``outcomes``: which rules fail, and how many rows fail so.
    """
    out: list[str] = []
    while len(out) < len(names):
        left = [(fails, n) for fails, n in outcomes if not any(fails[x] for x in out)]

        def worth(name: str) -> tuple[float, int, str]:
            return -sum(n for fails, n in left if fails[name]) / max(cost[name], 1), cost[name], name

        out.append(min((x for x in names if x not in out), key=worth))
    return out


def measure_order(df: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejection per cost on a sample of about ``sample_rows`` rows.

    The sample is a table of its own, a few rows from anywhere, so neither its size
    nor that of a task grows with ``df``.  The driver receives sums and counts.
    """
    share = min(1.0, sample_rows / max(df.count(), 1))
    text = F.coalesce(F.col("text"), F.lit(""))
    sample = df.select(text.alias("text")).sample(False, share, seed=11) if share < 1 else df.select(text.alias("text"))
    sample = materialize(sample.repartition(8).select("text", words_of(F.col("text")).alias("words")), "quality-sample")
    m = measured(F.col("text"), F.col("words"))
    now = lambda: F.java_method(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    cost = dict.fromkeys((r.name for r in rules), 2**62)
    for _ in range(READINGS):
        # A struct's fields are evaluated in this order: the clock, the rule, the clock.
        timed = sample.select(*[F.struct(now().alias("a"), r.fails(F.col("text"), m).alias("f"), now().alias("b")).alias(r.name) for r in rules])
        spent = timed.agg(*[F.sum(F.col(f"{r.name}.b") - F.col(f"{r.name}.a")) for r in rules]).first()
        for r, ns in zip(rules, spent):
            cost[r.name] = min(cost[r.name], ns or 0)
    fails = [r.fails(F.col("text"), m).alias(r.name) for r in rules]
    outcomes = [(r.asDict(), r["__n"]) for r in sample.select(*fails).groupBy(*cost).agg(F.count(F.lit(1)).alias("__n")).collect()]
    by_name = {r.name: r for r in rules}
    return [by_name[x] for x in greedy_order(list(cost), cost, outcomes)]


def cascade(ordered: list[Rule], text: Column, m: Measure, first: Column | None = None) -> Column:
    """Name of the first rule that rejects, or null; later rules aren't evaluated."""
    out = first
    for rule in ordered:
        out = (F if out is None else out).when(rule.fails(text, m), F.lit(rule.name))
    return out


def _one_row(value: Column) -> Column:
    """Through a generator of one row: a filter on what comes out can't pull the expression into
    itself, where each mention would work it out again."""
    return F.explode(F.array(value))


def with_measures(df: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed; a null text becomes empty."""
    names = others(df, ADDED)
    words, made = fresh(df, "__rule_words"), fresh(df, "__rule_measures")
    df = df.select(*[F.col(f"`{c}`") for c in names]).withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    m = measured(F.col("text"), F.col(words))
    df = df.withColumn(words, words_of(F.col("text")))
    df = df.withColumn(made, _one_row(F.struct(*[m(k).alias(k) for k in MEASURES])))
    df = df.select(*[F.col(f"`{c}`") for c in names], f"{made}.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def apply_rules(df: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """``df`` with the measures, ``base_failed``, ``rejected_by`` and ``kept``."""
    ordered = ordered if ordered is not None else measure_order(df, OWN)
    out = with_measures(df)
    return out.withColumn("rejected_by", cascade(ordered, F.col("text"), F.col, F.when(F.col("base_failed"), F.lit("base")))).withColumn(
        "kept", F.col("rejected_by").isNull()
    )


def keep_documents(df: DataFrame, ordered: list[Rule] | None = None) -> DataFrame:
    """The rows of ``df`` that ``apply_rules`` would keep, as they are, with no more measures than their verdicts need."""
    ordered = ordered if ordered is not None else measure_order(df, [*BASE, *OWN])
    words, verdict = fresh(df, "__rule_words"), fresh(df, "__rule_verdict")
    names = [F.col(f"`{c}`") for c in df.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    rejected = cascade(ordered, text, measured(text, F.col(words)))
    judged = df.withColumn(words, words_of(text)).withColumn(verdict, _one_row(rejected))
    return judged.filter(F.col(verdict).isNull()).select(*names)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents.

    Nulls, empty texts, ties, repeated rows, empty tables and extra columns: see the module.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line FROM d),
ln AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
g AS (SELECT a.doc_id, a.i, a.word AS x, b.word AS y, c.word AS z
      FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.i = a.i + 1
               JOIN p c ON a.doc_id = c.doc_id AND c.i = a.i + 2),
t AS (SELECT doc_id, x, y, z FROM g GROUP BY ALL HAVING count(*) >= 2),
r AS (SELECT DISTINCT g.doc_id, g.i FROM g JOIN t USING (doc_id, x, y, z)),
c AS (SELECT doc_id, i FROM r UNION SELECT doc_id, i + 1 FROM r UNION SELECT doc_id, i + 2 FROM r),
n AS (SELECT doc_id, count(*) AS n_repeat_words FROM c GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.text, len(d.lines) AS n_lines, CAST(len(d.w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(d.text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(ln.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN ln ON d.doc_id = ln.doc_id LEFT JOIN n ON d.doc_id = n.doc_id),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
            OR 2 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > word_chars
            OR 2 * length(regexp_replace(text, '[^\p{L}\p{M}\p{N}]', '', 'g')) < word_chars) AS kept
FROM f
"""
