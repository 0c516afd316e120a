"""Fill-in-middle transformation by lookaround splitting.

A unit grammar says where one unit of a text ends and the next begins, by the
classes of the two characters that meet there.  It is translated to a zero-width
boundary regex, a lookbehind for the one class and a lookahead for the other, and
``split`` at that regex keeps every character: the pieces are the units, and joined
they are the text.  Three runs of units become prefix, middle and suffix; where they
are cut and in what order they stand is drawn from a digest of the document's id, so
a repeated run, or a task that runs again, gives the same output.

A map in built-in functions: no shuffle, no Python, a text is held once with its
pieces and its output.

Defined results.  A null text is empty; an empty one has no units (``split`` would
give one) and stays plain, and so does one in which a mark stands already, as it
could not be restored.  A null doc_id counts as the empty text.  Repeated rows, and
rows of one doc_id, are each transformed, by the same draw.  An empty table gives an
empty result.  Input columns named like an added one, in any case, are replaced; all
others pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, others, table

ANY = r"[\s\S]"


@dataclass(frozen=True)
class Grammar:
    """A unit's pattern, matched from left to right, and the pairs of classes between which it ends."""

    pattern: str
    ends: tuple[tuple[str, str], ...]

    @property
    def boundary(self) -> str:
        return "|".join(f"(?<={left})(?={right})" for left, right in self.ends)


def ended_by(chars: str) -> Grammar:
    """Each unit reaches to one of the characters, the last one to the end."""
    return Grammar(f"[^{chars}]*[{chars}]|[^{chars}]+", ((f"[{chars}]", ANY),))


def led_by(chars: str) -> Grammar:
    """Each unit is a run of other characters with those of the class before it."""
    return Grammar(f"[{chars}]*[^{chars}]+|[{chars}]+", ((f"[^{chars}]", f"[{chars}]"),))


def runs_of(chars: str) -> Grammar:
    """Runs of characters of the class and runs of others in turn."""
    return Grammar(f"[{chars}]+|[^{chars}]+", ((f"[{chars}]", f"[^{chars}]"), (f"[^{chars}]", f"[{chars}]")))


CHARACTERS = Grammar(ANY, ((ANY, ANY),))
LINES = ended_by(r"\n")
WORDS = led_by(r"\x20\x09-\x0D")
UNITS = {"lines": LINES, "words": WORDS, "runs": runs_of(r"\x20\x09-\x0D"), "characters": CHARACTERS}


@dataclass(frozen=True)
class Marks:
    """What stands before prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        """Where no end of a mark is the start of one, no mark is found across a mark's edge."""
        every = (self.prefix, self.suffix, self.middle)
        if "" in every or len(set(every)) < 3:
            raise ValueError("marks must be three different texts")
        if any(a != b and a in b for a in every for b in every) or any(b.startswith(a[i:]) for a in every for b in every for i in range(1, len(a))):
            raise ValueError("marks must not overlap")

    @property
    def pattern(self) -> str:
        return "|".join(re.escape(m) for m in (self.prefix, self.suffix, self.middle))


def units(text: Column, grammar: Grammar) -> Column:
    """The units of a text; joined they are the text."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(F.split(text, grammar.boundary, -1))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text again, from what the transformation made of it."""
    order = F.when(form == "psm", F.array(F.lit(1), F.lit(3), F.lit(2))).otherwise(F.array(F.lit(2), F.lit(3), F.lit(1)))
    # An array of one, so that the output is split once for its three parts.
    joined = F.transform(F.array(F.split(output, marks.pattern, -1)), lambda part: F.array_join(F.transform(order, lambda i: F.get(part, i)), ""))
    return F.when(form == "plain", output).otherwise(F.get(joined, F.lit(0)))


def fill_in_middle(df: DataFrame, grammar: Grammar = LINES, seed: int = 7, percent: int = 100, spm_percent: int = 50, marks: Marks = Marks()) -> DataFrame:
    """All rows and columns of ``df`` plus ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Of the texts that can be, ``percent`` in a hundred are transformed, of these
    ``spm_percent`` to suffix, prefix, middle and the others to prefix, suffix, middle.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    names = others(df, made)
    df = df.select(*[F.col(f"`{c}`") for c in names])
    text, piece, draw, pre, mid, suf = (fresh(df, f"__fim_{x}") for x in ("text", "units", "draw", "prefix", "middle", "suffix"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = lambda i: F.conv(F.substring(draw, 8 * i - 7, 8), 16, 10).cast("long")
    n = F.col("n")
    first, last = F.least(h(1) % (n + 1), h(2) % (n + 1)).cast("int"), F.greatest(h(1) % (n + 1), h(2) % (n + 1)).cast("int")
    between = lambda a, b: F.array_join(F.slice(piece, a + 1, b - a), "")
    plain = (F.length(text) == 0) | F.col(text).rlike(marks.pattern) | (h(3) % 100 >= percent)
    # Each step's columns are read more than once by the next, so they stay columns and nothing is worked out twice.
    out = (
        df.withColumns({text: F.coalesce("text", F.lit("")), draw: digest})
        .withColumn("form", F.when(plain, "plain").when(h(4) % 100 < spm_percent, "spm").otherwise("psm"))
        .withColumn(piece, units(F.col(text), grammar))
        .withColumn("n", F.size(piece).cast("long"))
        .withColumns({pre: between(F.lit(0), first), mid: between(first, last), suf: between(last, n.cast("int"))})
    )
    p, s, m = F.concat(F.lit(marks.prefix), pre), F.concat(F.lit(marks.suffix), suf), F.concat(F.lit(marks.middle), mid)
    form = F.col("form")
    filled = form != "plain"
    return out.select(
        *[F.col(f"`{c}`") for c in names],
        "n",
        "form",
        F.when(filled, F.length(pre).cast("long")).alias("prefix_chars"),
        F.when(filled, F.length(mid).cast("long")).alias("middle_chars"),
        F.when(form == "psm", F.concat(p, s, m)).when(form == "spm", F.concat(s, p, m)).otherwise(F.col(text)).alias("output"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts cut into lines and filled in at the middle, with digests of the output and of the text restored from it.

    Nulls, empty texts, marks in texts, repeated rows, empty tables and extra columns: see the module.
    """
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = restore(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u FROM documents),
g AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS h2,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT doc_id, t, n, array_to_string(u[1:least(h1, h2)], '') AS pre, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS mid, array_to_string(u[greatest(h1, h2) + 1:n], '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""
