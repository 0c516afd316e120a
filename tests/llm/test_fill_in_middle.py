"""Fill-in-middle against plain Python: grammars, draws, marks, round trips."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from routeloom.llm import fill_in_middle as M

ALPHABET = ["a", "B", " ", "\t", "\n", "\n\n", "\r\n", "é", "日", "\U0001f600", "<", "<P", ">", "&", "\x85", " ", "."]
SCHEMA = "doc_id long, text string"


def texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 30))) for _ in range(n)]


def plain_version(doc_id, text, pattern=r"[^\n]*\n|[^\n]+", seed=7, percent=100, spm=50):
    text = text or ""
    pieces = re.findall(pattern, text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(pieces) + 1), h[1] % (len(pieces) + 1)))
    pre, mid, suf = ("".join(pieces[i:j]) for i, j in ((0, a), (a, b), (b, len(pieces))))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return len(pieces), "plain", None, None, text
    out = f"<S>{suf}<P>{pre}<M>{mid}" if h[3] % 100 < spm else f"<P>{pre}<S>{suf}<M>{mid}"
    return len(pieces), "spm" if h[3] % 100 < spm else "psm", len(pre), len(mid), out


@pytest.mark.parametrize("name", M.UNITS)
def test_units_are_the_grammars_matches(spark, name):
    rows = list(enumerate(texts(300)))
    grammar = M.UNITS[name]
    got = spark.createDataFrame(rows, SCHEMA).select("doc_id", M.units(F.col("text"), grammar).alias("u")).collect()
    assert {r.doc_id: r.u for r in got} == {i: re.findall(grammar.pattern, t) for i, t in rows}


@pytest.mark.parametrize("name", M.UNITS)
def test_outputs_and_round_trip(spark, name):
    rows = [*enumerate(texts(200, 5)), (None, "a\nb\nc"), (7, None), (8, ""), (8, "x\n<S>\ny"), (9, "a\nb"), (9, "a\nb"), (10, "\n" * 50_000 + "tail")]
    df = M.fill_in_middle(spark.createDataFrame(rows, SCHEMA), M.UNITS[name], percent=80, spm_percent=40)
    got = df.withColumn("back", M.restore(F.col("output"), F.col("form"))).collect()
    want = sorted((str(d), t or "", *map(str, plain_version(d, t, M.UNITS[name].pattern, percent=80, spm=40))) for d, t in rows)
    assert sorted((str(r.doc_id), r.text or "", str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in got) == want
    assert all(r.back == (r.text or "") for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}


def test_other_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb", "x")], "doc_id long, text string, FORM string").withColumns({c: F.lit(1) for c in ("__fim_text", "lang", "Output", "__FIM_units")})
    out = M.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "__fim_text", "lang", "__FIM_units", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert out.first()["__fim_text"] == 1
    assert M.fill_in_middle(df.limit(0)).collect() == []


def test_marks():
    for bad in (("a", "a", "b"), ("", "x", "y"), ("aba", "x", "y"), ("ab", "bc", "x"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            M.Marks(*bad)


def test_own_marks(spark):
    marks = M.Marks("[PRE.]", "[SUF*]", "[MID|]")
    rows = [(i, "a.\nb*\n[PRE\nc" * (i % 4)) for i in range(20)]
    out = M.fill_in_middle(spark.createDataFrame(rows, SCHEMA), M.CHARACTERS, marks=marks)
    assert all(r.back == r.text for r in out.withColumn("back", M.restore(F.col("output"), F.col("form"), marks)).collect())
