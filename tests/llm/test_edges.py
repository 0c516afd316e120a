"""Every operator on long texts, empty tables and columns whose names clash in another case."""

import os
import sys

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from routeloom.llm import bpe, decontaminate, jaccard_join, language_mixture, line_dedup, quality_classifier, quality_rules, suffix_dedup, tables, token_counts, warc  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("N_Words", "KEPT", "Kept_Text", "ITEMS", "Row", "CONTENT", "N_Lines", "Score", "Held_Out", "COPIES", "Batch", "Features", "N_Tokens", "Block", "Root", "Class", "__rule_words", "__line_text")
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def bench(spark):
    return spark.createDataFrame([(1, ITEM)], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")


def cached(df):
    from routeloom.workspace import work_path

    return token_counts.cached_counts(df, P.path("word_bpe_49k.json"), work_path(df.sparkSession, "token-cache"))


OPERATORS = {
    "op1": lambda df: quality_classifier.quality_scores(df, labels(df.sparkSession)),
    "op3": line_dedup.dedup_lines,
    "op4": suffix_dedup.drop_repeats,
    "op5": lambda df: language_mixture.predict_languages(df, language_mixture.language_counts(df)),
    "op6": jaccard_join.jaccard_components,
    "op7": lambda df: bpe.encode_documents(df, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
    "op8": cached,
    "op9": lambda df: decontaminate.decontaminate(df, bench(df.sparkSession)),
    "op10": quality_rules.apply_rules,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    df = spark.createDataFrame([], SCHEMA)
    assert OPERATORS[name](df).collect() == []


def test_empty_pages(spark):
    assert warc.derive(warc.responses(spark.createDataFrame([], "page_id long, url string, html string"))).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_nulls_repeated_rows_and_clashing_names(spark, name):
    rows = [(None, None, None, None, None), (None, ITEM, None, "s", 1), (1, ITEM, "en", "s", 1), (1, ITEM, "en", "s", 1), (2, "", "de", None, 0), (3, ITEM + " more", None, "s", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES})
    out = OPERATORS[name](df)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)


LINE = "a line that stands a hundred thousand times"
LONG = "\n".join([LINE] * 100_000) + "\n" + ITEM + " " + " ".join(f"w{i}" for i in range(20_000))


@pytest.fixture(scope="module")
def long_rows():
    return [(1, LONG, "en", "s", 1), (2, LONG.replace("w77 ", "other "), "en", "s", 1), (3, LINE + "\nx", "en", "s", 1), (4, ITEM, "de", "s", 1)]


@pytest.mark.parametrize("name", OPERATORS)
def test_long_texts(spark, long_rows, name):
    df = spark.createDataFrame(long_rows, SCHEMA).repartition(2)
    got = {r.doc_id: r for r in OPERATORS[name](df).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    text = [r[1] for r in long_rows]
    if name == "op3":
        for d, (s, lines) in enumerate(((s, x) for _, s, x in brute.line_dedup([r[:2] for r in long_rows])), 1):
            assert (got[d].n_lines, got[d].n_dropped, got[d].kept_text) == (len(lines), len(lines) - len(s), "\n".join(s))
    if name == "op4":
        assert sum(s.b - s.a for s in got[1].spans) == 0 and len(got[2].kept) < 110 and got[4].kept == b""
    if name == "op6":
        assert got[1].component_id == got[2].component_id == 1 and got[3].component_id == 3
    if name == "op8":
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
        assert [got[d].n_tokens for d in got] == [len(t.encode(text[d - 1], add_special_tokens=False).ids) for d in got]
    if name == "op7":
        import hashlib

        assert all(got[d].decoded_sha256 == hashlib.sha256(text[d - 1].encode()).hexdigest() for d in got)
    if name == "op9":
        assert [got[d].n_hit for d in (1, 2, 3, 4)] == [14, 14, 0, 14] and not got[1].contaminated and got[4].contaminated
    if name == "op10":
        for d in (1, 4):
            assert {k: got[d][k] for k in brute.measures("")} == brute.measures(text[d - 1])
    assert tables.fold(4) is not None
