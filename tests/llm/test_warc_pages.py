"""Pages that open much and close nothing, long pages, and clashing columns."""

import time

import pytest
from pyspark.sql import functions as F

from routeloom.llm import warc

SIZE = 5_000_000
#: What is repeated, and the text that is left of the page; None: the page itself, blanks squeezed.
HOSTILE = {
    "<a ": "<a " * 3,
    "<p ": None,
    "<html lang ": None,
    "<title>": "",
    "<!--": "",
    "<script ": "",
    "<": None,
    '="': None,
    '<a href="': None,
    "<a x='": None,
    "<a x=\"<a y='": None,
    "<title ": None,
    "</title": None,
    "</script ": None,
    "&": None,
    "&#": None,
    "\n \n": "",
    "\t ": "",
}


def derived(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {(r.page_id, r.record_type): r.block for r in warc.derive(warc.responses(df)).collect()}


def test_time_is_in_proportion_to_the_page(spark):
    """A quadratic pattern would take hours for one of these."""
    derived(spark, [(0, "u", "<p>warm</p>")])
    pages = [(i, "u", (s * (SIZE // len(s)))) for i, s in enumerate(HOSTILE)]
    began = time.monotonic()
    got = derived(spark, pages)
    assert time.monotonic() - began < 300
    for i, s in enumerate(HOSTILE):
        text = got[i, "conversion"]
        if HOSTILE[s] == "":
            assert text == "", s
        else:
            assert text == " ".join(pages[i][2].split()) or (s == "<a " and text.startswith("<a <a <a")), s


@pytest.mark.parametrize("page,text,meta", [
    ("<title>One</title><title>Two</title>x", "One\nTwo\nx", ["title: One"]),
    ("<title>One<title>Two</title>x", "One\nTwo\nx", ["title: One<title>Two"]),
    ("<title>never closed", "never closed", []),
    ("</title><title a=1>T &amp; U</TITLE >x", "T & U\nx", ["title: T & U"]),
    ("<HTML><html lang=de><html xml:lang='fr'>x", "x", ["language: de"]),
    ("<a href='x>y'>t</a> <A\nHREF=z>u</A>", "y'>t u", ["outlink: x>y", "outlink: z"]),
    ("<a title=\"1<2\" href=n>t</a>", "<a title=\"1<2\" href=n>t", []),
    ("<a title=\"1<b\" href=n>t</a>", "<a title=\"1t", []),
    ("<a <a href=y>t</a>", "<a t", ["outlink: y"]),
    ("<abbr href=no>a</abbr><a data-href=no href = \"yes\" href=no>b</a>", "ab", ["outlink: yes"]),
])
def test_markup(spark, page, text, meta):
    got = derived(spark, [(1, "u", page)])
    assert got[1, "conversion"] == text
    assert got[1, "metadata"].split("\r\n")[1:-1] == meta


def test_long_page(spark):
    page = "<html lang='en'><title>L</title>" + "".join(f"<p>line {i} &lt;<a href='/p{i}'>go</a><!-- {i} -->" for i in range(60_000))
    got = derived(spark, [(1, "u", page), (1, "u", page)])
    assert got[1, "conversion"] == "L\n" + "\n".join(f"line {i} <go" for i in range(60_000))
    assert got[1, "metadata"].count("outlink: /p") == 60_000


def test_clashing_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>x</p>"), (None, "u", "<p>x</p>")], "page_id long, url string, html string")
    more = df.withColumns({c: F.lit("clash") for c in ("BLOCK", "payload", "Record_Id", "__text", "__m", "__links", "refers_to", "target_uri", "http_headers")})
    for extra in (more, more.withColumn("DATE", F.lit(None).cast("string"))):
        got = warc.derive(warc.responses(extra)).collect()
        assert len(got) == 6 and {r.date for r in got} == {warc.NO_DATE}
        assert sorted(str((r.page_id, r.record_type, r.block)) for r in got) == sorted(str((r.page_id, r.record_type, r.block)) for r in warc.derive(warc.responses(df)).collect())
