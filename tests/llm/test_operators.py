import hashlib
import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from routeloom.llm import decontaminate, language_mixture, line_dedup, quality_classifier, quality_rules, tables, token_counts, warc  # noqa: E402

LONG = "word and another " * 4000
ROWS = [
    (1, "The same long line stands here.\nshort\n  THE SAME LONG LINE STANDS HERE. \r", "a"),
    (2, "the same long line stands here.\nother", None),
    (3, "x\nThe same long line stands here.", "b"),
    (3, "x\nThe same long line stands here.", "b"),
    (None, "The same long line stands here.\nTail é", "c"),
    (4, None, "d"),
    (5, "", "e"),
    (6, "\n\n", "f"),
    (7, LONG, "g"),
    (8, " ".join(f"w{i % 60}" for i in range(60)), "h"),
    (9, "a b c a b c " * 10, "i"),
    (10, "###!! $$ " * 40, "j"),
    (11, "ÉCOLE GRANDE " + " ".join("MOT" + chr(65 + i % 26) + chr(65 + i // 26) for i in range(80)), "k"),
    (12, "same\nsame\n" + " ".join(f"v{i}" for i in range(70)), "l"),
    (13, "a a a a", "m"),
]


def frame(spark, rows=ROWS):
    """With extra columns whose names clash with those that operators add."""
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in ("n_words", "kept", "kept_text", "items", "row", "content", "__w", "h")})


def key(rows):
    return sorted(rows, key=repr)


def test_quality_rules(spark):
    got = quality_rules.apply_rules(frame(spark)).select("doc_id", "text", *brute.measures("").keys(), "kept").collect()
    assert len(got) == len(ROWS)
    for r in got:
        want = brute.measures(r.text) | {"kept": brute.kept(r.text)}
        assert {k: r[k] for k in want} == want, r.text[:60]


def test_rule_order_changes_no_verdict(spark):
    a = quality_rules.apply_rules(frame(spark), quality_rules.OWN).select("doc_id", "kept").collect()
    b = quality_rules.apply_rules(frame(spark), quality_rules.OWN[::-1]).select("doc_id", "kept").collect()
    assert key(a) == key(b)
    every = [*quality_rules.BASE, *quality_rules.OWN]
    ordered = quality_rules.measure_order(frame(spark), every)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in every)


@pytest.mark.parametrize("step", [1, -1])
def test_keep_documents_gives_the_rows_that_are_kept(spark, step):
    got = quality_rules.keep_documents(frame(spark), [*quality_rules.BASE, *quality_rules.OWN][::step])
    assert got.columns == frame(spark).columns
    assert key((r.doc_id, r.text) for r in got.collect()) == key(r[:2] for r in ROWS if brute.kept(r[1]))


def test_greedy_order_counts_rejections_among_what_is_left():
    outcomes = [({"a": True, "b": True, "c": False}, 10), ({"a": False, "b": False, "c": True}, 3), ({"a": False, "b": True, "c": False}, 1)]
    assert quality_rules.greedy_order(["a", "b", "c"], {"a": 1, "b": 2, "c": 1}, outcomes) == ["a", "c", "b"]
    assert quality_rules.greedy_order(["b", "a"], {"a": 5, "b": 5}, []) == ["a", "b"]


def test_a_reading_takes_the_time_of_its_rule(spark):
    """A rule with much work costs many times one without any."""
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(3000)), "x") for i in range(40)]
    seen = {}
    greedy, quality_rules.greedy_order = quality_rules.greedy_order, lambda names, cost, outcomes: seen.update(cost) or greedy(names, cost, outcomes)
    try:
        quality_rules.measure_order(frame(spark, rows), [*quality_rules.BASE, *quality_rules.OWN])
    finally:
        quality_rules.greedy_order = greedy
    assert seen["repeat_words"] > 10 * seen["few_words"]


def test_line_dedup(spark):
    got = line_dedup.dedup_lines(frame(spark)).select("doc_id", "kept_text", "n_lines", "n_dropped").collect()
    want = [(d, "\n".join(s), len(x), len(x) - len(s)) for d, s, x in brute.line_dedup([r[:2] for r in ROWS])]
    assert key(map(tuple, got)) == key(want)


def items():
    return [(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (2, "short one"), (3, None), (4, "..."), (2, "short one"), (None, "é ü")]


def contaminated_rows():
    rng = random.Random(3)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron short one é ü".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    text = "ALPHA beta gamma-delta epsilon zeta eta theta iota kappa lambda mu nu"
    return rows + [(90, "x " * 10 + text + " y"), (91, "x " * 300 + text), (92, text[:-3]), (93, None), (94, "short. One! é;ü"), (94, "short. One! é;ü"), (None, "short one")]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_decontaminate(spark, limit):
    rows = contaminated_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    got = decontaminate.decontaminate(df, bench, max_item_bytes=limit).collect()
    want = brute.contamination(rows, items())
    assert key((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got) == key((a, b, c, d, e) for a, b, c, d, e in want)
    for r in got:
        if r.doc_id == 90:
            raw = r.text.encode()
            assert [raw[s.a : s.b].decode() for s in r.byte_spans] == ["ALPHA beta gamma-delta epsilon zeta eta theta iota kappa lambda mu nu"]


def test_blocks_of_items_change_no_column(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    rows = [*contaminated_rows(), (95, f"one {text}; short one. {text.upper()}"), (96, f"{text} short one {text}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items(), "item_id long, text string")
    whole = decontaminate.decontaminate(df, bench).collect()
    assert decontaminate.item_blocks(bench, 60)[1] > 1
    assert key(decontaminate.decontaminate(df, bench, max_item_bytes=60).collect()) == key(whole)


def test_decontaminate_empty(spark):
    df = frame(spark, [])
    assert decontaminate.decontaminate(df, spark.createDataFrame(items(), "item_id long, text string")).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.decontaminate(frame(spark), none).collect()} == {0}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, tmp_path, name):
    import public_tokenizers as P

    if name.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(P.path(name))
        count = lambda x: len(t.encode(x, add_special_tokens=False).ids)
    else:
        import sentencepiece

        t = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        count = lambda x: len(t.encode(x))
    rows = ROWS + [(20, "a <|endoftext|> b  <|EndOfText|>\t\n c", "z"), (21, " a b  c ", "z"), (22, "a  b", "z"), (23, "a b", "z")]
    cache = f"file://{tmp_path}/cache"
    want = key((d, len((x or "").encode()), count(x or ""), count(x or "") > 50) for d, x, _ in rows)
    first = token_counts.cached_counts(frame(spark, rows[:9]), P.path(name), cache, 50)
    assert first.count() == 9
    stored = spark.read.parquet(cache).count()
    got = token_counts.cached_counts(frame(spark, rows), P.path(name), cache, 50).collect()
    assert key(map(tuple, got)) == want
    now = spark.read.parquet(cache)
    assert stored < now.count() and now.count() == now.select("content").distinct().count()
    again = token_counts.cached_counts(frame(spark, rows), P.path(name), cache, 50).collect()
    assert key(map(tuple, again)) == want and spark.read.parquet(cache).count() == now.count()
    assert token_counts.cached_counts(frame(spark, []), P.path(name), cache, 50).collect() == []


def test_language_mixture(spark):
    rng = random.Random(1)
    vocab = {"en": "the and of with this that would could their".split(), "fr": "le la les des avec pour dans une être".split(), "de": "der die das und nicht eine auch für über".split()}
    rows = []
    for i in range(300):
        lang = rng.choice(list(vocab))
        rows.append((i, " ".join(rng.choice(vocab[lang]) for _ in range(30)), lang))
    rows += [(900, None, "en"), (901, "", "fr"), (902, "12 !!", "de"), (903, "é", None), (904, "a", None), (905, LONG, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    train, rest = df.filter(tables.fold(4) != 2), df.filter(tables.fold(4) == 2)
    out = language_mixture.predict_languages(df, language_mixture.language_counts(train)).collect()
    assert len(out) == len(rows)
    held = {r.doc_id for r in rest.collect()}
    want = {d: x for d, _, x in rows}
    assert all(r.lang_pred == want[r.doc_id] for r in out if r.doc_id in held and r.doc_id < 900)
    assert {r.lang_pred for r in out if r.doc_id in (900, 901, 902)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out)
    mixed = " ".join(" ".join(rng.choice(vocab[x]) for _ in range(60)) for x in ("en", "fr"))
    two = language_mixture.predict_languages(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), language_mixture.language_counts(train)).first()
    assert {x.lang for x in two.languages} == {"en", "fr"} and all(0.3 < x.share < 0.7 for x in two.languages)
    empty = language_mixture.predict_languages(df, language_mixture.language_counts(df.filter("false"))).collect()
    assert {r.lang_pred for r in empty} == {"und"}


def test_quality_classifier(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("plain words make good prose for people who read".split()) for _ in range(60))
    bad = lambda: " ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "###", "CLICK!!"]) for _ in range(60))
    rows = [(i, good() if i % 3 else bad()) for i in range(400)] + [(1000, None), (1001, ""), (1001, ""), (1002, LONG), (None, "x")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, features string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)] + [(1000, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality_scores(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert held and all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in held)
    flat = quality_classifier.quality_scores(df, labels.filter("quality = 1")).collect()
    assert {r.score for r in flat} == {1.0}
    assert quality_classifier.quality_scores(df.filter("false"), labels).collect() == []


def test_warc(spark):
    pages = [
        (1, "http://a/x", '<html lang="en"><head><title>A &amp; B</title><script>var x="<p>";</script></head><body><p>One&nbsp;two<br>three &#233;&#x41;&#0; <b>bold</b></p><!-- no --><a class="k" href="/u?a=1&amp;b=2">go</a><style>p{}</style></body></html>'),
        (2, None, None),
        (2, None, None),
        (3, "http://b", "1 < 2 <script>never closed"),
        (None, "http://c", "é" * 3000),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("block", F.lit("clash"))
    responses = warc.responses(df)
    out = warc.derive(responses).collect()
    assert len(out) == 2 * len(pages)
    by = {(r.page_id, r.record_type): r for r in out}
    assert by[1, "conversion"].block == "A & B\nOne two\nthree éA&#0; bold\ngo"
    assert by[1, "metadata"].block.split("\r\n") == [f"payload-length: {len(pages[0][2].encode())}", "title: A & B", "language: en", "outlink: /u?a=1&b=2", ""]
    assert by[3, "conversion"].block == "1 < 2" and by[2, "conversion"].block == ""
    import base64

    ids = {r.record_id for r in responses.collect()}
    for r in out:
        assert r.refers_to in ids
        assert r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.block.encode()).digest()).decode()
        assert r.content_length == len(r.block.encode())


def test_warc_attributes_and_references_as_a_parser_reads_them(spark):
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.links, self.lang, self.text = [], [], []

        def handle_starttag(self, tag, attrs):
            self.links += [v for k, v in attrs if tag == "a" and k == "href"]
            self.lang += [v for k, v in attrs if tag == "html" and k == "lang"]

        def handle_data(self, data):
            self.text.append(data)

    bodies = [
        "<a href='/one'>&eacute;&uuml;</a> <A class=k HREF=/two?a=1&amp;b=2>&szlig; &times;</A> <a title='x href=\"no\"' href = \"/it's\">&bull;</a>",
        "<a data-href=/no rel='a b'href='/&Eacute;\"q\"'>&frac12; &CounterClockwiseContourIntegral;</a><a href=/end/>&unknown; &NotEqualTilde;</a><a name=x>y</a><abbr href=/no>z</abbr>",
        "<a " + "word " * 50_000 + "href=/far>&hearts;</a>",
    ]
    pages = [(i, "u", f"<html {lang}>{b}</html>") for i, (lang, b) in enumerate(zip(("lang='de'", "class=c lang=pt-BR", 'lang="fr"'), bodies))]
    by = {(r.page_id, r.record_type): r.block for r in warc.derive(warc.responses(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()}
    for i, _, html in pages:
        p = Reader()
        p.feed(html)
        p.close()
        assert by[i, "metadata"].split("\r\n")[1:-1] == [f"language: {p.lang[0]}", *(f"outlink: {x}" for x in p.links)]
        assert by[i, "conversion"] == "".join(p.text)


def test_warc_files_round_trip(spark, tmp_path):
    import gzip

    df = spark.createDataFrame([(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>é\r\n\r\nWARC/1.1 trap</p>")], "page_id long, url string, html string")
    records = warc.derive(warc.responses(df))
    blobs = [r.bytes for r in warc.record_bytes(records).collect()]
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(b"".join(map(bytes, blobs)))
    (tmp_path / "w/b.warc.gz").write_bytes(b"".join(gzip.compress(bytes(b)) for b in blobs))
    got = warc.read_warc(spark, f"file://{tmp_path}/w").collect()
    want = key((r.record_type, r.record_id, r.target_uri, r.block) for r in records.collect())
    for name in ("a.warc", "b.warc.gz"):
        assert key((r.record_type, r.record_id, r.target_uri, bytes(r.block).decode()) for r in got if r.file.endswith(name)) == want
    problems = [[p for *_, p in warc.parse_records(x)] for x in (b"", b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort", b"WARC/1.0\r\nA: 1\r\n\r\n", b"WARC/1.0", b"junk")]
    assert problems == [[], ["cut short"], ["no length"], ["no end of the header"], ["no record"]]


def warc_record(kind, number, block, length=None, digest=None):
    own = f"WARC-Payload-Digest: {digest}\r\n" if digest else ""
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{number}>\r\nWARC-Target-URI: http://site/{number}\r\nWARC-Date: 2024-05-0{number}T00:00:00Z\r\n{own}"
    return f"{head}Content-Type: application/http; msgtype={kind}\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n".encode() + block + b"\r\n\r\n"


def test_responses_of_warc_files_keep_their_headers_and_digests(spark, tmp_path):
    import base64
    import gzip

    page = "<html lang=fr><title>Été</title><p>Un &amp; deux</p><a href=/x>y</a></html>"
    plain = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Own: 1\r\n\r\n" + page.encode()
    latin = b"HTTP/1.0 404 Not Found\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n" + page.encode("latin-1")
    packed = gzip.compress(page.encode())
    pieces = b"".join(f"{len(x):x};ext=1\r\n".encode() + x + b"\r\n" for x in (packed[:30], packed[30:])) + b"0\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n" + pieces
    records = [
        warc_record("warcinfo", 1, b"software: x\r\n"), warc_record("response", 2, plain, digest="sha1:OWNDIGEST"), warc_record("request", 3, b"GET / HTTP/1.1\r\n\r\n"),
        warc_record("response", 4, latin), warc_record("response", 5, chunked), warc_record("response", 6, chunked[:-20]), warc_record("response", 7, b"no header"),
    ]
    (tmp_path / "w").mkdir()
    broken = warc_record("response", 8, b"x", length=10**6)
    (tmp_path / "w/a.warc").write_bytes(b"".join(records[:3]) + broken + b"".join(records[3:]))
    bad = bytearray(gzip.compress(records[3]))
    bad[40:60] = b"\0" * 20
    (tmp_path / "w/b.warc.gz").write_bytes(gzip.compress(records[1]) + bytes(bad) + gzip.compress(records[4]))
    found = warc.http_responses(warc.read_warc(spark, f"file://{tmp_path}/w"))
    rows = found.collect()
    assert sorted(str(r.problem) for r in rows) == sorted(["None"] * 5 + ["cut short", "damaged gzip member", "chunks cut short", "no HTTP header"])
    good = {r.record_id: r for r in rows if r.problem is None}
    assert {r.payload for r in good.values()} == {page}
    own = good["<urn:uuid:2>"]
    assert (own.payload_digest, own.target_uri, own.date) == ("sha1:OWNDIGEST", "http://site/2", "2024-05-02T00:00:00Z")
    assert own.http_headers == plain.split(b"\r\n\r\n")[0].decode() + "\r\n"
    assert good["<urn:uuid:5>"].payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(page.encode()).digest()).decode()
    made = warc.derive(found.filter("problem is null"))
    by = {(r.refers_to, r.record_type): r for r in made.collect()}
    meta, text = by["<urn:uuid:4>", "metadata"], by["<urn:uuid:4>", "conversion"]
    assert meta.block.split("\r\n")[1:-1] == ["title: Été", "language: fr", "outlink: /x"]
    assert text.block.split("\n")[-1].endswith("y") and "Un & deux" in text.block
    assert "404 Not Found" in meta.source_headers
    out = [bytes(r.bytes) for r in warc.record_bytes(made).collect()]
    assert any(b"WARC-Refers-To: <urn:uuid:2>" in x and b"WARC-X-Source-Header: X-Own: 1" in x and b"WARC-X-Source-Payload-Digest: sha1:OWNDIGEST" in x for x in out)
