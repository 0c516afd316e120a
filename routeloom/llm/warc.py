"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response record gives two records that point back to it by WARC-Refers-To,
keep its target URI, date, HTTP headers and payload digest, and carry digests of
their own blocks.  Record ids are names: a digest of what the record is derived
from, so a repeated run, or a task that runs again, gives the same ids.

Building records is a map in built-in functions: no shuffle, no Python.  Reading
WARC files and taking HTTP messages apart is a map in Python: ``read_warc``, then
``http_responses``, then ``derive``.

Defined results.  Null html is an empty payload, with an empty conversion and a
metadata record without fields beyond the length; null url is an empty target.
Repeated pages give repeated records; an empty table gives none.  ``derive`` takes the
columns of ``responses`` or ``http_responses`` and drops all others, whatever they are
called.  Markup that never closes (a cut tag or
script) is dropped to its end if it opened a script, style or comment, else kept
as text.  A tag ends at its first ``>``, and one that meets another ``<`` before is
text; attributes are looked for up to that ``<``.  Every step's time is in proportion
to the page, whatever it opens and doesn't close.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Date of responses whose table has none.
NO_DATE = "1970-01-01T00:00:00Z"
DROPPED = ["script", "style", "noscript", "template"]
BREAKS = "p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|section|article|header|footer|nav|aside|main|blockquote|pre|hr|title|head|body|form|figure|figcaption"
#: Named character references of the SQL, which knows only these, and links and languages in double quotes.
SQL_ENTITIES = {
    "nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "copy": "©", "reg": "®", "middot": "·", "hellip": "…",
    "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "euro": "€",
}
SQL_REFERENCE = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]{2,6});"
SQL_LINK = r'(?i)^<a\s[^>]*?href\s*=\s*"([^"]*)"'
SQL_LANG = r'(?i)^<html\b[^>]*?lang\s*=\s*"([^"]*)"'
#: All named references that end in a semicolon, common ones first as a map is searched in order; no-break spaces are blanks.
ENTITIES = SQL_ENTITIES | {k[:-1]: v.replace("\xa0", " ") for k, v in html5.items() if k.endswith(";") and k[:-1] not in SQL_ENTITIES}
REFERENCE = "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"
#: Comments and elements that are dropped with what is in them, to their end or the text's.
GONE = "(?is)<(?:!--.*?(?:-->|$)|" + "|".join(rf"{t}\b.*?(?:</{t}\s*>|$)" for t in DROPPED) + ")"
BREAK = rf"(?i)</?(?:{BREAKS})\b[^<>]*>"
TAG = r"<[/!?a-zA-Z][^<>]*>"
#: What opens a title, and what closes it.
TITLE, TITLE_END = r"(?i)<title\b[^<>]*>", "(?i)</title"
#: A tag to the next one, in which its attributes are looked for.
A_PIECE, HTML_PIECE = r"(?i)<a[\s/][^<]*", r"(?i)<html[\s/][^<]*"
#: Blanks other than a single space, and line feeds with blanks around them; neither matches a plain space.
BLANKS = r"[\t\r\f\x0B][ \t\r\f\x0B]*| [ \t\r\f\x0B]+"
LINES = r" ?\n[ \n]*"
#: A value in double, single or no quotes, and what may stand between attributes.  Loops don't give back, so they take no stack.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)"""
OTHER = rf"""(?:[^\s=>"'/][^\s=>/]*+(?:\s*+=\s*+{VALUE})?+|["'=])[\s/]*+"""


def attribute(tag: str, name: str) -> str:
    """Pattern of a tag with the value of its first attribute of that name, quotes included, as its group."""
    return rf"(?i)^<{tag}(?=[\s/])[\s/]*+(?:(?!{name}\s*=){OTHER})*+{name}\s*=\s*({VALUE})"


LINK, LANG = attribute("a", "href"), attribute("html", "(?:xml:)?lang")


def attribute_values(html: str, piece: str, pattern: str) -> Column:
    """Values of an attribute, quotes included, of all tags of a kind that have it.

    Each tag is looked at by itself, up to the next one, so a page of tags that never
    close takes time in proportion to its length.
    """
    pieces = F.regexp_extract_all(html, F.lit(piece), F.lit(0))
    return F.filter(F.transform(pieces, lambda x: F.regexp_extract(x, pattern, 1)), lambda v: v != "")


def title(html: str) -> Column:
    """What stands between the first title's tag and the next end of a title; nothing if either is missing."""
    rest = F.split(F.get(F.split(html, TITLE, 2), F.lit(1)), TITLE_END, 2)
    return F.coalesce(F.when(F.size(rest) == 2, F.get(rest, F.lit(0))), F.lit(""))


def unquoted(value: Column) -> Column:
    return F.when(F.substring(value, 1, 1).isin('"', "'"), F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def labelled_sha1(text: Column) -> Column:
    """sha1: and the digest in base 32, as WARC files have it."""
    hex_ = F.sha1(text)
    digits = F.concat(*[F.lpad(F.conv(F.substring(hex_, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)])
    return F.concat(F.lit("sha1:"), F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\x01", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def decode_references(text: Column) -> Column:
    """Character references decoded, each once, from the left; unknown ones stay.

    Only what follows an ampersand is looked at.
    """
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")

    def part(x: Column, i: Column) -> Column:
        name = F.regexp_extract(x, REFERENCE, 1)
        digits = F.substring(name, 2, 9)
        number = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 9), 16, 10)).otherwise(digits).cast("int")
        good = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        numeric = F.when(good, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        char = F.when(F.startswith(name, F.lit("#")), numeric).otherwise(F.try_element_at(names, name))
        # An ampersand without a name isn't looked up, as the map is searched from end to end.
        return F.when(i == 0, x).when(name == "", F.concat(F.lit("&"), x)).otherwise(F.coalesce(F.concat(char, F.substr(x, F.length(name) + 2)), F.concat(F.lit("&"), x)))

    return F.when(F.instr(text, "&") == 0, text).otherwise(F.array_join(F.transform(F.split(text, "&"), part), ""))


def squeeze(text: Column) -> Column:
    """One space for each run of blanks, one line feed for each run of lines, none at the ends."""
    return F.btrim(F.regexp_replace(F.regexp_replace(text, BLANKS, " "), LINES, "\n"), F.lit(" \n"))


def with_plain_text(df: DataFrame, html: str, to: str) -> DataFrame:
    """``df`` with the text of a page in column ``to``.

    What is dropped whole goes first, then tags that break lines, then other tags;
    references are decoded and blanks squeezed.  Steps that read their input more
    than once get it as a column, so nothing is worked out twice.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, GONE, ""), BREAK, "\n"), TAG, "")
    return df.withColumn(to, bare).withColumn(to, decode_references(F.col(to))).withColumn(to, squeeze(F.col(to)))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table (page_id, url, html[, date])."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    date = F.coalesce(F.col("date").cast("string"), F.lit(NO_DATE)) if "date" in pages.columns else F.lit(NO_DATE)
    headers = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n")
    )
    return (
        pages.select("page_id", url.alias("target_uri"), date.alias("date"), headers.alias("http_headers"), html.alias("payload"))
        .withColumn("payload_digest", labelled_sha1(F.col("payload")))
        .withColumn("record_id", record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("target_uri"), F.col("payload_digest")))
    )


def derive(responses_: DataFrame) -> DataFrame:
    """A metadata and a conversion record for each response."""
    c = F.col
    # Fields stand in columns of their own first, so that each is worked out once.
    found = (
        responses_.withColumn("__title", title("payload"))
        .withColumn("__title", decode_references(c("__title")))
        .withColumn("__title", F.regexp_replace(squeeze(c("__title")), "\n", " "))
        .withColumn("__lang", squeeze(unquoted(F.coalesce(F.get(attribute_values("payload", HTML_PIECE, LANG), F.lit(0)), F.lit("")))))
        .withColumn("__links", F.transform(attribute_values("payload", A_PIECE, LINK), lambda x: F.concat(F.lit("outlink: "), squeeze(decode_references(unquoted(x))), F.lit("\r\n"))))
    )
    found = with_plain_text(found, "payload", "__text")
    field = lambda name, v: F.when(v == "", "").otherwise(F.concat(F.lit(f"{name}: "), v, F.lit("\r\n")))
    metadata = F.concat(
        F.lit("payload-length: "), F.octet_length("payload").cast("string"), F.lit("\r\n"),
        field("title", c("__title")), field("language", c("__lang")), F.array_join("__links", ""),
    )
    made = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), metadata.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), c("__text").alias("block")),
    )
    return (
        found.withColumn("__m", F.explode(made))
        .select(
            "page_id",
            "__m.record_type",
            record_id(c("__m.record_type"), c("record_id")).alias("record_id"),
            c("record_id").alias("refers_to"),
            "target_uri",
            "date",
            "__m.content_type",
            c("http_headers").alias("source_headers"),
            c("payload_digest").alias("source_payload_digest"),
            "__m.block",
        )
        .withColumn("block_digest", labelled_sha1(c("block")))
        .withColumn("content_length", F.octet_length("block").cast("long"))
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """(record_id, bytes): derived records as they stand in a WARC file."""
    line = lambda name, v: F.concat(F.lit(f"{name}: "), v, F.lit("\r\n"))
    c = F.col
    source = F.regexp_replace(F.btrim("source_headers", F.lit("\r\n")), "\r\n", "\r\nWARC-X-Source-Header: ")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", c("record_type")), line("WARC-Record-ID", c("record_id")), line("WARC-Refers-To", c("refers_to")),
        line("WARC-Target-URI", c("target_uri")), line("WARC-Date", c("date")), line("WARC-X-Source-Header", source),
        line("WARC-X-Source-Payload-Digest", c("source_payload_digest")), line("WARC-Block-Digest", c("block_digest")),
        line("Content-Type", c("content_type")), line("Content-Length", c("content_length").cast("string")), F.lit("\r\n"),
    )
    return records.select("record_id", F.encode(F.concat(head, c("block"), F.lit("\r\n\r\n")), "UTF-8").alias("bytes"))


#: A record, or the part of a file from ``at`` on that isn't one and why.
Found = tuple[int, list[tuple[str, str]], bytes, str | None]
DAMAGED = "no end of the header", "no length", "cut short", "damaged gzip member", "no record"


def parse_records(data: bytes) -> Iterator[Found]:
    """(place, header fields, block, problem) of each record of a WARC file, plain or gzip by member.

    What isn't a record is one, with a problem and without fields, and reading goes on at the
    next record's mark or gzip member after it.
    """
    if data[:2] != b"\x1f\x8b":
        yield from _plain(data, 0)
        return
    at = 0
    while at < len(data):
        d = zlib.decompressobj(31)
        try:
            member = d.decompress(data[at:])
            if not d.eof:
                raise zlib.error
        except zlib.error:
            yield at, [], b"", DAMAGED[3]
            at = data.find(b"\x1f\x8b\x08", at + 1)
            if at < 0:
                return
            continue
        yield from ((at, fields, block, problem) for _, fields, block, problem in _plain(member, at))
        at = len(data) - len(d.unused_data)


def _plain(data: bytes, base: int) -> Iterator[Found]:
    at = data.find(b"WARC/")
    if at < 0 and data:
        yield base, [], b"", DAMAGED[4]
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        after = data.find(b"\r\nWARC/", at + 1)
        if end < 0 or 0 <= after < end:
            yield base + at, [], b"", DAMAGED[0]
            at = after + 2 if after >= 0 else -1
            continue
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
        size = next((int(v) for k, v in fields if k.lower() == "content-length" and v.isdigit()), None)
        if size is None or end + 4 + size > len(data):
            yield base + at, fields, b"", DAMAGED[1] if size is None else DAMAGED[2]
            after = data.find(b"\r\nWARC/", end)
            at = after + 2 if after >= 0 else -1
            continue
        yield base + at, fields, data[end + 4 : end + 4 + size], None
        at = data.find(b"WARC/", end + 4 + size)


_RECORD = "file string, position long, record_type string, record_id string, target_uri string, date string, headers map<string,string>, block binary, problem string"
_RECORD_TYPES = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files under ``path``; what is damaged is a row, too, with its ``problem``.

    ``position`` is the record's byte in the file, or that of its gzip member.  A file
    is one task's work and is held in memory, unpacked member by member; files of the
    customary size (about 1 GB) need executors made for that.
    """
    names = [x.split()[0] for x in _RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                rows, size = [], 0
                for at, fields, block, problem in parse_records(content.as_buffer().to_pybytes()):
                    low = {k.lower(): v for k, v in reversed(fields)}
                    rows.append((file, at, *(low.get(f"warc-{x}") for x in ("type", "record-id", "target-uri", "date")), list({k: v for k, v in reversed(fields)}.items()), block, problem))
                    size += len(block)
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _RECORD_TYPES)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _RECORD_TYPES)], names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RECORD)


def http_message(block: bytes) -> tuple[str, bytes, str | None]:
    """(status line and headers, body without transfer and content coding, problem) of a response's block."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return "", block, "no HTTP header"
    head, body = block[: end + 2].decode("iso-8859-1"), block[end + 4 :]
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(":") for x in head.split("\r\n")[1:])}
    problem = None
    if "chunked" in fields.get("transfer-encoding", ""):
        body, problem = _unchunked(body)
    coding = fields.get("content-encoding", "")
    if body[:2] == b"\x1f\x8b" and "gzip" in coding or "deflate" in coding:
        try:
            body = zlib.decompressobj(31 if "gzip" in coding else 15).decompress(body)
        except zlib.error:
            problem = "damaged content coding"
    elif coding not in ("", "identity", "gzip"):
        problem = f"content coding {coding}"
    return head, body, problem


def _unchunked(body: bytes) -> tuple[bytes, str | None]:
    """A body put together from its chunks; one that has none, as some crawlers store it, stays."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or end + 2 + size > len(body):
            return (b"".join(out), "chunks cut short") if out else (body, None)
        if size == 0:
            return b"".join(out), None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _text(head: str, body: bytes) -> str:
    named = re.search(r"(?im)^content-type:[^\r\n]*charset\s*=\s*[\"']?([\w.:-]+)", head)
    try:
        return body.decode(named[1] if named else "utf-8", "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


_RESPONSE = "page_id long, record_id string, target_uri string, date string, http_headers string, payload string, payload_digest string, problem string"


def http_responses(records: DataFrame) -> DataFrame:
    """Response records of ``read_warc`` as ``derive`` takes them, with a ``problem`` where one is not whole.

    Keeps the record's own id, target, date, HTTP header and payload digest; a record
    without an id or digest gets one of its block or body.  Other records are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                block = r["block"] or b""
                head, body, problem = ("", b"", r["problem"]) if r["problem"] else http_message(block)
                low = {k.lower(): v for k, v in r["headers"] or []}
                digest = low.get("warc-payload-digest") or "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
                own = r["record_id"] or f"<urn:uuid:{uuid.UUID(hashlib.md5(block).hexdigest())}>"
                rows.append((None, own, r["target_uri"] or "", r["date"] or NO_DATE, head, _text(head, body), digest, problem))
            cols = zip(*rows) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [pa.int64(), *[pa.string()] * 7])], [x.split()[0] for x in _RESPONSE.split(", ")])

    damaged = F.col("record_type").isNull() & F.col("problem").isNotNull()
    found = records.filter((F.col("record_type") == "response") | damaged)
    return found.select("record_id", "target_uri", "date", "headers", "block", "problem").mapInArrow(run, _RESPONSE)


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records for each page.  Nulls, repeated rows, empty tables, cut markup and other columns: see the module."""
    return derive(responses(table(spark, sf_dir, "pages").select("page_id", "url", "html")))


def _oracle() -> str:
    """The same records in DuckDB's functions."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def sha(x: str) -> str:
        parts = " || ".join(f"lpad(to_base(CAST('0x' || substr(sha1({x}), {1 + 10 * i}, 10) AS BIGINT), 32), 8, '0')" for i in range(4))
        return f"'sha1:' || translate({parts}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"

    def rid(*parts: str) -> str:
        h = f"md5({' || chr(1) || '.join(parts)})"
        return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"

    def decoded(x: str) -> str:
        name = f"regexp_extract(p, '{SQL_REFERENCE}', 1)"
        number = f"CASE WHEN lower(substr({name}, 2, 1)) = 'x' THEN TRY_CAST('0x' || substr({name}, 3) AS INTEGER) ELSE TRY_CAST(substr({name}, 2) AS INTEGER) END"
        cases = " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in SQL_ENTITIES.items())
        char = f"CASE WHEN {name}[1] = '#' THEN CASE WHEN {number} BETWEEN 1 AND 1114111 AND NOT {number} BETWEEN 55296 AND 57343 THEN chr({number}) END ELSE CASE {name} {cases} END END"
        part = f"CASE WHEN i = 1 THEN p ELSE coalesce({char} || substr(p, length({name}) + 2), '&' || p) END"
        return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {part}), '')"

    def squeezed(x: str) -> str:
        return f"trim(regexp_replace(regexp_replace({x}, '{BLANKS}', ' ', 'g'), '{LINES}', chr(10), 'g'), ' ' || chr(10))"

    text = f"regexp_replace(regexp_replace(regexp_replace(payload, '{GONE}', '', 'g'), '{BREAK}', chr(10), 'g'), '{TAG}', '', 'g')"
    crlf = "chr(13) || chr(10)"
    field = lambda name, col: f"CASE WHEN {col} = '' THEN '' ELSE '{name}: ' || {col} || {crlf} END"
    return rf"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS target_uri, '{NO_DATE}' AS date, coalesce(html, '') AS payload,
         'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: '
           || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) || {crlf} AS source_headers
  FROM pages),
d AS (SELECT *, {sha("payload")} AS source_payload_digest FROM r),
i AS (SELECT *, {rid("'response'", "coalesce(CAST(page_id AS VARCHAR), '')", "target_uri", "source_payload_digest")} AS refers_to,
             replace({squeezed(decoded(f"regexp_extract(payload, '(?is){TITLE[4:]}(.*?)</title', 1)"))}, chr(10), ' ') AS title,
             {squeezed(f"coalesce(list_filter(list_transform(regexp_extract_all(payload, '{HTML_PIECE}'), lambda h: regexp_extract(h, '{SQL_LANG}', 1)), lambda h: h <> '')[1], '')")} AS lang,
             list_transform(list_transform(list_filter(regexp_extract_all(payload, '{A_PIECE}'), lambda h: regexp_matches(h, '{SQL_LINK}')), lambda h: regexp_extract(h, '{SQL_LINK}', 1)), lambda h: 'outlink: ' || {squeezed(decoded("h"))} || {crlf}) AS links
      FROM d),
m AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
         'payload-length: ' || CAST(octet_length(encode(payload)) AS VARCHAR) || {crlf} || {field("title", "title")} || {field("language", "lang")}
           || coalesce(array_to_string(links, ''), '') AS block FROM i
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {squeezed(decoded(text))} FROM i)
SELECT page_id, record_type, {rid("record_type", "refers_to")} AS record_id, refers_to, target_uri, date, content_type, source_headers,
       source_payload_digest, block, {sha("block")} AS block_digest, CAST(octet_length(encode(block)) AS BIGINT) AS content_length
FROM m
"""


OP2_SQL = _oracle()
