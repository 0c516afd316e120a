"""Source divergence against plain Python loops over all terms, groups and pairs."""

import os
import random
import re
import sys
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from brute import UP  # noqa: E402

from routeloom.llm import source_divergence as S

SCHEMA = "text string, lang string, source string"


def slow(rows, least=10, top=10, scale=1_000_000_000):
    docs, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = re.findall(S.TERM, (text or "").translate(UP))
        docs[lang].update(set(words))
        n[lang, source].update(words)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, k in docs[lang].items() if k >= least)
        whole = {t: sum(n[lang, s][t] for s in sources) for t in kept}

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + scale * (count[t] + 2) // total for t in kept}

        p, q = {s: shares(n[lang, s]) for s in sources}, shares(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [w + x for w in ("Ab", "cd", "éF", "日本", "z\x7f", "\U0001f600", "\x85") for x in ("", "a", "Bb", "-q", "7x", " ")]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["web", "web", "web", "Web", "books", "", None, "é"])
        own = words if source != "books" else words[:20]
        rows.append((" ".join(rng.choice(own) for _ in range(rng.randrange(0, 40))), lang, source))
    return rows + [(None, "en", "web"), ("", "fr", "only"), ("rare words here", "fr", "other"), ("\n\t", "it", "alone"), ("a " * 200_000, "en", "long"), ("a", "en", "nul")] + [("same text", "xx", "s")] * 12


@pytest.mark.parametrize("least,top,shard_rows", [(10, 10, 250_000), (3, 4, 40)])
def test_equals_loops(spark, least, top, shard_rows):
    rows = corpus(300)
    got = S.divergence(spark.createDataFrame(rows, SCHEMA).repartition(5), least, top, shard_rows=shard_rows).collect()
    assert sorted(map(tuple, got)) == slow(rows, least, top)


def test_ties_are_ranked_by_item(spark):
    rows = [(f"{w} both", "en", s) for s, w in (("a", "x"), ("b", "y"), ("c", "z")) for _ in range(10)]
    got = sorted(map(tuple, S.divergence(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == slow(rows) and [r[3] for r in got if r[:3] == ("en", "a", "pair")] == ["b", "c"]


def test_empty_table_and_other_columns(spark):
    empty = S.divergence(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [("a b", "en", s) for s in ("p", "q") for _ in range(10)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "2 AS n", "3 AS part", "4 AS shard", "'x' AS `Value`")
    assert sorted(map(tuple, S.divergence(df).collect())) == slow(rows)


def test_counts_are_added_up_on_the_way(monkeypatch):
    rows = [(t or "", la or "", so or "") for t, la, so in corpus(200, 2)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("text", "lang", "source"), r)) for r in rows[i : i + 30]]) for i in range(0, len(rows), 30)]
    monkeypatch.setattr(S, "TEXT_BYTES", 300)
    whole, n_rows = Counter(), []
    for held in (1 << 20, 60):
        monkeypatch.setattr(S, "HELD_ROWS", held)
        total = Counter()
        parts = list(S._count_texts(iter(batches)))
        for b in parts:
            for r in b.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        n_rows.append(sum(b.num_rows for b in parts))
        kept = [tuple(r.values()) for b in S._keep(3)(iter(parts)) for r in b.to_pylist()]
        assert not whole or (whole == total and kept_before == sorted(kept))
        whole, kept_before = total, sorted(kept)
    assert n_rows[1] > n_rows[0]
