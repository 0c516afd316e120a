import base64
import hashlib
import os
import random
import sys

import public_tokenizers as P
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402
from test_jaccard_join import brute as components  # noqa: E402

import corpus_pipeline  # noqa: E402


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 8))) for _ in range(500)]
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    lines = [sentence(12) for _ in range(4)]
    item = sentence(30)
    rows = []
    for i in range(90):
        if i % 4 == 3:
            w = rows[-1][1].split(" ")
            w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        else:
            text = "\n".join([sentence(rng.randrange(40, 90)), rng.choice(lines), sentence(20)])
        if i % 11 == 5:
            text += "\n" + item
        rows.append((i, text, "en", "src", len(text)))
    rows += [(100, None, None, None, None), (101, "", "en", None, 0), (102, "too short", "en", "s", 9), (3, rows[3][1], "en", "src", 1), (103, "A!! " * 80, "en", "s", 1)]
    return rows, [(1, item), (2, None)]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("source", "n_words").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = [(r[0], r[1]) for r in rows if brute.kept(r[1])]
    docs = [(d, "\n".join(s)) for d, s, _ in brute.line_dedup(docs)]
    root = {d: c for d, _, c in components(docs, 5, 80)}
    docs = sorted({(d, t) for d, t in docs if root[d] == d})
    bad = {d for d, *_, c in brute.contamination(docs, items) if c}
    docs = [x for x in docs if x[0] not in bad]
    assert 10 < len(docs) < 80 and bad
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(corpus_pipeline.TOKENIZER), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for d, t in docs:
        ids = enc.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got)) == sorted(want)


def test_stages_keep_the_columns(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for some in (rows, []):
        df = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, str(tmp_path))
            assert df.columns == names
        assert (df.count() > 0) == bool(some)


def test_different_texts_under_null_and_repeated_ids_stay(spark, tmp_path):
    rng = random.Random(5)
    new = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    near = lambda t: t.rsplit(" ", 1)[0] + " changed"
    a, b, c, d, e, f = (new() for _ in range(6))
    keep = [(None, a), (None, b), (None, c), (7, d), (7, e), (9, f), (None, None), (None, ""), (12, None), (12, "")]
    gone = [(3, near(a)), (8, near(d)), (10, near(f)), (11, near(near(b))), (9, near(c)), (None, b), (7, e), (12, "")]
    rows = [(*x, "en") for x in keep + gone]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(keep, key=repr)

    # Linked texts under a null id are still one document.
    rows = [(None, a, "en"), (None, near(a), "en"), (None, b, "en")]
    got = [r.text for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"), str(tmp_path)).collect()]
    assert len(got) == 2 and b in got
