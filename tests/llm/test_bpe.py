import base64
import random

import public_tokenizers as P
import pytest
import tiktoken

from routeloom.llm.bpe import encode_documents, load

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def pair():
    path = P.path(NAME)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return load(path, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(7)
    fixed = ["", " ", "a", "a" * 5000, "ab" * 700, "\n\n \t x", "Étude déjà-vu naïve 漢字かな 🙂🙂🏽 don't 12345", "<|endoftext|>", "=" * 999, "\x1c\x1d a\x85\xa0b\u2028c\u200bd", " " * 300 + "x"]
    alphabet = "abcdefgh éèüñ  \n\t0123.,'漢🙂ABC"
    return fixed + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(300)]


def test_ids_equal_the_library_and_decode_back(pair):
    ours, theirs = pair
    for t in texts():
        ids = ours.encode(t)
        assert ids == theirs.encode_ordinary(t), repr(t[:80])
        assert ours.decode_bytes(ids) == t.encode()


def test_matrix_and_heap_agree(pair):
    ours, _ = pair
    pieces = [t.encode() for t in texts() if t and len(t) < 500]
    for p, ids in zip(pieces, ours.merge_matrix(pieces)):
        assert ids.tolist() == ours.merge_long(p)


def test_documents(spark, pair):
    import hashlib

    rows = [(1, "hello world", "x"), (2, None, "y"), (3, "", None), (3, "hello world", "z"), (None, "ñ" * 3000, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(encode_documents(df, P.path(NAME), P.PATTERN, with_ids=True).collect(), key=repr)
    assert len(got) == 5
    by_text = {hashlib.sha256((t or "").encode()).hexdigest(): t or "" for _, t, _ in rows}
    for r in got:
        text = by_text[r.decoded_sha256]
        want = pair[1].encode_ordinary(text)
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert encode_documents(df, P.path(NAME), P.PATTERN).collect() == []
