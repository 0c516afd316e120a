import random
import re

import numpy as np
import pytest

from routeloom.llm import jaccard_join as J
from routeloom.llm.shingles import shingle_sets


def shingles(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k=4, percent=85):
    sets = [shingles(t, k) for _, t in rows]
    low = [r[0] for r in rows]
    key = lambda d: (-(2**63) if d is None else d)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            same = rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if same or (sets[i] and sets[j] and 100 * inter >= percent * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    best = {}
    for i in range(len(rows)):
        r = find(i)
        best[r] = low[i] if r not in best or key(low[i]) < key(best[r]) else best[r]
    return sorted(((rows[i][0], len(sets[i]), best[find(i)]) for i in range(len(rows))), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["É", "ß", "UPPER"]
    rows = []
    passage = " ".join(rng.choice(words) for _ in range(40))
    for i in range(n):
        if rows and rng.random() < 0.6:
            w = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 30, 150, 195, 210, 240, 400])))
            if rng.random() < 0.5:
                text += "\n" + passage
        rows.append((i, text))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one two"), (n + 4, "One\ttwo"), (n + 5, "a " * 3000), (None, rows[7][1]), (n + 6, rows[7][1].upper())]


def result(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, class string, n int").repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(df, **kw).collect()), key=repr)


def test_equals_brute_force(spark):
    rows = corpus(5)
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("block", [3, 20])
def test_five_words_at_eighty_percent_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "WIDE_BLOCK", 2 * block)
    rows = corpus(6, 80)
    assert result(spark, rows, words=5, percent=80) == brute(rows, 5, 80)


def near_threshold(seed, n=250):
    """Pairs of sets of 150 to 600 shingles whose similarity is one step above or below the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(20_000)]
    rows = []
    for i in range(n):
        size = rng.randrange(153, 604)
        a = rng.sample(words, size)
        r = round(0.15 / 1.85 * (size - 3)) + rng.choice([-1, 0, 1])
        b = a[: size - r] + rng.sample(words, r) if rng.random() < 0.5 else rng.sample(words, r) + a[r:]
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    return rows


def test_large_sets_at_the_threshold(spark):
    rows = near_threshold(8)
    want = brute(rows)
    assert 100 < sum(d != c for d, _, c in want) < 200
    assert result(spark, rows) == want
    assert result(spark, rows, fan=2) == want


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_linked_sets_share_posted_shingles(percent):
    """The bound that a class is judged by holds for every linked pair, and grows with the set."""
    m, rng = J.Measure(percent), np.random.default_rng(percent)
    assert all(m.beyond(n) <= m.beyond(n + 1) and m.shared(n) <= m.beyond(n) and m.posted(n) <= n for n in range(1, 3000))
    for _ in range(400):
        n = int(rng.integers(1, 900))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        out = int(rng.integers(0, m.misses(len(a)) + 1))
        kept = np.sort(rng.choice(a, len(a) - out, replace=False)) if rng.random() < 0.5 else a[out:]
        new = rng.integers(0, 2**63, max(0, 100 * len(kept) // percent - len(a)), dtype=np.uint64) >> np.uint64(rng.integers(0, 3))
        b = np.unique(np.concatenate([kept, new]))
        inter = len(np.intersect1d(a, b))
        if m.linked(inter, len(a), len(b)):
            both = len(np.intersect1d(a[: m.posted(len(a))], b[: m.posted(len(b))]))
            assert both >= max(m.shared(len(a)), m.shared(len(b)))


def test_a_long_text_has_the_shingles_of_its_words():
    from routeloom.llm import shingles as S

    text = " ".join(f"w{i % 5000}\t{i % 7}" for i in range(40_000))
    whole, size = next(shingle_sets(iter([text.encode()]), 4)), S.CHUNK_BYTES
    try:
        S.CHUNK_BYTES = 1000
        assert (next(shingle_sets(iter([text.encode()]), 4)) == whole).all()
    finally:
        S.CHUNK_BYTES = size
    assert len(whole) == len(shingles(text))


def test_many_documents_of_one_class_and_none(spark):
    rows = [(i, None if i % 3 == 0 else "one text that many documents have word for word") for i in range(3000)]
    assert result(spark, rows) == brute_classes(rows)


def brute_classes(rows):
    low = {}
    for d, t in rows:
        low.setdefault(t, d)
    return sorted(((d, len(shingles(t)), low[t] if t else d) for d, t in rows), key=repr)


def test_empty_table(spark):
    assert result(spark, []) == []


@pytest.mark.parametrize("seed", range(12))
def test_tree_gives_the_components_of_all_links(seed):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 3000, rng.integers(1, 120)).astype(np.uint64) for _ in range(6)]
    sets = []
    for _ in range(60):
        s = base[rng.integers(0, 6)].copy()
        for _ in range(rng.integers(0, 1 + len(s) // 6)):
            s[rng.integers(0, len(s))] = rng.integers(0, 3000)
        sets.append(np.unique(s))
    m = J.Measure(85)
    root = list(range(60))

    def find(root, x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(60):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if m.linked(inter, len(sets[i]), len(sets[j])):
                root[find(root, i)] = find(root, j)
    got = list(range(60))
    for a, b in J.spanning_links(sets, m):
        assert m.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
        got[find(got, a)] = find(got, b)
    label = lambda r: [min(j for j in range(60) if find(r, j) == find(r, i)) for i in range(60)]
    assert label(got) == label(root)


def test_shingle_counts():
    texts = [t or "" for _, t in corpus(1)]
    for t, s in zip(texts, shingle_sets((x.encode() for x in texts), 4)):
        assert len(s) == len(shingles(t))
