"""Plain Python versions of the contracts."""

import re
from collections import defaultdict

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
    n = len(w)
    return {
        "n_words": n,
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": n < 50 or 100 * len(hit) > 50 * n,
    }


def kept(text):
    m, text = measures(text), text or ""
    capital = sum(1 for c in text if re.match(r"[^\W\d_]", c) and c.isupper())
    import unicodedata

    solid = sum(1 for c in text if unicodedata.category(c)[0] in "LMN")
    return not (
        m["base_failed"]
        or m["word_chars"] < 2 * m["n_words"]
        or m["word_chars"] > 15 * m["n_words"]
        or 10 * m["n_symbols"] > 3 * m["n_words"]
        or 2 * m["n_dup_lines"] > len(text.split("\n"))
        or 2 * capital > m["word_chars"]
        or 2 * solid < m["word_chars"]
    )


def line_dedup(rows):
    """[(doc_id, kept lines, lines)] of (doc_id, text)."""
    holders = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UP)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = []
        for x in lines:
            h = holders.get(key(x), ())
            keeper = max((i for i in h if i is not None), default=None)
            if len(h) < 3 or d == keeper:
                stay.append(x)
        out.append((d, stay, lines))
    return out


def contamination(rows, items, window=13):
    """(doc_id, n_words, n_hit, item ids, contaminated) of (doc_id, text)."""
    patterns = defaultdict(set)
    for i, t in items:
        w = tuple(BENCH.findall((t or "").translate(UP)))
        if w:
            for k in range(max(1, len(w) - window + 1)):
                patterns[w[k : k + window]].add("" if i is None else str(i))
    sizes = {len(p) for p in patterns}
    out = []
    for d, t in rows:
        w = tuple(BENCH.findall((t or "").translate(UP)))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if w[k : k + n] in patterns:
                    hit.update(range(k, k + n))
                    found |= patterns[w[k : k + n]]
        out.append((d, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out
