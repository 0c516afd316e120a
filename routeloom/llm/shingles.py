"""Distinct word shingles of texts as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from .packed import mix

_U = np.uint64
_FOLD = bytes(32 if c == 32 or 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}
_SPACE = re.compile(rb"[ \t-\r]")


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            a = np.full(size, _U(base))
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"][:n], _powers["down"][:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lower-cased, and its start byte."""
    data = np.frombuffer(b" " + raw.translate(_FOLD) + b" ", dtype=np.uint8)
    edge = np.flatnonzero((data[1:] != 32) != (data[:-1] != 32))
    start, end = edge[::2], edge[1::2]
    up, down = _power(len(data))
    total = np.zeros(len(data), dtype=np.uint64)
    np.cumsum(_BYTE[data[1:-1]] * up[: len(data) - 2], out=total[1:-1])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U)), start


def combine(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words."""
    n = len(words) - k + 1
    h = words[:n].copy()
    for i in range(1, k):
        h = mix(h * _U(0xD6E8FEB86659FD93) + words[i : i + n])
    return h


#: Texts up to this size are hashed together; a longer one by itself.
CHUNK_BYTES = 1 << 20


def shingle_sets(texts: Iterator[bytes], k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingles; fewer than ``k`` words make one shingle, none make none."""
    held: list[bytes] = []
    size = 0
    for raw in texts:
        held.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield from _sets(held, k)
            held, size = [], 0
    yield from _sets(held, k)


def _sets(held: list[bytes], k: int) -> Iterator[np.ndarray]:
    if not held:
        return
    if len(held) == 1 and len(held[0]) > 2 * CHUNK_BYTES:
        words = np.concatenate([word_hashes(x)[0] for x in _pieces(held[0])])
        yield _shingles(words, combine(words, k) if len(words) >= k else words[:0], k)
        return
    words, start = word_hashes(b"\n".join(held))
    bound = np.cumsum([0, *[len(x) + 1 for x in held]])
    at = np.searchsorted(start, bound)
    runs_ = combine(words, k) if len(words) >= k else words[:0]
    for a, b in zip(at, at[1:]):
        yield _shingles(words[a:b], runs_[a : max(a, b - k + 1)], k)


def _shingles(words: np.ndarray, hashes: np.ndarray, k: int) -> np.ndarray:
    if len(words) >= k:
        s = np.sort(hashes)
        return s[np.append(True, s[1:] != s[:-1])]
    return combine(words, len(words)) ^ _U(len(words)) if len(words) else words


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A long text cut at white space after every ``CHUNK_BYTES``."""
    at = 0
    while at < len(raw):
        space = _SPACE.search(raw, at + CHUNK_BYTES)
        end = space.start() if space else len(raw)
        yield raw[at:end]
        at = end
