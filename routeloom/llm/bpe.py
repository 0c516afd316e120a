"""Byte-level BPE encoding and decoding on padded numpy matrices.

A text is split by the tokenizer's pattern.  The distinct pieces of a batch that
aren't known yet are bucketed by byte length and laid out as padded matrices of
token ids, one piece to a row.  In each round every live row merges its leftmost
pair of lowest rank; pair ranks come from an open-addressing hash table in numpy;
rows without a mergeable pair leave the matrix, and merged rows are compacted.

A row of n bytes needs up to n rounds, so pieces over ``LONG_PIECE`` bytes (runs
of one character, base64) go through a heap that makes the same merges in
O(n log n).

Memory.  A task holds the pair table (a few MB), a cache bounded by
``CACHE_PIECES`` and ``CACHE_CHARS``, and one slice of its Arrow batch with the ids
of its texts.  The operator is a map:
no shuffle, and a lost executor costs only its own tasks.

Defined results.  A null or empty text has no tokens; its decoded text is empty.
Equal ranks can't occur, so there are no ties but by place: the leftmost pair merges.
Repeated rows are each returned; an empty table gives an empty result.  Only doc_id
and text are read, so other columns neither clash nor pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, table

#: Longest piece, in bytes, that is merged in a matrix.
LONG_PIECE = 64
#: Pieces remembered in one Python worker, and characters of them and their ids.
CACHE_PIECES, CACHE_CHARS = 400_000, 64 << 20
NO_RANK = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> merged id, by open addressing over numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NO_RANK, dtype=np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[slot[todo]] == np.uint64(2**64 - 1)
            first = todo[free]
            _, once = np.unique(slot[first], return_index=True)
            put = first[once]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], merged[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NO_RANK where the pair doesn't merge."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slot = self._slot(keys)
        out = np.full(len(keys), NO_RANK, dtype=np.int32)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            at = self.keys[slot]
            hit = at == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            more = ~hit & (at != np.uint64(2**64 - 1))
            if not more.any():
                break
            todo, slot = todo[more], (slot[more] + 1) & self.mask
        return out


class Bpe:
    """Encoder and decoder for one rank file.  Ids are ranks, as in the library."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.find_pieces = ranks, regex.compile(pattern).findall
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(*(np.array(x, dtype=np.int64) for x in (left, right)), np.array(merged, dtype=np.int32))
        #: piece -> its ids as text, and such text -> the bytes that its ids decode to
        self.cache: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.held = 0

    # -- merging ---------------------------------------------------------

    def merge_matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length, all rows merging at once."""
        n, width = len(pieces), max(map(len, pieces))
        length = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        flat = self.byte_id[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ids = np.full((n, width), -1, dtype=np.int32)
        ids[np.arange(width) < length[:, None]] = flat
        out: list[np.ndarray] = [None] * n  # type: ignore[list-item]
        row = np.arange(n)
        rank = self._pair_ranks(ids, length)
        while len(row):
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), dtype=np.int64)
            low = rank[np.arange(len(row)), best] if rank.shape[1] else np.full(len(row), NO_RANK)
            live = low != NO_RANK
            if not live.all():
                for r in np.flatnonzero(~live):
                    out[row[r]] = ids[r, : length[r]].copy()
                ids, rank, length, row, best, low = (x[live] for x in (ids, rank, length, row, best, low))
                if not len(row):
                    break
            # Compaction: columns after the merged pair move one to the left.
            k, cols = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            src = cols + (cols > best[:, None])
            ids = np.take_along_axis(ids, src, axis=1)
            ids[k, best] = low
            length = length - 1
            src = src[:, : rank.shape[1] - 1]
            rank = np.take_along_axis(rank, src, axis=1)
            if rank.shape[1]:
                for at in (best - 1, best):
                    ok = (at >= 0) & (at + 1 < length) & (at < rank.shape[1])
                    r, c = k[ok], at[ok]
                    rank[r, c] = self.pairs.find(ids[r, c], ids[r, c + 1])
                past = (best + 1 >= length) & (best < rank.shape[1])
                rank[k[past], best[past]] = NO_RANK
        return out

    def _pair_ranks(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        rank = np.full((len(ids), max(ids.shape[1] - 1, 0)), NO_RANK, dtype=np.int32)
        inside = np.arange(rank.shape[1]) + 1 < length[:, None]
        r, c = np.nonzero(inside)
        rank[r, c] = self.pairs.find(ids[r, c], ids[r, c + 1])
        return rank

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges over a linked list and a heap of (rank, position)."""
        ranks = self.ranks
        start = list(range(len(piece)))
        end = [i + 1 for i in start]
        nxt, prv = [i + 1 for i in start], [i - 1 for i in start]
        alive = bytearray(b"\1" * len(piece))
        n = len(piece)

        def rank_at(i: int) -> int | None:
            j = nxt[i]
            return ranks.get(piece[start[i] : end[j]]) if j < n else None

        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank_at(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, mid, stop = heapq.heappop(heap)
            if not alive[i] or end[i] != mid or nxt[i] >= n or end[nxt[i]] != stop:
                continue
            j = nxt[i]
            alive[j] = 0
            end[i], nxt[i] = end[j], nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for k in (prv[i], i):
                if k >= 0 and (r := rank_at(k)) is not None:
                    heapq.heappush(heap, (r, k, end[k], end[nxt[k]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = nxt[i]
        return out

    # -- encoding --------------------------------------------------------

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces into the cache."""
        new = [p for p in pieces if p not in self.cache]
        raw = [p.encode() for p in new]
        order = sorted(range(len(new)), key=lambda i: len(raw[i]))
        at = 0
        while at < len(order):
            size = len(raw[order[at]])
            if size > LONG_PIECE:
                for i in order[at:]:
                    self._keep(new[i], self.merge_long(raw[i]))
                break
            # Bucket: lengths up to a quarter above the shortest, at most 20,000 rows.
            stop = at
            while stop < len(order) and stop - at < 20_000 and len(raw[order[stop]]) <= min(size + size // 4, LONG_PIECE):
                stop += 1
            group = order[at:stop]
            for i, ids in zip(group, self.merge_matrix([raw[i] for i in group])):
                self._keep(new[i], ids.tolist())
            at = stop

    def _keep(self, piece: str, ids: list[int]) -> None:
        text = self.cache[piece] = ",".join(map(str, ids))
        self.held += 2 * (len(piece) + len(text))
        if text not in self.decoded:
            self.decoded[text] = self.decode_bytes(ids)

    def encode_batch(self, texts: list[str]) -> list[list[str]]:
        """For each text the ids of its pieces, each piece's as decimals joined by commas."""
        if len(self.cache) > CACHE_PIECES or self.held > CACHE_CHARS:
            self.cache.clear()
            self.decoded.clear()
            self.held = 0
        split = [self.find_pieces(t) for t in texts]
        self.learn(set().union(*split))
        return [list(map(self.cache.__getitem__, pieces)) for pieces in split]

    def decode_batch(self, encoded: list[list[str]]) -> list[bytes]:
        """The bytes of id runs that ``encode_batch`` gave, decoded run by run."""
        return [b"".join(map(self.decoded.__getitem__, runs)) for runs in encoded]

    def encode(self, text: str) -> list[int]:
        return [int(i) for x in self.encode_batch([text])[0] for i in x.split(",")]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Bpe(ranks, pattern)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows that hold about ``max_bytes`` of ``column``, a row at least."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    block = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def encode_documents(df: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for each row of ``df``.

    ``ids`` (``with_ids``) are the token ids as an array; ``decoded_sha256`` is
    over the bytes that decoding those ids gives.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                encoded = bpe.encode_batch(batch.column("text").to_pylist())
                joined = [",".join(x) for x in encoded]
                cols = [
                    batch.column("doc_id"),
                    pa.array([x.count(",") + 1 if x else 0 for x in joined], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in joined], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in bpe.decode_batch(encoded)], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    ids = [[int(i) for i in x.split(",")] if x else [] for x in joined]
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return documents(df).mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents and the bytes that they decode to, as digests.

    Nulls, long texts and pieces, repeated rows, empty tables and other columns: see the module.
    """
    import public_tokenizers as P

    return encode_documents(table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
