"""Exact n-gram Jaccard join and its components, by prefix trees.

Steps, each over all rows:

1. Each text becomes a sorted set of shingle hashes.  Equal sets are one class.
2. A class of n shingles posts its first ones in hash order: all of them up to
   ``SMALL_SET``, else as many as a linked set may lack, and l(n) more.  Of two
   linked classes the one whose posted part ends first in that order has all but
   those it may lack of it in common with the other's posted part, so the two
   share l of the smaller of them, at least.  A posted shingle is *live* if a
   second class posts it; a class with fewer live ones than any linked class would
   share leaves.  This needs no pairs, and removes all but near copies and texts
   made of common passages.  Nothing here hangs on chance: see ``Measure.shared``.
3. Remaining classes order their live shingles by document frequency.  By the
   prefix-filter argument two linked classes share one of their first shingles, so
   components of "share a prefix shingle" hold all links; common passages stand
   last in the order and tie nothing together.
4. The full sets of each such cluster meet in one task.  A large cluster meets in
   blocks: first every block with the first one, then whatever stands outside the
   largest component found so with every block, so a group of near copies of any
   size costs work in proportion to it.  The task stores the globally ordered sets in a
   prefix tree with compressed edges.  A probe descends level by level, sharing
   the partial overlap of common beginnings, and prunes a subtree when even all
   that remains of the probe and of the subtree's longest set can't reach the
   overlap required, or when all its sets are in the probe's component already.
   Each class probes once, so copies by the thousand cost one descent each and
   give a spanning tree of links, not all pairs.
5. Links become components; every document gets its class's component.

Scale.  Postings are packed numpy columns sent as frames (see ``packed``) to buckets
of hashes; a shingle that is common within a map batch is sent as one flag, so no
bucket gathers a row for each of its documents.  Of a class a batch sends one
document, however many it has; the documents themselves are not dealt by class, and
classes get their smallest one by a partial minimum.  Texts cross the network once,
to bring the sets of clustered classes to their clusters.

Defined results.  Null and empty texts have no shingles, and are alone.  A null
doc_id counts as smaller than all others.  Rows of one doc_id are linked by their
own texts; repeated rows are all returned.  An empty table gives an empty result.  Only
doc_id and text are read, so other columns neither clash nor pass through.
Shingles are compared by 64 bits of hash, classes by 64 bits of their sets.  A long
text is hashed in pieces; its shingles are held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import components
from .common import materialize, table
from .packed import ROW, Frames, cells, exchange, frames, mix, pack, runs, split_by, unpack
from .shingles import shingle_sets

_U = np.uint64
NULL_ID = -(2**63)
#: Sets up to this size post all shingles; larger ones this share of theirs beyond what a linked set may lack.
SMALL_SET, MORE = 200, 15
#: Classes of a batch that may share a shingle before it is sent as a flag, and shingles of a batch.
COMMON, BATCH_SHINGLES = 64, 1_500_000
COMMON_LEVEL = 2**31 - 1
#: Text bytes for each bucket of the packed exchanges.
BUCKET_BYTES = 12 << 20
#: Classes in a block of a cluster, at least and, where many are left open, at most; and shingles in a
#: block.  Two blocks meet in one task.
BLOCK, WIDE_BLOCK, BLOCK_SHINGLES = 64, 2048, 1_500_000
#: Edges whose components are one task's work.
SMALL_GRAPH = 200_000
POST, LIVE, FIRST, DOC, EDGE = range(5)


class Measure:
    """The link test 100 * inter >= percent * union, in integers."""

    def __init__(self, percent: int):
        self.percent = percent

    def misses(self, n):
        """Shingles of a set of ``n`` that a linked set may lack."""
        return n - -(-self.percent * n // 100)

    def least(self, n):
        return -(-self.percent * n // 100)

    def most(self, n):
        return 100 * n // self.percent

    def beyond(self, n: int) -> int:
        """l(n): posted shingles beyond those that a linked set may lack; grows with n."""
        return self.least(n) if n <= SMALL_SET else min(self.least(n), max(self.least(SMALL_SET), -(-MORE * n // 100)))

    def posted(self, n: int) -> int:
        return self.misses(n) + self.beyond(n)

    def shared(self, n: int) -> int:
        """Posted shingles that a class of n has in common with any class it links with, at least.

        A class that posts its whole set loses nothing by where the other's part ends;
        a larger one may meet another that posts in part, of ``least(n)`` shingles or more.
        """
        return self.beyond(n) if n <= SMALL_SET else self.beyond(max(SMALL_SET + 1, self.least(n)))

    def linked(self, inter, n, m):
        return 100 * inter >= self.percent * (n + m - inter)

    def required(self, n, m):
        """Smallest overlap of linked sets of n and m."""
        return -(-self.percent * (n + m) // (100 + self.percent))


def set_key(s: np.ndarray) -> int:
    """64 bits over a whole set; 0 only for the empty one."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        h = mix(s * _U(0xA24BAED4963EE407) + _U(len(s)))
        key = mix(np.array([h.sum(dtype=_U) ^ np.bitwise_xor.reduce(mix(h))]))[0]
    return int(key.astype(np.int64)) or 1


def _bucket(x: np.ndarray, n: int) -> np.ndarray:
    return (mix(x.view(_U)) % _U(n)).astype(np.int64)


def _send(out: Frames, kind: int, by: np.ndarray, columns: list[np.ndarray], n_buckets: int) -> None:
    """Columns packed for the buckets of ``by``."""
    if len(by):
        for b, at in split_by(_bucket(by, n_buckets)):
            out.add(b, 0, kind, pack([c[at] for c in columns]))


def _by_kind(tables: Iterator[pa.RecordBatch]) -> dict[int, list]:
    found: dict[int, list] = {}
    for _, _, kind, payload in frames(cells(tables)):
        found.setdefault(kind, []).append(unpack(payload))
    return found


def _post(k: int, m: Measure, n_buckets: int, fan: int | None):
    """Rows (doc_id, row, text) -> postings by shingle, a document of each class by class, documents."""

    def finish(docs: list, tokens: list, classes: list) -> pa.RecordBatch:
        out = Frames(n_buckets, fan)
        if docs:
            ids, rows, cls, n = (np.array(x, dtype=np.int64) for x in zip(*docs))
            # Documents only pass through: a batch's stay together, wherever that is.
            out.add(int(_bucket(rows[:1], n_buckets)[0]), 0, DOC, pack([ids, rows, cls, n]))
            order = np.lexsort((rows, ids, cls))
            lead = order[runs(cls[order])[:-1]]
            lead = lead[n[lead] > 0]
            _send(out, FIRST, cls[lead], [x[lead] for x in (ids, rows, cls, n)], n_buckets)
        if tokens:
            token, cls = np.concatenate(tokens), np.concatenate(classes)
            order = np.lexsort((cls, token))
            token, cls = token[order], cls[order]
            cut = runs(token)
            size = np.diff(cut)
            common = np.repeat(size > COMMON, size)
            first = np.zeros(len(token), dtype=bool)
            first[cut[:-1]] = True
            # A common shingle is live for its classes here; other batches need only hear of it.
            _send(out, LIVE, cls[common], [cls[common], token[common], np.full(int(common.sum()), COMMON_LEVEL, np.int32)], n_buckets)
            send = ~common | first
            token, cls, common = token[send], cls[send], common[send]
            _send(out, POST, token, [token, cls, common.astype(np.uint8)], n_buckets)
        return out.record()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, tokens, classes, seen, size, keep = [], [], [], set(), 0, []

        def texts():
            for b in batches:
                for doc_id, row, text in zip(b.column("doc_id"), b.column("row"), b.column("text")):
                    keep.append((NULL_ID if not doc_id.is_valid else doc_id.as_py(), row.as_py()))
                    yield text.as_buffer().to_pybytes() if text.is_valid else b""

        done = 0
        for s in shingle_sets(texts(), k):
            doc_id, row = keep[done]
            done += 1
            if done > 4096:
                del keep[:done]
                done = 0
            key, n = set_key(s), len(s)
            docs.append((doc_id, row, key, n))
            if n and key not in seen:
                seen.add(key)
                tokens.append(s[: m.posted(n)])
                classes.append(np.full(len(tokens[-1]), key, dtype=np.int64))
                size += len(tokens[-1])
            if size >= BATCH_SHINGLES or len(docs) >= BATCH_SHINGLES // 8:
                yield finish(docs, tokens, classes)
                docs, tokens, classes, seen, size = [], [], [], set(), 0
        yield finish(docs, tokens, classes)

    return run


def _find_live(n_buckets: int, fan: int | None):
    """Bucket of shingles: which are in two classes or more, told to their classes."""

    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, parts = Frames(n_buckets, fan), []
        for to, source, kind, payload in frames(cells(tables)):
            if kind == POST:
                parts.append(unpack(payload))
            else:
                out.add(to, source, kind, payload)
        if parts:
            token, cls, common = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((cls, token))
            token, cls, common = token[order], cls[order], common[order]
            new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))
            cut = runs(token)
            df = np.add.reduceat(new.astype(np.int64), cut[:-1])
            flag = np.add.reduceat(common.astype(np.int64), cut[:-1]) > 0
            level = np.repeat(np.where(flag, COMMON_LEVEL, df), np.diff(cut)).astype(np.int32)
            tell = new & (level > 1)
            _send(out, LIVE, cls[tell], [cls[tell], token[tell], level[tell]], n_buckets)
        yield out.record()

    return run


_CLASS = "kind int, class long, doc_id long, row long, n long, tokens binary"


def _judge(m: Measure):
    """Bucket of classes: documents (kind 0) and, of classes that may link, one with a prefix (kind 1)."""

    def rows(kind: int, ids, own, cls, n, tokens: list) -> pa.RecordBatch:
        cols = [pa.array(np.full(len(ids), kind), pa.int32()), *(pa.array(x, pa.int64()) for x in (cls, ids, own, n)), pa.array(tokens, pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["kind", "class", "doc_id", "row", "n", "tokens"])

    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _by_kind(tables)
        for ids, own, cls, n in found.pop(DOC, []):
            yield rows(0, ids, own, cls, n, [None] * len(ids))
        if LIVE not in found or FIRST not in found:
            return
        lc, lt, ll = (np.concatenate(x) for x in zip(*found.pop(LIVE)))
        order = np.lexsort((lt, lc))
        lc, lt, ll = lc[order], lt[order], ll[order]
        new = np.append(True, (lc[1:] != lc[:-1]) | (lt[1:] != lt[:-1]))
        at = np.flatnonzero(new)
        ll = np.maximum.reduceat(ll, at)
        lc, lt = lc[at], lt[at]
        ids, own, cls, n = (np.concatenate(x) for x in zip(*found.pop(FIRST)))
        order = np.lexsort((own, ids, cls))
        lead = order[runs(cls[order])[:-1]]
        a, b = np.searchsorted(lc, cls[lead]), np.searchsorted(lc, cls[lead], side="right")
        able, prefixes = [], []
        for d, x, y in zip(lead.tolist(), a.tolist(), b.tolist()):
            least = m.shared(int(n[d]))
            if y - x < least:
                continue
            token, level = lt[x:y], ll[x:y]
            able.append(d)
            prefixes.append(pack([np.sort(token[np.lexsort((token, level))[: y - x - least + 1]])]))
        yield rows(1, *(v[able] for v in (ids, own, cls, n)), prefixes)

    return run


def _edges_here(token: np.ndarray, cls: np.ndarray):
    """Star edges of each shingle's classes, and one posting for each shingle."""
    order = np.lexsort((cls, token))
    token, cls = token[order], cls[order]
    cut = runs(token)
    hub = np.repeat(cls[cut[:-1]], np.diff(cut))
    apart = cls != hub
    pairs = np.unique(np.stack([cls[apart], hub[apart]], axis=1), axis=0)
    return pairs, token[cut[:-1]], cls[cut[:-1]]


def _post_prefixes(n_buckets: int, fan: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, classes, size = [], [], 0

        def finish() -> pa.RecordBatch:
            out = Frames(n_buckets, fan)
            if tokens:
                pairs, token, cls = _edges_here(np.concatenate(tokens), np.concatenate(classes))
                _send(out, POST, token, [token, cls], n_buckets)
                a, b = np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])
                _send(out, EDGE, a, [a, b], n_buckets)
            return out.record()

        for batch in batches:
            for cls, data in zip(batch.column("class").to_pylist(), batch.column("tokens")):
                (t,) = unpack(data.as_buffer().to_pybytes())
                tokens.append(t)
                classes.append(np.full(len(t), cls, dtype=np.int64))
                size += len(t)
                if size >= BATCH_SHINGLES:
                    yield finish()
                    tokens, classes, size = [], [], 0
        yield finish()

    return run


def _make_edges(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = _by_kind(tables)
    pairs = [np.stack(x, axis=1) for x in found.get(EDGE, [])]
    if POST in found:
        pairs.append(_edges_here(*(np.concatenate(x) for x in zip(*found[POST])))[0])
    if pairs:
        p = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(p[:, 0].copy()), pa.array(p[:, 1].copy())], ["a", "b"])


# -- the prefix tree ---------------------------------------------------------


class PrefixTree:
    """Ordered sets in a tree with compressed edges, held level by level in arrays."""

    def __init__(self, sets: list[np.ndarray], m: Measure):
        self.m, self.sizes = m, np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, _U)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        distinct, token, df = np.unique(flat, return_inverse=True, return_counts=True)
        # Frequent first, so that near copies share long beginnings; a shingle of one set can't be shared.
        rank = np.empty(len(distinct), dtype=np.int64)
        rank[np.lexsort((distinct, -df))] = np.arange(len(distinct))
        shared = df[token] > 1
        token, owner = rank[token[shared]], owner[shared]
        self.n_tokens = int((df > 1).sum())
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        cut = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.paths = [token[a:b] for a, b in zip(cut, cut[1:])]
        self._build()

    def _build(self) -> None:
        order = sorted(range(len(self.paths)), key=lambda i: self.paths[i].tolist())
        self.leaf_order = np.array(order, dtype=np.int64)
        paths = [self.paths[i] for i in order]
        lcp = [0] * (len(paths) + 1)
        for i in range(1, len(paths)):
            a, b = paths[i - 1], paths[i]
            k = min(len(a), len(b))
            ne = np.flatnonzero(a[:k] != b[:k])
            lcp[i] = int(ne[0]) if len(ne) else k
        # Nodes as (level, first leaf, last leaf + 1, from depth, to depth); sets that end at a
        # node's depth are leaves in its range of exactly that length.
        seg, lo, hi, d0, d1, parent = [], [], [], [], [], []
        levels: list[list[int]] = []
        work = [(0, len(paths), 0, -1, 0)] if paths else []
        while work:
            a, b, depth, up, level = work.pop()
            end = min(lcp[a + 1 : b]) if b - a > 1 else len(paths[a])
            node = len(seg)
            seg.append(paths[a][depth:end])
            lo.append(a)
            hi.append(b)
            d0.append(depth)
            d1.append(end)
            parent.append(up)
            while len(levels) <= level:
                levels.append([])
            levels[level].append(node)
            if b - a > 1:
                start = a
                for i in range(a + 1, b + 1):
                    if i == b or lcp[i] == end:
                        if not (i - start == 1 and len(paths[start]) == end):
                            work.append((start, i, end, node, level + 1))
                        start = i
        self.lo, self.hi, self.d1, self.parent = (np.array(x, dtype=np.int64) for x in (lo, hi, d1, parent))
        self.levels = [np.array(x, dtype=np.int64) for x in levels]
        self.seg_len = np.array([len(s) for s in seg], dtype=np.int64)
        self.seg_at = np.cumsum(self.seg_len) - self.seg_len
        self.seg = np.concatenate(seg) if seg else np.zeros(0, np.int64)
        self.last = np.array([s[-1] if len(s) else -1 for s in seg], dtype=np.int64)
        length = np.array([len(p) for p in paths], dtype=np.int64)
        size = self.sizes[self.leaf_order] if len(order) else np.zeros(0, np.int64)
        n = len(seg)
        self.rest = np.array([length[lo[i] : hi[i]].max() - d1[i] for i in range(n)], dtype=np.int64)
        self.small = np.array([size[lo[i] : hi[i]].min() for i in range(n)], dtype=np.int64)
        self.big = np.array([size[lo[i] : hi[i]].max() for i in range(n)], dtype=np.int64)
        self.length, self.size = length, size

    def probe(self, path: np.ndarray, n: int, wanted: np.ndarray) -> np.ndarray:
        """Positions in leaf order of the wanted sets that link with a set of size n over ``path``."""
        inside = np.zeros(self.n_tokens + 1, dtype=np.int64)
        inside[path] = 1
        have = np.cumsum(inside)
        open_leaves = np.concatenate([[0], np.cumsum(wanted)])
        left = open_leaves[self.hi] - open_leaves[self.lo]
        shortest, longest = self.m.least(n), self.m.most(n)
        partial = np.zeros(len(self.lo), dtype=np.int64)
        alive = np.zeros(len(self.lo) + 1, dtype=bool)
        alive[-1] = True  # above the root
        hits = []
        for level in self.levels:
            at = level[alive[self.parent[level]]]
            at = at[(left[at] > 0) & (self.small[at] <= longest) & (self.big[at] >= shortest)]
            if not len(at):
                break
            size = self.seg_len[at]
            gather = np.repeat(self.seg_at[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            got = np.concatenate([[0], np.cumsum(inside[self.seg[gather]])])
            stop = np.cumsum(size)
            above = np.where(self.parent[at] >= 0, partial[self.parent[at]], 0)
            partial[at] = above + got[stop] - got[stop - size]
            # What remains of the probe lies after the node's last shingle in the order.
            last = np.where(size > 0, self.last[at], -1)
            mine = len(path) - np.where(last >= 0, have[last], 0)
            bound = partial[at] + np.minimum(mine, self.rest[at])
            at = at[bound >= self.m.required(n, np.maximum(self.small[at], shortest))]
            alive[at] = True
            if len(at):
                # Sets that end here: the whole range of a leaf, or the first leaf of an inner node.
                first = self.lo[at]
                ends = (self.length[first] == self.d1[at]) & wanted[first]
                f, p = first[ends], partial[at][ends]
                hits.append(f[self.m.linked(p, n, self.size[f])])
                same = (self.hi[at] - first > 1) & (self.length[first] == self.d1[at])
                for i in np.flatnonzero(same):
                    more = np.arange(first[i] + 1, self.hi[at[i]])
                    more = more[(self.length[more] == self.d1[at[i]]) & wanted[more]]
                    hits.append(more[self.m.linked(partial[at[i]], n, self.size[more])])
        return np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)


def spanning_links(sets: list[np.ndarray], m: Measure) -> list[tuple[int, int]]:
    """Links that join the sets into exactly the components of all links."""
    tree = PrefixTree(sets, m)
    n = len(sets)
    wanted = np.ones(n, dtype=bool)
    links = []
    for start in range(n):
        if not wanted[start]:
            continue
        wanted[start] = False
        queue = [start]
        while queue and wanted.any():
            at = queue.pop()
            x = int(tree.leaf_order[at])
            for hit in tree.probe(tree.paths[x], int(tree.sizes[x]), wanted).tolist():
                wanted[hit] = False
                queue.append(hit)
                links.append((x, int(tree.leaf_order[hit])))
    return links


def _join_cluster(percent: int):
    m = Measure(percent)

    def run(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, sets = [], []
        for b in tables:
            classes += b.column("class").to_pylist()
            sets += [np.frombuffer(x.as_buffer().to_pybytes(), dtype=_U) for x in b.column("shingles")]
        order = sorted(range(len(classes)), key=classes.__getitem__)
        order = [i for k, i in enumerate(order) if not k or classes[i] != classes[order[k - 1]]]
        links = spanning_links([sets[i] for i in order], m)
        yield pa.RecordBatch.from_arrays([pa.array([classes[order[x]] for x, _ in links], pa.int64()), pa.array([classes[order[y]] for _, y in links], pa.int64())], ["a", "b"])

    return run


def _full_sets(k: int):
    """Rows (cluster, i, j, class, text) with the text replaced by its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                b = whole.slice(start, 256)
                sets = [s.tobytes() for s in shingle_sets((x.as_buffer().to_pybytes() for x in b.column("text")), k)]
                yield pa.RecordBatch.from_arrays([b.column(c) for c in ("cluster", "i", "j", "class")] + [pa.array(sets, pa.binary())], ["cluster", "i", "j", "class", "shingles"])

    return run


def _blocks(classes: F.Column, shingles: F.Column, size: F.Column) -> F.Column:
    return F.greatest(F.ceil(classes / size), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _meet(docs: DataFrame, spread: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) among the classes that share a task; ``spread`` lists each class's tasks in ``at``."""
    where = spread.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__id"), F.col("row").alias("__row"), "class", "cluster", "at")
    full = (
        docs.withColumn("__k", F.coalesce("doc_id", F.lit(NULL_ID)))
        .join(where.hint("merge"), (F.col("__k") == F.col("__id")) & (F.col("row") == F.col("__row")))
        .select("cluster", "class", "text", F.explode("at").alias("at"))
        .select("cluster", "at.i", "at.j", "class", "text")
        .mapInArrow(_full_sets(words), "cluster long, i int, j int, class long, shingles binary")
    )
    return full.groupBy("cluster", "i", "j").applyInArrow(_join_cluster(percent), "a long, b long")


def _second_round(member: DataFrame, links: DataFrame) -> DataFrame:
    """Tasks for what the first round left open in clusters of several blocks.

    Classes of a cluster's largest component need not meet one another again; all
    others meet every block, in blocks of their own.  The fewer they are, the smaller
    the blocks that come to them.
    """
    root = components(links, "jaccard-first", SMALL_GRAPH).select(F.bitwise_not("node").alias("__c"), F.col("root").alias("r"))
    big = member.filter("blocks > 1").withColumn("__n", F.bitwise_not("class")).join(root, F.col("__n") == F.col("__c"), "left").withColumn("r", F.coalesce("r", "class")).drop("__n", "__c")
    big = materialize(big, "jaccard-open")
    each = big.groupBy("cluster", "r").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    by = each.groupBy("cluster").agg(F.max(F.struct("k", "r", "n")).alias("top"), F.sum("k").alias("k"), F.sum("n").alias("n"))
    left, size = F.col("k") - F.col("top.k"), F.col("k")
    wide = F.least(F.lit(WIDE_BLOCK), F.greatest(F.lit(BLOCK), left / 4))
    by = by.filter(left > 0).select(
        F.bitwise_not("cluster").alias("__c"),
        F.col("top.r").alias("giant"),
        _blocks(left, F.col("n") - F.col("top.n"), wide).alias("rest"),
        _blocks(size, F.col("n"), wide).alias("wide"),
    )
    both = big.withColumn("__n", F.bitwise_not("cluster")).join(by.hint("merge"), F.col("__n") == F.col("__c"))
    own = F.pmod(F.xxhash64("class", F.lit(11)), F.col("rest")).cast("int")
    mine = F.pmod(F.xxhash64("class", F.lit(13)), F.col("wide")).cast("int")
    task = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    called = F.transform(F.sequence(F.lit(0), F.col("rest") - 1), lambda i: task(i, mine))
    calls = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda j: task(own, j))
    return both.withColumn("at", F.when(F.col("r") == F.col("giant"), called).otherwise(F.array_distinct(F.concat(called, calls))))


def jaccard_components(df: DataFrame, words: int = 4, percent: int = 85, fan: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, row) for each row of ``df``; ``row`` is xxhash64 of its text."""
    return jaccard_roots(df, words, percent, fan).drop("root")


def jaccard_roots(df: DataFrame, words: int = 4, percent: int = 85, fan: int | None = None) -> DataFrame:
    """As ``jaccard_components``, and the component's own ``root``, which doesn't hang on ids; null without shingles."""
    spark, m = df.sparkSession, Measure(percent)
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    b = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES)

    def by_bucket(rows: DataFrame, how, schema: str) -> DataFrame:
        return exchange(rows, b, fan).groupBy("to").applyInArrow(how, schema)

    posted = by_bucket(docs.mapInArrow(_post(words, m, b, fan), ROW), _find_live(b, fan), ROW)
    judged = materialize(by_bucket(posted, _judge(m), _CLASS), "jaccard-classes")
    members = judged.filter("kind = 0").drop("kind", "tokens")
    able = judged.filter("kind = 1").drop("kind")

    edges = by_bucket(able.select("class", "tokens").mapInArrow(_post_prefixes(b, fan), ROW), _make_edges, "a long, b long")
    cluster = components(edges, "jaccard-clusters", SMALL_GRAPH)
    placed = able.select("class", "doc_id", "row", "n").join(cluster, F.col("class") == F.col("node")).select("class", "doc_id", "row", "n", F.col("root").alias("cluster"))
    placed = materialize(placed, "jaccard-placed")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n")).filter("size > 1")
    sizes = sizes.withColumn("blocks", _blocks(F.col("size"), F.col("n"), F.lit(BLOCK)))
    sizes = materialize(sizes.select(F.bitwise_not("cluster").alias("__c"), "blocks"), "jaccard-sizes")
    member = (
        placed.withColumn("__n", F.bitwise_not("cluster"))
        .join(sizes.hint("merge"), F.col("__n") == F.col("__c"))
        .select("cluster", "class", "doc_id", "row", "n", "blocks", F.pmod(F.xxhash64("class", F.lit(7)), F.col("blocks")).cast("int").alias("mine"))
    )
    # Every block meets the first one.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    first_round = member.withColumn("at", F.when(F.col("mine") == 0, F.transform(every, lambda j: F.struct(F.lit(0).alias("i"), j.alias("j")))).otherwise(F.array(F.struct(F.lit(0).alias("i"), F.col("mine").alias("j")))))
    links = materialize(_meet(docs, first_round, words, percent), "jaccard-links")
    if sizes.filter("blocks > 1").limit(1).count():
        links = links.unionByName(materialize(_meet(docs, _second_round(member, links), words, percent), "jaccard-more-links"))

    linked = components(links, "jaccard-components", SMALL_GRAPH)
    firsts = members.filter("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    rooted = firsts.join(linked, F.col("class") == F.col("node"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    by_class = linked.join(lowest, "root").select(F.bitwise_not("node").alias("__c"), "component", "root")
    alone = firsts.select(F.bitwise_not("class").alias("__c"), "low")
    label = materialize(alone.join(by_class, "__c", "left").select("__c", F.coalesce("component", "low").alias("component"), F.coalesce("root", F.bitwise_not("__c")).alias("root")), "jaccard-labels")
    out = members.withColumn("__n", F.bitwise_not("class")).join(label.hint("merge"), F.col("__n") == F.col("__c"), "left")
    no_null = lambda c: F.when(c != NULL_ID, c)
    return out.select(
        no_null(F.col("doc_id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        no_null(F.coalesce("component", "doc_id")).alias("component_id"),
        "row",
        "root",
    )


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents that link at 85 of 100 over sets of 4-word shingles.

    Nulls, empty texts, ties, repeated rows, empty tables and other columns: see the module.
    """
    return jaccard_components(table(spark, sf_dir, "documents")).drop("row")
