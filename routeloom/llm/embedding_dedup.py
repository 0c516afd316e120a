"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by the order of its nearest reference points ("pivots"), which
are random directions made from a seed, so that whether two vectors share pivots
depends on the angle between them alone and not on the data.  Of the ``PREFIX``
nearest, two vectors are candidates if they share ``SHARED`` or more.  Candidates
come from inverted lists, one for each label and pivot: within the list of a pivot
its entries meet by each further pivot that they share, and a pair is taken where
those are the first two that it shares, so that it is looked at once.  Candidates are
verified by their cosine.

What is equal or nearly so is put together before any list is made.  Equal vectors of
a label become one point with its number of copies.  Points whose three nearest
pivots stand in one order have a leader, and those within a sixth of the linking
angle of it join its class: all of a class link with one another.  A class is
indexed by its leader, with its radius.  Classes whose leaders' angle with both radii
added is within the linking angle link as a whole, beyond it with both taken off not
at all; what lies between is settled vector by vector in double precision.  So a
group of copies, exact or near, is one entry however large it is.

Lists hold unit vectors of 12 bits a component.  Their rounding is bounded by the
stored step, and pairs that it leaves open go to the same exact check.

Scale.  No task holds a label or a pivot's whole list: lists of over ``LIST_ROWS``
entries are dealt into blocks that meet in pairs (each entry travels once for each
block; only vectors that crowd within the angle of few pivots, without being within a
sixth of the linking angle, make such lists).  The number of pivots grows with twice
the root of the rows, 256 to 4096, so that lists do, too.  A class is posted to five
lists of its six pivots, as two of six are shared only if one of the first five is.
Links are counted and trees of them made inside lists; pairs are never written, but
for those that an exact check must settle.  Components come from rounds of joins.

Recall.  Two vectors at the threshold of 0.93 share two of six pivots with
probability 0.99, 0.97 and 0.93 among 256, 1024 and 4096 pivots; closer ones more
often.  Links are never wrong.

Defined results.  A null label, a null, empty or zero vector, and one with null or
non-finite components links with nothing: no links, a component by itself, kept.
Vectors of other lengths don't link.  Repeated rows are vectors of their own.  A null
vec_id is nobody's smallest, and a component without others has none.  An empty
table gives an empty result.  Columns other than vec_id, label and embedding are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import components
from .common import materialize, table
from .packed import runs

COSINE = 0.93
PREFIX, SHARED, ORDERED = 6, 2, 3
MIN_PIVOTS, MAX_PIVOTS, SEED = 256, 4096, 12
LIST_ROWS = 16_384
#: Pairs of a list that are compared at once, and runs that are compared as matrices.
PAIRS, MATRIX = 1 << 17, 64
STEPS = 2047
SURE, TREE, OPEN = 0, 1, 2


# -- vectors ----------------------------------------------------------------------


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def pivots(n: int, dim: int) -> np.ndarray:
    return unit(np.random.default_rng([SEED, n, dim]).standard_normal((n, dim))).astype(np.float32)


def n_pivots(rows: int) -> int:
    return int(min(MAX_PIVOTS, max(MIN_PIVOTS, 2 ** round(math.log2(2 * math.sqrt(max(rows, 1)))))))


def nearest(u: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The ``PREFIX`` nearest points of each row, nearest first."""
    out = np.empty((len(u), PREFIX), np.int64)
    for a in range(0, len(u), 1024):
        score = -(u[a : a + 1024].astype(np.float32) @ points.T)
        some = np.sort(np.argpartition(score, PREFIX, axis=1)[:, :PREFIX], axis=1)
        order = np.argsort(np.take_along_axis(score, some, 1), axis=1, kind="stable")
        out[a : a + 1024] = np.take_along_axis(some, order, 1)
    return out


def encode(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(step, bytes) of unit vectors: two components of 12 bits in three bytes."""
    step = (np.abs(u).max(axis=1) / STEPS).astype(np.float32)
    q = np.rint(u / step[:, None].astype(np.float64)).clip(-STEPS, STEPS).astype(np.int32) + 2048
    if q.shape[1] % 2:
        q = np.hstack([q, np.full((len(q), 1), 2048, np.int32)])
    a, b = q[:, 0::2], q[:, 1::2]
    return step, np.stack([a & 255, (a >> 8) | ((b & 15) << 4), b >> 4], axis=2).astype(np.uint8).reshape(len(q), -1)


def decode(step: np.ndarray, packed: np.ndarray, dim: int) -> np.ndarray:
    x = packed.reshape(len(packed), packed.shape[1] // 3, 3).astype(np.int32)
    a, b = x[:, :, 0] | ((x[:, :, 1] & 15) << 8), (x[:, :, 1] >> 4) | (x[:, :, 2] << 4)
    q = np.stack([a, b], axis=2).reshape(len(packed), 2 * a.shape[1])[:, :dim] - 2048
    return (q * step[:, None].astype(np.float64)).astype(np.float32)


def rounding(step: np.ndarray, dim: int) -> float:
    """Bound of what rounding changes in the product of two encoded vectors."""
    each = 0.51 * float(step.max(initial=0)) * math.sqrt(dim)
    return each * (2 + each) + (dim + 2) * 2.0**-22


def entry(dim: int) -> np.dtype:
    return np.dtype([("id", "<i8"), ("total", "<i8"), ("radius", "<f4"), ("step", "<f4"), ("pivots", "<i2", PREFIX), ("vector", "u1", 3 * (-(-dim // 2)))])


def rows_of(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, place of each row's first) of an array of arrays."""
    if isinstance(cells, pa.ChunkedArray):
        cells = cells.combine_chunks()
    return np.asarray(cells.flatten()), np.concatenate([[0], np.cumsum(np.asarray(cells.value_lengths().fill_null(0), dtype=np.int64))])


def by_length(cells: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each length of vectors."""
    values, at = rows_of(cells)
    size = np.diff(at)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        yield int(d), rows, values[at[rows][:, None] + np.arange(d)]


def with_cosine(df: DataFrame, a: str, b: str) -> DataFrame:
    """``cosine`` of two columns of vectors of one length, in double precision, in place of them."""
    kept = [f for f in df.schema.fields if f.name not in (a, b)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", cosine double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.zeros(batch.num_rows)
            for (_, rows, x), (_, _, y) in zip(by_length(batch.column(a)), by_length(batch.column(b))):
                cosine[rows] = (unit(x) * unit(y)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(cosine)], [*[f.name for f in kept], "cosine"])

    return df.mapInArrow(run, schema)


# -- classes ----------------------------------------------------------------------


def usable() -> Column:
    """Whether a row's vector may link with others."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def keyed(df: DataFrame) -> DataFrame:
    """The rows with 128 bits of a digest of label and vector, null where the vector links with nothing."""
    good = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding").withColumn("good", usable())
    return good.select("vec_id", "label", "embedding", *[F.when(F.col("good"), h).alias(n) for n, h in (("ka", F.xxhash64("label", "embedding")), ("kb", F.xxhash64("embedding", "label")))])


def described(df: DataFrame, n: int) -> DataFrame:
    """Points: distinct vectors of a label with their copies, smallest vec_id, pivots in order of their number, and order of the nearest."""
    whole = df.filter("ka IS NOT NULL").groupBy("label", "embedding", "ka", "kb").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    kind = dict(whole.dtypes)["embedding"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            shared, order = np.zeros((batch.num_rows, PREFIX), np.int32), np.zeros(batch.num_rows, np.int64)
            for d, rows, x in by_length(batch.column("embedding")):
                if d not in made:
                    made[d] = pivots(n, d)
                near = nearest(unit(x), made[d])
                shared[rows] = np.sort(near, axis=1)
                order[rows] = near[:, :ORDERED] @ (1 << 16) ** np.arange(ORDERED)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * PREFIX), pa.array(shared.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(order)], [*batch.schema.names, "pivots", "order"])

    out = whole.mapInArrow(run, f"label string, embedding {kind}, ka long, kb long, low long, copies long, pivots array<int>, order long")
    return out.withColumn("dim", F.size("embedding")).withColumn("pid", F.monotonically_increasing_id())


def near_leaders(points: DataFrame, radius: float) -> DataFrame:
    """(pid, cid, copies, low, angle): points that belong to another one's class.

    The leader of those with the same nearest pivots in the same order is one chosen by hash.
    """
    same = ["label", "dim", "order"]
    first = points.groupBy(*same).agg(F.min(F.struct(F.xxhash64("pid").alias("h"), "pid")).alias("m"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(*same, F.col("m.pid").alias("cid"))
    leaders = first.join(points.select(F.col("pid").alias("cid"), F.col("embedding").alias("leader")), "cid")
    pairs = points.join(leaders, same).filter("pid <> cid").select("pid", "cid", "copies", "low", "embedding", "leader")
    near = with_cosine(pairs, "embedding", "leader")
    return near.withColumn("angle", F.acos(F.least("cosine", F.lit(1.0))) + 1e-7).filter(F.col("angle") <= radius).drop("cosine")


def classes_of(points: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each class, that of its leader, with ``total`` vectors, smallest vec_id and radius."""
    joined = members.groupBy(F.col("cid").alias("pid")).agg(F.sum("copies").alias("more"), F.min("low").alias("least"), F.max("angle").alias("radius"))
    own = points.join(members.select("pid"), "pid", "left_anti").join(joined, "pid", "left")
    return own.withColumns(
        {"total": F.col("copies") + F.coalesce("more", F.lit(0)), "low": F.least("low", "least"), "radius": F.coalesce("radius", F.lit(0.0))}
    ).drop("more", "least", "copies")


# -- lists ------------------------------------------------------------------------


def postings(classes: DataFrame, list_rows: int) -> DataFrame:
    """(label, dim, pivot, b, c, block, entry): each class in the lists of its first pivots, large lists as pairs of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            column = lambda name: np.asarray(batch.column(name))
            shared = rows_of(batch.column("pivots"))[0].reshape(-1, PREFIX)
            for d, rows, x in by_length(batch.column("embedding")):
                e = np.zeros(len(rows), entry(d))
                e["id"], e["total"], e["pivots"] = column("pid")[rows], column("total")[rows], shared[rows]
                # Rounded up, as a radius too small could lose a link.
                e["radius"] = np.nextafter(column("radius")[rows].astype(np.float32), np.float32(4)) * (column("radius")[rows] > 0)
                e["step"], e["vector"] = encode(unit(x))
                for i, one in zip(rows.tolist(), e):
                    cells[i] = one.tobytes()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("label", "dim", "pid", "pivots")], pa.array(cells, pa.binary())], ["label", "dim", "pid", "pivots", "entry"])

    key = ["label", "dim", "pivot"]
    posted = F.explode(F.slice("pivots", 1, PREFIX - SHARED + 1)).alias("pivot")
    large = classes.select("label", "dim", posted).groupBy(*key).count().filter(F.col("count") > list_rows)
    large = large.select(*key, F.ceil(F.col("count") / list_rows).cast("int").alias("blocks"))
    cells = classes.select("label", "dim", "pid", "pivots", "embedding", "total", "radius").mapInArrow(run, "label string, dim int, pid long, pivots array<int>, entry binary")
    rows = cells.select("label", "dim", posted, "pid", "entry").join(large, key, "left")
    block = F.coalesce(F.pmod(F.xxhash64("pid"), F.col("blocks")), F.lit(0)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    return rows.select(*key, block.alias("block"), other.alias("with"), "entry").select(*key, F.least("block", "with").alias("b"), F.greatest("block", "with").alias("c"), "block", "entry")


class Links:
    """Links that a list gives: their number for each entry, a tree of them, and pairs that stay open."""

    def __init__(self, e: np.ndarray, dim: int, angle: float):
        self.e, self.angle = e, angle
        self.x = decode(e["step"], e["vector"], dim)
        self.error = rounding(e["step"], dim)
        self.least = math.cos(min(math.pi, angle + 2 * float(e["radius"].max(initial=0)))) - self.error
        self.count, self.up = np.zeros(len(e), np.int64), np.arange(len(e))
        self.open: list[tuple[np.ndarray, np.ndarray]] = []

    def first_two(self, i: np.ndarray, j: np.ndarray, p: int, q: np.ndarray) -> np.ndarray:
        """Which pairs have p and q as the first two pivots that they share."""
        a, b = self.e["pivots"][i], self.e["pivots"][j]
        common = (a[:, :, None] == b[:, None, :]).any(axis=2)
        return (np.where(common & (a != p), a, np.iinfo(np.int16).max).min(axis=1) == q) & (np.where(common, a, np.iinfo(np.int16).max).min(axis=1) == p)

    def add(self, i: np.ndarray, j: np.ndarray, product: np.ndarray, p: int, q: np.ndarray) -> None:
        near = product >= self.least
        i, j, product, q = i[near], j[near], product[near].astype(np.float64), q[near]
        once = self.first_two(i, j, p, q)
        i, j, product = i[once], j[once], product[once]
        radii = self.e["radius"][i].astype(np.float64) + self.e["radius"][j]
        sure = np.arccos(np.clip(product - self.error, -1, 1)) + radii <= self.angle - 1e-7
        none = np.arccos(np.clip(product + self.error, -1, 1)) - radii > self.angle + 1e-7
        rest = ~(sure | none)
        self.open.append((i[rest], j[rest]))
        i, j = i[sure], j[sure]
        total = self.e["total"]
        np.add.at(self.count, i, total[j])
        np.add.at(self.count, j, total[i])
        while len(i):
            a, b = self.up[i], self.up[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            while (self.up[self.up] != self.up).any():
                self.up = self.up[self.up]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids = self.e["id"]
        some, tree = np.flatnonzero(self.count), np.flatnonzero(self.up != np.arange(len(ids)))
        i, j = (np.concatenate([x[k] for x in self.open] or [np.zeros(0, np.int64)]) for k in (0, 1))
        kind = np.repeat([SURE, TREE, OPEN], [len(some), len(tree), len(i)]).astype(np.int32)
        a, b = np.concatenate([ids[some], ids[tree], ids[i]]), np.concatenate([ids[some], ids[self.up[tree]], ids[j]])
        return kind, a, b, np.concatenate([self.count[some], np.zeros(len(tree) + len(i), np.int64)])


def list_links(e: np.ndarray, block: np.ndarray, across: bool, p: int, dim: int, angle: float) -> Links:
    """Links among a list's entries, or between its two blocks."""
    out = Links(e, dim, angle)
    at, column = np.nonzero(e["pivots"] > p)
    q = e["pivots"][at, column].astype(np.int64)
    order = np.argsort(q, kind="stable")
    at, q = at[order], q[order]
    cut = runs(q)
    size = np.diff(cut)
    short = np.repeat(size <= MATRIX, size)
    for step in range(1, min(MATRIX, int(size.max(initial=0)))):
        first = np.flatnonzero(short[:-step] & (q[:-step] == q[step:]))
        for a in range(0, len(first), PAIRS):
            f = first[a : a + PAIRS]
            i, j = at[f], at[f + step]
            if across:
                apart = block[i] != block[j]
                i, j, f = i[apart], j[apart], f[apart]
            out.add(i, j, np.einsum("ij,ij->i", out.x[i], out.x[j]), p, q[f])
    for k in np.flatnonzero(size > MATRIX):
        s = at[cut[k] : cut[k + 1]]
        for a in range(0, len(s), 256):
            rows = s[a : a + 256]
            product = out.x[rows] @ out.x[s[a:]].T
            wanted = np.triu(product >= out.least, 1)
            if across:
                wanted &= block[rows][:, None] != block[s[a:]][None, :]
            i, j = np.nonzero(wanted)
            for b in range(0, len(i), PAIRS):
                x, y = i[b : b + PAIRS], j[b : b + PAIRS]
                out.add(rows[x], s[a:][y], product[x, y], p, np.full(len(x), q[cut[k]]))
    return out


def _lists(angle: float):
    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, dim, p, b1, b2 = (k.as_py() for k in key)
        cells, blocks = [], []
        for b in batches:
            cells += [x.as_py() for x in b.column("entry")]
            blocks.append(np.asarray(b.column("block")))
        links = list_links(np.frombuffer(b"".join(cells), entry(dim)), np.concatenate(blocks), b1 != b2, p, dim, angle)
        kind, a, b, n = links.rows()
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b), pa.array(n)], ["kind", "a", "b", "n"])

    return run


# -- results ----------------------------------------------------------------------


def settle(open_: DataFrame, member: DataFrame, cosine: float) -> DataFrame:
    """(a, b, x, y, nx, ny): linked vectors of classes a and b that lists left open, with their copies."""
    side = lambda c, v, n: member.select(F.col("cid").alias(c), F.col("pid").alias(v), F.col("embedding").alias(f"{v}_vector"), F.col("copies").alias(n))
    pairs = open_.select("a", "b").join(side("a", "x", "nx"), "a").join(side("b", "y", "ny"), "b")
    return with_cosine(pairs, "x_vector", "y_vector").filter(F.col("cosine") >= cosine).drop("cosine")


def near_vectors(df: DataFrame, cosine: float = COSINE, list_rows: int = LIST_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``df`` (vec_id, label, embedding)."""
    angle = math.acos(cosine)
    rows = keyed(df)
    points = materialize(described(rows, n_pivots(df.count())), "embedding-points")
    members = materialize(near_leaders(points, angle / 6), "embedding-members")
    classes = classes_of(points, members)
    found = postings(classes, list_rows).groupBy("label", "dim", "pivot", "b", "c").applyInArrow(_lists(angle), "kind int, a long, b long, n long")
    found = materialize(found, "embedding-links")

    inside = points.select("pid", "ka", "kb", "copies", "embedding").join(members.select("pid", "cid"), "pid", "left").withColumn("cid", F.coalesce("cid", "pid"))
    settled = materialize(settle(found.filter(F.col("kind") == OPEN), inside, cosine), "embedding-settled")
    edges = found.filter(F.col("kind") == TREE).select("a", "b").unionByName(settled.select("a", "b"))
    root = components(edges, "embedding-components")

    whole = classes.select(F.col("pid").alias("cid"), "total", "low").join(root, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    lows = whole.groupBy("root").agg(F.min("low").alias("component_id"))
    sure = found.filter(F.col("kind") == SURE).groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("sure"))
    ends = F.explode(F.array(F.struct(F.col("x").alias("pid"), F.col("ny").alias("n")), F.struct(F.col("y").alias("pid"), F.col("nx").alias("n")))).alias("e")
    single = settled.select(ends).groupBy(F.col("e.pid").alias("pid")).agg(F.sum("e.n").alias("single"))
    each = whole.join(lows, "root").join(sure, "cid", "left").select("cid", "component_id", (F.col("total") - 1 + F.coalesce("sure", F.lit(0))).alias("links"))
    point = inside.drop("embedding", "copies").join(each, "cid").join(single, "pid", "left")
    point = point.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), "component_id", (F.col("links") + F.coalesce("single", F.lit(0))).alias("links"))
    out = rows.select("vec_id", "ka", "kb").join(point, (F.col("ka") == F.col("pa")) & (F.col("kb") == F.col("pb")), "left")
    alone = F.col("ka").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label linked at a cosine of 0.93 or more, with their number of links and component.

    Nulls, zero and non-finite vectors, ties, repeated rows, empty tables and other columns: see the module.
    """
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


#: Compares every pair of a label: for small tables.
OP12_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.y FROM r JOIN l ON r.b = l.x),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON c.vec_id = n.vec_id
"""
