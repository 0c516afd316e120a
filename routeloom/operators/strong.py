"""Strongly connected components of directed arcs, by levels of cells.

Nodes are dealt into cells, as for paths (``overlay``).  One pass contracts each cell to
its border nodes: those that reach one another inside it become one, and arcs between
them say which reach which.  What is left is dealt into larger cells, until it is one
task's work, which is counted first.  On the way back each cell gives its inner nodes to
the component of border nodes that both reach them and are reached by them, or else to
one of their own.  The number of passes grows with the logarithm of the graph, so a
chain of any length takes as many as a short one.

Without cells, arcs beyond one task's work go by colouring: the smallest node that
reaches each one, then backwards within its colour, again for what is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import materialize

#: Arcs that are one task's work.
SMALL = 200_000
ROOTS = "node string, root string"


def components_of(nodes: list, out: dict) -> dict:
    """{node: smallest node of its component}, components in reverse topological order."""
    index, low, place, stack, root = {}, {}, {}, [], {}

    def visit(node):
        index[node] = low[node] = len(index)
        place[node] = len(stack)
        stack.append(node)
        return node, iter(out.get(node, ()))

    for start in nodes:
        if start in index:
            continue
        work = [visit(start)]
        while work:
            node, rest = work[-1]
            to = next((t for t in rest if t not in index or t in place), None)
            if to is None:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    some = stack[place[node] :]
                    del stack[place[node] :]
                    least = min(some)
                    for n in some:
                        del place[n]
                        root[n] = least
            elif to in index:
                low[node] = min(low[node], index[to])
            else:
                work.append(visit(to))
    return root


def _cell(rows: pd.DataFrame) -> tuple[dict, dict, dict, dict]:
    """(label of border nodes, component of each node, components by their arcs forward and backward)."""
    arcs, marks = rows[rows["to_node"].notna()], rows[rows["to_node"].isna()]
    out: dict = {}
    for f, t in zip(arcs["from_node"], arcs["to_node"]):
        out.setdefault(f, []).append(t)
    border = dict(zip(marks["from_node"], marks["label"]))
    root = components_of([*out, *arcs["to_node"], *border], out)
    ahead: dict = {}
    behind: dict = {}
    for f, ends in out.items():
        for t in ends:
            if root[f] != root[t]:
                ahead.setdefault(root[f], set()).add(root[t])
                behind.setdefault(root[t], set()).add(root[f])
    return border, root, ahead, behind


def _contract(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """kind 0: a border node and the smallest one of its component here; kind 1: such a one and the next that it reaches."""
    border, root, ahead, _ = _cell(rows)
    first: dict = {}
    for n in sorted(border):
        first.setdefault(root[n], n)
    found = [(0, n, first[root[n]]) for n in border]
    for c, name in first.items():
        seen, todo = {c}, [c]
        while todo:
            for t in ahead.get(todo.pop(), ()):
                if t not in seen:
                    seen.add(t)
                    if t in first:
                        found.append((1, name, first[t]))
                    else:
                        todo.append(t)
    return pd.DataFrame(found, columns=["kind", "a", "b"], dtype=object)


def _resolve(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The component of each node of a cell, from the labels of its border nodes."""
    border, root, ahead, behind = _cell(rows)
    number = {label: 1 << i for i, label in enumerate(sorted(set(border.values())))}
    own = {root[n]: number[label] for n, label in border.items()}
    order = list(dict.fromkeys(root.values()))

    def spread(arcs: dict, nodes: list) -> dict:
        reach = {}
        for c in nodes:
            bits = own.get(c, 0)
            for t in arcs.get(c, ()):
                bits |= reach[t]
            reach[c] = bits
        return reach

    # Components come in reverse topological order: what one reaches stands before it.
    down, up = spread(ahead, order), spread(behind, order[::-1])
    names = {bit: label for label, bit in number.items()}
    label = {c: names.get(down[c] & up[c], c) for c in order}
    return pd.DataFrame({"node": list(root), "root": [label[c] for c in root.values()]}, columns=["node", "root"], dtype=object)


def _in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: dict = {}
    for b in batches:
        for f, t in zip(b["from_node"], b["to_node"]):
            out.setdefault(f, []).append(t)
    root = components_of([*out, *{t for v in out.values() for t in v}], out)
    yield pd.DataFrame({"node": list(root), "root": list(root.values())}, columns=["node", "root"], dtype=object)


def _spread(arcs: DataFrame, start: DataFrame, name: str) -> DataFrame:
    """(node, colour): the smallest colour that reaches each node, by rounds of joins."""
    best = materialize(start, name)
    while True:
        step = best.join(arcs, F.col("node") == F.col("from_node")).select(F.col("to_node").alias("node"), "colour")
        new = materialize(best.unionByName(step).groupBy("node").agg(F.min("colour").alias("colour")), name)
        if new.exceptAll(best).isEmpty():
            return new
        best = new


def by_colours(arcs: DataFrame) -> DataFrame:
    """(node, root) by forward and backward colouring; a component is found in the round of its smallest node."""
    done = None
    left = arcs
    nodes = materialize(arcs.select(F.explode(F.array("from_node", "to_node")).alias("node")).distinct(), "strong-nodes")
    while not nodes.isEmpty():
        colour = _spread(left, nodes.select("node", F.col("node").alias("colour")), "strong-forward")
        back = left.join(colour.select(F.col("node").alias("from_node"), F.col("colour").alias("cf")), "from_node").join(colour.select(F.col("node").alias("to_node"), F.col("colour").alias("ct")), "to_node").filter("cf = ct")
        back = materialize(back.select(F.col("to_node").alias("from_node"), F.col("from_node").alias("to_node")), "strong-back")
        found = _spread(back, colour.filter("node = colour"), "strong-backward").select("node", F.col("colour").alias("root"))
        done = found if done is None else done.unionByName(found)
        nodes = materialize(nodes.join(found, "node", "left_anti"), "strong-nodes")
        ends = [nodes.select(F.col("node").alias(f"{e}_node")) for e in ("from", "to")]
        left = materialize(left.join(ends[0], "from_node", "left_semi").join(ends[1], "to_node", "left_semi").select("from_node", "to_node"), "strong-left")
    return arcs.sparkSession.createDataFrame([], ROOTS) if done is None else done


def strong_components(arcs: DataFrame, cells: DataFrame | None = None, small: int = SMALL) -> DataFrame:
    """(node, root) of every node of ``arcs`` (from_node, to_node): the smallest node that it reaches and that reaches it.

    ``cells`` (node, cell) has all nodes; a cell's number without its last bits is that
    of a larger one.
    """
    now = materialize(arcs.select("from_node", "to_node").distinct(), "strong-arcs")
    size, levels = now.count(), []
    while size > small and cells is not None:
        ends = [cells.select(F.col("node").alias(f"{e}_node"), F.col("cell").alias(f"{e}_cell")) for e in ("from", "to")]
        placed = materialize(now.join(ends[0], "from_node").join(ends[1], "to_node"), "strong-placed")
        cross = placed.filter("from_cell <> to_cell")
        border = cross.select(F.explode(F.array(F.struct(F.col("from_node").alias("n"), F.col("from_cell").alias("cell")), F.struct(F.col("to_node").alias("n"), F.col("to_cell").alias("cell")))).alias("e")).select("e.cell", "e.n").distinct()
        inner = placed.filter("from_cell = to_cell").select(F.col("from_cell").alias("cell"), "from_node", "to_node", F.lit(None).cast("string").alias("label"))
        mark = lambda n, label: (F.col(n).alias("from_node"), F.lit(None).cast("string").alias("to_node"), F.col(label).alias("label"))
        made = inner.unionByName(border.select("cell", *mark("n", "n"))).groupBy("cell").applyInPandas(_contract, "kind int, a string, b string")
        made = materialize(made, "strong-contracted")
        first = made.filter("kind = 0")
        to = [first.select(F.col("a").alias(f"{e}_node"), F.col("b").alias(e)) for e in ("f", "t")]
        joined = cross.select(F.col("from_node").alias("f_node"), F.col("to_node").alias("t_node")).join(to[0], "f_node").join(to[1], "t_node").select(F.col("f").alias("from_node"), F.col("t").alias("to_node"))
        reached = made.filter("kind = 1").select(F.col("a").alias("from_node"), F.col("b").alias("to_node"))
        now = materialize(joined.unionByName(reached).filter("from_node <> to_node").distinct(), "strong-arcs")
        before, size = size, now.count()
        levels.append((inner, border, first, mark))
        cells = cells.join(first.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("node", F.greatest(F.shiftright(F.col("cell").cast("long"), 4), F.lit(1).cast("long")).alias("cell"))
        cells = materialize(cells, "strong-cells")
        if size > 0.8 * before:
            break
    roots = now.coalesce(1).mapInPandas(_in_one_task, ROOTS) if size <= small else by_colours(now)
    for inner, border, first, mark in reversed(levels):
        labels = first.join(roots, F.col("b") == F.col("node"), "left").select(F.col("a").alias("n"), F.coalesce("root", "b").alias("label"))
        marks = border.join(labels, "n").select("cell", *mark("n", "label"))
        roots = materialize(inner.unionByName(marks).groupBy("cell").applyInPandas(_resolve, ROOTS), "strong-roots")
    least = roots.groupBy("root").agg(F.min("node").alias("least"))
    return roots.join(least, "root").select("node", F.col("least").alias("root"))
