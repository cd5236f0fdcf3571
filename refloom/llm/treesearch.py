"""Exact search by a multiway hyperplane tree with distance ranges, over rows spread by leaf.

A node of the tree holds a few split points far apart from each other; a row goes to the
nearest one, down to a leaf. Beside each split point i the node keeps, for each sibling
subtree j, the smallest and largest distance from i to a row of j. A query looks for rows
whose inner product with it lies in a window, which is an annulus of distances around it:
a subtree is left out where, for some split point, the distances that the triangle
inequality leaves do not meet the annulus. Inside the leaves that remain, scores are exact.

Inner products become distances by one more coordinate: rows get sqrt(M - |x|^2), M being
the largest squared length, queries get 0. Then d^2 = |q|^2 + M - 2 * score.

The tree is fitted on a bounded sample (``SAMPLE`` rows) and holds at most ``FANOUT ** 3``
leaves, so its size does not grow with the table; every row is filed. Rows of a leaf meet
the queries that reach it in blocks of bounded size, by an equi join on (leaf, row block,
query block).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that the tree is fitted on (the ones whose id hashes smallest); a query's first bounds come from them too.
SAMPLE = 8_192
#: Split points of a node.
FANOUT = 8
#: Rows a leaf should hold; the tree is at most ``LEVELS`` levels deep.
LEAF_ROWS = 4_096
LEVELS = 3
#: Rows, and queries, that meet in one task at most (as expected; blocks are dealt by hash).
BLOCK = 16_384
#: Scores worked out at once.
_TILE = 1 << 20

_EXACT = 2.0**53


class Node(NamedTuple):
    """``points``: split points with their added coordinate; ``children``: nodes, or the numbers of leaves."""

    number: int
    points: np.ndarray
    children: list


class Tree(NamedTuple):
    root: Node | int
    nodes: int
    leaves: int
    dim: int
    top: float  # M
    sample_labels: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray


def pack(vector: np.ndarray) -> bytes:
    """Integer components in 4 bytes each; in 8 with one byte behind them where 4 are too few."""
    if not len(vector) or np.abs(vector).max() < 2**31:
        return vector.astype("<i4").tobytes()
    return vector.astype("<f8").tobytes() + b"."


def unpack(blobs: Sequence[bytes], dim: int) -> np.ndarray:
    """Packed vectors as rows of a matrix; missing components are 0."""
    if all(len(b) == 4 * dim for b in blobs):
        return np.frombuffer(b"".join(blobs), "<i4").reshape(len(blobs), dim).astype(float)
    out = np.zeros((len(blobs), dim))
    for k, b in enumerate(blobs):
        row = np.frombuffer(b[:-1], "<f8") if len(b) % 4 else np.frombuffer(b, "<i4")
        out[k, : len(row)] = row
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, as 64-bit integers (an error where one passes them)."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], dtype=object)
    out = whole(a) @ whole(b).T
    if max(abs(x) for x in out.ravel()) >= 2**63:
        raise ValueError("an inner product passes 64 bits")
    return out.astype(np.int64)


def added(vectors: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack([vectors, np.sqrt(np.maximum(top - np.einsum("ij,ij->i", vectors, vectors), 0))])


def distances(a: np.ndarray, points: np.ndarray) -> np.ndarray:
    gaps = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", points, points) - 2 * (a @ points.T)
    return np.sqrt(np.maximum(gaps, 0))


def _far_apart(rows: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` different rows, each the farthest from those before it."""
    chosen = [int(np.argmax(((rows - rows.mean(axis=0)) ** 2).sum(axis=1)))]
    gap = ((rows - rows[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        nxt = int(np.argmax(gap))
        if gap[nxt] <= 0:
            break
        chosen.append(nxt)
        gap = np.minimum(gap, ((rows - rows[nxt]) ** 2).sum(axis=1))
    return rows[chosen]


def fit(sample: np.ndarray, ids: np.ndarray, labels: np.ndarray, total: int, top: float) -> Tree:
    """The tree over a sample of a table of ``total`` rows: nodes split while their share of the table passes ``LEAF_ROWS``."""
    counts = {"nodes": 0, "leaves": 0}
    rows = added(sample, top)

    def grow(members: np.ndarray, level: int):
        points = None
        if level < LEVELS and len(members) > 1 and total * len(members) / len(rows) > LEAF_ROWS:
            points = _far_apart(rows[members], FANOUT)
        if points is None or len(points) < 2:
            counts["leaves"] += 1
            return counts["leaves"] - 1
        number = counts["nodes"]
        counts["nodes"] += 1
        nearest = distances(rows[members], points).argmin(axis=1)
        return Node(number, points, [grow(members[nearest == j], level + 1) for j in range(len(points))])

    root = grow(np.arange(len(rows)), 0)
    return Tree(root, counts["nodes"], counts["leaves"], sample.shape[1], top, labels, sample, ids)


def file_rows(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int, int], tuple[float, float]]]:
    """The leaf of each row, and the distance ranges (node, split point, subtree) -> (least, most) over these rows."""
    leaf = np.zeros(len(vectors), dtype=np.int64)
    ranges: dict[tuple[int, int, int], tuple[float, float]] = {}
    rows = added(vectors, tree.top)
    todo = [(tree.root, np.arange(len(rows)))]
    while todo:
        node, members = todo.pop()
        if not isinstance(node, Node):
            leaf[members] = node
            continue
        gaps = distances(rows[members], node.points)
        nearest = gaps.argmin(axis=1)
        for j, child in enumerate(node.children):
            mine = nearest == j
            if mine.any():
                for i in range(len(node.points)):
                    d = gaps[mine, i]
                    ranges[node.number, i, j] = (float(d.min()), float(d.max()))
                todo.append((child, members[mine]))
    return leaf, ranges


class Ranges(NamedTuple):
    """Per node matrices [split point, subtree]; a subtree without rows has least > most."""

    least: list[np.ndarray]
    most: list[np.ndarray]


def gather_ranges(tree: Tree, found) -> Ranges:
    sizes: dict[int, int] = {}
    todo = [tree.root]
    while todo:
        node = todo.pop()
        if isinstance(node, Node):
            sizes[node.number] = len(node.points)
            todo += node.children
    least = [np.full((sizes[n], sizes[n]), np.inf) for n in range(tree.nodes)]
    most = [np.full((sizes[n], sizes[n]), -np.inf) for n in range(tree.nodes)]
    for n, i, j, low, high in found:
        least[n][i, j], most[n][i, j] = low, high
    return Ranges(least, most)


def reach(tree: Tree, ranges: Ranges, query: np.ndarray, windows: np.ndarray) -> list[int]:
    """Leaves that may hold a row whose inner product with ``query`` lies in one of ``windows`` [least, most].

    Bounds are widened by more than the rounding of the distances, so no row is lost to it.
    """
    length = float(query @ query)
    scale = length + tree.top
    slack = 1.0 + 1e-9 * scale
    q = np.append(query, 0.0)[None, :]
    out: list[int] = []
    todo = [tree.root]
    while todo:
        node = todo.pop()
        if not isinstance(node, Node):
            out.append(node)
            continue
        d = distances(q, node.points)[0]
        least, most = ranges.least[node.number], ranges.most[node.number]
        near = np.maximum((d[:, None] - most).max(axis=0), (least - d[:, None]).max(axis=0))
        near = np.maximum(near, (d - d.min()) / 2)  # a row of j is no nearer to any other split point
        far = (d[:, None] + most).min(axis=0)
        filed = np.isfinite(most).all(axis=0)
        high = (scale - np.maximum(near, 0) ** 2) / 2 + slack
        low = (scale - far**2) / 2 - slack
        for j, child in enumerate(node.children):
            if filed[j] and any(low[j] <= w[1] and w[0] <= high[j] for w in windows):
                todo.append(child)
    return sorted(out)


# --- Spark side -----------------------------------------------------------------------------------


class Filed(NamedTuple):
    """A table (vec_id, label, v) with its tree, the tree's ranges and the number of rows of each leaf."""

    rows: DataFrame
    tree: Tree
    ranges: Ranges
    leaf_rows: dict[int, int]


def file_table(packed: DataFrame) -> Filed:
    """Fits the tree on a sample of ``packed`` (vec_id, label, v, dim, square) and files every row.

    What reaches the driver is bounded: the sample, a row a node, split point and subtree,
    and a row a leaf.
    """
    total, dim, top = packed.agg(F.count("*"), F.max("dim"), F.max("square")).first()
    dim, top = dim or 0, top or 0.0
    drawn = packed.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "label", "v").collect()
    tree = fit(unpack([bytes(r.v) for r in drawn], dim), np.array([r.vec_id for r in drawn]), np.array([r.label for r in drawn]), total, top)
    shared = packed.sparkSession.sparkContext.broadcast(tree)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = file_rows(shared.value, unpack(batch.column(2).to_pylist(), shared.value.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "label", "v", "leaf"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int, int], tuple[float, float]] = {}
        rows: Counter = Counter()
        for batch in batches:
            leaf, ranges = file_rows(shared.value, unpack(batch.column(0).to_pylist(), shared.value.dim))
            rows.update(leaf.tolist())
            for k, (low, high) in ranges.items():
                was = found.get(k, (low, high))
                found[k] = (min(low, was[0]), max(high, was[1]))
        out = [(*k, *v, 0) for k, v in found.items()] + [(-1, 0, leaf, 0.0, 0.0, n) for leaf, n in rows.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in out], schema=kinds)

    kinds = pa.schema([("n", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("rows", pa.int64())])
    parts = packed.select("v").mapInArrow(measure, "n int, i int, j int, low double, high double, rows long")
    seen = parts.groupBy("n", "i", "j").agg(F.min("low"), F.max("high"), F.sum("rows")).collect()
    ranges = gather_ranges(tree, [r[:5] for r in seen if r[0] >= 0])
    filed = packed.select("vec_id", "label", "v").mapInArrow(file, "vec_id long, label long, v binary, leaf long")
    return Filed(filed, tree, ranges, {r[2]: r[5] for r in seen if r[0] < 0})


#: The windows of each query of a batch: (tree, query vectors, rows of the queries) -> a list of (least, most) a query.
Windows = Callable[[Tree, np.ndarray, list[dict]], list[list[tuple[float, float]]]]
#: The rows that a block of rows answers a block of queries with: (rows, queries, their scores one row a query).
Answer = Callable[[pd.DataFrame, pd.DataFrame, np.ndarray], pd.DataFrame]


def search(filed: Filed, queries: DataFrame, n_queries: int, windows: Windows, answer: Answer, ddl: str) -> DataFrame:
    """``answer`` of every block of rows to every block of queries that reach its leaf, as rows of ``ddl``.

    ``queries`` has ``vec_id`` and ``v`` beside what the two functions read. A leaf is dealt
    into blocks of about ``BLOCK`` rows, its queries likewise, by a hash of the id; each
    block of the one meets each of the other once.
    """
    shared = filed.rows.sparkSession.sparkContext.broadcast((filed.tree, filed.ranges))
    blocks = {leaf: -(-n // BLOCK) for leaf, n in filed.leaf_rows.items()}
    q_blocks = max(1, -(-n_queries // BLOCK))
    names, at_v = [*queries.columns, "leaf", "block"], queries.columns.index("v")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, ranges = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                vectors = unpack(part.column(at_v).to_pylist(), tree.dim)
                wanted = windows(tree, vectors, part.to_pylist())
                sent = [(k, leaf, b) for k, w in enumerate(wanted) for leaf in reach(tree, ranges, vectors[k], w) for b in range(blocks.get(leaf, 0))]
                if sent:
                    at, leaf, block = (pa.array(x, pa.int64()) for x in zip(*sent, strict=True))
                    yield pa.RecordBatch.from_arrays([*part.take(at).columns, leaf, block], names=names)

    def meet(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        tree, _ = shared.value
        known = unpack(list(rows["v"]), tree.dim)
        step = max(1, _TILE // max(1, len(rows)))
        found = []
        for start in range(0, len(asked) if len(rows) else 0, step):
            part = asked.iloc[start : start + step]
            found.append(answer(rows, part, inner(unpack(list(part["v"]), tree.dim), known)))
        return pd.concat(found) if found else pd.DataFrame({f.name: [] for f in schema})

    schema = T._parse_datatype_string(ddl)
    reached = queries.mapInArrow(route, T.StructType([*queries.schema.fields, *T._parse_datatype_string("leaf long, block long").fields]))
    reached = reached.withColumn("q_block", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)))
    n_blocks = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in blocks.items() for x in kv]), F.col("leaf")) if blocks else F.lit(1)
    dealt = filed.rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), n_blocks)).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)).cast("array<long>")))
    keys = ["leaf", "block", "q_block"]
    return dealt.groupBy(*keys).cogroup(reached.groupBy(*keys)).applyInPandas(meet, schema)
