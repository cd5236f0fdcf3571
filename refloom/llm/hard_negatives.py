"""Hard negatives: rows of another label that score a little below an anchor's positives.

Vectors become integers (each component x is floor(256 * x)) and scores are exact inner
products. Two exact tree searches (``treesearch``) find, for each anchor, its best rows of
the same label, then, for each of these positives, the best rows of another label whose
score lies between ``LEAST`` and ``MOST`` percent of the positive's. The second search's
windows are annuli around the anchor: subtrees whose distance ranges do not meet any of
them are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refloom.llm import treesearch
from refloom.session import cut_lineage

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percentages of its positive's.
LEAST, MOST = 50, 95
ANCHOR_EVERY = 50


def packed_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """One row (vec_id, label, v, dim, square) for each id that takes part; see ``hard_negatives``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vec_id, label, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                whole = np.floor(256 * np.array(vector, dtype=float))  # a missing component becomes nan
                if np.isfinite(whole).all():
                    out.append((vec_id, label, treesearch.pack(whole), len(whole), float(whole @ whole)))
            yield pa.RecordBatch.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in out], schema=kinds)

    kinds = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.binary()), ("dim", pa.int32()), ("square", pa.float64())])
    taken = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in ((id_col, "vec_id"), (label_col, "label"), (vector_col, "vector"))])
    taken = taken.where("vec_id is not null and label is not null and vector is not null")
    taken = taken.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    packed = taken.mapInArrow(run, "vec_id long, label long, v binary, dim int, square double")
    one = packed.groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim", "square")).alias("row"))
    return one.select("vec_id", "row.*")


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id, in order."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = at[scores >= np.partition(scores, len(scores) - k)[len(scores) - k]]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def score_window(positive: int) -> tuple[int, int]:
    """The least and the largest score of a negative beside a positive's score (empty where the first is larger)."""
    return -((-LEAST * positive) // 100), (MOST * positive) // 100


def _positive_windows(tree: treesearch.Tree, vectors: np.ndarray, asked: list[dict]) -> list[list[tuple[float, float]]]:
    """From the score of the last positive that the sample alone gives; everything where it gives too few."""
    scores = treesearch.inner(vectors, tree.sample)
    out = []
    for k, q in enumerate(asked):
        mine = scores[k][(tree.sample_labels == q["label"]) & (tree.sample_ids != q["vec_id"])]
        out.append([(float(np.partition(mine, len(mine) - POSITIVES)[len(mine) - POSITIVES]) if len(mine) >= POSITIVES else -np.inf, np.inf)])
    return out


def _negative_windows(tree: treesearch.Tree, vectors: np.ndarray, asked: list[dict]) -> list[list[tuple[float, float]]]:
    """The window of each positive, from the score of the last negative that the sample alone gives."""
    scores = treesearch.inner(vectors, tree.sample)
    out = []
    for k, q in enumerate(asked):
        other = scores[k][tree.sample_labels != q["label"]]
        out.append([])
        for low, high in map(score_window, q["scores"]):
            inside = other[(other >= low) & (other <= high)]
            if len(inside) >= NEGATIVES:
                low = int(np.partition(inside, len(inside) - NEGATIVES)[len(inside) - NEGATIVES])
            if low <= high:
                out[-1].append((float(low), float(high)))
    return out


def _positives(rows: pd.DataFrame, asked: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    out = []
    for k, (vec_id, label) in enumerate(zip(asked["vec_id"], asked["label"], strict=True)):
        mine = np.flatnonzero((labels == label) & (ids != vec_id))
        best = mine[_first(scores[k][mine], ids[mine], POSITIVES)]
        out += [(vec_id, int(ids[b]), int(scores[k][b])) for b in best]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])


def _negatives(rows: pd.DataFrame, asked: pd.DataFrame, scores: np.ndarray) -> pd.DataFrame:
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    out = []
    for k, q in enumerate(asked.itertuples()):
        other = labels != q.label
        for positive, score in zip(q.ids, q.scores, strict=True):
            low, high = score_window(int(score))
            fit = np.flatnonzero(other & (scores[k] >= low) & (scores[k] <= high))
            best = fit[_first(scores[k][fit], ids[fit], NEGATIVES)]
            out += [(q.vec_id, int(positive), int(score), int(ids[b]), int(scores[k][b])) for b in best]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _ranked(found: DataFrame, by: list[str], score: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(row))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """For each anchor (id divisible by 50) and positive, its first negatives with rank and scores.

    Rows without an id, a label or a vector, or with a missing or non-finite component, take
    no part. Where an id repeats, the row with the smallest (label, vector) stands for it.
    Vectors of different lengths are compared as if the shorter ended in zeros (an empty one
    scores 0 with all). Ties go to the smaller id. Anchors without a positive, and positives
    without a negative, give no row; so does an empty table. Other columns are not read.
    A score beyond 64 bits is an error.
    """
    filed = treesearch.file_table(cut_lineage(packed_vectors(rows, id_col, vector_col, label_col)))
    anchors = filed.rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).select("vec_id", "label", "v")
    n = anchors.count()
    near = treesearch.search(filed, anchors, n, _positive_windows, _positives, "anchor_id long, positive_id long, positive_score long")
    best = _ranked(near, ["anchor_id"], "positive_score", "positive_id", POSITIVES)
    asked = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))  # at most POSITIVES
    asked = anchors.join(asked, F.col("anchor_id") == F.col("vec_id")).select(
        "vec_id", "label", "v", F.col("p.positive_id").alias("ids"), F.col("p.positive_score").alias("scores")
    )
    far = treesearch.search(
        filed, cut_lineage(asked), n, _negative_windows, _negatives,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    return _ranked(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
