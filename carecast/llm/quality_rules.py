"""Quality rules: gradient-boosted trees over document statistics.

The statistics of all documents are computed in one pass and written once.
Boosting runs on the driver over at most ``train_rows`` labelled documents
(the bound: lowest hashes of the labelled doc_ids, statistics averaged over
rows that share a doc_id). Trees are histogram-grown, keep monotonic
constraints on chosen features (``textstats.FEATURES``), and are flattened
into numpy node arrays, which score a batch of documents for all trees at once.

Defined cases: a null text counts as empty; a text of no words fails the base
rule; repeated rows give one output row each; labels that are null or
contradict each other are averaged and cut at 0.5; without labels of both
kinds the trees are constant and only the base rule decides; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textstats import COUNTS, FEATURES, MORE, document_stats, features, stats_frame

TRAIN_ROWS = 20_000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node arrays with absolute child numbers; leaves point at themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], n_trees: int = 80, depth: int = 3,
              rate: float = 0.15, bins: int = 48, l2: float = 2.0, min_rows: int = 8) -> Trees:
    """Second-order boosting of the logistic loss on quantile bins.

    A split on a constrained feature is taken only if the child values obey
    its direction, and both children inherit the middle of the two values as
    a bound, so that no later split below can break the order.
    """
    n, d = x.shape
    positive = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(positive / (1 - positive)))
    nodes: list[list] = []
    roots: list[int] = []
    if n == 0 or y.min() == y.max():
        zero = np.zeros(1, np.int64)
        return Trees(zero, np.zeros(1), zero, zero, np.zeros(1), np.zeros(1, np.int64), 0, 5.0)  # keeps all: one kind of label tells nothing
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    codes = np.column_stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(d)])
    margin = np.full(n, base)

    def leaf(value: float) -> int:
        nodes.append([0, 0.0, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, left_levels: int) -> int:
        gs, hs = g[rows].sum(), h[rows].sum()
        value = float(np.clip(-gs / (hs + l2), low, high))
        if left_levels == 0 or len(rows) < 2 * min_rows:
            return leaf(rate * value)
        best = (1e-6, None)
        for j in range(d):
            m = len(cuts[j]) + 1
            if m < 2:
                continue
            code = codes[rows, j]
            gl = np.cumsum(np.bincount(code, g[rows], m))[:-1]
            hl = np.cumsum(np.bincount(code, h[rows], m))[:-1]
            nl = np.cumsum(np.bincount(code, minlength=m))[:-1]
            vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-(gs - gl) / (hs - hl + l2), low, high)
            gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
            ok = (nl >= min_rows) & (len(rows) - nl >= min_rows)
            if directions[j]:
                ok &= directions[j] * (vr - vl) >= 0
            gain = np.where(ok, gain, -np.inf)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), (j, k, float(vl[k]), float(vr[k])))
        if best[1] is None:
            return leaf(rate * value)
        j, k, vl, vr = best[1]
        middle = (vl + vr) / 2
        bounds = [(low, high), (low, high)]
        if directions[j] > 0:
            bounds = [(low, middle), (middle, high)]
        elif directions[j] < 0:
            bounds = [(middle, high), (low, middle)]
        me = len(nodes)
        nodes.append([j, float(cuts[j][k]), 0, 0, 0.0])
        inside = codes[rows, j] <= k
        nodes[me][2] = grow(rows[inside], g, h, *bounds[0], left_levels - 1)
        nodes[me][3] = grow(rows[~inside], g, h, *bounds[1], left_levels - 1)
        return me

    for _ in range(n_trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        first = len(nodes)
        root = grow(np.arange(n), p - y, p * (1 - p), -6.0, 6.0, depth)
        roots.append(root)
        one = _flat(nodes[first:], [root - first], depth, 0.0, first)
        margin += one.margin(x)
    return _flat(nodes, roots, depth, base)


def _flat(nodes: list[list], roots: list[int], depth: int, base: float, shift: int = 0) -> Trees:
    f, t, left, right, v = zip(*nodes, strict=True)
    return Trees(np.array(f), np.array(t), np.array(left) - shift, np.array(right) - shift, np.array(v),
                 np.array(roots), depth, base)


def train(stats: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees fitted on at most ``train_rows`` labelled documents of ``stats``."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.avg("quality").alias("y"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    rows = (stats.join(F.broadcast(known), "doc_id")  # at most train_rows rows of 16 bytes
            .groupBy("doc_id").agg(F.first("y").alias("y"), *[F.avg(c).alias(c) for c in COUNTS + MORE])
            .toPandas().sort_values("doc_id", ignore_index=True))
    return fit_trees(features(rows), (rows["y"].to_numpy(np.float64) >= 0.5).astype(np.float64),
                     list(FEATURES.values()))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality_rules(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS,
                  threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base statistics, base_failed, tree_score, kept."""
    stats = materialize(document_stats(docs), "quality-rules-stats")
    trees = train(stats, labels, train_rows)

    @F.pandas_udf("double")
    def tree_score(s: pd.DataFrame) -> pd.Series:
        return pd.Series(trees.score(features(s)))

    return stats.withColumn("tree_score", tree_score(F.struct(*COUNTS, *MORE))).select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"),
        (~base_failed() & (F.col("tree_score") >= threshold)).alias("kept"), "tree_score")


def keep(texts: pd.Series, trees: Trees, threshold: float = 0.5) -> np.ndarray:
    """The verdict on a batch of texts, for use inside other pandas functions."""
    s = stats_frame(texts)
    failed = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > MAX_REPEAT_PERCENT * s.n_words)
    return (~failed & (trees.score(features(s)) >= threshold)).to_numpy()
