"""Quality classifier: regularised quadratic discriminant over document statistics.

Class moments are sums over every training row: each batch emits one row of
partial sums per class, so the shuffle carries a few rows per task. The class
covariances are shrunk towards the pooled diagonal; the score is the logistic
of the difference of the two log densities, whose Mahalanobis terms use
Cholesky factors computed once on the driver.

Training rows: labelled documents with ``crc32(doc_id as text) mod 3 <> 1``.
Labels, lang, source and doc_id are never inputs of a score.

Defined cases: null text counts as empty and is scored as such; a null doc_id
hashes as the empty string and is never labelled; repeated rows give one
output row each; contradicting labels of a doc_id are averaged and cut at 0.5;
if a class has no training row, every score is the share of label 1 (0.5
without labels).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .textstats import COUNTS, FEATURES, MORE, document_stats, features, stats_frame

HELD_OUT = 1
SHRINKAGE = 0.1
RIDGE = 1e-3


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the doc_id's text, modulo 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


@dataclass(frozen=True)
class Discriminant:
    """Scores by the difference of two Gaussian log densities; ``factors`` are lower Cholesky factors."""

    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray] | None
    factors: tuple[np.ndarray, np.ndarray] | None
    log_prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.log_prior)
        if self.means is not None:
            z = x / self.scale
            for sign, mean, low in zip((-1.0, 1.0), self.means, self.factors, strict=True):
                part = np.linalg.solve(low, (z - mean).T)
                margin += sign * (-0.5 * (part**2).sum(axis=0) - np.log(np.diag(low)).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -36.0, 36.0)))


def class_moments(stats: DataFrame, labels: DataFrame, fold_column: Column | None = None) -> dict[int, tuple]:
    """By class: count, sum and sum of outer products of the features of all training rows."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .where((fold() if fold_column is None else fold_column) != HELD_OUT)
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality")))
    d = len(FEATURES)
    sums = [f"s{i}" for i in range(1 + d + d * d)]

    def partial(batches):
        total = {}
        for pdf in batches:
            if len(pdf):
                x, y = features(pdf), pdf["quality"].to_numpy()
                for k in (0, 1):
                    z = x[y == k]
                    if len(z):
                        row = np.concatenate(([len(z)], z.sum(axis=0), (z.T @ z).ravel()))
                        total[k] = total[k] + row if k in total else row
        if total:
            yield pd.DataFrame([[k, *v] for k, v in total.items()], columns=["quality", *sums])

    rows = (stats.join(known, "doc_id")
            .mapInPandas(partial, "quality long, " + ", ".join(f"{c} double" for c in sums))
            .groupBy("quality").agg(*[F.sum(c).alias(c) for c in sums]).collect())
    out = {}
    for r in rows:
        v = np.array(r[1:])
        out[int(r[0])] = (v[0], v[1:1 + d], v[1 + d:].reshape(d, d))
    return out


def fit(moments: dict[int, tuple], shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
    """Shrunk class covariances (towards the pooled diagonal) and their Cholesky factors."""
    d = len(FEATURES)
    n = {k: moments[k][0] if k in moments else 0.0 for k in (0, 1)}
    if not n[0] or not n[1]:
        share = n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
        share = float(np.clip(share, 1e-6, 1 - 1e-6))
        return Discriminant(np.ones(d), None, None, float(np.log(share / (1 - share))))
    means = {k: moments[k][1] / n[k] for k in (0, 1)}
    cov = {k: moments[k][2] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)}
    pooled = np.maximum(sum(n[k] * np.diag(cov[k]) for k in (0, 1)) / (n[0] + n[1]), 1e-8)
    scale = np.sqrt(pooled)
    factors = []
    for k in (0, 1):
        c = cov[k] / np.outer(scale, scale)
        c = (1 - shrinkage) * c + shrinkage * np.eye(d) + ridge * np.eye(d)
        factors.append(np.linalg.cholesky(c))
    return Discriminant(scale, (means[0] / scale, means[1] / scale), tuple(factors), float(np.log(n[1] / n[0])))


def train(docs: DataFrame, labels: DataFrame) -> tuple[Discriminant, DataFrame]:
    """The model and the written statistics of all documents."""
    stats = materialize(document_stats(docs), "quality-classifier-stats")
    return fit(class_moments(stats, labels)), stats


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5)."""
    model, stats = train(docs, labels)

    @F.pandas_udf("double")
    def score(s: pd.DataFrame) -> pd.Series:
        return pd.Series(model.score(features(s)))

    return stats.select("doc_id", score(F.struct(*COUNTS, *MORE)).alias("score")).select(
        "doc_id", (fold() == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to carry label 1, all columns kept."""
    model, _ = train(docs, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(features(stats_frame(texts))))

    return docs.where(score(F.col("text").cast("string")) >= 0.5)
