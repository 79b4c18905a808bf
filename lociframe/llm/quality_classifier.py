"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each class has a mean and a covariance shrunk towards the pooled covariance and then towards its diagonal; the score is
the logistic of the difference of the two Mahalanobis log-densities. The Cholesky factors are computed once and cached in
the model that tasks receive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm.frames import table, written
from lociframe.llm.stats import features, labelled_sample, training_rows, with_stats
from lociframe.llm.workers import tidied


@dataclass(frozen=True)
class Discriminant:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]  # inverse Cholesky factors
    constant: tuple[float, float]  # log prior - log det / 2

    def score(self, x: np.ndarray) -> np.ndarray:
        """P(label 1), the log-density difference tempered by the number of features."""
        z = np.clip((transformed(x) - self.centre) / self.scale, -8, 8)
        # row by row, so that a row's score does not depend on the batch it comes in
        logs = [c - 0.5 * (((z - m)[:, None, :] * w[None]).sum(2) ** 2).sum(1) for m, w, c in zip(self.means, self.whiten, self.constant, strict=True)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -700, 700) / 4))


def transformed(x: np.ndarray) -> np.ndarray:
    """Heavy tails drawn in: square roots of ratios, logarithms as they are."""
    return np.sign(x) * np.sqrt(np.abs(x))


def fit(x: np.ndarray, y: np.ndarray, to_pooled: float = 0.3, to_diagonal: float = 0.1, ridge: float = 1e-2) -> Discriminant:
    """Shrinkage QDA. A class without rows takes the pooled mean and covariance; without any rows every score is 0.5."""
    z = transformed(x)
    k = x.shape[1]
    centre, scale = (z.mean(0), z.std(0) + 1e-6) if len(z) else (np.zeros(k), np.ones(k))
    z = np.clip((z - centre) / scale, -8, 8)
    rows = [z[y == c] for c in (0, 1)]
    own = [np.cov(r, rowvar=False, bias=True).reshape(k, k) if len(r) > 1 else None for r in rows]
    weight = [max(len(r), 1) for r in rows]
    there = [(s, w) for s, w in zip(own, weight, strict=True) if s is not None]
    pooled = sum(s * w for s, w in there) / sum(w for _, w in there) if there else np.eye(k)
    means, whiten, constant = [], [], []
    for r, s, w in zip(rows, own, weight, strict=True):
        s = pooled if s is None else (1 - to_pooled) * s + to_pooled * pooled
        s = (1 - to_diagonal) * s + to_diagonal * np.diag(np.diag(s)) + ridge * np.eye(k)
        lower = np.linalg.cholesky(s)
        means.append(r.mean(0) if len(r) else np.zeros(k))
        whiten.append(np.linalg.inv(lower))
        constant.append(float(np.log((len(r) + 1) / (len(z) + 2)) - np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(whiten), tuple(constant))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000) -> Discriminant:
    """The model of at most about `bound` labelled documents outside the held-out third; only their texts are looked at."""
    good = labelled_sample(labels, bound)
    # bounded by `bound`
    part = docs.join(F.broadcast(good.select(F.col("doc_id").alias(id_col))), id_col, "left_semi")
    train = training_rows(with_stats(part, id_col, text_col), good)
    return fit(features(train), train["quality"].to_numpy(int))


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of `docs`.

    The model is fitted on at most about `bound` labelled rows outside the held-out third (crc32 of the id as text, mod 3,
    is 1). Null and empty texts are scored like any other; a null id is never held out; an empty table gives no rows.
    """
    stats = written(with_stats(docs, id_col, text_col), "stats")
    train = training_rows(stats, labelled_sample(labels, bound))
    model = fit(features(train), train["quality"].to_numpy(int))

    @tidied
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.score(features(pdf))})

    return stats.mapInPandas(judge, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
