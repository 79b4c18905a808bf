"""Quality rules: hard limits on counts, then gradient-boosted trees over document statistics.

The trees are grown on histograms (second-order logistic boosting) on a bounded sample of labelled rows, with monotonic
constraints on the features that can only speak against a document, and are flattened into numpy node arrays: scoring a
batch is `depth` rounds of array lookups for all trees and rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import table, written
from lociframe.llm.stats import COUNTS, WORSE, features, labelled_sample, text_stats, training_rows, with_stats
from lociframe.llm.workers import tidied


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: node i of a tree has children 2i+1 and 2i+2; leaves stand after the nodes."""

    feature: np.ndarray  # (trees, nodes) int
    threshold: np.ndarray  # (trees, nodes): left if value <= threshold
    leaf: np.ndarray  # (trees, nodes + 1)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        nodes = self.feature.shape[1]
        depth = (nodes + 1).bit_length() - 1
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        for a in range(0, len(x), 4096):
            at = np.zeros((len(x[a : a + 4096]), len(self.feature)), np.int64)
            part = x[a : a + 4096]
            for _ in range(depth):
                right = part[rows[: len(part)], self.feature[trees, at]] > self.threshold[trees, at]
                at = 2 * at + 1 + right
            out[a : a + 4096] += self.leaf[trees, at - nodes].sum(1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def grow(x: np.ndarray, y: np.ndarray, worse: tuple[int, ...] = WORSE, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, ridge: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for labels y in {0, 1}; the score never rises with a feature named in `worse`.

    No rows, or labels of one kind: trees that give a constant (0.5, or the smoothed rate of that label).
    """
    n, k = x.shape
    nodes = (1 << depth) - 1
    rate_y = (y.sum() + 1) / (n + 2)
    model = {"feature": np.zeros((trees, nodes), np.int64), "threshold": np.full((trees, nodes), np.inf), "leaf": np.zeros((trees, nodes + 1))}
    base = float(np.log(rate_y / (1 - rate_y)))
    if n == 0 or y.min() == y.max():
        return Trees(model["feature"][:1], model["threshold"][:1], model["leaf"][:1], base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    sign = np.zeros(k)
    sign[list(worse)] = -1
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        low, high = {0: -np.inf}, {0: np.inf}
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            lo, hi = low[node], high[node]
            best, gain = None, 1e-9
            if len(rows) >= 2:
                gs, hs = g[rows], h[rows]
                total_g, total_h = gs.sum(), hs.sum()
                for j in range(k):
                    m = len(edges[j])
                    if not m:
                        continue
                    gl = np.cumsum(np.bincount(binned[rows, j], gs, m + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[rows, j], hs, m + 1))[:-1]
                    gr, hr = total_g - gl, total_h - hl
                    vl, vr = np.clip(-gl / (hl + ridge), lo, hi), np.clip(-gr / (hr + ridge), lo, hi)
                    value = -(gl * vl + 0.5 * (hl + ridge) * vl**2) - (gr * vr + 0.5 * (hr + ridge) * vr**2)
                    value[(hl < least) | (hr < least)] = -np.inf
                    if sign[j]:
                        value[(vr - vl) * sign[j] < 0] = -np.inf
                    i = int(np.argmax(value))
                    v0 = np.clip(-total_g / (total_h + ridge), lo, hi)
                    rise = value[i] + (total_g * v0 + 0.5 * (total_h + ridge) * v0**2)
                    if rise > gain:
                        best, gain = (j, i, vl[i], vr[i]), rise
            left, right = 2 * node + 1, 2 * node + 2
            low[left], high[left], low[right], high[right] = lo, hi, lo, hi
            if best is None:  # all rows go left, to a leaf of this node's value
                at[rows] = left
                continue
            j, i, vl, vr = best
            model["feature"][t, node], model["threshold"][t, node] = j, edges[j][i]
            at[rows] = np.where(binned[rows, j] <= i, left, right)
            if sign[j]:
                mid = (vl + vr) / 2
                low[left], high[right] = max(lo, mid), min(hi, mid)
        leaf = at - nodes
        gl, hl = np.bincount(leaf, g, nodes + 1), np.bincount(leaf, h, nodes + 1)
        for q in range(nodes + 1):
            model["leaf"][t, q] = rate * np.clip(-gl[q] / (hl[q] + ridge), low[nodes + q], high[nodes + q])
        margin += model["leaf"][t][leaf]
    return Trees(model["feature"], model["threshold"], model["leaf"], base)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """Rows (doc_id, COUNTS, base_failed, score, kept), one per row of `docs`.

    base_failed: fewer than 50 words, or more than half of the words in repeated 3-word windows. kept: not base_failed and
    a tree score of at least `threshold`. Null and empty texts have no words and fail; repeated rows each have a row; an
    empty table gives no rows; without labels the score is constant and the base rules decide alone.
    """
    stats = written(with_stats(docs, id_col, text_col), "stats")
    train = training_rows(stats, labelled_sample(labels, bound))
    trees = grow(features(train), train["quality"].to_numpy(float))

    @tidied
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[["doc_id", *COUNTS]].copy()
            out["base_failed"] = (pdf["n_words"] < 50) | (100 * pdf["n_repeat_words"] > 50 * pdf["n_words"])
            out["score"] = trees.score(features(pdf))
            out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
            yield out

    schema = "doc_id long, " + ", ".join(f"{f} long" for f in COUNTS) + ", base_failed boolean, score double, kept boolean"
    return stats.mapInPandas(judge, schema)


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that the quality rules keep, all columns as they are; decided in one pass, without a shuffle of texts."""
    good = labelled_sample(labels, bound)
    # bounded by `bound`: the hash sample keeps about that many ids
    part = docs.join(F.broadcast(good.select(F.col("doc_id").alias(id_col))), id_col, "left_semi")
    train = training_rows(with_stats(part, id_col, text_col), good)
    trees = grow(features(train), train["quality"].to_numpy(float))
    at = docs.columns.index(text_col)

    @tidied
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = A.text_bytes(batch.column(at))
            for a, b, some, where in A.pieces(data, offs):
                s = pd.DataFrame(text_stats(some, where))
                failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
                yield batch.slice(a, b - a).filter(pa.array((~failed & (trees.score(features(s)) >= threshold)).to_numpy()))

    return docs.mapInArrow(judge, docs.schema)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
