"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut in halves; each half has a codebook of its own, and the pairs of codewords form a grid of cells. Every
vector lives in the cell of its two nearest codewords and visits cells in order of distance (the multi-sequence of the two
sorted codebooks) as far as the target recall asks; there it is compared in double precision with all who live there. How
far to go is measured, not guessed: sampled vectors are moved to the threshold similarity in random directions, and the
number of cells visited is the target quantile of where the moved vectors live.

A pair is found if either visits the other's cell; where only one does, the cell's task counts the link for both. Cells with
many residents are cut into slices. Per cell a spanning forest and counts go on, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import Scratch, components, table, written
from lociframe.llm.simhash import forest
from lociframe.llm.workers import tidied, tidied_group

SLICE = 2048


def half_costs(x: np.ndarray, codebook: np.ndarray) -> np.ndarray:
    """(rows, codewords) squared distances, each computed alone so that any batch gives the same value."""
    out = np.empty((len(x), len(codebook)))
    for k, c in enumerate(codebook):
        out[:, k] = ((x - c) ** 2).sum(1)
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Codebook of at most k rows."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centre = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds if len(distinct) > k else 0):
        near = ((centre**2).sum(1)[None] - 2 * x @ centre.T).argmin(1)
        size = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        centre[size > 0] = total[size > 0] / size[size > 0, None]
    return centre


@dataclass(frozen=True)
class Grid:
    first: np.ndarray
    second: np.ndarray
    visits: int

    def costs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return half_costs(x[:, :half], self.first), half_costs(x[:, half:], self.second)

    def home(self, x: np.ndarray) -> np.ndarray:
        a, b = self.costs(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visited(self, x: np.ndarray, visits: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell) of every visit, and each row's largest visited cost; all cells up to that cost are visited."""
        a, b = self.costs(x)
        m = min(visits or self.visits, a.shape[1] * b.shape[1])
        # the m nearest cells lie among the m nearest codewords of each half, rank product at most m
        ra, rb = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        sa, sb = np.take_along_axis(a, ra, 1), np.take_along_axis(b, rb, 1)
        i, j = np.nonzero(np.outer(np.arange(1, a.shape[1] + 1), np.arange(1, b.shape[1] + 1)) <= m)
        cost = sa[:, i] + sb[:, j]
        far = np.partition(cost, m - 1, axis=1)[:, m - 1]
        row, pick = np.nonzero(cost <= far[:, None])
        return row, ra[row, i[pick]] * len(self.second) + rb[row, j[pick]], far

    def cost_of(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Cost of one cell for each row, by the same arithmetic as `costs`."""
        half = self.first.shape[1]
        i, j = cell // len(self.second), cell % len(self.second)
        return ((x[:, :half] - self.first[i]) ** 2).sum(1) + ((x[:, half:] - self.second[j]) ** 2).sum(1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. They are scaled by their largest component first, so no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.maximum(np.abs(x).max(1, initial=0), np.finfo(np.float64).tiny)[:, None]
    return x / np.sqrt((x * x).sum(1))[:, None]


def train(sample: np.ndarray, points: int, threshold: float, recall: float, seed: int = 5) -> Grid:
    """Codebooks and the number of visits. sample: unit rows; points: size of the whole collection."""
    half = max(1, sample.shape[1] // 2)
    k = int(np.clip(round(np.sqrt(points / 100)), 4, 512))
    grid = Grid(kmeans(sample[:, :half], k), kmeans(sample[:, half:], k), 1)
    rng = np.random.default_rng(seed)
    x = sample[rng.permutation(len(sample))[:2000]]
    noise = rng.standard_normal(x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    moved = threshold * x + np.sqrt(1 - threshold**2) * noise / np.maximum(np.sqrt((noise**2).sum(1)), 1e-12)[:, None]
    a, b = grid.costs(x)
    cell = grid.home(unit(moved))
    cost = a[np.arange(len(x)), cell // len(grid.second)] + b[np.arange(len(x)), cell % len(grid.second)]
    rank = np.array([(ai[:, None] + bi[None, :] <= c).sum() for ai, bi, c in zip(a, b, cost, strict=True)])
    return Grid(grid.first, grid.second, int(np.quantile(rank, recall)))


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95, recall: float = 0.97, sample: int = 20_000) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of `vectors`.

    Links are pairs found with cosine >= threshold, in double precision, none below. A vector that is null, of another
    length than most, zero, or holds a null or non-finite component links with nothing: n_links 0, itself its component.
    Equal vectors are one point with a multiplicity. A row with a null id has a null component and is not kept; repeated
    rows link with each other; an empty table gives no rows. The codebooks are trained on at most about `sample` points.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    lengths = rows.where("v is not null and size(v) > 0").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = lengths["n"] if lengths else 1
    sound = (F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.col("v"))).withColumn("point", F.xxhash64("v"))
    points = rows.where("v is not null").groupBy("point").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("first"))
    scratch = Scratch(vectors.sparkSession)
    points = scratch.written(points, "points")
    n = points.count()
    part = points if n <= sample else points.where(F.pmod(F.xxhash64(F.lit(11), "point"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    picked = part.orderBy("point").select("v").toArrow().column("v").combine_chunks()
    grid = train(unit(np.asarray(picked.values).reshape(-1, dims)), n, threshold, recall) if n else Grid(np.zeros((1, max(1, dims // 2))), np.zeros((1, dims - max(1, dims // 2))), 1)

    def matrix(column: pa.Array) -> np.ndarray:
        return unit(np.asarray(column.flatten()).reshape(-1, dims))

    @tidied
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(grid.home(matrix(batch.column(0))))], names=["cell"])

    # at most 512 x 512 cells
    residents = points.select("v").mapInArrow(homes, "cell long").groupBy("cell").count().where(F.col("count") > SLICE).collect()
    slices = {r["cell"]: -(-r["count"] // SLICE) for r in residents}
    # vectors travel as they came, in four bytes a component if they are floats, and are made unit length again where compared
    raw = "<f4" if "float" in dict(vectors.dtypes)[vector_col] else "<f8"
    kind = np.dtype([("cell", "<i8"), ("slice", "<i4"), ("lives", "u1"), ("point", "<i8"), ("home", "<i8"), ("times", "<i8"), ("far", "<f8"), ("v", raw, (dims,))])
    buckets = max(64, int(n * grid.visits * kind.itemsize / 16e6))

    @tidied
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                few = batch.slice(s, 500)
                given = np.asarray(few.column(1).flatten()).reshape(-1, dims)
                x = unit(given)
                row, cell, far = grid.visited(x)
                home = grid.home(x)
                entries = np.zeros(len(row) + len(x), kind)
                at = np.concatenate([row, np.arange(len(x))])
                entries["cell"], entries["lives"] = np.concatenate([cell, home]), np.arange(len(at)) >= len(row)
                for name, values in (("point", np.asarray(few.column(0))), ("home", home), ("times", np.asarray(few.column(2))), ("far", far), ("v", given)):
                    entries[name] = values[at]
                if slices:  # residents go to one slice of their cell, visitors to all
                    parts = np.array([slices.get(c, 1) for c in entries["cell"].tolist()])
                    copies = np.where(entries["lives"] == 1, 1, parts)
                    entries = np.repeat(entries, copies)
                    number = np.arange(len(entries)) - np.repeat(np.cumsum(copies) - copies, copies)
                    own = (A.mix(entries["point"].astype(A.U64)) % np.repeat(parts, copies).astype(A.U64)).astype(np.int64)
                    entries["slice"] = np.where(entries["lives"] == 1, own, number)
                bucket = (A.mix(entries["cell"].astype(A.U64) * A.MULT + entries["slice"].astype(A.U64)) % A.U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                entries, bucket = entries[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                yield pa.RecordBatch.from_arrays([pa.array(bucket[np.concatenate([[0], cuts])]), pa.array([e.tobytes() for e in np.split(entries, cuts)], pa.binary())], names=["bucket", "payload"])

    @tidied_group
    def compare(group: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(group.column("payload").to_pylist()), kind)
        order = np.lexsort((entries["lives"], entries["slice"], entries["cell"]))
        cell, piece = entries["cell"][order], entries["slice"][order]
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(cell) != 0) | (np.diff(piece) != 0)]))
        ids, counts, edge_a, edge_b = [], [], [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
            here = entries[order[s:e]]
            guests, own = here[here["lives"] == 0], here[here["lives"] == 1]
            own_v = unit(own["v"])
            a = b = np.zeros(0, np.int64)
            for g in range(0, len(guests), 512):
                some = guests[g : g + 512]
                i, j = np.nonzero(unit(some["v"]) @ own_v.T >= threshold)
                x, y = some[i], own[j]
                differ = x["point"] != y["point"]
                x, y = x[differ], y[differ]
                if not len(x):
                    continue
                ids.append(x["point"])
                counts.append(y["times"])
                one_way = x["home"] != y["home"]
                one_way[one_way] = grid.cost_of(unit(y["v"][one_way]), x["home"][one_way]) > y["far"][one_way]
                ids.append(y["point"][one_way])
                counts.append(x["times"][one_way])
                a, b = np.concatenate([a, x["point"]]), np.concatenate([b, y["point"]])
                if len(a) > 1 << 17:
                    p, q, nodes = forest(a, b)
                    a, b = nodes[p], nodes[q]
                    total = np.unique(np.concatenate(ids), return_inverse=True)
                    ids, counts = [total[0]], [np.bincount(total[1], np.concatenate(counts)).astype(np.int64)]
            if len(a):
                p, q, nodes = forest(a, b)
                edge_a.append(nodes[p])
                edge_b.append(nodes[q])
        point, n_links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if ids:
            point, at = np.unique(np.concatenate(ids), return_inverse=True)
            n_links = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        ea = np.concatenate([*edge_a, np.zeros(0, np.int64)])
        eb = np.concatenate([*edge_b, np.zeros(0, np.int64)])
        return pa.table({"a": pa.array(np.concatenate([point, ea])), "b": pa.array(np.concatenate([np.zeros(len(point), np.int64), eb])), "n": pa.array(np.concatenate([n_links, np.zeros(len(ea), np.int64)]))})

    found = scratch.written(points.select("point", "v", "times").mapInArrow(place, "bucket long, payload binary").groupBy("bucket").applyInArrow(compare, "a long, b long, n long"), "found")
    counted = found.where("n > 0").groupBy(F.col("a").alias("p")).agg(F.sum("n").alias("others"))
    parts = components(found.where("n = 0").select("a", "b"))
    grouped = points.select("point", "times", "first").join(parts, F.col("point") == F.col("node"), "left").select("point", "times", "first", F.coalesce("component", "point").alias("group"))
    least = grouped.groupBy("group").agg(F.min("first").alias("least"))
    label = grouped.join(least, "group").join(counted, F.col("point") == F.col("p"), "left").select(F.col("point").alias("q"), (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("n"), "least")
    joined = rows.select("vec_id", F.when(F.col("v").isNotNull(), F.col("point")).alias("point")).join(label, F.col("point") == F.col("q"), "left")
    result = joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("least", "vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(False)).alias("kept"),
    )
    result = written(result, "classes")
    scratch.remove()
    return result


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))
