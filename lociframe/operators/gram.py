"""Pair statistics as blocked Gram products.

Every statistic here is a sum over sites of products f(x) g(y) of one sample's feature with another's. The cells of SITES sites and
BLOCK samples are packed into one small matrix; a task takes some packs of two sample blocks, lines their sites up, and multiplies
features by BLAS. What leaves it is one row for each pair of samples, summed over all its sites, so the rows that are shuffled
follow the pairs and the number of tasks, never pairs times sites.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Sites of a pack, samples of a block at most, and packs that a task multiplies.
SITES, BLOCK, PACKS = 4096, 256, 8
#: Features of a matrix (sites, samples, values) with NaN where nothing is known; `site` has the sites' own values.
Features = Callable[[np.ndarray, np.ndarray], Sequence[np.ndarray]]


def numbered_samples(gt: DataFrame) -> DataFrame:
    """(sample_id, n): samples from 0 in order of their names."""
    # one row per sample
    return gt.select("sample_id").where("sample_id is not null").distinct().withColumn("n", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("sample_id")) - 1).cast("int"))


def counted_samples(gt: DataFrame) -> tuple[DataFrame, int, int]:
    """(samples (sample_id, n) from 0 in order of their names, how many, the most cells of one): one pass over the cells."""
    cells = gt.where("sample_id is not null").groupBy("sample_id").agg(F.count(F.lit(1)).alias("cells"))
    # one row per sample
    samples = cells.withColumn("n", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy("sample_id")) - 1).cast("int")).cache()
    size = samples.agg(F.count(F.lit(1)).alias("n"), F.max("cells").alias("most")).first()
    return samples.drop("cells"), size["n"], size["most"] or 0


def packs(gt: DataFrame, samples: DataFrame, values: Sequence[Column], site: Sequence[Column] = (), pack: Column | None = None, sites: int = 0, block: int = BLOCK) -> DataFrame:
    """(pack, block, n_sites, payload): cells with all `values` known, some sites and one block of samples a row. `pack` deals the sites,
    all samples of a site alike; by default a hash, about SITES each of `sites`. Cells of one site and sample must not repeat."""
    used = gt.where(" and ".join(["sample_id is not null", "chrom is not null", "pos is not null"]))
    if pack is None:
        pack = F.pmod(F.xxhash64("chrom", "pos"), F.lit(max(8, -(-sites // SITES))))
    width, wide = len(values), len(site)
    cells = used.select("sample_id", pack.alias("pack"), F.xxhash64("chrom").alias("c"), F.col("pos").cast("long").alias("p"), F.array(*(v.cast("double") for v in values)).alias("v"), F.array(*(s.cast("double") for s in site)).cast("array<double>").alias("s"))
    cells = cells.where(F.forall("v", lambda x: x.isNotNull())).join(samples, "sample_id").select("pack", (F.col("n") / block).cast("int").alias("block"), F.pmod("n", F.lit(block)).alias("col"), "c", "p", "v", "s")

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        place = np.zeros(rows.num_rows, [("c", "<i8"), ("p", "<i8")])
        place["c"], place["p"] = rows.column("c").to_numpy(), rows.column("p").to_numpy()
        sites, at = np.unique(place, return_inverse=True)
        matrix = np.full((len(sites), block, width), np.nan)
        matrix[at, rows.column("col").to_numpy()] = rows.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
        own = np.zeros((len(sites), wide))
        own[at] = rows.column("s").combine_chunks().flatten().to_numpy().reshape(-1, wide) if wide else 0
        small = matrix.astype(np.float32)
        matrix = small if ((small == matrix) | np.isnan(matrix)).all() else matrix
        payload = sites.tobytes() + own.tobytes() + matrix.tobytes()
        return pa.table({"pack": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int32()), "n_sites": pa.array([len(sites)], pa.int32()), "single": [matrix.dtype == np.float32], "payload": pa.array([payload], pa.binary())})

    return cells.groupBy("pack", "block").applyInArrow(gather, "pack long, block int, n_sites int, single boolean, payload binary")


def unpacked(row: dict, width: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sites, their values, matrix) of a pack."""
    n, raw = row["n_sites"], row["payload"]
    sites = np.frombuffer(raw, [("c", "<i8"), ("p", "<i8")], n)
    own = np.frombuffer(raw, "<f8", n * wide, 16 * n).reshape(n, wide)
    matrix = np.frombuffer(raw, "<f4" if row["single"] else "<f8", -1, 16 * n + 8 * n * wide).reshape(n, -1, width).astype(np.float64)
    return sites, own, matrix


def block_pairs(packed: DataFrame, blocks: int) -> DataFrame:
    """Each pack for all pairs (p, q), p <= q, of its block with another."""
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    exploded = packed.withColumn("o", F.explode(others))
    return exploded.select("*", F.least("block", "o").alias("p"), F.greatest("block", "o").alias("q")).drop("o")


def paired(rows: pa.Table, p: int, q: int, width: int, wide: int) -> Iterator[tuple]:
    """(pack row, sites' values, matrix of p, matrix of q) over the sites that both blocks have, pack by pack."""
    by_pack: dict[int, dict[int, dict]] = {}
    fields = [rows.column(c).to_pylist() for c in ("pack", "block", "n_sites", "single")]
    for pack, block, n_sites, single, payload in zip(*fields, (x for part in rows.column("payload").chunks for x in part), strict=True):
        by_pack.setdefault(pack, {})[block] = {"pack": pack, "n_sites": n_sites, "single": single, "payload": payload.as_buffer()}
    for pack in sorted(by_pack):
        both = by_pack[pack]
        if p not in both or q not in both:
            continue
        sites, own, x = unpacked(both[p], width, wide)
        if p == q:
            yield both[p], own, x, x
            continue
        others, _, y = unpacked(both[q], width, wide)
        _, i, j = np.intersect1d(sites, others, assume_unique=True, return_indices=True)
        if len(i):
            yield both[p], own[i], x[i], y[j]


def gram_sums(gt: DataFrame, values: Sequence[Column], features: Features, products: Sequence[tuple[str, int, int]], site: Sequence[Column] = (), include_self: bool = False, counted: tuple[DataFrame, int, int] | None = None) -> DataFrame:
    """(sample_i, sample_j, n, one double for each product), sample_i < sample_j (or <=): sums over the n sites where both samples have
    all `values`. products: (name, feature of i, feature of j). A pair without common sites has no row.
    counted: `counted_samples` of cells that hold those of gt."""
    samples, n_samples, sites = counted or counted_samples(gt)
    block = max(1, min(BLOCK, n_samples))
    blocks = -(-n_samples // block)
    width, wide, names = len(values), len(site), [name for name, _, _ in products]
    out = "i int, j int, n double, " + ", ".join(f"{name} double" for name in names)

    def multiply(key: tuple, rows: pa.Table) -> pa.Table:
        p, q = key[1].as_py(), key[2].as_py()
        sums = np.zeros((1 + len(products), block, block))
        for _, own, x, y in paired(rows, p, q, width, wide):
            known = [np.isfinite(m).all(2).astype(np.float64) for m in (x, y)]
            with np.errstate(invalid="ignore"):
                f, g = ([np.where(k > 0, v, 0.0) for v in features(np.moveaxis(m, 2, 0), own)] for m, k in zip((x, y), known, strict=True))
            sums[0] += known[0].T @ known[1]
            for r, (_, a, b) in enumerate(products, 1):
                sums[r] += f[a].T @ g[b]
        i, j = np.nonzero(sums[0])
        if p == q:
            keep = i <= j if include_self else i < j
            i, j = i[keep], j[keep]
        return pa.table({"i": pa.array((i + p * block).astype(np.int32)), "j": pa.array((j + q * block).astype(np.int32)), "n": sums[0][i, j]} | {name: sums[r][i, j] for r, name in enumerate(names, 1)})

    packed = packs(gt, samples, values, site, sites=sites, block=block)
    found = block_pairs(packed, blocks).groupBy(F.floor(F.col("pack") / PACKS).alias("some"), "p", "q").applyInArrow(multiply, out)
    summed = found.groupBy("i", "j").agg(F.sum("n").cast("long").alias("n"), *(F.sum(name).alias(name) for name in names))
    return named(summed, samples)


def named(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    """Numbers i and j as sample_i and sample_j."""
    a = samples.select(F.col("sample_id").alias("sample_i"), F.col("n").alias("i"))
    b = samples.select(F.col("sample_id").alias("sample_j"), F.col("n").alias("j"))
    rest = [c for c in pairs.columns if c not in ("i", "j")]
    return pairs.join(a, "i").join(b, "j").select("sample_i", "sample_j", *rest)


def dosages(x: np.ndarray, site: np.ndarray) -> list[np.ndarray]:
    """Indicators of dosages 0, 1 and 2, and of every known one."""
    return [(x[0] == d).astype(np.float64) for d in range(3)] + [np.ones_like(x[0])]


def standardised(x: np.ndarray, site: np.ndarray) -> list[np.ndarray]:
    """(x - 2p) / sqrt(2p(1 - p)), its diagonal term (x^2 - (1 + 2p)x + 2p^2) / (2p(1 - p)), and one."""
    p = site[:, :1]
    spread = 2 * p * (1 - p)
    return [(x[0] - 2 * p) / np.sqrt(spread), (x[0] ** 2 - (1 + 2 * p) * x[0] + 2 * p * p) / spread, np.ones_like(x[0])]


def replicate_distances(gt: DataFrame, block_of: Column, weights: Column, reps: int) -> DataFrame:
    """(rep, sample_i, sample_j, d, n): sums over blocks of sites of |x - y| / 2 and of common sites, each block times its weight in the
    replicate. weights: array of `reps` numbers, the same for all cells of a block; they meet the packs, not the cells."""
    samples, n_samples, _ = counted_samples(gt)
    block = max(1, min(BLOCK, n_samples))
    blocks = -(-n_samples // block)
    width = 1

    def multiply(key: tuple, rows: pa.Table) -> pa.Table:
        p, q = key[1].as_py(), key[2].as_py()
        sums = np.zeros((2, reps, block * block))
        weight = dict(zip(rows.column("pack").to_pylist(), rows.column("w"), strict=True))
        for row, _, x, y in paired(rows, p, q, width, 0):
            own = np.asarray(weight[row["pack"]].values, float)
            known = [np.isfinite(m[:, :, 0]).astype(np.float64) for m in (x, y)]
            n = known[0].T @ known[1]
            d = np.zeros_like(n)
            for t in (1, 2):  # |x - y| is the number of thresholds that one of them reaches
                a, b = (np.where(k > 0, m[:, :, 0] >= t, False).astype(np.float64) for m, k in zip((x, y), known, strict=True))
                d += a.T @ known[1] + known[0].T @ b - 2 * (a.T @ b)
            sums[0] += own[:, None] * (d / 2).ravel()
            sums[1] += own[:, None] * n.ravel()
        i, j = np.divmod(np.flatnonzero(sums[1].any(0)), block)
        if p == q:
            i, j = i[i < j], j[i < j]
        at = i * block + j
        rep = np.repeat(np.arange(1, reps + 1), len(at))
        return pa.table({"rep": pa.array(rep.astype(np.int32)), "i": pa.array(np.tile(i + p * block, reps).astype(np.int32)), "j": pa.array(np.tile(j + q * block, reps).astype(np.int32)), "d": sums[0][:, at].ravel(), "n": sums[1][:, at].ravel()})

    # a row per block of sites
    weighed = gt.where("chrom is not null and pos is not null").withColumn("pack", block_of).dropDuplicates(["pack"]).select("pack", weights.alias("w"))
    packed = packs(gt, samples, [F.col("dosage")], pack=block_of, block=block).join(weighed, "pack")
    found = block_pairs(packed, blocks).groupBy(F.pmod(F.xxhash64("pack"), F.lit(64)).alias("some"), "p", "q").applyInArrow(multiply, "rep int, i int, j int, d double, n double")
    return named(found.groupBy("rep", "i", "j").agg(F.sum("d").alias("d"), F.sum("n").alias("n")), samples)
