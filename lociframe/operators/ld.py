"""Linkage of sites, in tiles of a contig.

A tile has its own sites and, as a halo, those of the next `window` bases; cells become one matrix of sites and samples, and all sums that
r2 asks for are products of it. Samples beyond a block are summed from several matrices, so no group grows with the cohort.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators.lineage import kept

#: Bases of a tile at least, samples of a block, sites compared at once, and how much larger the tiles of each round of pruning are.
TILE, SAMPLES, ROWS, WIDER = 20_000, 2_048, 256, 16
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def ld_sums(gt: DataFrame, window: int) -> DataFrame:
    """(chrom, pos_a, pos_b, SUMS) of pairs of sites at most `window` apart that share a sample: sums of the dosages over the shared
    samples. Cells of one site and sample must not repeat."""
    called = gt.where("dosage is not null and chrom is not null and pos is not null and sample_id is not null")
    size = max(TILE, window)
    blocks = -(-called.agg(F.approx_count_distinct("sample_id", 0.01)).first()[0] // SAMPLES) or 1
    own = F.floor(F.col("pos") / size)
    tiles = F.array_distinct(F.array(own, F.floor((F.col("pos") - window) / size)))
    cells = called.select("chrom", F.pmod(F.xxhash64("sample_id"), F.lit(blocks)).alias("block"), "sample_id", F.col("pos").cast("long").alias("pos"), F.col("dosage").cast("double").alias("x"), F.explode(tiles).alias("tile"))

    def products(key: tuple, rows: pa.Table) -> pa.Table:
        chrom, tile = key[0].as_py(), key[1].as_py()
        pos, at = np.unique(rows.column("pos").to_numpy(), return_inverse=True)
        sample = rows.column("sample_id").combine_chunks().dictionary_encode()
        x, known = np.zeros((len(pos), len(sample.dictionary))), np.zeros((len(pos), len(sample.dictionary)))
        col = sample.indices.to_numpy()
        x[at, col], known[at, col] = rows.column("x").to_numpy(), 1.0
        square = x * x
        mine = int(np.searchsorted(pos, (tile + 1) * size))
        first = int(np.searchsorted(pos, tile * size))
        found: dict[str, list[np.ndarray]] = {c: [] for c in ("a", "b", *SUMS)}
        for s in range(first, mine, ROWS):
            e = min(mine, s + ROWS)
            stop = int(np.searchsorted(pos, pos[e - 1] + window, "right"))
            a, b = slice(s, e), slice(s, stop)
            n = known[a] @ known[b].T
            apart = pos[b][None, :] - pos[a][:, None]
            i, j = np.nonzero((apart > 0) & (apart <= window) & (n > 0))
            made = {"n": n, "sx": x[a] @ known[b].T, "sy": known[a] @ x[b].T, "sxx": square[a] @ known[b].T, "syy": known[a] @ square[b].T, "sxy": x[a] @ x[b].T}
            found["a"].append(pos[a][i])
            found["b"].append(pos[b][j])
            for c in SUMS:
                found[c].append(made[c][i, j])
        whole = {c: np.concatenate([np.zeros(0, np.int64 if c in ("a", "b") else np.float64), *v]) for c, v in found.items()}
        return pa.table({"chrom": pa.array([chrom] * len(whole["a"]), pa.string()), "pos_a": whole["a"], "pos_b": whole["b"]} | {c: whole[c] for c in SUMS})

    sums = cells.groupBy("chrom", "tile", "block").applyInArrow(products, "chrom string, pos_a long, pos_b long, " + ", ".join(f"{c} double" for c in SUMS))
    return sums if blocks == 1 else sums.groupBy("chrom", "pos_a", "pos_b").agg(*(F.sum(c).alias(c) for c in SUMS))


def ld_r2_pairs(gt: DataFrame, window: int) -> DataFrame:
    """r2 of dosages for pairs of sites of a contig at most `window` apart; a pair needs two samples and variance in both."""
    c = F.col
    cov = c("n") * c("sxy") - c("sx") * c("sy")
    vx, vy = c("n") * c("sxx") - c("sx") * c("sx"), c("n") * c("syy") - c("sy") * c("sy")
    r2 = F.when((vx > 0) & (vy > 0), cov * cov / (vx * vy))
    return ld_sums(gt, window).select("chrom", "pos_a", "pos_b", c("n").cast("long").alias("n"), r2.alias("r2")).where("r2 is not null and n >= 2")


def ld_prune(pairs: DataFrame, sites: DataFrame, r2: float = 0.2) -> DataFrame:
    """Sites (chrom, pos) kept by greedy pruning: in order of priority (then position), a kept site removes its neighbours with r2 above
    the threshold. sites: (chrom, pos, priority); a null priority comes last.

    A tile settles, in one pass by rank, each site whose better neighbours are settled; what hangs on other tiles waits for the next
    round, whose tiles are WIDER times as large and hold only what waits and the settled sites that it may reach. So the number of
    rounds follows the logarithm of a contig's length, whatever the chains of neighbours.
    """
    ranked = sites.select("chrom", F.col("pos").cast("long").alias("pos"), F.coalesce(F.col("priority").cast("double"), F.lit(float("-inf"))).alias("priority"))
    a = ranked.select("chrom", F.col("pos").alias("pos_a"), F.col("priority").alias("priority_a"))
    b = ranked.select("chrom", F.col("pos").alias("pos_b"), F.col("priority").alias("priority_b"))
    edges = pairs.where(F.col("r2") > r2).select("chrom", "pos_a", "pos_b").where("pos_a <> pos_b").join(a, ["chrom", "pos_a"]).join(b, ["chrom", "pos_b"])
    a_first = (F.col("priority_a") > F.col("priority_b")) | (F.col("priority_a") == F.col("priority_b")) & (F.col("pos_a") < F.col("pos_b"))
    better = edges.select("chrom", F.when(a_first, F.col("pos_b")).otherwise(F.col("pos_a")).alias("pos"), F.when(a_first, F.col("pos_a")).otherwise(F.col("pos_b")).alias("other")).groupBy("chrom", "pos").agg(F.collect_set("other").alias("better"))
    state = ranked.join(better, ["chrom", "pos"], "left").select("chrom", "pos", "priority", F.coalesce("better", F.array().cast("array<bigint>")).alias("better"), F.lit(0).alias("status"), F.lit(False).alias("done"))
    state = kept(state, "linked")
    far = state.agg(F.max(F.greatest(F.abs(F.col("pos") - F.coalesce(F.array_min("better"), F.col("pos"))), F.abs(F.col("pos") - F.coalesce(F.array_max("better"), F.col("pos"))))).alias("reach"), F.min("pos").alias("low"), F.max("pos").alias("high")).first()
    if far["high"] is None:
        return state.select("chrom", "pos")
    reach, size, out = far["reach"], max(1 << 20, WIDER * far["reach"]), []
    while True:
        tile = F.floor((F.col("pos") - far["low"]) / size)
        state = kept(state.groupBy("chrom", tile.alias("tile")).applyInArrow(settle(far["low"], size, reach), "chrom string, pos long, priority double, better array<bigint>, status int, done boolean"), "linked")
        out.append(state.where("done and status = 1").select("chrom", "pos"))
        state = state.where("not done")
        if size > far["high"] - far["low"] or state.where("status = 0").isEmpty():
            break
        size *= WIDER
    whole = state.where("status = 1").select("chrom", "pos")
    for df in out:
        whole = whole.unionByName(df)
    return whole


def settle(low: int, size: int, reach: int):
    """A function of a tile's sites: status 1 (kept) or -1 (removed) where the better neighbours tell; `done`: settled, and too far from
    the tile's edges for any site beyond them."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        pos, status = rows.column("pos").to_numpy(), rows.column("status").to_numpy().copy()
        order = np.lexsort((pos, -rows.column("priority").to_numpy()))
        better = rows.column("better").to_pylist()
        known = {p: s for p, s in zip(pos.tolist(), status.tolist(), strict=True) if s}
        for i in order.tolist():
            if status[i]:
                continue
            seen = [known.get(p, 0) for p in better[i]]
            if 1 in seen:
                status[i] = -1
            elif 0 not in seen:
                status[i] = 1
            if status[i]:
                known[int(pos[i])] = int(status[i])
        left = low + key[1].as_py() * size
        inside = (pos - left >= reach) & (left + size - 1 - pos >= reach)
        waiting = [[] if s else [p for p in b if known.get(p) != -1] for s, b in zip(status.tolist(), better, strict=True)]
        return pa.table({"chrom": rows.column("chrom"), "pos": rows.column("pos"), "priority": rows.column("priority"), "better": pa.array(waiting, pa.list_(pa.int64())), "status": pa.array(status, pa.int32()), "done": pa.array((status != 0) & inside)})

    return run
