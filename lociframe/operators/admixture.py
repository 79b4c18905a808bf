"""Admixture of K clusters from genotype likelihoods, to convergence.

The likelihood is maximised over the samples' shares q with the clusters' frequencies f profiled out: for given q a site's f is found
where the site's cells are, so only q, a thin matrix, travels between rounds, and no site table is joined or written. A pass over the
packed cells gives the log-likelihood of q and its EM step; SQUAREM extrapolates two steps, and a step that lost likelihood is taken
back. Restarts and parts share the passes and leave them once they have settled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators.gram import numbered_samples
from lociframe.operators.lineage import kept

SITE = ["chrom", "pos"]
#: Cells of a pack, samples of a row of sums, partial sums that meet at once, rounds for a site's frequencies.
CELLS, ROWS, MEET, INNER = 1 << 18, 1024, 64, 25
#: Cells that are worked on at once, and sites.
NEAR, FEW = 1 << 16, 4096
#: A frequency stands still when a step moves it by less; how far a site's steps are extrapolated at most.
STILL, FAR = 1e-7, 4.0
LEAST = 1e-6


def packed_cells(gl: DataFrame, samples: DataFrame, n: int) -> DataFrame:
    """(chroms, positions, payload): sites with all samples' likelihoods, scaled to maximum 1, three planes (sites, samples) of zeros where
    there are none."""
    known = gl.where(F.col("gl").isNotNull() & F.forall("gl", lambda x: x.isNotNull() & ~F.isnan(x))).where("chrom is not null and pos is not null")
    sites = known.agg(F.approx_count_distinct(F.struct(*SITE))).first()[0]
    pack = F.pmod(F.xxhash64(*SITE), F.lit(max(8, -(-sites * n // CELLS))))
    cells = known.join(samples, "sample_id").select(pack.alias("pack"), "chrom", F.col("pos").cast("long").alias("pos"), "n", F.transform("gl", lambda x: x.cast("double")).alias("gl"))

    def gather(key: tuple, rows: pa.Table) -> pa.Table:
        chrom = rows.column("chrom").combine_chunks().dictionary_encode()
        c, p = chrom.indices.to_numpy(), rows.column("pos").to_numpy()
        order = np.lexsort((p, c))
        new = np.concatenate([[True], (np.diff(c[order]) != 0) | (np.diff(p[order]) != 0)])
        own, at = order[new], np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        g, known = unit(rows.column("gl").combine_chunks().flatten().to_numpy().reshape(-1, 1, 3))
        planes = np.zeros((3, len(own), n), np.float32)
        planes[:, at, rows.column("n").to_numpy()] = np.where(known, g[:, 0], 0.0).T
        names = chrom.dictionary.take(pa.array(c[own]))
        return pa.table({"chroms": pa.array([names.to_pylist()], pa.list_(pa.string())), "positions": pa.array([p[own].tolist()], pa.list_(pa.int64())), "payload": pa.array([planes.tobytes()], pa.binary())})

    return cells.groupBy("pack").applyInArrow(gather, "chroms array<string>, positions array<bigint>, payload binary")


def unit(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(likelihoods scaled to maximum 1, known) of (sites, samples, 3)."""
    known = np.isfinite(g).all(2) & (g.max(2, initial=0) > 0)
    g = np.where(known[:, :, None], g, 1.0)
    return g / g.max(2, keepdims=True), known


def planes_of(g: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(3, sites, samples) of (sites, samples, 3), 0 where nothing is known."""
    return np.ascontiguousarray(np.moveaxis(np.where(known[:, :, None], g, 0.0), 2, 0))


def unpacked(payload: pa.Scalar, n: int) -> np.ndarray:
    return np.frombuffer(payload.as_buffer(), np.float32).reshape(3, -1, n)


def lines_of(planes: np.ndarray) -> np.ndarray:
    """A cell's likelihood at frequency h is g0 + h (2 b + c h), and half its slope b + c h: (g0, b, c), each (sites, samples); 1, 0 and 0 where
    nothing is known."""
    lines = np.empty((3, *planes.shape[1:]))
    g0, b, c = lines
    g0[:], c[:] = planes[0], planes[2]
    np.subtract(planes[1], g0, out=b)
    c -= planes[1]
    c -= b
    g0[(g0 == 0) & (b == 0) & (c == 0)] = 1.0
    return lines


def slopes(lines: np.ndarray, h: np.ndarray, out: np.ndarray) -> np.ndarray:
    """(d, h d, likelihood) at frequency h, in the three arrays of `out`: d is half the slope over the likelihood, so an allele drawn where h was
    meant is seen 1 + (1 - h) d times as often as expected, the other 1 - h d times."""
    g0, b, c = lines
    d, moved, total = out
    np.multiply(c, h, out=d)
    d += b
    np.add(d, b, out=total)
    total *= h
    total += g0
    np.maximum(total, 1e-300, out=total)
    d /= total
    np.multiply(d, h, out=moved)
    return out


def profiled(lines: np.ndarray, cells: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(K, sites) frequencies that maximise the likelihood of each site for given q, by INNER rounds of EM at most. Every two steps of a site
    are extrapolated, and sites that stand still leave the rounds. cells (K, sites): shares of the site's cells. q sums to 1 and f lies in
    [LEAST, 1 - LEAST], so h does."""
    out = np.empty((4, *lines.shape[1:]))
    out[3] = 0.3
    d, moved, _ = slopes(lines, out[3], out[:3])
    n = cells.sum(0)
    first = np.clip((0.6 * (n + (d - moved).sum(1)) + 0.1) / (2 * n + 0.2), 0.01, 0.99)
    f = np.repeat(first[None, :], q.shape[1], 0)
    turned, sites, x, before = np.ascontiguousarray(q.T), np.arange(f.shape[1]), f.copy(), None
    for i in range(INNER):
        now = out[:, : x.shape[1]]
        d, moved, _ = slopes(lines, np.matmul(x.T, turned, out=now[3]), now[:3])
        down = cells - turned @ moved.T
        up = (down + turned @ d.T) * x
        down *= 1 - x
        new = np.clip(up / np.maximum(up + down, 1e-300), LEAST, 1 - LEAST)
        moves = np.flatnonzero(np.abs(new - x).max(0) >= STILL)
        if not len(moves):
            break
        if 2 * len(moves) < x.shape[1]:
            f[:, sites] = new
            lines, cells, sites, x, new = lines[:, moves], cells[:, moves], sites[moves], x[:, moves], new[:, moves]
            before = None if before is None else before[:, moves]
        if before is None or i >= INNER - 3:  # the last steps are plain
            before, x = x, new
            continue
        r, v = x - before, new - 2 * x + before
        alpha = np.clip(np.sqrt((r * r).sum(0) / np.maximum((v * v).sum(0), 1e-300)), 1.0, FAR)
        before, x = None, np.clip(before + 2 * alpha * r + alpha * alpha * v, LEAST, 1 - LEAST)
    f[:, sites] = new
    return f


def steps_of(q: np.ndarray, g: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """`pack_steps` of likelihoods (sites, samples, 3)."""
    return pack_steps(q, planes_of(g, known))


def pack_steps(q: np.ndarray, planes: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(sums of the EM step of q, log-likelihood, f) over the sites of a pack, so many sites at a time that they stay in a core's cache."""
    sums, like, found = np.zeros_like(q), 0.0, []
    step = min(FEW, max(16, NEAR // max(1, planes.shape[2])))
    for s in range(0, planes.shape[1], step):
        lines = lines_of(planes[:, s : s + step])
        known = (planes[:, s : s + step] > 0).any(0).astype(np.float64)
        f = profiled(lines, q.T @ known.T, q)
        d, moved, total = slopes(lines, f.T @ q.T, np.empty((3, *known.shape)))
        sums += 2 * ((known - moved).sum(0)[:, None] + d.T @ f.T)
        like += float(np.log(total).sum())
        found.append(f.T)
    return q * sums, like, np.concatenate([np.zeros((0, q.shape[1])), *found])


@dataclass
class Model:
    """One restart or part: its samples, and where its SQUAREM cycle stands: at q, at its EM step, or at the extrapolation."""

    rep: int
    members: np.ndarray
    q: np.ndarray
    trail: list[np.ndarray] = field(default_factory=list)
    safe: np.ndarray | None = None
    longest: float = 4.0
    hit: bool = False
    floor: float = -np.inf
    like: float = -np.inf
    rounds: int = 0
    done: bool = False
    settled: bool = False

    def take(self, sums: np.ndarray, like: float, tolerance: float, most: int) -> None:
        """Go on from the EM step and the log-likelihood at q."""
        self.rounds += 1
        new = normalised(np.where(sums.sum(1, keepdims=True) > 0, sums, self.q))
        if self.safe is not None:
            if like < self.floor - 1e-7 * abs(self.floor):  # the extrapolation lost: back to the second step
                self.longest = max(1.0, self.longest / 4) if self.hit else self.longest
                self.q, self.safe = self.safe, None
            else:
                self.longest *= 4 if self.hit else 1
                self.like, self.q, self.safe = like, new, None
            self.done = self.rounds >= most
            return
        self.like = like
        self.settled = np.abs(new - self.q).max(initial=0) < tolerance
        if self.settled or self.rounds >= most:
            self.done = True
            return
        self.trail, self.q = [*self.trail, self.q], new
        if len(self.trail) < 2:
            return
        first, second = self.trail
        r, v = second - first, new - 2 * second + first
        size = np.sqrt((v * v).sum())
        alpha = min(self.longest, max(1.0, np.sqrt((r * r).sum()) / size)) if size > 0 else 1.0
        self.trail, self.hit = [], alpha == self.longest
        if alpha > 1.01:
            self.safe, self.floor, self.q = new, like, normalised(first + 2 * alpha * r + alpha**2 * v)


def normalised(q: np.ndarray) -> np.ndarray:
    q = np.clip(q, 0, None)
    q = np.clip(q / np.maximum(q.sum(1, keepdims=True), 1e-300), LEAST, 1)
    return q / q.sum(1, keepdims=True)


def one_pass(packs: DataFrame, models: list[Model], n: int, few: bool) -> dict[int, tuple[np.ndarray, float]]:
    """Sums of the EM step and log-likelihood of each model, from one reading of the packs. few: the tasks' sums are small
    enough to meet on the driver."""
    sent = packs.sparkSession.sparkContext.broadcast([(m.members, m.q) for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [(np.zeros_like(q), [0.0]) for _, q in sent.value]
        for batch in batches:
            for payload in batch.column(0):
                planes = unpacked(payload, n)
                for (members, q), (sums, like) in zip(sent.value, totals, strict=True):
                    step, own, _ = pack_steps(q, planes if len(members) == n else planes[:, :, members])
                    sums += step
                    like[0] += own
        rows = [(i, b // ROWS, sums[b : b + ROWS].tobytes(), like[0] if b == 0 else 0.0) for i, (sums, like) in enumerate(totals) for b in range(0, max(1, len(sums)), ROWS)]
        salt = TaskContext.get().partitionId() % MEET
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*((i, b, salt, p, x) for i, b, p, x in rows), strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64()), strict=True)], names=["model", "block", "salt", "payload", "like"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in rows.column("payload").to_pylist())
        return pa.table({"model": rows.column("model")[:1], "block": rows.column("block")[:1], "payload": pa.array([total.tobytes()], pa.binary()), "like": pa.array([float(np.sum(rows.column("like").to_numpy()))])})

    schema = "model int, block int, payload binary, like double"
    partial = packs.select("payload").mapInArrow(run, "model int, block int, salt int, payload binary, like double")
    met = partial if few else partial.groupBy("model", "block", "salt").applyInArrow(add, schema).groupBy("model", "block").applyInArrow(add, schema)
    found: dict[tuple, list] = {}
    for r in met.toArrow().to_pylist():
        found.setdefault((r["model"], r["block"]), []).append((np.frombuffer(r["payload"]), r["like"]))
    sent.destroy()
    out = {}
    for i, m in enumerate(models):
        mine = [found[key] for key in sorted(found) if key[0] == i]
        sums = np.concatenate([sum(x for x, _ in rows) for rows in mine]).reshape(m.q.shape) if mine else np.zeros_like(m.q)
        out[m.rep] = sums, sum(like for rows in mine for _, like in rows)
    return out


@dataclass
class Cells:
    """What all models of the same likelihoods share: the samples by number, how many, and the packs, written once."""

    samples: DataFrame
    n: int
    packs: DataFrame


def prepared(gl: DataFrame) -> Cells:
    """Likelihoods computed once, then counted and packed."""
    gl = kept(gl.select(*SITE, "sample_id", "gl"), "admixture-likelihoods")
    samples = numbered_samples(gl).cache()
    n = samples.count()
    return Cells(samples, n, kept(packed_cells(gl, samples, n), "admixture-cells"))


def admixture_em(gl: DataFrame | Cells, k: int, reps: int = 1, seed: int = 1, rounds: int = 300, parts: DataFrame | None = None, tolerance: float = 1e-6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K-cluster model of likelihoods (chrom, pos, sample_id, gl), or of `prepared` ones: (q: rep, sample_id, cluster, q), (f: rep, chrom, pos,
    cluster, f), (rep, log_likelihood, rounds, converged).

    Every restart has its own seed, seed + restart, and goes on until a step moves no share by `tolerance`, or for `rounds`
    passes. parts (sample_id, rep) runs one model per set of samples instead of restarts. Cells without likelihoods say nothing; a sample
    without any keeps its first shares. The driver holds q, a row per sample.
    """
    cells = gl if isinstance(gl, Cells) else prepared(gl)
    samples, n, packs = cells.samples, cells.n, cells.packs
    spark = packs.sparkSession
    if parts is None:
        members = {rep: np.arange(n) for rep in range(reps)}
    else:
        own = samples.join(parts.select("sample_id", "rep"), "sample_id").select("n", F.col("rep").cast("long").alias("rep")).toArrow()
        number, rep_of = own.column("n").to_numpy(), own.column("rep").to_numpy()
        members = {int(rep): np.sort(number[rep_of == rep]) for rep in np.unique(rep_of)}
    models = [Model(rep, some, np.random.default_rng([seed, rep]).dirichlet(np.ones(k), len(some))) for rep, some in members.items()]
    for m in models:
        m.q = normalised(m.q)
    few = packs.count() * sum(m.q.nbytes for m in models) <= 64 << 20
    while open_ := [m for m in models if not m.done]:
        found = one_pass(packs, open_, n, few)
        for m in open_:
            m.take(*found[m.rep], tolerance, rounds)
    sent = spark.sparkContext.broadcast([(m.rep, m.members, m.q) for m in models])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chroms, positions, payload in zip(*(batch.column(c) for c in range(3)), strict=True):
                planes = unpacked(payload, n)
                for rep, some, q in sent.value:
                    f = pack_steps(q, planes[:, :, some])[2]
                    s = len(f)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(s * k, rep)), pa.array([c for c in chroms.as_py() for _ in range(k)], pa.string()), pa.array(np.repeat(np.array(positions.as_py(), np.int64), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), s)), pa.array(f.ravel())], names=["rep", "chrom", "pos", "cluster", "f"])

    f = packs.select("chroms", "positions", "payload").mapInArrow(frequencies, "rep long, chrom string, pos long, cluster int, f double")
    rows = pa.table({
        "rep": np.concatenate([np.full(m.q.size, m.rep) for m in models] or [np.zeros(0, np.int64)]).astype(np.int64), "n": np.concatenate([np.repeat(m.members, k) for m in models] or [np.zeros(0)]).astype(np.int32),
        "cluster": np.concatenate([np.tile(np.arange(k), len(m.q)) for m in models] or [np.zeros(0)]).astype(np.int32), "q": np.concatenate([m.q.ravel() for m in models] or [np.zeros(0)]),
    })
    q = spark.createDataFrame(rows).join(samples, "n").select("rep", "sample_id", "cluster", "q")
    likes = spark.createDataFrame([(m.rep, float(m.like), m.rounds, bool(m.settled)) for m in models], "rep long, log_likelihood double, rounds int, converged boolean")
    return q, f, likes
