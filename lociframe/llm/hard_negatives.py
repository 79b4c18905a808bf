"""Hard-negative mining with rotated one-bit codes.

A row's integer vector x is rotated and coded by its signs; with the unit code vector o, x = <x, o> o + r. The remainder r is coded
in the same way under the next rotation, and so on for LEVELS codes; the alignments <r, o> are stored beside the bits, with the
length of the last remainder. For an anchor a, <a, x> is the sum of the alignments times <a, o>, plus <a, r>, which Cauchy-Schwarz
bounds by |a||r|; <a, o> comes from popcounts between the code and the bit planes of the rotated, rounded anchor, whose rounding error is
bounded by its 1-norm. So every pair has an interval that holds its score, without a chance of being wrong. What an interval cannot
rule out is scored in integers.

Rows and anchors are dealt into blocks by a hash, whatever their labels, and each pair of blocks is one task's group: no group grows
with the table or with a label. A block gives an anchor its few best rows; the best of all blocks are ranked by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm.frames import Scratch, table, written
from lociframe.llm.workers import tidied, tidied_pair

LEVELS, PLANES, SEED = 4, 8, 7
#: Rows and anchors of a block at most, about, and blocks of rows where the table is small.
ROW_BLOCK, ANCHOR_BLOCK, LEAST_BLOCKS = 32_768, 16_384, 16
#: Pairs whose intervals are held at once.
PAIRS = 1 << 20
FOUND = "anchor_id long, anchor_hash long, anchor_times long, place int, id long, hash long, times long, score long"


def rotations(dims: int) -> np.ndarray:
    """LEVELS orthogonal matrices, the same in every task."""
    rng = np.random.default_rng(SEED)
    return np.stack([np.linalg.qr(rng.standard_normal((dims, dims)))[0] for _ in range(LEVELS)])


def code_type(dims: int) -> np.dtype:
    words = -(-dims // 64)
    return np.dtype([("id", "<i8"), ("hash", "<i8"), ("label", "<i8"), ("times", "<i8"), ("bits", "<u8", (LEVELS, words)), ("along", "<f8", (LEVELS,)), ("rest", "<f8"), ("x", "<i4", (dims,))])


def packed(signs: np.ndarray) -> np.ndarray:
    """(rows, dims) booleans as (rows, words) of 64 bits."""
    words = -(-signs.shape[1] // 64)
    raw = np.zeros((len(signs), words * 8), np.uint8)
    some = np.packbits(signs, axis=1, bitorder="little")
    raw[:, : some.shape[1]] = some
    return raw.view("<u8")


def coded(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, alignments, lengths of the last remainder) of integer rows."""
    rest, bits, along = x.astype(np.float64), [], []
    root = np.sqrt(x.shape[1])
    for r in turn:
        turned = rest @ r.T
        signs = turned >= 0
        o = np.where(signs, 1.0, -1.0) @ r / root
        a = (rest * o).sum(1)
        rest = rest - a[:, None] * o
        bits.append(packed(signs))
        along.append(a)
    return np.stack(bits, 1), np.stack(along, 1), np.sqrt((rest * rest).sum(1))


class Anchors:
    """Bit planes of rotated anchors. Level m: (R a)_i is about low + step * q_i with q_i of PLANES bits, and for signs s of a code
    <a, o> is (low * sum(s) + step * sum(q * s)) / sqrt(dims), up to `off`."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.dims, levels = x.shape[1], []
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        for r in turn:
            turned = x.astype(np.float64) @ r.T
            low = turned.min(1)
            step = np.maximum((turned.max(1) - low) / ((1 << PLANES) - 1), 1e-12)
            q = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
            off = np.abs(turned - low[:, None] - step[:, None] * q).sum(1) / np.sqrt(self.dims)
            planes = np.stack([packed((q >> b) & 1 == 1) for b in range(PLANES)], 1)
            levels.append((planes, low, step, q.sum(1), off))
        self.levels = levels

    def intervals(self, some: slice, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of some anchors and all codes."""
        estimate = slack = 0.0
        root = np.sqrt(self.dims)
        for m, (planes, low, step, total, off) in enumerate(self.levels):
            bits = codes["bits"][:, m]
            ones = np.bitwise_count(bits).sum(1, dtype=np.int32)
            hit = np.zeros((len(low[some]), len(codes)), np.int32)
            for b in range(PLANES):
                for w in range(bits.shape[1]):
                    hit += np.bitwise_count(planes[some, b, w][:, None] & bits[None, :, w]).astype(np.int32) << b
            # sums over signs of +1 and -1: twice the sum over the ones less the sum over all
            dot = (low[some][:, None] * (2 * ones - self.dims)[None, :] + step[some][:, None] * (2 * hit - total[some][:, None])) / root
            along = codes["along"][:, m][None, :]
            estimate = estimate + along * dot
            slack = slack + np.abs(along) * off[some][:, None]
        slack = slack + self.length[some][:, None] * codes["rest"][None, :]
        slack = slack + 1e-9 * (1 + np.abs(estimate) + slack)
        return estimate - slack, estimate + slack


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, in pieces."""
    out = np.empty(len(a), np.int64)
    for s in range(0, len(a), 65_536):
        out[s : s + 65_536] = (a[s : s + 65_536].astype(np.int64) * b[s : s + 65_536]).sum(1)
    return out


def kth_largest(x: np.ndarray, k: int) -> np.ndarray:
    """Of each row; less than everything where a row is shorter."""
    return np.partition(x, x.shape[1] - k, axis=1)[:, x.shape[1] - k] if x.shape[1] >= k else np.full(len(x), -np.inf)


def best(row: np.ndarray, col: np.ndarray, score: np.ndarray, codes: np.ndarray, top: int) -> np.ndarray:
    """Positions of the first `top` pairs of each row: score descending, then id, then hash."""
    order = np.lexsort((codes["hash"][col], codes["id"][col], -score, row))
    r = row[order]
    starts = np.flatnonzero(np.concatenate([[True], np.diff(r) != 0])) if len(r) else np.zeros(0, np.int64)
    rank = np.arange(len(r)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(r)]])))
    return order[rank < top]


def unpacked(group: pa.Table, kind: int, dims: int) -> np.ndarray:
    """The coded rows (kind 0) or anchors (kind 1) of a group."""
    blobs = group.filter(pc.equal(group.column("kind"), kind)).column("payload").to_pylist()
    return np.frombuffer(b"".join(blobs), code_type(dims))


def steps(anchors: int, codes: int) -> Iterator[slice]:
    step = max(1, PAIRS // max(1, codes))
    for s in range(0, anchors, step):
        yield slice(s, s + step)


def result(anchors: np.ndarray, codes: np.ndarray, row: np.ndarray, col: np.ndarray, place: np.ndarray, score: np.ndarray, times: np.ndarray) -> pa.Table:
    values = (anchors["id"][row], anchors["hash"][row], anchors["times"][row], place.astype(np.int32), codes["id"][col], codes["hash"][col], times, score)
    return pa.table([pa.array(v) for v in values], names=[c.split()[0] for c in FOUND.split(", ")])


def positives_of(dims: int, top: int):
    """A function of a (row block, anchor block) group: each anchor's first `top` rows of its label in the block, repeats counted."""

    @tidied_pair
    def find(key: tuple, group: pa.Table) -> pa.Table:
        codes, anchors = unpacked(group, 0, dims), unpacked(group, 1, dims)
        turn, parts = rotations(dims), []
        for label in np.unique(anchors["label"]):
            mine, here = anchors[anchors["label"] == label], codes[codes["label"] == label]
            if not len(here):
                continue
            told = Anchors(mine["x"], turn)
            for at in steps(len(mine), len(here)):
                some = mine[at]
                low, high = told.intervals(at, here)
                itself = (some["id"][:, None] == here["id"][None, :]) & (some["hash"][:, None] == here["hash"][None, :])
                low[itself], high[itself] = -np.inf, -np.inf
                alive = (high >= kth_largest(low, top)[:, None]) & ~itself | itself & (here["times"] > 1)[None, :]
                row, col = np.nonzero(alive)
                score = scores(some["x"][row], here["x"][col])
                first = best(row, col, score, here, top)
                row, col = row[first], col[first]
                parts.append(result(some, here, row, col, np.zeros(len(row)), score[first], here["times"][col] - itself[row, col]))
        return pa.concat_tables(parts) if parts else result(anchors, codes, *(np.zeros(0, np.int64),) * 5)

    return find


def negatives_of(dims: int, top: int, at_least: int, at_most: int):
    """A function of a (row block, anchor block) group: for each anchor and positive its first `top` rows of other labels with
    at_least % to at_most % of the positive's score."""

    @tidied_pair
    def find(key: tuple, group: pa.Table) -> pa.Table:
        codes, anchors = unpacked(group, 0, dims), unpacked(group, 1, dims)
        turn, parts = rotations(dims), []
        windows = group.filter(pc.equal(group.column("kind"), 2))
        where = {pair: i for i, pair in enumerate(zip(anchors["id"].tolist(), anchors["hash"].tolist(), strict=True))}
        of = np.array([where[p] for p in zip(windows.column("anchor_id").to_pylist(), windows.column("anchor_hash").to_pylist(), strict=True)], np.int64)
        place, score = windows.column("place").to_numpy(), windows.column("score").to_pylist()
        least_of = np.array([-(-at_least * p // 100) for p in score], np.int64)
        most_of = np.array([at_most * p // 100 for p in score], np.int64)
        told = Anchors(anchors["x"], turn)
        for at in steps(len(anchors), len(codes)) if len(codes) else ():
            some = anchors[at]
            mine = np.flatnonzero((of >= at.start) & (of < at.stop) & (least_of <= most_of))
            if not len(mine):
                continue
            low, high = told.intervals(at, codes)
            other = some["label"][:, None] != codes["label"][None, :]
            for p in np.unique(place[mine]):
                w = mine[place[mine] == p]
                line = of[w] - at.start
                least, most = least_of[w][:, None], most_of[w][:, None]
                low_w, high_w, can = low[line], high[line], other[line]
                can = can & (high_w >= least) & (low_w <= most)
                inside = can & (low_w >= least) & (high_w <= most)
                can &= high_w >= kth_largest(np.where(inside, low_w, -np.inf), top)[:, None]
                row, col = np.nonzero(can)
                score = scores(some["x"][line[row]], codes["x"][col])
                good = (score >= least[row, 0]) & (score <= most[row, 0])
                row, col, score = row[good], col[good], score[good]
                first = best(row, col, score, codes, top)
                row, col = row[first], col[first]
                parts.append(result(some, codes, line[row], col, place[w][row], score[first], codes["times"][col]))
        return pa.concat_tables(parts) if parts else result(anchors, codes, *(np.zeros(0, np.int64),) * 5)

    return find


def ranked(found: DataFrame, top: int, keys: tuple[str, ...]) -> DataFrame:
    """The first `top` of each key, with `rank` from 1; a row that stands for several counts as often."""
    place = W.partitionBy(*keys).orderBy(F.desc("score"), "id", "hash", "copy")
    copies = found.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(top).cast("long")))))
    return copies.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def hard_negatives(
    vectors: DataFrame, anchor: Column | None = None, positives: int = 5, negatives: int = 3, at_least: int = 50, at_most: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x); a score is the integer inner product with the anchor. Anchors are the rows where `anchor`
    (over id_col) holds, all if None. An anchor's positives are its first `positives` other rows of the same label by score
    descending, then id; for each, the first `negatives` rows of other labels with at_least % to at_most % of the positive's
    score.

    Rows with a null id, label or vector, a null or non-finite component, another length than most, or a squared integer length
    of 2^62 or more (whose scores need not fit 64 bits) take no part. Repeated rows (equal id, label and vector) each take a place, as
    positives, as negatives and as anchors; rows that differ under one id go by a hash of their vector. Other columns are
    ignored; an empty table, or one without anchors, gives no rows.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"), (F.lit(True) if anchor is None else anchor).alias("anchor"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    small = F.aggregate(v, F.lit(0.0), lambda t, x: t + (F.abs(scale * x) + 1) * (F.abs(scale * x) + 1)) < float(1 << 62)
    rows = rows.where("id is not null and label is not null and v is not null and size(v) > 0").where(sound)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dims = lengths["n"] if lengths else 1
    rows = rows.where(F.size("v") == dims).where(small).select("id", "label", F.transform(v, lambda x: F.floor(scale * x).cast("int")).alias("x"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    rows = rows.withColumn("hash", F.xxhash64("label", "x"))
    # repeated rows are one with a multiplicity
    counted = rows.groupBy("id", "hash").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.max("anchor").alias("anchor"), F.count(F.lit(1)).alias("times"))
    counted = scratch.written(counted, "rows")
    size = counted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("anchor").cast("long")).alias("m")).first()
    row_blocks, anchor_blocks = max(LEAST_BLOCKS, -(-size["n"] // ROW_BLOCK)), max(1, -(-(size["m"] or 0) // ANCHOR_BLOCK))
    r, q = F.pmod(F.xxhash64("id", "hash"), F.lit(row_blocks)).cast("int"), F.pmod(F.xxhash64("hash", "id"), F.lit(anchor_blocks)).cast("int")

    @tidied
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, turn = code_type(dims), rotations(dims)
        for batch in batches:
            entries = np.zeros(batch.num_rows, kind)
            for i, name in enumerate(("id", "hash", "label", "times")):
                entries[name] = batch.column(i).to_numpy()
            entries["x"] = batch.column(4).flatten().to_numpy().reshape(-1, dims)
            entries["bits"], entries["along"], entries["rest"] = coded(entries["x"], turn)
            for number, column, some in ((0, 6, slice(None)), (1, 7, batch.column(5).to_numpy(zero_copy_only=False))):
                block, own = batch.column(column).to_numpy()[some], entries[some]
                order = np.argsort(block, kind="stable")
                block, first = np.unique(block[order], return_index=True)
                parts = [e.tobytes() for e in np.split(own[order], first[1:])] if len(block) else []
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), number, np.int32)), pa.array(block.astype(np.int32)), pa.array(parts, pa.binary())], names=["kind", "block", "payload"])

    packed_rows = counted.select("id", "hash", "label", "times", "x", "anchor", r.alias("r"), q.alias("q")).mapInArrow(pack, "kind int, block int, payload binary")
    packed_rows = scratch.written(packed_rows, "packed")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("anchor_id", "long"), ("anchor_hash", "long"), ("place", "int"), ("score", "long"))]
    grid = packed_rows.where("kind = 0").select(F.col("block").alias("r"), every(anchor_blocks).alias("q"), "kind", "payload", *nothing).unionByName(
        packed_rows.where("kind = 1").select(every(row_blocks).alias("r"), F.col("block").alias("q"), "kind", "payload", *nothing)
    )
    seen = grid.groupBy("r", "q").applyInArrow(positives_of(dims, positives), FOUND)
    firsts = ranked(seen, positives, ("anchor_id", "anchor_hash")).select("anchor_id", "anchor_hash", "anchor_times", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    firsts = scratch.written(firsts, "positives")
    own_block = F.pmod(F.xxhash64(F.col("anchor_hash"), F.col("anchor_id")), F.lit(anchor_blocks)).cast("int")
    windows = firsts.select(every(row_blocks).alias("r"), own_block.alias("q"), F.lit(2).alias("kind"), F.lit(None).cast("binary").alias("payload"), "anchor_id", "anchor_hash", "place", F.col("positive_score").alias("score"))
    found = grid.unionByName(windows).groupBy("r", "q").applyInArrow(negatives_of(dims, negatives, at_least, at_most), FOUND)
    keys = ("anchor_id", "anchor_hash", "place")
    hard = ranked(found.drop("anchor_times"), negatives, keys).select(*keys, "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = firsts.join(hard, list(keys)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("anchor_times"))))
    out = written(joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
    scratch.remove()
    return out


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `embeddings` whose vec_id is divisible by 50 as anchors; where vec_id is divisible by 7, the label is the next one."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
