"""SimHash near-dedup by anchor points.

Fingerprints are compared per anchor. Two ways to place them:

* `cover`: the anchors are the codewords of a covering code, the product of repetition codes over blocks of the fingerprint's
  bits. Each fingerprint is at home at its nearest codeword (majority of every block) and is replicated to every codeword
  that is home to some point within the threshold. Any two fingerprints within the threshold meet at the home of either,
  so no link is lost. The number of blocks follows the number of distinct fingerprints.
* `soft`: for thresholds too wide for that (a similarity of 0.8 lies near 20 of 128 bits). Several short codes, each over
  its own bits; a fingerprint is replicated to the anchors nearest to it by the margins of its bits. How many is measured
  for the number of fingerprints: simulated pairs at similarity 0.8 must meet in `RECALL` of all cases. `similar_groups`
  takes such pairs as candidates only and verifies the shingle sets.

Equal fingerprints are one point. Per anchor only a spanning forest of the links is emitted, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import Scratch, components, table, written
from lociframe.llm.workers import tidied, tidied_group

U64 = A.U64
RECALL = 0.98
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def xx_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every k-word shingle, space-joined, and the number of shingles per document."""
    raw = LOWER[data].tobytes()
    out: list[int] = []
    counts = np.zeros(len(offs) - 1, np.int64)
    digest = xxhash.xxh64_intdigest
    for i, (a, b) in enumerate(itertools.pairwise(offs.tolist())):
        words = raw[a:b].split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= k:
            out.append(digest(line, 42))
            counts[i] = 1
            continue
        ends = list(itertools.accumulate(map(len, words), lambda x, n: x + 1 + n))
        starts = [0, *(e + 1 for e in ends[: len(words) - k])]
        out += [digest(line[s:e], 42) for s, e in zip(starts, ends[k - 1 :])]  # noqa: B905
        counts[i] = len(words) - k + 1
    return np.array(out, U64).reshape(-1, 1), counts


def wide_shingles(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every k-word shingle (fewer words: of the whole sequence), without a Python loop over words."""
    data = LOWER[data]
    w = A.Words(data, offs)
    h = A.span_hash(A.byte_prefix(data), w.start, w.end)
    grams = A.gram_hash(h, k)
    inside = w.doc[k - 1 :] == w.doc[: len(grams)] if len(grams) else np.zeros(0, bool)
    doc, grams = w.doc[: len(grams)][inside], grams[inside]
    few = np.flatnonzero((w.count > 0) & (w.count < k))
    own = np.array([A.gram_hash(h[w.first[i] : w.first[i + 1]], int(w.count[i]))[0] for i in few], U64)
    doc, grams = np.concatenate([doc, few]), np.concatenate([grams, own])
    order = np.argsort(doc, kind="stable")
    grams = grams[order]
    return np.column_stack([grams, A.mix(grams ^ A.GRAM)]), np.bincount(doc, minlength=len(offs) - 1)


def bit_counts(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(documents, bits): in how many of a document's hashes each bit is set."""
    bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
    out = np.zeros((len(counts), 64 * h.shape[1]), np.int64)
    there = np.flatnonzero(counts)
    if len(there):
        starts = np.concatenate([[0], np.cumsum(counts[there])[:-1]])
        out[there] = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """(rows, 64 * m) booleans -> (rows, m) unsigned 64-bit."""
    return np.packbits(bits, axis=1, bitorder="little").view(U64).reshape(len(bits), -1)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp binary), one per row of `docs`: the fingerprint's little-endian bytes. No words: all bits zero."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = A.text_bytes(batch.column(1))
            for a, b, part, at in A.pieces(data, offs, 1 << 20):
                h, counts = xx_shingles(part, at, shingle)
                ones = bit_counts(h, counts) if len(h) else np.zeros((b - a, 64), np.int64)
                fp = packed(2 * ones > counts[:, None])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([r.tobytes() for r in fp], pa.binary())], names=["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, fp binary")


class Cover:
    """Product of repetition codes over `blocks` blocks of 64 bits."""

    def __init__(self, points: int, threshold: int):
        self.threshold = threshold
        self.blocks = int(np.clip(np.ceil(np.log2(max(points, 1) / 24 + 1)), 8, 21))
        edge = np.linspace(0, 64, self.blocks + 1).round().astype(int)
        self.size = np.diff(edge)
        self.masks = np.array([((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in itertools.pairwise(edge)], U64)
        self.replicas = 1 + self.blocks + self.blocks * self.blocks // 4

    def ones(self, fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, :1] & self.masks[None, :]).astype(np.int64)

    def home(self, fp: np.ndarray) -> np.ndarray:
        return ((2 * self.ones(fp) > self.size) << np.arange(self.blocks)).sum(1).astype(np.int64)

    def anchors(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of each replica."""
        ones, half = self.ones(fp), self.size // 2
        need = np.where(2 * ones > self.size, ones - half, half + 1 - ones)  # bits to change until a block's majority turns
        home = self.home(fp)
        rows, where = [np.arange(len(fp))], [home]
        for n in range(1, self.threshold + 1):
            for blocks in itertools.combinations(range(self.blocks), n):
                at = np.flatnonzero(need[:, blocks].sum(1) <= self.threshold)
                rows.append(at)
                where.append(home[at] ^ sum(1 << b for b in blocks))
        return np.concatenate(rows), np.concatenate(where)


class Soft:
    """Short codes over separate bits of a wide fingerprint, visited by margin."""

    def __init__(self, points: int, tables: int = 5):
        self.bits = int(np.clip(np.ceil(np.log2(max(points, 2))) - 1, 8, 25))
        self.weak = min(10, self.bits)
        self.tables = tables
        self.own = [np.arange(t * self.bits, (t + 1) * self.bits) for t in range(tables)]  # at most 125 of 128 bits
        self.probes = max(12, self.visits(RECALL))  # longer codes need more visits
        self.replicas = tables * self.probes

    def visits(self, recall: float, similarity: float = 0.8, pairs: int = 3000) -> int:
        """Visits that let this share of simulated pairs meet: sums of the bits of two sets that share `similarity` of
        their shingles correlate by 2 * similarity / (1 + similarity)."""
        r, same = np.random.default_rng(7), 2 * similarity / (1 + similarity)
        x = r.standard_normal((pairs, 128))
        y = same * x + np.sqrt(1 - same * same) * r.standard_normal((pairs, 128))
        met = np.full(pairs, 1 << self.weak)
        for own in self.own:
            differ = (x[:, own] > 0) != (y[:, own] > 0)
            for side in (x, y):
                order, cost, _ = self.costs(np.minimum(np.abs(side[:, own]) * 32, 255).astype(np.uint8))
                there = np.take_along_axis(differ, order, 1)
                place = there @ (1 << np.arange(self.weak))
                rank = (cost <= np.take_along_axis(cost, place[:, None], 1)).sum(1)
                met = np.minimum(met, np.where(there.sum(1) == differ.sum(1), rank, 1 << self.weak))
        return int(np.quantile(met, recall, method="higher"))

    def costs(self, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weakest bits of each row, the cost of flipping each subset of them, and the subsets."""
        subset = (np.arange(1 << self.weak)[:, None] >> np.arange(self.weak)) & 1
        firm = margin.astype(np.float64)
        order = np.argsort(firm, axis=1, kind="stable")[:, : self.weak]
        return order, (np.take_along_axis(firm, order, 1) ** 2) @ subset.T.astype(np.float64), subset

    def home(self, fp: np.ndarray, t: int) -> np.ndarray:
        word, at = divmod(t * self.bits, 64)
        key = fp[:, word] >> U64(at)
        if at + self.bits > 64:
            key = key | (fp[:, word + 1] << U64(64 - at))
        return (key & U64((1 << self.bits) - 1)).astype(np.int64) * self.tables + t

    def anchors(self, fp: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, where = [], []
        for t in range(self.tables):
            order, cost, subset = self.costs(margin[:, self.own[t]])
            probes = min(self.probes, cost.shape[1])
            best = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
            best[:, 0] = np.where((best == 0).any(1), best[:, 0], 0)  # the home itself is always visited
            chosen = (best[:, :, None] >> np.arange(self.weak)) & 1
            flips = (chosen << order[:, None, :]).sum(2)
            rows.append(np.repeat(np.arange(len(fp)), probes))
            where.append(((self.home(fp, t) // self.tables)[:, None] ^ flips).ravel() * self.tables + t)
        return np.concatenate(rows), np.concatenate(where)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (node, root) of the graph with edges a-b over integer nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return np.flatnonzero(keep), label[keep], nodes


def linked(homes: np.ndarray, members: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (indices into `members`) of the links between the points at home at an anchor and all replicas there.

    homes: indices into members. Blocks of bounded size; after each block only its forest is carried on.
    """
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = max(1, (1 << 21) // max(len(members), 1))
    for s in range(0, len(homes), step):
        part = homes[s : s + step]
        far = np.zeros((len(part), len(members)), np.uint8)
        for m in range(members.shape[1]):
            far += np.bitwise_count(members[part, m][:, None] ^ members[:, m][None, :])
        i, j = np.nonzero(far <= threshold)
        i = part[i]
        differ = i != j
        a, b = np.concatenate([a, i[differ]]), np.concatenate([b, j[differ]])
        if len(a) > 1 << 18:
            x, y, nodes = forest(a, b)
            a, b = nodes[x], nodes[y]
    if len(a):
        x, y, nodes = forest(a, b)
        a, b = nodes[x], nodes[y]
    return a, b


def links(points: DataFrame, code: Cover, threshold: int, buckets: int) -> DataFrame:
    """Edges (a binary, b binary) between distinct fingerprints within the threshold; per anchor a forest.

    points: (fp), one row per distinct fingerprint. Replicas travel packed per task and bucket of anchors.
    """
    kind = np.dtype([("anchor", "<i8"), ("fp", "<u8", (1,))])

    @tidied
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                fp = np.frombuffer(b"".join(batch.column(0).slice(s, 2000).to_pylist()), U64).reshape(-1, 1)
                rows, anchor = code.anchors(fp)
                out = np.empty(len(rows), kind)
                out["anchor"], out["fp"] = anchor, fp[rows]
                bucket = (A.mix(anchor.astype(U64) * A.MULT) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                out, bucket = out[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                yield pa.RecordBatch.from_arrays([pa.array(bucket[np.concatenate([[0], cuts])]), pa.array([x.tobytes() for x in np.split(out, cuts)], pa.binary())], names=["bucket", "payload"])

    @tidied_group
    def compare(group: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(group.column("payload").to_pylist()), kind)
        entries = entries[np.argsort(entries["anchor"], kind="stable")]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(entries["anchor"]) != 0]))
        fps = np.ascontiguousarray(entries["fp"])
        at_home = code.home(fps) == entries["anchor"]
        left, right = [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(entries)]):  # noqa: B905
            homes = np.flatnonzero(at_home[s:e])
            if len(homes) and e - s > 1:
                a, b = linked(homes, fps[s:e], threshold)
                if len(a):
                    left.append(fps[s:e][a])
                    right.append(fps[s:e][b])
        a = np.concatenate(left) if left else np.zeros((0, 1), U64)
        b = np.concatenate(right) if right else np.zeros((0, 1), U64)
        return pa.table({"a": pa.array([x.tobytes() for x in a], pa.binary()), "b": pa.array([x.tobytes() for x in b], pa.binary())})

    return points.mapInArrow(place, "bucket long, payload binary").groupBy("bucket").applyInArrow(compare, "a binary, b binary")


def simhash_groups(docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one per row of `docs`; component_id is the smallest doc_id reachable.

    64-bit fingerprints and the covering code: every link within the threshold is found. Null and empty
    texts have fingerprint zero and are linked like any other; a null id has a row and is never a component's smallest id
    unless it has no other; repeated rows keep a row each; an empty table gives no rows. At most 2**62 distinct fingerprints.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    points = scratch.written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    n = points.count()
    code = Cover(n, threshold)
    buckets = max(64, int(n * code.replicas * 16 / 4e6))
    edges = links(points.select("fp"), code, threshold, buckets).distinct()

    # from here a point is named by its fingerprint as a number
    def name(c: str):
        return F.conv(F.hex(c), 16, -10).cast("long")

    named = points.select("fp", "first", name("fp").alias("point"))
    parts = components(edges.select(name("a").alias("a"), name("b").alias("b")))
    grouped = named.join(parts, named["point"] == parts["node"], "left").select("fp", "first", F.coalesce("component", "point").alias("group"))
    least = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    label = grouped.join(least, "group").select("fp", "component_id")
    high_first = F.array_join(F.reverse(F.regexp_extract_all(F.lower(F.hex("fp")), F.lit("(..)"), 1)), "")
    found = written(marked.join(label, "fp").select("doc_id", high_first.alias("fingerprint"), "component_id"), "groups")
    scratch.remove()
    return found


# verified groups


def shingle_sets(docs: DataFrame, shingle: int, with_set: bool = False) -> DataFrame:
    """Rows (doc_id, text_hash, point, fp, margin), one per row of `docs` (doc_id, text, text_hash): a 64-bit name of the set of
    shingles and the fingerprint of that set; with_set: (point, shingles binary), sorted 64-bit hashes of the set."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = A.text_bytes(batch.column(1))
            for a, b, part, at in A.pieces(data, offs, 1 << 20):
                h, counts = wide_shingles(part, at, shingle)
                doc = np.repeat(np.arange(b - a), counts)
                order = np.lexsort((h[:, 0], doc))
                h, doc = h[order], doc[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:, 0] != h[:-1, 0]) | (doc[1:] != doc[:-1])
                h, counts = np.ascontiguousarray(h[fresh]), np.bincount(doc[fresh], minlength=b - a)
                ends = np.concatenate([[0], np.cumsum(counts)])
                total = np.concatenate([[U64(0)], np.cumsum(A.mix(h[:, 1]), dtype=U64)])
                point = pa.array(A.mix(total[ends[1:]] - total[ends[:-1]] + counts.astype(U64)).view(np.int64))
                if with_set:
                    sets = [h[x:y, 0].tobytes() for x, y in itertools.pairwise(ends.tolist())]
                    yield pa.RecordBatch.from_arrays([point, pa.array(sets, pa.binary())], names=["point", "shingles"])
                    continue
                ones = bit_counts(h, counts) if len(h) else np.zeros((b - a, 128), np.int64)
                firm = np.abs(2 * ones - counts[:, None]) / np.sqrt(np.maximum(counts, 1))[:, None]
                fp = packed(2 * ones > counts[:, None])
                columns = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (fp, np.minimum(firm * 32, 255).astype(np.uint8))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), point, *columns], names=["doc_id", "text_hash", "point", "fp", "margin"])

    return docs.select("doc_id", "text", "text_hash").mapInArrow(run, "point long, shingles binary" if with_set else "doc_id long, text_hash long, point long, fp binary, margin binary")


def candidates(points: DataFrame, code: Soft, bits: int, buckets: int, chunk: int = 0) -> DataFrame:
    """What meets at an anchor and differs in at most `bits` bits, of points (point, fp, margin): per anchor a spanning forest of
    such pairs, rows (a long, b long) with a < b; or, with a `chunk`, the points that have such a pair, rows (group long, side
    int, point long): a group is an anchor, or a pair of its chunks of about that many points, told apart by `side`."""
    kind = np.dtype([("anchor", "<i8"), ("point", "<i8"), ("fp", "<u8", (2,))])

    @tidied
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                fp = np.frombuffer(b"".join(part.column(1).to_pylist()), U64).reshape(-1, 2)
                margin = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(len(fp), -1)
                rows, anchor = code.anchors(fp, margin)
                out = np.empty(len(rows), kind)
                out["anchor"], out["fp"], out["point"] = anchor, fp[rows], part.column(0).to_numpy()[rows]
                bucket = (A.mix(anchor.astype(U64) * A.MULT) % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                out, bucket = out[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                yield pa.RecordBatch.from_arrays([pa.array(bucket[np.concatenate([[0], cuts])]), pa.array([x.tobytes() for x in np.split(out, cuts)], pa.binary())], names=["bucket", "payload"])

    def met_before(x: np.ndarray, y: np.ndarray, table: int) -> np.ndarray:
        """Pairs that are at home at one anchor of an earlier table, and are dealt with there."""
        out = np.zeros(len(x), bool)
        for t in range(table):
            out |= code.home(x, t) == code.home(y, t)
        return out

    def near(members: np.ndarray, homes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step, table = max(1, (1 << 20) // len(members)), int(members["anchor"][0]) % code.tables
        fps = np.ascontiguousarray(members["fp"])
        for s in range(0, len(homes), step):
            part = homes[s : s + step]
            far = np.zeros((len(part), len(members)), np.uint8)
            for m in range(2):
                far += np.bitwise_count(fps[part, m][:, None] ^ fps[:, m][None, :])
            i, j = np.nonzero((far <= bits) & (members["point"][part][:, None] != members["point"][None, :]))
            fresh = ~met_before(fps[part[i]], fps[j], table)
            yield part[i][fresh], j[fresh]

    def trees(members: np.ndarray, homes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every member of a tree with the tree's first by name: anchors that see the same points give the same rows."""
        names = members["point"]
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in near(members, homes):
            a, b = np.concatenate([a, i]), np.concatenate([b, j])
            if len(a) > 1 << 18:
                x, y, nodes = forest(a, b)
                a, b = nodes[x], nodes[y]
        if not len(a):
            return names[:0], names[:0]
        x, y, nodes = forest(a, b)
        return names[nodes[y]], names[nodes[x]]

    def groups(members: np.ndarray, homes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        has = np.zeros(len(members), bool)
        for i, j in near(members, homes):
            has[i] = has[j] = True
        names = members["point"][has]
        parts = -(-len(names) // chunk)
        own = (A.mix(names.astype(U64)) % U64(max(parts, 1))).astype(np.int64)
        other = np.tile(np.arange(parts), len(names))
        own, names = np.repeat(own, parts), np.repeat(names, parts)
        low, high = np.minimum(own, other), np.maximum(own, other)
        group = A.mix(A.mix(members["anchor"][:1].astype(U64)) + (low * parts + high).astype(U64)).view(np.int64)
        return group, (own > other).astype(np.int32), names

    @tidied
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group", "side", "point"] if chunk else ["a", "b"]
        entries = np.frombuffer(b"".join(p for batch in batches for p in batch.column("payload").to_pylist()), kind)
        entries = entries[np.lexsort((entries["point"], entries["anchor"]))]
        starts = np.flatnonzero(np.concatenate([[True], np.diff(entries["anchor"]) != 0]))
        fps = np.ascontiguousarray(entries["fp"])
        at_home = np.zeros(len(entries), bool)
        for t in range(code.tables):
            at_home |= code.home(fps, t) == entries["anchor"]
        found: list[tuple[np.ndarray, ...]] = []
        waiting = 0
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(entries)]):  # noqa: B905
            homes = np.flatnonzero(at_home[s:e])
            if not len(homes) or e - s < 2:
                continue
            found.append((groups if chunk else trees)(entries[s:e], homes))
            waiting += len(found[-1][0])
            if waiting > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=names)
                found, waiting = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=names)

    picked = points.select("point", "fp", "margin")
    return picked.mapInArrow(place, "bucket long, payload binary").groupBy("bucket").applyInArrow(compare, "group long, side int, point long" if chunk else "a long, b long").distinct()


def similar_pairs(fps: np.ndarray, side: np.ndarray, ends: np.ndarray, values: np.ndarray, bits: int, similarity: float, cells: int = 1 << 23) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of rows whose fingerprints differ in at most `bits` bits and whose sets (values between ends) have this
    Jaccard similarity at least; rows of one side are not compared where there are two.

    Elements of one row alone meet nothing and are left out; the others are columns of 0/1 matrices, `cells` large at most,
    whose product counts what rows share.
    """
    n, size = len(fps), np.diff(ends).astype(np.int64)
    distinct, column, often = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    keep = often[column] > 1
    row, column = row[keep], column[keep]
    first = np.searchsorted(row, np.arange(n + 1))
    two = side.min() != side.max()

    def matrix(some: np.ndarray, columns: np.ndarray) -> np.ndarray:
        out = np.zeros((len(some), len(columns)), np.float32)
        for k, r in enumerate(some.tolist()):
            mine = column[first[r] : first[r + 1]]
            at = np.minimum(np.searchsorted(columns, mine), max(len(columns) - 1, 0))
            if len(columns):
                out[k, at[columns[at] == mine]] = 1
        return out

    step = max(1, min(256, (1 << 20) // n))
    for s in range(0, n, step):
        mine = np.arange(s, min(s + step, n))
        far = np.zeros((len(mine), n), np.uint8)
        for m in range(fps.shape[1]):
            far += np.bitwise_count(fps[mine, m][:, None] ^ fps[:, m][None, :])
        ratio = np.minimum(size[mine][:, None], size[None, :]) >= similarity * np.maximum(size[mine][:, None], size[None, :]) - 1e-9
        open_ = (far <= bits) & ratio & (mine[:, None] < np.arange(n)[None, :])
        if two:
            open_ &= side[mine][:, None] != side[None, :]
        theirs = np.flatnonzero(open_.any(0))
        mine = mine[open_.any(1)]
        while len(mine) and len(theirs):
            # as many rows at once as keep their columns few
            a = len(mine)
            while True:
                columns = np.unique(np.concatenate([column[first[r] : first[r + 1]] for r in mine[:a].tolist()]))
                if a == 1 or a * len(columns) <= cells:
                    break
                a = -(-a // 4)
            left = matrix(mine[:a], columns)
            wide = max(1, cells // max(len(columns), 1))
            for t in range(0, len(theirs), wide):
                right = theirs[t : t + wide]
                both = np.rint(left @ matrix(right, columns).T).astype(np.int64)
                union = size[mine[:a]][:, None] + size[right][None, :] - both
                i, j = np.nonzero((both >= similarity * union - 1e-9) & open_[mine[:a] - s][:, right])
                yield mine[:a][i], right[j]
            mine = mine[a:]


def verified(groups: DataFrame, points: DataFrame, sets: DataFrame, bits: int, similarity: float) -> DataFrame:
    """Links (a long, b long) between points of a group (group, side, point) whose sets of shingles are similar enough: per group
    a spanning forest. A point's set travels once per group that it is in."""

    @tidied_group
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("point")
        names = rows.column("point").to_numpy()
        fps = np.frombuffer(b"".join(rows.column("fp").to_pylist()), U64).reshape(len(names), -1)
        data, ends = A.text_bytes(rows.column("shingles"))
        values = np.frombuffer(data.tobytes(), U64)
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in similar_pairs(fps, rows.column("side").to_numpy(), ends // 8, values, bits, similarity):
            a, b = np.concatenate([a, i]), np.concatenate([b, j])
            if len(a) > 1 << 18:
                x, y, nodes = forest(a, b)
                a, b = nodes[x], nodes[y]
        if len(a):
            x, y, nodes = forest(a, b)
            a, b = nodes[x], nodes[y]
        return pa.table({"a": pa.array(names[a], pa.int64()), "b": pa.array(names[b], pa.int64())})

    held = groups.join(points.select("point", "fp"), "point").join(sets, "point")
    return held.select("group", "side", "point", "fp", "shingles").groupBy("group").applyInArrow(run, "a long, b long")


def similar_groups(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, bits: int = 36, id_col: str = "doc_id", text_col: str = "text", chunk: int = 2048, chunks: int = 32
) -> DataFrame:
    """Rows (doc_id, point, component_id), one per row of `docs`; component_id is the smallest doc_id reachable over pairs whose
    sets of shingles have the Jaccard similarity. No pair below it links; of those at it, `RECALL` meet at an anchor.

    Equal sets are one point. Candidates are pairs that meet at an anchor within `bits` bits; per anchor a spanning forest of
    them joins points to families, and within a family all pairs within the bits are verified in one task, in blocks. Families
    of more than `chunk` points are dealt by pairs of chunks; those of more than `chunks` of them, where most pairs do not
    meet anywhere, by anchors. So no pair is a row, and every candidate is verified. Nulls as in `simhash_groups`.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    marked = scratch.written(shingle_sets(rows, shingle), "shingled")
    points = scratch.written(marked.groupBy("point").agg(F.min("doc_id").alias("first"), F.min("text_hash").alias("text_hash"), F.first("fp").alias("fp"), F.first("margin").alias("margin")), "points")
    n = points.count()
    code = Soft(n)
    buckets = max(64, int(n * code.replicas * 32 / 1.6e7))
    tree = scratch.written(candidates(points, code, bits, buckets), "trees")
    families = components(tree)
    met = tree.select(F.explode(F.array("a", "b")).alias("point")).distinct()
    some = scratch.written(points.join(met.join(families, met["point"] == families["node"], "left").select("point", F.coalesce("component", "point").alias("family")), "point"), "met-points")
    parts = F.ceil(F.col("n") / chunk)
    large = some.groupBy("family").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk).select("family", parts.alias("parts"))
    dealt = some.join(large, "family", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit(3), "point"), F.col("parts"))
    paired = dealt.where(F.col("parts") <= chunks).select("point", "family", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    groups = paired.select(F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("group"), (F.col("own") > F.col("other")).cast("int").alias("side"), "point")
    wide = dealt.where(F.col("parts") > chunks).select("point", "fp", "margin")
    if not wide.isEmpty():
        groups = groups.unionByName(candidates(wide, code, bits, buckets, chunk))
    texts = rows.join(some.select("text_hash"), "text_hash", "left_semi")
    sets = scratch.written(shingle_sets(texts, shingle, with_set=True).dropDuplicates(["point"]), "shingle-sets")
    links = scratch.written(verified(groups, some, sets, bits, similarity), "links")
    joined = components(links)
    grouped = points.select("point", "first").join(joined, points["point"] == joined["node"], "left").select("point", "first", F.coalesce("component", "point").alias("group"))
    least = grouped.groupBy("group").agg(F.min("first").alias("component_id"))
    label = grouped.join(least, "group").select("point", "component_id")
    found = written(marked.select("doc_id", "point").join(label, "point").select("doc_id", "point", "component_id"), "groups")
    scratch.remove()
    return found


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
