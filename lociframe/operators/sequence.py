"""Masks and statistics of sequences: frames (contig, seq) or, where a function walks along sequences, tiles of them."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.operators.intervals import complement, label_lengths, merge, overlap_semi, subtract
from lociframe.operators.lineage import kept

#: Characters of a tile, and of a piece of one that sites are looked up in.
TILE, PIECE = 65_536, 4_096
#: Bytes of a text that are walked at once, and runs that are handed on together.
WALK, RUNS = 1 << 20, 1 << 16
TILES = "contig string, at long, n int, before string, ends boolean, seq string"


def letters(text: str) -> np.ndarray:
    """Code points, upper-cased where that is one character."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lower = (codes >= 97) & (codes <= 122)
    codes = np.where(lower, codes - 32, codes)
    for c in np.unique(codes[codes > 127]).tolist():
        up = chr(c).upper()
        if len(up) == 1 and ord(up) != c:
            codes[codes == c] = ord(up)
    return codes


COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")


def complemented(text: str) -> str:
    """The reverse complement; characters other than A, C, G and T are their own."""
    return text.translate(COMPLEMENT)[::-1]


def tiled(seqs: DataFrame, overlap: int = 0, tile: int = TILE) -> DataFrame:
    """(contig, at, n, before, ends, seq): tiles of (contig, seq), as `sources.fasta.read_fasta_tiles` reads them: n characters from `at` on,
    with up to `overlap` that follow, the character before, and whether the contig ends in `seq`. Each sequence is walked once.
    Frames that are tiles already pass; their overlap must be as large."""
    if "at" in seqs.columns:
        return seqs.select("contig", "at", "n", "before", "ends", "seq")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            size = 0
            for contig, seq in zip(batch.column(0), batch.column(1), strict=True):
                name, text = contig.as_py(), seq.as_py() or ""
                for at in range(0, len(text), tile):
                    n = min(tile, len(text) - at)
                    held.append((name, at, n, text[at - 1] if at else "", at + n + overlap >= len(text), text[at : at + n + overlap]))
                    size += n
                    if size > 1 << 22:
                        yield tile_batch(held)
                        held, size = [], 0
            if held:
                yield tile_batch(held)

    return seqs.select("contig", "seq").mapInArrow(cut, TILES)


def tile_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[c.split()[0] for c in TILES.split(", ")])


def full_text(before: str, seq: str, n: int, ends: bool, k: int) -> str:
    """The character before a tile and the tile, whose overlap must reach to all windows of k characters and one more."""
    if not ends and len(seq) < n + k:
        raise ValueError(f"windows of {k} need tiles with an overlap of {k}")
    return before + seq


def lengths(seqs: DataFrame) -> DataFrame:
    """(contig, len) of sequences or tiles."""
    if "at" in seqs.columns:
        return seqs.groupBy("contig").agg(F.max(F.col("at") + F.col("n")).alias("len"))
    return seqs.select("contig", F.length("seq").cast("long").alias("len"))


def pieces(seqs: DataFrame, size: int = PIECE) -> DataFrame:
    """(contig, bin, at, seq): short pieces of sequences or tiles, each within one bin of `size` bases."""
    bins = F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("n") - 1) / size))
    cut = tiled(seqs).where("n > 0").withColumn("bin", F.explode(bins)).withColumn("from", F.greatest("at", F.col("bin") * size))
    to = F.least(F.col("at") + F.col("n"), (F.col("bin") + 1) * size)
    return cut.select("contig", "bin", F.col("from").alias("at"), F.substr("seq", (F.col("from") - F.col("at") + 1).cast("int"), (to - F.col("from")).cast("int")).alias("seq"))


def _runs(contigs: DataFrame, inside: bytes, label: str) -> DataFrame:
    """Maximal runs of the ASCII characters `inside`. Runs of a tile are found in numpy, and only those that touch a tile's edge are
    merged."""
    member = np.zeros(256, bool)
    member[list(inside)] = True

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, edges = [], [], [], []
            for k, (at, n, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(5), strict=True)):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                whole = chars[-1] == n  # nothing of what follows
                if not whole:
                    raw = raw[: np.searchsorted(chars[1:], n, "right")]
                flag = np.concatenate([[False], member[raw], [False]])
                change = np.flatnonzero(flag[1:] != flag[:-1])
                first, last = chars[change[::2]], chars[change[1::2]]
                rows.append(np.full(len(first), k))
                starts.append(first + at)
                ends.append(last + at)
                closed = whole and batch.column(4)[k].as_py()
                edges.append(((first == 0) & (at > 0)) | ((last == n) & (not closed)))
            some = pa.array(np.concatenate([np.zeros(0, np.int64), *rows]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(some), *(pa.array(np.concatenate([np.zeros(0, t), *x])) for t, x in ((np.int64, starts), (np.int64, ends), (bool, edges)))], names=["chrom", "start", "end", "edge"])

    if "at" not in contigs.columns:
        return contigs.select("contig", "seq").mapInArrow(whole_runs(member), "chrom string, start long, end long").withColumn("label", F.lit(label))
    hits = tiled(contigs).mapInArrow(find, "chrom string, start long, end long, edge boolean")
    return hits.where("not edge").select("chrom", "start", "end").unionByName(merge(hits.where("edge").select("chrom", "start", "end"))).withColumn("label", F.lit(label))


def whole_runs(member: np.ndarray):
    """A function for mapInArrow over (contig, seq): maximal runs of the bytes in `member`, text by text in pieces of WALK bytes. A run that
    goes on in the next piece is held until it ends, so a text needs no tiles and its runs no merging."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, held = [], [], [], 0
            for k, text in enumerate(batch.column(1)):
                if not text.is_valid:
                    continue
                raw, seen, open_ = np.frombuffer(text.as_buffer(), np.uint8), 0, -1
                for s in range(0, len(raw), WALK):
                    piece = raw[s : s + WALK]
                    flag = np.concatenate([[open_ >= 0], member[piece], [False]])
                    lead = (piece & 0xC0) != 0x80
                    if lead.all():
                        place = lambda x, seen=seen: x + seen
                        size = len(piece)
                    else:
                        chars = np.concatenate([[0], np.cumsum(lead, dtype=np.int32)])
                        place = lambda x, chars=chars, seen=seen: chars[x] + seen
                        size = int(chars[-1])
                    change = np.flatnonzero(flag[1:] != flag[:-1])
                    if open_ >= 0:  # the run that came in ends at the first change, its start is known
                        first, last = np.concatenate([[open_], place(change[1::2])]), place(change[::2])
                    else:
                        first, last = place(change[::2]), place(change[1::2])
                    seen, open_ = seen + size, -1
                    if s + WALK < len(raw) and len(piece) and member[piece[-1]]:
                        open_, first, last = int(first[-1]), first[:-1], last[:-1]
                    rows.append(np.full(len(first), k, np.int32))
                    starts.append(first.astype(np.int64))
                    ends.append(last.astype(np.int64))
                    held += len(first)
                    if held > RUNS:
                        yield run_batch(batch, rows, starts, ends)
                        rows, starts, ends, held = [], [], [], 0
            yield run_batch(batch, rows, starts, ends)

    return run


def run_batch(batch: pa.RecordBatch, rows: list[np.ndarray], starts: list[np.ndarray], ends: list[np.ndarray]) -> pa.RecordBatch:
    columns = (pa.array(np.concatenate([np.zeros(0, t), *x])) for t, x in ((np.int64, starts), (np.int64, ends)))
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate([np.zeros(0, np.int32), *rows]))), *columns], names=["chrom", "start", "end"])


def hard_mask(contigs: DataFrame) -> DataFrame:
    """Runs of upper-case N."""
    return _runs(contigs, b"N", "NRef")


def soft_mask(contigs: DataFrame) -> DataFrame:
    """Runs of lower-case letters."""
    return _runs(contigs, bytes(range(97, 123)), "SoftMaskRef")


def exclude_mask(iv: DataFrame) -> DataFrame:
    return iv.select("chrom", "start", "end", F.lit("Excluded").alias("label"))


def window_sums(seqs: DataFrame, k: int, window: int) -> DataFrame:
    """(contig, w, s, m) of each window of `window` starts: the sum of ln(n!) over the counts n of its k-mers, and their number.

    Windows within a tile are summed there; of those that tiles share, the counts of k-mers meet first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            closed_ones: list[tuple] = []
            for row in range(batch.num_rows):
                contig, at, n, _, ends, seq = (batch.column(c)[row].as_py() for c in range(6))
                text = full_text("", seq, n, ends, k - 1)
                starts = min(n, len(text) - k + 1)
                if starts <= 0:
                    continue
                codes = letters(text)
                known, rank = np.unique(codes, return_inverse=True)
                bits = max(1, int(len(known) - 1).bit_length())
                per, words = 64 // bits, []
                for a in range(0, k, per):
                    word = np.zeros(starts, np.uint64)
                    for j in range(a, min(k, a + per)):
                        word = (word << np.uint64(bits)) | rank[j : j + starts].astype(np.uint64)
                    words.append(word)
                w = (np.arange(starts) + at) // window
                order = np.lexsort([*words[::-1], w])
                new = np.concatenate([[True], np.any([x[order][1:] != x[order][:-1] for x in (w, *words)], axis=0)])
                head = np.flatnonzero(new)
                count = np.diff(np.concatenate([head, [starts]]))
                of = w[order][head]
                closed = ends and len(seq) == n
                inside = (of * window >= at) & (((of + 1) * window <= at + n) | closed)
                log = np.array([math.lgamma(x + 1) for x in range(int(count.max()) + 1)])[count]
                first = int(of[0])
                sums, sizes = (np.bincount(of[inside] - first, x[inside]) for x in (log, count))
                some = np.flatnonzero(sizes)
                closed_ones.append((contig, first + some, sums[some], sizes[some].astype(np.int64)))
                upper = "".join(map(chr, codes))
                out += [(contig, int(of[i]), None, None, upper[p : p + k], int(count[i])) for i in np.flatnonzero(~inside).tolist() for p in [int(order[head[i]])]]
            types = (pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.string(), pa.int64())
            if closed_ones:
                names, *columns = zip(*closed_ones, strict=True)
                many = sum(len(w) for w in columns[0])
                owners = pa.array(names, pa.string()).take(pa.array(np.repeat(np.arange(len(names)), [len(w) for w in columns[0]])))
                yield pa.RecordBatch.from_arrays([owners, *(pa.array(np.concatenate(c)) for c in columns), pa.nulls(many, pa.string()), pa.nulls(many, pa.int64())], names=["contig", "w", "s", "m", "kmer", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 6, types, strict=True)], names=["contig", "w", "s", "m", "kmer", "n"])

    aligned = "at" not in seqs.columns and window <= TILE
    found = tiled(seqs, k, TILE // window * window if aligned else TILE).mapInArrow(find, "contig string, w long, s double, m long, kmer string, n long")
    if aligned:  # tiles hold whole windows
        return found.where("kmer is null").select("contig", "w", "s", "m")
    shared = found.where("kmer is not null").groupBy("contig", "w", "kmer").agg(F.sum("n").alias("n"))
    logs = F.expr("ln(1)") + F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("n")), F.lit(0.0), lambda t, i: t + F.log(i))
    summed = shared.groupBy("contig", "w").agg(F.sum(logs).alias("s"), F.sum("n").alias("m"))
    return found.where("kmer is null").select("contig", "w", "s", "m").unionByName(summed)


def low_complexity_mask(contigs: DataFrame, k: int = 7, window: int = 5_000, threshold: float = 0.6) -> DataFrame:
    """Merged windows of low complexity: over the counts n of a window's k-mers, the sum of ln(n!) exceeds what as many random
    k-mers give, 4^k e^-x sum(ln(n!) x^n / n!) with x = k-mers / 4^k, by more than `threshold` per k-mer.

    contigs: (contig, seq), or tiles with an overlap of k or more."""
    sums = window_sums(contigs, k, window)
    logs = np.array([math.lgamma(i + 1) for i in range(2, RANDOM_TERMS + 1)])

    def complex_enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, at = np.unique(batch.column(3).to_numpy(), return_inverse=True)  # few numbers of k-mers, many windows
            x = m[:, None] / float(4**k)
            random = (logs * np.exp(np.arange(2, RANDOM_TERMS + 1) * np.log(x) - x - logs)).sum(1)
            low = batch.column(2).to_numpy() - float(4**k) * random[at] > threshold * m[at]
            yield batch.filter(pa.array(low)).select(["contig", "w"])

    # far fewer than the windows, and `merge` reads them more than once
    scored = kept(sums.mapInArrow(complex_enough, "contig string, w long"), "low-complexity")
    ends = scored.join(lengths(contigs), "contig")
    return merge(ends.select(F.col("contig").alias("chrom"), (F.col("w") * window).alias("start"), F.least((F.col("w") + 1) * window, F.col("len")).alias("end")))


#: Terms of the sum for random k-mers; x is small where a window has fewer k-mers than there are different ones.
RANDOM_TERMS = 60


def logs_to(n: int) -> Column:
    """ln(i!) for i up to n, as one array."""
    return F.from_json(F.lit(json.dumps([math.lgamma(i + 1) for i in range(n + 1)])), "array<double>")


def count_of(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc_percent(contigs: DataFrame) -> DataFrame:
    """Length-weighted GC share over A, C, G, T of the genome."""
    return contigs.agg((100.0 * F.sum(count_of(F.col("seq"), "GCgc")) / F.sum(count_of(F.col("seq"), "ACGTacgt"))).alias("gc_percent"))


def cluster_hits(hits: DataFrame, min_len: int, max_gap: int, drop_contig: str) -> DataFrame:
    """hits (chrom, start, end, q_start, q_end): long ones off the dropped contig, strand from the query's order, merged within max_gap."""
    strand = F.when(F.col("q_start") <= F.col("q_end"), "+").otherwise("-")
    used = hits.where((F.col("end") - F.col("start") >= min_len) & (F.col("chrom") != drop_contig)).withColumn("strand", strand)
    return merge(used, max_gap, {"strands": F.concat_ws(",", F.array_sort(F.collect_set("strand"))), "q_min": F.min(F.least("q_start", "q_end")), "q_max": F.max(F.greatest("q_start", "q_end"))})


def numt_mask(hits: DataFrame, min_len: int, max_gap: int, mito: str | None = None) -> DataFrame:
    """(chrom, start, end, strands, label): where the matches of `kmers.kmer_hits` of nuclear against mitochondrial sequences lie, from
    `min_len` on, merged within `max_gap`; not on the mitochondrial contig itself."""
    last = F.col("b_start") + F.col("end") - F.col("start")
    forward = F.col("strand") == "+"
    turned = hits.select(F.col("a_contig").alias("chrom"), "start", "end", F.when(forward, F.col("b_start")).otherwise(last).alias("q_start"), F.when(forward, last).otherwise(F.col("b_start")).alias("q_end"))
    return cluster_hits(turned, min_len, max_gap, mito or "").select("chrom", "start", "end", "strands", F.lit("NUMT").alias("label"))


def merge_masks(*masks: DataFrame) -> DataFrame:
    """All masks in one, overlapping ones merged with their distinct labels."""
    out = masks[0].select("chrom", "start", "end", "label")
    for m in masks[1:]:
        out = out.unionByName(m.select("chrom", "start", "end", "label"))
    return merge(out, 0, {"label": F.concat_ws(",", F.array_sort(F.collect_set("label")))})


def summarise_masks(include: DataFrame, masks: DataFrame, contigs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classification that covers the genome, passing intervals, bases per label)."""
    wanted = merge(include.select("chrom", "start", "end"))
    passing = subtract(wanted, masks.select("chrom", "start", "end"))
    outside = complement(wanted, contigs).withColumn("label", F.lit("Excluded"))
    rest = subtract(outside, masks.select("chrom", "start", "end"))
    whole = masks.select("chrom", "start", "end", "label").unionByName(passing.withColumn("label", F.lit("Included"))).unionByName(rest)
    return whole, passing, label_lengths(whole)


def circular_shift(contigs: DataFrame, n: int) -> DataFrame:
    """Each sequence begins at its n-th base (modulo its length)."""
    at = F.pmod(F.lit(n), F.greatest(F.length("seq"), F.lit(1)))
    return contigs.withColumn("seq", F.concat(F.substr("seq", at + 1), F.substr("seq", F.lit(1), at)))


def gc_windows(seqs: DataFrame, size: int) -> DataFrame:
    """(contig, bin, gc): GC percent, rounded down, among A, C, G and T of whole windows of `size` bases that have any."""
    cut = pieces(seqs, size).groupBy("contig", "bin").agg(F.sum(count_of(F.col("seq"), "GCgc")).alias("g"), F.sum(count_of(F.col("seq"), "ACGTacgt")).alias("n"), F.sum(F.length("seq")).alias("len"))
    return cut.where((F.col("len") == size) & (F.col("n") > 0)).select("contig", "bin", F.floor(100 * F.col("g") / F.col("n")).alias("gc"))


def n_proportion(contigs: DataFrame) -> DataFrame:
    """Per sequence: bases, N bases, share."""
    n = count_of(F.col("seq"), "Nn")
    return contigs.select("contig", F.length("seq").alias("total"), n.alias("n_bases"), (n / F.length("seq")).alias("proportion"))


def covered_n_share(contigs: DataFrame, sites: DataFrame) -> DataFrame:
    """Share of covered sites that are not in runs of N. sites: (chrom, pos), a row each, or intervals (chrom, start, end), whose bases
    count once and are not rows."""
    if "pos" not in sites.columns:
        bases = lambda iv, name: iv.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias(name))
        covered = merge(sites.select("chrom", "start", "end"))
        free = subtract(covered, hard_mask(contigs).select("chrom", "start", "end"))
        return bases(covered, "n_sites").crossJoin(bases(free, "n_free")).select("n_sites", (F.col("n_free") / F.nullif("n_sites", F.lit(0))).alias("not_n"))
    points = sites.select("chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end")).distinct()
    inside = overlap_semi(points, hard_mask(contigs).drop("label")).agg(F.count(F.lit(1)).alias("n_in"))
    return points.agg(F.count(F.lit(1)).alias("n_sites")).crossJoin(inside).select("n_sites", (1 - F.col("n_in") / F.col("n_sites")).alias("not_n"))


def allsites(contigs: DataFrame, *masks: DataFrame) -> DataFrame:
    """The genome without any of the masks."""
    union = masks[0].select("chrom", "start", "end")
    for m in masks[1:]:
        union = union.unionByName(m.select("chrom", "start", "end"))
    return complement(union, contigs)


def autosome_mask(contigs: DataFrame, pattern: str) -> DataFrame:
    """Whole contigs whose name does not match the pattern."""
    return contigs.where(~F.col("contig").rlike(pattern)).select(F.col("contig").alias("chrom"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
