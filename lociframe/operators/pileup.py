"""Allele counts of sites from alignments, in tiles of count arrays."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bases of a tile: reads go to each tile that they reach into.
TILE = 4_096
OP = re.compile(r"([0-9]+)([MIDNSHP=X])")
ON_REF, ON_READ, MATCH = frozenset("MDN=X"), frozenset("MIS=X"), frozenset("M=X")


@functools.lru_cache(4096)
def matches(cigar: str) -> tuple[tuple[int, int, int], ...]:
    """(reference offset, read offset, length) of each run of matches. Insertions and clips advance the read only, deletions the
    reference only."""
    r = q = 0
    out = []
    for n, op in OP.findall(cigar or ""):
        if op in MATCH:
            out.append((r, q, int(n)))
        r += int(n) * (op in ON_REF)
        q += int(n) * (op in ON_READ)
    return tuple(out)


def placed_bases(pos: int, cigar: str, seq: bytes, qual: bytes, min_bq: int, trim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, upper-case letters, qualities) of a read's good bases."""
    at = np.concatenate([np.zeros(0, np.int64), *(np.arange(r, r + n) for r, _, n in matches(cigar))])
    own = np.concatenate([np.zeros(0, np.int64), *(np.arange(q, q + n) for _, q, n in matches(cigar))])
    there = (own >= trim) & (own < len(seq) - trim) & (own < len(qual))
    at, own = at[there], own[there]
    letter, score = np.frombuffer(seq, np.uint8)[own], np.frombuffer(qual, np.uint8)[own].astype(np.int64) - 33
    letter = np.where((letter >= 97) & (letter <= 122), letter - 32, letter)
    good = score >= min_bq
    return pos + at[good], letter[good], score[good]


def pileup(aln: DataFrame, dropped: int, min_bq: int = 13, min_mq: int = 20, trim: int = 0, max_depth: int = 1000) -> DataFrame:
    """(chrom, pos, sample_id, allele, fwd, rev) from alignments (chrom, pos, sample_id, qname, flag, mapq, cigar, seq, qual).

    Bases below `min_bq`, within `trim` of a read's ends, of reads below `min_mq` or with a `dropped` flag are left out. Where a
    template's mates both cover a site, the base of higher quality counts, the first mate's if equal. Templates beyond `max_depth`
    at a site are left out in order of name. A group is a sample's reads in one tile.
    """
    bit = F.col("flag").bitwiseAND(F.lit(dropped)) == 0
    span = F.aggregate(F.regexp_extract_all("cigar", F.lit("([0-9]+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    used = aln.where(bit & (F.col("mapq") >= min_mq) & F.col("seq").isNotNull() & F.col("qual").isNotNull() & F.col("cigar").isNotNull())
    rows = used.select("chrom", "sample_id", F.col("pos").cast("long").alias("pos"), "qname", "flag", "cigar", "seq", "qual", span.alias("n")).where("n > 0")
    tiles = F.sequence(F.floor(F.col("pos") / TILE), F.floor((F.col("pos") + F.col("n") - 1) / TILE))
    dealt = rows.withColumn("tile", F.explode(tiles)).drop("n")

    def count(key: tuple, group: pa.Table) -> pa.Table:
        start = key[2].as_py() * TILE
        counts, depth = np.zeros((TILE, 2, 128), np.int32), np.zeros(TILE, np.int64)
        order = group.sort_by([("qname", "ascending"), ("flag", "ascending")])
        names = order.column("qname").to_pylist()
        pos, flag, cigar, seq, qual = (order.column(c).to_pylist() for c in ("pos", "flag", "cigar", "seq", "qual"))
        i = 0
        while i < len(names):
            e = i + 1
            while e < len(names) and names[e] == names[i]:
                e += 1
            parts = []
            for k in range(i, e):
                at, letter, score = placed_bases(pos[k], cigar[k], seq[k].encode("ascii", "replace"), qual[k].encode("latin-1", "replace"), min_bq, trim)
                inside = (at >= start) & (at < start + TILE)
                parts.append((at[inside] - start, letter[inside], score[inside], np.full(inside.sum(), int(flag[k] & 0x10 != 0))))
            at, letter, score, back = (np.concatenate(x) for x in zip(*parts, strict=True))
            if e - i > 1:  # one base of a template at a site
                best = np.lexsort((np.arange(len(at)), -score, at))
                best = best[np.concatenate([[True], at[best][1:] != at[best][:-1]])] if len(best) else best
                at, letter, back = at[best], letter[best], back[best]
            free = depth[at] < max_depth
            at = at[free]
            depth[at] += 1
            counts[at, back[free], np.minimum(letter[free], 127)] += 1
            i = e
        where, letter = np.nonzero(counts.any(1))
        return pa.table({
            "chrom": pa.array([key[0].as_py()] * len(where), pa.string()), "pos": pa.array(where + start), "sample_id": pa.array([key[1].as_py()] * len(where), pa.string()),
            "allele": pa.array([chr(c) for c in letter], pa.string()), "fwd": pa.array(counts[where, 0, letter].astype(np.int64)), "rev": pa.array(counts[where, 1, letter].astype(np.int64)),
        })

    return dealt.groupBy("chrom", "sample_id", "tile").applyInArrow(count, "chrom string, pos long, sample_id string, allele string, fwd long, rev long")
