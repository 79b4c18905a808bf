"""Adapter trimming with mismatches, by a catalogue and by the overlap of mates. Reads of a batch are one matrix of letters; an
adapter is laid at each start in turn over all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reads of a matrix.
ROWS = 4_096
COMPLEMENTS = np.arange(128, dtype=np.uint32)
for _a, _b in ("AT", "TA", "CG", "GC", "at", "ta", "cg", "gc"):
    COMPLEMENTS[ord(_a)] = ord(_b)


def as_matrix(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(letters as code points, 0 beyond the end; lengths)."""
    sizes = np.array([len(t or "") for t in texts], np.int64)
    out = np.zeros((len(texts), int(sizes.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)
    return out, sizes


def adapter_starts(texts: Sequence[str | None], adapters: Sequence[str], min_overlap: int, error: float) -> np.ndarray:
    """Where each text's first adapter begins, or its length: a start where the adapter, or as much of it as the text has room for and
    `min_overlap` letters at least, has at most floor(error * letters) mismatches."""
    m, sizes = as_matrix(texts)
    first = sizes.copy()
    for adapter in adapters:
        a = np.frombuffer(adapter.encode("utf-32-le"), np.uint32)
        if len(a) < min_overlap:
            continue
        for start in range(m.shape[1] - 1, -1, -1):
            some = np.flatnonzero(sizes - start >= min_overlap)
            if not len(some):
                continue
            part = m[some, start : start + len(a)]
            n = np.minimum(sizes[some] - start, len(a))
            wrong = ((part != a[: part.shape[1]]) & (np.arange(part.shape[1])[None, :] < n[:, None])).sum(1)
            hit = some[wrong <= np.floor(error * n + 1e-9)]
            first[hit] = np.minimum(first[hit], start)
    return first


def cut_to(reads: DataFrame, length: Column, *pairs: tuple[str, str]) -> DataFrame:
    """Columns of `pairs` (seq, qual) cut to a length."""
    return reads.withColumn("__n", length.cast("int")).withColumns({c: F.substr(c, F.lit(1), F.col("__n")) for p in pairs for c in p}).drop("__n")


def trim_adapter(reads: DataFrame, adapters: Sequence[str], min_overlap: int = 8, error: float = 0.125) -> DataFrame:
    """Reads (seq, qual, ...) clipped where the first adapter begins; a remnant of an adapter at the end counts from `min_overlap`
    letters on."""
    if not adapters:
        return reads

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("seq")).to_pylist()
            cut = np.concatenate([np.zeros(0, np.int64), *(adapter_starts(texts[s : s + ROWS], adapters, min_overlap, error) for s in range(0, len(texts), ROWS))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut)], names=[*batch.schema.names, "__cut"])

    schema = ", ".join(f"`{c}` {t}" for c, t in reads.dtypes)
    return cut_to(reads.mapInArrow(find, f"{schema}, `__cut` bigint"), F.col("__cut"), ("seq", "qual")).drop("__cut")


def insert_lengths(first: Sequence[str | None], second: Sequence[str | None], min_overlap: int, error: float, most: int) -> np.ndarray:
    """Length of the insert of each pair whose mates read through it, -1 if none is found: the n from `min_overlap` to the shorter
    read's length at which the first n letters of one mate are the reverse complement of the other's, with the smallest share of
    mismatches, at most `error` and `most` of them; the longest such n."""
    (a, na), (b, nb) = as_matrix(first), as_matrix(second)
    b = np.where(b < 128, COMPLEMENTS[np.minimum(b, 127)], b)
    room = np.minimum(na, nb)
    best, length = np.full(len(a), np.inf), np.full(len(a), -1, np.int64)
    for n in range(min_overlap, int(room.max(initial=0)) + 1):
        some = np.flatnonzero(room >= n)
        wrong = (a[some, :n] != b[some, :n][:, ::-1]).sum(1)
        share = wrong / n
        hit = (share <= error) & (wrong <= most) & (share <= best[some])
        best[some[hit]], length[some[hit]] = share[hit], n
    return length


def trim_read_through(pairs: DataFrame, min_overlap: int = 20, error: float = 0.2, most: int = 5) -> DataFrame:
    """Pairs (seq1, qual1, seq2, qual2, ...) with `insert`, the length that the mates' overlap shows (null if none): what the mates have
    read beyond it, adapter of any length, is clipped."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("seq1", "seq2"))
            found = np.concatenate([np.zeros(0, np.int64), *(insert_lengths(one[s : s + ROWS], two[s : s + ROWS], min_overlap, error, most) for s in range(0, len(one), ROWS))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, mask=found < 0)], names=[*batch.schema.names, "insert"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pairs.dtypes)
    found = pairs.mapInArrow(find, f"{schema}, insert bigint")
    longest = F.greatest(F.length("seq1"), F.length("seq2"))
    return cut_to(found, F.coalesce("insert", longest), ("seq1", "qual1"), ("seq2", "qual2"))


def detected_adapters(pairs: DataFrame, letters: int = 12, min_overlap: int = 20, error: float = 0.2, most: int = 5) -> DataFrame:
    """(mate, adapter, n): the letters that follow the insert in pairs that read through it, by how many pairs show them."""
    whole = pairs.select(F.col("seq1").alias("whole1"), F.col("seq2").alias("whole2"), "seq1", "qual1", "seq2", "qual2")
    found = trim_read_through(whole, min_overlap, error, most).where("insert is not null")
    each = [found.select(F.lit(i).alias("mate"), F.substr(f"whole{i}", (F.col("insert") + 1).cast("int"), F.lit(letters)).alias("adapter")) for i in (1, 2)]
    return each[0].unionByName(each[1]).where(F.length("adapter") == letters).groupBy("mate", "adapter").agg(F.count(F.lit(1)).alias("n"))
