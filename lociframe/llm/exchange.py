"""Asking the whole corpus about hashes, group by group.

Documents are dealt into groups of a few MB of text by a hash of their id and text. A group sends, per bucket of hashes, one
packed row of distinct entries in sorted order; a bucket sees every group's entries and answers each with a few bits in the
same order; the answers return to the group, which can recompute what it asked. So a window costs a few bytes on the way
out and bits on the way back, and a hash that stands in a third of all documents reaches its bucket once per group only.

All steps are lazy and keyed: the grouped text is shuffled once and read again by the later steps (one reused exchange),
and a lost task recomputes its own groups or buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import text_size

U64 = A.U64
ASKED = "bucket int, g int, payload binary"
ANSWERED = "g int, level int, bucket int, answer binary"


def grouped_text(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = (), group_bytes: int = 1_500_000) -> tuple[DataFrame, int]:
    """((g, doc_id, text, carried columns), bytes of text). A group is a bounded share of the text, or one longer document."""
    _, size = text_size(docs, text_col)
    groups = max(48, -(-size // group_bytes))
    g = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(groups)).cast("int")
    picked = docs.select(g.alias("g"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c) for c in carry))
    return picked, size


def buckets_for(size: int, bytes_each: int = 8_000_000) -> int:
    return max(64, -(-size // bytes_each))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Rising with the hash, so sorted hashes are sorted by bucket."""
    return ((h >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def in_order(group: pa.Table) -> pa.Table:
    """The group's rows in an order that depends on their content alone."""
    return group.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if group.num_rows > 1 else group


def ask(group_id: int, entries: np.ndarray, hashes: np.ndarray, buckets: int, blob: Callable[[slice], bytes] | None = None) -> pa.Table:
    """Rows (bucket, g, payload) for entries sorted by `hashes`; blob renders a slice of entries, else their own bytes."""
    where = bucket_of(hashes, buckets)
    heads = np.flatnonzero(np.concatenate([[True], np.diff(where) != 0])) if len(where) else np.zeros(0, np.int64)
    ends = np.concatenate([heads[1:], [len(where)]]) if len(where) else heads
    blobs = [blob(slice(a, b)) if blob else entries[a:b].tobytes() for a, b in zip(heads.tolist(), ends.tolist(), strict=True)]
    return pa.table({"bucket": pa.array(where[heads], pa.int32()), "g": pa.array(np.full(len(heads), group_id), pa.int32()), "payload": pa.array(blobs, pa.binary())})


def answers(group: pa.Table, level: int) -> bytes:
    """A level's answers to a group, joined in bucket order."""
    rows = [(b, a) for lv, b, a in zip(group.column("level").to_pylist(), group.column("bucket").to_pylist(), group.column("answer").to_pylist(), strict=True) if lv == level]
    return b"".join(a for _, a in sorted(rows, key=lambda x: x[0]))


def answer_rows(level: int, bucket: int, groups: list[int], parts: list[bytes]) -> pa.Table:
    n = len(groups)
    return pa.table({"g": pa.array(groups, pa.int32()), "level": pa.array([level] * n, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()), "answer": pa.array(parts, pa.binary())})


def split_lengths(lengths: list[int]) -> Iterator[slice]:
    at = 0
    for n in lengths:
        yield slice(at, at + n)
        at += n
