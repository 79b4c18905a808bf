"""Vectorised helpers that run inside Spark tasks on the bytes of an Arrow string column.

A batch of texts is one uint8 array plus document offsets. Words are ``[^\\x20\\x09-\\x0D]+`` everywhere.
Hashes are 64-bit polynomial hashes of bytes, mixed; `mix` is the splitmix64 finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MULT = U64(0x9E3779B97F4A7C15)
MULT_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
GRAM = U64(0xD6E8FEB86659FD93)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * MULT)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """MULT**i and MULT**-i for i < n (kept between batches up to 2 M entries)."""
    up, down = _powers["up"], _powers["down"]
    if len(up) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, MULT, U64), np.full(size, MULT_INV, U64)
        up[0] = down[0] = U64(1)
        up, down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        if size <= 1 << 21:
            _powers.update(up=up, down=down)
    return up[:n], down[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def pieces(data: np.ndarray, offs: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of about `limit` bytes: (first row, end row, bytes, offsets). A longer text is a run of its own."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def positions(raw: bytes, mark: bytes) -> np.ndarray:
    """Where `mark` stands in `raw`."""
    out, at = [], raw.find(mark)
    while at >= 0:
        out.append(at)
        at = raw.find(mark, at + 1)
    return np.array(out, np.int64)


def count_between(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each [offs[i], offs[i+1])."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


class Words:
    """Words of a run of documents: start, end (byte positions), doc (row), first (first word of each row, plus the total)."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        solid = ~IS_SPACE[data]
        n = len(data)
        begin, stop = solid.copy(), solid.copy()
        if n:
            begin[1:] &= ~solid[:-1]
            stop[:-1] &= ~solid[1:]
            heads = offs[:-1][offs[:-1] < offs[1:]]
            begin[heads] = solid[heads]
            tails = offs[1:][offs[:-1] < offs[1:]] - 1
            stop[tails] = solid[tails]
        self.solid = solid
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offs)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offs) - 1), self.count)


def byte_prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums for `span_hash`."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUE[data] * powers(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes in each [start, end), the same wherever they stand."""
    down = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64) * GRAM)


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of n consecutive word hashes from each position with n words to its right (document ends are the caller's)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for j in range(n):
        out *= GRAM
        out += words[j : j + m]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for every full window, in log2(w) passes."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def cover(flags: np.ndarray, w: int, n: int) -> np.ndarray:
    """Positions of n that some flagged window [i, i+w) covers."""
    at = np.flatnonzero(flags)
    mark = np.bincount(at, minlength=n + 1) - np.bincount(np.minimum(at + w, n), minlength=n + 1)
    return np.cumsum(mark[:n]) > 0
