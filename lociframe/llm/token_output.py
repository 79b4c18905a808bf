"""Token-ID output in a binary format of patched frame-of-reference blocks, and its reader.

A shard is a run of documents in ascending id order; it is a sequence of chunks of whole documents, each about 64 Ki ids (one
longer document is a chunk of its own). A chunk's payload packs its ids in blocks of 128: the block's minimum is
subtracted, the rest is packed at the width that holds 90 % of the block, and larger values keep their high bits in an
exception list; an index gives where each block starts. Chunks are rows of Parquet files, so any file system that Spark
writes to will do.

Payload layout, little-endian: magic u32, ids u32, blocks u32, exceptions u32; then per block minimum u32, start of packed
bytes u32, start in the exception list u32, width u8; then the packed bytes; then exceptions: place in block u8, high bits u32.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import table, text_size, written
from lociframe.llm.wordtable import WordTable, distinct, runs, word_keys
from lociframe.llm.workers import keeping, tidied

MAGIC = 0x31524650
BLOCK = 128
CHUNK_IDS = 1 << 16
HEADER = np.dtype("<u4")
STOP = np.zeros(256, bool)
STOP[list(b".,")] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: Kinds of parts: a word after a space, a word after anything else, white space.
SPACED, ALONE, SPACES = 0, 1, 2
# fixed values: UTF-8 of white space beyond ASCII: U+0085, U+00A0, U+1680, U+205F, U+3000; U+2000 to U+200A, U+2028, U+2029 and U+202F by their third byte
WIDE_SPACES = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
WIDE_THIRD = np.zeros(256, bool)
WIDE_THIRD[[*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF]] = True
CHUNKS = "shard int, chunk long, start_in_shard long, n_ids long, doc_ids array<long>, n_tokens array<long>, payload binary"


def width_of(x: np.ndarray) -> np.ndarray:
    """Bits needed for each value."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.uint8)


def pack(ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """Patched frame-of-reference bytes of unsigned 32-bit ids; any values, any number of them, none included."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    values = np.full(blocks * BLOCK, ids[-1] if n else 0, np.uint32)
    values[:n] = ids
    values = values.reshape(blocks, BLOCK)
    least = values.min(1) if blocks else np.zeros(0, np.uint32)
    rest = values - least[:, None]
    place = min(BLOCK - 1, int(percentile * BLOCK))
    width = width_of(np.partition(rest, place, axis=1)[:, place]) if blocks else np.zeros(0, np.uint8)
    high = rest.astype(np.uint64) >> width[:, None].astype(np.uint64)
    block, spot = np.nonzero(high)
    starts = np.zeros(blocks + 1, np.uint32)
    np.cumsum(width.astype(np.int64) * (BLOCK // 8), out=starts[1:], dtype=np.uint32)
    body = np.zeros(int(starts[-1]), np.uint8)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            bits = np.unpackbits(rest[rows].astype(HEADER).view(np.uint8).reshape(-1, 4), axis=1, count=w, bitorder="little")
            packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            body[(starts[rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    patches = np.searchsorted(block, np.arange(blocks)).astype(np.uint32)
    parts = [np.array([MAGIC, n, blocks, len(block)], HEADER), least.astype(HEADER), starts[:-1].astype(HEADER), patches, width, body, spot.astype(np.uint8), high[block, spot].astype(HEADER)]
    return b"".join(p.tobytes() for p in parts)


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    magic, n, blocks, patches = np.frombuffer(payload, HEADER, 4).tolist()
    if magic != MAGIC:
        raise ValueError("not a token payload")
    at = 16
    least, starts, first = (np.frombuffer(payload, HEADER, blocks, at + 4 * blocks * i) for i in range(3))
    at += 12 * blocks
    width = np.frombuffer(payload, np.uint8, blocks, at)
    at += blocks
    size = int(width.astype(np.int64).sum()) * (BLOCK // 8)
    body = np.frombuffer(payload, np.uint8, size, at)
    at += size
    spot = np.frombuffer(payload, np.uint8, patches, at)
    high = np.frombuffer(payload, HEADER, patches, at + patches)
    rest = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        if w:
            rows = np.flatnonzero(width == w)
            packed = body[starts[rows].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)]
            bits = np.zeros((len(rows) * BLOCK, 32), np.uint8)
            bits[:, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, w)
            rest[rows] = np.packbits(bits, axis=1, bitorder="little").view(HEADER).reshape(-1, BLOCK)
    block = np.repeat(np.arange(blocks), np.diff(np.append(first, patches).astype(np.int64)))
    rest[block, spot] += high << width[block].astype(np.uint32)
    return (rest + least[:, None]).ravel()[:n]


class Encoder:
    """Ids of texts by the tokenizers library, with a bounded memory of what words encode to.

    A byte-level tokenizer splits a text into pre-tokens and encodes each alone, and a run of white space ends before the
    last of its characters, which opens the next pre-token if it is a space. So texts are put together from their words and
    white-space runs, and the library is asked once per distinct one, many in a row. Other tokenizers, texts with white space
    beyond ASCII and texts that hold an added token go to the library whole.
    """

    #: Words remembered, at about 45 bytes each.
    BOUND = 800_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.parts_alone = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and spec["model"].get("type") == "BPE"
        self.added = [t["content"].encode() for t in spec.get("added_tokens", [])]
        vocabulary = self.library.get_vocab()
        self.opens = [np.zeros(max(vocabulary.values()) + 1, bool) for _ in range(2)]
        self.opens[SPACED][[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.opens[ALONE][[i for t, i in vocabulary.items() if t == "\u010a"]] = True
        self.known = WordTable(self.BOUND)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _asked(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words of one kind, many in a row: each opened by a space, or by a line feed that is a pre-token
        of its own and taken out again."""
        size = end - start + 1
        joined = data[np.maximum(runs(start - 1, size), 0)]
        joined[np.cumsum(size) - size] = 32 if kind == SPACED else 10
        stops = np.concatenate([[0], np.cumsum(size)])
        heads = np.arange(0, len(start), 512)
        raw = joined.tobytes()
        texts = [raw[stops[a] : stops[min(a + 512, len(start))]].decode() for a in heads.tolist()]
        ids, sizes = [], []
        for a, e in zip(heads.tolist(), self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            got = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(self.opens[kind][got])
            n = min(512, len(start) - a)
            if len(cuts) == n:
                sizes.append(np.diff(np.append(cuts, len(got))) - (kind == ALONE))
                ids.append(got if kind == SPACED else np.delete(got, cuts))
            else:  # a word that the library splits in another way
                mark = " " if kind == SPACED else ""
                each = self.whole([mark + data[i:j].tobytes().decode() for i, j in zip(start[a : a + n].tolist(), end[a : a + n].tolist(), strict=True)])
                sizes.append(np.array([len(x) for x in each]))
                ids += each
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _spaces(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per run) of runs of white space."""
        each = self.whole([data[i:j].tobytes().decode() for i, j in zip(start.tolist(), end.tolist(), strict=True)])
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)

    def _odd(self, raw: bytes, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Texts that go to the library whole. What spans two texts sends one more."""
        odd = np.full(len(offs) - 1, not self.parts_alone)
        if not self.parts_alone:
            return odd
        at = [A.positions(raw, mark) for mark in (*self.added, *WIDE_SPACES)]
        dashes = A.positions(raw, b"\xe2\x80")
        at.append(dashes[WIDE_THIRD[data[np.minimum(dashes + 2, len(data) - 1)]]])
        odd[np.searchsorted(offs, np.concatenate(at), "right") - 1] = True
        return odd

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text) for texts given as bytes and offsets."""
        raw = data.tobytes()
        odd = self._odd(raw, data, offs)
        w = A.Words(data, offs)
        # white space before each word, and after the last word of each text
        lead = w.start.copy()
        if len(lead):
            lead[1:] -= w.end[:-1]
            heads = w.first[:-1][w.count > 0]
            lead[heads] = w.start[heads] - offs[w.doc[heads]]
        last = offs[:-1].copy()
        last[w.count > 0] = w.end[w.first[1:][w.count > 0] - 1]
        opened = np.zeros(len(w.start), bool)
        opened[lead > 0] = data[w.start[lead > 0] - 1] == 32
        # a comma or full stop after a letter, at a word's end, is a pre-token of its own
        before = data[np.maximum(w.end - 2, 0)]
        stop = STOP[data[w.end - 1]] & LETTER[before] & (w.end - w.start > 1)
        runs_of = np.flatnonzero(lead > 1), np.flatnonzero((lead > 0) & ~opened), np.flatnonzero(last < offs[1:])
        start = np.concatenate([w.start, w.end[stop] - 1, (w.start - lead)[runs_of[0]], w.start[runs_of[1]] - 1, last[runs_of[2]]])
        end = np.concatenate([w.end - stop, w.end[stop], w.start[runs_of[0]] - 1, w.start[runs_of[1]], offs[1:][runs_of[2]]])
        doc = np.concatenate([w.doc, w.doc[stop], w.doc[runs_of[0]], w.doc[runs_of[1]], runs_of[2]])
        kind = np.full(len(start), SPACES, np.uint8)
        kind[: len(opened)], kind[len(opened) : len(opened) + int(stop.sum())] = np.where(opened, SPACED, ALONE), ALONE
        plain = np.flatnonzero(~odd[doc])
        order = plain[np.argsort(start[plain], kind="stable")]
        start, end, doc, kind = start[order], end[order], doc[order], kind[order]
        # longer words are named by their number in a batch
        names, short = word_keys(data, start, end, kind)
        longer: dict[tuple[bytes, int], int] = {}
        for i in np.flatnonzero(~short).tolist():
            names[i] = longer.setdefault((raw[start[i] : end[i]], int(kind[i])), len(longer)), 255 << 56
        which, first, hashes = distinct(names)
        names, kind, short = names[first], kind[first], short[first]
        at = np.full(len(first), -1)
        at[short] = self.known.find(names[short], hashes[short])
        size, begin = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        there = at >= 0
        size[there], begin[there] = self.known.size[at[there]], self.known.start[at[there]]
        pools = [self.known.pool]
        base = len(self.known.pool)
        new_rows, new_ids = [], []
        for k in (SPACED, ALONE, SPACES):
            ask = np.flatnonzero(~there & (kind == k))
            if len(ask):
                spans = data, start[first[ask]], end[first[ask]]
                ids, n = self._spaces(*spans) if k == SPACES else self._asked(*spans, k)
                size[ask], begin[ask] = n, base + np.cumsum(n) - n
                base += len(ids)
                pools.append(ids)
                new_rows.append(ask)
        pool = np.concatenate(pools)
        if new_rows:
            new = np.concatenate(new_rows)
            new = new[short[new]]
            new_ids = pool[runs(begin[new], size[new])]
            self.known.add(names[new], hashes[new], size[new], new_ids)
        # whole texts stand after the words' ids in the pool, as parts of their own
        whole = self.whole([raw[a:b].decode() for a, b in zip(offs[:-1][odd].tolist(), offs[1:][odd].tolist(), strict=True)])
        whole_size = np.array([len(x) for x in whole], np.int64)
        size_of, start_of = size[which], begin[which]
        if len(whole):
            doc = np.concatenate([doc, np.flatnonzero(odd)])
            size_of, start_of = np.concatenate([size_of, whole_size]), np.concatenate([start_of, len(pool) + np.cumsum(whole_size) - whole_size])
            pool = np.concatenate([pool, *whole])
            order = np.argsort(doc, kind="stable")
            size_of, start_of, doc = size_of[order], start_of[order], doc[order]
        return pool[runs(start_of, size_of)], np.bincount(doc, size_of, len(offs) - 1).astype(np.int64)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 16_000_000, max_shards: int = 100_000) -> DataFrame:
    """Encode every text, append `end_id`, and write the ids in ascending id order; the written chunks, read back (CHUNKS).

    Nulls encode as empty texts, null ids come first, rows with equal ids go by text; an empty table writes no chunks.
    """
    _, size = text_size(docs, text_col)
    shards = min(max_shards, max(16, -(-size // shard_bytes)))
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    @keeping(("tokens", tokenizer), lambda: Encoder(tokenizer))
    def encode(encoder: Encoder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        end = np.uint32(end_id).tobytes()
        chunk, start = 0, 0
        held: list[tuple[int | None, bytes]] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal chunk, start, held, n_held
            counts = [len(b) // 4 for _, b in held]
            payload = pack(np.frombuffer(b"".join(b for _, b in held), np.uint32))
            row = [[shard], [chunk], [start], [n_held], [[d for d, _ in held]], [counts], [payload]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            chunk, start, held, n_held = chunk + 1, start + n_held, [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=["shard", "chunk", "start_in_shard", "n_ids", "doc_ids", "n_tokens", "payload"])

        for batch in batches:
            data, offs = A.text_bytes(batch.column(1))
            for a, b, part, at in A.pieces(data, offs, 3 << 20):
                ids, counts = encoder(part, at)
                ends = np.cumsum(counts)
                for d, i, j in zip(batch.column(0).slice(a, b - a).to_pylist(), (ends - counts).tolist(), ends.tolist(), strict=True):
                    held.append((d, ids[i:j].tobytes() + end))
                    n_held += j - i + 1
                    if n_held >= CHUNK_IDS:
                        yield flush()
        if held:
            yield flush()

    ordered = picked.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(encode, CHUNKS), "tokens")


def read_tokens(chunks: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids binary) of written chunks: start counts the ids of all documents before."""
    # one row per shard, at most max_shards of them: the running sum and what is broadcast are of that size
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    order = W.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    before = shards.select(F.col("shard").alias("s"), F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))
    joined = chunks.join(F.broadcast(before), F.col("shard") == F.col("s")).select("doc_ids", "n_tokens", "payload", (F.col("before") + F.col("start_in_shard")).alias("start"))

    @tidied
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = unpack(row["payload"]).tobytes()
                ends = np.cumsum(row["n_tokens"])
                starts = ends - row["n_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts), pa.array(row["n_tokens"], pa.int64()), pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return joined.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = write_tokens(table(spark, sf_dir, "documents"), public_tokenizer("byte_bpe_50k.json"))
    return read_tokens(chunks).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
