"""Substring dedup by level-wise doubling.

A window of `window` words is repeated only if all shorter windows in it are. Level by level (length, twice the length, ...,
the window itself) a candidate is represented by the smallest of its sub-windows of that length, a choice that depends on
content alone, so equal windows choose alike; windows whose sub-window is repeated at one length alone go on to twice that
length, until none survive or the full length is decided. The last level compares 96 bits of hash of whole windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm import exchange as X
from lociframe.llm.frames import table
from lociframe.llm.workers import tidied_group, tidied_pair

U64 = A.U64
LAST = np.dtype([("h", "<u8"), ("check", "<u4"), ("doc", "<i8")])
NO_ID = np.iinfo(np.int64).max  # a null id is larger than any other


def level_lengths(window: int, base: int) -> list[int]:
    out = [min(base, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


class Group:
    """One group of documents with the candidates that the answered levels leave."""

    def __init__(self, docs: pa.Table, window: int):
        self.docs = X.in_order(docs)
        ids = self.docs.column("doc_id").combine_chunks()
        self.ids = np.asarray(ids.fill_null(NO_ID)) if len(ids) else np.zeros(0, np.int64)
        self.data, self.offs = A.text_bytes(self.docs.column("text"))
        self.window = window
        self.words = A.Words(self.data, self.offs)
        self.hash = A.span_hash(A.byte_prefix(self.data), self.words.start, self.words.end)
        n = len(self.hash) - window + 1
        self.starts = np.flatnonzero(self.words.doc[window - 1 :] == self.words.doc[:n]) if n > 0 else np.zeros(0, np.int64)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, position) of the representative of every candidate at this length."""
        grams = A.gram_hash(self.hash, length)
        if length == self.window or not len(self.starts):
            return grams[self.starts] if len(self.starts) else np.zeros(0, U64), self.starts
        bits = U64(32)  # a fixed width: equal windows choose alike in groups of any size, equal hashes by their order
        low = (U64(1) << bits) - U64(1)
        least = A.sliding_min((grams & ~low) | np.arange(len(grams), dtype=U64), self.window - length + 1)
        at = (least[self.starts] & low).astype(np.int64)
        return A.mix(grams[at] ^ A.GRAM), at  # smallest hashes are dense at the low end; mixed again they fill all buckets alike

    def narrow(self, length: int, bits: bytes) -> None:
        """Keep the candidates whose representative is repeated: in another document of the group, or by the answer in another group."""
        h, at = self.anchors(length)
        distinct, several = self.distinct(h, at)
        yes = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
        sizes = np.bincount(X.bucket_of(distinct, self.buckets), minlength=0) if len(distinct) else np.zeros(0, np.int64)
        yes = unpadded(yes, sizes[sizes > 0])
        self.starts = self.starts[(several | yes)[np.searchsorted(distinct, h)]] if len(h) else self.starts

    buckets = 1

    def distinct(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes, and whether each stands in two documents of the group."""
        doc = self.ids[self.words.doc[at]] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((doc, h))
        hs, ds = h[order], doc[order]
        head = np.concatenate([[True], hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, bool)
        change = np.zeros(len(hs), bool)
        if len(hs):
            change[1:] = (hs[1:] == hs[:-1]) & (ds[1:] != ds[:-1])
        group = np.cumsum(head) - 1
        return hs[head], np.bincount(group[change], minlength=int(head.sum())) > 0

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """(entries of LAST, one per distinct window and sorted; index of each candidate's entry)."""
        h, at = self.anchors(self.window)
        other = A.gram_hash(A.mix(self.hash ^ A.MULT), self.window)
        check = (other[at] >> U64(32)).astype(np.uint32) if len(at) else np.zeros(0, np.uint32)
        doc = self.ids[self.words.doc[at]] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((doc, check, h))
        h, check, doc = h[order], check[order], doc[order]
        head = np.concatenate([[True], (h[1:] != h[:-1]) | (check[1:] != check[:-1])]) if len(h) else np.zeros(0, bool)
        entries = np.empty(int(head.sum()), LAST)
        entries["h"], entries["check"], entries["doc"] = h[head], check[head], doc[head]
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(head) - 1
        return entries, index


def unpadded(bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits of consecutive runs of the given sizes, each run padded to whole bytes."""
    starts = np.concatenate([[0], np.cumsum(-(-sizes // 8) * 8)[:-1]]).astype(np.int64) if len(sizes) else np.zeros(0, np.int64)
    take = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes).astype(np.int64) + np.arange(int(sizes.sum())) if len(sizes) else np.zeros(0, np.int64)
    return bits[take]


def packed_runs(flags: np.ndarray, sizes: list[int]) -> list[bytes]:
    return [np.packbits(flags[s], bitorder="little").tobytes() for s in X.split_lengths(sizes)]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, base: int = 4, carry: tuple[str, ...] = (), joined: bool = True) -> DataFrame:
    """Rows (doc_id, carried columns, kept_text, n_words, n_removed, n_spans), one per row of `docs`.

    A word goes if a window of `window` words that covers it also starts in a document with a smaller id; windows are
    judged on the input. kept_text: the other words, joined by one space; or, if not `joined`, the text as it is without the
    removed words and the white space between each of them and the next word. Null texts have no words; texts under one window
    lose nothing; rows with equal ids do not count against each other; a null id is larger than any other; an empty table
    gives no rows.
    """
    grouped, size = X.grouped_text(docs, id_col, text_col, carry)
    lengths, buckets = level_lengths(window, base), X.buckets_for(size)

    def load(docs_table: pa.Table, answered: pa.Table | None, levels: int) -> Group:
        group = Group(docs_table, window)
        group.buckets = buckets
        for level in range(levels):
            group.narrow(lengths[level], X.answers(answered, level) if answered is not None else b"")
        return group

    def asking(level: int):
        def run(docs_table: pa.Table, answered: pa.Table | None) -> pa.Table:
            g = docs_table.column("g")[0].as_py() if docs_table.num_rows else -1
            group = load(docs_table, answered, level)
            if level == len(lengths) - 1:
                entries, _ = group.last()
                return X.ask(g, entries, entries["h"], buckets)
            distinct, _ = group.distinct(*group.anchors(lengths[level]))
            return X.ask(g, distinct, distinct, buckets)

        return tidied_pair(run) if level else tidied_group(lambda docs_table: run(docs_table, None))

    def answering(level: int):
        @tidied_pair
        def run(key: tuple, rows: pa.Table) -> pa.Table:
            groups, payloads = rows.column("g").to_pylist(), rows.column("payload").to_pylist()
            if level == len(lengths) - 1:
                e = np.frombuffer(b"".join(payloads), LAST)
                order = np.lexsort((e["doc"], e["check"], e["h"]))
                h, c, d = e["h"][order], e["check"][order], e["doc"][order]
                head = np.concatenate([[True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])])
                least = d[np.flatnonzero(head)][np.cumsum(head) - 1]
                flags = np.empty(len(e), bool)
                flags[order] = least < d
                sizes = [len(p) // LAST.itemsize for p in payloads]
            else:
                flags = repeated_any(np.frombuffer(b"".join(payloads), U64))
                sizes = [len(p) // 8 for p in payloads]
            return X.answer_rows(level, key[0].as_py(), groups, packed_runs(flags, sizes))

        return run

    answered = None
    for level in range(len(lengths)):
        if answered is None:
            asked = grouped.groupBy("g").applyInArrow(asking(level), X.ASKED)
        else:
            asked = grouped.groupBy("g").cogroup(answered.groupBy("g")).applyInArrow(asking(level), X.ASKED)
        more = asked.groupBy("bucket").applyInArrow(answering(level), X.ANSWERED)
        answered = more if answered is None else answered.unionByName(more)

    @tidied_pair
    def finish(docs_table: pa.Table, replies: pa.Table) -> pa.Table:
        group = load(docs_table, replies, len(lengths) - 1)
        entries, index = group.last()
        yes = np.unpackbits(np.frombuffer(X.answers(replies, len(lengths) - 1), np.uint8), bitorder="little").astype(bool)
        sizes = np.bincount(X.bucket_of(entries["h"], buckets)) if len(entries) else np.zeros(0, np.int64)
        yes = unpadded(yes, sizes[sizes > 0])
        w = group.words
        flags = np.zeros(len(w.start), bool)
        if len(index):
            doc = group.ids[w.doc[group.starts]]
            flags[group.starts] = yes[index] | (entries["doc"][index] < doc)
        gone = A.cover(flags, window, len(w.start))
        begins = gone.copy()
        begins[1:] &= ~(gone[:-1] & (w.doc[1:] == w.doc[:-1]))
        removed = A.count_between(gone, w.first)
        raw, texts = group.data.tobytes(), []
        if not joined:
            until = w.end.copy()
            inner = np.flatnonzero(w.doc[1:] == w.doc[:-1])
            until[inner] = w.start[inner + 1]
            edge = np.zeros(len(group.data) + 1, np.int64)
            np.add.at(edge, w.start[gone], 1)
            np.add.at(edge, until[gone], -1)
            stays = np.cumsum(edge[:-1]) == 0
            ends = np.concatenate([[0], np.cumsum(stays)])[group.offs]
            left = group.data[stays].tobytes()
            texts = [left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        for i, (a, b) in enumerate(zip(group.offs[:-1].tolist(), group.offs[1:].tolist(), strict=True) if joined else ()):
            words = raw[a:b].split()
            if removed[i]:
                words = [x for x, no in zip(words, gone[w.first[i] : w.first[i + 1]].tolist(), strict=True) if not no]
            texts.append(b" ".join(words))
        out = {"doc_id": group.docs.column("doc_id")} | {c: group.docs.column(c) for c in carry}
        out |= {"kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "n_words": pa.array(w.count), "n_removed": pa.array(removed), "n_spans": pa.array(A.count_between(begins, w.first))}
        return pa.table(out)

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id long, " + "".join(f"`{c}` {kinds[c]}, " for c in carry) + "kept_text string, n_words long, n_removed long, n_spans long"
    return grouped.groupBy("g").cogroup(answered.groupBy("g")).applyInArrow(finish, schema)


def repeated_any(h: np.ndarray) -> np.ndarray:
    """Flag of entries whose value stands there twice or more."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    flag = np.zeros(len(h), bool)
    flag[1:] |= same
    flag[:-1] |= same
    out = np.empty(len(h), bool)
    out[order] = flag
    return out


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
