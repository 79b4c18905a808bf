"""Suffix-array dedup: repeated byte strings by column-wise construction over aligned segments.

A column-wise construction inserts one symbol per document and round, from the right end, and keeps the order of all
suffixes and their common prefixes from the round before. Over whole documents it needs as many rounds as the longest text
has bytes, each passing over everything built so far, so here it runs on what can hold a repeat at all, in columns of
bounded number:

1. Every window of `length` bytes names its anchor, the smallest of the `gram`-byte strings in it. Equal windows name equal
   anchors at equal offsets. Windows of one anchor form a segment of at most 2 * length - gram bytes. Groups of documents ask
   which anchors stand elsewhere; what stands at an anchor of its own cannot repeat.
2. All other segments, aligned at their anchors, are the collection of documents of the column-wise construction; one that
   stands several times in a group comes twice. Per bucket of anchors, each round inserts the next column's symbol of every
   segment. In the order of the suffixes so far these symbols are the collection's Burrows-Wheeler transform; its LF mapping,
   a stable sort by anchor and symbol, is the next order, and the common prefixes follow from range minima over the last
   ones. A window repeats if a neighbour in its column shares `length` bytes with it. Rounds are bounded by the segments'
   length, and a bucket by the share of the text dealt to it, so order, transform and prefixes stay in the task's memory: the
   sequential files of the external algorithm, which hold them between rounds, are not needed.
3. An anchor with more than `hot` segments would be one large group. Its segments, and what of them differs its windows, are
   told apart by 128 bits of hash and dealt by them: only equal ones meet, once per group of documents.
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
KEY = np.dtype([("anchor", "<u8"), ("segment", "<u8")])
WINDOW = np.dtype([("anchor", "<u8"), ("window", "<u8")])
HEAD = np.dtype([("anchor", "<u8"), ("left", "<i4"), ("starts", "<i4")])
#: Answers to a segment: it takes part in the construction; its anchor is large and it stands elsewhere unchanged; its anchor is
#: large and its windows are asked for; its anchor is large.
SEND, FLAG, HOT, LARGE = 1, 2, 4, 8


class Group:
    """The segments of one group of documents."""

    def __init__(self, docs: pa.Table, length: int, gram: int):
        self.docs = X.in_order(docs)
        self.data, self.offs = A.text_bytes(self.docs.column("text"))
        n = len(self.data)
        self.length = length
        spans = np.diff(self.offs)
        valid = np.zeros(n + 1, np.int64)
        np.add.at(valid, self.offs[:-1][spans >= length], 1)
        np.add.at(valid, (self.offs[1:] - length + 1)[spans >= length], -1)
        starts = np.flatnonzero(np.cumsum(valid[:n]) > 0)  # window starts that stay within a document
        self.prefix = A.byte_prefix(self.data)
        if len(starts):
            every = np.arange(n - gram + 1)
            grams = A.span_hash(self.prefix, every, every + gram)
            bits = U64(32)  # a fixed width: equal windows choose alike in groups of any size, equal hashes by their order
            low = (U64(1) << bits) - U64(1)
            least = A.sliding_min((grams & ~low) | every.astype(U64), length - gram + 1)
            anchor = (least[starts] & low).astype(np.int64)
            head = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)])
            first = np.flatnonzero(head)
            self.at, self.begin = anchor[first], starts[first]  # anchor and first window start of each segment
            self.count = np.diff(np.concatenate([first, [len(starts)]]))
            key = np.empty(len(first), KEY)
            key["anchor"] = A.mix(grams[self.at] ^ A.GRAM)  # smallest hashes are dense at the low end; mixed again they fill all buckets alike
            key["segment"] = A.mix(A.span_hash(self.prefix, self.begin, self.begin + self.count - 1 + length) + (self.at - self.begin).astype(U64))
        else:
            self.at = self.begin = self.count = np.zeros(0, np.int64)
            key = np.empty(0, KEY)
        order = np.lexsort((key["segment"], key["anchor"]))
        s = key[order]
        head = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
        self.keys = s[head]  # distinct segments, sorted
        self.sample = order[head]  # one occurrence of each
        self.entry = np.empty(len(s), np.int64)  # each occurrence's distinct segment
        self.entry[order] = np.cumsum(head) - 1
        self.times = np.bincount(self.entry, minlength=len(self.keys))

    def codes(self, answered: pa.Table) -> np.ndarray:
        return np.frombuffer(X.answers(answered, 0), np.uint8)

    def sent(self, codes: np.ndarray) -> np.ndarray:
        """Distinct segments that take part in the construction, those that stand here several times twice."""
        take = ((codes & SEND) > 0) | ((codes == 0) & (self.times > 1)) if len(codes) else np.zeros(0, bool)
        chosen = np.flatnonzero(take)
        return np.repeat(chosen, 1 + (self.times[chosen] > 1))

    def window_starts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every window start of these occurrences of segments, and the row of `which` it belongs to."""
        count = self.count[which]
        owner = np.repeat(np.arange(len(which)), count)
        return self.begin[which][owner] + np.arange(int(count.sum())) - (np.cumsum(count) - count)[owner], owner

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of the segments keys[chosen]: starts, each one's distinct window, the distinct windows in order of their hash,
        and how often each stands in the segments."""
        starts, owner = self.window_starts(self.sample[chosen])
        found = np.empty(len(starts), WINDOW)
        found["anchor"] = self.keys["anchor"][chosen][owner]
        found["window"] = A.mix(A.span_hash(self.prefix, starts, starts + self.length) ^ A.GRAM)
        order = np.lexsort((found["anchor"], found["window"]))
        s = found[order]
        head = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
        entry = np.empty(len(s), np.int64)
        entry[order] = np.cumsum(head) - 1
        return starts, entry, s[head], np.bincount(entry, minlength=int(head.sum()))

    def blob(self, chosen: np.ndarray):
        """Renders the segments keys[chosen][slice]: count, heads, then their bytes."""

        def render(part: slice) -> bytes:
            which = self.sample[chosen[part]]
            heads = np.empty(len(which), HEAD)
            heads["anchor"] = self.keys["anchor"][chosen[part]]
            heads["left"], heads["starts"] = self.at[which] - self.begin[which], self.count[which]
            raw = self.data
            body = b"".join(raw[b : b + c - 1 + self.length].tobytes() for b, c in zip(self.begin[which].tolist(), self.count[which].tolist(), strict=True))
            return np.int64(len(which)).tobytes() + heads.tobytes() + body

        return render


def range_min(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(x[a:b]) for each pair a < b."""
    span = b - a
    if not len(span):
        return span
    out = x[a].copy()
    widest = int(span.max())
    if widest <= 12:
        for t in range(1, widest):
            longer = span > t
            out[longer] = np.minimum(out[longer], x[a[longer] + t])
        return out
    level, step = x, 1
    while step < widest + 1:
        use = (span >= step) & (span < 2 * step)
        if use.any():
            out[use] = np.minimum(level[a[use]], level[b[use] - step])
        level = np.minimum(level[: len(level) - step], level[step:]) if len(level) > step else level
        step *= 2
    return out


def repeated_columns(heads: np.ndarray, body: np.ndarray, length: int) -> np.ndarray:
    """For segments aligned at their anchors: flag of every window start (segment by segment) whose `length` bytes stand
    in another segment of the same anchor at the same offset.

    Rounds go from the rightmost column to the left. `order` holds the active segments sorted by (anchor, suffix from this
    column on), `common` the bytes each shares with the one before it, and `transform` the symbols that the next round puts
    before the suffixes, in their order.
    """
    n = len(heads)
    sizes = heads["starts"].astype(np.int64) - 1 + length
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    left = heads["left"].astype(np.int64)
    end = sizes - left  # first column after the segment
    group = np.unique(heads["anchor"], return_inverse=True)[1].astype(np.int64)
    flags_at = np.concatenate([[0], np.cumsum(heads["starts"].astype(np.int64))])
    flags = np.zeros(int(flags_at[-1]), bool)
    enters = np.argsort(-end, kind="stable")
    entering, begun = end[enters], 0
    order = np.zeros(0, np.int64)
    common = np.zeros(0, np.int64)
    for column in range(int(end.max()) - 1, -int(left.max()) - 1, -1):
        upto = int(np.searchsorted(-entering, -(column + 1), "right"))
        if upto > begun:  # segments that end here start with an empty suffix, before all others of their anchor
            new = enters[begun:upto]
            begun = upto
            merged = np.concatenate([new, order])
            place = np.argsort(group[merged], kind="stable")
            common = np.concatenate([np.zeros(len(new), np.int64), common])[place]
            order = merged[place]
            fresh = np.concatenate([np.ones(len(new), bool), np.zeros(len(order) - len(new), bool)])[place]
            common[fresh] = 0
            after = np.flatnonzero(fresh[:-1] & ~fresh[1:]) + 1
            common[after] = 0
        stay = left[order] + column >= 0
        if not stay.all():  # segments that began to the right of this column leave; prefixes shorten to the minimum passed
            keep = np.flatnonzero(stay)
            if len(keep):
                before = np.concatenate([[-1], keep[:-1]])
                common = range_min(common, before + 1, keep + 1)
            else:
                common = common[:0]
            order = order[keep]
        if not len(order):
            continue
        g = group[order]
        transform = body[base[order] + left[order] + column].astype(np.int64)
        key = g * 256 + transform
        place = np.argsort(key, kind="stable")  # the LF mapping, by anchor
        key = key[place]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        rows = np.flatnonzero(same)
        fresh_common = np.zeros(len(order), np.int64)
        fresh_common[rows] = np.minimum(range_min(common, place[rows - 1] + 1, place[rows] + 1) + 1, length)
        order, common = order[place], fresh_common
        hit = common >= length
        if hit.any():
            both = hit.copy()
            both[:-1] |= hit[1:]
            flags[flags_at[order[both]] + left[order[both]] + column] = True
    return flags


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 32, carry: tuple[str, ...] = (), hot: int = 4096) -> DataFrame:
    """Rows (doc_id, carried columns, kept binary, n_bytes, n_removed, n_spans), one per row of `docs`.

    A byte goes if a `length`-byte string that covers it also starts anywhere else, in the same document or another;
    strings are judged on the input. Null texts are empty; shorter texts lose nothing; repeated rows repeat each other, so
    all of their strings go; an empty table gives no rows. What stands at an anchor of more than `hot` segments is told apart
    by 128 bits of hash; all else is compared byte by byte.
    """
    grouped, size = X.grouped_text(docs, id_col, text_col, carry)
    buckets = X.buckets_for(size)

    @tidied_group
    def first(rows: pa.Table) -> pa.Table:
        g = Group(rows, length, gram)
        return X.ask(rows.column("g")[0].as_py(), g.keys, g.keys["anchor"], buckets)

    @tidied_pair
    def compare_keys(key: tuple, rows: pa.Table) -> pa.Table:
        payloads = rows.column("payload").to_pylist()
        e = np.frombuffer(b"".join(payloads), KEY)
        sizes = [len(p) // KEY.itemsize for p in payloads]
        order = np.lexsort((np.repeat(rows.column("g").to_numpy(), sizes), e["segment"], e["anchor"]))
        s = e[order]
        new_anchor = np.concatenate([[True], s["anchor"][1:] != s["anchor"][:-1]])
        new_segment = new_anchor | np.concatenate([[True], s["segment"][1:] != s["segment"][:-1]])
        anchor, segment = np.cumsum(new_anchor) - 1, np.cumsum(new_segment) - 1
        stands, kinds = np.bincount(anchor)[anchor], np.bincount(anchor[new_segment])[anchor]  # segments of each anchor, and distinct ones
        large = np.where(new_segment & (kinds > 1), HOT, LARGE) | np.where(np.bincount(segment)[segment] > 1, FLAG, 0)
        code = np.where(stands > hot, large, np.where(stands > 1, SEND, 0))
        out = np.empty(len(e), np.uint8)
        out[order] = code
        return X.answer_rows(0, key[0].as_py(), rows.column("g").to_pylist(), [out[x].tobytes() for x in X.split_lengths(sizes)])

    @tidied_pair
    def second(rows: pa.Table, answered: pa.Table) -> pa.Table:
        g = Group(rows, length, gram)
        codes, group = g.codes(answered), rows.column("g")[0].as_py()
        chosen = g.sent(codes)
        sent = X.ask(group, chosen, g.keys["anchor"][chosen], buckets, g.blob(chosen))
        distinct = g.windows(np.flatnonzero(codes & HOT))[2]
        asked = X.ask(group, distinct, distinct["window"], buckets)
        moved = pa.array(asked.column("bucket").to_numpy() + buckets, pa.int32())  # buckets of windows follow those of segments
        return pa.concat_tables([sent, asked.set_column(0, "bucket", moved)])

    def compare_windows(bucket: int, rows: pa.Table) -> pa.Table:
        payloads = rows.column("payload").to_pylist()
        e = np.frombuffer(b"".join(payloads), WINDOW)
        order = np.lexsort((e["anchor"], e["window"]))
        s = e[order]
        window = np.cumsum(np.concatenate([[True], s[1:] != s[:-1]])) - 1
        out = np.empty(len(e), np.uint8)
        out[order] = np.bincount(window)[window] > 1
        return X.answer_rows(2, bucket, rows.column("g").to_pylist(), [out[x].tobytes() for x in X.split_lengths([len(p) // WINDOW.itemsize for p in payloads])])

    @tidied_pair
    def columns(key: tuple, rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= buckets:
            return compare_windows(key[0].as_py(), rows)
        heads, bodies, counts = [], [], []
        for p in rows.column("payload").to_pylist():
            n = int(np.frombuffer(p, np.int64, 1)[0])
            heads.append(np.frombuffer(p, HEAD, n, 8))
            bodies.append(np.frombuffer(p, np.uint8, -1, 8 + n * HEAD.itemsize))
            counts.append(int(heads[-1]["starts"].sum()))
        flags = repeated_columns(np.concatenate(heads), np.concatenate(bodies), length)
        return X.answer_rows(1, key[0].as_py(), rows.column("g").to_pylist(), [np.packbits(flags[x]).tobytes() for x in X.split_lengths(counts)])

    @tidied_pair
    def finish(rows: pa.Table, answered: pa.Table) -> pa.Table:
        g = Group(rows, length, gram)
        codes = g.codes(answered)
        n = len(g.data)
        starts = np.zeros(n, bool)
        # of large anchors: whole segments that stand elsewhere unchanged, in this group or another
        large = (codes & (HOT | LARGE)) > 0
        whole = ((codes & FLAG) > 0) | (large & (g.times > 1)) if len(codes) else np.zeros(0, bool)
        chosen = g.sent(codes)
        where = X.bucket_of(g.keys["anchor"][chosen], buckets)
        replies = {b: a for lv, b, a in zip(answered.column("level").to_pylist(), answered.column("bucket").to_pylist(), answered.column("answer").to_pylist(), strict=True) if lv == 1}
        for b in np.unique(where).tolist():
            keys = chosen[where == b]
            which = g.sample[keys]
            count = g.count[which]
            yes = np.unpackbits(np.frombuffer(replies[b], np.uint8))[: int(count.sum())].astype(bool)
            at = np.repeat(g.begin[which] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
            starts[at[yes]] = True
            # a segment of repeats throughout has them wherever it stands
            full = np.bincount(np.repeat(np.arange(len(keys)), count), yes, len(keys)) == count
            whole[keys[full]] = True
        all_starts = np.repeat(g.begin - np.concatenate([[0], np.cumsum(g.count)[:-1]]), g.count) + np.arange(int(g.count.sum())) if len(g.begin) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(g.begin)), g.count)
        starts[all_starts[whole[g.entry[owner]]]] = True
        at, entry, distinct, times = g.windows(np.flatnonzero(codes & HOT))
        elsewhere = np.frombuffer(X.answers(answered, 2), np.uint8).astype(bool)
        starts[at[((times > 1) | elsewhere)[entry]]] = True
        gone = A.cover(starts, length, n)
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = g.offs[:-1][g.offs[:-1] < g.offs[1:]]
        begins[heads] = gone[heads]
        removed = A.count_between(gone, g.offs)
        kept = g.data[~gone]
        kept_offs = g.offs - np.concatenate([[0], np.cumsum(removed)])
        raw = kept.tobytes()
        texts = [raw[a:b] for a, b in zip(kept_offs[:-1].tolist(), kept_offs[1:].tolist(), strict=True)]
        out = {"doc_id": g.docs.column("doc_id")} | {c: g.docs.column(c) for c in carry}
        out |= {"kept": pa.array(texts, pa.binary()), "n_bytes": pa.array(np.diff(g.offs)), "n_removed": pa.array(removed), "n_spans": pa.array(A.count_between(begins, g.offs))}
        return pa.table(out)

    known = grouped.groupBy("g").applyInArrow(first, X.ASKED).groupBy("bucket").applyInArrow(compare_keys, X.ANSWERED)
    sent = grouped.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(second, X.ASKED)
    answered = known.unionByName(sent.groupBy("bucket").applyInArrow(columns, X.ANSWERED))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id long, " + "".join(f"`{c}` {kinds[c]}, " for c in carry) + "kept binary, n_bytes long, n_removed long, n_spans long"
    return grouped.groupBy("g").cogroup(answered.groupBy("g")).applyInArrow(finish, schema)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
