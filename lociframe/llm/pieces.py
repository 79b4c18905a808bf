"""SentencePiece encoding with N-best segmentations, and decoding.

A text is a lattice of pieces. Forward Viterbi scores give, for every position, the best score of what lies before it; a
backward A-star search from the end uses them as exact estimates, so it meets complete segmentations in order of score. No
piece of the model goes on past the start of a new word, so the search runs per distinct word, whose result is kept (within
a bound), and the same search over the words' alternatives gives the N best segmentations of the text.

Spaces are written as U+2581 with one in front of the text; characters without a piece become byte pieces at the smallest
score less 10, and so does a literal U+2581, which keeps decoding exact.
"""

from __future__ import annotations

import heapq
import itertools
import operator
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import table
from lociframe.llm.token_output import public_tokenizer
from lociframe.llm.wordtable import WordTable, distinct, runs, word_keys
from lociframe.llm.workers import keeping, tidy

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_score = operator.itemgetter(0)
NBEST = "array<struct<score: double, ids: binary>>"


class Model:
    """Pieces and scores of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                self.raw.append(bytes([int(text[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces[text] = (i, sp.get_score(i))
                self.raw.append(text.replace(SPACE, " ").encode())
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # every beginning of a piece; what is a piece itself has its score and ids
        self.prefixes: dict[str, tuple[float, tuple[int, ...] | None]] = {}
        self.pairs: set[str] = set()
        for text, (i, score) in self.pieces.items():
            self.pairs.update(map("".join, itertools.pairwise(text)))
            for k in range(1, len(text)):
                self.prefixes.setdefault(text[:k], (0.0, None))
            self.prefixes[text] = (score, (i,))
        # bytes side by side that may stand in one piece: all but two ASCII characters, neither a space, that do so in none
        self.joins = np.ones((256, 256), bool)
        ascii_ = [c for c in range(128) if c != 32]
        self.joins[np.ix_(ascii_, ascii_)] = [[chr(c) + chr(d) in self.pairs for d in ascii_] for c in ascii_]
        # pieces of each length: sorted hashes, ids and scores, for `forward`
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {len(t) for t in self.pieces}:
            some = [t for t in self.pieces if len(t) == size]
            h = prefix_hashes(code_points(some, size))[:, size]
            order = np.argsort(h)
            self.by_length[size] = (h[order], np.array([self.pieces[t][0] for t in some], np.int64)[order], np.array([self.pieces[t][1] for t in some])[order])
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        self.words = re.compile(f"^[^{SPACE}]+|{SPACE}+[^{SPACE}]*" if self.by_word else "(?s:.+)").findall


def code_points(words: list[str], size: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), size)


def prefix_hashes(cp: np.ndarray) -> np.ndarray:
    """(words, characters + 1): hash of each beginning, from which `forward` has the hash of any substring."""
    mixed = A.mix((cp.astype(A.U64) + A.U64(1)) * A.MULT)
    out = np.zeros((len(cp), cp.shape[1] + 1), A.U64)
    for j in range(cp.shape[1]):
        out[:, j + 1] = out[:, j] * A.MULT + mixed[:, j]
    return out


def forward(model: Model, words: list[str], n: int) -> tuple[np.ndarray, list[bytes]]:
    """Viterbi scores of words of one length, all at once: (scores of the n best segmentations, ids of the best).

    The same scores guide `n_best`, which then finds a word's other segmentations when a text needs them.
    """
    m, size = len(words), len(words[0])
    cp = code_points(words, size)
    prefix = prefix_hashes(cp)
    lift = [1]
    for _ in range(size):
        lift.append(lift[-1] * int(A.MULT) % (1 << 64))
    best = np.full((size + 1, m, n), -np.inf)
    best[0, :, 0] = 0
    back = np.zeros((size + 1, m), np.int64)
    via = np.zeros((size + 1, m), np.int64)
    for j in range(1, size + 1):
        cur = np.full((m, n), -np.inf)
        for i in range(max(0, j - model.longest), j):
            table = model.by_length.get(j - i)
            if table is None and j - i > 1:
                continue
            if table is not None:
                h = prefix[:, j] - prefix[:, i] * A.U64(lift[j - i])
                at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
                ok = table[0][at] == h
            if j - i == 1:  # a character without a piece is named by its negative code
                ids = -cp[:, i].astype(np.int64) - 1 if table is None else np.where(ok, table[1][at], -cp[:, i].astype(np.int64) - 1)
                scores = np.full(m, model.unknown) if table is None else np.where(ok, table[2][at], model.unknown)
                rows = np.arange(m)
            else:
                rows = np.flatnonzero(ok)
                if not len(rows):
                    continue
                ids, scores = table[1][at[rows]], table[2][at[rows]]
            x = best[i, rows] + scores[:, None]
            old = cur[rows]
            won = x[:, 0] > old[:, 0]
            back[j, rows[won]], via[j, rows[won]] = i, ids[won]
            cur[rows] = np.sort(np.concatenate([old, x], axis=1), axis=1)[:, : n - 1 : -1]
        best[j] = cur
    at, steps, all_rows, none = np.full(m, size), [], np.arange(m), np.iinfo(np.int64).min
    while at.any():
        steps.append(np.where(at > 0, via[at, all_rows], none))
        at = np.where(at > 0, back[at, all_rows], 0)
    path = np.array(steps[::-1]).T
    there = path != none
    flat, count = path[there], there.sum(1)
    unknown = flat < 0
    if unknown.any():
        codes, which = np.unique(-flat[unknown] - 1, return_inverse=True)
        spelled = [[model.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in codes.tolist()]
        width = np.ones(len(flat), np.int64)
        width[unknown] = np.array([len(x) for x in spelled])[which]
        ids = np.repeat(flat, width)
        start = np.cumsum(width) - width
        for k, x in enumerate(spelled):
            for d, b in enumerate(x):
                ids[start[unknown][which == k] + d] = b
        owner = np.repeat(np.arange(m), count)
        flat, count = ids, np.bincount(owner, width, m).astype(np.int64)
    raw = flat.astype(np.uint32).tobytes()
    ends = (4 * np.cumsum(count)).tolist()
    return best[size], [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def n_best(model: Model, text: str, n: int) -> list[tuple[float, bytes]]:
    """The n best segmentations of `text`, best first: (score, little-endian unsigned 32-bit ids). Fewer where fewer exist.

    Forward: best[k], and for each position the n best last pieces, for no completion needs more of them. Backward: A-star
    from the end; best[] is the exact score of the rest, so the first n arrivals at the start are the n best.
    """
    size, prefixes, unknown = len(text), model.prefixes, model.unknown
    enters: list[list[tuple[float, int, float, tuple[int, ...]]]] = [[] for _ in range(size + 1)]
    best = [0.0] * (size + 1)
    for i in range(size):
        if i:
            here = enters[i]
            if len(here) > 1:
                here.sort(key=_score, reverse=True)
                del here[n:]
            best[i] = here[0][0]
        at = best[i]
        first = text[i]
        hit = prefixes.get(first)
        if hit is None or hit[1] is None:
            enters[i + 1].append((at + unknown, i, unknown, tuple(model.byte_ids[b] for b in first.encode("utf-8", "surrogatepass"))))
        else:
            enters[i + 1].append((at + hit[0], i, hit[0], hit[1]))
        j = i + 2
        while hit is not None and j <= size:
            hit = prefixes.get(text[i:j])
            if hit is not None and hit[1] is not None:
                enters[j].append((at + hit[0], i, hit[0], hit[1]))
            j += 1
    here = enters[size]
    here.sort(key=_score, reverse=True)
    del here[n:]
    # (minus estimate, position, tie number, score of what lies behind, link): ties go to what is nearest the start
    agenda = [(-here[0][0], size, 0, 0.0, None)]
    found, number, pop, push = [], 0, heapq.heappop, heapq.heappush
    while agenda:
        _, at, _, behind, link = pop(agenda)
        if at == 0:
            ids: list[int] = []
            while link is not None:
                ids += link[0]
                link = link[1]
            found.append((behind, np.array(ids, np.uint32).tobytes()))
            if len(found) == n:
                break
            continue
        for total, i, score, piece in enters[at]:
            number += 1
            push(agenda, (-(total + behind), i, number, score + behind, (piece, link)))
        if len(agenda) > 64 * n:  # only the n best can matter
            agenda = heapq.nsmallest(n, agenda)
    return found


def combine(words: list[list[tuple[float, bytes]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best choices of one alternative per word, best first: (loss against the best, chosen alternatives)."""
    start = (0,) * len(words)
    out, agenda, seen = [], [(0.0, start)], {start}
    while agenda and len(out) < n:
        loss, choice = heapq.heappop(agenda)
        out.append((loss, choice))
        for d, k in enumerate(choice):
            if k + 1 < len(words[d]):
                nxt = choice[:d] + (k + 1,) + choice[d + 1 :]
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(agenda, (loss + words[d][k][0] - words[d][k + 1][0], nxt))
    return out


def joined(parts: list[list[tuple[float, bytes]]], n: int) -> list[tuple[float, bytes]]:
    """The n best segmentations of independent parts side by side."""
    if len(parts) == 1:
        return parts[0]
    base = sum(p[0][0] for p in parts)
    return [(base - loss, b"".join([p[k][1] for p, k in zip(parts, choice, strict=True)])) for loss, choice in combine(parts, n)]


class Segmenter:
    """N-best segmentations of texts; at most `BOUND` words (some 60 bytes each) and `PARTS` lists of alternatives are remembered."""

    BOUND = 400_000
    PARTS = 20_000

    def __init__(self, path: str, n: int):
        self.model, self.n = Model(path), n
        self.words = WordTable(self.BOUND, numbers=2)  # ids of the best; its score and the loss of the second best
        self.parts: dict[str, list[tuple[float, bytes]]] = {}
        self.literal = [(self.model.unknown, np.array([self.model.byte_ids[b] for b in SPACE.encode()], np.uint32).tobytes())]

    def word(self, text: str) -> list[tuple[float, bytes]]:
        """A word falls into parts where two characters stand side by side that do so in no piece."""
        if len(text) > 1 and not text[1:].isalpha():
            pairs, cuts = self.model.pairs, [0]
            for i in range(1, len(text)):
                if text[i - 1 : i + 1] not in pairs:
                    cuts.append(i)
            cuts.append(len(text))
            return joined([n_best(self.model, text[a:b], self.n) for a, b in itertools.pairwise(cuts)], self.n)
        return n_best(self.model, text, self.n)

    def looked_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of the best and loss of the second best, number of ids, ids of all) of words, by length, all at once."""
        numbers, sizes, found = np.zeros((len(texts), 2)), np.zeros(len(texts), np.int64), [b""] * len(texts)
        ask: dict[int, list[int]] = {}
        for i, t in enumerate(texts):
            ask.setdefault(len(t) if len(t) <= 48 else 0, []).append(i)
        for size, which in ask.items():
            for a in range(0, len(which), 8192):
                some = which[a : a + 8192]
                words = [texts[i] for i in some]
                if size:
                    scores, ids = forward(self.model, words, 2)
                    numbers[some, 0], numbers[some, 1] = scores[:, 0], scores[:, 0] - scores[:, 1]
                else:
                    longer = [n_best(self.model, w, 2) for w in words]
                    numbers[some] = [(w[0][0], w[0][0] - w[1][0] if len(w) > 1 else np.inf) for w in longer]
                    ids = [w[0][1] for w in longer]
                for i, got in zip(some, ids, strict=True):
                    found[i] = got
                sizes[some] = [len(x) // 4 for x in ids]
        return numbers, sizes, np.frombuffer(b"".join(found), np.uint32)

    def alternatives(self, text: str, score: float, best: bytes) -> list[tuple[float, bytes]]:
        """The n best of a word, its known best first whatever ties there are."""
        if text not in self.parts:
            if len(self.parts) >= self.PARTS:
                self.parts.clear()
            self.parts[text] = self.word(text)
        return [(score, best), *[x for x in self.parts[text] if x[1] != best][: self.n - 1]]

    def one(self, text: str) -> list[list[tuple[float, bytes]]]:
        """The words of a text with a literal U+2581, which becomes byte pieces."""
        out = []
        for k, piece in enumerate(text.split(SPACE)):
            out += [self.literal] * (k > 0)
            spaced = piece.replace(" ", SPACE)
            out += [self.word(w) for w in self.model.words(spaced if k else SPACE + spaced)]
        return out

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> list[list[tuple[float, bytes]]]:
        """The n best segmentations of each text, given as bytes and offsets.

        Words, cut where no piece goes on, are looked up once per distinct word and put together for all texts at once. A
        text's other segmentations differ from its best only in the n - 1 words that lose least.
        """
        raw, n = data.tobytes(), len(offs) - 1
        odd = np.full(n, not self.model.by_word)
        odd[np.searchsorted(offs, A.positions(raw, SPACE.encode()), "right") - 1] = True
        plain = np.flatnonzero(~odd & (np.diff(offs) > 0))
        gap = data == 32
        begin = gap.copy()
        begin[1:] &= ~gap[:-1]
        begin[1:] |= ~self.model.joins[data[:-1], data[1:]]
        begins = np.flatnonzero(begin)
        owner = np.searchsorted(offs, begins, "right") - 1
        ok = ~odd[owner] & (begins > offs[owner])
        begins, owner = begins[ok], owner[ok]
        starts = np.sort(np.concatenate([offs[:-1][plain], begins]))
        doc = np.sort(np.concatenate([plain, owner]))
        head = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
        ends = np.where(np.concatenate([head[1:], [True]]), offs[1:][doc], np.concatenate([starts[1:], [0]])) if len(doc) else starts
        names, short = word_keys(data, starts, ends, head.astype(np.uint8))
        longer: dict[tuple[bytes, bool], int] = {}  # named by their number in the batch
        for i in np.flatnonzero(~short).tolist():
            names[i] = longer.setdefault((raw[starts[i] : ends[i]], bool(head[i])), len(longer)), 255 << 56
        which, first, hashes = distinct(names)
        names, short = names[first], short[first]
        at = np.full(len(first), -1)
        at[short] = self.words.find(names[short], hashes[short])
        numbers, size, place = np.zeros((len(first), 2)), np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        there = at >= 0
        numbers[there], size[there], place[there] = self.words.numbers[at[there]], self.words.size[at[there]], self.words.start[at[there]]
        ask = np.flatnonzero(~there)

        def text(k: int) -> str:
            return (SPACE if head[k] else "") + raw[starts[k] : ends[k]].decode().replace(" ", SPACE)

        numbers[ask], size[ask], ids = self.looked_up([text(k) for k in first[ask].tolist()])
        place[ask] = len(self.words.pool) + np.cumsum(size[ask]) - size[ask]
        ids = np.concatenate([self.words.pool, ids])
        new = ask[short[ask]]
        self.words.add(names[new], hashes[new], size[new], ids[runs(place[new], size[new])], numbers[new])
        score, loss = numbers[which].T
        size, place = size[which], place[which]
        total = np.cumsum(size)
        body = ids[runs(place, size)].tobytes()
        scores = np.bincount(doc, score, n) if len(doc) else np.zeros(n)
        lengths = np.bincount(doc, size, n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)
        stop = np.cumsum(lengths)
        bounds = np.searchsorted(doc, np.arange(n + 1))
        out: list[list[tuple[float, bytes]]] = []
        for i in range(n):
            if odd[i]:
                out.append(joined(self.one(raw[offs[i] : offs[i + 1]].decode()), self.n) or [(0.0, b"")])
                continue
            a, b = int(bounds[i]), int(bounds[i + 1])
            base, here = float(scores[i]), body[4 * int(stop[i] - lengths[i]) : 4 * int(stop[i])]
            best = [(base, here)]
            if self.n > 1 and b > a:
                few = a + (np.argpartition(loss[a:b], self.n - 2)[: self.n - 1] if b - a > self.n - 1 else np.arange(b - a))
                few = np.sort(few).tolist()
                shift = int(total[a] - size[a])
                spots = [(4 * int(total[k] - size[k] - shift), 4 * int(total[k] - shift)) for k in few]
                words = [self.alternatives(text(k), float(score[k]), here[x:y]) for k, (x, y) in zip(few, spots, strict=True)]
                for less, choice in combine(words, self.n)[1:]:
                    parts, last = [], 0
                    for (x, y), w, c in zip(spots, words, choice, strict=True):
                        parts += [here[last:x], w[c][1]]
                        last = y
                    best.append((base - less, b"".join([*parts, here[last:]])))
            out.append(best)
        return out


def text_of(model: Model, ids: bytes) -> bytes:
    """The UTF-8 text of little-endian unsigned 32-bit ids, without the space that encoding put in front."""
    raw = b"".join(map(model.raw.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
    return raw[1:] if raw[:1] == b" " else raw


def sentencepiece_encode(docs: DataFrame, model: str, n: int = 2, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, carried columns, nbest, exact), one per row of `docs`: the n best segmentations of the text, best first,
    and whether decoding the best gives the text back.

    ids are little-endian unsigned 32-bit. Null and empty texts have one segmentation, of no pieces; ties of score come in
    a fixed order; repeated rows keep a row each; an empty table gives no rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    @keeping(("pieces", model, n), lambda: Segmenter(model, n))
    def run(segment: Segmenter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        struct = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.binary())]))
        for batch in batches:
            data, offs = A.text_bytes(batch.column(1))
            for a, b, some, at in A.pieces(data, offs, 1 << 20):
                part, raw = batch.slice(a, b - a), some.tobytes()
                found = segment(some, at)
                exact = [text_of(segment.model, best[0][1]) == raw[i:j] for best, (i, j) in zip(found, itertools.pairwise(at.tolist()), strict=True)]
                nbest = [[{"score": s, "ids": ids} for s, ids in best] for best in found]
                yield pa.RecordBatch.from_arrays([part.column(0), *(part.column(2 + k) for k in range(len(carry))), pa.array(nbest, struct), pa.array(exact)], names=["doc_id", *carry, "nbest", "exact"])
            tidy()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__text"), *(F.col(c) for c in carry))
    return picked.mapInArrow(run, "doc_id long, " + "".join(f"`{c}` {kinds[c]}, " for c in carry) + f"nbest {NBEST}, exact boolean")


def sentencepiece_decode(rows: DataFrame, model: str, ids_col: str = "ids", carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows (carried columns, decoded): the text of each row's ids (little-endian unsigned 32-bit); null ids give null.

    Bytes that are not UTF-8 become U+FFFD; one leading space, the one that encoding put there, is dropped.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    @keeping(("model", model), lambda: Model(model))
    def run(pieces: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                texts = [None if ids is None else text_of(pieces, ids).decode("utf-8", "replace") for ids in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(1 + k) for k in range(len(carry))), pa.array(texts, pa.string())], names=[*carry, "decoded"])

    return rows.select(F.col(ids_col).alias("__ids"), *(F.col(c) for c in carry)).mapInArrow(run, "".join(f"`{c}` {kinds[c]}, " for c in carry) + "decoded string")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces and scores of the two best segmentations, their digests, and whether decoding gives the text back."""
    encoded = sentencepiece_encode(table(spark, sf_dir, "documents"), public_tokenizer("piece_bpe_32k.model"), 2)
    best, other = F.get("nbest", F.lit(0)), F.get("nbest", F.lit(1))
    return encoded.select(
        "doc_id", (F.octet_length(best["ids"]) / 4).cast("long").alias("n_pieces"), best["score"].alias("score"), F.crc32(best["ids"]).alias("ids_crc32"), other["score"].alias("second_score"), F.crc32(other["ids"]).alias("second_crc32"), "exact"
    )
