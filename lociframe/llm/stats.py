"""Statistics of whole texts, shared by the quality rules and the quality classifier (one pass, in Arrow batches)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.workers import tidied

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_upper", "n_digits", "n_marks", "n_stops", "n_short", "n_long", "n_wide", "n_pair_words", "n_distinct", "n_sentence_ends")
FIELDS = COUNTS + MORE

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?;:{}[]()=_~^@\\/\"")] = True
STOPS = np.zeros(256, bool)
STOPS[list(b".,")] = True


def repeated(key: np.ndarray) -> tuple[np.ndarray, int]:
    """(flag for each entry whose value occurs twice or more, number of distinct values)."""
    if not len(key):
        return np.zeros(0, bool), 0
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    flag = np.zeros(len(k), bool)
    flag[1:] |= same
    flag[:-1] |= same
    out = np.empty(len(k), bool)
    out[order] = flag
    return out, int(len(k) - same.sum())


def later(key: np.ndarray) -> np.ndarray:
    """Flag for each entry that equals an earlier one."""
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key), bool)
    k = key[order]
    out[order[1:]] = k[1:] == k[:-1]
    return out


def text_stats(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """One value of each of FIELDS per document."""
    n = len(offs) - 1
    w = A.Words(data, offs)
    prefix = A.byte_prefix(data)
    hashes = A.span_hash(prefix, w.start, w.end)
    seed = A.mix(np.arange(1, n + 1, dtype=A.U64) * A.MULT)
    lead = (data & 0xC0) != 0x80
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    length = chars[w.end] - chars[w.start]
    out = {"n_words": w.count, "word_chars": A.count_between(lead & w.solid, offs), "n_symbols": A.count_between(SYMBOLS[data], offs)}
    # lines with a word that equal an earlier line of the text
    cuts = np.flatnonzero(data == 10)
    cut_doc = np.searchsorted(offs, cuts, "right") - 1
    start = np.concatenate([offs[:-1], cuts + 1])
    end = np.concatenate([cuts, offs[1:]])
    start.sort()
    end.sort()
    line_doc = np.sort(np.concatenate([np.arange(n), cut_doc]))
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, line_doc = start[worded], end[worded], line_doc[worded]
    out["n_dup_lines"] = np.bincount(line_doc[later(A.span_hash(prefix, start, end) ^ seed[line_doc])], minlength=n)
    # words in 3-word windows that stand twice or more in the text
    grams = A.gram_hash(hashes, 3)
    inside = w.doc[2:] == w.doc[: len(grams)] if len(grams) else np.zeros(0, bool)
    flags = np.zeros(len(grams), bool)
    flags[inside] = repeated(grams[inside] ^ seed[w.doc[: len(grams)][inside]])[0]
    out["n_repeat_words"] = A.count_between(A.cover(flags, 3, len(hashes)), w.first)
    wide = data >= 0x80
    out |= {"n_chars": A.count_between(lead, offs), "n_lines": np.bincount(line_doc, minlength=n)}
    for name, flag in (("n_upper", UPPER), ("n_digits", DIGIT), ("n_marks", MARKS), ("n_stops", STOPS)):
        out[name] = A.count_between(flag[data], offs)
    out["n_wide"] = A.count_between(wide & lead, offs)
    out["n_short"] = A.count_between(length <= 3, w.first)
    out["n_long"] = A.count_between(length >= 12, w.first)
    out["n_pair_words"] = np.bincount(w.doc[1:][(hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])], minlength=n) if len(hashes) > 1 else np.zeros(n, np.int64)
    out["n_distinct"] = w.count - np.bincount(w.doc[later(hashes ^ seed[w.doc])], minlength=n) if len(hashes) else np.zeros(n, np.int64)
    out["n_sentence_ends"] = A.count_between(data[w.end - 1] == 46, w.first) if len(hashes) else np.zeros(n, np.int64)
    return out


def with_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Rows (doc_id, fields...), one per row of `docs`; a null text counts as empty, a null id stays null."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = A.text_bytes(batch.column(1))
            for a, b, part, at in A.pieces(data, offs):
                got = text_stats(part, at)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(got[f].astype(np.int64)) for f in fields)], names=["doc_id", *fields])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, " + ", ".join(f"{f} long" for f in fields))


def features(pdf) -> np.ndarray:
    """Model inputs of a table with FIELDS: ratios and logarithms, none of them of id, language, source or label."""
    v = {f: pdf[f].to_numpy(float) for f in FIELDS}
    words, chars, lines = np.maximum(v["n_words"], 1), np.maximum(v["n_chars"], 1), np.maximum(v["n_lines"], 1)
    return np.column_stack(
        [
            v["n_symbols"] / words,
            v["n_repeat_words"] / words,
            v["n_dup_lines"] / lines,
            v["n_upper"] / chars,
            v["n_marks"] / words,
            v["n_pair_words"] / words,
            np.log1p(v["n_words"]),
            v["word_chars"] / words,
            v["n_stops"] / words,
            v["n_digits"] / chars,
            v["n_short"] / words,
            v["n_long"] / words,
            v["n_wide"] / chars,
            v["n_distinct"] / words,
            v["n_sentence_ends"] / words,
            np.log1p(v["n_words"] / lines),
        ]
    )


#: Columns of `features` for which more can never make a document better: symbols, repeats, equal lines, capitals, marks.
WORSE = (0, 1, 2, 3, 4, 5)


def labelled_sample(labels: DataFrame, bound: int = 20_000) -> DataFrame:
    """Rows (doc_id, quality): at most about `bound` labelled ids whose crc32(doc_id as text) mod 3 is not 1.

    The bound is the only sample: beyond it a hash of the id keeps the fraction bound/rows. Null ids and labels are left
    out; a doc_id labelled twice counts once, with its largest label.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    good = good.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    n = good.count()
    return good if n <= bound else good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * bound / n))


def training_rows(stats: DataFrame, good: DataFrame):
    """A pandas table of FIELDS and `quality` for the documents of a labelled sample, in a fixed order."""
    return stats.join(good, "doc_id").select(*FIELDS, "quality", "doc_id").toPandas().sort_values(["doc_id", *FIELDS]).drop(columns="doc_id")
