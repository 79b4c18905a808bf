"""Audit of how the sources of a language diverge in their terms, as an Arrow compute pipeline.

Texts are lower-cased, split, dictionary-encoded and counted by Arrow's hash group_by inside mapInArrow; a task sends one row per
(lang, source, term) of its own rows. Those rows are dealt by (lang, term) into shards, merged there by the same group_by, and
only terms of enough documents are written. The written cells, dealt again by (lang, hash of the term), give each shard a
count matrix of some terms and all sources of one language; its sums of integer divergences add up over the shards.

No shard holds more than a bounded share of the terms, a very common term has one row per task and source, and a source with
a third of all documents is one column like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm.frames import Scratch, table, text_size, written
from lociframe.llm.workers import tidied

#: Fixed value: what stands between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Bytes of text that are split at once, and rows of counts that are merged at once.
SLICE_BYTES, MERGE_ROWS = 2 << 20, 200_000
#: Left-hand sources of a shard's task.
BLOCK = 128
CELLS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """Rows (lang, source, term, n, docs) of some documents."""
    parts = pc.split_pattern_regex(pc.ascii_lower(text), BETWEEN)
    row, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    solid = pc.not_equal(term, "")
    coded = term.filter(solid).dictionary_encode()
    once = pa.table({"row": row.filter(solid), "term": coded.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    at = once.column("row")
    keyed = pa.table({"lang": langs.indices.take(at), "source": sources.indices.take(at), "term": once.column("term"), "n": once.column("count_all")})
    found = keyed.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    words = [d.dictionary.take(found.column(c)) for d, c in ((langs, "lang"), (sources, "source"), (coded, "term"))]
    return pa.table([*words, found.column("n_sum"), found.column("count_all").cast(pa.int64())], schema=CELLS)


def merged(tables: list[pa.Table]) -> pa.Table:
    """Rows of equal (lang, source, term) in one."""
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([found.column(c) for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=CELLS)


def text_runs(text: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of about SLICE_BYTES; a longer text is a run of its own."""
    total = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    a, n = 0, len(text)
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, total[a] + SLICE_BYTES, "right")) - 1)
        yield a, b - a
        a = b


@tidied
def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches (lang, source, text) without nulls -> CELLS, merged within the task as far as MERGE_ROWS allow."""
    held: list[pa.Table] = []
    for batch in batches:
        for at, n in text_runs(batch.column(2)):
            held.append(count_terms(*(batch.column(c).slice(at, n) for c in range(3))))
            if len(held) > 1 and sum(t.num_rows for t in held) > MERGE_ROWS:
                held = [merged(held)]
                if held[0].num_rows > MERGE_ROWS // 2:
                    yield from held.pop().to_batches()
    if held:
        yield from merged(held).to_batches()


def kept_cells(min_docs: int):
    """A function for mapInArrow over all CELLS rows of some (lang, term): the terms of `min_docs` documents or more, with `total`,
    their count in the language, and `head`, true in one row of each."""

    @tidied
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]).cast(CELLS))
            if sum(t.num_rows for t in held) > MERGE_ROWS and sum(t.num_rows for t in held[1:]) > held[0].num_rows:
                held = [merged(held)]
        if not held:
            return
        cells = merged(held)
        lang, term = (cells.column(c).combine_chunks().dictionary_encode() for c in ("lang", "term"))
        code = lang.indices.to_numpy().astype(np.int64) * len(term.dictionary) + term.indices.to_numpy()
        _, first, which = np.unique(code, return_index=True, return_inverse=True)
        sums = {}
        for c in ("n", "docs"):
            sums[c] = np.zeros(len(first), np.int64)
            np.add.at(sums[c], which, cells.column(c).to_numpy())
        head = np.zeros(len(code), bool)
        head[first] = True
        out = cells.drop_columns("docs").append_column("total", pa.array(sums["n"][which])).append_column("head", pa.array(head))
        yield from out.filter(pa.array(sums["docs"][which] >= min_docs)).to_batches(max_chunksize=50_000)

    return merge


def probability(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (n + 2v)) in whole numbers, three digits at a time: nothing overflows below 9e15 terms."""
    size = n + 2 * v
    rest, out = count + 2, np.zeros(np.broadcast(count, n).shape, np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // size
        rest = rest % size
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def shard_sums(top: int):
    """A function for cogroups (cells, sources) of one lang, shard and block: partial results (lang, source, part, item, value)."""

    def sums(key: tuple, cells: pa.Table, sources: pa.Table) -> pa.Table:
        sources = sources.sort_by("source")
        names, n, own = sources.column("source").to_pylist(), sources.column("n").to_numpy(), sources.column("own").to_numpy(zero_copy_only=False)
        lang, v, whole = key[0].as_py(), int(sources.column("v")[0].as_py()), int(n.sum())
        coded = cells.column("term").combine_chunks().dictionary_encode()
        place = pc.sort_indices(coded.dictionary).to_numpy()  # by UTF-8
        rank = np.empty(len(place), np.int64)
        rank[place] = np.arange(len(place))
        terms = coded.dictionary.take(pa.array(place))
        row, n_terms = rank[coded.indices.to_numpy()], len(terms)
        order = np.argsort(row, kind="stable")
        row, count, total = row[order], cells.column("n").to_numpy()[order], cells.column("total").to_numpy()[order]
        col = pc.index_in(cells.column("source").combine_chunks(), sources.column("source").combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)[order]
        left = np.flatnonzero(own)
        pair = np.zeros((len(left), len(names)), np.int64)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in left]
        step = max(1, (1 << 20) // max(1, len(names)))
        for a in range(0, n_terms, step):
            lo, hi = np.searchsorted(row, [a, a + step])
            m = min(step, n_terms - a)
            dense, in_lang = np.zeros((m, len(names)), np.int64), np.zeros(m, np.int64)
            dense[row[lo:hi] - a, col[lo:hi]] = count[lo:hi]
            in_lang[row[lo:hi] - a] = total[lo:hi]
            p, q = probability(dense, n[None, :], v), probability(in_lang, np.int64(whole), v)
            for i, s in enumerate(left.tolist()):
                pair[i] += divergence(p[:, s : s + 1], p).sum(0)
                up = np.flatnonzero((dense[:, s] > 0) & (p[:, s] > q))
                f = np.concatenate([best[i][0], divergence(p[up, s], q[up])])
                where = np.concatenate([best[i][1], up + a])
                first = np.argsort(-f, kind="stable")[:top]  # earlier terms are smaller
                best[i] = f[first], where[first]
        out: dict[str, list] = {"source": [], "part": [], "item": [], "value": []}
        for i, s in enumerate(left.tolist()):
            others = [j for j in range(len(names)) if j != s]
            f, where = best[i]
            out["source"] += [names[s]] * (len(others) + len(f))
            out["part"] += ["pair"] * len(others) + ["term"] * len(f)
            out["item"] += [names[j] for j in others] + terms.take(pa.array(where)).to_pylist()
            out["value"] += pair[i, others].tolist() + f.tolist()
        rows = len(out["part"])
        return pa.table({"lang": pa.array([lang] * rows, pa.string()), "source": pa.array(out["source"], pa.string()), "part": pa.array(out["part"], pa.string()), "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})

    return sums


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every (lang, source) of `docs`.

    Terms are the runs of ASCII letters and characters beyond ASCII, with A-Z lower-cased; a language keeps those in `min_docs` of
    its rows or more. With c a term's count, N the sum of counts and V the number of kept terms, p = 1 + floor(10^9 (c + 2) /
    (N + 2V)) and two such p diverge by floor((p - q)^2 / (p + q)). Part `pair`: the divergence from each other source of the
    language, summed over its kept terms. Part `term`: the source's kept terms that are more probable there than in the language,
    with their divergence, the first `top`. Ranks go by value descending, then item in UTF-8 order.

    Null texts, langs and sources are empty strings. A language without kept terms has pairs of value 0, a language of one source
    no pairs. Repeated rows count each; other columns are ignored; an empty table gives no rows. Values fit 64 bits below 9e15
    terms a language.
    """
    spark = docs.sparkSession
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    scratch = Scratch(spark)
    _, size = text_size(texts, "text")
    shards = max(96, size >> 25)
    partial = texts.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    cells = scratch.written(partial.repartition(shards, "lang", "term").mapInArrow(kept_cells(min_docs), "lang string, source string, term string, n long, total long, head boolean"), "cells")
    kept = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = cells.groupBy("lang").agg(F.sum(F.col("head").cast("long")).alias("v"))
    groups = texts.select("lang", "source").distinct().join(kept, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = scratch.written(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    widest = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("v").alias("v")).agg(F.max("s").alias("s"), F.max("v").alias("v")).first()
    s, v = widest["s"] or 1, widest["v"] or 0
    pieces, blocks = max(1, -(-v // int(np.clip(200_000_000 // s**2, 1024, 8_000)))), -(-s // BLOCK)
    dealt = cells.select("lang", "source", "term", "n", "total", F.pmod(F.xxhash64("term"), F.lit(pieces)).cast("int").alias("piece"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else dealt.withColumn("block", F.lit(0))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    told = groups.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("own", block == F.col("block"))
    keys = ("lang", "piece", "block")
    found = dealt.groupBy(*keys).cogroup(told.groupBy(*keys)).applyInArrow(shard_sums(top), "lang string, source string, part string, item string, value long")
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(place)).where((F.col("part") == "pair") | (F.col("rank") <= top))
    result = written(ranked.select("lang", "source", "part", "item", "value", "rank"), "divergence")
    scratch.remove()
    return result


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all `documents`: terms of 10 documents or more, first 10 terms of each source."""
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), w AS (
  SELECT id, lang, source, unnest(terms) AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM w GROUP BY 1, 2, 3
), k AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY 1, 2 HAVING sum(docs) >= 10
), v AS (
  SELECT lang, count(*) AS v, sum(total) AS whole FROM k GROUP BY 1
), g AS (
  SELECT d.lang, d.source, CAST(coalesce(any_value(s.n), 0) AS HUGEINT) AS size
  FROM d LEFT JOIN (SELECT c.lang, c.source, sum(c.n) AS n FROM c JOIN k ON c.lang = k.lang AND c.term = k.term GROUP BY 1, 2) s
    ON d.lang = s.lang AND d.source = s.source
  GROUP BY 1, 2
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 2)) // (g.size + 2 * v.v) AS p,
         1 + (1000000000 * (k.total + 2)) // (v.whole + 2 * v.v) AS q
  FROM g JOIN v ON g.lang = v.lang JOIN k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), parts AS (
  SELECT pairs.lang, pairs.source, 'pair' AS part, pairs.item, coalesce(sums.value, 0) AS value
  FROM pairs LEFT JOIN sums ON pairs.lang = sums.lang AND pairs.source = sums.source AND pairs.item = sums.item
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
