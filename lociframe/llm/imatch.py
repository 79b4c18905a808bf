"""Document fingerprints by I-Match, in DataFrame functions only.

Terms are runs of letters, digits and characters beyond ASCII, lower-cased and named by 64 bits. The lexicon keeps those whose
share of documents lies in a band of inverse document frequency. A document's distinct lexicon terms, sorted, are hashed over
several random subsets of the lexicon; two documents have a subset's hash in common if no term of the subset is in one of
them only. Subsets have rates 2^-s: a document of n terms uses the four scales s at which a subset has between n/4 and 4 terms
of it, 16 subsets each, so that half-changed texts still share hashes and unlike ones share none, at any length.

Document frequencies are counted over 2^22 classes of terms (22 bits of the term's hash). A class counts a document once, and
holds the rare terms of a corpus in equal shares, some 10^-5 of the documents, however large the corpus is. So the lexicon is
a bitmap of 512 KB at any size, and belonging to it is a look-up in a literal: no join, and nothing that grows is broadcast.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm.frames import Scratch, table, written

#: Fixed value: what stands between terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CLASS_BITS = 22
SCALES, SUBSETS = 4, 16
#: Rows of a tile of neighbouring documents, on average, and ranges of ids whose density is measured.
TILE_ROWS, RANGES = 1024, 64


def terms_of(text: Column) -> Column:
    """Distinct 64-bit names of a text's terms."""
    words = F.array_remove(F.split(F.lower(text), BETWEEN, -1), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def class_of(term: Column) -> Column:
    return F.shiftrightunsigned(term, 64 - CLASS_BITS)


def lexicon(docs: DataFrame, text_col: str, at_least: float, at_most: float) -> list[int]:
    """The lexicon's bitmap, 64 classes a word: those in `at_least` to `at_most` of the documents. At most 65,536 words are collected."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n = texts.count()
    counts = texts.select(F.explode(F.array_distinct(F.transform(terms_of(F.col("text")), class_of))).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    band = counts.where((F.col("n") >= at_least * n) & (F.col("n") <= at_most * n))
    words = band.groupBy(F.shiftright("c", 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(c & 63 AS int))")).alias("bits"))
    found = {r["word"]: r["bits"] for r in words.collect()}
    return [found.get(i, 0) for i in range(1 << (CLASS_BITS - 6))]


def in_scale(s: Column, i: Column, term: Column) -> Column:
    """The term is in subset i of scale s: at scales under 4, 2^s subsets each share a hash function; beyond, all 16 share one."""
    low = F.least(s, F.lit(4))
    name = F.when(s < 4, F.xxhash64(term.bitwiseXOR(F.expr("1L") + F.call_function("shiftright", i.cast("long"), low)))).otherwise(term)
    return name.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s) - 1) == i.cast("long").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), low) - 1)


def with_fingerprint(df: DataFrame, text_col: str, bits: list[int], out: str) -> DataFrame:
    """df with `out`: struct (scale int, hashes array<short>), 64 hashes of 15 bits; 0: no term of the document in the subset.

    A text without lexicon terms uses all its terms; one without terms is named by itself.
    """
    words = F.from_json(F.lit(json.dumps(bits)), "array<bigint>")
    listed = lambda h: F.getbit(F.get(words, F.shiftright(class_of(h), 6).cast("int")), class_of(h).bitwiseAND(F.lit(63)).cast("int")) == 1
    x = df.withColumn("__terms", terms_of(F.coalesce(F.col(text_col), F.lit(""))))
    x = x.withColumn("__band", F.filter("__terms", listed))
    alone = F.array(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    x = x.withColumn("__chosen", F.when(F.size("__band") > 0, F.col("__band")).when(F.size("__terms") > 0, F.col("__terms")).otherwise(alone)).drop("__terms", "__band")
    x = x.withColumn("__scale", F.greatest(F.lit(1), F.floor(F.log2(F.size("__chosen"))).cast("int") - 1))
    # of the terms, only those in a subset of the widest scale; the scales beyond are nested in it
    few = lambda terms, s: F.filter(terms, lambda h: h.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s) - 1) < SUBSETS)
    x = x.withColumn("__sorted", F.sort_array(F.when(F.col("__scale") < 4, F.col("__chosen")).otherwise(few(F.col("__chosen"), F.col("__scale"))))).drop("__chosen")
    numbers = F.sequence(F.lit(0), F.lit(SUBSETS - 1))

    def hashes(terms: Column, s: Column) -> Column:
        own = F.transform(numbers, lambda i: F.filter(terms, lambda h: in_scale(s, i, h)))
        return F.transform(own, lambda a: F.when(F.size(a) > 0, 1 + F.pmod(F.xxhash64(a), F.lit(32767))).otherwise(0).cast("short"))

    for k in range(SCALES):
        s = F.col("__scale") + k
        x = x.withColumn(f"__s{k}", F.when(s < 4, F.col("__sorted")).otherwise(few(F.col("__sorted"), s)))
    x = x.withColumn(out, F.struct(F.col("__scale").alias("scale"), F.concat(*(hashes(F.col(f"__s{k}"), F.col("__scale") + k) for k in range(SCALES))).alias("hashes")))
    return x.drop("__scale", "__sorted", *(f"__s{k}" for k in range(SCALES)))


def as_text(fingerprint: Column) -> Column:
    """The scale and the hashes in hexadecimal."""
    return F.concat(F.lpad(F.lower(F.hex(fingerprint["scale"])), 2, "0"), F.array_join(F.transform(fingerprint["hashes"], lambda h: F.lpad(F.lower(F.hex(h)), 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets of scales that both use, and of which either has a term, the share with equal hashes; 1 for equal
    fingerprints, 0 where no scale is common."""
    high, apart = F.greatest(a["scale"], b["scale"]), F.abs(a["scale"] - b["scale"])
    part = lambda f: F.slice(f["hashes"], SUBSETS * (high - f["scale"]) + 1, SUBSETS * (SCALES - apart))
    codes = F.zip_with(part(a), part(b), lambda p, q: F.when((p == 0) & (q == 0), 0).when(p == q, 65537).otherwise(1))
    both = F.aggregate(codes, F.lit(0), lambda total, c: total + c)
    share = F.shiftright(both, 16) / F.greatest(both.bitwiseAND(F.lit(65535)), F.lit(1))
    return F.when(a == b, 1.0).when(apart >= SCALES, 0.0).otherwise(share)


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 1e-4, at_most: float = 0.1) -> DataFrame:
    """Rows (doc_id, fingerprint string, signature struct), one per row of `docs`; `likeness` compares signatures.

    The lexicon's terms stand in `at_least` to `at_most` of the rows. A null text is empty; equal texts have equal fingerprints;
    repeated rows keep a row each; other columns are ignored; an empty table gives no rows.
    """
    bits = lexicon(docs, text_col, at_least, at_most)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return with_fingerprint(texts, "text", bits, "signature").select("doc_id", as_text(F.col("signature")).alias("fingerprint"), "signature")


def tile_of_id(docs: DataFrame, id_col: str) -> Column:
    """A number that does not fall as ids rise, with about TILE_ROWS rows each: the ids' RANGES quantile ranges, each cut evenly by
    its own density. Rows of one id share a tile; null ids have tile -1."""
    n = docs.count()
    bounds = sorted(set(docs.approxQuantile(id_col, [i / RANGES for i in range(RANGES + 1)], 0.002))) if n else []
    if len(bounds) < 2:
        return F.when(F.col(id_col).isNull(), F.lit(-1)).otherwise(0).cast("long")
    per = max(1, n // (len(bounds) - 1) // TILE_ROWS)

    def pick(lo: int, hi: int) -> Column:  # a tree of comparisons
        if hi - lo == 1:
            width = max(1.0, (bounds[hi] - bounds[lo]) / per)
            within = F.floor((F.col(id_col).cast("double") - F.lit(bounds[lo])) / F.lit(width)).cast("long")
            return F.lit(lo).cast("long") * F.lit(1 << 40) + F.least(F.greatest(within, F.lit(0).cast("long")), F.lit((1 << 40) - 1))
        mid = (lo + hi) // 2
        return F.when(F.col(id_col).cast("double") < F.lit(bounds[mid]), pick(lo, mid)).otherwise(pick(mid, hi))

    return F.when(F.col(id_col).isNull(), F.lit(-1).cast("long")).otherwise(pick(0, len(bounds) - 1))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 1e-4, at_most: float = 0.1) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one per row of `docs`.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all, of the next row's text;
    rows go by doc_id descending, nulls last, equal ids by their text's hash, and the first follows the last. Both texts have
    their I-Match fingerprint over the lexicon of all rows; `near_edited` and `near_next` are the likeness of a row's fingerprint to
    that of its edited text and to the next row's. Defined as in `document_fingerprints` otherwise.

    Texts are shuffled once, by tiles of neighbouring ids; a tile's first row is also sent to the tile that it follows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    bits = lexicon(docs, text_col, at_least, at_most)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.select(tile_of_id(texts.select("doc_id"), "doc_id").alias("tile"), "doc_id", F.xxhash64("text").alias("h"), "text")
    order = F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id", "h")
    firsts = texts.groupBy("tile").agg(F.max(order).alias("head"))
    # one row per tile
    everywhere = W.partitionBy(F.lit(0)).orderBy(F.desc("tile"))
    before = F.coalesce(F.lag("tile").over(everywhere), F.last("tile").over(everywhere.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    heads = scratch.written(firsts.select("head.doc_id", "head.h", before.alias("tile")), "heads")
    own = texts.select("tile", "doc_id", "h", "text", F.lit(True).alias("own"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
    lent = texts.drop("tile").join(heads.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "tile"), same).dropDuplicates(["tile"])
    both = with_fingerprint(own.unionByName(lent.select("tile", "doc_id", "h", "text", F.lit(False).alias("own"))), "text", bits, "f")
    after = W.partitionBy("tile").orderBy(F.desc("own"), F.desc_nulls_last("doc_id"), F.desc("h"))
    placed = both.select("own", "doc_id", "text", "f", F.lead("text").over(after).alias("t"), F.lead("f").over(after).alias("g")).where("own")
    n, half = F.char_length("text"), F.shiftright(F.char_length("text"), 1)
    edited = placed.select("doc_id", n.alias("n_chars"), "f", "g", F.concat(F.substring("text", F.lit(1), n - half), F.substring("t", F.lit(1), half)).alias("edited"))
    edited = with_fingerprint(edited, "edited", bits, "e")
    result = edited.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("g")).alias("near_next"),
    )
    result = written(result, "fingerprints")
    scratch.remove()
    return result


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all `documents` and of their edited texts, lexicon terms in 0.01 % to 10 % of the documents."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
