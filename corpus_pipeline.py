"""Corpus pipeline: quality rules, near-duplicate removal, repeated passages, source mixing, segmentation.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
`documents`, whatever other columns their input has. Null texts count as empty; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm.frames import table, written
from lociframe.llm.mixing import mixed_documents
from lociframe.llm.pieces import sentencepiece_encode
from lociframe.llm.quality_classifier import trained
from lociframe.llm.quality_rules import quality_filter
from lociframe.llm.simhash import similar_groups
from lociframe.llm.substring_dedup import substring_dedup
from lociframe.llm.token_output import public_tokenizer

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
#: Near copies share 0.8 of their five-word shingles. 19.4 of 128 fingerprint bits differ there on average; pairs within NEAR_BITS are verified.
SHINGLE, SIMILARITY, NEAR_BITS = 5, 0.8, 36


def stage_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, those without words among them; repeated rows are judged alike."""
    return quality_filter(docs.select(*DOCUMENT), table(spark, sf_dir, "labels"))


def stage_simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of verified near copies stays, the one with the smallest id.

    Null texts, empty ones and those without words are copies of each other. Rows equal in id and text are one; rows without
    an id stay as they are.
    """
    groups = similar_groups(docs, SHINGLE, SIMILARITY, NEAR_BITS)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    # rows that agree in id and text are one, with the least of their other columns; dealt by id as the join has dealt them, so the
    # texts move once
    same = docs.withColumn("__digest", F.md5(F.encode("text", "UTF-8"))).join(first, "doc_id", "left_semi").groupBy("doc_id", "__digest")
    rest = [c for c in DOCUMENT if c not in ("doc_id", "text")]
    kept = same.agg(F.first("text").alias("text"), F.min(F.struct(*rest)).alias("__rest")).select("doc_id", "text", "__rest.*").select(*DOCUMENT)
    return kept.unionByName(docs.where("doc_id is null").select(*DOCUMENT))


def stage_substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand in a document with a smaller id go; a document left without words by that goes too.

    Texts keep their lines and spaces, and a document that loses nothing comes out byte for byte (a null text as null). Nulls
    and empty texts lose nothing and stay; repeated rows and rows with equal ids do not count against each other.
    """
    kept = substring_dedup(docs.withColumn("__null", F.col("text").isNull()), carry=("lang", "source", "n_chars", "__null"), joined=False).where("n_removed = 0 or n_words > n_removed")
    text = F.when(~F.col("__null"), F.col("kept_text"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length(text).cast("long")).alias("n_chars"))


def stage_mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per complete epoch of its source, and once more if the last, partial one holds it.

    Keys are scaled by the score of the quality model of the labelled documents. A null source is a source; texts without
    words go with every epoch; repeated rows share their fate.
    """
    used = docs.select(*DOCUMENT)
    return mixed_documents(used, trained(used, table(spark, sf_dir, "labels")))


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation, scores of the two best, and whether decoding gives the text back.

    One row per row, repeated ones too. Null and empty texts have no pieces, score 0 and no second score, and are exact.
    """
    model = public_tokenizer("piece_bpe_32k.model")
    encoded = sentencepiece_encode(docs, model, 2, carry=("lang", "source", "n_chars"))
    best, other = F.get("nbest", F.lit(0)), F.get("nbest", F.lit(1))
    return encoded.select("doc_id", "lang", "source", "n_chars", best["ids"].alias("ids"), (F.octet_length(best["ids"]) / 4).cast("long").alias("n_pieces"), best["score"].alias("score"), other["score"].alias("second_score"), "exact")


STAGES = [
    ("quality_rules", stage_quality_rules),
    ("simhash_near_dedup", stage_simhash_near_dedup),
    ("substring_dedup", stage_substring_dedup),
    ("mix_sources", stage_mix_sources),
    ("sentencepiece", stage_sentencepiece),
]
#: Trained trees, fingerprints and segmentations are not expressible in SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
