"""Genomic-shaped views of the driver tables, as frames and as DuckDB common table expressions of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_key(part: str) -> tuple:
    return F.concat(F.lit("chr"), (F.col(part) % 5 + 1).cast("string")).alias("chrom"), (F.col(part) * 37).alias("pos")


def genotypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chrom, pos, sample_id, dosage, dp, gq, n_ref, n_alt) from lineitem."""
    dosage = (F.col("l_linenumber") + F.round(F.col("l_discount") * 100).cast("int")) % 3
    g = table(spark, sf_dir, "lineitem").groupBy(*site_key("l_partkey"), F.concat(F.lit("S"), (F.col("l_suppkey") % 40).cast("string")).alias("sample_id")).agg(
        F.min(dosage).cast("int").alias("dosage"), F.sum(F.col("l_quantity").cast("long")).alias("dp"), F.max(F.round(F.col("l_tax") * 1000).cast("int")).alias("gq")
    )
    alt = F.when(F.col("dosage") == 0, 0).when(F.col("dosage") == 1, F.floor(F.col("dp") / 2)).otherwise(F.col("dp"))
    return g.withColumn("n_alt", alt.cast("long")).withColumn("n_ref", F.col("dp") - F.col("n_alt"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chrom, pos, ref, alt, qual, type) from part."""
    letters = F.array(*(F.lit(b) for b in "ACGT"))
    at = lambda e: F.get(letters, (e % 4).cast("int"))
    k = F.col("p_partkey")
    kind = F.when(F.col("p_size") % 10 < 7, "SNP").when(F.col("p_size") % 10 < 9, "INDEL").otherwise("REF")
    alt = F.when(kind == "REF", F.expr("cast(array() as array<string>)")).when(F.col("p_size") % 7 == 0, F.array(at(k + 1), at(k + 2))).otherwise(F.array(at(k + 1 + F.col("p_size") % 3)))
    return table(spark, sf_dir, "part").select(*site_key("p_partkey"), at(k).alias("ref"), alt.alias("alt"), F.round(F.col("p_retailprice") - 890, 2).alias("qual"), kind.alias("type"), F.col("p_size").alias("size"))


def popmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("S"), (F.col("s_suppkey") % 40).cast("string")).alias("sample_id")).agg(F.min("s_nationkey").alias("n"))
    return s.select("sample_id", F.concat(F.lit("P"), (F.col("n") % 4).cast("string")).alias("pop"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chrom, start, end, label, weight) from events."""
    start = F.unix_timestamp("ts") - 1704067200
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("chrom"), start.alias("start"), (start + 1 + F.floor(F.col("value") * 60)).alias("end"), F.concat(F.lit("L"), (F.col("user_id") % 4).cast("string")).alias("label"), (F.floor("value") + 1).alias("weight"))


def split_intervals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two interval sets: labels L0 and L1 against L2 and L3."""
    iv = intervals(spark, sf_dir)
    return iv.where("label in ('L0', 'L1')"), iv.where("label in ('L2', 'L3')")


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = intervals(spark, sf_dir).groupBy(F.col("chrom").alias("contig")).agg(F.max("end").alias("length"))
    # one row per contig
    return iv.withColumn("rank", F.expr("row_number() over (partition by 0 order by contig)"))


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    start = F.unix_timestamp("ts") - 1704067200
    bits = F.when(F.col("user_id") % 11 == 0, 1024).otherwise(0) + F.when(F.col("user_id") % 13 == 0, 256).otherwise(0) + F.when(F.col("user_id") % 2 == 0, 16).otherwise(0) + F.when(F.col("user_id") % 17 == 0, 12).otherwise(0)
    return e.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("qname"), bits.cast("int").alias("flag"), F.col("event_type").alias("chrom"), start.alias("start"), (start + 1 + F.floor("value")).alias("end"),
        (F.col("event_id") % 61).cast("int").alias("mapq"), F.floor("value").cast("long").alias("tlen"), (F.floor("value") + 1).alias("aligned"), F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("sample_id"),
        F.concat(F.lit("g"), (F.col("user_id") % 5).cast("string")).alias("rg"), (F.col("event_id") % 97).alias("qual_sum"),
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where("text is not null").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("contig"), F.col("text").alias("seq"), F.length("text").cast("long").alias("length"))


#: Letters as bases, by their place in the alphabet.
ALPHABET, AS_BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC"


def dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, seq): the documents' ASCII letters as bases, all else left out."""
    seq = F.translate(F.upper(F.regexp_replace("seq", "[^A-Za-z]", "")), ALPHABET, AS_BASES)
    return sequences(spark, sf_dir).select("contig", seq.alias("seq"))


def benchmark_dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, seq): the benchmark's letters as bases; items with an odd id are reverse complements."""
    rows = table(spark, sf_dir, "benchmark").where("text is not null")
    seq = F.translate(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), ALPHABET, AS_BASES)
    return rows.select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("contig"), F.when(F.col("item_id") % 2 == 1, F.reverse(F.translate(seq, "ACGT", "TGCA"))).otherwise(seq).alias("seq"))


def allele_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, pos, allele, fwd, rev, shifted) from lineitem: few reads a row, most of them of the position's own base, some
    alleles in lower case."""
    at = F.when(F.col("l_linenumber") <= 5, F.col("l_partkey") % 4).otherwise((F.col("l_linenumber") + F.col("l_suppkey")) % 5)
    allele = F.get(F.array(*(F.lit(a) for a in ("A", "C", "G", "T", "AT"))), at.cast("int"))
    allele = F.when(F.col("l_suppkey") % 7 == 0, F.lower(allele)).otherwise(allele)
    n = F.col("l_quantity").cast("long") % 4
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 4).cast("string")).alias("sample_id"), (F.col("l_partkey") % 500 + 1).alias("pos"), allele.alias("allele"), F.when(F.col("l_returnflag") == "N", n).otherwise(0).alias("fwd"), F.when(F.col("l_returnflag") == "N", 0).otherwise(n).alias("rev"), (F.col("l_linestatus") == "O").alias("shifted")
    )


SQL = {
    "g": """g AS (SELECT chrom, pos, sample_id, dosage, dp, gq, CASE dosage WHEN 0 THEN 0 WHEN 1 THEN dp // 2 ELSE dp END AS n_alt, dp - CASE dosage WHEN 0 THEN 0 WHEN 1 THEN dp // 2 ELSE dp END AS n_ref FROM (
      SELECT 'chr' || CAST(l_partkey % 5 + 1 AS VARCHAR) AS chrom, l_partkey * 37 AS pos, 'S' || CAST(l_suppkey % 40 AS VARCHAR) AS sample_id,
        min((l_linenumber + CAST(round(l_discount * 100) AS INT)) % 3) AS dosage, CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS dp, max(CAST(round(l_tax * 1000) AS INT)) AS gq
      FROM lineitem GROUP BY 1, 2, 3))""",
    "s": """s AS (SELECT 'chr' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS chrom, p_partkey * 37 AS pos, substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1) AS ref,
      CASE WHEN p_size % 10 >= 9 THEN CAST([] AS VARCHAR[]) WHEN p_size % 7 = 0 THEN [substr('ACGT', CAST((p_partkey + 1) % 4 AS INT) + 1, 1), substr('ACGT', CAST((p_partkey + 2) % 4 AS INT) + 1, 1)]
        ELSE [substr('ACGT', CAST((p_partkey + 1 + p_size % 3) % 4 AS INT) + 1, 1)] END AS alt,
      round(p_retailprice - 890, 2) AS qual, CASE WHEN p_size % 10 < 7 THEN 'SNP' WHEN p_size % 10 < 9 THEN 'INDEL' ELSE 'REF' END AS type, p_size AS size FROM part)""",
    "pop": """pop AS (SELECT sample_id, 'P' || CAST(n % 4 AS VARCHAR) AS pop FROM (SELECT 'S' || CAST(s_suppkey % 40 AS VARCHAR) AS sample_id, min(s_nationkey) AS n FROM supplier GROUP BY 1))""",
    "iv": """iv AS (SELECT event_type AS chrom, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS start, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + 1 + CAST(floor(value * 60) AS BIGINT) AS "end",
      'L' || CAST(user_id % 4 AS VARCHAR) AS label, CAST(floor(value) AS BIGINT) + 1 AS weight FROM events)""",
    "contigs": """contigs AS (SELECT contig, length, row_number() OVER (ORDER BY contig) AS rank FROM (SELECT chrom AS contig, max("end") AS length FROM iv GROUP BY 1))""",
    "aln": """aln AS (SELECT 'r' || CAST(event_id AS VARCHAR) AS qname,
      (CASE WHEN user_id % 11 = 0 THEN 1024 ELSE 0 END) + (CASE WHEN user_id % 13 = 0 THEN 256 ELSE 0 END) + (CASE WHEN user_id % 2 = 0 THEN 16 ELSE 0 END) + (CASE WHEN user_id % 17 = 0 THEN 12 ELSE 0 END) AS flag,
      event_type AS chrom, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 AS start, CAST(floor(epoch(ts)) AS BIGINT) - 1704067200 + 1 + CAST(floor(value) AS BIGINT) AS "end", CAST(event_id % 61 AS INT) AS mapq,
      CAST(floor(value) AS BIGINT) AS tlen, CAST(floor(value) AS BIGINT) + 1 AS aligned, 'S' || CAST(user_id % 10 AS VARCHAR) AS sample_id, 'g' || CAST(user_id % 5 AS VARCHAR) AS rg, event_id % 97 AS qual_sum FROM events)""",
    "seq": """seq AS (SELECT 'd' || CAST(doc_id AS VARCHAR) AS contig, text AS seq, CAST(length(text) AS BIGINT) AS length FROM documents WHERE text IS NOT NULL)""",
    "dna": """dna AS (SELECT contig, translate(upper(regexp_replace(seq, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM seq)""",
    "benchmark_dna": """benchmark_dna AS (SELECT 'b' || CAST(item_id AS VARCHAR) AS contig, CASE WHEN item_id % 2 = 1 THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS seq
      FROM (SELECT item_id, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS s FROM benchmark WHERE text IS NOT NULL))""",
    "reads_at": """reads_at AS (SELECT 'S' || CAST(l_suppkey % 4 AS VARCHAR) AS sample_id, l_partkey % 500 + 1 AS pos, CASE WHEN l_suppkey % 7 = 0 THEN lower(allele) ELSE allele END AS allele,
      CASE WHEN l_returnflag = 'N' THEN n ELSE 0 END AS fwd, CASE WHEN l_returnflag = 'N' THEN 0 ELSE n END AS rev, l_linestatus = 'O' AS shifted
      FROM (SELECT *, ['A', 'C', 'G', 'T', 'AT'][CAST(CASE WHEN l_linenumber <= 5 THEN l_partkey % 4 ELSE (l_linenumber + l_suppkey) % 5 END AS INT) + 1] AS allele, CAST(floor(l_quantity) AS BIGINT) % 4 AS n FROM lineitem))""",
}
NEEDS = {"contigs": ["iv"], "dna": ["seq"]}


def with_views(*names: str, body: str) -> str:
    """A query whose WITH clause defines the named views (and what they need) before its own."""
    order: list[str] = []
    for n in names:
        for x in [*NEEDS.get(n, []), n]:
            if x not in order:
                order.append(x)
    return "WITH " + ", ".join(SQL[n] for n in order) + (", " if body.lstrip().startswith("@") else " ") + body.lstrip().removeprefix("@")
