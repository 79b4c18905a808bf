"""Queries over sequences, reads, genotypes, the mitochondrial consensus, populations and spectra."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators import duplicates as U
from lociframe.operators import filters as Q
from lociframe.operators import genotypes as G
from lociframe.operators import intervals as I
from lociframe.operators import ld as L
from lociframe.operators import kmers as N
from lociframe.operators import mito as M
from lociframe.operators import popgen as P
from lociframe.operators import reads as R
from lociframe.operators import saf as S
from lociframe.operators import sequence as K
from lociframe.operators import sfs as X
from lociframe.operators import trimming as T
from lociframe.operators.lineage import kept
from lociframe.plans import views as V
from lociframe.plans.core_queries import AB, merged_sql
from lociframe.plans.registry import query


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def islands_sql(src: str, name: str, gap: int = 0, extra: str = "") -> str:
    """Common table expressions that end in `name`: the intervals of `src` merged within `gap`, with extra aggregates."""
    return f"""{name}_m AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}),
{name}_n AS (SELECT *, sum(CASE WHEN reach IS NULL OR start - reach > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM {name}_m),
{name} AS (SELECT chrom, min(start) AS start, max("end") AS "end"{extra} FROM {name}_n GROUP BY chrom, island)"""


def kmers_sql(src: str, name: str, k: int) -> str:
    """(contig, p, kmer) of every window of k characters of `src` (contig, seq), upper-cased."""
    return f"{name}_p AS (SELECT contig, seq, unnest(range(0, length(seq) - {k} + 1)) AS p FROM {src} WHERE length(seq) >= {k}), {name} AS (SELECT contig, p, upper(substr(seq, p + 1, {k})) AS kmer FROM {name}_p)"


# sequences


def runs_sql(pattern: str, label: str) -> str:
    """Runs of one character class: positions by character, islands by row number."""
    return V.with_views("seq", body=f"""@c AS (SELECT contig, unnest(range(0, length)) AS p, seq FROM seq), h AS (SELECT contig, p, p - row_number() OVER (PARTITION BY contig ORDER BY p) AS k FROM c WHERE regexp_full_match(substr(seq, p + 1, 1), '{pattern}'))
SELECT contig AS chrom, min(p) AS start, max(p) + 1 AS "end", '{label}' AS label FROM h GROUP BY contig, k""")


@query(runs_sql("N", "NRef"))
def hard_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.hard_mask(V.sequences(spark, d))


@query(runs_sql("[a-z]", "SoftMaskRef"))
def soft_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.soft_mask(V.sequences(spark, d))


@query(V.with_views("iv", body="""SELECT chrom, start, "end", 'Excluded' AS label FROM iv WHERE weight > 400"""))
def exclude_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.exclude_mask(V.intervals(spark, d).where("weight > 400"))


@query(V.with_views("seq", body="@" + kmers_sql("seq", "k", 24) + """, o AS (SELECT kmer FROM k GROUP BY 1 HAVING 1 / count(*) < 0.5), h AS (SELECT contig, p, p - row_number() OVER (PARTITION BY contig ORDER BY p) AS run FROM k WHERE kmer IN (SELECT kmer FROM o))
SELECT contig AS chrom, min(p) AS start, max(p) + 1 AS "end" FROM h GROUP BY contig, run"""))
def kmer_mappability(spark: SparkSession, d: str) -> DataFrame:
    return N.kmer_mappability(V.sequences(spark, d), 24, 0.5)


@query(V.with_views("seq", body="@" + kmers_sql("seq", "k", 3) + """, c AS (SELECT contig, p // 64 AS w, kmer, count(*) AS n FROM k GROUP BY 1, 2, 3), t AS (SELECT contig, w, sum(lgamma(n + 1)) AS s, CAST(sum(n) AS DOUBLE) AS m FROM c GROUP BY 1, 2),
sc AS (SELECT t.contig AS chrom, w * 64 AS start, least((w + 1) * 64, length) AS "end" FROM t JOIN seq ON seq.contig = t.contig WHERE s - 64 * list_sum(list_transform(range(2, 61), lambda n: lgamma(n + 1) * exp(n * ln(m / 64) - m / 64 - lgamma(n + 1)))) > 0.25 * m), """ + islands_sql("sc", "mg") + " SELECT * FROM mg"))
def low_complexity_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.low_complexity_mask(V.sequences(spark, d), 3, 64, 0.25)


@query(V.with_views("seq", body="SELECT round(100.0 * sum(length(seq) - length(translate(seq, 'GCgc', ''))) / sum(length(seq) - length(translate(seq, 'ACGTacgt', ''))), 6) AS gc_percent FROM seq"))
def gc_percent(spark: SparkSession, d: str) -> DataFrame:
    return rounded(K.gc_percent(V.sequences(spark, d)), "gc_percent")


def hits_sql(a: str, b: str, k: int, min_len: int) -> str:
    """Maximal matches of k-mers between views a and b (contig, seq) on both strands of b, by islands on diagonals."""
    return f"""{b}_r AS (SELECT contig, length(seq) AS n, reverse(translate(upper(seq), 'ACGT', 'TGCA')) AS seq FROM {b}), """ + kmers_sql(a, "ka", k) + ", " + kmers_sql(b, "kb", k) + ", " + kmers_sql(f"{b}_r", "kr", k) + f""",
h AS (SELECT ka.contig AS a_contig, kb.contig AS b_contig, '+' AS strand, ka.p AS a, ka.p - kb.p AS diagonal FROM ka JOIN kb USING (kmer)
  UNION ALL SELECT ka.contig, kr.contig, '-', ka.p, ka.p + n - kr.p - {k} FROM ka JOIN kr USING (kmer) JOIN {b}_r r ON r.contig = kr.contig),
hr AS (SELECT *, a - row_number() OVER (PARTITION BY a_contig, b_contig, strand, diagonal ORDER BY a) AS run FROM h),
hits AS (SELECT a_contig, b_contig, min(a) AS start, max(a) + {k} AS "end", CASE strand WHEN '+' THEN min(a) - diagonal ELSE diagonal - max(a) END AS b_start, strand FROM hr GROUP BY a_contig, b_contig, strand, diagonal, run HAVING max(a) + {k} - min(a) >= {min_len})"""


@query(V.with_views("seq", body="@pg AS (SELECT 'p' || CAST(page_id AS VARCHAR) AS contig, html AS seq FROM pages WHERE html IS NOT NULL), " + hits_sql("seq", "pg", 40, 60) + " SELECT * FROM hits"))
def kmer_hits(spark: SparkSession, d: str) -> DataFrame:
    pages = V.table(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("contig"), F.col("html").alias("seq"))
    return N.kmer_hits(V.sequences(spark, d), pages.where("seq is not null"), 40, 60)


@query(V.with_views("dna", "benchmark_dna", body="@" + hits_sql("dna", "benchmark_dna", 24, 30) + " SELECT * FROM hits"))
def strand_hits(spark: SparkSession, d: str) -> DataFrame:
    """The documents' letters as bases against the benchmark's, every other item of which is its reverse complement."""
    return N.kmer_hits(V.dna(spark, d), V.benchmark_dna(spark, d), 24, 30)


@query(V.with_views("dna", "benchmark_dna", body="@" + hits_sql("dna", "benchmark_dna", 24, 60) + """, u AS (SELECT a_contig AS chrom, start, "end", strand FROM hits), """ + islands_sql("u", "mu", 200, """, string_agg(DISTINCT strand, ',' ORDER BY strand) AS strands""") + """ SELECT chrom, start, "end", strands, 'NUMT' AS label FROM mu"""))
def numt_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.numt_mask(N.kmer_hits(V.dna(spark, d), V.benchmark_dna(spark, d), 24, 60), 60, 200)


@query(V.with_views("dna", body="@" + kmers_sql("dna", "k", 21) + " SELECT n, count(*) AS kmers FROM (SELECT kmer, count(*) AS n FROM k GROUP BY 1) GROUP BY 1"))
def kmer_spectrum(spark: SparkSession, d: str) -> DataFrame:
    """How many k-mers of the documents' letters as bases stand how often."""
    return N.kmer_counts(V.dna(spark, d), 21).groupBy("n").agg(F.count(F.lit(1)).alias("kmers"))


@query(V.with_views("dna", body="@" + kmers_sql("dna", "k", 31) + """, o AS (SELECT kmer FROM k GROUP BY 1 HAVING 1 / count(*) < 0.4), h AS (SELECT contig, p, p - row_number() OVER (PARTITION BY contig ORDER BY p) AS run FROM k WHERE kmer IN (SELECT kmer FROM o))
SELECT contig AS chrom, min(p) AS start, max(p) + 1 AS "end" FROM h GROUP BY contig, run"""))
def kmer_mappability_bases(spark: SparkSession, d: str) -> DataFrame:
    return N.kmer_mappability(V.dna(spark, d), 31, 0.4)


@query(V.with_views("iv", body="@u AS (SELECT chrom, start, \"end\" FROM iv WHERE \"end\" - start >= 5000 AND chrom <> 'click'), " + merged_sql("u", 2000) + " SELECT * FROM merged"))
def cluster_hits(spark: SparkSession, d: str) -> DataFrame:
    hits = V.intervals(spark, d).withColumns({"q_start": F.col("weight"), "q_end": F.col("weight") + 5})
    return K.cluster_hits(hits, 5000, 2000, "click").select("chrom", "start", "end")


@query(V.with_views("iv", body="@" + merged_sql("iv").replace("max(\"end\") AS \"end\" FROM numbered", "max(\"end\") AS \"end\", string_agg(DISTINCT label, ',' ORDER BY label) AS label FROM numbered") + " SELECT * FROM merged"))
def merge_masks(spark: SparkSession, d: str) -> DataFrame:
    return K.merge_masks(*V.split_intervals(spark, d))


@query(V.with_views("contigs", body="SELECT CAST(sum(length) AS BIGINT) AS bases FROM contigs"))
def mask_summary_total(spark: SparkSession, d: str) -> DataFrame:
    """Bases of the classification, which covers the genome once."""
    a, b = V.split_intervals(spark, d)
    return K.summarise_masks(a, K.merge_masks(b), V.contigs(spark, d))[0].agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


@query(V.with_views("contigs", body="@" + AB + ", " + islands_sql("a", "ma") + ", " + islands_sql("b", "mb", 0, ", string_agg(DISTINCT label, ',' ORDER BY label) AS label") + """, ov AS (SELECT coalesce(sum(least(ma."end", mb."end") - greatest(ma.start, mb.start)), 0) AS n FROM ma JOIN mb ON ma.chrom = mb.chrom AND ma.start < mb."end" AND mb.start < ma."end"),
t AS (SELECT (SELECT sum("end" - start) FROM ma) AS a, (SELECT sum("end" - start) FROM mb) AS b, (SELECT sum(length) FROM contigs) AS g, ov.n FROM ov)
SELECT label, CAST(sum("end" - start) AS BIGINT) AS bases FROM mb GROUP BY 1 UNION ALL SELECT 'Included', CAST(a - n AS BIGINT) FROM t UNION ALL SELECT 'Excluded', CAST(g - a - (b - n) AS BIGINT) FROM t"""))
def mask_summary(spark: SparkSession, d: str) -> DataFrame:
    a, b = V.split_intervals(spark, d)
    return K.summarise_masks(a, K.merge_masks(b), V.contigs(spark, d))[2]


@query(V.with_views("contigs", body="@" + AB + ", " + islands_sql("a", "ma") + ", " + islands_sql("b", "mb") + """, ov AS (SELECT coalesce(sum(least(ma."end", mb."end") - greatest(ma.start, mb.start)), 0) AS n FROM ma JOIN mb ON ma.chrom = mb.chrom AND ma.start < mb."end" AND mb.start < ma."end") SELECT CAST((SELECT sum("end" - start) FROM ma) - n AS BIGINT) AS bases FROM ov"""))
def mask_passing_bases(spark: SparkSession, d: str) -> DataFrame:
    a, b = V.split_intervals(spark, d)
    return K.summarise_masks(a, K.merge_masks(b), V.contigs(spark, d))[1].agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


@query(V.with_views("seq", body="SELECT contig, substr(seq, 100 % greatest(length, 1) + 1) || substr(seq, 1, 100 % greatest(length, 1)) AS seq FROM seq"))
def circular_shift(spark: SparkSession, d: str) -> DataFrame:
    return K.circular_shift(V.sequences(spark, d), 100).select("contig", "seq")


@query(V.with_views("seq", body="SELECT contig, length AS total, CAST(length(seq) - length(translate(seq, 'Nn', '')) AS BIGINT) AS n_bases, round((length(seq) - length(translate(seq, 'Nn', ''))) / length, 6) AS proportion FROM seq WHERE length > 0"))
def n_proportion(spark: SparkSession, d: str) -> DataFrame:
    return rounded(K.n_proportion(V.sequences(spark, d).where("length > 0")), "proportion")


@query(V.with_views("contigs", body="SELECT contig AS chrom, CAST(0 AS BIGINT) AS start, length AS \"end\" FROM contigs WHERE NOT regexp_matches(contig, '^(click|view)')"))
def autosome_mask(spark: SparkSession, d: str) -> DataFrame:
    return K.autosome_mask(V.contigs(spark, d), "^(click|view)")


@query(V.with_views("contigs", body="@" + merged_sql("iv") + """ SELECT CAST((SELECT sum(length) FROM contigs) - sum("end" - start) AS BIGINT) AS bases FROM merged"""))
def allsites(spark: SparkSession, d: str) -> DataFrame:
    return K.allsites(V.contigs(spark, d), *V.split_intervals(spark, d)).agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


# reads and alignments


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts cut into reads of 100 characters, the last one shorter; qualities from the characters of the text. Texts are cut into
    blocks first, so no read is looked for from the beginning of a long text, and what a query does not use is not cut."""
    docs = V.table(spark, d, "documents").where("length(text) > 0").select("doc_id", "text", F.length("text").alias("n"))
    steps = lambda size: F.explode(F.sequence(F.lit(0), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(size)))
    at = docs.select("*", steps(2_000).alias("at"))
    blocks = at.select("doc_id", "at", F.least(F.col("n") - F.col("at"), F.lit(2_000)).alias("n"), F.substr("text", F.col("at") + 1, F.lit(2_000)).alias("block"))
    cut = blocks.select("*", steps(100).alias("i")).select("doc_id", F.expr("(at + i) div 100").alias("part"), F.substr("block", F.col("i") + 1, F.lit(100)).alias("seq"))
    name = F.concat(F.lit("@m:1:FC"), (F.col("doc_id") % 7).cast("string"), F.lit(":"), (F.col("doc_id") % 4 + 1).cast("string"), F.lit(":"), F.col("doc_id").cast("string"), F.lit(":"), F.col("part").cast("string"), F.lit("/1"))
    return cut.select(name.alias("read_id"), "seq", F.translate("seq", "etaoinshr ", "!#%*,/37;?").alias("qual"), F.concat(F.lit("g"), (F.col("doc_id") % 3).cast("string")).alias("rg"), "doc_id", "part")


RD = """cutup AS (SELECT doc_id, text, unnest(range(0, (length(text) - 1) // 100 + 1)) AS part FROM documents WHERE length(text) > 0),
rd AS (SELECT doc_id, part, '@m:1:FC' || CAST(doc_id % 7 AS VARCHAR) || ':' || CAST(doc_id % 4 + 1 AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR) || ':' || CAST(part AS VARCHAR) || '/1' AS read_id, substr(text, part * 100 + 1, 100) AS seq, translate(substr(text, part * 100 + 1, 100), 'etaoinshr ', '!#%*,/37;?') AS qual, 'g' || CAST(doc_id % 3 AS VARCHAR) AS rg FROM cutup)"""


@query(f"WITH {RD} SELECT doc_id, part, split_part(read_id, ':', 3) AS flowcell, CAST(split_part(read_id, ':', 4) AS INT) AS lane FROM rd")
def parse_read_header(spark: SparkSession, d: str) -> DataFrame:
    return R.parse_read_header(reads(spark, d)).select("doc_id", "part", "flowcell", "lane")


@query(f"WITH {RD} SELECT DISTINCT split_part(read_id, ':', 3) || '.' || split_part(read_id, ':', 4) || '.' || rg AS rg, 'S' || rg AS sample_id FROM rd")
def read_group_id(spark: SparkSession, d: str) -> DataFrame:
    f = R.parse_read_header(reads(spark, d)).select("flowcell", "lane", F.col("rg").alias("lib"), F.concat(F.lit("S"), F.col("rg")).alias("sample_id"))
    return R.read_group_id(f).select("rg", "sample_id")


@query(f"WITH {RD} SELECT rg || '|' || read_id AS read_id FROM rd")
def annotate_rg(spark: SparkSession, d: str) -> DataFrame:
    return R.annotate_rg(reads(spark, d)).select("read_id")


ADAPTERS = ["the and of", "athon"]


def adapters_sql(least: int) -> str:
    """`cut`: where the first adapter begins, or the length: all starts, all letters, an eighth of them wrong at most."""
    hits = " + ".join(f"""list_filter(range(0, greatest(length(seq) - {least} + 1, 0)), lambda i: length(list_filter(range(1, least({len(a)}, length(seq) - i) + 1), lambda k: substr(seq, i + k, 1) <> substr('{a}', k, 1))) <= least({len(a)}, length(seq) - i) // 8)""" for a in ADAPTERS if len(a) >= least).replace(" + list", " || list")
    return f"{RD}, st AS (SELECT doc_id, part, seq, list_min({hits}) AS hit FROM rd)"


@query(f"WITH {adapters_sql(3)} SELECT doc_id, part, substr(seq, 1, CAST(coalesce(hit, length(seq)) AS BIGINT)) AS seq FROM st")
def trim_adapter(spark: SparkSession, d: str) -> DataFrame:
    return T.trim_adapter(reads(spark, d), ADAPTERS, 3).select("doc_id", "part", "seq")


def read_through(spark: SparkSession, d: str) -> DataFrame:
    """Mates of 100 letters from inserts of the documents' letters as bases, one in 20 to 119 letters by the number of the piece; what is beyond
    the insert is adapter."""
    starts = F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / 120).cast("int"))
    cut = V.dna(spark, d).where("length(seq) > 0").select("contig", F.posexplode(F.transform(starts, lambda i: F.substr("seq", 120 * i + 1, F.lit(120)))).alias("part", "piece"))
    cut = cut.where("length(piece) = 120").withColumn("ins", F.substr("piece", F.lit(1), (40 + F.pmod(F.col("part") * 7 + F.length("contig"), F.lit(80))).cast("int")))
    back = F.reverse(F.translate("ins", "ACGT", "TGCA"))
    mate = lambda s, a: F.substr(F.concat(s, F.lit(a), F.repeat(F.lit("T"), F.lit(100))), F.lit(1), F.lit(100))
    return cut.select("contig", "part", F.length("ins").alias("size"), mate(F.col("ins"), "AGATCGGAAGAGC").alias("seq1"), F.repeat(F.lit("I"), F.lit(100)).alias("qual1"), mate(back, "AGATCGGAAGAGC").alias("seq2"), F.repeat(F.lit("I"), F.lit(100)).alias("qual2"))


@query(V.with_views("dna", body="""@pc AS (SELECT contig, unnest(range(0, (length(seq) - 1) // 120 + 1)) AS part, seq FROM dna WHERE length(seq) > 0), ins AS (SELECT contig, part, substr(substr(seq, part * 120 + 1, 120), 1, CAST(40 + (part * 7 + length(contig)) % 80 AS BIGINT)) AS s FROM pc WHERE length(substr(seq, part * 120 + 1, 120)) = 120),
mt AS (SELECT contig, part, substr(s || 'AGATCGGAAGAGC' || repeat('T', 100), 1, 100) AS a, substr(reverse(translate(s, 'ACGT', 'TGCA')) || 'AGATCGGAAGAGC' || repeat('T', 100), 1, 100) AS b FROM ins),
fd AS (SELECT *, list_max(list_filter(range(40, 101), lambda n: substr(a, 1, n) = reverse(translate(substr(b, 1, n), 'ACGT', 'TGCA')))) AS n FROM mt)
SELECT contig, part, substr(a, 1, coalesce(n, 100)) AS seq1, substr(b, 1, coalesce(n, 100)) AS seq2 FROM fd"""))
def trim_read_through(spark: SparkSession, d: str) -> DataFrame:
    return T.trim_read_through(read_through(spark, d), 40, 0.0, 0).select("contig", "part", "seq1", "seq2")


@query(f"WITH {RD} SELECT doc_id, part, regexp_replace(seq, 'G{{2,}}$', '') AS seq FROM rd")
def trim_poly_g(spark: SparkSession, d: str) -> DataFrame:
    return R.trim_poly_g(reads(spark, d), 2).select("doc_id", "part", "seq")


@query(f"WITH {RD}, ql AS (SELECT doc_id, part, qual, list_transform(range(1, length(qual) + 1), lambda i: unicode(substr(qual, i, 1)) - 33) AS x FROM rd) SELECT doc_id, part, CAST(coalesce(list_filter(range(0, greatest(length(qual) - 4, 0) + 1), lambda i: list_sum(list_slice(x, i + 1, i + 4)) < 80)[1], length(qual)) AS BIGINT) AS length FROM ql")
def cut_right(spark: SparkSession, d: str) -> DataFrame:
    return R.cut_right(reads(spark, d)).select("doc_id", "part", F.length("seq").cast("long").alias("length"))


@query(f"WITH {RD} SELECT doc_id, part FROM rd WHERE length(seq) >= 15 AND length(seq) - length(replace(seq, 'N', '')) <= 1 AND len(list_filter(range(1, length(seq)), lambda i: substr(seq, i, 1) <> substr(seq, i + 1, 1))) >= 0.95 * (length(seq) - 1)")
def read_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.read_filter(reads(spark, d), 15, 1, 0.95).select("doc_id", "part")


@query(f"WITH {RD} SELECT CAST(length(seq) AS BIGINT) AS length, count(*) AS n, count(DISTINCT seq) AS n_distinct FROM rd GROUP BY 1")
def length_and_duplication(spark: SparkSession, d: str) -> DataFrame:
    return R.length_and_duplication(reads(spark, d))


@query(f"WITH {RD}, c AS (SELECT unnest(range(1, length(seq) + 1)) AS cycle, seq, qual FROM rd) SELECT cycle, count(*) AS n, round(avg(unicode(substr(qual, cycle, 1)) - 33), 6) AS mean_quality, round(avg(CASE WHEN substr(seq, cycle, 1) IN ('G', 'C', 'g', 'c') THEN 1.0 ELSE 0.0 END), 6) AS gc FROM c GROUP BY 1")
def read_qc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.read_qc(reads(spark, d)), "mean_quality", "gc")


@query(f"WITH {RD}, a AS (SELECT * FROM rd WHERE (doc_id + part) % 3 <> 0), b AS (SELECT * FROM rd WHERE (doc_id + part) % 4 <> 0) SELECT a.rg, count(*) AS pairs FROM a JOIN b USING (doc_id, part) GROUP BY 1")
def pair_sync(spark: SparkSession, d: str) -> DataFrame:
    return synced(spark, d)[0].groupBy("rg").agg(F.count(F.lit(1)).alias("pairs"))


def synced(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    r = reads(spark, d).withColumn("name", F.col("read_id"))
    return R.pair_sync(r.where("(doc_id + part) % 3 <> 0"), r.where("(doc_id + part) % 4 <> 0"))


@query(f"WITH {RD} SELECT rg, read_id AS name, CAST(CASE WHEN (doc_id + part) % 4 = 0 THEN 1 ELSE 2 END AS INT) AS mate FROM rd WHERE ((doc_id + part) % 3 = 0) <> ((doc_id + part) % 4 = 0)")
def pair_sync_alone(spark: SparkSession, d: str) -> DataFrame:
    """The reads whose mate is missing, and which mate they are."""
    return synced(spark, d)[1]


DROP = 0x4 | 0x100 | 0x200 | 0x400 | 0x800


@query(V.with_views("aln", body=f"SELECT qname FROM aln WHERE (flag & {DROP}) = 0 AND mapq >= 20 AND (tlen = 0 OR abs(tlen) BETWEEN 15 AND 10000) AND aligned >= 30"))
def alignment_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.alignment_filter(V.alignments(spark, d)).select("qname")


def paired_alignments(spark: SparkSession, d: str) -> DataFrame:
    """Two mates of every event with clips and tile coordinates in the name; a fifth have one mapped mate, some a supplementary row."""
    e = V.table(spark, d, "events")
    k, u = F.col("event_id"), F.col("user_id")
    name = F.concat(F.lit("M1:7:FC:1:"), (u % 3).cast("string"), F.lit(":"), (k * 37 % 9000).cast("string"), F.lit(":"), (k * 91 % 9000).cast("string"))
    at = F.floor(F.unix_timestamp("ts") / 2000) % 150 * 10
    pick = lambda *v: F.element_at(F.array(*(F.lit(x) for x in v)), (k % 3 + 1).cast("int"))
    row = lambda flag, start, end, cigar: F.struct(F.lit(flag).alias("flag"), start.alias("start"), end.alias("end"), cigar.alias("cigar"))
    lead, trail = pick(0, 2, 5), pick(0, 0, 3)
    single, more = k % 5 == 0, k % 11 == 0
    rows = F.array(row(65, at + lead, at + 32, pick("32M", "2S30M", "5H27M")), F.when(~single, row(145, at + 50, at + 82 + u % 2 - trail, pick("32M", "32M", "29M3S"))), F.when(single, row(133, at, at, F.lit("*"))), F.when(more, row(2113, at + 500, at + 520, F.lit("20M12S"))))
    wide = e.select(name.alias("qname"), F.col("event_type").alias("chrom"), F.concat(F.lit("g"), (u % 2).cast("string")).alias("rg"), F.translate(F.md5(k.cast("string")), "0123456789abcdef", "$$IIIIIIIIIIIIII").alias("qual"), F.explode(F.array_compact(rows)).alias("x"))
    return wide.select("qname", "chrom", "rg", "qual", "x.*")


PAIRED = """ev AS (SELECT *, 'M1:7:FC:1:' || CAST(user_id % 3 AS VARCHAR) || ':' || CAST(event_id * 37 % 9000 AS VARCHAR) || ':' || CAST(event_id * 91 % 9000 AS VARCHAR) AS qname, 'g' || CAST(user_id % 2 AS VARCHAR) AS rg, event_type AS chrom, CAST(floor(epoch(ts)) AS BIGINT) // 2000 % 150 * 10 AS base,
  40 * length(replace(translate(md5(CAST(event_id AS VARCHAR)), '0123456789abcdef', '$$IIIIIIIIIIIIII'), '$', '')) AS s FROM events),
rows_ AS (SELECT qname, rg, chrom, 65 AS flag, base AS five, s FROM ev UNION ALL SELECT qname, rg, chrom, 145, base + 82 + user_id % 2, s FROM ev WHERE event_id % 5 <> 0 UNION ALL SELECT qname, rg, chrom, 133, NULL, s FROM ev WHERE event_id % 5 = 0 UNION ALL SELECT qname, rg, chrom, 2113, NULL, s FROM ev WHERE event_id % 11 = 0),
tm AS (SELECT rg, qname, list_sort(list(chrom || ':' || lpad(CAST(five AS VARCHAR), 9, '0') || CASE WHEN (flag & 16) <> 0 THEN '-' ELSE '+' END)) AS ends, sum(s) AS score FROM rows_ WHERE flag IN (65, 145) GROUP BY 1, 2),
rk AS (SELECT *, row_number() OVER (PARTITION BY rg, ends ORDER BY score DESC, qname) AS place, first_value(qname) OVER (PARTITION BY rg, ends ORDER BY score DESC, qname) AS best FROM tm),
taken AS (SELECT DISTINCT rg, unnest(ends) AS e FROM tm WHERE len(ends) > 1),
jd AS (SELECT rk.*, len(ends) = 1 AND EXISTS (SELECT 1 FROM taken t WHERE t.rg = rk.rg AND t.e = rk.ends[1]) AS by_pair FROM rk),
mk AS (SELECT rg, qname, place > 1 OR by_pair AS dup, NOT by_pair AND split_part(qname, ':', 5) = split_part(best, ':', 5) AND abs(CAST(split_part(qname, ':', 6) AS BIGINT) - CAST(split_part(best, ':', 6) AS BIGINT)) <= 2500 AND abs(CAST(split_part(qname, ':', 7) AS BIGINT) - CAST(split_part(best, ':', 7) AS BIGINT)) <= 2500 AS near FROM jd)"""


@query(f"WITH {PAIRED} SELECT r.qname, r.rg, r.flag, flag <> 133 AND dup AS duplicate, flag <> 133 AND dup AND near AS optical FROM rows_ r JOIN mk USING (rg, qname)")
def mark_template_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return U.mark_duplicates(paired_alignments(spark, d)).select("qname", "rg", "flag", "duplicate", "optical")


@query(V.with_views("aln", body="""SELECT qname, row_number() OVER (PARTITION BY rg, chrom, CASE WHEN (flag & 16) <> 0 THEN "end" ELSE start END, (flag & 16) <> 0 ORDER BY qual_sum DESC, qname) > 1 AS duplicate FROM (SELECT * REPLACE (start // 1000 AS start, "end" // 1000 AS "end") FROM aln)"""))
def mark_duplicates(spark: SparkSession, d: str) -> DataFrame:
    coarse = V.alignments(spark, d).withColumns({"start": F.floor(F.col("start") / 1000), "end": F.floor(F.col("end") / 1000)})
    return R.mark_duplicate_reads(coarse).select("qname", "duplicate")


@query(V.with_views("aln", "iv", body="@" + merged_sql("(SELECT chrom, start, \"end\" FROM iv WHERE weight > 450)") + f""" SELECT qname FROM aln a WHERE (flag & {0x4 | 0x100 | 0x400 | 0x800}) = 0 AND EXISTS (SELECT 1 FROM merged m WHERE m.chrom = a.chrom AND m.start < a."end" AND a.start < m."end")"""))
def recruit_region_reads(spark: SparkSession, d: str) -> DataFrame:
    return R.recruit_region_reads(V.alignments(spark, d), V.intervals(spark, d).where("weight > 450")).select("qname")


DEPTH = f"""used AS (SELECT * FROM aln WHERE mapq >= 0 AND (flag & {DROP}) = 0), ev AS (SELECT chrom, x AS start, sum(d) AS d FROM (SELECT chrom, start AS x, 1 AS d FROM used UNION ALL SELECT chrom, "end", -1 FROM used) GROUP BY 1, 2 HAVING sum(d) <> 0),
depth AS (SELECT * FROM (SELECT chrom, start, lead(start) OVER w AS "end", CAST(sum(d) OVER (PARTITION BY chrom ORDER BY start) AS BIGINT) AS depth FROM ev WINDOW w AS (PARTITION BY chrom ORDER BY start)) WHERE depth > 0 AND "end" IS NOT NULL)"""


@query(V.with_views("aln", body=f"@{DEPTH} SELECT * FROM depth"))
def per_base_depth(spark: SparkSession, d: str) -> DataFrame:
    return R.per_base_depth(V.alignments(spark, d))


@query(V.with_views("aln", body=f"""@{DEPTH} SELECT least(depth, 2) AS depth, CAST(sum("end" - start) AS BIGINT) AS bases FROM depth GROUP BY 1"""))
def depth_distribution(spark: SparkSession, d: str) -> DataFrame:
    return R.depth_distribution(R.per_base_depth(V.alignments(spark, d)), 2)


@query(V.with_views("aln", "iv", body=f"@{DEPTH}, " + islands_sql("(SELECT chrom, start, \"end\" FROM iv WHERE weight > 450)", "mb") + """, cuts AS (SELECT d.chrom, d.start AS s0, d."end" AS e0, d.depth, greatest(mb.start, d.start) AS cs, least(mb."end", d."end") AS ce FROM depth d JOIN mb ON d.chrom = mb.chrom AND d.start < mb."end" AND mb.start < d."end"),
pieces AS (SELECT chrom, depth, coalesce(lag(ce) OVER (PARTITION BY chrom, s0 ORDER BY cs), s0) AS start, cs AS "end" FROM cuts UNION ALL SELECT chrom, depth, max(ce), e0 FROM cuts GROUP BY chrom, s0, e0, depth
 UNION ALL SELECT chrom, depth, start, "end" FROM depth d WHERE NOT EXISTS (SELECT 1 FROM mb WHERE mb.chrom = d.chrom AND d.start < mb."end" AND mb.start < d."end")), lft AS (SELECT * FROM pieces WHERE start < "end" AND depth >= 1), """ + islands_sql("lft", "mg", 0, ', CAST(sum(("end" - start) * depth) AS BIGINT) AS weight') + " SELECT * FROM mg"))
def covered_intervals(spark: SparkSession, d: str) -> DataFrame:
    return R.covered_intervals(R.per_base_depth(V.alignments(spark, d)), V.intervals(spark, d).where("weight > 450"), 1)


@query(V.with_views("aln", "contigs", body=f"""@{DEPTH}, r AS (SELECT chrom, count(*) AS n_reads, avg(mapq) AS mean_mapq FROM used GROUP BY 1), c AS (SELECT chrom, sum("end" - start) AS covered, sum(("end" - start) * depth) AS bases FROM depth GROUP BY 1)
SELECT contig AS chrom, coalesce(n_reads, 0) AS n_reads, CAST(coalesce(covered, 0) AS BIGINT) AS covered, round(100.0 * coalesce(covered, 0) / length, 6) AS coverage, round(coalesce(bases, 0) / length, 6) AS mean_depth, round(coalesce(mean_mapq, 0), 6) AS mean_mapq FROM contigs LEFT JOIN r ON r.chrom = contig LEFT JOIN c ON c.chrom = contig"""))
def contig_coverage(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.contig_coverage(V.alignments(spark, d), V.contigs(spark, d)), "coverage", "mean_depth", "mean_mapq")


@query()
def downsample_to_coverage(spark: SparkSession, d: str) -> DataFrame:
    return R.downsample_to_coverage(V.alignments(spark, d), V.intervals(spark, d).where("weight > 300"), 0.001).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("aln", body="SELECT tlen AS size, count(*) AS n FROM aln WHERE tlen > 0 GROUP BY 1"))
def insert_sizes(spark: SparkSession, d: str) -> DataFrame:
    return R.insert_sizes(V.alignments(spark, d))


@query(V.with_views("aln", body="SELECT count(*) AS n, CAST(sum(CASE WHEN (flag & 4) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_mapped, CAST(sum(CASE WHEN (flag & 256) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_secondary, CAST(sum(CASE WHEN (flag & 1024) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicate, CAST(sum(CASE WHEN mapq < 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_low_mapq, round(avg(CASE WHEN tlen > 0 THEN tlen END), 6) AS mean_insert, round(quantile_cont(CASE WHEN tlen > 0 THEN tlen END, 0.5), 6) AS median_insert FROM aln"))
def alignment_qc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(R.alignment_qc(V.alignments(spark, d)), "mean_insert", "median_insert")


@query(V.with_views("aln", body="@x AS (SELECT sample_id, rg FROM aln), o AS (SELECT sample_id, rg FROM aln WHERE mapq > 5 OR sample_id <> 'S3'), e AS (SELECT sample_id, string_agg(DISTINCT rg, ',' ORDER BY rg) AS a FROM x GROUP BY 1), f AS (SELECT sample_id, string_agg(DISTINCT rg, ',' ORDER BY rg) AS b FROM o GROUP BY 1) SELECT sample_id, CASE WHEN a = b THEN 'PASS' ELSE 'FAIL' END AS status FROM e JOIN f USING (sample_id)"))
def reuse_validation(spark: SparkSession, d: str) -> DataFrame:
    a = V.alignments(spark, d).withColumn("config", F.lit("v1"))
    return R.reuse_validation(a, a.where("mapq > 5 or sample_id <> 'S3'"))


@query(V.with_views("aln", body="SELECT rg, round(sqrt(sum(power(mapq - qual_sum, 2) * aligned) / sum(aligned)), 6) AS rmse, CAST(sum(aligned) AS BIGINT) AS observations FROM aln GROUP BY 1"))
def recalibration_qc(spark: SparkSession, d: str) -> DataFrame:
    a = V.alignments(spark, d).select("rg", F.col("mapq").alias("QualityScore"), F.col("qual_sum").alias("EmpiricalQuality"), F.col("aligned").alias("Observations"))
    return rounded(R.recalibration_qc(a, ["rg"]), "rmse")


# genotypes


def likelihoods(spark: SparkSession, d: str) -> DataFrame:
    return G.genotype_likelihoods(V.genotypes(spark, d))


GL = """l AS (SELECT *, n_alt * ln(0.01) + n_ref * ln(0.99) AS a0, (n_alt + n_ref) * ln(0.5) AS a1, n_alt * ln(0.99) + n_ref * ln(0.01) AS a2 FROM g), e AS (SELECT *, exp(a0 - greatest(a0, a1, a2)) AS e0, exp(a1 - greatest(a0, a1, a2)) AS e1, exp(a2 - greatest(a0, a1, a2)) AS e2 FROM l),
gl AS (SELECT chrom, pos, sample_id, dosage, dp, gq, e0 / (e0 + e1 + e2) AS l0, e1 / (e0 + e1 + e2) AS l1, e2 / (e0 + e1 + e2) AS l2 FROM e)"""


@query(V.with_views("g", body=f"@{GL} SELECT chrom, pos, sample_id, round(l0, 6) AS l0, round(l1, 6) AS l1, round(l2, 6) AS l2 FROM gl"))
def genotype_likelihoods(spark: SparkSession, d: str) -> DataFrame:
    return likelihoods(spark, d).select("chrom", "pos", "sample_id", *(F.round(F.col("gl")[i], 6).alias(f"l{i}") for i in range(3)))


@query(V.with_views("g", body=f"@{GL} SELECT chrom, pos, sample_id, CASE WHEN 1 - greatest(l0, l1, l2) <= 1 - 0.9 THEN CASE WHEN l0 = greatest(l0, l1, l2) THEN 0 WHEN l1 = greatest(l0, l1, l2) THEN 1 ELSE 2 END END AS dosage FROM gl"))
def gp_to_gt(spark: SparkSession, d: str) -> DataFrame:
    return G.gp_to_gt(likelihoods(spark, d).withColumnRenamed("gl", "gp")).select("chrom", "pos", "sample_id", "dosage")


def posterior_sql(rounds: int = 5) -> str:
    """The EM of the cohort model, unrolled."""
    steps = [f"q{k}a AS (SELECT *, l0 * (1 - f) * (1 - f) AS a, l1 * 2 * f * (1 - f) AS b, l2 * f * f AS c FROM q{k}), q{k + 1} AS (SELECT * EXCLUDE (f, a, b, c), least(greatest(sum((b + 2 * c) / (a + b + c)) OVER (PARTITION BY chrom, pos) / (2 * count(*) OVER (PARTITION BY chrom, pos)), 1e-6), 1 - 1e-6) AS f FROM q{k}a)" for k in range(rounds)]
    return ", ".join(["q0 AS (SELECT *, 0.25 AS f FROM gl)", *steps, f"po AS (SELECT *, l0 * (1 - f) * (1 - f) AS a, l1 * 2 * f * (1 - f) AS b, l2 * f * f AS c FROM q{rounds})"])


@query(V.with_views("g", body=f"@{GL}, {posterior_sql()} SELECT chrom, pos, sample_id, round(a / (a + b + c), 6) AS p0, round(b / (a + b + c), 6) AS p1, round(c / (a + b + c), 6) AS p2 FROM po"))
def genotype_posteriors(spark: SparkSession, d: str) -> DataFrame:
    return G.genotype_posteriors(likelihoods(spark, d)).select("chrom", "pos", "sample_id", *(F.round(F.col("gp")[i], 6).alias(f"p{i}") for i in range(3)))


@query(V.with_views("g", body="SELECT chrom, pos, sample_id, CASE WHEN dp % 5 = 0 THEN NULL ELSE dosage END AS dosage FROM g"))
def mask_zero_depth(spark: SparkSession, d: str) -> DataFrame:
    return G.mask_zero_depth(V.genotypes(spark, d).withColumn("dp", F.col("dp") % 5)).select("chrom", "pos", "sample_id", "dosage")


@query(V.with_views("s", body="SELECT chrom, pos, concat_ws('_', chrom, CAST(pos AS VARCHAR), ref, alt[1]) AS id FROM s"))
def set_variant_id(spark: SparkSession, d: str) -> DataFrame:
    return G.set_variant_id(V.sites(spark, d)).select("chrom", "pos", "id")


@query(V.with_views("g", "s", body="""SELECT s.chrom, s.pos, count(g.sample_id) AS n FROM s LEFT JOIN g ON s.chrom = g.chrom AND s.pos = g.pos WHERE len(s.alt) = 1 AND NOT (s.chrom = 'chr1' AND s.pos - 1 BETWEEN 0 AND 9999) GROUP BY 1, 2"""))
def constrain_to_panel(spark: SparkSession, d: str) -> DataFrame:
    exclude = spark.createDataFrame([("chr1", 0, 10_000)], "chrom string, start long, end long")
    return G.constrain_to_panel(V.genotypes(spark, d), V.sites(spark, d), exclude).groupBy("chrom", "pos").agg(F.count("sample_id").alias("n"))


@query(V.with_views("s", body="SELECT chrom, pos FROM s WHERE len(alt) <= 1"))
def max_alt_alleles(spark: SparkSession, d: str) -> DataFrame:
    return G.max_alt_alleles(V.sites(spark, d), 1).select("chrom", "pos")


def phred(spark: SparkSession, d: str) -> DataFrame:
    return V.genotypes(spark, d).withColumn("pl", F.when(F.col("gq") > 10, F.array(F.col("dosage") * F.col("gq"), F.abs(F.col("dosage") - 1) * F.col("gq"), (2 - F.col("dosage")) * F.col("gq"))))


@query(V.with_views("g", body="""@x AS (SELECT chrom, pos, sample_id, gq, power(10, -dosage * gq / 10.0) AS a, power(10, -abs(dosage - 1) * gq / 10.0) AS b, power(10, -(2 - dosage) * gq / 10.0) AS c, max(CASE WHEN gq > 10 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom, pos) AS ok FROM g)
SELECT chrom, pos, sample_id, round(CASE WHEN gq > 10 THEN a / (a + b + c) ELSE 1 / 3.0 END, 6) AS p0, round(CASE WHEN gq > 10 THEN b / (a + b + c) ELSE 1 / 3.0 END, 6) AS p1 FROM x WHERE ok = 1"""))
def pl_to_gp(spark: SparkSession, d: str) -> DataFrame:
    return G.pl_to_gp(phred(spark, d)).select("chrom", "pos", "sample_id", *(F.round(F.col("gp")[i], 6).alias(f"p{i}") for i in range(2)))


@query()
def pseudohaploid(spark: SparkSession, d: str) -> DataFrame:
    return G.pseudohaploid(V.genotypes(spark, d).withColumn("ad", F.array("n_ref", "n_alt"))).select("chrom", "pos", "sample_id", "dosage")


@query()
def single_read_ibs(spark: SparkSession, d: str) -> DataFrame:
    return G.single_read_ibs(base_counts(spark, d)).select("chrom", "pos", "sample_id", "allele")


def base_counts(spark: SparkSession, d: str) -> DataFrame:
    return V.genotypes(spark, d).select("chrom", "pos", "sample_id", F.col("n_ref").alias("A"), F.col("n_alt").alias("C"), F.lit(0).alias("G"), F.lit(0).alias("T"))


@query(V.with_views("g", body="SELECT chrom, pos, sample_id, CAST(CASE WHEN n_ref + n_alt = 0 THEN -1 WHEN n_ref >= n_alt THEN 0 ELSE 1 END AS INT) AS allele FROM g"))
def single_read_ibs_major(spark: SparkSession, d: str) -> DataFrame:
    return G.single_read_ibs(base_counts(spark, d), "major").select("chrom", "pos", "sample_id", "allele")


@query(V.with_views("iv", body="""SELECT chrom, CAST(sum("end" - start) AS BIGINT) AS n, CAST(sum(("end" - start) * (start + 1 + "end") // 2) AS BIGINT) AS total FROM iv GROUP BY 1"""))
def expand_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Bases and sum of positions per contig over every block, whatever its length."""
    return G.expand_blocks(V.intervals(spark, d)).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("total"))


@query(V.with_views("g", body="""@b AS (SELECT *, CAST(gq >= 20 AS INT) + CAST(gq >= 40 AS INT) AS band FROM (SELECT sample_id, chrom, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY pos) AS pos, dp, gq FROM g)), r AS (SELECT *, pos - row_number() OVER (PARTITION BY sample_id, chrom, band ORDER BY pos) AS run FROM b)
SELECT sample_id, chrom, band, min(pos) - 1 AS start, max(pos) AS "end", min(dp) AS min_dp FROM r GROUP BY sample_id, chrom, band, run HAVING max(dp) > 0 AND max(gq) > 0"""))
def gvcf_bands(spark: SparkSession, d: str) -> DataFrame:
    g = V.genotypes(spark, d).selectExpr("sample_id", "chrom", "row_number() over (partition by sample_id, chrom order by pos) as pos", "dp", "gq")
    return G.gvcf_bands(g, [20, 40])


@query(V.with_views("s", body="SELECT chrom, pos - 2 * (size % 4) - 1 AS pos, 'T' AS ref, 'TCA' AS alt FROM s UNION SELECT chrom, pos, 'C', 'G' FROM s"))
def normalise_variants(spark: SparkSession, d: str) -> DataFrame:
    """An insertion at the end of repeats of CA, which moves to their start, beside a substitution, which stays."""
    s = V.sites(spark, d).select("chrom", "pos", F.lit("CA").alias("ref"), F.array(F.lit("CACA"), F.lit("GA")).alias("alt"), F.concat(F.lit("GT"), F.repeat(F.lit("CA"), F.col("size") % 4)).alias("before"))
    return G.normalise_variants(s, "before")


@query(V.with_views("g", body="""@v AS (SELECT chrom, pos, sample_id, dosage, dp FROM g WHERE dosage > 0), bl AS (SELECT sample_id, chrom, pos - 300 AS start, pos + 300 AS "end", dp FROM g WHERE dosage = 0), st AS (SELECT DISTINCT chrom, pos FROM v), sm AS (SELECT DISTINCT sample_id FROM g),
ins AS (SELECT st.chrom, st.pos, bl.sample_id, max(bl.dp) AS block_dp FROM st JOIN bl ON bl.chrom = st.chrom AND bl.start < st.pos AND st.pos - 1 < bl."end" GROUP BY 1, 2, 3)
SELECT st.chrom, st.pos, sm.sample_id, CAST(CASE WHEN v.sample_id IS NOT NULL THEN v.dosage WHEN ins.block_dp IS NOT NULL THEN 0 END AS INT) AS dosage, coalesce(v.dp, ins.block_dp) AS dp
FROM st CROSS JOIN sm LEFT JOIN v ON v.chrom = st.chrom AND v.pos = st.pos AND v.sample_id = sm.sample_id LEFT JOIN ins ON ins.chrom = st.chrom AND ins.pos = st.pos AND ins.sample_id = sm.sample_id"""))
def combine_samples(spark: SparkSession, d: str) -> DataFrame:
    g = V.genotypes(spark, d)
    blocks = g.where("dosage = 0").select("sample_id", "chrom", (F.col("pos") - 300).alias("start"), (F.col("pos") + 300).alias("end"), "dp")
    return G.combine_samples(g.where("dosage > 0").select("chrom", "pos", "sample_id", "dosage", "dp"), blocks)


# mitochondrial consensus

COUNTED = """cnt AS (SELECT shifted, sample_id, pos, {sums}, CAST(sum(CASE WHEN upper(allele) NOT IN ('A', 'C', 'G', 'T') THEN fwd + rev ELSE 0 END) AS BIGINT) AS non_snv FROM reads_at GROUP BY 1, 2, 3)""".format(sums=", ".join(f"CAST(sum(CASE WHEN upper(allele) = '{b}' THEN fwd + rev ELSE 0 END) AS BIGINT) AS {b}" for b in "ACGT"))
FRAME = """fr AS (SELECT sample_id, pos FROM (SELECT DISTINCT sample_id FROM reads_at) CROSS JOIN (SELECT unnest(range(1, 501)) AS pos)), o AS (SELECT * FROM cnt WHERE NOT shifted), sh AS (SELECT * REPLACE ((pos + 249) % 500 + 1 AS pos) FROM cnt WHERE shifted),
ch AS (SELECT fr.sample_id, fr.pos, CASE WHEN (fr.pos <= 50 OR fr.pos > 450) AND sh.pos IS NOT NULL THEN 'shifted' WHEN o.pos IS NOT NULL THEN 'original' ELSE 'none' END AS source, {cols} FROM fr LEFT JOIN o ON o.sample_id = fr.sample_id AND o.pos = fr.pos LEFT JOIN sh ON sh.sample_id = fr.sample_id AND sh.pos = fr.pos),
dep AS (SELECT *, A + C + G + T AS depth, A + C + G + T + non_snv AS total_depth FROM ch), rk AS (SELECT *, list_sort([{{'n': -A, 'b': 'A'}}, {{'n': -C, 'b': 'C'}}, {{'n': -G, 'b': 'G'}}, {{'n': -T, 'b': 'T'}}]) AS r FROM dep),
mj AS (SELECT *, r[1].b AS major, CASE WHEN depth > 0 THEN -r[1].n / depth ELSE 0 END AS major_af, r[2].b AS minor, CASE WHEN depth > 0 THEN -r[2].n / depth ELSE 0 END AS minor_af, CASE WHEN total_depth > 0 THEN non_snv / total_depth ELSE 0 END AS non_snv_af FROM rk),
vd AS (SELECT *, CASE WHEN total_depth < {depth} THEN 'LOW_DEPTH' WHEN non_snv_af > 0.2 THEN 'NON_SNV_EVIDENCE' WHEN depth = 0 THEN 'NO_BASE_SUPPORT' WHEN major_af >= 0.8 THEN 'PASS' WHEN {mixed} AND minor_af >= 0.2 AND -r[2].n >= {minor} THEN 'MIXED_IUPAC' ELSE 'LOW_MAJOR_AF' END AS filter FROM mj),
cl AS (SELECT *, CASE filter WHEN 'PASS' THEN major WHEN 'MIXED_IUPAC' THEN CASE least(major, minor) || greatest(major, minor) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' ELSE 'K' END ELSE 'N' END AS base FROM vd)"""
COLS = dict(cols=", ".join(f"coalesce(CASE WHEN (fr.pos <= 50 OR fr.pos > 450) AND sh.pos IS NOT NULL THEN sh.{c} ELSE o.{c} END, 0) AS {c}" for c in ("A", "C", "G", "T", "non_snv")))


CHOSEN = FRAME.format(depth=20, mixed="true", minor=5, **COLS)
CHOSEN_N = FRAME.format(depth=10, mixed="false", minor=3, **COLS)


def mito_calls(spark: SparkSession, d: str, mode: str = "iupac") -> DataFrame:
    """mode "iupac": as a run calls them; mode "N": the caller's own defaults."""
    a = V.allele_reads(spark, d)
    original, shifted = M.allele_counts(a.where("not shifted")), M.shifted_to_original(M.allele_counts(a.where("shifted")), 250, 500)
    chosen = M.choose_source(original, shifted, a.select("sample_id").distinct(), 500, 50)
    return M.call_major_allele(chosen, min_depth=20, min_minor_depth=5, het_mode="iupac") if mode == "iupac" else M.call_major_allele(chosen)


@query(V.with_views("reads_at", body=f"@{COUNTED} SELECT sample_id, pos, A, C, G, T, non_snv FROM cnt WHERE NOT shifted"))
def mito_allele_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.allele_counts(V.allele_reads(spark, d).where("not shifted")).select("sample_id", "pos", "A", "C", "G", "T", "non_snv")


@query(V.with_views("reads_at", body=f"@{COUNTED}, {CHOSEN} SELECT sample_id, pos, source, filter, base, round(major_af, 6) AS major_af FROM cl"))
def mito_major_alleles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mito_calls(spark, d).select("sample_id", "pos", "source", "filter", "base", "major_af"), "major_af")


@query(V.with_views("reads_at", body=f"@{COUNTED}, {CHOSEN_N} SELECT sample_id, pos, source, filter, base, round(major_af, 6) AS major_af FROM cl"))
def mito_major_alleles_n(spark: SparkSession, d: str) -> DataFrame:
    return rounded(mito_calls(spark, d, "N").select("sample_id", "pos", "source", "filter", "base", "major_af"), "major_af")


@query(V.with_views("reads_at", body=f"@{COUNTED}, {CHOSEN} SELECT sample_id, string_agg(base, '' ORDER BY pos) AS seq FROM cl GROUP BY 1"))
def mito_consensus(spark: SparkSession, d: str) -> DataFrame:
    return M.consensus_sequence(mito_calls(spark, d))


@query(V.with_views("reads_at", body=f"@{COUNTED}, {CHOSEN} SELECT sample_id, round(avg(total_depth), 6) AS mean_depth, round(quantile_cont(total_depth, 0.5), 6) AS median_depth, CAST(sum(CASE WHEN total_depth >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_covered, CAST(sum(CASE WHEN base = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_unknown, CAST(sum(CASE WHEN filter = 'PASS' THEN 1 ELSE 0 END) AS BIGINT) AS n_pass, CAST(sum(CASE WHEN source = 'shifted' THEN 1 ELSE 0 END) AS BIGINT) AS n_shifted FROM cl GROUP BY 1"))
def mito_qc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.mito_qc(mito_calls(spark, d), 20), "mean_depth", "median_depth").select("sample_id", "mean_depth", "median_depth", "n_covered", "n_unknown", "n_pass", "n_shifted")


@query(V.with_views("reads_at", body=f"@{COUNTED}, {CHOSEN}, vt AS (SELECT pos, base, count(*) AS n FROM cl WHERE base IN ('A', 'C', 'G', 'T') GROUP BY 1, 2) SELECT pos, CASE WHEN sum(n) < 2 THEN 'N' ELSE list(base ORDER BY n DESC, base)[1] END AS base FROM vt GROUP BY 1"))
def majority_fasta(spark: SparkSession, d: str) -> DataFrame:
    return M.majority_fasta(mito_calls(spark, d).select("pos", "sample_id", "base"), 2)


# populations

FREQ = "fr AS (SELECT chrom, pos, sum(dosage) / (2 * count(dosage)) AS freq, count(dosage) AS n_obs FROM g GROUP BY 1, 2 HAVING count(dosage) > 0)"
PAIRS = "pr AS (SELECT a.chrom, a.pos, a.sample_id AS sample_i, b.sample_id AS sample_j, a.dosage AS x, b.dosage AS y FROM g a JOIN g b ON a.chrom = b.chrom AND a.pos = b.pos AND a.sample_id {op} b.sample_id)"


@query(V.with_views("g", body=f"@{FREQ} SELECT chrom, pos, round(freq, 6) AS freq, n_obs FROM fr"))
def allele_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.allele_frequencies(V.genotypes(spark, d)), "freq")


@query(V.with_views("g", body=f"@{FREQ}, {PAIRS.format(op='<=')} SELECT sample_i, sample_j, round(sum((x - 2 * freq) * (y - 2 * freq) / (2 * freq * (1 - freq))) / count(*), 5) AS value FROM pr JOIN fr USING (chrom, pos) WHERE freq > 0 AND freq < 1 GROUP BY 1, 2"))
def grm(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.grm(V.genotypes(spark, d)), "value", digits=5)


@query(V.with_views("g", body=f"@{FREQ}, {PAIRS.format(op='<=')} SELECT sample_i, sample_j, round(sum(CASE WHEN sample_i = sample_j THEN (x * x - (1 + 2 * freq) * x + 2 * freq * freq) ELSE (x - 2 * freq) * (y - 2 * freq) END / (2 * freq * (1 - freq))) / count(*) + max(CASE WHEN sample_i = sample_j THEN 1 ELSE 0 END), 5) AS value FROM pr JOIN fr USING (chrom, pos) WHERE freq > 0 AND freq < 1 GROUP BY 1, 2"))
def relatedness_ajk(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.relatedness_ajk(V.genotypes(spark, d)), "value", digits=5)


@query(V.with_views("g", body=f"@{PAIRS.format(op='<')}, t AS (SELECT sample_i, sample_j, count(*) AS nsnp, CAST(sum(CASE WHEN x = 1 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS hethet, CAST(sum(CASE WHEN abs(x - y) = 2 THEN 1 ELSE 0 END) AS BIGINT) AS ibs0, CAST(sum(CASE WHEN x = 1 THEN 1 ELSE 0 END) AS BIGINT) AS het_i, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS het_j FROM pr GROUP BY 1, 2) SELECT *, round(CASE WHEN least(het_i, het_j) > 0 THEN (hethet - 2 * ibs0) / (2 * least(het_i, het_j)) + 0.5 - 0.25 * (het_i + het_j) / least(het_i, het_j) END, 6) AS kinship FROM t"))
def king_table(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.king_table(V.genotypes(spark, d)), "kinship")


@query(V.with_views("g", body=f"@{PAIRS.format(op='<')} SELECT sample_i, sample_j, round(sum(abs(x - y)) / (2.0 * count(*)), 6) AS value FROM pr GROUP BY 1, 2"))
def ibs_distance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.ibs_distance(V.genotypes(spark, d)), "value")


@query()
def pca_table(spark: SparkSession, d: str) -> DataFrame:
    g = kept(V.genotypes(spark, d).select("chrom", "pos", "sample_id", "dosage"), "genotypes")
    return P.pca_table(*P.pca(P.grm(g), g.select("sample_id")), V.popmap(spark, d))


@query()
def mds(spark: SparkSession, d: str) -> DataFrame:
    g = kept(V.genotypes(spark, d).select("chrom", "pos", "sample_id", "dosage"), "genotypes")
    return P.mds(P.drop_until_complete(P.square(P.ibs_distance(g), g.select("sample_id"))))[0]


@query(V.with_views("g", body=f"@{GL} SELECT a.sample_id AS sample_i, b.sample_id AS sample_j, round(avg(0.5 * (a.l0 * b.l1 + a.l1 * b.l0 + a.l1 * b.l2 + a.l2 * b.l1) + a.l0 * b.l2 + a.l2 * b.l0), 6) AS value FROM gl a JOIN gl b ON a.chrom = b.chrom AND a.pos = b.pos AND a.sample_id < b.sample_id GROUP BY 1, 2"))
def gl_expected_distance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.gl_expected_distance(likelihoods(spark, d).withColumnRenamed("gl", "gp")), "value")


@query()
def bootstrap_blocks(spark: SparkSession, d: str) -> DataFrame:
    return P.bootstrap_blocks(V.genotypes(spark, d))


@query(V.with_views("g", body=f"@{GL}, ed AS (SELECT chrom, pos, sample_id, l1 + 2 * l2 AS x FROM gl), fq AS (SELECT chrom, pos, sum(x) / (2 * count(x)) AS freq FROM ed GROUP BY 1, 2) SELECT a.sample_id AS sample_i, b.sample_id AS sample_j, round(avg((a.x - 2 * freq) * (b.x - 2 * freq) / (2 * freq * (1 - freq))), 5) AS value FROM ed a JOIN ed b ON a.chrom = b.chrom AND a.pos = b.pos AND a.sample_id <= b.sample_id JOIN fq ON fq.chrom = a.chrom AND fq.pos = a.pos WHERE freq > 0 AND freq < 1 GROUP BY 1, 2"))
def gl_covariance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.gl_covariance(likelihoods(spark, d).withColumnRenamed("gl", "gp")), "value", digits=5)


@query(V.with_views("g", body=f"@{FREQ} SELECT sample_id, round(sum(CASE WHEN dosage = 1 THEN 1.0 ELSE 0 END), 6) AS obs_het, round(sum(2 * freq * (1 - freq)), 5) AS exp_het, count(*) AS n_sites, round(1 - sum(CASE WHEN dosage = 1 THEN 1.0 ELSE 0 END) / sum(2 * freq * (1 - freq)), 5) AS F FROM g JOIN fr USING (chrom, pos) WHERE freq > 0 AND freq < 1 GROUP BY 1"))
def inbreeding(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.inbreeding(V.genotypes(spark, d)), "obs_het", "exp_het", "F", digits=5)


@query(V.with_views("g", body="@t AS (SELECT chrom, pos, avg(CASE WHEN dosage = 1 THEN 1.0 ELSE 0 END) AS o, 2 * (sum(dosage) / (2 * count(dosage))) * (1 - sum(dosage) / (2 * count(dosage))) AS e FROM g GROUP BY 1, 2) SELECT chrom, pos, round(o, 6) AS obs_het, round(e, 6) AS exp_het, round(1 - o / e, 6) AS F FROM t WHERE e > 0"))
def site_inbreeding(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.site_inbreeding(V.genotypes(spark, d)), "obs_het", "exp_het", "F")


@query(V.with_views("g", "pop", body="""@p AS (SELECT chrom, pos, pop, sum(dosage) / (2 * count(dosage)) AS p FROM g JOIN pop USING (sample_id) GROUP BY 1, 2, 3), w AS (SELECT chrom, pos, max(CASE WHEN pop = 'P0' THEN p END) AS a, max(CASE WHEN pop = 'P1' THEN p END) AS b, max(CASE WHEN pop = 'P2' THEN p END) AS c, max(CASE WHEN pop = 'P3' THEN p END) AS e FROM p GROUP BY 1, 2),
k AS (SELECT chrom, floor(pos / 5000) AS blk, sum((1 - a) * b * c * (1 - e) + a * (1 - b) * (1 - c) * e) AS x, sum(a * (1 - b) * c * (1 - e) + (1 - a) * b * (1 - c) * e) AS y FROM w WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND e IS NOT NULL GROUP BY 1, 2), t AS (SELECT sum(x) AS xx, sum(y) AS yy FROM k),
l AS (SELECT xx, yy, (xx - x - (yy - y)) / (xx - x + yy - y) AS dd FROM k CROSS JOIN t) SELECT round((max(xx) - max(yy)) / (max(xx) + max(yy)), 5) AS D, round(sqrt((count(dd) - 1) * var_pop(dd)), 5) AS SE, count(*) AS n_blocks FROM l"""))
def abba_baba(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.abba_baba(V.genotypes(spark, d), V.popmap(spark, d), "P0", "P1", "P2", "P3", 5000).select("D", "SE", "n_blocks"), "D", "SE", digits=5)


@query(V.with_views("g", "pop", body="""@p AS (SELECT chrom, pos, pop, sum(dosage) / (2 * count(dosage)) AS p FROM g JOIN pop USING (sample_id) GROUP BY 1, 2, 3), tr AS (SELECT a.chrom, a.pos, a.pop AS h1, b.pop AS h2, c.pop AS h3, a.p AS a, b.p AS b, c.p AS c, e.p AS e FROM p a JOIN p b ON a.chrom = b.chrom AND a.pos = b.pos AND a.pop < b.pop JOIN p c ON a.chrom = c.chrom AND a.pos = c.pos AND c.pop NOT IN (a.pop, b.pop) JOIN p e ON a.chrom = e.chrom AND a.pos = e.pos AND e.pop = 'P3' WHERE a.pop <> 'P3' AND b.pop <> 'P3' AND c.pop <> 'P3'),
k AS (SELECT h1, h2, h3, chrom, floor(pos / 5000) AS blk, sum((1 - a) * b * c * (1 - e) + a * (1 - b) * (1 - c) * e) AS x, sum(a * (1 - b) * c * (1 - e) + (1 - a) * b * (1 - c) * e) AS y FROM tr GROUP BY 1, 2, 3, 4, 5), t AS (SELECT h1, h2, h3, sum(x) AS xx, sum(y) AS yy FROM k GROUP BY 1, 2, 3),
l AS (SELECT h1, h2, h3, xx, yy, (xx - x - (yy - y)) / (xx - x + yy - y) AS dd FROM k JOIN t USING (h1, h2, h3)) SELECT h1, h2, h3, round((max(xx) - max(yy)) / (max(xx) + max(yy)), 5) AS D, round(sqrt((count(dd) - 1) * var_pop(dd)), 5) AS SE, count(*) AS n_blocks FROM l GROUP BY 1, 2, 3"""))
def abba_baba_trees(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.abba_baba_trees(V.genotypes(spark, d), V.popmap(spark, d), "P3", 5000).select("h1", "h2", "h3", "D", "SE", "n_blocks"), "D", "SE", digits=5)


@query(V.with_views("g", body=f"@{PAIRS.format(op='<')}, t AS (SELECT sample_i, sample_j, " + ", ".join(f"CAST(sum(CASE WHEN x = {i} AND y = {j} THEN 1 ELSE 0 END) AS BIGINT) AS n{i}{j}" for i in range(3) for j in range(3)) + " FROM pr GROUP BY 1, 2) SELECT *, round(CASE WHEN n11 > 0 THEN (n02 + n20) / n11 END, 6) AS R0, round(CASE WHEN n01 + n10 + n12 + n21 + n02 + n20 > 0 THEN n11 / (n01 + n10 + n12 + n21 + n02 + n20) END, 6) AS R1, round(CASE WHEN n01 + n10 + n12 + n21 + 2 * n11 > 0 THEN (n11 - 2 * (n02 + n20)) / (n01 + n10 + n12 + n21 + 2 * n11) END, 6) AS KING FROM t"))
def joint_genotype_counts(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.joint_genotype_counts(V.genotypes(spark, d)), "R0", "R1", "KING")


@query(V.with_views("g", "s", body="SELECT s.chrom, s.pos, n_samples FROM s LEFT JOIN (SELECT chrom, pos, CAST(sum(CASE WHEN gq > 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_samples FROM g GROUP BY 1, 2) USING (chrom, pos)"))
def ibs_missing_counts(spark: SparkSession, d: str) -> DataFrame:
    return missing_ibs(spark, d)[1]


def missing_ibs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    ibs = V.genotypes(spark, d).withColumn("allele", F.when(F.col("gq") > 20, F.col("dosage")).otherwise(-1))
    return P.ibs_missing_counts(ibs, V.sites(spark, d))


@query(V.with_views("g", body="SELECT sample_id, CAST(sum(CASE WHEN gq > 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_sites FROM g GROUP BY 1"))
def ibs_missing_samples(spark: SparkSession, d: str) -> DataFrame:
    return missing_ibs(spark, d)[0]


@query(V.with_views("reads_at", body="@a AS (SELECT sample_id, ['A', 'C', 'G', 'T'][CAST(pos % 4 AS INT) + 1] AS anc, allele AS base, CAST(sum(fwd + rev) AS BIGINT) AS n FROM reads_at WHERE allele <> 'AT' GROUP BY 1, 2, 3) SELECT *, round(n / sum(n) OVER (PARTITION BY sample_id, anc), 6) AS rate FROM a"))
def substitution_matrix(spark: SparkSession, d: str) -> DataFrame:
    p = V.allele_reads(spark, d).where("allele <> 'AT'").select(F.lit("m").alias("chrom"), "pos", "sample_id", F.col("allele").alias("base"), (F.col("fwd") + F.col("rev")).alias("n"))
    anc = p.select("chrom", "pos").distinct().withColumn("anc", F.get(F.array(*(F.lit(b) for b in "ACGT")), (F.col("pos") % 4).cast("int")))
    return rounded(P.substitution_matrix(p, anc), "rate")


@query("SELECT 'C' || CAST(c_custkey AS VARCHAR) AS sample_id FROM customer WHERE c_custkey % 1000 BETWEEN 100 AND 600 AND c_acctbal BETWEEN 0 AND 5000")
def geo_filter(spark: SparkSession, d: str) -> DataFrame:
    return located(spark, d)[0].select("sample_id")


def located(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = V.table(spark, d, "customer").select((F.col("c_custkey") % 1000).cast("double").alias("long"), F.col("c_acctbal").alias("lat"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("sample_id"), "c_custkey")
    box = spark.createDataFrame([(100.0, 0.0), (600.0, 5000.0)], "long double, lat double")
    dist = c.select(F.col("sample_id").alias("sample_i"), F.explode(F.array("sample_id", F.concat(F.lit("C"), (F.col("c_custkey") + 1).cast("string")))).alias("sample_j"), F.col("lat").alias("value"))
    return P.geo_filter(c.drop("c_custkey"), box, dist)


@query("""WITH k AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 1000 BETWEEN 100 AND 600 AND c_acctbal BETWEEN 0 AND 5000)
SELECT 'C' || CAST(a.c_custkey AS VARCHAR) AS sample_i, 'C' || CAST(b.c_custkey AS VARCHAR) AS sample_j, a.c_acctbal AS value FROM k a JOIN k b ON b.c_custkey IN (a.c_custkey, a.c_custkey + 1)""")
def geo_filter_distances(spark: SparkSession, d: str) -> DataFrame:
    """The distances between the samples inside the box."""
    return located(spark, d)[1]


@query(V.with_views("s", body="SELECT chrom, pos, chrom || '_' || CAST(CAST(floor((row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1) / 25) AS BIGINT) AS VARCHAR) AS \"window\" FROM s"))
def genome_windows(spark: SparkSession, d: str) -> DataFrame:
    return P.genome_windows(V.sites(spark, d).select("chrom", "pos"), "snp", 25)


@query(V.with_views("g", "s", "pop", body="SELECT chrom, pos, sample_id FROM g WHERE sample_id IN (SELECT sample_id FROM pop WHERE pop = 'P1') AND (chrom, pos) IN (SELECT (chrom, pos) FROM s WHERE type = 'SNP')"))
def subset_gl(spark: SparkSession, d: str) -> DataFrame:
    return P.subset_gl(likelihoods(spark, d), V.popmap(spark, d).where("pop = 'P1'"), V.sites(spark, d).where("type = 'SNP'")).select("chrom", "pos", "sample_id")


@query(V.with_views("pop", body="@n AS (SELECT row_number() OVER (ORDER BY sample_id) AS k, sample_id FROM pop) SELECT a.sample_id AS sample_i, b.sample_id AS sample_j FROM n a JOIN n b ON a.k = b.k - 1"))
def rename_pair_ids(spark: SparkSession, d: str) -> DataFrame:
    index = V.popmap(spark, d).selectExpr("row_number() over (partition by 0 order by sample_id) as number", "sample_id")
    return P.rename_pair_ids(index.select(F.col("number").alias("i"), (F.col("number") + 1).alias("j")), index)


@query()
def recursive_bipartition(spark: SparkSession, d: str) -> DataFrame:
    return P.recursive_bipartition(likelihoods(spark, d))


@query()
def admixture_em(spark: SparkSession, d: str) -> DataFrame:
    return P.admixture_em(likelihoods(spark, d), 2, 1, 1, tolerance=1e-4)[0]


# spectra

SITE = "st AS (SELECT chrom, pos, sum(dosage) AS ac, 2 * count(dosage) AS an FROM g GROUP BY 1, 2 HAVING count(dosage) > 0)"
TERMS = "tm AS (SELECT chrom, pos, 2.0 * ac * (an - ac) / (an * (an - 1)) AS pi, CASE WHEN ac > 0 AND ac < an THEN 1 ELSE 0 END AS seg, CASE WHEN ac > 0 AND ac < an THEN 1 ELSE 0 END / (SELECT sum(1.0 / i) FROM range(1, 100) r(i) WHERE i < an) AS theta_w FROM st)"


@query(V.with_views("g", body=f"@{SITE} SELECT CAST(least(ac, an - ac) AS BIGINT) AS bin, an, count(*) AS n FROM st GROUP BY 1, 2"))
def sfs_1d(spark: SparkSession, d: str) -> DataFrame:
    return X.sfs_1d(V.genotypes(spark, d))


@query(V.with_views("g", body=f"""@{SITE}, b AS (SELECT ac AS bin, count(*) AS n FROM st GROUP BY 1), z AS (SELECT CAST(max(bin) AS DOUBLE) AS c FROM b),
t AS (SELECT sum(n * 2 * bin * (c - bin) / (c * (c - 1))) AS pi, sum(CASE WHEN bin > 0 AND bin < c THEN n ELSE 0 END) AS S, sum(n) AS n_sites, sum(CASE WHEN bin = 1 THEN n ELSE 0 END) AS e, max(c) AS c FROM b CROSS JOIN z),
a AS (SELECT *, list_sum(list_transform(range(1, CAST(c AS BIGINT)), lambda i: 1.0 / i)) AS a1, list_sum(list_transform(range(1, CAST(c AS BIGINT)), lambda i: 1.0 / (i * i))) AS a2 FROM t),
k AS (SELECT *, (c + 1) / (3 * (c - 1)) - 1 / a1 AS c1, 2 * (c * c + c + 3) / (9 * c * (c - 1)) - (c + 2) / (a1 * c) + a2 / (a1 * a1) AS c2, 1 + a1 * a1 / (a2 + a1 * a1) * (2 * (c * a1 - 2 * (c - 1)) / ((c - 1) * (c - 2)) - (c + 1) / (c - 1)) AS v FROM a)
SELECT round(pi, 6) AS pi, round(S / a1, 6) AS theta_w, CAST(S AS BIGINT) AS S, CAST(n_sites AS BIGINT) AS n_sites, round((pi - S / a1) / sqrt(c1 / a1 * S + c2 / (a1 * a1 + a2) * S * (S - 1)), 6) AS tajima_d, round((S - a1 * e) / sqrt((a1 - 1 - v) * S + v * S * S), 6) AS fu_li_d FROM k"""))
def sfs_stats(spark: SparkSession, d: str) -> DataFrame:
    s = X.sfs_1d(V.genotypes(spark, d), folded=False)
    return rounded(X.sfs_stats(s.groupBy("bin").agg(F.sum("n").alias("n"))), "pi", "theta_w", "tajima_d", "fu_li_d")


@query(V.with_views("g", body=f"@{SITE}, {TERMS}, bk AS (SELECT *, ntile(10) OVER (PARTITION BY chrom ORDER BY pos) AS block FROM tm), o AS (SELECT chrom, block, sum(pi) AS pi, sum(theta_w) AS theta_w, sum(seg) AS S, count(*) AS n_sites FROM bk GROUP BY 1, 2), w AS (SELECT sum(pi) AS p, sum(S) AS q FROM o) SELECT chrom, CAST(block AS INT) AS block, round(pi, 5) AS pi, round(theta_w, 5) AS theta_w, CAST(S AS BIGINT) AS S, n_sites, round(p - pi, 5) AS pi_without, CAST(q - S AS BIGINT) AS S_without FROM o CROSS JOIN w"))
def sfs_blocks(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.sfs_blocks(V.genotypes(spark, d), 10), "pi", "theta_w", "pi_without", digits=5)


@query(V.with_views("g", body=f"@{SITE}, {TERMS}, w AS (SELECT *, unnest(range(CAST(greatest(0, ceil((pos - 1 - 9999) / 5000)) AS BIGINT), CAST(floor((pos - 1) / 5000) AS BIGINT) + 1)) AS k FROM tm) SELECT chrom, k * 5000 AS start, round(sum(pi), 5) AS pi, round(sum(theta_w), 5) AS theta_w, CAST(sum(seg) AS BIGINT) AS S, count(*) AS n_sites FROM w GROUP BY 1, 2"))
def windowed_theta(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.windowed_theta(V.genotypes(spark, d), 10_000, 5_000), "pi", "theta_w", digits=5)


TWO = "tp AS (SELECT chrom, pos, sum(CASE WHEN pop = 'P0' THEN dosage END) AS ac1, sum(CASE WHEN pop = 'P0' THEN 2 END) AS an1, sum(CASE WHEN pop = 'P1' THEN dosage END) AS ac2, sum(CASE WHEN pop = 'P1' THEN 2 END) AS an2 FROM g JOIN pop USING (sample_id) WHERE pop IN ('P0', 'P1') GROUP BY 1, 2 HAVING sum(CASE WHEN pop = 'P0' THEN 2 END) > 0 AND sum(CASE WHEN pop = 'P1' THEN 2 END) > 0)"
FST = "ft AS (SELECT chrom, pos, power(ac1 / an1 - ac2 / an2, 2) AS f2, power(ac1 / an1 - ac2 / an2, 2) - ac1 / an1 * (1 - ac1 / an1) / (an1 - 1) - ac2 / an2 * (1 - ac2 / an2) / (an2 - 1) AS num, ac1 / an1 * (1 - ac2 / an2) + ac2 / an2 * (1 - ac1 / an1) AS dxy, CASE WHEN ac1 + ac2 > 0 AND ac1 + ac2 < an1 + an2 THEN 1 ELSE 0 END AS seg FROM tp WHERE an1 > 1 AND an2 > 1)"


@query(V.with_views("g", "pop", body=f"@{TWO} SELECT CAST(ac1 AS BIGINT) AS i, CAST(ac2 AS BIGINT) AS j, CAST(count(*) AS DOUBLE) AS n FROM tp GROUP BY 1, 2"))
def sfs_2d(spark: SparkSession, d: str) -> DataFrame:
    return X.sfs_2d(V.genotypes(spark, d), V.popmap(spark, d), "P0", "P1")


@query(V.with_views("g", "pop", body=f"""@{TWO}, x AS (SELECT *, unnest(range(0, 5)) AS i FROM tp WHERE an1 >= 4 AND an2 >= 4), y AS (SELECT *, unnest(range(0, 5)) AS j FROM x),
w AS (SELECT i, j, CASE WHEN i <= ac1 AND 4 - i <= an1 - ac1 AND j <= ac2 AND 4 - j <= an2 - ac2 THEN exp({" + ".join(f"lgamma(ac{n} + 1) - lgamma({k} + 1) - lgamma(ac{n} - {k} + 1) + lgamma(an{n} - ac{n} + 1) - lgamma(4 - {k} + 1) - lgamma(an{n} - ac{n} - 4 + {k} + 1) - lgamma(an{n} + 1) + lgamma(5) + lgamma(an{n} - 3)" for n, k in ((1, "i"), (2, "j")))}) ELSE 0 END AS w FROM y)
SELECT CAST(CASE WHEN i + j > 4 THEN 4 - i ELSE i END AS INT) AS i, CAST(CASE WHEN i + j > 4 THEN 4 - j ELSE j END AS INT) AS j, round(sum(w), 6) AS n FROM w GROUP BY 1, 2"""))
def sfs_2d_projected(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.sfs_2d(V.genotypes(spark, d), V.popmap(spark, d), "P0", "P1", True, (4, 4)), "n")


@query(V.with_views("g", "pop", body=f"@{TWO}, {FST} SELECT round(avg(f2), 6) AS f2, round(sum(num) / sum(dxy), 6) AS fst, round(avg(dxy), 6) AS dxy, CAST(sum(seg) AS BIGINT) AS S, count(*) AS n_sites FROM ft"))
def sfs_2d_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.sfs_2d_stats(V.genotypes(spark, d), V.popmap(spark, d), "P0", "P1"), "f2", "fst", "dxy")


@query(V.with_views("g", "pop", body=f"@{TWO}, {FST}, w AS (SELECT *, unnest(range(CAST(greatest(0, ceil((pos - 1 - 19999) / 10000)) AS BIGINT), CAST(floor((pos - 1) / 10000) AS BIGINT) + 1)) AS k FROM ft) SELECT chrom, k * 10000 AS start, round(sum(num) / sum(dxy), 6) AS fst, count(*) AS n_sites FROM w GROUP BY 1, 2"))
def windowed_fst(spark: SparkSession, d: str) -> DataFrame:
    return rounded(X.windowed_fst(V.genotypes(spark, d), V.popmap(spark, d), "P0", "P1", 20_000, 10_000), "fst")


@query()
def site_allele_likelihood(spark: SparkSession, d: str) -> DataFrame:
    """Every entry of every site's likelihoods."""
    saf = S.site_allele_likelihood(likelihoods(spark, d)).select("chrom", "pos", F.posexplode("saf").alias("n_derived", "likelihood"))
    return rounded(saf, "likelihood")


@query()
def sfs_2d_em(spark: SparkSession, d: str) -> DataFrame:
    return rounded(S.sfs_2d_em(likelihoods(spark, d), V.popmap(spark, d), "P0", "P1"), "n", digits=4)


@query()
def sfs_em(spark: SparkSession, d: str) -> DataFrame:
    return X.sfs_em(S.site_allele_likelihood(likelihoods(spark, d)))


@query()
def ld_prune(spark: SparkSession, d: str) -> DataFrame:
    pairs = L.ld_r2_pairs(V.genotypes(spark, d), 1000)
    return L.ld_prune(pairs, V.sites(spark, d).select("chrom", "pos", F.col("size").alias("priority")), 0.2)


@query()
def admixture_residual_corr(spark: SparkSession, d: str) -> DataFrame:
    gl = likelihoods(spark, d)
    q, f, _ = P.admixture_em(gl, 2, 1, 1, tolerance=1e-4)
    return P.admixture_residual_corr(gl.withColumnRenamed("gl", "gp"), q, f)


@query(V.with_views("seq", body="SELECT CAST(sum(length) AS BIGINT) AS n_sites, round(1 - sum(length - length(replace(seq, 'N', ''))) / sum(length), 6) AS not_n FROM seq"))
def covered_n_share(spark: SparkSession, d: str) -> DataFrame:
    s = V.sequences(spark, d)
    every = s.where("length > 0").select(F.col("contig").alias("chrom"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    return rounded(K.covered_n_share(s, every), "not_n")

# distributions and tests


@query(V.with_views("s", "g", body="""@per AS (SELECT chrom, pos, sum(dosage) / (2 * count(dosage)) AS af, sum(dp) AS dp FROM g GROUP BY 1, 2), j AS (SELECT s.*, af, per.dp AS depth FROM s LEFT JOIN per ON s.chrom = per.chrom AND s.pos = per.pos)
SELECT 'AF' AS measure, CAST(floor(round(af * 100, 6)) AS BIGINT) AS bin, count(*) AS n FROM j WHERE af IS NOT NULL GROUP BY 2 UNION ALL SELECT 'QUAL', CAST(floor(qual) AS BIGINT), count(*) FROM j WHERE qual IS NOT NULL GROUP BY 2
UNION ALL SELECT 'DP', CAST(depth AS BIGINT), count(*) FROM j WHERE depth IS NOT NULL GROUP BY 2 UNION ALL SELECT 'INDEL', CAST(length(alt[1]) - length(ref) AS BIGINT), count(*) FROM j WHERE type = 'INDEL' AND alt[1] IS NOT NULL GROUP BY 2"""))
def site_distributions(spark: SparkSession, d: str) -> DataFrame:
    return Q.site_distributions(V.sites(spark, d), V.genotypes(spark, d))


@query(f"WITH {RD}, c AS (SELECT unnest(range(1, length(seq) + 1)) AS cycle, upper(seq) AS seq FROM rd) SELECT cycle, CASE WHEN substr(seq, cycle, 1) IN ('A', 'C', 'G', 'T') THEN substr(seq, cycle, 1) ELSE 'N' END AS base, count(*) AS n FROM c GROUP BY 1, 2")
def base_composition(spark: SparkSession, d: str) -> DataFrame:
    return R.base_composition(reads(spark, d))


@query(V.with_views("dna", body="""@w AS (SELECT contig, unnest(range(0, length(seq) // 50)) AS bin, seq FROM dna), gw AS (SELECT contig, bin, floor(100 * (50 - length(translate(substr(seq, bin * 50 + 1, 50), 'GC', ''))) / 50) AS gc FROM w), st AS (SELECT 'd' || CAST(event_id % 1000 AS VARCHAR) AS contig, CAST(floor(value * 7) AS BIGINT) // 50 AS bin, count(*) AS r FROM events GROUP BY 1, 2),
b AS (SELECT gc, count(*) AS windows, coalesce(sum(r), 0) AS reads FROM gw LEFT JOIN st USING (contig, bin) GROUP BY 1) SELECT CAST(gc AS BIGINT) AS gc, windows, CAST(reads AS BIGINT) AS reads, round(reads / windows / (SELECT sum(reads) / sum(windows) FROM b), 6) AS normalised FROM b"""))
def gc_bias(spark: SparkSession, d: str) -> DataFrame:
    aln = V.table(spark, d, "events").select(F.concat(F.lit("d"), (F.col("event_id") % 1000).cast("string")).alias("chrom"), F.floor(F.col("value") * 7).alias("start"), F.lit(0).alias("flag"))
    return rounded(R.gc_bias(aln, K.gc_windows(V.dna(spark, d), 50), 50), "normalised")


@query(V.with_views("reads_at", body="""@a AS (SELECT sample_id, ['A', 'C', 'G', 'T'][CAST(pos % 4 AS INT) + 1] AS anc, upper(allele) AS base, CAST(sum(fwd + rev) AS BIGINT) AS n FROM reads_at WHERE upper(allele) <> 'AT' GROUP BY 1, 2, 3), m AS (SELECT *, n / sum(n) OVER (PARTITION BY sample_id, anc) AS rate FROM a), sn AS (SELECT sample_id, anc, sum(n) AS k FROM m GROUP BY 1, 2), bs AS (SELECT DISTINCT base FROM m),
x AS (SELECT sn.sample_id, sn.anc, bs.base, k, coalesce(m.rate, 0) - coalesce(p.rate, 0) AS excess FROM sn JOIN bs ON bs.base <> sn.anc LEFT JOIN m ON m.sample_id = sn.sample_id AND m.anc = sn.anc AND m.base = bs.base LEFT JOIN m p ON p.sample_id = 'S0' AND p.anc = sn.anc AND p.base = bs.base), e AS (SELECT sample_id, sum(excess * k) AS s FROM x GROUP BY 1), w AS (SELECT sample_id, sum(k) AS t FROM sn GROUP BY 1)
SELECT sample_id, round(s / t, 6) AS error, anc, base, round(excess, 6) AS excess FROM x JOIN e USING (sample_id) JOIN w USING (sample_id)"""))
def error_from_excess(spark: SparkSession, d: str) -> DataFrame:
    base = F.upper("allele")
    p = V.allele_reads(spark, d).where(base != "AT").select(F.lit("m").alias("chrom"), "pos", "sample_id", base.alias("base"), (F.col("fwd") + F.col("rev")).alias("n"))
    anc = p.select("chrom", "pos").distinct().withColumn("anc", F.get(F.array(*(F.lit(b) for b in "ACGT")), (F.col("pos") % 4).cast("int")))
    return rounded(P.error_from_excess(P.substitution_matrix(p, anc), "S0"), "error", "excess")


@query(V.with_views("g", body=f"@{SITE}, bk AS (SELECT *, ntile(10) OVER (PARTITION BY chrom ORDER BY pos) AS block FROM st) SELECT chrom, CAST(block AS INT) AS block, CAST(least(ac, an - ac) AS BIGINT) AS bin, an, count(*) AS n FROM bk GROUP BY 1, 2, 3, 4"))
def sfs_block_spectra(spark: SparkSession, d: str) -> DataFrame:
    return X.sfs_block_spectra(V.genotypes(spark, d), 10)


@query(V.with_views("g", body="""@c AS (SELECT chrom, pos, CAST(count(*) FILTER (dosage = 0) AS DOUBLE) AS a, CAST(count(*) FILTER (dosage = 1) AS DOUBLE) AS b, CAST(count(*) FILTER (dosage = 2) AS DOUBLE) AS c FROM g WHERE dosage IS NOT NULL GROUP BY 1, 2), f AS (SELECT *, a + b + c AS n, (b + 2 * c) / (2 * (a + b + c)) AS p FROM c)
SELECT chrom, pos, round(1 - b / n / (2 * p * (1 - p)), 6) AS F, round(greatest(0, 2 * (CASE WHEN a > 0 THEN a * ln(a / n / ((1 - p) * (1 - p))) ELSE 0 END + CASE WHEN b > 0 THEN b * ln(b / n / (2 * p * (1 - p))) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(c / n / (p * p)) ELSE 0 END)), 6) AS lr FROM f WHERE p > 0 AND p < 1"""))
def site_inbreeding_ratio(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.site_inbreeding_ratio(V.genotypes(spark, d)), "F", "lr")
