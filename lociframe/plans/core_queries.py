"""Queries over intervals, table steps and filters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators import chunking as C
from lociframe.operators import dataflow as D
from lociframe.operators import filters as Q
from lociframe.operators import intervals as I
from lociframe.operators import ld as L
from lociframe.operators.params import FilterParams, TypeThresholds
from lociframe.plans import views as V
from lociframe.plans.registry import query

ISLANDS = """marked AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}),
numbered AS (SELECT *, sum(CASE WHEN reach IS NULL OR start - reach > {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM marked)"""


def merged_sql(src: str, gap: int = 0, name: str = "merged") -> str:
    return ISLANDS.format(src=src, gap=gap) + f""", {name} AS (SELECT chrom, min(start) AS start, max("end") AS "end" FROM numbered GROUP BY chrom, island)"""


AB = """a AS (SELECT * FROM iv WHERE label IN ('L0', 'L1')), b AS (SELECT * FROM iv WHERE label IN ('L2', 'L3'))"""


@query(V.with_views("contigs", body="SELECT chrom, start, \"end\", label, weight FROM iv"))
def interval_sort(spark: SparkSession, d: str) -> DataFrame:
    return I.sort_genome_order(V.intervals(spark, d), V.contigs(spark, d))


@query(V.with_views("iv", body="@" + ISLANDS.format(src="iv", gap=100) + """ SELECT chrom, min(start) AS start, max("end") AS "end", CAST(sum(weight) AS BIGINT) AS weight, string_agg(DISTINCT label, ',' ORDER BY label) AS label, count(*) AS n FROM numbered GROUP BY chrom, island"""))
def interval_merge(spark: SparkSession, d: str) -> DataFrame:
    return I.merge(V.intervals(spark, d), 100, {"weight": F.sum("weight"), "label": I.distinct_labels(), "n": F.count(F.lit(1))})


@query(V.with_views("iv", body="@" + AB + ", " + merged_sql("b", 0, "mb") + """, cuts AS (SELECT a.chrom, a.start AS s0, a."end" AS e0, a.label, a.weight, greatest(mb.start, a.start) AS cs, least(mb."end", a."end") AS ce FROM (SELECT DISTINCT * FROM a) a JOIN mb ON a.chrom = mb.chrom AND a.start < mb."end" AND mb.start < a."end"),
pieces AS (SELECT chrom, s0, e0, label, weight, coalesce(lag(ce) OVER w, s0) AS start, cs AS "end" FROM cuts WINDOW w AS (PARTITION BY chrom, s0, e0, label, weight ORDER BY cs) UNION ALL SELECT chrom, s0, e0, label, weight, max(ce), e0 FROM cuts GROUP BY 1, 2, 3, 4, 5
 UNION ALL SELECT chrom, start, "end", label, weight, start, "end" FROM (SELECT DISTINCT * FROM a) a WHERE NOT EXISTS (SELECT 1 FROM mb WHERE mb.chrom = a.chrom AND a.start < mb."end" AND mb.start < a."end"))
SELECT p.chrom, p.start, p."end", p.label, p.weight FROM pieces p WHERE p.start < p."end" """))
def interval_subtract(spark: SparkSession, d: str) -> DataFrame:
    a, b = V.split_intervals(spark, d)
    return I.subtract(a.distinct(), b)


@query(V.with_views("iv", body="@" + AB + """ SELECT a.chrom, count(*) AS pairs, CAST(sum(least(a."end", b."end") - greatest(a.start, b.start)) AS BIGINT) AS overlap FROM a JOIN b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" GROUP BY 1"""))
def interval_intersect(spark: SparkSession, d: str) -> DataFrame:
    a, b = V.split_intervals(spark, d)
    return I.intersect_wo(a, b).groupBy("chrom").agg(F.count(F.lit(1)).alias("pairs"), F.sum("overlap").alias("overlap"))


HIT = """EXISTS (SELECT 1 FROM b WHERE b.chrom = a.chrom AND a.start < b."end" AND b.start < a."end")"""


@query(V.with_views("iv", body="@" + AB + f" SELECT * FROM a WHERE {HIT}"))
def interval_overlap_semi(spark: SparkSession, d: str) -> DataFrame:
    return I.overlap_semi(*V.split_intervals(spark, d))


@query(V.with_views("iv", body="@" + AB + f" SELECT * FROM a WHERE NOT {HIT}"))
def interval_overlap_anti(spark: SparkSession, d: str) -> DataFrame:
    return I.overlap_anti(*V.split_intervals(spark, d))


@query(V.with_views("contigs", body="@" + merged_sql("iv") + """, edges AS (SELECT chrom, start, "end" FROM merged UNION ALL SELECT contig, length, length FROM contigs),
gaps AS (SELECT chrom, coalesce(max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, start AS "end" FROM edges) SELECT * FROM gaps WHERE "end" > start"""))
def interval_complement(spark: SparkSession, d: str) -> DataFrame:
    return I.complement(V.intervals(spark, d), V.contigs(spark, d))


@query(V.with_views("contigs", body="""SELECT chrom, greatest(0, start - 500) AS start, least(length, "end" + 500) AS "end", label, weight FROM iv JOIN contigs ON chrom = contig"""))
def interval_slop(spark: SparkSession, d: str) -> DataFrame:
    return I.slop(V.intervals(spark, d), 500, V.contigs(spark, d))


@query(V.with_views("iv", body="@" + AB + """, u AS (SELECT DISTINCT chrom, start, "end" FROM a) SELECT a.chrom, a.start, a."end", CAST(sum(b.weight) AS BIGINT) AS weight FROM u a JOIN b ON a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" GROUP BY 1, 2, 3"""))
def interval_map_sum(spark: SparkSession, d: str) -> DataFrame:
    a, b = V.split_intervals(spark, d)
    return I.map_sum(a.select("chrom", "start", "end").distinct(), b)


@query(V.with_views("iv", body="""SELECT chrom, unnest(range(start, "end", 1000)) AS start, least(start + 1000 * generate_subscripts(range(start, "end", 1000), 1), "end") AS "end" FROM iv"""))
def interval_windows(spark: SparkSession, d: str) -> DataFrame:
    return I.make_windows(V.intervals(spark, d).select("chrom", "start", "end"), 1000)


MASK = """mask AS (SELECT chrom, pos - 50 AS start, pos + 2950 AS "end" FROM s WHERE pos % 11 = 0)"""


def site_mask(spark: SparkSession, d: str) -> DataFrame:
    return V.sites(spark, d).where("pos % 11 = 0").select("chrom", (F.col("pos") - 50).alias("start"), (F.col("pos") + 2950).alias("end"))


@query(V.with_views("s", body="@" + MASK + """ SELECT s.chrom, s.pos, CASE WHEN EXISTS (SELECT 1 FROM mask m WHERE m.chrom = s.chrom AND m.start <= s.pos - 1 AND s.pos - 1 < m."end") THEN 1 ELSE 0 END AS in_mask FROM s"""))
def site_in_mask(spark: SparkSession, d: str) -> DataFrame:
    return I.site_in_mask(V.sites(spark, d).select("chrom", "pos"), site_mask(spark, d))


@query(V.with_views("iv", body="""SELECT label, CAST(sum("end" - start) AS BIGINT) AS bases FROM iv GROUP BY 1"""))
def interval_label_lengths(spark: SparkSession, d: str) -> DataFrame:
    return I.label_lengths(V.intervals(spark, d))


@query(V.with_views("iv", body="""SELECT chrom, min(start) AS start, max("end") AS "end" FROM iv GROUP BY 1"""))
def interval_spans(spark: SparkSession, d: str) -> DataFrame:
    return I.span_by_contig(V.intervals(spark, d))


@query(V.with_views("contigs", body="""SELECT contig AS chrom, CAST(0 AS BIGINT) AS start, length AS "end", CASE WHEN length >= 2500000 THEN 'long' ELSE 'short' END AS class FROM contigs"""))
def contig_classes(spark: SparkSession, d: str) -> DataFrame:
    return I.contig_classes(V.contigs(spark, d), 2_500_000)


@query(V.with_views("contigs", body="SELECT * FROM contigs WHERE contig IN (SELECT chrom FROM iv WHERE weight > 480)"))
def contigs_named(spark: SparkSession, d: str) -> DataFrame:
    return I.restrict_to_contigs(V.contigs(spark, d), V.intervals(spark, d).where("weight > 480"))


@query(V.with_views("s", body="@p AS (SELECT chrom, greatest(0, pos - 1000) AS start, pos + 1000 AS \"end\" FROM s WHERE size = 3), " + merged_sql("p") + " SELECT * FROM merged"))
def windows_around_points(spark: SparkSession, d: str) -> DataFrame:
    return I.windows_around_points(V.sites(spark, d).where("size = 3"), 1000)


@query("""WITH c AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS sample_id, 1000 + s_suppkey * 37 AS n_reads FROM supplier), k AS (SELECT *, greatest(1, (n_reads + 499) // 500) AS parts FROM c),
x AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM k) SELECT sample_id, CAST((part - 1) * 500 + 1 AS BIGINT) AS first, CAST(CASE WHEN part = parts THEN n_reads ELSE part * 500 END AS BIGINT) AS last, CAST(part AS INT) AS part FROM x""")
def read_ranges(spark: SparkSession, d: str) -> DataFrame:
    c = V.table(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_id"), (1000 + F.col("s_suppkey") * 37).alias("n_reads"))
    return I.read_ranges(c, 500)


@query(V.with_views("s", body="""@o AS (SELECT chrom, pos, row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1 AS i, max(pos) OVER (PARTITION BY chrom) AS last FROM (SELECT DISTINCT chrom, pos FROM s)), h AS (SELECT * FROM o WHERE i % 50 = 0)
SELECT chrom, pos AS start, coalesce(lead(pos) OVER (PARTITION BY chrom ORDER BY pos) - 1, last) AS "end" FROM h"""))
def regions_every_n_sites(spark: SparkSession, d: str) -> DataFrame:
    return I.regions_every_n_sites(V.sites(spark, d), 50)


@query(V.with_views("contigs", body="""SELECT count(DISTINCT chrom) AS n_contigs, count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN start = 0 AND "end" = length THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_full, count(*) > 1 AND count(*) = sum(CASE WHEN start = 0 AND "end" = length THEN 1 ELSE 0 END) AS merge_flag FROM iv LEFT JOIN contigs ON chrom = contig"""))
def full_length_check(spark: SparkSession, d: str) -> DataFrame:
    return I.full_length_check(V.intervals(spark, d), V.contigs(spark, d))


@query(V.with_views("iv", body="""SELECT chrom, greatest(0, start - 100) AS start, "end" + 100 AS "end", chrom || ':' || CAST(greatest(0, start - 100) AS VARCHAR) || '-' || CAST("end" + 100 AS VARCHAR) AS region FROM iv"""))
def pad_regions(spark: SparkSession, d: str) -> DataFrame:
    return I.pad_regions(V.intervals(spark, d), 100)


@query(V.with_views("aln", "iv", body="@t AS (SELECT * FROM iv WHERE weight > 300), " + merged_sql("t") + """, p AS (SELECT sample_id, sum(least(a."end", m."end") - greatest(a.start, m.start)) AS n FROM aln a JOIN merged m ON a.chrom = m.chrom AND a.start < m."end" AND m.start < a."end" GROUP BY 1), tot AS (SELECT sum("end" - start) AS n FROM merged)
SELECT sample_id, CAST(coalesce(p.n, 0) AS BIGINT) AS PRESENT_BASES, CAST(tot.n AS BIGINT) AS TARGET_BASES, round(1 - coalesce(p.n, 0) / tot.n, 6) AS MISSING_FRACTION FROM (SELECT DISTINCT sample_id FROM aln) LEFT JOIN p USING (sample_id) CROSS JOIN tot"""))
def missing_fraction(spark: SparkSession, d: str) -> DataFrame:
    out = I.missing_fraction(V.alignments(spark, d).select("sample_id", "chrom", "start", "end"), V.intervals(spark, d).where("weight > 300"))
    return out.withColumn("MISSING_FRACTION", F.round("MISSING_FRACTION", 6))


@query()
def chunks_balanced(spark: SparkSession, d: str) -> DataFrame:
    return C.chunk_balanced(I.merge(V.intervals(spark, d), 0, {"weight": F.sum("weight")}), V.contigs(spark, d), 20_000)


@query(V.with_views("iv", body="@" + merged_sql("iv").replace('max("end") AS "end" FROM numbered', 'max("end") AS "end", sum(weight) AS weight FROM numbered') + """, x AS (SELECT *, coalesce(sum(weight) OVER (ORDER BY chrom, start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(weight) OVER () AS total FROM merged),
k AS (SELECT *, CAST(greatest(1, ceil(total / 20000)) AS BIGINT) AS k, total / greatest(1, ceil(total / 20000)) AS per FROM x), l AS (SELECT *, CAST(least(k - 1, floor((before + 1e-9) / per)) AS BIGINT) AS lo0 FROM k), h AS (SELECT *, CAST(least(k - 1, greatest(lo0, ceil((before + weight) / per - 1e-9) - 1)) AS BIGINT) AS hi0 FROM l),
e AS (SELECT *, unnest(range(lo0, hi0 + 1)) AS chunk FROM h), c AS (SELECT chrom, start, "end", weight, chunk, "end" - start AS len, CASE WHEN chunk = lo0 THEN 0 ELSE floor(("end" - start) * CASE WHEN weight > 0 THEN least(1.0, greatest(0.0, (chunk * per - before) / weight)) ELSE 0 END + 0.5) END AS lo,
CASE WHEN chunk = hi0 THEN "end" - start ELSE floor(("end" - start) * CASE WHEN weight > 0 THEN least(1.0, greatest(0.0, ((chunk + 1) * per - before) / weight)) ELSE 0 END + 0.5) END AS hi FROM e)
SELECT chrom, CAST(start + lo AS BIGINT) AS start, CAST(start + hi AS BIGINT) AS "end", round(weight * (hi - lo) / len, 4) AS weight, chunk FROM c WHERE hi > lo"""))
def chunks_balanced_split(spark: SparkSession, d: str) -> DataFrame:
    cut = C.chunk_balanced_split(I.merge(V.intervals(spark, d), 0, {"weight": F.sum("weight")}), V.contigs(spark, d), 20_000)
    return cut.withColumn("weight", F.round("weight", 4))


@query()
def interval_pipeline(spark: SparkSession, d: str) -> DataFrame:
    iv = V.intervals(spark, d)
    return C.interval_pipeline(iv.where("label <> 'L0'"), V.contigs(spark, d), iv.where("label = 'L0'"), 50_000, 100)


# table steps


@query(V.with_views("pop", body="SELECT pop, string_agg(sample_id, ',' ORDER BY sample_id) AS samples FROM pop GROUP BY 1"))
def group_tuple(spark: SparkSession, d: str) -> DataFrame:
    return D.group_tuple(V.popmap(spark, d), ["pop"]).select("pop", F.array_join("sample_id", ",").alias("samples"))


@query(V.with_views("g", "pop", body="SELECT pop, count(*) AS n FROM g JOIN pop USING (sample_id) GROUP BY 1"))
def join_by(spark: SparkSession, d: str) -> DataFrame:
    return D.join_by(V.genotypes(spark, d), V.popmap(spark, d), ["sample_id"]).groupBy("pop").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("contigs", "pop", body="SELECT sample_id, contig, length FROM pop CROSS JOIN contigs"))
def combine(spark: SparkSession, d: str) -> DataFrame:
    return D.combine(V.popmap(spark, d), V.contigs(spark, d)).select("sample_id", "contig", "length")


@query(V.with_views("pop", body="SELECT a.pop, a.sample_id AS sample_id, b.sample_id AS other FROM pop a JOIN pop b USING (pop)"))
def combine_by(spark: SparkSession, d: str) -> DataFrame:
    p = V.popmap(spark, d)
    return D.combine_by(p, p.withColumnRenamed("sample_id", "other"), ["pop"]).select("pop", "sample_id", "other")


@query(V.with_views("pop", body="SELECT * FROM pop WHERE sample_id NOT IN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey < 10)"))
def not_done(spark: SparkSession, d: str) -> DataFrame:
    done = V.table(spark, d, "supplier").where("s_suppkey < 10").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_id"))
    return D.not_done(V.popmap(spark, d), done, ["sample_id"]).select("sample_id", "pop")


@query(V.with_views("iv", body="SELECT label, count(*) AS n FROM (SELECT * FROM iv WHERE weight > 100 UNION ALL SELECT * FROM iv WHERE weight > 300) GROUP BY 1"))
def mix_frames(spark: SparkSession, d: str) -> DataFrame:
    iv = V.intervals(spark, d)
    return D.mix(iv.where("weight > 100"), iv.where("weight > 300")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("iv", body="SELECT label, o AS source_order, count(*) AS n FROM (SELECT *, 0 AS o FROM iv WHERE weight > 100 UNION ALL SELECT *, 1 FROM iv WHERE weight > 300) GROUP BY 1, 2"))
def concat_frames(spark: SparkSession, d: str) -> DataFrame:
    iv = V.intervals(spark, d)
    return D.concat(iv.where("weight > 100"), iv.where("weight > 300")).groupBy("label", "source_order").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("aln", body="SELECT sample_id, rg, qname FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, rg ORDER BY start, qname) AS n FROM aln) WHERE n = 1"))
def distinct_first(spark: SparkSession, d: str) -> DataFrame:
    return D.distinct_first(V.alignments(spark, d), ["sample_id", "rg"], ["start", "qname"]).select("sample_id", "rg", "qname")


@query(V.with_views("aln", body="SELECT DISTINCT sample_id, rg FROM aln"))
def unique_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.unique(V.alignments(spark, d), ["sample_id", "rg"])


@query(V.with_views("contigs", body="SELECT contig, length FROM contigs ORDER BY length DESC, contig"))
def sorted_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.sorted_rows(V.contigs(spark, d), [("length", False), ("contig", True)]).select("contig", "length")


@query(V.with_views("g", body="SELECT count(DISTINCT sample_id) AS cohort_size FROM g"))
def cohort_size(spark: SparkSession, d: str) -> DataFrame:
    return D.cohort_size(V.genotypes(spark, d))


@query("SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''")
def split_text(spark: SparkSession, d: str) -> DataFrame:
    return D.split_text(V.table(spark, d, "documents").select("doc_id", F.col("text").alias("line")), "line")


@query(V.with_views("pop", body="SELECT pop, sample_id, row_number() OVER (PARTITION BY pop ORDER BY sample_id) AS input_index FROM pop"))
def manifest(spark: SparkSession, d: str) -> DataFrame:
    return D.manifest(V.popmap(spark, d), "sample_id", ["pop"]).select("pop", "sample_id", "input_index")


@query(V.with_views("aln", body="@e AS (SELECT sample_id, rg, CAST(substr(sample_id, 2) AS INT) % 3 + 1 AS n_expected FROM aln) SELECT sample_id, n_expected, count(DISTINCT rg) AS n_parts FROM e GROUP BY 1, 2 HAVING count(DISTINCT rg) = n_expected"))
def counted_groups(spark: SparkSession, d: str) -> DataFrame:
    e = V.alignments(spark, d).select("sample_id", "rg", (F.substring("sample_id", 2, 9).cast("int") % 3 + 1).alias("n_expected"))
    return D.counted_groups(e, "sample_id", "rg", "n_expected")


@query("SELECT sample_id FROM (SELECT DISTINCT 'S' || CAST(s_suppkey % 40 AS VARCHAR) AS sample_id FROM supplier INTERSECT SELECT DISTINCT 'S' || CAST(l_suppkey % 30 AS VARCHAR) FROM lineitem)")
def in_both(spark: SparkSession, d: str) -> DataFrame:
    named = V.table(spark, d, "lineitem").select(F.concat(F.lit("S"), (F.col("l_suppkey") % 30).cast("string")).alias("sample_id"))
    return D.in_both(V.popmap(spark, d), named)


@query("SELECT DISTINCT 'S' || CAST(s_suppkey % 40 AS VARCHAR) AS sample_id FROM supplier EXCEPT SELECT 'S' || CAST(l_suppkey % 30 AS VARCHAR) FROM lineitem")
def only_first(spark: SparkSession, d: str) -> DataFrame:
    named = V.table(spark, d, "lineitem").select(F.concat(F.lit("S"), (F.col("l_suppkey") % 30).cast("string")).alias("sample_id"))
    return D.only_first(V.popmap(spark, d), named)


@query(V.with_views("iv", body="""SELECT chrom, label, start, "end", weight FROM (SELECT *, row_number() OVER (PARTITION BY chrom, label ORDER BY weight DESC, start, "end") AS place FROM iv) WHERE place <= 3"""))
def top_k(spark: SparkSession, d: str) -> DataFrame:
    """The three heaviest intervals of each contig and label."""
    return D.top_k(V.intervals(spark, d), ["chrom", "label"], [("weight", False), ("start", True), ("end", True)], 3).select("chrom", "label", "start", "end", "weight")


@query(V.with_views("iv", body="""SELECT chrom, "end" - start AS length, label || ':' || chrom AS name FROM iv"""))
def map_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.map_rows(V.intervals(spark, d), {"chrom": "chrom", "length": F.col("end") - F.col("start"), "name": "concat(label, ':', chrom)"})


@query(V.with_views("iv", body="SELECT * FROM iv WHERE weight > 250"))
def keep_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.keep(V.intervals(spark, d), "weight > 250")


@query(V.with_views("iv", body="SELECT label, CASE WHEN weight > 400 THEN 'heavy' WHEN weight > 100 THEN 'middle' ELSE 'light' END AS branch, count(*) AS n FROM iv GROUP BY 1, 2"))
def branch(spark: SparkSession, d: str) -> DataFrame:
    parts = D.branch(V.intervals(spark, d), {"heavy": "weight > 400", "middle": "weight > 100", "light": "true"})
    return D.mix(*(p.withColumn("branch", F.lit(name)) for name, p in parts.items())).groupBy("label", "branch").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("pop", body="SELECT pop, count(*) AS n FROM pop GROUP BY 1"))
def if_empty(spark: SparkSession, d: str) -> DataFrame:
    """An empty table gives way to its default, another does not."""
    p = V.popmap(spark, d)
    return D.if_empty(D.if_empty(p.where("pop = 'nowhere'"), p), p.limit(0)).groupBy("pop").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("pop", body="SELECT pop, string_agg(sample_id, ',' ORDER BY sample_id) AS samples FROM pop GROUP BY 1"))
def collect_list_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.collect_list_rows(V.popmap(spark, d), "sample_id", ["pop"]).select("pop", F.array_join("sample_id", ",").alias("samples"))


# filters

MASKED = "m AS (SELECT chrom, pos, sample_id, dp, gq, CASE WHEN coalesce(gq < 3, false) OR coalesce(dp < 1, false) OR coalesce(dp > 100, false) THEN NULL ELSE dosage END AS dosage FROM g)"
MISSING = "miss AS (SELECT sample_id AS SAMPLE, count(dosage) AS PRESENT_BASES, (SELECT count(*) FROM s) AS TARGET_BASES, ((SELECT count(*) FROM s) - count(dosage)) / (SELECT count(*) FROM s) AS MISSING_FRACTION FROM m GROUP BY 1)"
POPS = ["P0", "P1", "P2", "P3"]
#: Settings under which every test fails some site of the driver tables.
SITE_PARAMS = FilterParams(
    gq=3, gt_dp_min=1, gt_dp_max=100, sample_max_missing=0.95, dp_percentile_lower=2.0, dp_percentile_upper=97.0, dist_indel_snp=200, dist_indel_indel=200, pop_min_n=3, pop_fail_mode="ANY",
    types={k: TypeThresholds(qual=20, dp_min=480, eh=0.4, hwe=0.004, maf=0.27, ns=16, cr=0.4, pop_eh=0.4, pop_hwe=0.02, pop_maf=0.01, pop_ns=1, pop_cr=0.12) for k in ("SNP", "INDEL")},
)


def hwe_sql(src: str, name: str = "hw") -> str:
    """Common table expressions that end in `name` (n0, n1, n2, HWE, ExcHet) for the triples of `src`."""
    return f"""{name}_t AS (SELECT DISTINCT n0, n1, n2, n0 + n1 + n2 AS n, least(2 * n0 + n1, 2 * n2 + n1) AS rare FROM {src}),
{name}_h AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS h FROM {name}_t),
{name}_l AS (SELECT *, lgamma(n + 1) - lgamma((rare - h) // 2 + 1) - lgamma(h + 1) - lgamma(n - (rare + h) // 2 + 1) + h * ln(2) AS lp FROM {name}_h),
{name}_w AS (SELECT *, exp(lp - max(lp) OVER (PARTITION BY n0, n1, n2)) AS w FROM {name}_l), {name}_x AS (SELECT *, max(CASE WHEN h = n1 THEN w END) OVER (PARTITION BY n0, n1, n2) AS here FROM {name}_w),
{name} AS (SELECT n0, n1, n2, least(1, sum(CASE WHEN w <= here * (1 + 1e-9) THEN w ELSE 0 END) / sum(w)) AS HWE, least(1, sum(CASE WHEN h >= n1 THEN w ELSE 0 END) / sum(w)) AS ExcHet FROM {name}_x GROUP BY 1, 2, 3)"""


def in_pops(metric: str, low: float, mode: str = "ANY") -> str:
    """Any (or every) population of three samples or more has the metric below `low`; false without one."""
    each = [f"(q.n_{p} IS NOT NULL AND coalesce({metric}_{p} < {low}, false))" if mode == "ANY" else f"(q.n_{p} IS NULL OR coalesce({metric}_{p} < {low}, false))" for p in POPS]
    return "(" + (" OR " if mode == "ANY" else " AND ").join(each) + ")"


GENOTYPES = [(p, d) for p in POPS for d in (0, 1, 2)]
TAGS = f"""kept AS (SELECT SAMPLE AS sample_id FROM miss WHERE MISSING_FRACTION < 0.95), grp AS (SELECT sample_id, regexp_replace(pop, '[\\s_]', '', 'g') AS pop FROM pop WHERE sample_id IN (SELECT sample_id FROM kept)),
q AS (SELECT count(*) AS n, {", ".join(f"CASE WHEN count(*) FILTER (pop = '{p}') >= 3 THEN count(*) FILTER (pop = '{p}') END AS n_{p}" for p in POPS)} FROM grp),
cnt AS (SELECT m.chrom, m.pos, CAST(sum(dp) AS BIGINT) AS DP, {", ".join(f"count(*) FILTER (grp.pop IS NOT NULL AND dosage = {d}) AS n{d}" for d in (0, 1, 2))}, {", ".join(f"count(*) FILTER (grp.pop = '{p}' AND dosage = {d}) AS n{d}_{p}" for p, d in GENOTYPES)} FROM m LEFT JOIN grp USING (sample_id) GROUP BY 1, 2),
deep AS (SELECT s.*, cnt.* EXCLUDE (chrom, pos) FROM s LEFT JOIN cnt USING (chrom, pos)), dh AS (SELECT coalesce(DP, 0) AS depth, count(*) AS k FROM deep GROUP BY 1), dc AS (SELECT depth, sum(k) OVER (ORDER BY depth) AS cum, sum(k) OVER () AS total FROM dh),
bnd AS (SELECT min(CASE WHEN cum >= greatest(1, ceil(0.02 * total)) THEN depth END) AS DPlower, min(CASE WHEN cum >= greatest(1, ceil(0.97 * total)) THEN depth END) AS DPupper FROM dc),
two AS (SELECT * FROM deep WHERE len(alt) = 1 AND n0 IS NOT NULL),
trip AS (SELECT n0, n1, n2 FROM two {" ".join(f"UNION ALL SELECT n0_{p}, n1_{p}, n2_{p} FROM two" for p in POPS)}), {hwe_sql("trip")},
tags AS (SELECT two.*, CAST(two.n1 + 2 * two.n2 AS BIGINT) AS AC, 2 * (two.n0 + two.n1 + two.n2) AS AN, two.n0 + two.n1 + two.n2 AS NS, CASE WHEN two.n0 + two.n1 + two.n2 > 0 THEN least((two.n1 + 2 * two.n2) / (2 * (two.n0 + two.n1 + two.n2)), 1 - (two.n1 + 2 * two.n2) / (2 * (two.n0 + two.n1 + two.n2))) END AS MAF,
  1 - (two.n0 + two.n1 + two.n2) / q.n AS F_MISSING, (two.n0 + two.n1 + two.n2) / q.n AS CR, hw.HWE, hw.ExcHet,
  {", ".join(f"two.n0_{p} + two.n1_{p} + two.n2_{p} AS NS_{p}, (two.n0_{p} + two.n1_{p} + two.n2_{p}) / q.n_{p} AS CR_{p}, CASE WHEN two.n0_{p} + two.n1_{p} + two.n2_{p} > 0 THEN least((two.n1_{p} + 2 * two.n2_{p}) / (2 * (two.n0_{p} + two.n1_{p} + two.n2_{p})), 1 - (two.n1_{p} + 2 * two.n2_{p}) / (2 * (two.n0_{p} + two.n1_{p} + two.n2_{p}))) END AS MAF_{p}, h{p}.HWE AS HWE_{p}, h{p}.ExcHet AS ExcHet_{p}" for p in POPS)}
  FROM two CROSS JOIN q JOIN hw USING (n0, n1, n2) {" ".join(f"JOIN hw h{p} ON h{p}.n0 = two.n0_{p} AND h{p}.n1 = two.n1_{p} AND h{p}.n2 = two.n2_{p}" for p in POPS)})"""


def filter_sql(mode: str) -> str:
    plain = [("QUAL_FAIL", "qual < 20"), ("DP_MIN_FAIL", "DP < 480"), ("DP_LOWER_PERC_FAIL", "DP < DPlower"), ("DP_UPPER_PERC_FAIL", "DP > DPupper"), ("EH_FAIL", "ExcHet < 0.4"), ("HWE_FAIL", "HWE < 0.004"), ("MAF_FAIL", "MAF < 0.27"), ("NS_FAIL", "NS < 16"), ("CR_FAIL", "CR < 0.4")]
    some = "(" + " OR ".join(f"q.n_{p} IS NOT NULL" for p in POPS) + ")"
    pops = [(f"POP_{n}_FAIL", f"{some} AND {in_pops(m, low, mode)}") for n, m, low in (("EH", "ExcHet", 0.4), ("HWE", "HWE", 0.02), ("MAF", "MAF", 0.01), ("NS", "NS", 1), ("CR", "CR", 0.12))]
    gap = "EXISTS (SELECT 1 FROM two i WHERE i.chrom = t.chrom AND i.type = 'INDEL' {own} AND abs(i.pos - t.pos) <= {d})"
    first = [("SnpGap", "t.type = 'SNP' AND " + gap.format(own="", d=200)), ("IndelGap", "t.type = 'INDEL' AND " + gap.format(own="AND i.pos <> t.pos", d=200)), ("MASK_FAIL", """EXISTS (SELECT 1 FROM gone k WHERE k.chrom = t.chrom AND k.start <= t.pos - 1 AND t.pos - 1 < k."end")""")]
    cases = [f"CASE WHEN {c} THEN '{n}' END" for n, c in first] + [f"CASE WHEN t.type IN ('SNP', 'INDEL') AND {c} THEN '{n}' END" for n, c in plain + pops]
    return f"""gone AS (SELECT chrom, pos - 50 AS start, pos + 350 AS "end" FROM s WHERE pos % 77 = 0), f AS (SELECT t.*, concat_ws(';', {", ".join(cases)}) AS filter FROM tags t CROSS JOIN q CROSS JOIN bnd)"""


FLAGSHIP = f"@{MASKED}, {MISSING}, {TAGS}, {filter_sql('ANY')}"
FLAGSHIP_ALL = f"@{MASKED}, {MISSING}, {TAGS}, {filter_sql('ALL')}"


def filtered(spark: SparkSession, d: str, mode: str = "ANY") -> DataFrame:
    gone = V.sites(spark, d).where("pos % 77 = 0").select("chrom", (F.col("pos") - 50).alias("start"), (F.col("pos") + 350).alias("end"))
    return Q.site_filter_query(V.genotypes(spark, d), V.sites(spark, d), V.popmap(spark, d), replace(SITE_PARAMS, pop_fail_mode=mode), gone)


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + " SELECT chrom, pos, filter FROM f"))
def site_filters(spark: SparkSession, d: str) -> DataFrame:
    """The whole filter: every test of a site, global and in populations, with what failed."""
    return filtered(spark, d).select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@query(V.with_views("g", "s", "pop", body=FLAGSHIP_ALL + " SELECT chrom, pos, filter FROM f"))
def site_filters_all_populations(spark: SparkSession, d: str) -> DataFrame:
    return filtered(spark, d, "ALL").select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + " SELECT CASE WHEN filter = '' THEN 'PASS' ELSE filter END AS FILTER, count(*) AS COUNT FROM f GROUP BY 1"))
def site_filter_summary(spark: SparkSession, d: str) -> DataFrame:
    return Q.filter_summary(filtered(spark, d))


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + " SELECT chrom, pos, AC, AN, NS, round(MAF, 6) AS MAF, round(F_MISSING, 6) AS F_MISSING, round(CR, 6) AS CR, round(HWE, 6) AS HWE, round(ExcHet, 6) AS ExcHet, DP FROM f"))
def site_tags(spark: SparkSession, d: str) -> DataFrame:
    return filtered(spark, d).select("chrom", "pos", "AC", "AN", "NS", *(F.round(c, 6).alias(c) for c in ("MAF", "F_MISSING", "CR", "HWE", "ExcHet")), "DP")


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + " SELECT chrom, pos, type, round(qual, 2) AS qual FROM f WHERE filter = ''"))
def pass_sites(spark: SparkSession, d: str) -> DataFrame:
    return Q.pass_sites(filtered(spark, d), ["type", "qual"])


@query(V.with_views("g", body=f"@{MASKED} SELECT sample_id, count(*) AS n, count(dosage) AS n_called FROM m GROUP BY 1"))
def mask_genotypes(spark: SparkSession, d: str) -> DataFrame:
    return Q.mask_genotypes(V.genotypes(spark, d), 3, 1, 100).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.count("dosage").alias("n_called"))


def missingness(spark: SparkSession, d: str) -> DataFrame:
    return Q.sample_missingness(Q.mask_genotypes(V.genotypes(spark, d), 3, 1, 100), V.sites(spark, d))


@query(V.with_views("g", "s", body=f"@{MASKED}, {MISSING} SELECT SAMPLE, PRESENT_BASES, TARGET_BASES, round(MISSING_FRACTION, 6) AS MISSING_FRACTION FROM miss"))
def sample_missingness(spark: SparkSession, d: str) -> DataFrame:
    return missingness(spark, d).withColumn("MISSING_FRACTION", F.round("MISSING_FRACTION", 6))


@query(V.with_views("g", "s", body=f"@{MASKED}, {MISSING} SELECT SAMPLE AS sample_id FROM miss WHERE MISSING_FRACTION < 0.5"))
def keep_samples(spark: SparkSession, d: str) -> DataFrame:
    return Q.keep_samples(missingness(spark, d), 0.5)


@query(V.with_views("g", "s", body=f"@{MASKED}, {MISSING} SELECT CASE WHEN MISSING_FRACTION > 0.5 THEN 'FAIL' ELSE 'PASS' END AS STATUS, CAST(least(floor(MISSING_FRACTION * 20), 19) AS BIGINT) AS BIN, count(*) AS COUNT FROM miss GROUP BY 1, 2"))
def sample_missing_qc(spark: SparkSession, d: str) -> DataFrame:
    return Q.sample_missing_qc(missingness(spark, d), 0.5)


@query(V.with_views("pop", body="SELECT sample_id, pop FROM (SELECT sample_id, regexp_replace(pop, '[\\s_]', '', 'g') AS pop, count(*) OVER (PARTITION BY pop) AS n FROM pop WHERE CAST(substr(sample_id, 2) AS INT) % 3 > 0) WHERE n >= 5"))
def population_groups(spark: SparkSession, d: str) -> DataFrame:
    p = V.popmap(spark, d)
    return Q.population_groups(p, p.where("cast(substr(sample_id, 2) as int) % 3 > 0").select("sample_id"), 5).select("sample_id", "pop")


HIST = "h AS (SELECT depth, count(*) AS count FROM (SELECT coalesce(sum(dp), 0) AS depth FROM s LEFT JOIN g USING (chrom, pos) GROUP BY chrom, pos) GROUP BY 1)"


def depth_hist(spark: SparkSession, d: str) -> DataFrame:
    depth = V.genotypes(spark, d).groupBy("chrom", "pos").agg(F.sum("dp").alias("dp"))
    return Q.depth_histogram(V.sites(spark, d).select("chrom", "pos").join(depth, ["chrom", "pos"], "left"))


@query(V.with_views("g", "s", body=f"@{HIST} SELECT CAST(depth AS BIGINT) AS depth, count FROM h"))
def depth_histogram(spark: SparkSession, d: str) -> DataFrame:
    return depth_hist(spark, d)


@query(V.with_views("g", "s", body=f"@{HIST} SELECT CAST(depth AS BIGINT) AS depth, CAST(2 * count AS BIGINT) AS count FROM h"))
def merge_histograms(spark: SparkSession, d: str) -> DataFrame:
    h = depth_hist(spark, d)
    return Q.merge_histograms(h, h)


@query(V.with_views("g", "s", body=f"@{HIST}, c AS (SELECT depth, sum(count) OVER (ORDER BY depth) AS cum, sum(count) OVER () AS total FROM h) SELECT CAST(min(CASE WHEN cum >= greatest(1, ceil(0.05 * total)) THEN depth END) AS BIGINT) AS DPlower, CAST(min(CASE WHEN cum >= greatest(1, ceil(0.95 * total)) THEN depth END) AS BIGINT) AS DPupper FROM c"))
def depth_bounds(spark: SparkSession, d: str) -> DataFrame:
    return Q.depth_bounds(depth_hist(spark, d), 5, 95)


@query(V.with_views("g", body="@o AS (SELECT CAST(sum(dp) AS BIGINT) AS dp, row_number() OVER (ORDER BY sum(dp)) - 1 AS i, count(*) OVER () AS n FROM g GROUP BY chrom, pos) SELECT max(CASE WHEN i = floor(n * 0.05) THEN dp END) AS lower, max(CASE WHEN i = floor(n * 0.95) THEN dp END) AS upper FROM o"))
def depth_percentile_index(spark: SparkSession, d: str) -> DataFrame:
    return Q.depth_percentile_index(V.genotypes(spark, d).groupBy("chrom", "pos").agg(F.sum("dp").alias("dp")), 0.05, 0.95)


@query(V.with_views("s", body="SELECT chrom, pos, type FROM s WHERE len(alt) = 1"))
def biallelic(spark: SparkSession, d: str) -> DataFrame:
    return Q.biallelic(V.sites(spark, d)).select("chrom", "pos", "type")


POP_TAGS = "sz AS (SELECT pop, count(*) AS n FROM pop GROUP BY 1), pc AS (SELECT chrom, pos, pop, " + ", ".join(f"count(*) FILTER (dosage = {d}) AS n{d}" for d in (0, 1, 2)) + " FROM g JOIN pop USING (sample_id) GROUP BY 1, 2, 3), " + hwe_sql("pc") + """,
cell AS (SELECT chrom, pos, pop, n0 + n1 + n2 AS NS, CASE WHEN n0 + n1 + n2 > 0 THEN least((n1 + 2 * n2) / (2 * (n0 + n1 + n2)), 1 - (n1 + 2 * n2) / (2 * (n0 + n1 + n2))) END AS MAF, (n0 + n1 + n2) / sz.n AS CR, HWE, ExcHet FROM pc JOIN sz USING (pop) JOIN hw USING (n0, n1, n2)),
wide AS (SELECT chrom, pos, """ + ", ".join(f"max(CASE WHEN pop = '{p}' THEN {m} END) AS {m}_{p}" for p in POPS for m in Q.POP_METRICS) + " FROM cell GROUP BY 1, 2)"


def pop_tags(spark: SparkSession, d: str) -> DataFrame:
    return Q.site_tags_by_pop(V.genotypes(spark, d), V.popmap(spark, d), POPS)


@query(V.with_views("g", "pop", body=f"@{POP_TAGS} SELECT chrom, pos, " + ", ".join(f"round(CAST({m}_{p} AS DOUBLE), 6) AS {m}_{p}" for p in POPS for m in Q.POP_METRICS) + " FROM wide"))
def site_tags_by_pop(spark: SparkSession, d: str) -> DataFrame:
    return pop_tags(spark, d).select("chrom", "pos", *(F.round(F.col(f"{m}_{p}").cast("double"), 6).alias(f"{m}_{p}") for p in POPS for m in Q.POP_METRICS))


def bad_sql(m: str, low: float, op: str) -> str:
    return "(" + f" {op} ".join(f"coalesce({m}_{p} < {low}, false)" for p in POPS) + ")"


@query(V.with_views("g", "pop", body=f"@{POP_TAGS} SELECT chrom, pos, concat_ws(';', CASE WHEN {bad_sql('MAF', 0.1, 'OR')} THEN 'POP_MAF_FAIL' END, CASE WHEN {bad_sql('CR', 0.4, 'OR')} THEN 'POP_CR_FAIL' END) AS filter FROM wide"))
def population_filters_any(spark: SparkSession, d: str) -> DataFrame:
    return Q.population_site_filters(pop_tags(spark, d), POPS, {"MAF": 0.1, "CR": 0.4}, "ANY").select("chrom", "pos", F.concat_ws(";", "pop_filter").alias("filter"))


@query(V.with_views("g", "pop", body=f"@{POP_TAGS} SELECT chrom, pos, concat_ws(';', CASE WHEN {bad_sql('MAF', 0.3, 'AND')} THEN 'POP_MAF_FAIL' END, CASE WHEN {bad_sql('CR', 0.6, 'AND')} THEN 'POP_CR_FAIL' END) AS filter FROM wide"))
def population_filters_all(spark: SparkSession, d: str) -> DataFrame:
    return Q.population_site_filters(pop_tags(spark, d), POPS, {"MAF": 0.3, "CR": 0.6}, "ALL").select("chrom", "pos", F.concat_ws(";", "pop_filter").alias("filter"))


@query(V.with_views("s", body="SELECT chrom, pos, CAST(CASE WHEN type = 'SNP' AND EXISTS (SELECT 1 FROM s t WHERE t.chrom = s.chrom AND t.type = 'INDEL' AND abs(t.pos - s.pos) <= 200) THEN 1 ELSE 0 END AS INT) AS snp_gap FROM s"))
def snp_gap(spark: SparkSession, d: str) -> DataFrame:
    return Q.snp_gap(V.sites(spark, d), 200).select("chrom", "pos", "snp_gap")


@query(V.with_views("s", body="SELECT chrom, pos, CAST(CASE WHEN type = 'INDEL' AND EXISTS (SELECT 1 FROM s t WHERE t.chrom = s.chrom AND t.type = 'INDEL' AND t.pos <> s.pos AND abs(t.pos - s.pos) <= 200) THEN 1 ELSE 0 END AS INT) AS indel_gap FROM s"))
def indel_gap(spark: SparkSession, d: str) -> DataFrame:
    return Q.indel_gap(V.sites(spark, d), 200).select("chrom", "pos", "indel_gap")


@query(V.with_views("s", body="@" + MASK + """ SELECT s.chrom, s.pos, CASE WHEN EXISTS (SELECT 1 FROM mask m WHERE m.chrom = s.chrom AND m.start <= s.pos - 1 AND s.pos - 1 < m."end") THEN 'MASK_FAIL' ELSE '' END AS filter FROM s"""))
def mask_filter(spark: SparkSession, d: str) -> DataFrame:
    s = V.sites(spark, d).select("chrom", "pos", F.expr("cast(array() as array<string>)").alias("filter"))
    return Q.mask_filter(s, site_mask(spark, d)).select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + ", c AS (SELECT *, CAST(floor(pos / 1000) AS BIGINT) AS chunk FROM f) SELECT chunk, count(*) AS n FROM c WHERE chunk IN (SELECT chunk FROM c WHERE filter = '') GROUP BY 1"))
def drop_empty_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = filtered(spark, d).withColumn("chunk", F.floor(F.col("pos") / 1000).cast("long"))
    return Q.drop_empty_chunks(c).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + ", b AS (SELECT min(qual) AS lo, max(qual) AS hi FROM f) SELECT CASE WHEN contains(filter, 'QUAL_FAIL') THEN 'FAIL' ELSE 'PASS' END AS STATUS, CAST(floor((qual - lo) / ((hi - lo) / 100)) AS BIGINT) AS BIN, count(*) AS COUNT FROM f CROSS JOIN b GROUP BY 1, 2"))
def pass_fail_histogram(spark: SparkSession, d: str) -> DataFrame:
    return Q.pass_fail_histogram(filtered(spark, d), "qual", "QUAL_FAIL")


@query(V.with_views("g", "s", "pop", body=FLAGSHIP + """, l AS (SELECT type AS TYPE, 'MAF' AS RULE, MAF AS v, 0.0 AS lo, 0.5 AS hi, CASE WHEN list_contains(string_split(filter, ';'), 'MAF_FAIL') THEN 'FAIL' ELSE 'PASS' END AS FILTER FROM f UNION ALL SELECT type, 'CR', CR, 0.0, 1.0, CASE WHEN list_contains(string_split(filter, ';'), 'CR_FAIL') THEN 'FAIL' ELSE 'PASS' END FROM f),
b AS (SELECT TYPE, RULE, FILTER, lo, (hi - lo) / 20 AS w, greatest(1, ceil((least(greatest(v, lo), hi) - lo) / ((hi - lo) / 20))) AS i FROM l WHERE v IS NOT NULL), c AS (SELECT TYPE, RULE, FILTER, round(lo + (i - 0.5) * w, 6) AS BIN, count(*) AS COUNT FROM b GROUP BY 1, 2, 3, 4) SELECT *, round(COUNT / sum(COUNT) OVER (PARTITION BY TYPE, RULE), 6) AS PROP FROM c"""))
def metric_histogram_global(spark: SparkSession, d: str) -> DataFrame:
    h = Q.metric_histogram_global(filtered(spark, d), {"MAF": (0, 0.5), "CR": (0, 1)}, 20)
    return h.select("TYPE", "RULE", "FILTER", F.round("BIN", 6).alias("BIN"), "COUNT", F.round("PROP", 6).alias("PROP"))


def histogram_sql(src: str, by: str, bins: int) -> str:
    """Right-closed bins by mid-point and shares, for rows (by..., TYPE, RULE, v, lo, hi, FILTER) of `src`."""
    return f"""b AS (SELECT {by}TYPE, RULE, FILTER, lo, (hi - lo) / {bins} AS w, greatest(1, ceil((least(greatest(v, lo), hi) - lo) / ((hi - lo) / {bins}))) AS i FROM {src} WHERE v IS NOT NULL),
c AS (SELECT {by}TYPE, RULE, FILTER, round(lo + (i - 0.5) * w, 6) AS BIN, count(*) AS COUNT FROM b GROUP BY ALL) SELECT *, round(COUNT / sum(COUNT) OVER (PARTITION BY {by}TYPE, RULE), 6) AS PROP FROM c"""


@query(V.with_views("g", "pop", body=f"@{POP_TAGS}, l AS (" + " UNION ALL ".join(f"SELECT '{p}' AS POP, 'SNP' AS TYPE, '{m}' AS RULE, CAST({m}_{p} AS DOUBLE) AS v, 0.0 AS lo, {hi} AS hi, CASE WHEN '{m}' = 'MAF' AND (" + " OR ".join(f"coalesce(MAF_{x} < 0.1, false)" for x in POPS) + ") THEN 'FAIL' ELSE 'PASS' END AS FILTER FROM wide" for p in POPS for m, hi in (("MAF", 0.5), ("CR", 1.0))) + "), " + histogram_sql("l", "POP, ", 20)))
def metric_histogram_by_pop(spark: SparkSession, d: str) -> DataFrame:
    t = Q.population_site_filters(pop_tags(spark, d), POPS, {"MAF": 0.1}, "ANY").withColumn("type", F.lit("SNP"))
    h = Q.metric_histogram_by_pop(t, POPS, {"MAF": (0, 0.5), "CR": (0, 1)}, 20)
    return h.select("POP", "TYPE", "RULE", "FILTER", F.round("BIN", 6).alias("BIN"), "COUNT", F.round("PROP", 6).alias("PROP"))


@query(V.with_views("s", body="@c AS (SELECT *, CAST(floor(pos / 10000) AS BIGINT) AS chunk FROM s), k AS (SELECT DISTINCT chunk FROM c ORDER BY md5(CAST(chunk AS VARCHAR)) LIMIT 5) SELECT round(max(qual) * 1.1, 6) AS qual FROM c WHERE chunk IN (SELECT chunk FROM k)"))
def metric_max_estimate(spark: SparkSession, d: str) -> DataFrame:
    c = V.sites(spark, d).withColumn("chunk", F.floor(F.col("pos") / 10000).cast("long"))
    return Q.metric_max_estimate(c, ["qual"]).select(F.round("qual", 6).alias("qual"))


@query(V.with_views("s", body="SELECT type, count(*) AS n FROM s GROUP BY 1"))
def split_by_type(spark: SparkSession, d: str) -> DataFrame:
    parts = Q.split_by_type(V.sites(spark, d))
    return D.mix(*parts.values()).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("g", body="SELECT DISTINCT chrom, pos FROM g"))
def sites_only(spark: SparkSession, d: str) -> DataFrame:
    return Q.sites_only(V.genotypes(spark, d))


@query(V.with_views("g", "s", body="SELECT sample_id, count(*) AS n FROM g WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM s WHERE type = 'INDEL') GROUP BY 1"))
def subset_to_sites(spark: SparkSession, d: str) -> DataFrame:
    return Q.subset_to_sites(V.genotypes(spark, d), V.sites(spark, d).where("type = 'INDEL'")).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


@query(V.with_views("s", body="SELECT chrom, pos FROM s WHERE type = 'SNP' AND (chrom, pos) IN (SELECT (chrom, pos) FROM s WHERE qual > 50)"))
def isec_n2(spark: SparkSession, d: str) -> DataFrame:
    s = V.sites(spark, d)
    return Q.isec_n2(s.where("type = 'SNP'"), s.where("qual > 50")).select("chrom", "pos")


@query(V.with_views("g", "pop", body="SELECT sample_id, count(*) AS n FROM g WHERE sample_id IN (SELECT sample_id FROM pop WHERE pop = 'P1') GROUP BY 1"))
def sample_subset_common(spark: SparkSession, d: str) -> DataFrame:
    return Q.sample_subset_common(V.genotypes(spark, d), V.popmap(spark, d).where("pop = 'P1'")).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


def annotated(spark: SparkSession, d: str) -> DataFrame:
    s = V.sites(spark, d)
    return s.select("chrom", "pos", "type", F.col("qual").alias("QUAL"), (F.col("size") % 5).cast("double").alias("QD"), (F.col("size") % 6).cast("double").alias("SOR"), (F.col("pos") % 90).cast("double").alias("FS"), (F.col("pos") % 70).cast("double").alias("MQ"), (F.col("pos") % 30 - 20).cast("double").alias("MQRankSum"), F.lit(None).cast("double").alias("ReadPosRankSum"))


ANN = "ann AS (SELECT chrom, pos, type, qual AS QUAL, CAST(size % 5 AS DOUBLE) AS QD, CAST(size % 6 AS DOUBLE) AS SOR, CAST(pos % 90 AS DOUBLE) AS FS, CAST(pos % 70 AS DOUBLE) AS MQ, CAST(pos % 30 - 20 AS DOUBLE) AS MQRankSum FROM s)"


@query(V.with_views("s", body=f"@{ANN} SELECT chrom, pos, concat_ws(';', CASE WHEN QD < 2 THEN 'QD2' END, CASE WHEN QUAL < 30 THEN 'QUAL30' END, CASE WHEN SOR > 3 THEN 'SOR3' END, CASE WHEN FS > 60 THEN 'FS60' END, CASE WHEN MQ < 40 THEN 'MQ40' END, CASE WHEN MQRankSum < -12.5 THEN 'MQRankSum-12.5' END) AS filter FROM ann WHERE type = 'SNP'"))
def hard_filter_snp(spark: SparkSession, d: str) -> DataFrame:
    return Q.hard_filter_snp(annotated(spark, d).where("type = 'SNP'")).select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@query(V.with_views("s", body=f"@{ANN} SELECT chrom, pos, concat_ws(';', CASE WHEN QD < 2 THEN 'QD2' END, CASE WHEN QUAL < 30 THEN 'QUAL30' END, CASE WHEN FS > 200 THEN 'FS200' END) AS filter FROM ann WHERE type = 'INDEL'"))
def hard_filter_indel(spark: SparkSession, d: str) -> DataFrame:
    return Q.hard_filter_indel(annotated(spark, d).where("type = 'INDEL'")).select("chrom", "pos", F.concat_ws(";", "filter").alias("filter"))


@query(V.with_views("g", body="SELECT chrom, pos, round(1 - count(dosage) / 40, 6) AS nocall FROM g GROUP BY 1, 2 HAVING 1 - count(dosage) / 40 <= 0.45"))
def max_nocall_fraction(spark: SparkSession, d: str) -> DataFrame:
    return Q.max_nocall_fraction(V.genotypes(spark, d), 40, 0.45).withColumn("nocall", F.round("nocall", 6))


@query(V.with_views("s", body=f"@{ANN} SELECT chrom, pos, QUAL, QD, SOR FROM ann"))
def variants_to_table(spark: SparkSession, d: str) -> DataFrame:
    return Q.variants_to_table(annotated(spark, d), ["QUAL", "QD", "SOR"])


@query(V.with_views("s", body=f"@{ANN} SELECT chrom, pos, CASE WHEN MQ >= 20 THEN 'PASS' ELSE 'FAIL' END AS MQ_status, CASE WHEN FS <= 60 THEN 'PASS' ELSE 'FAIL' END AS FS_status, MQ >= 20 AND FS <= 60 AS all_pass FROM ann"))
def snpstat_filter_summary(spark: SparkSession, d: str) -> DataFrame:
    return Q.snpstat_filter_summary(annotated(spark, d), {"MQ": (">=", 20), "FS": ("<=", 60)})


@query(V.with_views("s", body="@t AS (SELECT chrom, pos, (pos % 997 + 1) / 1000.0 AS p FROM s), r AS (SELECT p, sum(count(*)) OVER (ORDER BY p) AS rank, sum(count(*)) OVER () AS m FROM t GROUP BY p), a AS (SELECT p, least(1.0, min(p * m / rank) OVER (ORDER BY p DESC)) AS q FROM r) SELECT chrom, pos, round(q, 6) AS p_adjusted FROM t JOIN a USING (p)"))
def bh_adjusted(spark: SparkSession, d: str) -> DataFrame:
    t = V.sites(spark, d).select("chrom", "pos", ((F.col("pos") % 997 + 1) / 1000.0).alias("p"))
    return Q.lr_pvalue_bh(t, given_p=True).select("chrom", "pos", F.round("p_adjusted", 6).alias("p_adjusted"))


@query(V.with_views("s", body="@t AS (SELECT chrom, pos, power((pos % 997 + 1) / 998.0, 6) AS p FROM s), r AS (SELECT p, sum(count(*)) OVER (ORDER BY p) AS rank, sum(count(*)) OVER () AS m FROM t GROUP BY p), a AS (SELECT p, least(1.0, min(p * m / rank) OVER (ORDER BY p DESC)) AS q FROM r), w AS (SELECT chrom, greatest(0, pos - 200) AS start, pos + 200 AS \"end\" FROM t JOIN a USING (p) WHERE q < 0.02), " + merged_sql("w") + " SELECT * FROM merged"))
def paralog_mask(spark: SparkSession, d: str) -> DataFrame:
    t = V.sites(spark, d).select("chrom", "pos", F.pow((F.col("pos") % 997 + 1) / F.lit(998.0), F.lit(6)).alias("p"))
    return Q.paralog_mask(Q.lr_pvalue_bh(t, given_p=True), 0.02, 200)


@query()
def lr_pvalues(spark: SparkSession, d: str) -> DataFrame:
    """Likelihood-ratio tests with their p and adjusted values."""
    lr = V.sites(spark, d).select("chrom", "pos", F.col("qual").alias("lr"))
    return Q.lr_pvalue_bh(lr).select("chrom", "pos", F.round("p", 6).alias("p"), F.round("p_adjusted", 6).alias("p_adjusted"))


@query(V.with_views("g", body="SELECT sample_id, CAST(sum(CASE WHEN dp > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_sites FROM g GROUP BY 1"))
def individual_data_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.individual_data_counts(V.genotypes(spark, d))


@query(V.with_views("s", body="@x AS (SELECT *, ref || coalesce(alt[1], '') AS pair FROM s) SELECT type, count(*) AS n, CAST(sum(CASE WHEN type = 'SNP' AND pair IN ('AG', 'GA', 'CT', 'TC') THEN 1 ELSE 0 END) AS BIGINT) AS n_ts, CAST(sum(CASE WHEN type = 'SNP' AND pair NOT IN ('AG', 'GA', 'CT', 'TC') THEN 1 ELSE 0 END) AS BIGINT) AS n_tv, round(avg(qual), 6) AS mean_qual FROM x GROUP BY 1"))
def vcf_stats(spark: SparkSession, d: str) -> DataFrame:
    return Q.vcf_stats(V.sites(spark, d)).withColumn("mean_qual", F.round("mean_qual", 6))


@query(V.with_views("g", body="SELECT sample_id, CAST(sum(CASE WHEN dosage = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_ref, CAST(sum(CASE WHEN dosage = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_het, CAST(sum(CASE WHEN dosage = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_hom_alt, CAST(sum(CASE WHEN dosage IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, round(avg(dp), 6) AS mean_dp FROM g GROUP BY 1"))
def sample_stats(spark: SparkSession, d: str) -> DataFrame:
    return Q.sample_stats(V.genotypes(spark, d)).withColumn("mean_dp", F.round("mean_dp", 6))


@query(V.with_views("s", body="SELECT chrom, CAST(floor(pos / 10000) AS BIGINT) AS \"window\", min(pos) AS pos FROM s GROUP BY 1, 2"))
def thin_sites(spark: SparkSession, d: str) -> DataFrame:
    return Q.thin_sites(V.sites(spark, d))


@query(V.with_views("g", body="""@p AS (SELECT a.chrom, a.pos AS pos_a, b.pos AS pos_b, a.dosage AS x, b.dosage AS y FROM g a JOIN g b ON a.chrom = b.chrom AND a.sample_id = b.sample_id AND a.pos < b.pos AND b.pos - a.pos <= 1000),
t AS (SELECT chrom, pos_a, pos_b, count(*) AS n, count(*) * sum(x * y) - sum(x) * sum(y) AS c, count(*) * sum(x * x) - sum(x) * sum(x) AS vx, count(*) * sum(y * y) - sum(y) * sum(y) AS vy FROM p GROUP BY 1, 2, 3) SELECT chrom, pos_a, pos_b, n, round(CAST(c AS DOUBLE) * c / (CAST(vx AS DOUBLE) * vy), 6) AS r2 FROM t WHERE vx > 0 AND vy > 0 AND n >= 2"""))
def ld_r2_pairs(spark: SparkSession, d: str) -> DataFrame:
    return L.ld_r2_pairs(V.genotypes(spark, d), 1000).withColumn("r2", F.round(F.col("r2").cast("double"), 6))


@query(V.with_views("g", "s", body="SELECT s.chrom, s.pos, n FROM s LEFT JOIN (SELECT chrom, pos, count(*) AS n FROM g WHERE gq > 60 GROUP BY 1, 2) USING (chrom, pos)"))
def join_site_stats(spark: SparkSession, d: str) -> DataFrame:
    n = V.genotypes(spark, d).where("gq > 60").groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n"))
    return Q.join_site_stats(V.sites(spark, d).select("chrom", "pos"), n)


@query(V.with_views("g", body="@c AS (SELECT chrom, pos, " + ", ".join(f"count(*) FILTER (dosage = {d}) AS n{d}" for d in (0, 1, 2)) + " FROM g GROUP BY 1, 2), " + hwe_sql("c") + " SELECT chrom, pos, round(HWE, 6) AS HWE, round(ExcHet, 6) AS ExcHet FROM c JOIN hw USING (n0, n1, n2)"))
def hwe_exact(spark: SparkSession, d: str) -> DataFrame:
    tested = Q.hwe_exact(Q.genotype_counts(V.genotypes(spark, d)))
    return tested.select("chrom", "pos", F.round("HWE", 6).alias("HWE"), F.round("ExcHet", 6).alias("ExcHet"))
