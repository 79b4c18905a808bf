"""Queries over sample sheets, text sources and sinks: tables written in a format and read back from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions.sql import register_sql_functions
from lociframe.operators import dataflow as D
from lociframe.operators import mito as M
from lociframe.operators import popgen as P
from lociframe.operators import reads as R
from lociframe.operators.lineage import scratch
from lociframe.plans import views as V
from lociframe.plans.registry import query
from lociframe.sources import readers, writers


def sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sample sheet from suppliers and nations: blank libraries, names with spaces, three kinds of sources."""
    s = V.table(spark, d, "supplier").join(V.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    code = F.lpad(k.cast("string"), 6, "0")
    fwd = F.when(k % 5 == 0, F.concat(F.lit("SRR"), code)).when(k % 5 == 1, F.concat(F.lit("https://host/"), code, F.lit("_1.fq.gz"))).otherwise(F.concat(F.lit(" "), code, F.lit("_1.fq.gz")))
    return s.select(F.concat(F.lit("S"), code).alias("sample"), F.when(k % 3 == 0, " ").otherwise("lib").alias("lib"), F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat("n_name", F.lit(" x"))).alias("pop"), fwd.alias("fwd"), F.when(k % 5 > 0, F.concat(code, F.lit("_2.fq.gz"))).alias("rev"))


SHEET = """sheet AS (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS sample, CASE WHEN s_suppkey % 3 = 0 THEN 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') ELSE 'lib' END AS lib,
  CASE WHEN s_suppkey % 4 = 0 THEN 'unknown' ELSE regexp_replace(n_name || ' x', '\\s+', '_', 'g') END AS pop, CASE WHEN s_suppkey % 5 = 0 THEN 'accession' WHEN s_suppkey % 5 = 1 THEN 'url' ELSE 'local' END AS source
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


@query(f"WITH {SHEET} SELECT sample, lib, pop, source FROM sheet")
def normalise_samplesheet(spark: SparkSession, d: str) -> DataFrame:
    return readers.normalise_samplesheet(sheet(spark, d)).select("sample", "lib", "pop", "source")


@query(f"WITH {SHEET} SELECT sample, source, 1 AS n_inputs FROM sheet")
def group_reads(spark: SparkSession, d: str) -> DataFrame:
    return readers.group_reads(readers.normalise_samplesheet(sheet(spark, d))).select("sample", "source", F.size("inputs").alias("n_inputs"))


@query(f"WITH {SHEET} SELECT sample AS sample_id, pop FROM sheet")
def popmap(spark: SparkSession, d: str) -> DataFrame:
    return readers.popmap(readers.normalise_samplesheet(sheet(spark, d)))


@query(V.with_views("s", body="""SELECT chrom, pos - 1 AS start, CASE WHEN type = 'REF' THEN pos + size ELSE pos END AS "end", 1 AS weight FROM s"""))
def gvcf_blocks(spark: SparkSession, d: str) -> DataFrame:
    end = F.create_map(F.lit("END"), F.when(F.col("type") == "REF", (F.col("pos") + F.col("size")).cast("string")))
    return readers.gvcf_blocks(V.sites(spark, d).withColumn("info", end))


@query(V.with_views("g", body="@st AS (SELECT DISTINCT chrom, pos FROM g), f AS (SELECT st.chrom, st.pos, x.sample_id, coalesce(CAST(g.dosage AS VARCHAR), '3') AS d FROM st CROSS JOIN (SELECT DISTINCT sample_id FROM g) x LEFT JOIN g ON g.chrom = st.chrom AND g.pos = st.pos AND g.sample_id = x.sample_id) SELECT sample_id, chrom, CAST(floor(pos / 5000) AS BIGINT) AS tile, count(*) AS n_sites, string_agg(d, '' ORDER BY pos) AS genotypes FROM f GROUP BY 1, 2, 3"))
def genotype_strings(spark: SparkSession, d: str) -> DataFrame:
    return writers.genotype_strings(V.genotypes(spark, d), 5_000)


@query(V.with_views("iv", body="SELECT chrom, start, \"end\", label, weight FROM iv WHERE label IN ('L0', 'L2')"))
def concat_ordered(spark: SparkSession, d: str) -> DataFrame:
    iv = V.intervals(spark, d).withColumn("pos", F.col("start"))
    return writers.concat_ordered([iv.where("label = 'L2'"), iv.where("label = 'nothing'"), iv.where("label = 'L0'")], V.contigs(spark, d)).drop("pos")


@query(V.with_views("iv", body="SELECT CAST(2 * count(*) AS INT) AS n_parts, 2 * count(*) AS n_merged, true AS equal FROM iv"))
def merge_tables_with_check(spark: SparkSession, d: str) -> DataFrame:
    iv = V.intervals(spark, d)
    return writers.merge_tables_with_check([iv, iv])[1]


@query(V.with_views("g", body="SELECT DISTINCT sample_id AS family_id, sample_id FROM g"))
def dosage_samples(spark: SparkSession, d: str) -> DataFrame:
    return P.dosage_table(V.genotypes(spark, d))[1]


@query(V.with_views("pop", body="@l AS (SELECT pop, list(sample_id ORDER BY sample_id) AS a FROM pop GROUP BY 1) SELECT pop, unnest(a) AS sample_id, unnest(a) AS other FROM l"))
def flat_map(spark: SparkSession, d: str) -> DataFrame:
    lists = D.group_tuple(V.popmap(spark, d), ["pop"])
    return D.flat_map(lists.withColumn("other", F.col("sample_id")), ["sample_id", "other"])


@query(V.with_views("aln", body="SELECT qname FROM aln WHERE (flag & 12) = 12"))
def unmapped_pairs(spark: SparkSession, d: str) -> DataFrame:
    a = V.alignments(spark, d).withColumn("seq", F.col("qname"))
    both = a.unionByName(a.withColumn("flag", F.col("flag").bitwiseOR(F.lit(64))))
    return R.unmapped_pairs(both).select("qname")


@query(V.with_views("aln", body="SELECT qname FROM aln WHERE rg <> 'g3'"))
def strip_rg(spark: SparkSession, d: str) -> DataFrame:
    a = V.alignments(spark, d)
    named = a.select(F.concat_ws("|", "rg", "qname").alias("qname"), F.create_map(F.lit("NM"), F.lit("0")).alias("tags"))
    return R.strip_rg(named, a.where("rg <> 'g3'").select("rg").distinct())[0].select("qname")


@query(V.with_views("g", body="SELECT DISTINCT chrom, pos FROM g"))
def dosage_variants(spark: SparkSession, d: str) -> DataFrame:
    return P.dosage_table(V.genotypes(spark, d))[0]


@query(V.with_views("g", body="SELECT chrom, pos, sample_id, dosage FROM g"))
def dosages(spark: SparkSession, d: str) -> DataFrame:
    return P.dosage_table(V.genotypes(spark, d))[2]


@query(V.with_views("aln", body="SELECT rg || '|' || qname AS qname, CASE WHEN strpos(rg || '|' || qname, '|') = 0 THEN 'no prefix' ELSE 'unknown group' END AS reason FROM aln WHERE rg = 'g3' UNION ALL SELECT qname, 'no prefix' FROM aln WHERE rg = 'g1'"))
def strip_rg_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Alignments whose read group is not known, and those without one in their name."""
    a = V.alignments(spark, d)
    tags = F.create_map(F.lit("NM"), F.lit("0")).alias("tags")
    named = a.select(F.concat_ws("|", "rg", "qname").alias("qname"), tags).unionByName(a.where("rg = 'g1'").select("qname", tags))
    return R.strip_rg(named, a.where("rg <> 'g3'").select("rg").distinct())[1].select("qname", "reason")


def text_lines(df: DataFrame, *cols: str | object, name: str) -> str:
    """A table as tab-separated lines in the shared folder; the path."""
    path = scratch(df.sparkSession, name)
    D.collect_file(df.select(*cols), df.select(*cols).columns, "\t", path)
    return path


@query(V.with_views("iv", body="""SELECT chrom, start, "end", CASE WHEN weight % 2 = 0 THEN label ELSE 'none' END AS label FROM iv"""))
def read_bed(spark: SparkSession, d: str) -> DataFrame:
    """Intervals as BED lines, half of them without a label, between comments and blank lines."""
    iv = V.intervals(spark, d)
    line = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), F.when(F.col("weight") % 2 == 0, F.col("label")))
    path = scratch(spark, "bed")
    iv.select(F.explode(F.array(line, F.lit("# made"), F.lit(""))).alias("value")).write.text(path)
    return readers.read_bed(spark, path, "none")


@query(V.with_views("iv", "s", body="""SELECT chrom, pos FROM s UNION ALL SELECT chrom, unnest(range(greatest(0, start - 5) + 1, start + 6)) FROM iv WHERE label = 'L1'"""))
def read_sitelist(spark: SparkSession, d: str) -> DataFrame:
    """Sites in the three forms of a list."""
    s, iv = V.sites(spark, d), V.intervals(spark, d).where("label = 'L1'")
    one = s.select(F.when(F.col("size") % 2 == 0, F.concat("chrom", F.lit(":"), F.col("pos").cast("string"))).otherwise(F.concat("chrom", F.lit("\t"), F.col("pos").cast("string"))).alias("value"))
    three = iv.select(F.concat_ws("\t", "chrom", (F.col("start") - 5).cast("string"), (F.col("start") + 5).cast("string")).alias("value"))
    path = scratch(spark, "sites")
    one.unionByName(three).write.text(path)
    return readers.read_sitelist(spark, path)


def vcf(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Sites and genotypes of all samples, S0 to S39, as VCF lines, read back. Cells without a row are missing."""
    s, g = V.sites(spark, d), V.genotypes(spark, d)
    names = [f"S{i}" for i in range(40)]
    wide = g.where(F.col("sample_id").isin(names)).groupBy("chrom", "pos").pivot("sample_id", names).agg(F.first(F.concat(F.element_at(F.array(F.lit("0/0"), F.lit("0/1"), F.lit("1/1")), F.col("dosage") + 1), F.lit(":"), F.col("dp").cast("string"), F.lit(":"), F.col("gq").cast("string"), F.lit(":"), F.col("n_ref").cast("string"), F.lit(","), F.col("n_alt").cast("string"))))
    joined = s.join(wide, ["chrom", "pos"], "left")
    alt = F.when(F.size("alt") == 0, F.lit(".")).otherwise(F.concat_ws(",", "alt"))
    line = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", alt, F.col("qual").cast("string"), F.when(F.col("size") % 3 == 0, "PASS").otherwise("q10;s50"), F.concat(F.lit("SZ="), F.col("size").cast("string"), F.lit(";DB")), F.lit("GT:DP:GQ:AD"), *(F.coalesce(n, F.lit("./.:.:.:.")) for n in names))
    head = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])
    first = spark.range(1).select(F.explode(F.array(F.lit("##fileformat=VCFv4.2"), F.lit(head))).alias("value"))
    path = scratch(spark, "vcf")
    first.unionByName(joined.select(line.alias("value"))).write.text(path)
    return readers.read_vcf(spark, path)


@query(V.with_views("s", body="SELECT chrom, pos, ref, array_to_string(alt, ',') AS alt, qual, CASE WHEN size % 3 = 0 THEN '' ELSE 'q10;s50' END AS filter, CAST(size AS VARCHAR) AS sz FROM s"))
def read_vcf_sites(spark: SparkSession, d: str) -> DataFrame:
    return vcf(spark, d)[0].select("chrom", "pos", "ref", F.concat_ws(",", "alt").alias("alt"), "qual", F.concat_ws(";", "filter").alias("filter"), F.col("info")["SZ"].alias("sz"))


@query(V.with_views("g", "s", body="@nm AS (SELECT 'S' || CAST(unnest(range(0, 40)) AS VARCHAR) AS sample_id) SELECT s.chrom, s.pos, nm.sample_id, g.dosage, CAST(g.dp AS INT) AS dp, g.gq, CAST(g.n_ref AS INT) AS ad0, CAST(g.n_alt AS INT) AS ad1 FROM s CROSS JOIN nm LEFT JOIN g ON g.chrom = s.chrom AND g.pos = s.pos AND g.sample_id = nm.sample_id"))
def read_vcf_genotypes(spark: SparkSession, d: str) -> DataFrame:
    return vcf(spark, d)[1].select("chrom", "pos", "sample_id", "dosage", "dp", "gq", F.get("ad", F.lit(0)).alias("ad0"), F.get("ad", F.lit(1)).alias("ad1"))


@query("SELECT 'd' || CAST(doc_id AS VARCHAR) AS contig, regexp_replace(text, '[\\s>]', '', 'g') AS seq, CAST(length(regexp_replace(text, '[\\s>]', '', 'g')) AS BIGINT) AS length FROM documents WHERE length(regexp_replace(text, '[\\s>]', '', 'g')) > 0")
def fasta_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Texts without white space as FASTA records of wrapped lines, read back."""
    seq = F.regexp_replace("text", r"[\s>]", "")
    docs = V.table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("contig"), seq.alias("seq")).where("length(seq) > 0")
    path = scratch(spark, "fasta")
    writers.write_fasta(docs, path)
    return readers.read_fasta(spark, path).select("contig", "seq", "length")


@query("SELECT '@r' || CAST(event_id AS VARCHAR) || ' x' AS read_id, md5(CAST(event_id AS VARCHAR)) AS seq, repeat('I', 32) AS qual, CAST(1 AS INT) AS mate FROM events")
def read_fastq(spark: SparkSession, d: str) -> DataFrame:
    """Reads as records of four lines over several files, read back."""
    e = V.table(spark, d, "events")
    name = F.col("event_id").cast("string")
    path = scratch(spark, "fastq")
    e.repartition(3, "event_id").select(F.concat(F.lit("@r"), name, F.lit(" x\n"), F.md5(name), F.lit("\n+\n"), F.repeat(F.lit("I"), 32)).alias("value")).write.text(path)
    return readers.read_fastq(spark, path, 1)


@query(V.with_views("aln", body="SELECT qname, flag, chrom AS contig, start + 1 AS pos, mapq, tlen, rg FROM aln"))
def read_sam(spark: SparkSession, d: str) -> DataFrame:
    a = V.alignments(spark, d)
    text = lambda c: F.col(c).cast("string")
    line = F.concat_ws("\t", "qname", text("flag"), "chrom", (F.col("start") + 1).cast("string"), text("mapq"), F.lit("4M"), F.lit("*"), F.lit("0"), text("tlen"), F.lit("ACGT"), F.lit("IIII"), F.lit("NM:i:0"), F.concat(F.lit("RG:Z:"), "rg"))
    path = scratch(spark, "sam")
    spark.range(1).select(F.lit("@HD\tVN:1.6").alias("value")).unionByName(a.select(line.alias("value"))).write.text(path)
    return readers.read_sam(spark, path)[0].select("qname", "flag", "contig", "pos", "mapq", "tlen", F.col("tags")["RG"].alias("rg"))


FULL = "nm AS (SELECT DISTINCT sample_id FROM g), st AS (SELECT DISTINCT g.chrom, g.pos, s.ref, s.alt[1] AS alt FROM g JOIN s ON s.chrom = g.chrom AND s.pos = g.pos), fl AS (SELECT st.chrom, st.pos, ref, alt, nm.sample_id, CASE WHEN g.dosage IS NULL THEN [0.333333, 0.333333, 0.333333] ELSE [round((g.gq % 7 + 1) / 16.0, 6), round((g.dosage + 1) / 8.0, 6), 0.25] END AS gp FROM st CROSS JOIN nm LEFT JOIN g ON g.chrom = st.chrom AND g.pos = st.pos AND g.sample_id = nm.sample_id)"


def beagle(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """(folder of the likelihood table of all samples and sites, what was written)."""
    g, s = V.genotypes(spark, d), V.sites(spark, d)
    sites = g.select("chrom", "pos").distinct().join(s.select("chrom", "pos", "ref", "alt"), ["chrom", "pos"])
    cells = sites.crossJoin(g.select("sample_id").distinct()).join(g.select("chrom", "pos", "sample_id", "dosage", "gq"), ["chrom", "pos", "sample_id"], "left")
    third = F.array(*(F.lit(0.333333),) * 3)
    gp = F.when(F.col("dosage").isNull(), third).otherwise(F.array(F.round((F.col("gq") % 7 + 1) / 16.0, 6), F.round((F.col("dosage") + 1) / 8.0, 6), F.lit(0.25)))
    path = scratch(spark, "beagle")
    writers.write_beagle(cells.withColumn("gp", gp), path)
    return path, cells


@query(V.with_views("g", "s", body=f"@{FULL} SELECT chrom || ':' || CAST(pos AS VARCHAR) AS marker, ref AS allele1, coalesce(alt, '.') AS allele2, sample_id, gp[1] AS l0, gp[2] AS l1, gp[3] AS l2 FROM fl"))
def beagle_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The wide likelihood table, written and read back."""
    return readers.read_beagle(spark, beagle(spark, d)[0]).select("marker", "allele1", "allele2", "sample_id", *(F.col("gl")[i].alias(f"l{i}") for i in range(3)))


@query(V.with_views("g", "s", body=f"@{FULL} SELECT row_number() OVER (ORDER BY chrom, pos) AS n, chrom || ':' || CAST(pos AS VARCHAR) AS marker FROM (SELECT DISTINCT chrom, pos FROM fl)"))
def beagle_order(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers of the markers: the header is line 0 and rows stand in order."""
    lines = readers.numbered_lines(spark, beagle(spark, d)[0])
    return lines.where("n > 0 or not line like 'marker%'").select("n", F.split("line", "\t")[0].alias("marker"))


PILE = """al AS (SELECT l_partkey AS pos, list(CAST(floor(l_quantity) AS BIGINT) % 9 ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity) AS q FROM lineitem GROUP BY 1)"""


@query("WITH " + PILE + """, x AS (SELECT pos, unnest(['X', 'Y']) AS sample_id, q FROM al), y AS (SELECT pos, sample_id, q, unnest([1, 2]) AS i FROM x)
SELECT sample_id, 'm' AS chrom, pos, CASE i WHEN 1 THEN 'A' ELSE 'CT' END AS allele, CASE WHEN sample_id = 'X' THEN coalesce(q[i], 0) ELSE 0 END AS fwd, CASE WHEN sample_id = 'X' THEN 1 ELSE coalesce(q[i], 0) END AS rev FROM y""")
def read_pileup_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of two samples as all-sites lines with alleles in lower case, read back."""
    q = F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"))), lambda x: F.floor(x["l_quantity"]) % 9)
    at = lambda i: F.coalesce(F.get("q", F.lit(i)), F.lit(0)).cast("string")
    rows = V.table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("pos")).agg(q.alias("q"))
    line = F.concat_ws("\t", F.lit("m"), F.col("pos").cast("string"), F.lit("a"), F.lit("a,ct"), F.concat(F.lit("0/1:"), at(0), F.lit(","), at(1), F.lit(":1,1")), F.concat(F.lit("0/1:0,0:"), at(0), F.lit(","), at(1)))
    path = scratch(spark, "pileup")
    rows.select(line.alias("value")).write.text(path)
    return readers.read_pileup_counts(spark, path, ["X", "Y"])


@query(V.with_views("iv", body="""SELECT CAST(weight % 7 AS BIGINT) AS chunk, chrom, start, "end" FROM iv"""))
def interval_chunk_files(spark: SparkSession, d: str) -> DataFrame:
    """One folder per chunk, read back with the chunk from its name."""
    path = scratch(spark, "chunks")
    writers.write_interval_chunks(V.intervals(spark, d).withColumn("chunk", F.col("weight") % 7), path)
    back = spark.read.csv(path, sep="\t", schema="chrom string, start long, end long, name string")
    return back.select(F.substring("name", 1, 6).cast("long").alias("chunk"), "chrom", "start", "end")


@query(V.with_views("s", body="SELECT chrom AS CHROM, pos AS POS, CASE WHEN size % 2 = 0 THEN 'A_FAIL;B_FAIL' END AS FILTER, qual AS QUAL, type AS TYPE, size AS DP, size + 1 AS NS_P0 FROM s"))
def site_metrics_file(spark: SparkSession, d: str) -> DataFrame:
    """The table of metrics with a header line, read back; a site without a failed test has an empty FILTER."""
    s = V.sites(spark, d).withColumns({"filter": F.when(F.col("size") % 2 == 0, F.array(F.lit("A_FAIL"), F.lit("B_FAIL"))).otherwise(F.expr("cast(array() as array<string>)")), "DP": F.col("size"), "NS_P0": F.col("size") + 1, "other": F.lit(1)})
    path = scratch(spark, "metrics")
    writers.write_site_metrics(s, path)
    return spark.read.csv(path, sep="\t", header=True, schema="CHROM string, POS long, FILTER string, QUAL double, TYPE string, DP int, NS_P0 int")


@query(V.with_views("g", body="SELECT chrom AS contig_name, count(*) AS n, count(DISTINCT sample_id) AS n_samples FROM g GROUP BY 1"))
def split_by_contig(spark: SparkSession, d: str) -> DataFrame:
    """One folder per contig, read back by folder."""
    path = scratch(spark, "contigs")
    writers.split_by_contig(V.genotypes(spark, d), path)
    return spark.read.parquet(path).groupBy("contig_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("sample_id").alias("n_samples"))


@query(V.with_views("pop", body="SELECT sample_id || chr(9) || pop AS value FROM pop"))
def collect_file(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.text(text_lines(V.popmap(spark, d), "sample_id", "pop", name="popmap"))


@query(f"WITH {SHEET} SELECT sample, lib, pop, source FROM sheet")
def read_samplesheet(spark: SparkSession, d: str) -> DataFrame:
    """The sheet as a CSV file, read, checked and normalised."""
    path = scratch(spark, "sheet")
    sheet(spark, d).write.csv(path, header=True)
    return readers.normalise_samplesheet(readers.read_samplesheet(spark, path)[0]).select("sample", "lib", "pop", "source")


BASED = """b AS (SELECT 'chr' || CAST(p_partkey % 5 + 1 AS VARCHAR) AS chrom, p_partkey // 5 + 1 AS pos, substr('ACGT', CAST(p_size % 4 AS INT) + 1, 1) AS ref, substr('ACGT', CAST((p_size + 1) % 4 AS INT) + 1, 1) AS alt, p_partkey * 37 AS at FROM part)"""


@query(V.with_views("g", body=f"""@{BASED}, rg AS (SELECT chrom, (pos - 1) // 50 * 50 AS start, min(pos) AS lo FROM b GROUP BY 1, 2), sm AS (SELECT DISTINCT sample_id FROM g),
c AS (SELECT b.chrom, (b.pos - 1) // 50 * 50 AS start, b.pos, sm.sample_id, CASE WHEN coalesce(g.dp, 0) < 10 THEN 'N' WHEN g.dosage = 2 THEN alt WHEN g.dosage = 1 THEN CASE least(ref, alt) || greatest(ref, alt) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' ELSE 'K' END ELSE ref END AS base FROM b CROSS JOIN sm LEFT JOIN g ON g.chrom = b.chrom AND g.pos = b.at AND g.sample_id = sm.sample_id)
SELECT chrom, start, start + 50 AS "end", sample_id, string_agg(base, '' ORDER BY pos) AS seq FROM c GROUP BY 1, 2, 4 HAVING count(*) = 50 AND sum(CASE WHEN base = 'N' THEN 0 ELSE 1 END) > 5"""))
def region_consensus(spark: SparkSession, d: str) -> DataFrame:
    """Consensus of regions of 50 bases for every sample."""
    k = F.col("p_partkey")
    letters = F.array(*(F.lit(x) for x in "ACGT"))
    b = V.table(spark, d, "part").select(*V.site_key("p_partkey"), F.floor(k / 5).alias("i"), F.get(letters, (F.col("p_size") % 4).cast("int")).alias("ref"), F.get(letters, ((F.col("p_size") + 1) % 4).cast("int")).alias("alt"))
    b = b.withColumnRenamed("pos", "at").withColumn("pos", (F.col("i") + 1).cast("long"))
    # places before a contig's first part have no base
    seqs = b.groupBy(F.col("chrom").alias("contig")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ref"))), lambda x: x["ref"]), "").alias("s"), F.min("pos").alias("lo")).select("contig", F.concat(F.repeat(F.lit("N"), (F.col("lo") - 1).cast("int")), "s").alias("seq"))
    whole = b.groupBy("chrom", (F.floor((F.col("pos") - 1) / 50) * 50).alias("start")).agg(F.count(F.lit(1)).alias("n")).where("n = 50").select("chrom", "start", (F.col("start") + 50).alias("end"))
    g = V.genotypes(spark, d).select("chrom", F.col("pos").alias("at"), "sample_id", "dosage", "dp").join(b.select("chrom", "at", "pos", "ref", "alt"), ["chrom", "at"])
    return M.region_consensus(seqs, whole, g.select("chrom", "pos", "sample_id", "ref", "alt", "dosage"), g.select("chrom", "pos", "sample_id", "dp"), "iupac", 10, 5)


@query("""WITH r AS (SELECT event_id, event_type AS chrom, CAST(floor(epoch(ts)) AS BIGINT) % 2000 + 1 AS pos, 'S' || CAST(user_id % 3 AS VARCHAR) AS sample_id, user_id % 2 = 0 AS rev, event_id % 3 AS k, translate(md5(CAST(event_id AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, translate(md5(CAST(event_id + 1 AS VARCHAR)), '0123456789abcdef', '$$IIIIIIIIIIIIII') AS qual FROM events WHERE event_id % 61 >= 20),
b AS (SELECT *, unnest(range(0, 32)) AS i FROM r), p AS (SELECT chrom, sample_id, rev, substr(seq, i + 1, 1) AS allele, CASE k WHEN 0 THEN pos + i WHEN 1 THEN pos + i - 2 ELSE pos + i + CASE WHEN i >= 10 THEN 2 ELSE 0 END END AS pos FROM b WHERE NOT (k = 1 AND i < 2) AND unicode(substr(qual, i + 1, 1)) - 33 >= 13)
SELECT chrom, pos, sample_id, allele, CAST(sum(CASE WHEN rev THEN 0 ELSE 1 END) AS BIGINT) AS fwd, CAST(sum(CASE WHEN rev THEN 1 ELSE 0 END) AS BIGINT) AS rev FROM p GROUP BY 1, 2, 3, 4""")
def pileup(spark: SparkSession, d: str) -> DataFrame:
    """Allele counts of reads with clips and deletions; low base and mapping qualities are left out."""
    e = V.table(spark, d, "events")
    name = F.col("event_id").cast("string")
    cigar = F.element_at(F.array(F.lit("32M"), F.lit("2S30M"), F.lit("10M2D22M")), (F.col("event_id") % 3 + 1).cast("int"))
    reads = e.select(name.alias("qname"), F.when(F.col("user_id") % 2 == 0, 16).otherwise(0).alias("flag"), F.col("event_type").alias("chrom"), (F.unix_timestamp("ts") % 2000 + 1).alias("pos"), (F.col("event_id") % 61).cast("int").alias("mapq"), cigar.alias("cigar"), F.translate(F.md5(name), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"), F.translate(F.md5((F.col("event_id") + 1).cast("string")), "0123456789abcdef", "$$IIIIIIIIIIIIII").alias("qual"), F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("sample_id"))
    return R.pileup(reads, max_depth=10**6)


@query(V.with_views("g", body="SELECT chrom, pos, sample_id, CAST(CASE WHEN gq >= 30 THEN dosage END AS INT) AS called, CASE dosage WHEN 0 THEN 'A' WHEN 1 THEN 'M' ELSE 'C' END AS code, round(power(10, -gq / 10.0) / (power(10, -gq / 10.0) + 1 + power(10, -20 / 10.0)), 6) AS p0 FROM g"))
def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The registered SQL functions, called from SQL text."""
    register_sql_functions(spark)
    V.genotypes(spark, d).createOrReplaceTempView("sql_function_rows")
    high = "array(IF(dosage = 0, 0.95D, 0.02D), IF(dosage = 1, 0.95D, 0.02D), IF(dosage = 2, 0.95D, 0.02D))"
    flat = "array(0.4D, 0.3D, 0.3D)"
    return spark.sql(f"SELECT chrom, pos, sample_id, gp_to_gt(IF(gq >= 30, {high}, {flat}), 0.9D) AS called, iupac('A', IF(dosage = 0, 'A', 'C')) AS heterozygous, round(pl_to_gp(array(gq, 0, 20))[0], 6) AS p0, dosage FROM sql_function_rows").selectExpr("chrom", "pos", "sample_id", "called", "IF(dosage = 2, 'C', heterozygous) AS code", "p0")
