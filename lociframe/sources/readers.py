"""Text formats as frames. Every reader scans with Spark, so any store that Spark reads will do, and gz files too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.lineage import kept

SHEET = ["sample", "lib", "pop", "fwd", "rev"]
ACCESSION = r"^(?i)[SED]RR[0-9]{6,}$"


def read_samplesheet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with a reason): sample of three characters or more, fwd required; an accession has no rev, else rev is required."""
    raw = spark.read.csv(path, header=True, schema=", ".join(f"{c} string" for c in SHEET))
    accession = F.trim("fwd").rlike(ACCESSION)
    reason = (
        F.when(F.col("sample").isNull() | (F.length(F.trim("sample")) < 3), "sample").when(F.col("lib").isNotNull() & (F.length("lib") > 0) & F.col("lib").rlike(r"[\s|]"), "lib")
        .when(F.col("fwd").isNull() | (F.length(F.trim("fwd")) < 3), "fwd").when(accession & F.col("rev").isNotNull() & (F.trim("rev") != ""), "rev with accession").when(~accession & (F.col("rev").isNull() | (F.trim("rev") == "")), "rev")
    )
    judged = raw.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def normalise_samplesheet(sheet: DataFrame) -> DataFrame:
    """Trimmed; a blank lib is the sample, a blank pop 'unknown', whitespace in pop an underscore; source by the form of fwd."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    fwd = F.trim("fwd")
    source = F.when(fwd.rlike(ACCESSION), "accession").when(fwd.rlike(r"^(?i)(https?|ftp|s3|gs)://"), "url").otherwise("local")
    return sheet.select(F.trim("sample").alias("sample"), F.when(blank("lib"), F.trim("sample")).otherwise(F.trim("lib")).alias("lib"), F.when(blank("pop"), "unknown").otherwise(F.regexp_replace(F.trim("pop"), r"\s+", "_")).alias("pop"), source.alias("source"), fwd.alias("input1"), F.when(~blank("rev"), F.trim("rev")).alias("input2"))


def group_reads(sheet: DataFrame) -> DataFrame:
    """Per sample its libraries and inputs; mixed source types are an error when read."""
    out = sheet.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("lib", "input1", "input2"))).alias("inputs"), F.collect_set("source").alias("__s"))
    return out.withColumn("source", F.when(F.size("__s") == 1, F.col("__s")[0]).otherwise(F.raise_error(F.concat(F.lit("mixed sources: "), "sample")))).drop("__s")


def popmap(sheet: DataFrame, need_two: bool = False) -> DataFrame:
    """sample_id -> pop, one row per sample (first pop by name). need_two: fewer than two populations is an error."""
    out = sheet.groupBy(F.col("sample").alias("sample_id")).agg(F.min("pop").alias("pop"))
    if need_two and out.select("pop").distinct().limit(2).count() < 2:
        raise ValueError("at least two populations are needed")
    return out


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("line"))


def read_bed(spark: SparkSession, path: str, label: str = "") -> DataFrame:
    """(chrom, start, end, label): comments and blank lines skipped, a default label where there is no fourth column."""
    parts = lines_of(spark, path).where(~F.col("line").rlike("^(#|track|browser|\\s*$)")).select(F.split("line", "\t").alias("p"))
    return parts.select(F.col("p")[0].alias("chrom"), F.col("p")[1].cast("long").alias("start"), F.col("p")[2].cast("long").alias("end"), F.coalesce(F.get("p", F.lit(3)), F.lit(label)).alias("label"))


def read_sitelist(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, pos 1-based) from `chr:pos`, two columns, or intervals of three; starts below 0 become 0."""
    lines = lines_of(spark, path).where(~F.col("line").rlike(r"^(#|\s*$)"))
    p = F.split(F.regexp_replace("line", r"^([^\t]+):([0-9]+)$", "$1\t$2"), "\t")
    three = F.sequence(F.greatest(F.lit(0), F.col("p")[1].cast("long")) + 1, F.col("p")[2].cast("long"))
    return lines.select(p.alias("p")).select(F.col("p")[0].alias("chrom"), F.explode(F.when(F.size("p") >= 3, three).otherwise(F.array(F.col("p")[1].cast("long")))).alias("pos"))


def _missing(c: Column) -> Column:
    return F.when(~c.isin(".", ""), c)


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(sites, genotypes). Sample names come from the header line; `.` is null; a genotype with a missing allele is missing."""
    lines = lines_of(spark, path)
    header = lines.where(F.col("line").startswith("#CHROM")).first()
    samples = header["line"].split("\t")[9:] if header else []
    p = lines.where(~F.col("line").startswith("#") & (F.col("line") != "")).select(F.split("line", "\t").alias("p"))
    c = lambda i: F.col("p")[i]
    site = p.select(
        c(0).alias("chrom"), c(1).cast("long").alias("pos"), _missing(c(2)).alias("id"), c(3).alias("ref"), F.when(c(4) == ".", F.expr("cast(array() as array<string>)")).otherwise(F.split(c(4), ",")).alias("alt"), _missing(c(5)).cast("double").alias("qual"),
        F.when(c(6).isin(".", "PASS"), F.expr("cast(array() as array<string>)")).otherwise(F.split(c(6), ";")).alias("filter"), F.str_to_map(c(7), F.lit(";"), F.lit("=")).alias("info"), F.get("p", F.lit(8)).alias("__format"), F.slice("p", 10, max(len(samples), 1)).alias("__cells"),
    )
    size = F.array_max(F.transform(F.concat(F.array("ref"), "alt"), F.length))
    kind = F.when(F.size("alt") == 0, "REF").when(size == 1, "SNP").otherwise("INDEL")
    site = site.withColumn("type", kind)
    names = F.array(*(F.lit(s) for s in samples)) if samples else F.expr("cast(array() as array<string>)")
    cell = site.select("chrom", "pos", "__format", F.explode(F.arrays_zip(names.alias("n"), F.col("__cells").alias("v"))).alias("z")).select("chrom", "pos", F.col("z.n").alias("sample_id"), F.map_from_arrays(F.slice(F.split("__format", ":"), 1, F.size(F.split(F.col("z.v"), ":"))), F.split(F.col("z.v"), ":")).alias("m"))
    field = lambda k: _missing(F.col("m")[k])
    ints = lambda k: F.when(field(k).isNotNull(), F.transform(F.split(field(k), ","), lambda x: x.cast("int")))
    gt = F.split(field("GT"), "[/|]")
    dosage = F.when(F.col("m")["GT"].isNotNull() & ~F.col("m")["GT"].contains("."), F.aggregate(F.transform(gt, lambda a: (a.cast("int") > 0).cast("int")), F.lit(0), lambda s, x: s + x))
    gts = cell.where("sample_id is not null").select("chrom", "pos", "sample_id", dosage.alias("dosage"), field("DP").cast("int").alias("dp"), field("GQ").cast("int").alias("gq"), ints("AD").alias("ad"), ints("PL").alias("pl"), F.when(field("GP").isNotNull(), F.transform(F.split(field("GP"), ","), lambda x: x.cast("double"))).alias("gp"))
    return site.drop("__format", "__cells"), gts


def gvcf_blocks(sites: DataFrame) -> DataFrame:
    """Reference blocks and records as [pos - 1, END or pos) of weight 1."""
    return sites.select("chrom", (F.col("pos") - 1).alias("start"), F.coalesce(F.col("info")["END"].cast("long"), "pos").alias("end"), F.lit(1).alias("weight"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq, length, rank). A record is one row; ranks follow the order in the files.
    For genomes, `fasta.read_fasta_tiles` reads tiles instead."""
    parts = numbered_splits(by_split(spark.read.text(path, lineSep="\n>"))).select(F.regexp_replace("value", "^>", "").alias("value"), F.col("n").alias("__at"))
    records = parts.where(F.trim("value") != "")
    named = records.select("__at", F.regexp_extract("value", r"^(\S+)", 1).alias("contig"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "").alias("seq"))
    # one number per contig
    ranks = records.select("__at").withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("__at")))
    return named.join(ranks, "__at").select("contig", "seq", F.length("seq").cast("long").alias("length"), "rank")


def by_split(rows: DataFrame) -> DataFrame:
    """Rows of a scan with their row id `__id` and their split, `__file` and `__start`. Spark deals splits by size, so row ids follow the
    order of the files only within a split."""
    return rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__id"))


def numbered_splits(rows: DataFrame) -> DataFrame:
    """rows of `by_split` with `n`, their number from 0 in the order of the files' names. A split's rows are counted from its least id, and
    the splits before it, a row per split, once. The rows are written first: splits follow the number of cores, so a second scan of the
    text has others where executors come or go in between."""
    rows = kept(rows, "splits")
    counts = rows.groupBy("__file", "__start").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    # one row per split
    line = W.partitionBy(F.lit(0)).orderBy("__file", "__start").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("__file", "__start", (F.coalesce(F.sum("__n").over(line), F.lit(0)) - F.col("__first")).alias("__shift"))
    return rows.join(F.broadcast(before), ["__file", "__start"]).withColumn("n", F.col("__id") + F.col("__shift")).drop("__file", "__start", "__id", "__shift")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, n): lines with their number from 0, in the order of the files' names."""
    return numbered_splits(by_split(spark.read.text(path))).select(F.col("value").alias("line"), "n")


def read_fastq(spark: SparkSession, path: str, mate: int) -> DataFrame:
    """(read_id, seq, qual, mate): four lines a record."""
    lines = numbered_lines(spark, path)
    at = F.pmod("n", F.lit(4))
    wide = lines.groupBy(F.floor(F.col("n") / 4).alias("__rec")).agg(*(F.max(F.when(at == i, F.col("line"))).alias(c) for i, c in ((0, "read_id"), (1, "seq"), (3, "qual"))))
    return wide.select("read_id", "seq", "qual", F.lit(mate).alias("mate"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(alignments with a map of tags, header lines)."""
    lines = lines_of(spark, path)
    p = lines.where(~F.col("line").startswith("@") & (F.col("line") != "")).select(F.split("line", "\t").alias("p"))
    names = ["qname", "flag", "contig", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    kinds = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}
    tags = F.map_from_entries(F.transform(F.slice("p", 12, 1000), lambda t: F.struct(F.split(t, ":", 3)[0], F.split(t, ":", 3)[2])))
    header = lines.where(F.col("line").startswith("@")).select(F.substring("line", 2, 2).alias("record"), "line")
    return p.select(*(F.col("p")[i].cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)), tags.alias("tags")), header


def read_beagle(spark: SparkSession, path: str) -> DataFrame:
    """(marker, allele1, allele2, sample_id, gl[3]) from the wide table; three columns per sample."""
    lines = lines_of(spark, path)
    header = lines.where(F.col("line").startswith("marker")).first()
    if header is None:
        raise ValueError("no header line that begins with marker")
    head = header["line"].split("\t")[3::3]
    p = lines.where(~F.col("line").startswith("marker") & (F.col("line") != "")).select(F.split("line", "\t").alias("p"))
    value = F.transform(F.sequence(F.lit(0), F.lit(len(head) - 1)), lambda i: F.transform(F.slice(F.col("p"), 4 + 3 * i, F.lit(3)), lambda x: x.cast("double")))
    return p.select(F.col("p")[0].alias("marker"), F.col("p")[1].alias("allele1"), F.col("p")[2].alias("allele2"), F.explode(F.arrays_zip(F.array(*(F.lit(s) for s in head)).alias("s"), value.alias("g"))).alias("z")).select("marker", "allele1", "allele2", F.col("z.s").alias("sample_id"), F.col("z.g").alias("gl"))


def read_pileup_counts(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """(sample_id, chrom, pos, allele in upper case, fwd, rev) from rows chrom, pos, ref, alleles, then GT:FWD:REV per sample; another number
    of columns is an error when read."""
    p = lines_of(spark, path).where(~F.col("line").rlike("^(#|$)")).select(F.split("line", "\t").alias("p"))
    checked = p.select(F.when(F.size("p") == 4 + len(samples), F.col("p")).otherwise(F.raise_error(F.lit("columns do not match the samples"))).alias("p"))
    cells = checked.select(F.col("p")[0].alias("chrom"), F.col("p")[1].cast("long").alias("pos"), F.split(F.upper(F.col("p")[3]), ",").alias("a"), F.explode(F.arrays_zip(F.array(*(F.lit(s) for s in samples)).alias("s"), F.slice("p", 5, len(samples)).alias("v"))).alias("z"))
    counts = cells.select("chrom", "pos", F.col("z.s").alias("sample_id"), "a", F.split(F.split(F.col("z.v"), ":")[1], ",").alias("f"), F.split(F.split(F.col("z.v"), ":")[2], ",").alias("r"))
    return counts.select("sample_id", "chrom", "pos", F.explode(F.arrays_zip("a", "f", "r")).alias("z")).select("sample_id", "chrom", "pos", F.col("z.a").alias("allele"), F.col("z.f").cast("long").alias("fwd"), F.col("z.r").cast("long").alias("rev"))
