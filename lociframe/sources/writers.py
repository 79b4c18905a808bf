"""Text and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def write_interval_chunks(chunks: DataFrame, path: str) -> None:
    """One folder per chunk, named by its padded number and a hash of its intervals."""
    line = F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"))
    names = chunks.groupBy("chunk").agg(F.md5(F.concat_ws("\n", F.array_sort(F.collect_list(line)))).alias("__h"))
    named = chunks.join(names, "chunk").select(F.concat(F.lpad(F.col("chunk").cast("string"), 6, "0"), F.lit("_"), F.substring("__h", 1, 8)).alias("name"), "chrom", "start", "end")
    named.repartition("name").sortWithinPartitions("name", "chrom", "start").write.mode("overwrite").partitionBy("name").csv(path, sep="\t")


def beagle_rows(gp: DataFrame) -> DataFrame:
    """Wide likelihood rows (chrom, pos, marker, allele1, allele2, values): three columns per sample, in order of sample ids;
    a missing allele is a dot."""
    ordered = F.array_sort(F.collect_list(F.struct("sample_id", "gp")))
    values = F.flatten(F.transform(ordered, lambda x: x["gp"]))
    return gp.groupBy("chrom", "pos", "ref", F.get("alt", F.lit(0)).alias("alt")).agg(values.alias("v")).select("chrom", "pos", F.concat_ws(":", "chrom", F.col("pos").cast("string")).alias("marker"), F.coalesce("ref", F.lit(".")).alias("allele1"), F.coalesce("alt", F.lit(".")).alias("allele2"), F.array_join(F.transform("v", lambda x: F.format_string("%.6f", x)), "\t").alias("values"))


def write_beagle(gp: DataFrame, path: str) -> None:
    """The header line, then rows in order of contig and position: the part files read in order of their names are the table."""
    samples = sorted(r[0] for r in gp.select("sample_id").distinct().collect())  # the header names every sample
    line = "\t".join(["marker", "allele1", "allele2", *(s for s in samples for _ in range(3))])
    head = gp.sparkSession.createDataFrame([(0, "", 0, line)], "__k int, chrom string, pos long, value string")
    rows = beagle_rows(gp).select(F.lit(1).alias("__k"), "chrom", F.col("pos").cast("long").alias("pos"), F.concat_ws("\t", "marker", "allele1", "allele2", "values").alias("value"))
    head.unionByName(rows).orderBy("__k", "chrom", "pos").select("value").write.mode("overwrite").text(path)


def write_fasta(seqs: DataFrame, path: str, width: int = 80) -> None:
    wrapped = F.regexp_replace(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), "\n$", "")
    seqs.select(F.concat(F.lit(">"), "contig", F.lit("\n"), wrapped).alias("value")).write.mode("overwrite").text(path)


def write_site_metrics(metrics: DataFrame, path: str) -> None:
    """CHROM, POS, FILTER, QUAL, TYPE and whichever metric and per-population columns there are."""
    first = {"chrom": "CHROM", "pos": "POS", "filter": "FILTER", "qual": "QUAL", "type": "TYPE"}
    cols = [F.concat_ws(";", "filter").alias("FILTER") if c == "filter" else F.col(c).alias(n) for c, n in first.items() if c in metrics.columns]
    rest = [F.col(c) for c in metrics.columns if c.split("_")[0] in ("DP", "ExcHet", "HWE", "MAF", "NS", "CR")]
    metrics.select(*cols, *rest).write.mode("overwrite").csv(path, sep="\t", header=True)


def concat_ordered(dfs: list[DataFrame], contigs: DataFrame) -> DataFrame:
    """All chunk tables in genome order; if all are empty, an empty table of the same columns."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    ranked = out.join(contigs.select(F.col("contig").alias("chrom"), F.col("rank").alias("__rank")), "chrom", "left")
    return ranked.repartitionByRange("__rank", "pos").sortWithinPartitions("__rank", "pos").drop("__rank").select(*dfs[0].columns)


def split_by_contig(df: DataFrame, path: str) -> None:
    df.withColumn("contig_name", F.regexp_replace("chrom", "[^A-Za-z0-9_.-]", "_")).write.mode("overwrite").partitionBy("contig_name").parquet(path)


def genotype_strings(gt: DataFrame, tile: int = 1 << 20) -> DataFrame:
    """(sample_id, chrom, tile, n_sites, genotypes): per sample and tile of a contig one string of 0, 1, 2 and 3 (missing) over the
    tile's sites in order. Every sample has a row in every tile that has a site."""
    tiled = gt.select("chrom", "pos", "sample_id", "dosage", F.floor(F.col("pos") / tile).cast("long").alias("tile"))
    order = W.partitionBy("chrom", "tile").orderBy("pos")
    sites = tiled.select("chrom", "tile", "pos").distinct().withColumn("i", F.row_number().over(order))
    tiles = sites.groupBy("chrom", "tile").agg(F.count(F.lit(1)).alias("n_sites"))
    called = tiled.where("dosage is not null").join(sites, ["chrom", "tile", "pos"]).groupBy("sample_id", "chrom", "tile").agg(F.array_sort(F.collect_list(F.struct("i", F.col("dosage").cast("string").alias("d")))).alias("c"))
    # a row per sample and tile
    frame = tiles.crossJoin(gt.select("sample_id").distinct()).join(called, ["sample_id", "chrom", "tile"], "left").withColumn("c", F.coalesce("c", F.expr("cast(array() as array<struct<i:int,d:string>>)")))
    gap = lambda a, b: F.repeat(F.lit("3"), (b - a - 1).cast("int"))
    parts = F.transform("c", lambda x, k: F.concat(gap(F.coalesce(F.get(F.col("c"), k - 1)["i"], F.lit(0)), x["i"]), x["d"]))
    tail = gap(F.coalesce(F.get("c", F.size("c") - 1)["i"], F.lit(0)), F.col("n_sites") + 1)
    return frame.select("sample_id", "chrom", "tile", "n_sites", F.concat(F.array_join(parts, ""), tail).alias("genotypes"))


def merge_tables_with_check(dfs: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(all rows, one row of part counts against the merged count)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    parts = sum(d.count() for d in dfs)
    return out, out.agg(F.lit(parts).alias("n_parts"), F.count(F.lit(1)).alias("n_merged")).withColumn("equal", F.col("n_parts") == F.col("n_merged"))
