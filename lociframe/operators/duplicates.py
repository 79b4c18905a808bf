"""Duplicates of sequenced templates: alignments (qname, flag, chrom, start, end, cigar, rg, and qual or qual_sum)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Alignment flag bits.
UNMAPPED, REVERSE, SECONDARY, SUPPLEMENTARY = 0x4, 0x10, 0x100, 0x800
#: Fixed value: base qualities below it do not count in a template's score.
LEAST_QUALITY = 15


def clipped(cigar: Column, pattern: str) -> Column:
    """Bases of the soft and hard clips that the pattern finds in a CIGAR."""
    numbers = F.regexp_extract_all(F.regexp_extract(cigar, pattern, 1), F.lit("([0-9]+)[SH]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def five_prime(reverse: Column) -> Column:
    """The unclipped 5' end: where the read would start had nothing been clipped."""
    lead, trail = clipped(F.col("cigar"), "^((?:[0-9]+[SH])+)"), clipped(F.col("cigar"), "((?:[0-9]+[SH])+)$")
    return F.when(reverse, F.col("end") + trail).otherwise(F.col("start") - lead)


def base_score(qual: Column) -> Column:
    """Sum of the base qualities from LEAST_QUALITY on."""
    scores = F.transform(F.split(qual, ""), lambda c: F.coalesce(F.ascii(c), F.lit(0)) - 33)
    return F.aggregate(scores, F.lit(0).cast("long"), lambda a, x: a + F.when(x >= LEAST_QUALITY, x).otherwise(0))


def mark_duplicates(aln: DataFrame, optical_distance: int = 2500, by_read_group: bool = True) -> DataFrame:
    """aln with `duplicate`, and `optical` where the template lies within `optical_distance` of the kept one on the same tile.

    A template is a name within a read group; its signature is the unclipped 5' ends and strands of its mapped primary reads, and its
    score the sum of their base qualities. Of templates with two or more ends and equal signatures the best stays, by score, then name. A template
    with one mapped end is a duplicate of any pair with that end, else of the best such template. Mapped reads share their template's
    marks, supplementary ones too; unmapped and secondary ones are not marked. by_read_group: templates of different groups are not
    each other's duplicates.

    Tile and coordinates are the last three numbers of a name, before white space. The best of a signature is found by aggregation and
    joined back, so a signature that very many templates share is split like any skewed join.
    """
    bit = lambda b: F.col("flag").bitwiseAND(F.lit(b)) != 0
    score = F.col("qual_sum").cast("long") if "qual_sum" in aln.columns else base_score(F.col("qual"))
    primary = aln.where(~bit(UNMAPPED | SECONDARY | SUPPLEMENTARY)).withColumn("__r", bit(REVERSE))
    ends = primary.select(F.coalesce("rg", F.lit("")).alias("__rg"), "qname", F.struct("chrom", five_prime(F.col("__r")).alias("at"), F.col("__r").alias("r")).alias("e"), score.alias("s"))
    templates = ends.groupBy("__rg", "qname").agg(F.array_sort(F.collect_list("e")).alias("ends"), F.sum("s").alias("score"))
    templates = templates.withColumns({"group": F.col("__rg") if by_read_group else F.lit(""), "first": F.col("ends")[0], "paired": F.size("ends") > 1})
    signature = ["group", "first", "paired", "ends"]
    best = templates.groupBy(*signature).agg(F.min(F.struct((-F.col("score")).alias("n"), "qname", "__rg")).alias("best"))
    taken = templates.where("paired").select("group", F.explode(F.array_distinct("ends")).alias("first")).distinct().withColumn("taken", F.lit(True))
    best = best.join(taken, ["group", "first"], "left").withColumn("taken", F.coalesce("taken", F.lit(False)) & ~F.col("paired"))
    place = lambda c: F.regexp_extract(F.regexp_extract(c, r"^(\S+)", 1), r"^(.*:[0-9]+):[0-9]+:[0-9]+$", 1)
    number = lambda c, i: F.regexp_extract(F.regexp_extract(c, r"^(\S+)", 1), r":([0-9]+):([0-9]+)$", i).try_cast("long")
    kept = F.col("best.qname")
    near = (place(kept) != "") & (place(kept) == place(F.col("qname"))) & (F.abs(number(kept, 1) - number(F.col("qname"), 1)) <= optical_distance) & (F.abs(number(kept, 2) - number(F.col("qname"), 2)) <= optical_distance)
    judged = templates.join(best, signature).select("__rg", "qname", (F.col("taken") | (F.col("best.qname") != F.col("qname")) | (F.col("best.__rg") != F.col("__rg"))).alias("__d"), (near & ~F.col("taken")).alias("__o"))
    marked = aln.withColumn("__rg", F.coalesce("rg", F.lit(""))).join(judged, ["__rg", "qname"], "left")
    duplicate = F.coalesce("__d", F.lit(False)) & ~bit(UNMAPPED | SECONDARY)
    return marked.withColumns({"duplicate": duplicate, "optical": duplicate & F.coalesce("__o", F.lit(False))}).select(*aln.columns, "duplicate", "optical")
