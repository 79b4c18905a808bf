"""Genotype likelihoods, posteriors, calls and transforms on long genotype frames (chrom, pos, sample_id, ...)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELL = ["chrom", "pos", "sample_id"]
SITE = ["chrom", "pos"]


def normalised(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.transform(values, lambda x: x / total)


def genotype_likelihoods(gt: DataFrame, error: float = 0.01, ploidy: int = 2) -> DataFrame:
    """`gl`: likelihood of 0..ploidy alternative alleles given reference and alternative reads (columns n_ref, n_alt), binomial
    in the share of alternative reads with symmetric error; scaled to sum 1. No reads: uniform."""
    logs = [F.col("n_alt") * F.log(F.lit(p)) + F.col("n_ref") * F.log(F.lit(1 - p)) for p in (g / ploidy * (1 - error) + (1 - g / ploidy) * error for g in range(ploidy + 1))]
    top = F.greatest(*logs)
    # plain columns, not functions of arrays: what takes one likelihood of a cell then computes that one, and the shared terms once
    each = [F.exp(x - top) for x in logs]
    total = sum(each[1:], F.lit(0.0) + each[0])
    return gt.withColumn("gl", F.array(*(x / total for x in each)))


def genotype_posteriors(gl: DataFrame, popmap: DataFrame | None = None, model: str = "cohort", rounds: int = 5) -> DataFrame:
    """`gp`: likelihood times Hardy-Weinberg prior. The allele frequency is of the cohort, of each population, or none (flat): a
    fixed number of EM rounds over the likelihoods of a site, which one aggregation puts in one row."""
    if model == "flat":
        return gl.withColumn("gp", normalised(F.col("gl")))
    keys = SITE if model == "cohort" else [*SITE, "pop"]
    cur = gl if model == "cohort" else gl.join(popmap, "sample_id")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for g in batch.column(len(keys)):
                likely, f = np.asarray(g.values, float).reshape(-1, 3), 0.25
                for _ in range(rounds):
                    post = likely * ((1 - f) ** 2, 2 * f * (1 - f), f * f)
                    f = float(((post[:, 1] + 2 * post[:, 2]) / post.sum(1)).sum() / (2 * len(likely)))
                    f = min(max(f, 1e-6), 1 - 1e-6)
                found.append(f)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array(found, pa.float64())], names=[*keys, "f"])

    kinds = ", ".join(f"{k} {cur.schema[k].dataType.simpleString()}" for k in keys)
    freq = cur.where("gl is not null").groupBy(*keys).agg(F.flatten(F.collect_list("gl")).alias("g")).mapInArrow(frequencies, f"{kinds}, f double")
    prior = F.array((1 - F.col("f")) * (1 - F.col("f")), 2 * F.col("f") * (1 - F.col("f")), F.col("f") * F.col("f"))
    return cur.join(freq, keys).withColumn("gp", normalised(F.zip_with("gl", prior, lambda a, b: a * b))).drop("f")


def call_of(gp: Column, min_posterior: float) -> Column:
    top = F.array_max(gp)
    return F.when(1 - top <= 1 - min_posterior, (F.array_position(gp, top) - 1).cast("int"))


def gp_to_gt(gt: DataFrame, min_posterior: float = 0.9) -> DataFrame:
    """The most probable genotype where its posterior is at least min_posterior, else missing."""
    return gt.withColumn("dosage", call_of(F.col("gp"), min_posterior))


def mask_zero_depth(gt: DataFrame) -> DataFrame:
    return gt.withColumn("dosage", F.when(~F.coalesce(F.col("dp") == 0, F.lit(False)), F.col("dosage")))


def set_variant_id(sites: DataFrame) -> DataFrame:
    return sites.withColumn("id", F.concat_ws("_", "chrom", F.col("pos").cast("string"), "ref", F.get("alt", F.lit(0))))


def constrain_to_panel(calls: DataFrame, panel: DataFrame, exclude: DataFrame) -> DataFrame:
    """Biallelic panel sites outside the excluded intervals, with the calls there; absent sites have nulls."""
    from lociframe.operators.intervals import site_in_mask

    used = site_in_mask(panel.where(F.size("alt") == 1), exclude, "__x").where("__x = 0").drop("__x")
    return used.join(calls.drop(*[c for c in calls.columns if c in panel.columns and c not in SITE]), SITE, "left")


#: Bases of a tile of the cohort matrix, and samples of a block of it.
TILE, SAMPLES = 65_536, 256


def combine_samples(variants: DataFrame, blocks: DataFrame) -> DataFrame:
    """Cohort matrix at variant sites: each sample's variant call (chrom, pos, sample_id, dosage, dp), or dosage 0 with the depth of the
    reference block that holds the site (sample_id, chrom, start, end, dp; the deepest if they overlap), or missing. A sample has one
    call at a site at most.

    A task has a tile's sites, its variant calls and reference blocks of some samples, and lays each block over the sorted sites; a block
    is a row for each tile that it reaches into, however many sites it holds.
    """
    number = lambda n: F.pmod(F.xxhash64("sample_id"), F.lit(n)).cast("int")
    samples = blocks.select("sample_id").unionByName(variants.select("sample_id")).where("sample_id is not null").distinct()
    parts = max(1, -(-samples.count() // SAMPLES))
    tile = lambda c: F.floor(c / TILE)
    sites = variants.where("chrom is not null and pos is not null").select(*SITE, tile(F.col("pos") - 1).alias("tile")).distinct()
    names = samples.groupBy(number(parts).alias("part")).agg(F.collect_list("sample_id").alias("names"))
    keys = sites.select("chrom", "tile").distinct().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(names, "part")
    kind = dict(variants.dtypes)["dp"]
    columns = {"kind": "int", "pos": "bigint", "end": "bigint", "sample_id": "string", "dosage": "int", "dp": "bigint", "names": "array<string>"}

    def rows(df: DataFrame, **given: Column) -> DataFrame:
        return df.select("chrom", "tile", "part", *(given.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()))

    c = F.col
    placed = blocks.where(c("end") > c("start")).withColumn("tile", F.explode(F.sequence(tile(c("start")), tile(c("end") - 1)))).withColumn("part", number(parts))
    union = rows(keys, kind=F.lit(0), names=c("names"))
    union = union.unionByName(rows(sites.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), kind=F.lit(1), pos=c("pos")))
    union = union.unionByName(rows(variants.withColumn("tile", tile(c("pos") - 1)).withColumn("part", number(parts)), kind=F.lit(2), pos=c("pos"), sample_id=c("sample_id"), dosage=c("dosage"), dp=c("dp")))
    union = union.unionByName(rows(placed, kind=F.lit(3), pos=c("start"), end=c("end"), sample_id=c("sample_id"), dp=c("dp")))

    def lay(key: tuple, group: pa.Table) -> pa.Table:
        of = lambda k: group.filter(pc.equal(group.column("kind"), k))
        names = [s for some in of(0).column("names").to_pylist() for s in some]
        pos = np.unique(of(1).column("pos").to_numpy())
        at = {s: i for i, s in enumerate(names)}
        none = np.iinfo(np.int64).min
        deep = np.full((len(names), len(pos)), none)
        covering = of(3)
        if len(pos) and len(names):
            dp = covering.column("dp").combine_chunks().fill_null(none + 1).to_numpy()  # a block without a depth still holds its sites
            low, high = (np.searchsorted(pos - 1, covering.column(x).to_numpy(), "left") for x in ("pos", "end"))
            for s, a, b, d in zip(covering.column("sample_id").to_pylist(), low.tolist(), high.tolist(), dp.tolist(), strict=True):
                if a < b and s in at:
                    np.maximum(deep[at[s], a:b], d, out=deep[at[s], a:b])
        deep[deep == none + 1] = none
        called, depth = np.full(deep.shape, none), np.full(deep.shape, none)
        calls = of(2)
        known = [i for i, s in enumerate(calls.column("sample_id").to_pylist()) if s in at]
        calls = calls.take(pa.array(known, pa.int64()))
        i = np.array([at[s] for s in calls.column("sample_id").to_pylist()], np.int64)
        j = np.searchsorted(pos, calls.column("pos").to_numpy())
        called[i, j] = calls.column("dosage").combine_chunks().cast(pa.int64()).fill_null(none).to_numpy()
        depth[i, j] = calls.column("dp").combine_chunks().fill_null(none).to_numpy()
        dosage = np.where(called != none, called, np.where((deep != none) & (depth == none), 0, none)).ravel()
        dp = np.where(depth != none, depth, deep).ravel()
        n = len(names) * len(pos)
        return pa.table({"chrom": pa.array([key[0].as_py()] * n, pa.string()), "pos": pa.array(np.tile(pos, len(names))), "sample_id": pa.array(np.repeat(np.array(names, object), len(pos)), pa.string()), "dosage": pa.array(dosage.astype(np.int32), mask=dosage == none), "dp": pa.array(dp, mask=dp == none)})

    cells = union.groupBy("chrom", "tile", "part").applyInArrow(lay, "chrom string, pos long, sample_id string, dosage int, dp long")
    return cells.withColumn("dp", c("dp").cast(kind))


def gvcf_bands(persite: DataFrame, edges: list[int]) -> DataFrame:
    """Runs of neighbouring reference sites (sample_id, chrom, pos, dp, gq) in one GQ band; runs without depth or quality go."""
    band = sum((F.col("gq") >= e).cast("int") for e in edges)
    order = W.partitionBy("sample_id", "chrom", "band").orderBy("pos")
    runs = persite.withColumn("band", band).withColumn("run", F.col("pos") - F.row_number().over(order))
    blocks = runs.groupBy("sample_id", "chrom", "band", "run").agg((F.min("pos") - 1).alias("start"), F.max("pos").alias("end"), F.min("dp").alias("min_dp"), F.max("dp").alias("max_dp"), F.max("gq").alias("max_gq"))
    return blocks.where("max_dp > 0 and max_gq > 0").drop("run", "max_dp", "max_gq")


def max_alt_alleles(sites: DataFrame, n: int) -> DataFrame:
    return sites.where(F.size("alt") <= n)


def gp_of_pl(pl: Column) -> Column:
    return normalised(F.transform(pl, lambda x: F.pow(F.lit(10.0), -x / 10.0)))


def pl_to_gp(gt: DataFrame, use_posteriors: bool = False) -> DataFrame:
    """`gp` from phred likelihoods `pl` (or from posteriors `pp`): 10^(-x/10), normalised; sites where any sample has values;
    a missing cell is uniform."""
    source = "pp" if use_posteriors else "pl"
    any_here = F.max(F.col(source).isNotNull()).over(W.partitionBy(*SITE))
    third = F.array(*(F.lit(1.0 / 3),) * 3)
    return gt.withColumn("__any", any_here).where("__any").drop("__any").withColumn("gp", F.coalesce(gp_of_pl(F.col(source)), third))


def pseudohaploid(gt: DataFrame, seed: int = 123) -> DataFrame:
    """One allele drawn in proportion to allele depths `ad`, by a hash of seed and cell; dosage 0, 2 or missing. An index of 2
    or more leaves the genotype as it is."""
    total = F.aggregate("ad", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    draw = F.pmod(F.xxhash64(F.lit(seed), *CELL), F.col("__total"))
    index = F.aggregate("ad", F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("hit")), lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["i"] + 1).alias("i"), F.when((a["hit"] < 0) & (F.col("__draw") < a["sum"] + x), a["i"]).otherwise(a["hit"]).alias("hit")), lambda a: a["hit"])
    drawn = gt.withColumn("__total", total).withColumn("__draw", F.when(F.col("__total") > 0, draw)).withColumn("__allele", F.when(F.col("__total") > 0, index))
    call = F.when(F.col("__allele").isNull(), F.lit(None)).when(F.col("__allele") == 0, 0).when(F.col("__allele") == 1, 2).otherwise(F.col("dosage"))
    return drawn.withColumn("dosage", call.cast("int")).drop("__total", "__draw", "__allele")


def expand_blocks(blocks: DataFrame) -> DataFrame:
    """One row per base of each block (chrom, start, end, ...): for blocks of bounded length."""
    rest = [c for c in blocks.columns if c not in ("start", "end")]
    return blocks.where("end > start").select(*rest, F.explode(F.sequence(F.col("start") + 1, F.col("end"))).alias("pos"))


def single_read_ibs(counts: DataFrame, mode: str = "random", seed: int = 123) -> DataFrame:
    """One base per cell from columns A, C, G, T (read counts): the most frequent (ties in letter order) or a draw by hash;
    -1 without reads."""
    bases = ["A", "C", "G", "T"]
    total = sum(F.col(b) for b in bases)
    if mode == "major":
        top = F.greatest(*bases)
        pick = F.coalesce(*(F.when(F.col(b) == top, F.lit(i)) for i, b in enumerate(bases)))
    else:
        at, run, pick = F.pmod(F.xxhash64(F.lit(seed), *CELL), F.greatest(total, F.lit(1))), F.lit(0), F.lit(None).cast("int")
        for i, b in enumerate(bases):
            run = run + F.col(b)
            pick = F.coalesce(pick, F.when(at < run, F.lit(i)))
    return counts.withColumn("allele", F.when(total > 0, pick).otherwise(-1))


def shared(a: Column, b: Column, most: Column, at_end: bool) -> Column:
    """How many characters, `most` at the most, two strings share at their end or start: each length is tried."""
    same = (lambda n: F.right(a, n) == F.right(b, n)) if at_end else (lambda n: F.left(a, n) == F.left(b, n))
    return F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), lambda n: (n == 0) | same(n))), F.lit(0))


def normalise_variants(sites: DataFrame, flank: str | None = None) -> DataFrame:
    """Shared ends of ref and each alt trimmed (suffix first, then prefix, one base kept), position moved, one row per alt.

    `flank` names a column with the reference bases right before pos: an insertion or deletion that could as well stand
    further left moves there, as far as the flank shows.
    """
    before = F.col(flank) if flank else F.lit("")
    one = sites.select("chrom", "pos", "ref", F.explode("alt").alias("alt"), F.coalesce(before, F.lit("")).alias("__flank"))
    r, a = F.col("ref"), F.col("alt")
    tail = one.withColumn("__t", shared(r, a, F.least(F.length(r), F.length(a)) - 1, True))
    cut = tail.withColumns({"ref": F.left(r, F.length(r) - F.col("__t")), "alt": F.left(a, F.length(a) - F.col("__t"))})
    headed = cut.withColumn("__h", shared(r, a, F.least(F.length(r), F.length(a)) - 1, False))
    moved = headed.select("chrom", (F.col("pos") + F.col("__h")).alias("pos"), F.substr(r, F.col("__h") + 1).alias("ref"), F.substr(a, F.col("__h") + 1).alias("alt"), F.concat("__flank", F.left(r, F.col("__h"))).alias("__flank"))
    # an indel of the bases `unit` after an anchor base may move by n if the last n bases up to the anchor continue it backwards
    indel = (F.least(F.length(r), F.length(a)) == 1) & (F.length(r) != F.length(a)) & (F.left(r, F.lit(1)) == F.left(a, F.lit(1)))
    unit = F.substr(F.when(F.length(r) > F.length(a), r).otherwise(a), F.lit(2))
    shown = moved.withColumns({"__unit": F.when(indel, unit), "__left": F.concat("__flank", F.left(r, F.lit(1)))})
    left, u = F.col("__left"), F.col("__unit")
    # bases n places before the end of `left` against those of the unit, over and over
    differ = F.filter(F.sequence(F.lit(1), F.greatest(F.length(left), F.lit(1))), lambda n: F.substr(left, F.length(left) - n + 1, F.lit(1)) != F.substr(u, F.length(u) - F.pmod(n - 1, F.length(u)), F.lit(1)))
    steps = F.when(u.isNull(), 0).otherwise(F.least(F.coalesce(F.get(differ, F.lit(0)) - 1, F.length(left)), F.length(left) - 1))
    placed = shown.withColumn("__n", steps)
    n = F.col("__n")
    base = F.substr(left, F.length(left) - n, F.lit(1))
    rolled = F.concat(base, F.left(F.concat(F.right(left, n), u), F.length(u)))
    here = lambda c: F.when(n == 0, c).when(F.length(c) == 1, base).otherwise(rolled)
    return placed.select("chrom", (F.col("pos") - n).alias("pos"), here(r).alias("ref"), here(a).alias("alt")).distinct()
