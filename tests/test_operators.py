"""Rules that define the filters, the consensus, exact tests, dataflow steps, streams, and files."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.functions.sql import register_sql_functions
from lociframe.operators import dataflow as D
from lociframe.operators import filters as Q
from lociframe.operators import genotypes as G
from lociframe.operators import ld as L
from lociframe.operators import mito as M
from lociframe.operators import popgen as P
from lociframe.operators import reads as R
from lociframe.operators import saf as S
from lociframe.operators import sequence as K
from lociframe.operators import sfs as X
from lociframe.operators.params import TypeThresholds
from lociframe.sources import readers, writers
from lociframe.streaming import incremental
from lociframe.streaming.store import Store


def test_missing_values_never_fail(spark):
    t = spark.createDataFrame([("c", 1, "SNP", None, 0.2), ("c", 2, "SNP", 30.0, 0.2), ("c", 3, "SNP", 29.9, None)], "chrom string, pos long, type string, qual double, CR double")
    out = Q.global_site_filters(t, {"SNP": TypeThresholds(qual=30, cr=0.3)}).orderBy("pos").collect()
    assert [r["filter"] for r in out] == [["CR_FAIL"], ["CR_FAIL"], ["QUAL_FAIL"]]
    assert [r["filter"] for r in Q.global_site_filters(t, {}).collect()] == [[], [], []]


def test_sample_at_the_threshold_is_dropped_but_labelled_pass(spark):
    m = spark.createDataFrame([("x", 0.5), ("y", 0.4), ("z", 0.6)], "SAMPLE string, MISSING_FRACTION double")
    assert [r[0] for r in Q.keep_samples(m, 0.5).collect()] == ["y"]
    assert sorted((r["STATUS"], r["COUNT"]) for r in Q.sample_missing_qc(m, 0.5, 1).collect()) == [("FAIL", 1), ("PASS", 2)]


def test_depth_bounds_nearest_rank(spark):
    h = spark.createDataFrame([(0, 1), (5, 8), (9, 1)], "depth long, count long")
    assert tuple(Q.depth_bounds(h, 10, 90).first()) == (0, 5)
    assert tuple(Q.depth_bounds(h, 10.1, 90.1).first()) == (5, 9)


def test_hwe_against_enumeration():
    def brute(a, b, c):
        n, k = a + b + c, 2 * a + b
        p = {h: math.factorial(n) / (math.factorial((k - h) // 2) * math.factorial(h) * math.factorial(n - (k + h) // 2)) * 2**h for h in range(k % 2, min(k, 2 * n - k) + 1, 2)}
        t = sum(p.values())
        return sum(v for v in p.values() if v <= p[b] * (1 + 1e-9)) / t, sum(v for h, v in p.items() if h >= b) / t

    r = random.Random(3)
    for _ in range(60):
        x = [r.randint(0, 9) for _ in range(3)]
        if sum(x):
            assert Q.hwe_p(*x) == pytest.approx(brute(*x))


def test_greedy_prune(spark):
    r = random.Random(5)
    sites = [("c", p, r.randint(0, 5)) for p in range(30)]
    pairs = [("c", a, b, 0.9) for a in range(30) for b in range(a + 1, min(a + 5, 30)) if r.random() < 0.4]
    kept = set()
    for _, p, _ in sorted(sites, key=lambda s: (-s[2], s[1])):
        if not any((a == p and b in kept) or (b == p and a in kept) for _, a, b, _ in pairs):
            kept.add(p)
    got = L.ld_prune(spark.createDataFrame(pairs, "chrom string, pos_a long, pos_b long, r2 double"), spark.createDataFrame(sites, "chrom string, pos long, priority int"))
    assert {x["pos"] for x in got.collect()} == kept


def test_mito_rules(spark):
    def call(a, c, other=0, **settings):
        o = spark.createDataFrame([("s", 1, a, c, 0, 0, other, a + c, a + c + other, other / max(1, a + c + other))], "sample_id string, pos long, A long, C long, G long, T long, non_snv long, depth long, total_depth long, non_snv_af double")
        x = M.call_major_allele(o, **settings).first()
        return x["filter"], x["base"]

    assert call(5, 4) == ("LOW_DEPTH", "N") and call(8, 2) == ("PASS", "A") and call(7, 3) == ("LOW_MAJOR_AF", "N")
    assert call(8, 0, 3) == ("NON_SNV_EVIDENCE", "N") and call(8, 0, 2) == ("PASS", "A") and call(0, 0, 0, min_depth=0) == ("NO_BASE_SUPPORT", "N")
    mixed = {"het_mode": "iupac", "min_depth": 3, "mixed_min_af": 0.2}
    for minor, want in ((1, ("LOW_MAJOR_AF", "N")), (2, ("LOW_MAJOR_AF", "N")), (3, ("MIXED_IUPAC", "M")), (4, ("MIXED_IUPAC", "M"))):
        assert call(2 * minor, minor, **mixed) == want and call(2 * minor, minor, min_depth=3)[1] == "N"
    assert call(78, 22, het_mode="iupac") == ("MIXED_IUPAC", "M") and call(78, 22, het_mode="iupac", mixed_min_af=0.25) == ("LOW_MAJOR_AF", "N")
    assert call(5, 15, het_mode="iupac", min_minor_depth=6)[0] == "LOW_MAJOR_AF"
    with pytest.raises(ValueError):
        call(1, 1, het_mode="other")
    with pytest.raises(ValueError):
        M.validate_mito(100, 1, 100, [0.5])
    counts = spark.createDataFrame([("s", 1, "a", 2, 1), ("s", 1, "A", 1, None), ("s", 1, "ct", 4, 0), ("s", 1, None, 0, 2)], "sample_id string, pos long, allele string, fwd long, rev long")
    x = M.allele_counts(counts).first()
    assert (x["A"], x["non_snv"], x["depth"], x["total_depth"]) == (4, 6, 4, 10)


def test_circular_positions(spark):
    x = M.shifted_to_original(spark.createDataFrame([(1,), (50,), (51,), (100,)], "pos long"), 50, 100)
    assert [r[0] for r in x.collect()] == [51, 100, 1, 50]
    assert K.circular_shift(spark.createDataFrame([("m", "ABCDE")], "contig string, seq string"), 7).first()["seq"] == "CDEAB"


def test_masks(spark):
    c = spark.createDataFrame([("x", "NNacGTNNN"), ("y", "acgt"), ("z", "")], "contig string, seq string")
    assert sorted((r["chrom"], r["start"], r["end"]) for r in K.hard_mask(c).collect()) == [("x", 0, 2), ("x", 6, 9)]
    assert sorted((r["chrom"], r["start"], r["end"]) for r in K.soft_mask(c).collect()) == [("x", 2, 4), ("y", 0, 4)]


def test_pseudohaploid_is_deterministic_and_leaves_other_alleles(spark):
    g = spark.createDataFrame([("c", p, "s", 1, ad) for p, ad in enumerate([[5, 0], [0, 5], [0, 0], [0, 0, 4]])], "chrom string, pos long, sample_id string, dosage int, ad array<int>")
    out = [r["dosage"] for r in G.pseudohaploid(g).orderBy("pos").collect()]
    assert out == [0, 2, None, 1] and out == [r["dosage"] for r in G.pseudohaploid(g).orderBy("pos").collect()]


def test_normalise(spark):
    s = spark.createDataFrame([("c", 10, "CTT", ["CT"]), ("c", 20, "GAC", ["GTC", "GAC"])], "chrom string, pos long, ref string, alt array<string>")
    assert ("c", 21, "A", "T") in [tuple(r) for r in G.normalise_variants(s).collect()]
    assert ("c", 10, "CT", "C") in [tuple(r) for r in G.normalise_variants(s).collect()]


def test_indels_move_left_as_far_as_the_flank_shows(spark):
    def brute(flank, ref, alt, pos):
        """The leftmost pair of alleles that makes the same sequence: every start and shape is tried."""
        here, there = flank + ref, flank + alt
        while len(here) > 1 and len(there) > 1 and here[-1] == there[-1]:
            here, there = here[:-1], there[:-1]
        k = 0
        while len(here) - k > 1 and len(there) - k > 1 and here[k] == there[k]:
            k += 1
        return pos - len(flank) + k, here[k:], there[k:]

    r, rows = random.Random(4), []
    for p in range(300):
        flank, ref = "".join(r.choice("AC") for _ in range(r.randint(1, 6))), "".join(r.choice("AC") for _ in range(r.randint(1, 4)))
        alt = ref[:1] + "".join(r.choice("AC") for _ in range(r.randint(0, 4)))
        if alt != ref:
            rows.append(("c", 100 * p + 50, ref, [alt], flank))
    sites = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt array<string>, before string")
    got = {x["pos"] // 100: (x["pos"], x["ref"], x["alt"]) for x in G.normalise_variants(sites, "before").collect()}
    for _, pos, ref, (alt,), flank in rows:
        want = brute(flank, ref, alt, pos)
        if 1 in (len(want[1]), len(want[2])) and len(want[1]) != len(want[2]):
            assert got[pos // 100] == want


def test_spectrum_likelihoods_of_long_cohorts(spark):
    rows = [("c", 1, f"s{s:03}", [0.9, 0.05, 0.05] if s % 3 else [0.05, 0.9, 0.05]) for s in range(200)]
    saf = S.site_allele_likelihood(spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>")).first()["saf"]
    assert len(saf) == 401 and max(saf) == pytest.approx(1.0) and all(math.isfinite(x) and x >= 0 for x in saf)


def test_bipartition_keeps_two_groups_apart(spark):
    r, rows = random.Random(3), []
    for p in range(60):
        for s in range(8):
            d = int(r.random() < 0.95) + int(r.random() < 0.95) if (s < 4) == (p % 2 == 0) else int(r.random() < 0.05) + int(r.random() < 0.05)
            rows.append(("c", p, f"s{s}", [0.98 if d == i else 0.01 for i in range(3)]))
    gl = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>")
    parts = {x["sample_id"]: x["part"] for x in P.recursive_bipartition(gl, 1, 15).collect()}
    assert len({parts[f"s{i}"] for i in range(4)}) == 1 and len({parts[f"s{i}"] for i in range(4, 8)}) == 1 and parts["s0"] != parts["s4"]
    deep = P.recursive_bipartition(gl, 5, 4)
    assert deep.count() == 8 and deep.select("sample_id").distinct().count() == 8


def test_downsampling_keeps_mates_together_and_meets_the_depth(spark):
    rows = [(f"r{i}", "c", 10 * (i % 500), 10 * (i % 500) + 100, "s") for i in range(4000) for _ in (1, 2)]
    aln = spark.createDataFrame(rows, "qname string, chrom string, start long, end long, sample_id string")
    kept = R.downsample_to_coverage(aln, spark.createDataFrame([("c", 0, 5000)], "chrom string, start long, end long"), 40.0)
    names = [x["qname"] for x in kept.collect()]
    assert len(names) == 2 * len(set(names)) and abs(len(names) / len(rows) - 40 / 160) < 0.05


def test_balanced_chunks_cover_every_base_once(spark):
    from lociframe.operators import chunking as C

    r = random.Random(6)
    iv = [("a" if i % 2 else "b", 100 * i, 100 * i + r.randint(1, 90), r.randint(0, 50)) for i in range(60)]
    frame_ = spark.createDataFrame(iv, "chrom string, start long, end long, weight long")
    contigs = spark.createDataFrame([("a", 10_000, 1), ("b", 10_000, 2)], "contig string, length long, rank int")
    for split in (False, True):
        got = C.interval_pipeline(frame_.where("weight > 0"), contigs, frame_, 150, 0, split=split).collect()
        assert sum(x["end"] - x["start"] for x in got) == sum(e - s for _, s, e, w in iv if w > 0)
        order = sorted(got, key=lambda x: (x["chrom"], x["start"]))
        assert [x["chunk"] for x in order] == sorted(x["chunk"] for x in order) and len({x["chunk"] for x in order}) >= 5


def test_reuse_only_of_what_is_valid(spark, tmp_path):
    schema = "sample_id string, ok boolean, n int"
    spark.createDataFrame([("a", True, 1), ("a", True, 2), ("b", False, 1)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: incremental.incremental_reuse(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "c"), valid="ok").awaitTermination(90)
    run()
    spark.createDataFrame([("a", True, 9), ("b", True, 3), ("c", True, 1)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    held = sorted((x["sample_id"], x["ok"]) for x in Store(spark, str(tmp_path / "store"), schema).read().collect())
    assert held == [("a", True), ("b", True), ("c", True)]


def test_running_missingness_equals_batch(spark, tmp_path):
    m = spark.createDataFrame([("s", 3, 10), ("s", 4, 10), ("t", 1, 10)], "SAMPLE string, present long, target long")
    m.write.parquet(str(tmp_path / "m"))
    q = incremental.incremental_missing(spark.readStream.schema(m.schema).parquet(str(tmp_path / "m"))).writeStream.format("memory").queryName("missing_now").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(90)
    assert sorted(map(tuple, spark.sql("select * from missing_now").collect())) == [("s", 7, 20), ("t", 1, 10)]


def test_pileup(spark):
    a = spark.createDataFrame([("r1", 0, "c", 10, 60, "2S3M1D2M", "xxACGTA", "IIIIIII", "s"), ("r2", 16, "c", 11, 60, "2M", "CT", "I!", "s")], "qname string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string, sample_id string")
    got = sorted((r["pos"], r["allele"], r["fwd"], r["rev"]) for r in R.pileup(a).collect())
    assert got == [(10, "A", 1, 0), (11, "C", 1, 1), (12, "G", 1, 0), (14, "T", 1, 0), (15, "A", 1, 0)]


def test_spectrum_em_finds_called_counts(spark):
    r, rows = random.Random(1), []
    for p in range(60):
        for s in range(4):
            d = int(r.random() < 0.3) + int(r.random() < 0.3)
            rows.append(("c", p, f"s{s}", [1.0 if d == i else 1e-9 for i in range(3)], d))
    g = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>, dosage int")
    em = {x["bin"]: x["n"] for x in X.sfs_em(S.site_allele_likelihood(g), 30).collect()}
    called = {x["bin"]: x["n"] for x in X.sfs_1d(g, folded=False).collect()}
    assert all(abs(em[b] - called.get(b, 0)) < 0.1 for b in em)


def test_mds_and_drop(spark):
    pts = np.random.default_rng(0).normal(size=(5, 2))
    d = [(f"s{i}", f"s{j}", float(np.linalg.norm(pts[i] - pts[j]))) for i in range(5) for j in range(i + 1, 5)] + [("s0", "t", 1.0)]
    pairs = spark.createDataFrame(d, "sample_i string, sample_j string, value double")
    sq = P.square(pairs, spark.createDataFrame([(s,) for s in ("s0", "s1", "s2", "s3", "s4", "t")], "sample_id string"))
    whole = P.drop_until_complete(sq)
    assert "t" not in {r["sample_i"] for r in whole.collect()}
    xy = {}
    for r in P.mds(whole)[0].collect():
        xy.setdefault(r["sample_id"], {})[r["component"]] = r["value"]
    for i, j, v in d[:10]:
        assert math.dist([xy[i][1], xy[i][2]], [xy[j][1], xy[j][2]]) == pytest.approx(v, abs=1e-6)


def test_dataflow(spark):
    df = spark.createDataFrame([("a", [1, 2], [3, 4])], "k string, x array<int>, y array<int>")
    assert sorted(tuple(r) for r in D.flat_map(df, ["x", "y"]).collect()) == [("a", 1, 3), ("a", 2, 4)]
    with pytest.raises(Exception, match="unequal"):
        D.flat_map(spark.createDataFrame([("a", [1], [3, 4])], "k string, x array<int>, y array<int>"), ["x", "y"]).collect()
    out = D.branch(spark.createDataFrame([("PASS",), ("FAIL",)], "s string"), {"ok": "s = 'PASS'", "bad": "s = 'FAIL'"})
    assert out["ok"].count() == 1 and out["bad"].count() == 1
    with pytest.raises(Exception, match="fits no branch"):
        D.branch(spark.createDataFrame([("?",)], "s string"), {"ok": "s = 'PASS'"})["ok"].collect()


def test_sql_functions(spark):
    register_sql_functions(spark)
    r = spark.sql("select gp_to_gt(array(0.05D, 0.94D, 0.01D), 0.9D) a, gp_to_gt(array(0.5D, 0.5D, 0D), 0.9D) b, iupac('T', 'A') c, pl_to_gp(array(0, 10, 20))[0] d, hwe_exact(1, 2, 1) e").first()
    assert (r["a"], r["b"], r["c"]) == (1, None, "W") and r["d"] == pytest.approx(1 / 1.11) and 0 < r["e"] <= 1


def test_streams_equal_batch(spark, tmp_path):
    parts = spark.createDataFrame([("s1", "p1", 2), ("s1", "p2", 2), ("s1", "p2", 2), ("s2", "p1", 2)], "sample_id string, part string, n_parts int")
    parts.write.parquet(str(tmp_path / "parts"))
    q = incremental.counted_groups(spark.readStream.schema(parts.schema).parquet(str(tmp_path / "parts"))).writeStream.format("memory").queryName("done_groups").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c1")).start()
    q.awaitTermination(90)
    assert [tuple(r) for r in spark.sql("select * from done_groups").collect()] == [("s1", 2)]
    h = spark.createDataFrame([(1, 2), (1, 3), (4, 1)], "depth long, count long")
    h.write.parquet(str(tmp_path / "h"))
    q = incremental.incremental_histogram(spark.readStream.schema(h.schema).parquet(str(tmp_path / "h"))).writeStream.format("memory").queryName("hist").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.awaitTermination(90)
    assert sorted(map(tuple, spark.sql("select * from hist").collect())) == sorted(map(tuple, Q.merge_histograms(h).collect()))


def test_text_sources(spark, tmp_path):
    (tmp_path / "x.vcf").write_text("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\nc\t5\t.\tA\tG,T\t30\tPASS\tDP=9;END=8\tGT:DP:GQ:AD\t0/1:7:20:3,4\t./.:.:.:.\n")
    sites, gt = readers.read_vcf(spark, str(tmp_path / "x.vcf"))
    s = sites.first()
    assert (s["pos"], s["alt"], s["qual"], s["info"]["DP"]) == (5, ["G", "T"], 30.0, "9")
    got = {r["sample_id"]: (r["dosage"], r["dp"], r["ad"]) for r in gt.collect()}
    assert got == {"S1": (1, 7, [3, 4]), "S2": (None, None, None)}
    assert tuple(readers.gvcf_blocks(sites).first()) == ("c", 4, 8, 1)
    (tmp_path / "x.fa").write_text(">c1 first > of two\nACGT\nNN\n>c2\nac\n")
    assert [(r["contig"], r["seq"], r["length"], r["rank"]) for r in readers.read_fasta(spark, str(tmp_path / "x.fa")).orderBy("rank").collect()] == [("c1", "ACGTNN", 6, 1), ("c2", "ac", 2, 2)]
    (tmp_path / "x.fq").write_text("@r1 a\nACGT\n+\nIIII\n@r2\nGG\n+\n!!\n")
    assert sorted((r["read_id"], r["seq"], r["qual"]) for r in readers.read_fastq(spark, str(tmp_path / "x.fq"), 1).collect()) == [("@r1 a", "ACGT", "IIII"), ("@r2", "GG", "!!")]
    (tmp_path / "x.sam").write_text("@RG\tID:g1\tSM:s\nr1\t0\tc\t7\t60\t4M\t*\t0\t0\tACGT\tIIII\tRG:Z:g1\n")
    aln, header = readers.read_sam(spark, str(tmp_path / "x.sam"))
    assert aln.first()["tags"]["RG"] == "g1" and header.count() == 1
    (tmp_path / "x.bed").write_text("#c\nc\t1\t5\nc\t7\t9\tL\n")
    assert sorted(map(tuple, readers.read_bed(spark, str(tmp_path / "x.bed"), "D").collect())) == [("c", 1, 5, "D"), ("c", 7, 9, "L")]
    (tmp_path / "x.sites").write_text("c:5\r\n# x\n\nc\t9\nc\t10\t12\n")
    assert sorted(map(tuple, readers.read_sitelist(spark, str(tmp_path / "x.sites")).collect())) == [("c", 5), ("c", 9), ("c", 11), ("c", 12)]
    (tmp_path / "x.csv").write_text("sample,lib,pop,fwd,rev\nabc,,P 1,x_1.fq.gz,x_2.fq.gz\nab,l,p,SRR123456,\nsss,l,,SRR123456,\n")
    ok, bad = readers.read_samplesheet(spark, str(tmp_path / "x.csv"))
    assert [r["sample"] for r in bad.collect()] == ["ab"]
    n = {r["sample"]: (r["lib"], r["pop"], r["source"]) for r in readers.normalise_samplesheet(ok).collect()}
    assert n == {"abc": ("abc", "P_1", "local"), "sss": ("l", "unknown", "accession")}
    writers.write_fasta(spark.createDataFrame([("c", "A" * 100)], "contig string, seq string"), str(tmp_path / "out.fa"))
    assert sorted(map(len, "".join(p.read_text() for p in (tmp_path / "out.fa").glob("part*")).split())) == [2, 20, 80]
    assert F is not None


def test_spectrum_em_counts_sites_with_fewer_samples(spark):
    """Against EM over likelihood arrays in which absent samples are flat."""
    r, rows, safs = random.Random(2), [], []
    for p in range(20):
        z = np.ones(1)
        for s in range(5):
            gl = [r.random() for _ in range(3)] if s < 2 + p % 4 else [1.0, 1.0, 1.0]
            if s < 2 + p % 4:
                rows.append(("c", p, f"s{s}", gl))
            z = np.convolve(z, np.array(gl) * [1, 2, 1])
        safs.append(z / [math.comb(10, j) for j in range(11)])
    want = np.full(11, 1 / 11)
    for _ in range(20):
        post = np.array(safs) * want
        want = (post / post.sum(1, keepdims=True)).mean(0)
    em = {x["bin"]: x["n"] for x in X.sfs_em(S.site_allele_likelihood(spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>")), tol=0.0).collect()}
    assert np.allclose([em[j] for j in range(11)], 20 * want) and abs(sum(em.values()) - 20) < 1e-6


def test_prune_settles_a_long_chain(spark):
    """Tied priorities along a chain: every second site stays, past any number of rounds."""
    sites, pairs = [("c", p, 0) for p in range(106)], [("c", p, p + 1, 0.9) for p in range(105)]
    got = L.ld_prune(spark.createDataFrame(pairs, "chrom string, pos_a long, pos_b long, r2 double").coalesce(1), spark.createDataFrame(sites, "chrom string, pos long, priority int").coalesce(1))
    assert {x["pos"] for x in got.collect()} == set(range(0, 106, 2))


def test_lines_are_numbered_in_order_of_the_files_names(spark, tmp_path):
    """Spark deals the larger file first."""
    for name, n in (("part-00000", 3), ("part-00001", 500), ("part-00002", 40)):
        (tmp_path / name).write_text("".join(f"{name}:{i}\n" for i in range(n)))
    got = [r["line"] for r in readers.numbered_lines(spark, str(tmp_path)).orderBy("n").collect()]
    assert got == [f"{name}:{i}" for name, n in (("part-00000", 3), ("part-00001", 500), ("part-00002", 40)) for i in range(n)]


def test_a_fastq_record_may_span_files_of_any_size(spark, tmp_path):
    (tmp_path / "part-00000").write_text("@a\nAC\n")
    (tmp_path / "part-00001").write_text("+\nII\n" + "".join(f"@b{i}\nGT\n+\n!!\n" for i in range(300)))
    got = readers.read_fastq(spark, str(tmp_path), 1).collect()
    assert len(got) == 301 and sorted((r["read_id"], r["seq"], r["qual"]) for r in got)[0] == ("@a", "AC", "II")


def test_lines_keep_their_numbers_when_another_scan_would_be_split_otherwise(spark, tmp_path):
    """Every evaluation of these rows cuts them into more splits, as scans do when cores come."""
    runs = tmp_path / "runs"

    def cut(batches):
        with open(runs, "ab") as f:
            f.write(b"x")
        size = 100 >> runs.stat().st_size
        for b in batches:
            yield b.assign(__file="f", __start=b["__id"] // size * size)

    rows = spark.range(0, 100, 1, 1).select(F.col("id").cast("string").alias("value"), F.col("id").alias("__id")).mapInPandas(cut, "value string, __id long, __file string, __start long")
    got = sorted((r["n"], r["value"]) for r in readers.numbered_splits(rows).collect())
    assert got == [(i, str(i)) for i in range(100)]


def test_fasta_ranks_follow_the_files_names(spark, tmp_path):
    (tmp_path / "part-00000").write_text(">x\nAC\n")
    (tmp_path / "part-00001").write_text(">y\n" + "ACGT\n" * 50 + ">z\nA\n")
    assert [(r["contig"], r["rank"]) for r in readers.read_fasta(spark, str(tmp_path)).orderBy("rank").collect()] == [("x", 1), ("y", 2), ("z", 3)]
