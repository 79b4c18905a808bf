"""A whole run on a small genome with planted variants."""

import random

from lociframe.operators.params import ChunkParams, FilterParams, MaskParams, MitoParams, RunParams, TypeThresholds
from lociframe.plans import run as U


def test_planted_variants_are_called_and_filtered(spark):
    r = random.Random(1)
    seq = {c: "".join(r.choice("ACGT") for _ in range(2000)) for c in ("c1", "c2")}
    seq["c1"] = seq["c1"][:900] + "N" * 60 + seq["c1"][960:]
    other = {"A": "C", "C": "G", "G": "T", "T": "A"}
    planted = {("c1", 300): 0.5, ("c1", 1500): 0.5, ("c2", 700): 0.5, ("c2", 1200): 0.05}
    rows, truth = [], {}
    for s in range(12):
        own = {k: int(r.random() < f) + int(r.random() < f) for k, f in planted.items()}
        truth[f"s{s:02}"] = own
        for i in range(400):
            c, at = r.choice(["c1", "c2"]), r.randrange(1950)
            bases = list(seq[c][at : at + 50])
            for (chrom, pos), d in own.items():
                if chrom == c and at < pos <= at + 50 and r.random() < d / 2:
                    bases[pos - 1 - at] = other[bases[pos - 1 - at]]
            rows.append((f"s{s:02}r{i}", 0, c, at + 1, at, at + 50, 60, "50M", 0, "".join(bases), "I" * 50, f"s{s:02}", 50))
    aln = spark.createDataFrame(rows, "qname string, flag int, chrom string, pos long, start long, end long, mapq int, cigar string, tlen long, seq string, qual string, sample_id string, aligned long")
    sequences = spark.createDataFrame([(c, s, len(s), i) for i, (c, s) in enumerate(seq.items())], "contig string, seq string, length long, rank int")
    pops = spark.createDataFrame([(s, "A" if i % 2 else "B") for i, s in enumerate(sorted(truth))], "sample_id string, pop string")
    exclude = spark.createDataFrame([("c1", 1450, 1550)], "chrom string, start long, end long")
    params = RunParams(
        masks=MaskParams(mappability=0, complexity=0), chunks=ChunkParams(bases_per_chunk=20_000),
        filters=FilterParams(dp_percentile_lower=None, dp_percentile_upper=None, dist_indel_snp=None, types={"SNP": TypeThresholds(qual=30, maf=0.1, cr=0.5)}),
    )
    got = U.run(U.Inputs(sequences, aln, pops, exclude=exclude), params)
    found = {(x["chrom"], x["pos"]): x["filter"] for x in got["filtered"].collect()}
    assert found["c1", 300] == [] and found["c2", 700] == [] and found["c1", 1500] == ["MASK_FAIL"] and "MAF_FAIL" in found["c2", 1200]
    assert {(x["chrom"], x["pos"]) for x in got["passing"].collect()} == {("c1", 300), ("c2", 700)}
    calls = {(x["chrom"], x["pos"], x["sample_id"]): x["dosage"] for x in got["genotypes"].collect()}
    right = [calls.get((*k, s)) == d for s, own in truth.items() for k, d in own.items() if calls.get((*k, s)) is not None]
    assert sum(right) >= 0.95 * len(right) and len(right) > 30
    assert sum(x["COUNT"] for x in got["summary"].collect()) == len(found)
    assert {x["label"] for x in got["mask"].collect()} == {"NRef", "Excluded"}
    passing = got["passing"].join(got["sites"].select("chrom", "pos", "type"), ["chrom", "pos"])
    made = U.outputs(passing, got["genotypes"], pops)
    pairs = made["kinship"].count()
    assert 30 < pairs <= 66 and made["distance"].count() == pairs and made["grm"].count() >= pairs + 10
    assert made["eigenvalues"].count() == 2 and 10 <= made["pca"].count() <= 12 and made["coordinates"].count() >= 6
    assert got["chunks"].columns == ["chrom", "start", "end", "weight", "chunk"] and got["coverage"].columns[0] == "chrom"


def test_mitochondrial_consensus_of_a_run(spark):
    r = random.Random(5)
    length, shift = 400, 150
    mito = "".join(r.choice("ACGT") for _ in range(length))
    other = {"A": "C", "C": "G", "G": "T", "T": "A"}
    own = {"s1": mito[:9] + other[mito[9]] + mito[10:], "s2": mito[:200] + other[mito[200]] + mito[201:]}
    rows = {False: [], True: []}
    for sample, seq in own.items():
        for i in range(600):
            at = r.randrange(length)
            read = (seq + seq)[at : at + 40]
            for shifted in (False, True):
                start = (at - shift) % length if shifted else at
                if start + 40 <= length:  # what crosses the ends of a linear contig is not aligned
                    rows[shifted].append((f"{sample}r{i}", 0, "mt", start + 1, start, start + 40, 60, "40M", 0, read, "I" * 40, sample, 40))
    schema = "qname string, flag int, chrom string, pos long, start long, end long, mapq int, cigar string, tlen long, seq string, qual string, sample_id string, aligned long"
    aln, shifted = (spark.createDataFrame(rows[s], schema) for s in (False, True))
    sequences = spark.createDataFrame([("mt", mito, length, 0)], "contig string, seq string, length long, rank int")
    pops = spark.createDataFrame([("s1", "A"), ("s2", "B")], "sample_id string, pop string")
    params = RunParams(mito=MitoParams(shift=shift, breakpoint_window=60, min_depth=10))
    got = U.mito_consensus(U.Inputs(sequences, aln, pops, mito="mt", shifted=shifted), params)
    assert {x["sample_id"]: x["seq"] for x in got["consensus"].collect()} == own
    assert {x["sample_id"]: x["n_shifted"] for x in got["qc"].collect()} == {"s1": 120, "s2": 120}
    alone = U.mito_consensus(U.Inputs(sequences, aln, pops, mito="mt"), params)["consensus"].collect()
    assert all(x["seq"][0] == "N" and x["seq"][100:300] == own[x["sample_id"]][100:300] for x in alone)
