"""Sequences in tiles: the FASTA source, masks and k-mers against plain Python, both strands, hot minimizers, time by length."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from lociframe.operators import kmers as N
from lociframe.operators import mito as M
from lociframe.operators import sequence as K
from lociframe.plans import run as U
from lociframe.sources import fasta, readers


def genome(seed=1, n=4, size=700):
    r = random.Random(seed)
    out = {f"c{i}": "".join(r.choice("ACGTacgtN" if i % 2 else "ACGT") for _ in range(size + 10 * i)) for i in range(n)}
    shared = "".join(r.choice("ACGT") for _ in range(80))
    out["c0"] = out["c0"][:100] + shared + out["c0"][100:] + "A" * 50
    out["c2"] = out["c2"][:300] + K.complemented(shared) + out["c2"][300:400] + shared[:60] + out["c2"][400:]
    return out | {"empty": "", "short": "AC"}


def frame(spark, seqs):
    return spark.createDataFrame(list(seqs.items()), "contig string, seq string")


def written(tmp_path, seqs, width=60, end="\n"):
    path = tmp_path / "genome.fa"
    path.write_text("".join(f">{c} described > twice{end}" + "".join(s[i : i + width] + end for i in range(0, len(s), width)) for c, s in seqs.items()), newline="")
    return str(path)


def spans(df, *more):
    return sorted((r["chrom"], r["start"], r["end"], *(r[m] for m in more)) for r in df.collect())


@pytest.mark.parametrize("trial", range(60))
def test_ranges_of_a_file(tmp_path, trial):
    """The reader's own parts, without a session: any tile, overlap, range and line width."""
    r = random.Random(trial)
    seqs = {f"c{i}": "".join(r.choice("ACGTN") for _ in range(r.choice([0, 1, 5, 37, 300]))) for i in range(r.randint(1, 5))}
    path = written(tmp_path, seqs, r.choice([1, 7, 60, 1000]), r.choice(["\n", "\r\n"]))
    tile, overlap = r.choice([4, 16, 50]), r.choice([0, 3, 9])
    options = {"path": path, "tile": str(tile), "overlap": str(overlap), "range": str(r.choice([5, 33, 200, 10**6]))}
    reader, index = fasta.FastaReader(options), fasta.FastaReader({**options, "index": "true"})
    got, carry = defaultdict(list), (None, 0)
    for part in reader.partitions():
        for batch in reader.read(part):
            for x in batch.to_pylist():
                contig, at = (carry[0], carry[1] + x["at"]) if x["part"] == 0 else (x["contig"], x["at"])
                got[contig].append((at, x["n"], x["seq"], x["ends"], x["before"]))
        last = [x for b in index.read(part) for x in b.to_pylist()][-1]
        carry = (carry[0], carry[1] + last["at"]) if last["part"] == 0 else (last["contig"], last["at"])
    for contig, s in seqs.items():
        place = 0
        for at, n, seq, ends, before in sorted(got[contig]):
            assert at == place and seq == s[at : at + n + overlap] and before == (s[at - 1] if at else "")
            assert not ends or at + n + overlap >= len(s)
            assert ends or len(seq) >= n + overlap
            place += n
        assert place == len(s)


def test_tiles_from_the_source(spark, tmp_path):
    seqs = genome()
    tiles = fasta.read_fasta_tiles(spark, written(tmp_path, seqs, 37), overlap=12, tile=64, range_bytes=500)
    assert tiles.rdd.getNumPartitions() > 1
    rows = sorted((r["contig"], r["at"], r["n"], r["before"], r["seq"]) for r in tiles.collect())
    for contig, s in seqs.items():
        mine = [x for x in rows if x[0] == contig]
        assert "".join(x[4][: x[2]] for x in mine) == s and all(x[4] == s[x[1] : x[1] + x[2] + 12] for x in mine)
    whole = frame(spark, seqs)
    for f in (K.hard_mask, K.soft_mask):
        assert spans(f(tiles)) == spans(f(whole))
    assert spans(K.low_complexity_mask(tiles, 3, 50, 0.05)) == spans(K.low_complexity_mask(whole, 3, 50, 0.05)) != []
    assert spans(N.kmer_mappability(tiles, 11, 0.9)) == spans(N.kmer_mappability(whole, 11, 0.9)) != []
    with pytest.raises(Exception, match="overlap"):
        N.kmer_mappability(tiles, 40, 0.9).count()


def test_one_contig_is_many_tasks_and_packed_files_are_read(spark, tmp_path):
    import gzip

    r = random.Random(2)
    s = "".join(r.choice("ACGT") for _ in range(300_000))
    path = written(tmp_path, {"big": s}, 10**9)  # one line
    tiles = fasta.read_fasta_tiles(spark, path, overlap=5, tile=4096, range_bytes=20_000)
    assert tiles.select("at").rdd.getNumPartitions() > 1 and len(fasta.FastaReader({"path": path, "range": "20000"}).partitions()) == 16
    assert "".join(x["seq"][: x["n"]] for x in sorted(tiles.collect(), key=lambda x: x["at"])) == s
    packed = str(tmp_path / "genome.fa.gz")
    with gzip.open(packed, "wt") as f:
        f.write(f">big\n{s[:1000]}\n{s[1000:5000]}\n>next\nACGT\n")
    rows = fasta.read_fasta_tiles(spark, packed, overlap=5, tile=512).orderBy("contig", "at").collect()
    assert "".join(x["seq"][: x["n"]] for x in rows if x["contig"] == "big") == s[:5000] and rows[-1]["seq"] == "ACGT"


def brute_hits(a, b, k, min_len):
    out = []
    for ac, sa in a.items():
        for bc, sb in b.items():
            for strand in "+-":
                x, y = sa.upper(), sb.upper() if strand == "+" else K.complemented(sb.upper())
                for d in range(-len(y), len(x)):
                    run = 0
                    for i in range(max(0, d), min(len(x), len(y) + d) + 1):
                        same = i < min(len(x), len(y) + d) and x[i] == y[i - d]
                        if same:
                            run += 1
                            continue
                        if run >= max(k, min_len):
                            at = i - run - d
                            out.append((ac, bc, i - run, i, at if strand == "+" else len(y) - at - run, strand))
                        run = 0
    return sorted(out)


def hits(df):
    return sorted((r["a_contig"], r["b_contig"], r["start"], r["end"], r["b_start"], r["strand"]) for r in df.collect())


def test_matches_on_both_strands(spark, monkeypatch):
    seqs = genome(size=150)
    a, b = {c: seqs[c] for c in ("c0", "c1", "short")}, {c: seqs[c] for c in ("c2", "c3", "empty")} | {"tail": seqs["c0"][-70:], "rev": K.complemented(seqs["c1"][20:90])}
    want = brute_hits(a, b, 13, 15)
    assert {x[5] for x in want} == {"+", "-"} and len(want) > 5
    assert hits(N.kmer_hits(frame(spark, a), frame(spark, b), 13, 15)) == want
    monkeypatch.setattr(N, "HOT", 3)  # most minimizers are hot
    assert hits(N.kmer_hits(frame(spark, a), frame(spark, b), 13, 15)) == want


def test_repeats_have_rows_for_matches_only(spark):
    r = random.Random(6)
    unit = "".join(r.choice("ACGT") for _ in range(400))
    a = {f"a{i}": "".join(r.choice("ACGT") for _ in range(20)) + unit + "".join(r.choice("ACGT") for _ in range(20)) for i in range(12)}
    b = {f"b{i}": unit + "".join(r.choice("ACGT") for _ in range(20)) for i in range(10)}
    found = N.super_kmers(frame(spark, a), 20).unionByName(N.super_kmers(frame(spark, b), 20, 1)).toArrow()
    assert N.match_ends(20)(found).num_rows < 2 * 12 * 10 * 2  # 381 k-mers a match would be 45,720
    assert len([h for h in hits(N.kmer_hits(frame(spark, a), frame(spark, b), 20, 300))]) == 120


def test_a_product_of_one_group_is_made_in_pieces(spark, monkeypatch):
    group, by_a, by_b = np.zeros(300, np.int64), np.full(300, 65), np.full(500, 66)
    made = list(N.unlike_pairs(group, by_a, np.zeros(500, np.int64), by_b, 1000))
    assert max(len(i) for i, _ in made) == 1000 and len({(x, y) for i, j in made for x, y in zip(i.tolist(), j.tolist(), strict=True)}) == 150_000
    unit = "".join(random.Random(7).choices("ACGT", k=70))
    a, b = {f"a{i}": "ACGT"[i % 4] + unit + "TG"[i % 2] for i in range(12)}, {f"b{i}": unit + "AC"[i % 2] + "AC" * 45 for i in range(10)}
    want = brute_hits(a, b, 60, 60)
    assert hits(N.kmer_hits(frame(spark, a), frame(spark, b), 40, 60)) == want and len(want) == 120
    rows = N.super_kmers(frame(spark, a), 60).unionByName(N.super_kmers(frame(spark, b), 60, 1)).unionByName(N.super_kmers(frame(spark, b), 60, 2, True)).toArrow()
    ends = [e for e in N.pieces_of_ends(rows, 60)]
    packed = [e.packed(8, (N.name_hashes(e.a_names),) * 2) for e in ends]
    assert sum(x.num_rows for x in packed) <= 16 < 240 == sum(len(e.at) for e in ends), "a row for each shard and piece, not for each end"
    got = [r for shard in range(8) for x in N.matched(iter([p.filter(pa.compute.equal(p["shard"], shard)) for p in packed]), 60, 60, 50) for r in x.to_pylist()]
    assert sorted((r["a_contig"], r["b_contig"], r["start"], r["end"], r["b_start"], r["strand"]) for r in got) == want


def test_counts_of_kmers(spark, monkeypatch):
    seqs = genome() | {"text": "Straße übér alles, ünd nøch 日本語 " * 6}
    for k in (1, 5, 31, 32, 70):
        want = Counter(s.upper()[i : i + k] if "ß" not in s else "".join(c.upper() if len(c.upper()) == 1 else c for c in s)[i : i + k] for s in seqs.values() for i in range(len(s) - k + 1))
        assert {r["kmer"]: r["n"] for r in N.kmer_counts(frame(spark, seqs), k).collect()} == dict(want)
    monkeypatch.setattr(N, "HOT", 3)
    assert {r["kmer"]: r["n"] for r in N.kmer_counts(frame(spark, seqs), 70).collect()} == dict(want)


def test_mappability_of_hot_minimizers(spark, monkeypatch):
    seqs = genome() | {"poly": "A" * 500 + "ACGT" * 100}
    plain = spans(N.kmer_mappability(frame(spark, seqs), 9, 0.6))
    count = Counter(s.upper()[i : i + 9] for s in seqs.values() for i in range(len(s) - 8))
    want = {(c, i) for c, s in seqs.items() for i in range(len(s) - 8) if 1 / count[s.upper()[i : i + 9]] < 0.6}
    assert {(c, i) for c, a, b in plain for i in range(a, b)} == want
    monkeypatch.setattr(N, "HOT", 50)
    assert spans(N.kmer_mappability(frame(spark, seqs), 9, 0.6)) == plain


def test_buckets_go_in_passes_that_leave_no_shuffle_files(spark, monkeypatch):
    seqs = genome() | {"poly": "A" * 500 + "ACGT" * 100}
    plain = spans(N.kmer_mappability(frame(spark, seqs), 9, 0.6))
    name, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    write = N.kept

    def watched(df, what, *compression):
        seen.append((what, spark.conf.get(name), *compression))
        return write(df, what, *compression)

    monkeypatch.setattr(N, "kept", watched)
    monkeypatch.setattr(N, "PASS", N.BUCKET)  # as many passes as are allowed
    assert spans(N.kmer_mappability(frame(spark, seqs), 9, 0.6)) == plain
    assert seen.count(("pass", "true")) == N.PASSES and ("super-kmers", "false", "zstd") in seen and spark.conf.get(name) == "false"
    monkeypatch.setattr(N, "HOT", 50)
    assert spans(N.kmer_mappability(frame(spark, seqs), 9, 0.6)) == plain
    rows = N.super_kmers(frame(spark, seqs), 9, buckets=2, named=False).where("bucket >= 0").toArrow()
    runs = N.Runs(rows, 9)
    assert not runs.flags.any() and len(runs.codes) == sum(runs.size) + 8 * len(runs.size), "no letters beside the runs"


def test_pieces_and_reference_bases(spark):
    seqs = genome()
    cut = K.pieces(K.tiled(frame(spark, seqs), 3, 100), 64).collect()
    for contig, s in seqs.items():
        mine = sorted((x["at"], x["seq"], x["bin"]) for x in cut if x["contig"] == contig)
        assert "".join(x[1] for x in mine) == s and all(x[0] // 64 == x[2] == (x[0] + len(x[1]) - 1) // 64 for x in mine)
    sites = spark.createDataFrame([(c, p) for c, s in seqs.items() for p in (1, 2, 99, len(s)) if 0 < p <= len(s)], "chrom string, pos long")
    got = {(x["chrom"], x["pos"]): x["ref"] for x in U.reference_bases(frame(spark, seqs), sites).collect()}
    assert got == {(c, p): seqs[c][p - 1].upper() for c, p in got} and len(got) == sites.distinct().count()


def test_region_consensus_modes(spark):
    seqs = frame(spark, {"c": "acgtACGT" * 1500})
    regions = spark.createDataFrame([("c", 4090, 4100), ("c", 0, 4)], "chrom string, start long, end long")
    depth = spark.createDataFrame([("c", p, "s", 0 if p == 4095 else 5) for p in [*range(1, 5), *range(4091, 4101)]], "chrom string, pos long, sample_id string, dp int")
    variants = spark.createDataFrame([("c", 2, "s", "C", "T", 1), ("c", 4093, "s", "G", "A", 2)], "chrom string, pos long, sample_id string, ref string, alt string, dosage int")
    for mode, base in (("iupac", "Y"), ("hap1", "C"), ("hap2", "T")):
        got = {r["start"]: r["seq"] for r in M.region_consensus(seqs, regions, variants, depth, mode).collect()}
        assert got == {0: f"A{base}GT", 4090: "GTACNTACGT"}


def test_numt_mask_of_a_run(spark):
    r = random.Random(9)
    mito = "".join(r.choice("ACGT") for _ in range(600))
    a = "".join(r.choice("ACGT") for _ in range(3000))
    seqs = {"n1": a[:500] + mito[100:300] + a[500:900] + K.complemented(mito[350:520]) + a[900:], "n2": a[::-1], "mt": mito}
    sequences = spark.createDataFrame([(c, s, len(s), i) for i, (c, s) in enumerate(seqs.items())], "contig string, seq string, length long, rank int")
    params = U.RunParams(masks=U.RunParams().masks.__class__(mappability=0, complexity=0, numt_max_gap=100))
    mask = U.masks(U.Inputs(sequences, None, None, mito="mt"), params)
    got = [x for x in spans(mask, "label") if x[3] == "NUMT"]
    assert [(x[0], abs(x[1] - s) < 5, abs(x[2] - e) < 5) for x, (s, e) in zip(got, [(500, 700), (1100, 1270)], strict=True)] == [("n1", True, True)] * 2


def test_time_follows_length(spark):
    """1, 2 and 4 Mb in one contig: masks and k-mers take about as many times longer."""
    r = random.Random(3)
    block = "".join(r.choices("ACGTacgtN", k=1_000_000))
    took = {}
    for mb in (1, 1, 2, 4):
        seqs = frame(spark, {"c": block * mb}).cache()
        seqs.count()
        began = time.perf_counter()
        assert K.soft_mask(seqs).count() and N.super_kmers(seqs, 21).count() and K.pieces(seqs).count() and K.window_sums(seqs, 7, 5000).count()
        took[mb] = time.perf_counter() - began
        seqs.unpersist()
    assert took[4] < 6 * took[1] + 2 and took[2] < 3 * took[1] + 2


def test_read_fasta_ranks(spark, tmp_path):
    seqs = genome()
    got = readers.read_fasta(spark, written(tmp_path, seqs, 50)).orderBy("rank").collect()
    assert [(x["contig"], x["seq"], x["length"], x["rank"]) for x in got] == [(c, s, len(s), i) for i, (c, s) in enumerate(seqs.items(), 1)]


def test_share_of_covered_bases_by_intervals_and_by_sites(spark):
    seqs = spark.createDataFrame([("a", "NNACGNTN"), ("b", "ACGT"), ("c", "NN")], "contig string, seq string")
    parts = [("a", 0, 4), ("a", 2, 7), ("b", 1, 3), ("c", 1, 2)]
    spans = spark.createDataFrame(parts, "chrom string, start long, end long")
    points = spark.createDataFrame(sorted({(c, p + 1) for c, s, e in parts for p in range(s, e)}), "chrom string, pos long")
    for sites in (spans, points):
        got = K.covered_n_share(seqs, sites).first()
        assert got["n_sites"] == 10 and abs(got["not_n"] - 0.6) < 1e-12
    whole = K.covered_n_share(seqs, spark.createDataFrame([], "chrom string, start long, end long")).first()
    assert whole["n_sites"] == 0 and whole["not_n"] is None


def test_runs_of_kmers_are_packed_by_bucket(spark):
    r = random.Random(8)
    seqs = {f"s{i}": "".join(r.choice("ACGT") for _ in range(2000)) for i in range(30)}
    rows = N.super_kmers(frame(spark, seqs).coalesce(1), 31, buckets=8, named=False)
    assert rows.where("bucket >= 0").count() == 8 and rows.agg({"n": "sum"}).first()[0] == 30 * 1970
    assert rows.selectExpr("sum(length(seq) + length(runs))").first()[0] < 5 * 30 * 2000  # once a row of text for each run


def test_whole_texts_are_masked_without_tiles_or_merging(spark, monkeypatch):
    from lociframe.operators import sequence as S

    monkeypatch.setattr(S, "WALK", 5)
    text = "aaaaaaaéabcDEfghijklmnopqNNNNNNNNNNNNx" + "ß" * 7 + "zz"
    seqs = spark.createDataFrame([("a", text), ("b", ""), ("c", None), ("d", "N")], "contig string, seq string")
    for inside, find in ((set("abcdefghijklmnopqrstuvwxyz"), lambda: next(S.whole_runs(member(range(97, 123)))(iter([batch])))), ({"N"}, lambda: next(S.whole_runs(member(b"N"))(iter([batch]))))):
        member = lambda of: np.isin(np.arange(256), list(of))
        batch = seqs.toArrow().combine_chunks().to_batches()[0]
        want = []
        for name, s in (("a", text), ("d", "N")):
            flags = [False, *(x in inside for x in s), False]
            edges = [i for i in range(len(s) + 1) if flags[i] != flags[i + 1]]
            want += [(name, x, y) for x, y in zip(edges[::2], edges[1::2], strict=True)]
        assert [tuple(r.values()) for r in find().to_pylist()] == want
    plan = S.soft_mask(seqs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan
    windows = S.window_sums(seqs, 3, 64)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in windows, "tiles hold whole windows, so none is summed again"
