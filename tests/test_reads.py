"""Adapters, template duplicates and pileups against plain Python: mismatches, remnants, clips, supplementary reads, mates that overlap."""

import random

import pytest

from lociframe.operators import duplicates as U
from lociframe.operators import reads as R
from lociframe.operators import trimming as T


def mutated(r, s, n):
    at = r.sample(range(len(s)), n)
    return "".join(r.choice([c for c in "ACGT" if c != x]) if i in at else x for i, x in enumerate(s))


def brute_start(seq, adapters, least, error):
    for start in range(len(seq)):
        for a in adapters:
            n = min(len(a), len(seq) - start)
            if n >= least and len(a) >= least and sum(x != y for x, y in zip(seq[start:], a)) <= int(error * n + 1e-9):
                return start
    return len(seq)


@pytest.mark.parametrize("least", [1, 3, 8])
def test_adapters_with_mismatches_and_remnants(spark, least):
    r = random.Random(least)
    adapters = ["AGATCGGAAGAGCACACG", "CTGTCTCTTATACACATC"]
    rows = []
    for i in range(300):
        s = "".join(r.choice("ACGT") for _ in range(r.randint(0, 60)))
        kind = i % 4
        if kind == 0:  # a remnant of 1 to 7 letters
            s += adapters[i % 2][: r.randint(1, 7)]
        elif kind == 1:
            s += mutated(r, adapters[i % 2], r.randint(0, 3)) + "".join(r.choice("ACGT") for _ in range(9))
        rows.append((i, s, "I" * len(s)))
    rows += [(300, "", ""), (301, None, None), (302, "é" * 5 + adapters[0], "I" * 23)]
    got = {x["i"]: (x["seq"], x["qual"]) for x in T.trim_adapter(spark.createDataFrame(rows, "i int, seq string, qual string"), adapters, least).collect()}
    for i, s, q in rows[:301] + rows[302:]:
        at = brute_start(s, adapters, least, 0.125)
        assert got[i] == (s[:at], q[:at]), s
    assert got[301] == (None, None)
    if least == 8:
        cut = [len(got[i][0]) < len(s) - 8 for i, s, _ in rows[:300] if i % 4 == 1]
        assert sum(cut) > 0.7 * len(cut)


COMP = str.maketrans("ACGT", "TGCA")


def test_mates_that_read_through(spark):
    r = random.Random(4)
    adapter, rows, truth = "AGATCGGAAGAGCACACGTCT", [], []
    for i in range(250):
        size = 73 + i if i < 8 else r.randint(25, 140)
        ins = "".join(r.choice("ACGT") for _ in range(size))
        mates = [(s + adapter + "".join(r.choice("ACGT") for _ in range(100)))[:80] for s in (ins, ins.translate(COMP)[::-1])]
        if i % 3 == 0:
            mates[0] = mutated(r, mates[0][:25], 2) + mates[0][25:]
        rows.append((i, mates[0], "I" * 80, mates[1], "J" * 80))
        truth.append(size if size <= 80 else None)
    pairs = spark.createDataFrame(rows, "i int, seq1 string, qual1 string, seq2 string, qual2 string")
    got = {x["i"]: x for x in T.trim_read_through(pairs).collect()}
    for i, size in enumerate(truth):
        assert got[i]["insert"] == size and len(got[i]["seq1"]) == len(got[i]["qual2"]) == (size or 80)
    # remnants of 1 to 7 letters are found too
    assert {80 - s for s in truth if s} >= {1, 2, 3, 4, 5, 6, 7}
    top = T.detected_adapters(pairs).orderBy("mate", "n", ascending=[True, False]).collect()
    assert {(x["mate"], x["adapter"]) for x in top if x["n"] > 30} == {(1, adapter[:12]), (2, adapter[:12])}


def brute_duplicates(rows, distance, by_group):
    import re

    def five(start, end, cigar, back):
        ops = re.findall(r"([0-9]+)([MIDNSHP=X])", cigar)
        lead = trail = 0
        for n, op in ops:
            if op not in "SH":
                break
            lead += int(n)
        for n, op in reversed(ops):
            if op not in "SH":
                break
            trail += int(n)
        return end + trail if back else start - lead

    t = {}
    for q, flag, chrom, start, end, cigar, rg, qual in rows:
        if not flag & (0x4 | 0x100 | 0x800):
            x = t.setdefault((rg, q), [[], 0])
            x[0].append((chrom, five(start, end, cigar, bool(flag & 16)), bool(flag & 16)))
            x[1] += sum(ord(c) - 33 for c in qual if ord(c) - 33 >= 15)
    groups, pair_ends = {}, set()
    for (rg, q), (ends, score) in t.items():
        ends = tuple(sorted(ends))
        g = rg if by_group else ""
        groups.setdefault((g, ends), []).append((-score, q, rg))
        if len(ends) > 1:
            pair_ends |= {(g, e) for e in ends}
    dup, near = set(), set()
    for (g, ends), members in groups.items():
        members.sort()
        by_pair = len(ends) == 1 and (g, ends[0]) in pair_ends
        for k, (_, q, rg) in enumerate(members):
            if k or by_pair:
                dup.add((rg, q))
                a, b = q.split(":"), members[0][1].split(":")
                if not by_pair and a[:-2] == b[:-2] and abs(int(a[-2]) - int(b[-2])) <= distance and abs(int(a[-1]) - int(b[-1])) <= distance:
                    near.add((rg, q))
    return dup, near


@pytest.mark.parametrize("by_group", [True, False])
def test_duplicates_of_templates(spark, by_group):
    r = random.Random(3)
    rows = []
    for i in range(300):
        name, rg = f"M:1:FC:1:{r.randint(1, 2)}:{r.randint(0, 6000)}:{r.randint(0, 6000)}", r.choice(["a", "b"])
        at, size = r.choice([100, 100, 200, 300]), r.choice([150, 160])
        lead, trail = r.choice([0, 3]), r.choice([0, 4])
        qual = "".join(r.choice("!5I") for _ in range(20))
        first = (name, 65, "c", at + lead, at + 20, f"{lead}S{20 - lead}M" if lead else "20M", rg, qual)
        second = (name, 145, "c", at + size - 20, at + size - trail, f"{20 - trail}M{trail}H" if trail else "20M", rg, qual)
        kind = i % 6
        rows.append(first)
        rows.append(second if kind else (name, 133, "c", at, at, "*", rg, qual))
        if kind == 1:
            rows.append((name, 2113, "c", 900, 910, "10M10S", rg, qual))
        if kind == 2:
            rows.append((name, 65 | 0x100, "d", 5, 25, "20M", rg, qual))
    dup, near = brute_duplicates(rows, 2500, by_group)
    schema = "qname string, flag int, chrom string, start long, end long, cigar string, rg string, qual string"
    got = U.mark_duplicates(spark.createDataFrame(rows, schema), 2500, by_group).collect()
    assert len(got) == len(rows) and len(dup) > 200 and near
    for x in got:
        marked = (x["rg"], x["qname"]) in dup and not x["flag"] & (0x4 | 0x100)
        assert x["duplicate"] == marked and x["optical"] == (marked and (x["rg"], x["qname"]) in near)
    assert any(x["duplicate"] for x in got if x["flag"] & 0x800)


def test_templates_of_more_than_two_ends_are_equal_in_all_of_them(spark):
    rows = [(q, f, "c", a, a + 10, "10M", "g", "IIII") for q, ats in (("p", (0, 100, 300)), ("q", (0, 200, 300)), ("r", (0, 200, 300)), ("s", (200,)), ("t", (400,))) for f, a in zip((65, 65, 65), ats, strict=False)]
    schema = "qname string, flag int, chrom string, start long, end long, cigar string, rg string, qual string"
    got = U.mark_duplicates(spark.createDataFrame(rows, schema)).where("duplicate").select("qname").distinct().collect()
    assert sorted(x[0] for x in got) == ["r", "s"]


def brute_pileup(rows, min_bq, trim, depth):
    import re

    bases = {}
    for q, flag, chrom, pos, mapq, cigar, seq, qual, sample in rows:
        if flag & R.DROPPED or mapq < 20:
            continue
        ref, own = pos, 0
        for n, op in re.findall(r"([0-9]+)([MIDNSHP=X])", cigar):
            for k in range(int(n)):
                if op in "M=X" and trim <= own + k < len(seq) - trim and ord(qual[own + k]) - 33 >= min_bq:
                    bases.setdefault((chrom, ref + k, sample), {}).setdefault(q, []).append((-(ord(qual[own + k]) - 33), flag, seq[own + k].upper()))
            ref += int(n) * (op in "MDN=X")
            own += int(n) * (op in "MIS=X")
    out = {}
    for (chrom, pos, sample), by_name in bases.items():
        for name in sorted(by_name)[:depth]:
            _, flag, base = min(by_name[name], key=lambda x: x[:2])
            cell = out.setdefault((chrom, pos, sample, base), [0, 0])
            cell[bool(flag & 16)] += 1
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize(("trim", "depth"), [(0, 1000), (2, 3)])
def test_pileup_of_mates_and_tiles(spark, trim, depth):
    r = random.Random(7)
    rows = []
    for i in range(120):
        pos = r.choice([4070, 4080, 4090, 10])
        for mate, back in ((64, 0), (128, 16)):
            cigar, n = r.choice([("30M", 30), ("4S26M", 30), ("10M2D20M", 30), ("10M3I17M", 30), ("5H12M100N18M", 30)])
            rows.append((f"t{i:03}", 1 | mate | back | (0x400 if r.random() < 0.1 else 0), "c", pos + r.randint(0, 8), r.choice([10, 60, 60]), cigar, "".join(r.choice("ACGTNa") for _ in range(n)), "".join(r.choice("#5I") for _ in range(n)), r.choice(["s1", "s2"])))
    df = spark.createDataFrame(rows, "qname string, flag int, chrom string, pos long, mapq int, cigar string, seq string, qual string, sample_id string")
    got = {(x["chrom"], x["pos"], x["sample_id"], x["allele"]): (x["fwd"], x["rev"]) for x in R.pileup(df, trim=trim, max_depth=depth).collect()}
    assert got == brute_pileup(rows, 13, trim, depth) and len(got) > 150
    plan = R.pileup(df)._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_cuts_and_changes_take_no_function_call_for_each_letter(spark):
    from lociframe.operators import reads as R

    rows = [("AACC😀😀GT", "IIII!!!!"), ("ACGT", None), ("", ""), ("AC", "!!"), ("ACGTACGT", "IIIIIIII")]
    reads = spark.createDataFrame(rows, "seq string, qual string")
    cut, kept = R.cut_right(reads), R.read_filter(reads, 0, 5, 0.6)
    assert [r["seq"] for r in cut.collect()] == ["AAC", "ACGT", "", "", "ACGTACGT"]
    assert [r["seq"] for r in kept.collect()] == ["ACGT", "", "AC", "ACGTACGT"]
    assert all("lambda" not in df._jdf.queryExecution().optimizedPlan().toString() for df in (cut, kept))
