"""Source divergence against plain Python: nulls, empty and long texts, ties, repeats, clashing columns, small shards."""

import random
import re
from collections import Counter, defaultdict

import pytest

from lociframe.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = [t.translate(UP) for t in TERM.findall(text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        p, total = {}, Counter()
        for s in sources:
            n = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (n + 2 * v) for t in kept}
            total.update({t: counts[lang, s][t] for t in kept})
        whole = sum(total.values())
        q = {t: 1 + 10**9 * (total[t] + 2) // (whole + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def corpus():
    r = random.Random(3)
    words = ["Le", "la", "ÉTÉ", "été", "x", "y", "zeta", "théta", "日本", "a\u0000b", "o'clock", "[k]", "Q9q"]
    rows = []
    for i in range(400):
        n = r.choice([0, 1, 3, 8, 30])
        source = f"s{r.choice([0, 0, 0, 0, 1, 2, 3, 4])}"
        rows.append((" ".join(r.choice(words[: 4 + 2 * int(source[1])]) for _ in range(n)), r.choice(["en", "fr"]), source))
    rows += [(None, "en", "s9"), ("", "xx", "s1"), ("le la", None, None), ("le " * 40_000, "fr", "s2"), ("###", "xx", "s2")] + [("x y x", "en", None)] * 25
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "w") for r in rows], "text string, lang string, source string, n long, total long, term string")


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_against_brute_force(spark, rows):
    assert got(divergence.source_divergence(frame(spark, rows).repartition(5))) == brute(rows)


def test_small_runs_blocks_and_other_limits(spark, rows, monkeypatch):
    # tasks run in forked workers that import the module anew, so the functions are called here
    monkeypatch.setattr(divergence, "SLICE_BYTES", 50)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 20)
    import pyarrow as pa

    columns = [pa.array([x or "" for x in c]) for c in zip(*[(lang, source, text) for text, lang, source in rows], strict=True)]
    batches = list(divergence.partial_counts(iter([pa.RecordBatch.from_arrays(columns, names=["lang", "source", "text"])])))
    assert len(batches) > 3
    total = Counter()
    for b in batches:
        for x in b.to_pylist():
            total[x["lang"], x["source"], x["term"]] += x["n"]
    want = Counter((lang or "", source or "", t.translate(UP)) for text, lang, source in rows for t in TERM.findall(text or ""))
    assert total == want
    assert got(divergence.source_divergence(frame(spark, rows), min_docs=3, top=2)) == brute(rows, 3, 2)


def test_many_sources_in_blocks(spark):
    r = random.Random(5)
    rows = [(" ".join(r.choice("abcdefgh") for _ in range(6)), "en", f"s{i % 300}") for i in range(600)]
    assert got(divergence.source_divergence(frame(spark, rows))) == brute(rows)


def test_no_rows(spark):
    assert divergence.source_divergence(frame(spark, [])).count() == 0
