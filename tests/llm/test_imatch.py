"""I-Match fingerprints against plain Python: nulls, empty and long texts, repeats, null ids, clashing columns, tiles."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lociframe.llm import imatch

BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
MASK = (1 << 64) - 1


def name(text):
    return xxhash.xxh64_intdigest(text.encode(), seed=42)


def name_of_long(x, seed=42):
    return xxhash.xxh64_intdigest((x & MASK).to_bytes(8, "little"), seed=seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def terms(text):
    return {name(t) for t in BETWEEN.split(text.lower()) if t}


def brute_lexicon(texts, at_least, at_most):
    df = Counter(c for t in texts for c in {h >> 42 for h in terms(t)})
    return {c for c, n in df.items() if at_least * len(texts) <= n <= at_most * len(texts)}


def brute(text, lexicon):
    chosen = {h for h in terms(text) if h >> 42 in lexicon} or terms(text) or {name(text)}
    scale = max(1, int(math.log2(len(chosen))) - 1)
    hashes = []
    for s in range(scale, scale + 4):
        for i in range(16):
            low = min(s, 4)
            mine = [h for h in chosen if ((name_of_long(h ^ (1 + (i >> low))) if s < 4 else h) & ((1 << s) - 1)) == i & ((1 << low) - 1)]
            seed = 42
            for h in sorted(signed(h) for h in mine):
                seed = name_of_long(h, seed)
            hashes.append(1 + signed(seed) % 32767 if mine else 0)
    return scale, hashes


def brute_likeness(a, b):
    if a == b:
        return 1.0
    if abs(a[0] - b[0]) > 3:
        return 0.0
    pairs = [(a[1][16 * (s - a[0]) + i], b[1][16 * (s - b[0]) + i]) for s in range(max(a[0], b[0]), min(a[0], b[0]) + 4) for i in range(16)]
    used = [p for p in pairs if p != (0, 0)]
    return sum(p == q for p, q in used) / max(1, len(used))


def text_form(f):
    return f"{f[0]:02x}" + "".join(f"{h:04x}" for h in f[1])


def corpus(n=150, seed=4):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéÀ日x") for _ in range(r.randint(1, 6))) for _ in range(400)]
    out = [(3 * i if i % 50 else 10_000_000 + i, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 5, 30, 200])))) for i in range(n)]
    out += [(-5, None), (-6, ""), (-7, "  \n"), (-8, "###"), (-9, "One"), (-10, "w " * 50_000 + " ".join(words)), (-11, out[3][1]), (out[4][0], out[5][1]), out[6], (None, out[9][1])]
    return out


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, 2, "f") for x in rows], "doc_id long, text string, tile long, h long, own string")


def in_order(rows):
    return sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, signed(name(x[1]))), reverse=True)


@pytest.mark.parametrize("tile", [1024, 4])
def test_against_brute_force(spark, rows, monkeypatch, tile):
    monkeypatch.setattr(imatch, "TILE_ROWS", tile)
    lexicon = brute_lexicon([t or "" for _, t in rows], 0.01, 0.3)
    line = in_order(rows)
    want = []
    for k, (i, text) in enumerate(line):
        after = line[(k + 1) % len(line)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        f, e, g = brute(text, lexicon), brute(edited, lexicon), brute(after, lexicon)
        want.append((i if i is not None else -99, len(text), hashlib.sha256(edited.encode()).hexdigest(), text_form(f), text_form(e), round(brute_likeness(f, e), 9), round(brute_likeness(f, g), 9)))
    found = imatch.edited_fingerprints(frame(spark, rows).repartition(3), at_least=0.01, at_most=0.3)
    got = [(*(-99 if v is None else v for v in r[:5]), round(r[5], 9), round(r[6], 9)) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_half_edited_texts_stand_out(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(r.choice(words) for _ in range(120))) for i in range(200)]
    out = imatch.edited_fingerprints(frame(spark, rows)).agg(F.avg((F.col("near_edited") > F.col("near_next")).cast("double")), F.avg("near_edited"), F.avg("near_next")).first()
    assert out[0] > 0.97 and out[1] > 0.1 and out[2] < 0.05


def test_fingerprints_of_a_table(spark, rows):
    found = imatch.document_fingerprints(frame(spark, rows), at_least=0.01, at_most=0.3)
    assert found.count() == len(rows)
    lexicon = brute_lexicon([t or "" for _, t in rows], 0.01, 0.3)
    want = sorted((-99 if i is None else i, text_form(brute(t or "", lexicon))) for i, t in rows)
    assert sorted((-99 if r[0] is None else r[0], r[1]) for r in found.select("doc_id", "fingerprint").collect()) == want


def test_one_row_and_none(spark):
    assert imatch.edited_fingerprints(frame(spark, [])).count() == 0 and imatch.document_fingerprints(frame(spark, [])).count() == 0
    one = imatch.edited_fingerprints(frame(spark, [(4, "ab cd")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"ab ab").hexdigest() and one["near_next"] == 1.0
