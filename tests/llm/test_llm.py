"""Training-data operators against brute force on small fixtures: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lociframe.llm import arrays as A
from lociframe.llm import embedding_dedup, frames, mixing, pieces, quality_classifier, quality_rules, simhash, stats, substring_dedup, suffix_dedup, token_output, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, g int, bucket int"


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = ["al", "be", "ga", "de", "Ep", "ze", "eta", "théta", "x|y", "###"]
    line = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared, out = line(40), []
    for i in range(n):
        text = "\n".join(line(r.randint(1, 60)) for _ in range(r.randint(1, 4)))
        out.append((i, text if i % 3 else text + "\n" + shared))
    out += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one"), (n + 4, line(6000)), (n + 5, out[1][1]), (n + 5, out[1][1]), (None, out[4][1]), (n + 7, "word " * 300)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}" if (d or 0) % 7 else None, 0, 1, 2) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).persist()


def key(d):
    return -1 if d is None else d


def test_statistics(docs, rows):
    got = sorted((key(r["doc_id"]), *(r[c] for c in stats.COUNTS)) for r in stats.with_stats(docs).collect())

    def brute(t):
        w = WORD.findall(t or "")
        grams = {}
        for i in range(len(w) - 2):
            grams.setdefault(tuple(w[i : i + 3]), []).append(i)
        hit = {i + k for v in grams.values() if len(v) > 1 for i in v for k in range(3)}
        lines, seen = 0, set()
        for x in (t or "").split("\n"):
            if WORD.search(x):
                lines += x in seen
                seen.add(x)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), lines, len(hit)

    assert got == sorted((key(d), *brute(t)) for d, t in rows)


def test_empty_tables(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.quality_rules(none, labels).count() == 0 and quality_classifier.quality_classifier(none, labels).count() == 0
    assert simhash.simhash_groups(none).count() == 0 and substring_dedup.substring_dedup(none).count() == 0 and suffix_dedup.suffix_dedup(none).count() == 0
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert token_output.read_tokens(token_output.write_tokens(none, token_output.public_tokenizer("byte_bpe_50k.json"))).count() == 0
    assert pieces.sentencepiece_encode(none, token_output.public_tokenizer("piece_bpe_32k.model")).count() == 0
    assert url_filter.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_trees_are_monotonic_and_learn():
    r = np.random.default_rng(0)
    x = r.random((800, 4))
    y = ((x[:, 0] < 0.5) & (x[:, 1] > 0.3)).astype(float)
    trees = quality_rules.grow(x, y, worse=(0,))
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.97
    z = np.repeat(r.random((50, 4)), 20, axis=0)
    z[:, 0] = np.tile(np.linspace(0, 1, 20), 50)
    assert (np.diff(trees.score(z).reshape(50, 20), axis=1) <= 1e-12).all()
    assert quality_rules.grow(np.zeros((0, 4)), np.zeros(0)).score(np.zeros((2, 4))) == pytest.approx([0.5, 0.5])


def labelled(spark, n=600):
    r, rows, labels = random.Random(4), [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [r.choice(["alpha", "beta", "gamma,", "delta."]) + ("###" if bad else "") + str(r.randint(0, 99)) for _ in range(r.randint(60, 200))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_models_on_held_out_rows(spark):
    d, labels = labelled(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality_classifier.quality_classifier(d, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"]]) > 0.95
    rules = quality_rules.quality_rules(d, labels).collect()
    assert np.mean([r["kept"] == bool(truth[r["doc_id"]]) for r in rules if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]) > 0.95
    kept = {r["doc_id"] for r in quality_rules.quality_filter(d, labels).collect()}
    assert kept == {r["doc_id"] for r in rules if r["kept"]}


def union_find(pairs, nodes):
    p = {n: n for n in nodes}

    def find(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            p[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(0)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5), (None, 3)]
    got = {x["node"]: x["component"] for x in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find([e for e in edges if None not in e], {n for e in edges if None not in e for n in e})
    assert got == {n: c for n, c in want.items() if n != c}


def test_simhash(docs, rows):
    def fingerprint(t):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 2]
    roots = union_find(pairs, range(len(fps)))
    least = {r: min((rows[i][0] for i in roots if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots.values())}
    want = sorted((key(rows[i][0]), f"{fps[i]:016x}", least[roots[i]]) for i in roots)
    assert sorted((key(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(docs).collect()) == want


@pytest.mark.parametrize("points", [10, 50_000, 10**7])
def test_covering_code_loses_no_link(points):
    code, r = simhash.Cover(points, 2), np.random.default_rng(points)
    x = r.integers(0, 2**64, 2000, dtype=np.uint64)
    y = x ^ (np.uint64(1) << r.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 2000).astype(np.uint64))
    row, at = code.anchors(y[:, None])
    there = set(zip(row.tolist(), at.tolist(), strict=True))
    assert all((i, h) in there for i, h in enumerate(code.home(x[:, None]).tolist()))


def test_substring_dedup(docs, rows):
    order = {i: float("inf") if d is None else d for i, (d, _) in enumerate(rows)}
    w = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for i, x in enumerate(w):
        for k in range(len(x) - 12):
            g = tuple(x[k : k + 13])
            first[g] = min(first.get(g, float("inf")), order[i])
    want = []
    for i, x in enumerate(w):
        gone = {k + j for k in range(len(x) - 12) if first[tuple(x[k : k + 13])] < order[i] for j in range(13)}
        want.append((key(rows[i][0]), len(x), len(gone), " ".join(v for k, v in enumerate(x) if k not in gone)))
    for base in (4, 7, 13):
        got = sorted((key(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"]) for r in substring_dedup.substring_dedup(docs, base=base).collect())
        assert got == sorted(want)
    assert substring_dedup.substring_dedup(docs, carry=("lang", "bucket")).columns[:3] == ["doc_id", "lang", "bucket"]


@pytest.mark.parametrize("length,gram", [(200, 32), (40, 8)])
def test_suffix_dedup(docs, rows, length, gram):
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    want = []
    for (d, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        want.append((key(d), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.suffix_dedup(docs, length=length, gram=gram)
    assert sorted((key(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got.collect()) == sorted(want)


def test_token_blocks_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 127, 128, 129, 3000):
        for top in (1, 2, 300, 2**32):
            x = r.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            assert (token_output.unpack(token_output.pack(x)) == x).all()


def test_token_output(docs, rows):
    from tokenizers import Tokenizer

    path = token_output.public_tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    start, want = 0, []
    for d, text in sorted(rows, key=lambda x: (key(x[0]), x[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], np.uint32)
        want.append((key(d), start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_output.read_tokens(token_output.write_tokens(docs, path)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("c")).collect()
    assert sorted((key(r[0]), *r[1:]) for r in got) == sorted(want)
    odd = ["a  b", " lead", "tail ", "x\n y", "<|endoftext|>", "a   b c", "it's 12 ok?", "é漢 \r\n"]
    ids, counts = token_output.Encoder(path)(*A.text_bytes(pa.array(odd)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [t.encode(x, add_special_tokens=False).ids for x in odd]


def test_segmentations():
    import sentencepiece

    path = token_output.public_tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    model, r = pieces.Model(path), random.Random(2)

    def brute(text, n):
        if not text:
            return [0.0]
        text, out = "▁" + text.replace(" ", "▁"), []

        def go(i, s):
            if i == len(text):
                out.append(s)
                return
            if text[i] not in model.pieces:
                go(i + 1, s + model.unknown)
            for j in range(i + 1, len(text) + 1):
                if text[i:j] in model.pieces:
                    go(j, s + model.pieces[text[i:j]][1])

        go(0, 0.0)
        return sorted(out, reverse=True)[:n]

    texts = ["".join(r.choice(["a", "th", "e", " ", "in", ".", "\n", "é", "漢"]) for _ in range(r.randint(0, 7))) for _ in range(120)]
    for n in (1, 2, 4):
        for text, got in zip(texts, pieces.Segmenter(path, n)(*A.text_bytes(pa.array(texts))), strict=True):
            assert [s for s, _ in got] == pytest.approx(brute(text, n)) and len({i for _, i in got}) == len(got)
            assert all(sp.decode(np.frombuffer(i, np.uint32).tolist()) == text for _, i in got)


def test_piece_round_trip(spark, docs, rows):
    path = token_output.public_tokenizer("piece_bpe_32k.model")
    more = frame(spark, [(1000, "a▁b ▁"), (1001, "x" * 3000)]).unionByName(docs)
    best = pieces.sentencepiece_encode(more, path, 2, carry=("text",)).select("text", F.get("nbest", F.lit(0))["ids"].alias("ids"))
    out = pieces.sentencepiece_decode(best, path, carry=("text",)).collect()
    assert len(out) == len(rows) + 2 and all(r["decoded"] == (r["text"] or "") for r in out)


def test_mixing(docs, rows):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows) and sorted(r.asDict().items() for r in got) == sorted(r.asDict().items() for r in mixing.mix_sources(docs).collect())
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    size = {s: sum(r["size"] for r in x) for s, x in by.items()}
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    goal, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > 2 * size[s]}
        if not full:
            goal |= {s: unit * weight[s] for s in open_}
            break
        goal |= {s: 2.0 * size[s] for s in full}
        left -= sum(2.0 * size[s] for s in full)
        open_ -= full
    for s, x in by.items():
        assert x[0]["target"] == pytest.approx(goal[s]) and abs(sum(r["taken"] for r in x) - goal[s]) <= 1 and x[0]["source_size"] == size[s]
    # the last pass takes documents in order of their keys, the last of them in part
    keys = {(r["doc_id"], r["size"]): r["key"] for r in mixing.keyed(docs, "doc_id", "text", "source", None, 7).collect()}
    for s, x in by.items():
        epochs = int(goal[s] // size[s])
        extra = [r["taken"] - epochs * r["size"] for r in sorted(x, key=lambda r: (keys[r["doc_id"], r["size"]], key(r["doc_id"]), r["size"])) if r["size"]]
        assert [e > 0 for e in extra] == sorted((e > 0 for e in extra), reverse=True)
    copies = {}
    for r in mixing.mixed_documents(docs).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    for r in got:
        if r["size"] and r["doc_id"] not in (None, 65):
            assert abs(copies.get(r["doc_id"], 0) - r["taken"] / r["size"]) <= 0.5


def test_urls(spark):
    urls = [None, "", "no scheme", "http://a.com", "http://A.COM/", "https://www.example.com/en/x?y", "https://example.com/en/", "https://sub.example.com/en/1#t", "http://x.net/es/", "http://x.net/esx", "net://net/fr/", "http://example.com?u=/en/", "http://b.org/en/", "http://www.example.com/en/", "http://xexample.com/en/"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert got[0] == ("", "", None, "allow") and got[2] == ("", "", None, "allow") and got[3] == ("a.com", "", None, "allow") and got[4] == ("a.com", "/", "com/", "allow")
    assert got[5] == ("www.example.com", "/en/x", "www.example.com/en/", "allow") and got[6][2:] == ("example.com/en/", "block") and got[7][2:] == ("example.com/en/", "block")
    assert got[8][2:] == ("net/es/", "block") and got[9][2:] == (None, "allow") and got[10][2:] == ("net/fr/", "block") and got[11][1:] == ("", None, "allow") and got[14][2:] == ("com/", "allow")


def test_cascade_is_exact(spark):
    keys = [f"k{i}" for i in range(3000)]
    listed = spark.createDataFrame([(k,) for k in keys[:200]], "key string")
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    levels = url_filter.cascade(listed, universe)
    assert len(levels) > 1
    assert {r["key"] for r in universe.where(url_filter.listed(levels, F.col("key"))).collect()} == set(keys[:200])


def test_rules_as_a_frame_by_filters_and_by_joins(spark):
    """Many rules, clashing hosts and paths, equal keys of two verdicts, repeated and odd urls: both ways as a plain search."""
    r = random.Random(7)
    hosts = ["".join(r.choice("ab") for _ in range(r.randint(1, 2))) + "." + t for t in ("com", "net") for _ in range(5)]
    rules = sorted({(h, "/" + "".join(r.choice("xy/") for _ in range(r.randint(0, 3))), r.choice(["allow", "block", "look"])) for h in [*hosts, "com"] for _ in range(6)})
    urls = [f"http://{r.choice(['', 'w.', 'w.v.'])}{r.choice(hosts)}/{''.join(r.choice('xy/') for _ in range(r.randint(0, 5)))}" for _ in range(300)] + [None, "", "x", "http://" + "a" * 5000 + ".com/" + "x" * 5000]
    pages = spark.createDataFrame([(i % 290, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, path string")

    def brute(u):
        if not u or "://" not in u:
            return "", "", None, "none"
        host, _, path = u.split("://", 1)[1].partition("/")
        path = "/" + path
        fit = [(-len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *((min(fit)[1], min(fit)[2]) if fit else (None, "none"))

    want = sorted(((i % 290, *brute(u)) for i, u in enumerate(urls)), key=str)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    for most in (10**6, 10):
        got = url_filter.url_filter(pages, table, default="none", max_keys=most)
        assert sorted((tuple(x) for x in got.collect()), key=str) == want
    assert sorted((tuple(x) for x in url_filter.url_filter(pages, tuple(rules), default="none").collect()), key=str) == want


def test_embeddings(spark):
    r = np.random.default_rng(3)
    x = embedding_dedup.unit(r.standard_normal((400, 32)))
    z = r.standard_normal((400, 32))
    z = embedding_dedup.unit(z - (z * x).sum(1)[:, None] * x)
    c = r.uniform(0.95, 1, (400, 1))
    v = np.concatenate([x, c * x + np.sqrt(1 - c * c) * z, x[:1], 3 * x[:1]])
    bad = [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [1.0], []]
    rows = [(i, list(map(float, a))) for i, a in enumerate(v)] + [(1000 + i, b) for i, b in enumerate(bad)] + [(None, list(map(float, x[5])))]
    got = {r["vec_id"]: r for r in embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    near = (embedding_dedup.unit(v) @ embedding_dedup.unit(v).T) >= 0.95
    np.fill_diagonal(near, False)
    extra = near[:, 5] | (np.arange(len(v)) == 5)
    assert len(got) == len(rows) and all(got[i]["n_links"] <= near[i].sum() + extra[i] for i in range(len(v)))
    assert sum(got[i]["n_links"] for i in range(len(v))) >= 0.9 * near.sum()
    assert got[0]["n_links"] >= 2 and got[802 - 1]["component_id"] == 0 and not got[801]["kept"] and got[0]["kept"]
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["component_id"] == 1000 + i and got[1000 + i]["kept"] for i in range(len(bad)))
    assert got[None]["component_id"] is None and not got[None]["kept"]


def test_pipeline(spark, tmp_path):
    d, labels = labelled(spark, 200)
    copies = d.where("doc_id in (1, 2, 3)").withColumn("doc_id", F.col("doc_id") + 1000)
    d.unionByName(copies).drop("g", "bucket").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        seen.append(now)
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in seen]
    assert len(corpus_pipeline.STAGES) == 5 and all(s.columns == list(corpus_pipeline.DOCUMENT) for s in seen[:4])
    assert not {i for i in ids[0] if i % 4 == 0 and i < 1000} and ids[1] <= ids[0] and not ids[1] & {1001, 1002, 1003} and ids[4] == ids[3]
    assert seen[4].where("not exact").count() == 0


def edited(r, sizes, edits):
    """Texts in pairs: a text and a copy with some of its words, far apart, replaced."""
    texts = []
    for size, k in zip(sizes, edits, strict=True):
        w = [f"w{r.randrange(3000)}" for _ in range(size)]
        v = list(w)
        for at in range(k):
            v[at * size // max(k, 1) + 7] = f"edited{r.randrange(10**9)}"
        texts += [" ".join(w), " ".join(v)]
    return texts


def jaccard(x, y, k=corpus_pipeline.SHINGLE):
    a, b = ({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (x.split(), y.split()))
    return len(a & b) / len(a | b)


def test_pipeline_near_copies_are_verified(spark):
    """With the pipeline's parameters: pairs from 0.66 to 0.9, nearly all at 0.8 and over link and none below."""
    texts = edited(random.Random(4), [300] * 300, [3 + i % 9 for i in range(300)])
    alike = np.array([jaccard(texts[2 * i], texts[2 * i + 1]) for i in range(300)])
    groups = simhash.similar_groups(frame(spark, list(enumerate(texts))), corpus_pipeline.SHINGLE, corpus_pipeline.SIMILARITY, corpus_pipeline.NEAR_BITS)
    got = {x["doc_id"]: x["component_id"] for x in groups.collect()}
    joined = np.array([got[2 * i + 1] == 2 * i for i in range(300)])
    assert all(got[2 * i] == 2 * i for i in range(300)) and (alike < 0.8).sum() > 100
    assert not joined[alike < 0.8].any() and joined[alike >= 0.8].mean() >= 0.97


def test_pipeline_chains_and_clusters_of_near_copies(spark):
    """A cluster whose members only reach each other over others, beside sets equal in all but order and unlinked texts."""
    r = random.Random(5)
    w = [f"w{r.randrange(3000)}" for _ in range(300)]
    texts = []
    for k in range(40):
        v = list(w)
        for at in range(k):
            v[7 * at + 3] = f"e{at}"
        texts.append(" ".join(v))
    texts += [None, "", "one", "One", *edited(r, [250] * 3, [0] * 3)]
    pairs = [(i, j) for i in range(40) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8]
    roots = union_find([*pairs, (40, 41), (42, 43), (44, 45), (46, 47), (48, 49)], range(len(texts)))
    got = simhash.similar_groups(frame(spark, list(enumerate(texts)))).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == roots


@pytest.mark.parametrize("points", [10**4, 10**6, 10**8, 10**10])
def test_soft_anchors_keep_recall_at_every_size(points):
    """Simulated pairs at similarity 0.8, other draws than those that the visits are measured on."""
    code, r, n = simhash.Soft(points), np.random.default_rng(points), 1000
    x = r.standard_normal((n, 128))
    sides = x, 8 / 9 * x + np.sqrt(1 - 64 / 81) * r.standard_normal((n, 128))
    fps = [simhash.packed(s > 0) for s in sides]
    met = np.zeros(n, bool)
    for here, there in ((0, 1), (1, 0)):
        rows, where = code.anchors(fps[here], np.minimum(np.abs(sides[here]) * 32, 255).astype(np.uint8))
        for t in range(code.tables):
            np.logical_or.at(met, rows, where == code.home(fps[there], t)[rows])
    assert met.mean() >= 0.96


@pytest.mark.parametrize("hot", [1, 3])
def test_suffix_dedup_of_hot_anchors(spark, hot):
    """A passage amid differing text: its anchors have a segment per document, told apart window by window."""
    r = random.Random(6)
    line = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    shared = line(60)
    texts = [line(r.randint(0, 60)) + shared[r.randint(0, 15) :] + line(r.randint(0, 60)) for _ in range(60)] + [shared + shared, line(90)]
    docs = frame(spark, list(enumerate(texts)))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    seen = {}
    for t in texts:
        for i in range(len(t) - 39):
            seen[t[i : i + 40]] = seen.get(t[i : i + 40], 0) + 1
    gone = [{j for i in range(len(t) - 39) if seen[t[i : i + 40]] > 1 for j in range(i, i + 40)} for t in texts]
    got = sorted(suffix_dedup.suffix_dedup(docs, length=40, gram=8, hot=hot).select(*columns).collect())
    assert [(x["doc_id"], x["n_removed"], bytes(x["kept"]).decode()) for x in got] == [(i, len(g), "".join(c for j, c in enumerate(t) if j not in g)) for i, (t, g) in enumerate(zip(texts, gone, strict=True))]
    assert got == sorted(suffix_dedup.suffix_dedup(docs, length=40, gram=8).select(*columns).collect())


@pytest.mark.parametrize("chunk,chunks", [(16, 3), (8, 1)])
def test_large_families_are_verified_in_chunks_and_by_anchors(spark, chunk, chunks):
    """One family dealt whole, by pairs of chunks, and by anchors: the same classes."""
    r = random.Random(8)
    w = [f"w{r.randrange(3000)}" for _ in range(200)]
    texts = []
    for _ in range(90):
        v = list(w)
        for at in r.sample(range(40), r.randint(1, 5)):
            v[5 * at] = f"e{r.randrange(10**9)}"
        texts.append(" ".join(v))
    rows = frame(spark, list(enumerate(texts)))
    want = union_find([(i, j) for i in range(90) for j in range(i) if jaccard(texts[i], texts[j]) >= 0.8], range(90))
    got = {x["doc_id"]: x["component_id"] for x in simhash.similar_groups(rows, chunk=chunk, chunks=chunks).collect()}
    assert len(set(want.values())) > 1 and got == want == {x["doc_id"]: x["component_id"] for x in simhash.similar_groups(rows).collect()}


def test_similar_pairs_against_brute_force():
    r = np.random.default_rng(4)
    for sides, cells in ((1, 1 << 23), (2, 1 << 23), (1, 40)):
        base = r.integers(0, 2**63, 30, dtype=np.uint64)
        sets = [np.unique(np.concatenate([r.choice(base, r.integers(15, 30), replace=False), r.integers(0, 2**63, r.integers(0, 4), dtype=np.uint64)])) for _ in range(60)] + [np.zeros(0, np.uint64)] * 2
        side = np.arange(len(sets)) % sides
        fps = r.integers(0, 4, (len(sets), 2), dtype=np.uint64)
        ends = np.cumsum([0, *map(len, sets)])
        found = simhash.similar_pairs(fps, side, ends, np.concatenate(sets), 3, 0.8, cells)
        got = {(int(i), int(j)) for x, y in found for i, j in zip(x, y, strict=True)}
        jac = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)) - 1e-9
        want = {(i, j) for j in range(len(sets)) for i in range(j) if (sides == 1 or side[i] != side[j]) and int(np.bitwise_count(fps[i] ^ fps[j]).sum()) <= 3 and jac(sets[i], sets[j])}
        assert got == want and len(got) > 5


def test_words_are_remembered_within_a_bound():
    """However few words the memory holds, ids and segmentations are the same; and words of one hash keep their own entries."""
    from lociframe.llm.wordtable import WordTable, distinct, name_hash, word_keys

    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdé漢.,1") for _ in range(r.randint(1, 20))) for _ in range(r.randint(0, 60))) for _ in range(120)]
    bpe, sp = token_output.public_tokenizer("byte_bpe_50k.json"), token_output.public_tokenizer("piece_bpe_32k.model")
    big, small, one, other = token_output.Encoder(bpe), token_output.Encoder(bpe), pieces.Segmenter(sp, 2), pieces.Segmenter(sp, 2)
    small.known.bound, other.words.bound, other.PARTS = 50, 50, 3
    for a in range(0, 120, 10):
        column = A.text_bytes(pa.array(texts[a : a + 10]))
        assert all((x == y).all() for x, y in zip(big(*column), small(*column), strict=True)) and one(*column) == other(*column)
    assert len(small.known) <= 50 + 1000 and len(big.known) > 500
    names, short = word_keys(np.frombuffer(b"abcabcdefghijklmnopq", np.uint8), np.array([0, 3, 3]), np.array([3, 6, 20]), np.array([0, 0, 1], np.uint8))
    assert (names[0] == names[1]).all() and short.tolist() == [True, True, False]
    which, first, hashes = distinct(names)
    assert which.tolist() == [0, 0, 1] and first.tolist() == [0, 2] and (hashes == name_hash(names[first])).all()
    table = WordTable(10)
    table.add(names[:1], np.array([7], np.uint64), np.array([2]), np.array([5, 6], np.uint32))
    assert table.find(names[2:], np.array([7], np.uint64)).tolist() == [-1] and table.find(names[:1], np.array([7], np.uint64)).tolist() == [0]


def test_white_space_and_odd_texts_encode_as_the_library_does():
    path = token_output.public_tokenizer("byte_bpe_50k.json")
    encoder, r = token_output.Encoder(path), random.Random(1)
    parts = ["a", "Bc", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", ".", ",", "é", "漢", "it's", "'s", "12", "\u00a0", "\u2003", "—", "x" * 20, "<|endoftext|>", "\r\n", "\x1f", "Ġ", "ABC.", "é,", "\x85", "\u3000"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    ids, counts = encoder(*A.text_bytes(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_components_that_do_not_settle_raise(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")
    with pytest.raises(RuntimeError, match="not settled"):
        frames.components(edges, rounds=1)


MESSY = "doc_id long, text string, lang string, source string, n_chars long, extra string, g int, point long"


def messy(spark, rows):
    return spark.createDataFrame([(d, t, None if (d or 0) % 5 == 0 else "en", f"s{(d or 0) % 3}" if (d or 0) % 4 else None, None if t is None else len(t), "x", 1, 2) for d, t in rows], MESSY)


def clean_text(r, k=120):
    return "\n".join(" ".join(r.choice(["alpha", "beta", "gamma,", "delta."]) + str(r.randint(0, 999)) for _ in range(k // 3)) for _ in range(3)) + "\n"


def test_stages_on_nulls_empty_and_long_texts_repeats_ties_and_extra_columns(spark, tmp_path):
    """Every stage gives its stated result on a messy table and nothing on an empty one."""
    _, labels = labelled(spark, 60)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    r = random.Random(9)
    base = clean_text(r)
    long_text = " ".join(clean_text(r) for _ in range(60))
    rows = [(1, base), (2, None), (3, ""), (4, " \n\t "), (5, base), (6, long_text), (7, clean_text(r)), (7, clean_text(r)), (8, base.replace("\n", " \n  ")), (None, clean_text(r)), (None, None)]
    d = messy(spark, [*rows, rows[6]]).repartition(2)
    done = {name: stage(spark, d, str(tmp_path)) for name, stage in corpus_pipeline.STAGES}
    assert all(done[n].columns == list(corpus_pipeline.DOCUMENT) for n in done if n != "sentencepiece")
    pairs = lambda df: sorted((key(x["doc_id"]), x["text"]) for x in df.collect() if x["text"] is not None)
    kept = pairs(done["quality_rules"])
    assert {i for i, _ in kept} <= {-1, 1, 5, 6, 7, 8} and all(x in [(key(i), t) for i, t in rows] for x in kept)
    near = [(x["doc_id"], x["text"]) for x in done["simhash_near_dedup"].collect()]
    # copies of one text, white space aside, are one group; texts without words too; rows equal in id and text are one
    assert sorted(i for i, _ in near if i is not None) == [1, 2, 6, 7, 7] and sum(i is None for i, _ in near) == 2
    passages = done["substring_dedup"].collect()
    whole = {(key(x["doc_id"]), x["text"]) for x in passages}
    assert {(1, base), (6, long_text), (7, rows[6][1]), (7, rows[7][1]), (3, ""), (4, " \n\t "), (2, None)} <= whole
    assert not {5, 8} & {x["doc_id"] for x in passages} and all(x["n_chars"] == (None if x["text"] is None else len(x["text"])) for x in passages)
    mixed = done["mix_sources"].collect()
    assert {key(x["doc_id"]) for x in mixed} <= {key(i) for i, _ in rows} and len(mixed) >= len(rows)
    pieces_ = done["sentencepiece"].collect()
    assert len(pieces_) == len(rows) + 1 and all(x["exact"] for x in pieces_)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, messy(spark, []), str(tmp_path)).count() == 0


def test_passages_are_cut_out_of_the_text_as_it_is(spark):
    r = random.Random(2)
    passage = " ".join(f"p{r.randrange(500)}" for _ in range(40))
    head, tail = "A first line.\n\n  indented,\tand more\n", "\n\nlast words  \n"
    rows = [(1, f"x {passage} y"), (2, head + passage + tail), (3, head + "\n" + tail)]
    got = {x["doc_id"]: x["kept_text"] for x in substring_dedup.substring_dedup(frame(spark, rows), joined=False).collect()}
    assert got == {1: rows[0][1], 2: head + "last words  \n", 3: rows[2][1]}
