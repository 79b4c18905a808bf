"""The trained models against plain formulas: densities, flat trees, verdicts; recall of the embedding grid; null and odd rows."""

import random

import numpy as np
import pytest

from lociframe.llm import embedding_dedup as D
from lociframe.llm import quality_classifier as C
from lociframe.llm import quality_rules as Q


def data(n=600, k=6, seed=1):
    r = np.random.default_rng(seed)
    y = r.integers(0, 2, n)
    x = r.normal(size=(n, k)) * (1 + y[:, None]) + 2 * y[:, None] * np.arange(k)
    return x, y


def test_scores_are_log_densities_of_shrunken_classes():
    x, y = data()
    model = C.fit(x, y)
    z = np.sign(x) * np.sqrt(np.abs(x))
    z = np.clip((z - z.mean(0)) / (z.std(0) + 1e-6), -8, 8)
    parts = [z[y == c] for c in (0, 1)]
    own = [np.cov(p.T, bias=True) for p in parts]
    pooled = sum(s * len(p) for s, p in zip(own, parts, strict=True)) / len(z)
    logs = []
    for p, s in zip(parts, own, strict=True):
        s = 0.7 * s + 0.3 * pooled
        s = 0.9 * s + 0.1 * np.diag(np.diag(s)) + 0.01 * np.eye(len(s))
        d = z - p.mean(0)
        logs.append(np.log((len(p) + 1) / (len(z) + 2)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(-(logs[1] - logs[0]) / 4)), abs=1e-9)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    assert (C.fit(x[:0], y[:0]).score(x) == 0.5).all()


def walked(trees, row):
    total = trees.base
    for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
        at = 0
        while at < len(feature):
            at = 2 * at + (1 if row[feature[at]] <= threshold[at] else 2)
        total += leaf[at - len(feature)]
    return total


def test_flat_trees_equal_a_walk_and_are_monotonic():
    x, y = data(400, 5, 3)
    trees = Q.grow(x, y.astype(float), worse=(0, 4), trees=20)
    assert trees.margin(x) == pytest.approx([walked(trees, row) for row in x], abs=1e-12)
    assert ((trees.score(x) >= 0.5) == y).mean() > 0.85
    for j in (0, 4):  # the score never rises with these
        for row in x[:40]:
            line = np.repeat(row[None], 50, 0)
            line[:, j] = np.linspace(-8, 20, 50)
            assert (np.diff(trees.margin(line)) <= 1e-12).all()


def test_verdicts_of_documents(spark):
    r = random.Random(5)
    good = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(r.randint(60, 200)))
    bad = lambda: " ".join("".join(r.choice("#$%&*<>|") for _ in range(r.randint(2, 7))) for _ in range(r.randint(60, 200)))
    rows = [(i, good() if i % 2 else bad()) for i in range(160)] + [(200, None), (201, ""), (202, "short text"), (203, "same three words " * 40), (204, good()), (204, good()), (None, good())]
    docs = spark.createDataFrame([(*x, 1, 0.5) for x in rows], "doc_id long, text string, n_words int, score double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(160)], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(docs, labels).collect()
    assert len(got) == len(rows)
    by = {}
    for x in got:
        by.setdefault(x["doc_id"], []).append(x)
    assert all(by[i][0]["kept"] == bool(i % 2) for i in range(160)) and not any(by[i][0]["base_failed"] for i in range(160))
    assert all(by[i][0]["base_failed"] and not by[i][0]["kept"] for i in (200, 201, 202, 203))
    assert [x["kept"] for x in by[204]] == [True, True] and by[None][0]["kept"]
    kept = Q.quality_filter(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(x["kept"] for x in got)
    judged = C.quality_classifier(docs, labels).collect()
    assert len(judged) == len(rows) and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.5) for x in judged)
    held = [x for x in judged if x["held_out"]]
    assert all(x["predicted"] == x["doc_id"] % 2 for x in held if x["doc_id"] < 160) and not any(x["held_out"] for x in judged if x["doc_id"] is None)


def test_components_and_links_of_embeddings(spark):
    """Planted groups on a grid of several codewords, against brute force: no false link, and recall of links."""
    r = np.random.default_rng(7)
    centres = r.standard_normal((700, 32))
    x = np.concatenate([centres, centres[:150] + 0.12 * r.standard_normal((150, 32)), centres[:60] + 0.12 * r.standard_normal((60, 32)), np.repeat(centres[:1], 40, 0)]).astype(np.float32)
    rows = [(int(i), v.tolist(), 1) for i, v in enumerate(x)] + [(5000, None, 1), (5001, [0.0] * 32, 1), (5002, [float("nan")] * 32, 1), (5003, x[3].tolist(), 2), (5003, x[3].tolist(), 2)]
    got = D.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, cell long")).collect()
    assert len(got) == len(rows)
    ids = np.array([i for i, v, _ in rows if i not in (5000, 5001, 5002)])
    u = np.array([v for i, v, _ in rows if i not in (5000, 5001, 5002)], np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(link, label[None, :], 1 << 40).min(1))
        if (new == label).all():
            break
        label = new
    want, found = dict(zip(ids.tolist(), zip(link.sum(1).tolist(), label.tolist(), strict=True), strict=True)), {}
    for g in got:
        found.setdefault(g["vec_id"], []).append(g)
    links = sum(found[i][0]["n_links"] for i in want)
    assert links >= 0.97 * sum(n for n, _ in want.values()) and all(found[i][0]["n_links"] <= want[i][0] for i in want)
    assert sum(found[i][0]["component_id"] == c for i, (_, c) in want.items()) >= 0.97 * len(want)
    assert all(g["kept"] == (g["vec_id"] == g["component_id"]) for g in got)
    assert all(found[i][0]["n_links"] == 0 and found[i][0]["component_id"] == i for i in (5000, 5001, 5002))
