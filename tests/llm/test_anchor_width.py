"""Windows choose their anchors alike in groups of unequal size, near-ties of hashes included."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lociframe.llm import arrays as A
from lociframe.llm import substring_dedup, suffix_dedup


def coarse(monkeypatch):
    """Hashes with few distinct leading bits, so that nearly every window has near-ties."""
    span, gram = A.span_hash, A.gram_hash
    fold = lambda h: (h & A.U64(0x3)) << A.U64(62) | (h & A.U64((1 << 40) - 1))
    monkeypatch.setattr(A, "span_hash", lambda *a: fold(span(*a)))
    monkeypatch.setattr(A, "gram_hash", lambda *a: fold(gram(*a)))


def table(texts):
    return pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})


@pytest.mark.parametrize("more", [0, 30])
def test_bytes(monkeypatch, more):
    r = random.Random(more)
    shared = "".join(r.choice("abcd") for _ in range(600))
    coarse(monkeypatch)
    small = suffix_dedup.Group(table([shared]), 200, 32)
    large = suffix_dedup.Group(table([shared, *("".join(r.choice("abcd") for _ in range(200_000)) for _ in range(more))]), 200, 32)
    mine = [(a, b) for a, b in zip(large.at.tolist(), large.begin.tolist(), strict=True) if b + 200 <= 600]
    assert mine == [(a, b) for a, b in zip(small.at.tolist(), small.begin.tolist(), strict=True) if b + 200 <= 600] and mine


def test_words(monkeypatch):
    coarse(monkeypatch)
    r = random.Random(2)
    shared = " ".join(r.choice("abcdefgh") for _ in range(300))
    rest = [" ".join(r.choice("abcdefgh") for _ in range(300_000)) for _ in range(5)]
    places = []
    for texts in ([shared], [shared, *rest]):
        some = substring_dedup.Group(table(texts), 13)
        _, at = some.anchors(4)
        places.append(at[some.starts <= 300 - 13][: 300 - 12])
    assert np.array_equal(*places)
