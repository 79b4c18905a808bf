"""Links that say the same are few before the rounds of connected components begin."""

import numpy as np
import pyarrow as pa

from lociframe.llm.frames import components, spanning


def test_a_partition_keeps_a_forest_of_its_links():
    r = np.random.default_rng(5)
    own = np.repeat([0, 1000, 5000], 20_000)
    a, b = own + r.integers(0, 900, len(own)), own + r.integers(0, 900, len(own))
    batches = [pa.RecordBatch.from_arrays([pa.array(a[s : s + 7000]), pa.array(b[s : s + 7000])], names=["a", "b"]) for s in range(0, len(a), 7000)]
    out = pa.Table.from_batches(list(spanning(iter(batches))))
    assert out.num_rows == 3 * 899 and set(out.column("b").to_pylist()) == {0, 1000, 5000}
    assert pa.Table.from_batches(list(spanning(iter([])))).num_rows == 0


def test_components_are_those_of_all_links(spark):
    n = 300
    rows = [(i, j) for i in range(n) for j in range(i + 1, n, 7)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long"), rows_per_file=500).collect()}
    assert found == {i: 0 for i in range(1, n)} | {1001 + i: 1000 for i in range(40)}
