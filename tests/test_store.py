"""The store that a stream corrects: replaced rows, batches that run twice, writes that die before their commit."""

import pytest

from lociframe.streaming import incremental
from lociframe.streaming.store import Store, one_each, reuse

SCHEMA = "sample_id string, ok boolean, n int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def held(store):
    return sorted(tuple(x) for x in store.read().collect())


def test_an_invalid_row_is_replaced_and_batches_count_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), SCHEMA)
    assert held(store) == []
    assert reuse(rows(spark, ("a", True, 1), ("b", False, 2), (None, True, 0)), 0, store, "ok")
    assert reuse(rows(spark, ("a", True, 9), ("b", True, 3)), 1, store, "ok")
    assert held(store) == [("a", True, 1), ("b", True, 3)]
    assert not reuse(rows(spark, ("c", True, 5)), 1, store, "ok")  # the same batch again
    assert held(store) == [("a", True, 1), ("b", True, 3)]
    assert reuse(rows(spark, ("b", False, 7), ("d", True, 1), ("d", True, 0)), 2, store, "ok")
    assert held(store) == [("a", True, 1), ("b", True, 3), ("d", True, 0)]


def test_a_write_that_dies_is_not_read(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), SCHEMA)
    reuse(rows(spark, ("a", True, 1)), 0, store)
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError, match="gone"):
            reuse(rows(spark, ("b", True, 2)), 1, store)
    assert held(store) == [("a", True, 1)] and len(list((tmp_path / "store" / "data").iterdir())) == 2
    assert reuse(rows(spark, ("b", True, 3)), 1, store)  # the batch runs again
    assert held(store) == [("a", True, 1), ("b", True, 3)]
    store.sweep()
    assert len(list((tmp_path / "store" / "data").iterdir())) == 2 and held(store) == [("a", True, 1), ("b", True, 3)]


def test_compaction_keeps_rows_and_numbers(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), SCHEMA)
    for number in range(4):
        store.write(rows(spark, ("a", True, number), (f"s{number}", True, number)), number)
    want = held(store)
    assert ("a", True, 3) in want and len(want) == 5
    store.compact()
    assert held(store) == want and list(store.commits()) == [3] and len(list((tmp_path / "store" / "data").iterdir())) == 1
    assert not store.write(rows(spark, ("a", True, 99)), 2) and not store.write(rows(spark, ("a", True, 99)), 3)
    assert store.write(rows(spark, ("a", True, 4)), 4) and ("a", True, 4) in held(store)


def test_a_stream_that_fails_half_way_and_goes_on(spark, tmp_path, monkeypatch):
    rows(spark, ("a", True, 1), ("b", False, 1)).coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: incremental.incremental_reuse(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "c"), valid="ok").awaitTermination(90)
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(Exception, match="gone"):
            run()
    store = Store(spark, str(tmp_path / "store"), SCHEMA)
    assert held(store) == []
    run()
    assert held(store) == [("a", True, 1), ("b", False, 1)]
    rows(spark, ("a", True, 5), ("b", True, 2)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert held(store) == [("a", True, 1), ("b", True, 2)]


def test_one_row_for_each_key_is_the_same_in_any_run(spark):
    df = rows(spark, ("a", True, 3), ("a", True, 2), ("a", None, 9), ("b", True, 1))
    first = sorted(map(tuple, one_each(df.repartition(3), "sample_id").collect()))
    assert first == sorted(map(tuple, one_each(df.coalesce(1), "sample_id").collect())) and len(first) == 2
