"""Segments of the event store: filters, growing buckets, merges under a commit, retries."""

import glob

import pytest
from litmark.streaming import store as K
from litmark.streaming.events import EVENT_COLUMNS, EVENT_SCHEMA
from pyspark.sql import functions as F
from pyspark.sql import types as T


def events(spark, low, high, value=1.0):
    """Rows of the stored columns with keys k<low> to k<high - 1>."""
    kinds = {f.name: f.dataType for f in T._parse_datatype_string(EVENT_SCHEMA)}
    rows = spark.range(low, high).withColumn("event_id", F.concat(F.lit("k"), "id")).withColumn("taxa_alfabetizacao_atualizada", F.lit(value))
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in EVENT_COLUMNS])


def keys(frame):
    return sorted(r["event_id"] for r in frame.select("event_id").collect())


def history(spark, store, asked, batch=None):
    met, _ = K.met_buckets(spark, store, asked)
    return K.possible_history(spark, store, asked, met, batch)


def test_new_keys_open_hardly_any_stored_file(spark, tmp_path):
    store = K.EventStore(str(tmp_path), bucket_rows=500)
    K.add_batch(spark, store, events(spark, 0, 60_000), 60_000, "a")
    K.add_batch(spark, store, events(spark, 60_000, 62_000), 2_000, "b")
    files = len(K.stored_events(spark, store).inputFiles())
    assert files >= 130 and [s["level"] for s in K.segments(spark, store)] == [7, 2]
    none = history(spark, store, events(spark, 100_000, 110_000))
    assert none is None or len(none.inputFiles()) <= 3
    # Five stored keys among the new ones open their buckets, and only the key is read from them.
    some = history(spark, store, events(spark, 100_000, 110_000).unionAll(events(spark, 59_998, 60_003)))
    assert set(keys(events(spark, 59_998, 60_003))) <= set(keys(some)) and len(some.inputFiles()) <= 8
    plan = some._sc._jvm.PythonSQLUtils.explainString(some._jdf.queryExecution(), "formatted")
    assert "ReadSchema: struct<event_id:string>" in plan


def test_filters_are_read_in_the_buckets_of_the_keys_only(spark, tmp_path, monkeypatch):
    store = K.EventStore(str(tmp_path), bucket_rows=100)
    K.add_batch(spark, store, events(spark, 0, 10_000), 10_000, "a")
    listed = []
    real = K._folders
    monkeypatch.setattr(K, "_folders", lambda *a: listed.append(real(*a)) or listed[-1])
    found = history(spark, store, events(spark, 7, 10))
    assert len(listed[0]) <= 3 and set(keys(found)) >= {"k7", "k8", "k9"} and found.count() < 500


def test_merges_bound_the_files_and_leave_readers_alone(spark, tmp_path):
    store = K.EventStore(str(tmp_path), bucket_rows=1_000, fanout=3)
    reader, most = None, 0
    for k in range(30):
        asked = events(spark, 10 * k, 10 * k + 15)
        old = history(spark, store, asked)
        new = asked if old is None else asked.join(old, "event_id", "left_anti")
        assert K.add_batch(spark, store, new, 15, f"b{k}") == (15 if k == 0 else 10)
        if k == 1:
            reader = K.stored_events(spark, store)
        left = K.compact(spark, store)
        most = max(most, left)
        if k == 2:
            assert left == 1 and reader.count() == 25  # the folders that the merge replaced are still there
    stored = K.stored_events(spark, store)
    assert stored.count() == 305 == stored.select("event_id").distinct().count()
    assert stored.select("lote").distinct().count() == 30
    assert most <= 8 and len(stored.inputFiles()) <= 8
    valid = {s["id"] for s in K.segments(spark, store)}
    lying = {f.split("segmento=")[1].split("/")[0] for f in glob.glob(f"{store.accepted}/*/*/*.parquet")}
    assert valid <= lying and len(lying) <= len(valid) + 2 * 4 * K.GRACE


def test_buckets_grow_by_splitting(spark, tmp_path):
    store = K.EventStore(str(tmp_path), buckets=2, bucket_rows=50, fanout=2)
    for k in range(4):
        K.add_batch(spark, store, events(spark, 100 * k, 100 * k + 100), 100, f"b{k}")
        K.compact(spark, store)
    (segment,) = K.segments(spark, store)
    assert segment["level"] == 3 and segment["batch"] is None
    assert set(keys(history(spark, store, events(spark, 150, 160)))) >= set(keys(events(spark, 150, 160)))
    part = K.stored_events(spark, store, buckets=[1])
    assert 0 < part.count() < 400 and part.count() + K.stored_events(spark, store, buckets=[0]).count() == 400


def test_a_retry_replaces_a_batch_that_was_merged(spark, tmp_path):
    store = K.EventStore(str(tmp_path), fanout=2)
    for name, low in (("a", 0), ("b", 10)):
        K.add_batch(spark, store, events(spark, low, low + 10), 10, name)
        (tmp_path / "contadores" / f"lote={name}").mkdir(parents=True)
    K.compact(spark, store)
    assert [s["batch"] for s in K.segments(spark, store)] == [None]
    again = events(spark, 0, 4, 2.0)
    assert set(keys(again)) <= set(keys(history(spark, store, again)))
    old = history(spark, store, again, "a")
    new = again if old is None else again.join(old, "event_id", "left_anti")
    assert K.add_batch(spark, store, new, 4, "a") == 4
    assert keys(K.stored_events(spark, store)) == sorted(keys(again) + keys(events(spark, 10, 20)))
    K.add_batch(spark, store, events(spark, 30, 40), 10, "c")
    K.compact(spark, store)
    assert keys(K.stored_events(spark, store)) == sorted(keys(again) + keys(events(spark, 10, 20)) + keys(events(spark, 30, 40)))
    K.add_batch(spark, store, None, 0, "b")
    assert keys(K.stored_events(spark, store)) == sorted(keys(again) + keys(events(spark, 30, 40)))


class Killed(BaseException):
    pass


def test_a_batch_or_a_merge_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    def killed(*_):
        raise Killed

    store = K.EventStore(str(tmp_path), fanout=2)
    K.add_batch(spark, store, events(spark, 0, 10), 10, "a")
    with monkeypatch.context() as m:
        m.setattr(K, "commit", killed)
        with pytest.raises(Killed):
            K.add_batch(spark, store, events(spark, 10, 20), 10, "b")
        assert keys(K.stored_events(spark, store)) == keys(events(spark, 0, 10))
    K.add_batch(spark, store, events(spark, 10, 20), 10, "b")
    with monkeypatch.context() as m:
        m.setattr(K, "commit", killed)
        with pytest.raises(Killed):
            K.compact(spark, store)
        assert len(K.segments(spark, store)) == 2 and K.stored_events(spark, store).count() == 20
    assert K.compact(spark, store) == 1 and K.stored_events(spark, store).count() == 20


def test_prints_of_other_keys_are_compared_exactly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "_print", lambda hashed: F.lit(7))
    store = K.EventStore(str(tmp_path))
    K.add_batch(spark, store, events(spark, 0, 10), 10, "a")
    found = history(spark, store, events(spark, 8, 14))
    assert keys(events(spark, 8, 14).join(found, "event_id", "left_anti")) == ["k10", "k11", "k12", "k13"]
