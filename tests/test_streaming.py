import json

import pytest
from litmark import fixed_values as V
from litmark.streaming import consumer as K
from litmark.streaming import events as E
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F


def event(key, new=41.0, old=40.0, **changes):
    payload = {
        "ano": 2024,
        "id_municipio": "3500001",
        "id_uf": "35",
        "codigo_rede": 3,
        "rede": "Municipal",
        "taxa_alfabetizacao_anterior": old,
        "taxa_alfabetizacao_atualizada": new,
        "variacao_pp": round(new - old, 2),
    }
    payload.update({k: v for k, v in changes.items() if k in payload})
    record = {
        "event_id": key,
        "event_type": V.EVENT_TYPE,
        "event_timestamp_utc": "2026-07-12T10:00:00+00:00",
        "schema_version": "1.0",
        "source": "teste",
        "payload": payload,
    }
    record.update({k: v for k, v in changes.items() if k not in payload})
    return record


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / name).write_text("\n".join(text) + "\n", encoding="utf-8")


def errors(spark, *lines):
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "n int, value string")
    return [r["erro"] for r in E.parse_events(df).orderBy("n").collect()]


def test_valid_variants(spark):
    assert errors(
        spark,
        event("a"),
        event(12),
        event("a", ano="2024", codigo_rede=3.9),
        event("a", taxa_alfabetizacao_anterior="40.0"),
        event("a", event_timestamp_utc="2026-07-12"),
        event("a", variacao_pp=1.005),
    ) == [None] * 6


def test_first_broken_rule_is_reported(spark):
    absent, empty = V.EVENT_FIELD_ABSENT.format, V.EVENT_FIELD_EMPTY.format
    without = event("a")
    del without["source"]
    cases = [
        ("{bad", V.EVENT_NOT_OBJECT),
        ("[1]", V.EVENT_NOT_OBJECT),
        ("3", V.EVENT_NOT_OBJECT),
        (json.dumps(event("a")) + " x", V.EVENT_NOT_OBJECT),
        (json.dumps(event("a")) + ", {}", V.EVENT_NOT_OBJECT),
        (event(None), absent(field="event_id")),
        (event("  "), empty(field="event_id")),
        (event("a", event_type="outro", schema_version="9"), V.EVENT_WRONG_TYPE + "outro."),
        (event("a", schema_version="2.0"), V.EVENT_WRONG_VERSION + "2.0."),
        (event("a", event_timestamp_utc="12/07/2026"), V.EVENT_BAD_TIMESTAMP),
        (event("a", payload="x"), V.EVENT_BAD_PAYLOAD),
        (event("a", payload=None), V.EVENT_BAD_PAYLOAD),
        (event("a", ano="2023.9"), V.EVENT_BAD_INTEGERS),
        (event("a", codigo_rede=None), V.EVENT_BAD_INTEGERS),
        (event("a", ano=2022), V.EVENT_BAD_YEAR + "2022."),
        (event("a", codigo_rede=7), V.EVENT_BAD_NETWORK + "7."),
        (event("a", id_uf="11"), V.EVENT_BAD_PREFIX),
        (event("a", rede=" "), empty(field="rede")),
        (event("a", taxa_alfabetizacao_anterior="x"), V.EVENT_NOT_NUMERIC.format(field="taxa_alfabetizacao_anterior")),
        (event("a", new=100.5), V.EVENT_OUT_OF_RANGE.format(field="taxa_alfabetizacao_atualizada")),
        (event("a", variacao_pp=None), V.EVENT_BAD_VARIATION),
        (event("a", variacao_pp=1.5), V.EVENT_WRONG_VARIATION),
        (without, absent(field="source")),
    ]
    assert errors(spark, *[c[0] for c in cases]) == [c[1] for c in cases]


def test_filters_stay_above_the_parser(spark):
    df = spark.createDataFrame([(json.dumps(event("a")),)], "value string")
    parsed = E.parse_events(df.select("value", F.lit("f").alias("arquivo_origem"), F.lit(1).alias("numero_linha_origem")))
    valid = E.valid_events(parsed)
    text = valid._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("try_variant_get") == 1
    assert valid.columns == E.EVENT_COLUMNS


def test_encoded_events_are_valid(spark):
    base = spark.createDataFrame(
        [(2024, "3500001", "35", 3, "Municipal", 99.5), (2023, "3500002", "35", 0, "Total", 1.0), (2023, "x", "y", 1, "z", None)],
        "ano int, id_municipio string, id_uf string, codigo_rede int, rede string, taxa_alfabetizacao double",
    )
    events = E.encode_events(E.event_base(base), F.lit(1.234))
    parsed = E.parse_events(E.to_lines(events)).collect()
    assert len(parsed) == 2 and all(r["erro"] is None for r in parsed)
    assert sorted(r["taxa_alfabetizacao_atualizada"] for r in parsed) == [2.23, 100.0]
    assert sorted(r["variacao_pp"] for r in parsed) == [0.5, 1.23]


def stored(spark, store):
    return {r["event_id"]: r["taxa_alfabetizacao_atualizada"] for r in K.stored_events(spark, store).collect()}


def test_last_wins_in_a_batch_first_wins_across_batches(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    write(source, "eventos_1.jsonl", event("a", 41.0), "", event("b", 42.0), event("a", 43.0), "{bad")
    first = K.replay_all(spark, str(source), store, "1", "*.jsonl")
    assert first == {"validos": 3, "invalidos": 1, "duplicados_no_lote": 1, "ja_processados": 0, "novos": 2}
    assert stored(spark, store) == {"a": 43.0, "b": 42.0}
    write(source, "eventos_2.jsonl", event("a", 50.0), event("c", 44.0))
    second = K.replay_all(spark, str(source), store, "2", "*.jsonl")
    assert second == {"validos": 5, "invalidos": 1, "duplicados_no_lote": 2, "ja_processados": 2, "novos": 1}
    assert stored(spark, store) == {"a": 43.0, "b": 42.0, "c": 44.0}
    rejected = spark.read.parquet(store.rejected).first()
    assert rejected["mensagem"] == f"eventos_1.jsonl, linha 5: {V.EVENT_NOT_OBJECT}"
    lines = {r["event_id"]: r["numero_linha_origem"] for r in K.stored_events(spark, store).collect()}
    assert lines == {"a": 4, "b": 3, "c": 2}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    write(source, "e.jsonl", event("a"), event("b"))
    for _ in range(2):
        assert K.replay_all(spark, str(source), store, "1")["novos"] == 2
    assert K.stored_events(spark, store).count() == 2


def test_batches_of_any_name_store_a_key_once(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    write(source, "e.jsonl", *[event(f"k{i}") for i in range(40)])
    for name in ("01", "1", "2026-01-01", "nightly-2"):
        made = K.replay_all(spark, str(source), store, name)
        assert made["novos"] == (40 if name == "01" else 0)
    K.start_stream(spark, str(source), store, str(tmp_path / "check")).awaitTermination()
    assert K.replay_all(spark, str(source), store, "01")["novos"] == 40
    found = K.stored_events(spark, store)
    assert found.count() == 40 and {r["lote"] for r in found.select("lote").collect()} == {"01"}


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"), buckets=64)
    write(source, "e.jsonl", *[event(f"k{i}") for i in range(200)])
    K.replay_all(spark, str(source), store, "1")
    assert K.stored_events(spark, store).count() == 200
    some = K.stored_events(spark, store, buckets=[3])
    assert 0 < some.count() < 20
    assert all("/balde=3/" in f for f in some.inputFiles())


def test_a_retry_with_fewer_events_replaces_all_of_the_batch(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    write(source, "e.jsonl", *[event(f"k{i}") for i in range(50)])
    K.replay_all(spark, str(source), store, "1")
    write(source, "e.jsonl", event("k7"))
    assert K.replay_all(spark, str(source), store, "1")["novos"] == 1
    assert sorted(stored(spark, store)) == ["k7"]


def test_fail_fast_stores_nothing(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    write(source, "e.jsonl", event("a"), "{bad")
    with pytest.raises(K.InvalidEventsError):
        K.replay_all(spark, str(source), store, "1", fail_fast=True)
    assert K.stored_events(spark, store) is None
    query = K.start_stream(spark, str(source), store, str(tmp_path / "check"), fail_fast=True)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert K.stored_events(spark, store) is None


def test_stream_equals_batch(spark, tmp_path):
    source, store = tmp_path / "in", K.EventStore(str(tmp_path / "out"))
    seen = []
    write(source, "e1.jsonl", event("a", 41.0), event("a", 42.0), event("b", 43.0))
    for name in ("e1.jsonl", "e2.jsonl", "none"):
        if name == "e2.jsonl":
            write(source, name, event("a", 50.0), "", event("c", 44.0), "{bad")
        query = K.start_stream(spark, str(source), store, str(tmp_path / "check"), after_batch=seen.append)
        query.awaitTermination()
    assert stored(spark, store) == {"a": 42.0, "b": 43.0, "c": 44.0}
    assert [s["novos"] for s in seen] == [2, 1]
    assert spark.read.parquet(store.rejected).first()["numero_linha_origem"] == 4
    assert spark.read.parquet(store.counters).agg(F.sum("validos")).first()[0] == 5


@pytest.mark.parametrize("limit", [{"files_per_batch": 1}, {"bytes_per_batch": "1"}])
def test_bounded_batches(spark, tmp_path, limit):
    source, store, seen = tmp_path / "in", K.EventStore(str(tmp_path / "out")), []
    for i in range(3):
        write(source, f"e{i}.jsonl", event("a", 41.0 + i), event(f"k{i}"))
    query = K.start_stream(spark, str(source), store, str(tmp_path / "check"), after_batch=seen.append, **limit)
    query.awaitTermination()
    assert sorted(stored(spark, store)) == ["a", "k0", "k1", "k2"]
    assert [s["novos"] for s in seen] == [2, 1, 1]


def test_one_event_key_with_a_third_of_all_rows(spark):
    n = 30_000
    df = spark.range(n).select(
        F.lit("f").alias("arquivo_origem"),
        F.col("id").alias("numero_linha_origem"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
    )
    last = K.keep_last(df)
    assert last.where("event_id = 'hot'").first()["numero_linha_origem"] == n - 3
    assert last.count() == n - n // 3 + 1


def test_counters_and_merged_batches_parse_once(spark):
    lines = [event("a", 41.0), event("a", 42.0), event("b", 43.0), "{bad", event("a", 50.0), event("c", 44.0), "{bad", event("c", 45.0)]
    text = [(i, i < 4, x if isinstance(x, str) else json.dumps(x)) for i, x in enumerate(lines)]
    df = spark.createDataFrame(text, "numero_linha_origem long, primeiro boolean, value string").withColumn("arquivo_origem", F.lit("f"))
    parsed = E.parse_events(df)
    merged = K.merge_batches(E.valid_events(parsed, "primeiro"), F.col("primeiro"))
    assert {r["event_id"]: r["taxa_alfabetizacao_atualizada"] for r in merged.collect()} == {"a": 42.0, "b": 43.0, "c": 45.0}
    counted = K.counters(parsed, F.col("primeiro"))
    assert counted.first().asDict() == {"validos": 6, "invalidos": 2, "duplicados_no_lote": 3, "ja_processados": 2, "novos": 1}
    none = K.counters(parsed.where("false"), F.col("primeiro")).first().asDict()
    assert set(none.values()) == {0}
    for frame in (merged, counted):
        assert frame._jdf.queryExecution().executedPlan().toString().count("try_parse_json") <= 1


def test_a_base_without_valid_rows_is_an_error(spark):
    schema = "ano int, id_municipio string, id_uf string, codigo_rede int, rede string, taxa_alfabetizacao double"
    with pytest.raises(ValueError, match="no valid rows"):
        E.event_base(spark.createDataFrame([(2023, "x", "y", 1, "z", None)], schema))


def test_each_field_is_stripped_once_and_the_fence_can_be_left_out(spark):
    lines = spark.createDataFrame([json.dumps(event(" a ")), " ", "\u00a0", "x"], "string")
    parsed = E.parse_events(lines, keep_blank=True, fenced=False)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert plan.count("trim(") == 9  # eight text fields and the line itself
    fenced = E.parse_events(lines, keep_blank=True)
    assert [tuple(r) for r in parsed.collect()] == [tuple(r) for r in fenced.collect()]
    assert [r.em_branco for r in parsed.collect()] == [False, True, True, False]
