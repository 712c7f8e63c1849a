import os

import pytest
from litmark import fixed_values as V
from litmark.operators.costs import usage
from litmark.operators.runs import layer_metrics
from litmark.plans import medallion as M
from litmark.sources import catalog, lines, sinks
from litmark.sources import snapshots as S
from litmark.sources.lines import job_history
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from workload import sources as queries_of_sources
from workload.registry import QUERIES


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_snapshot_is_the_greatest_date(spark, tmp_path):
    path = str(tmp_path / "t")
    for date, value in [("2026-01-10", 1), ("2026-02-01", 2), ("2025-12-31", 3)]:
        assert S.write_snapshot(spark.createDataFrame([(value,)], "v int"), path, date) == 1
    assert S.latest_snapshot(spark, path, S.BRONZE_DATE) == "2026-02-01"
    newest = S.read_latest(spark, path)
    assert rows(newest) == [(2,)] and newest.columns == ["v"]


def test_missing_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    with pytest.raises(FileNotFoundError):
        S.read_latest(spark, path)


def test_yearly_rerun_replaces_and_leaves_no_stale_files(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(1000).select((F.col("id") % 2 + 2023).cast("int").alias("ano"), F.col("id").alias("v"))
    assert S.write_yearly_snapshot(big, path, "2026-01-01", rows_per_file=100) == 1000
    assert S.write_yearly_snapshot(big.where("ano = 2024").limit(3), path, "2026-01-01", rows_per_file=100) == 3
    counts = {r["ano"]: r["count"] for r in S.read_latest_per(spark, path).groupBy("ano").count().collect()}
    assert counts == {2023: 500, 2024: 3}
    only = S.read_latest_per(spark, path, only=["2024"])
    assert only.count() == 3 and "data_ingestao" not in only.columns


def test_years_with_different_columns_are_united_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_yearly_snapshot(spark.createDataFrame([(2023, 1)], "ano int, a int"), path, "2026-01-01")
    S.write_yearly_snapshot(spark.createDataFrame([(2024, "x")], "ano int, b string"), path, "2026-01-02")
    got = {(r["ano"], r["a"], r["b"]) for r in S.read_latest_per(spark, path).collect()}
    assert got == {(2023, 1, None), (2024, None, "x")}


def test_shuffles_grow_with_the_input(spark, tmp_path, monkeypatch):
    from litmark import session

    path = str(tmp_path / "t")
    spark.range(20_000).write.parquet(path)
    with session.sized_shuffles(spark, path) as number:
        assert number == 8
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 1000)
    with session.sized_shuffles(spark, path) as number:
        assert number > 8 and spark.conf.get(session.SHUFFLE_SETTING) == str(number)
    assert spark.conf.get(session.SHUFFLE_SETTING, None) is None


def test_year_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(2023, 1), (2024, 2)], "ano int, v int").write.parquet(path)
    df = S.extract_year(S.extract(spark, path), 2024)
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(ano,2024)" in text
    assert rows(df) == [(2024, 2)]


def test_line_numbers_match_a_plain_reading(spark, tmp_path):
    """Small splits, several files, blank lines: numbers equal those of reading each file from its start."""
    expected = []
    for name, count in [("a.jsonl", 700), ("b.jsonl", 1), ("c.jsonl", 333)]:
        content = [f"{name}-{i} " + "x" * (i % 40) if i % 7 else "" for i in range(1, count + 1)]
        (tmp_path / name).write_text("\n".join(content) + "\n", encoding="utf-8")
        expected += [(name, i, line) for i, line in enumerate(content, start=1) if line]
    (tmp_path / "ignored.txt").write_text("no\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        numbered = lines.read_numbered_lines(spark, str(tmp_path), "*.jsonl")
        got = rows(numbered.select("arquivo_origem", "numero_linha_origem", "value"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(expected)


def test_strict_json_refuses_bad_lines_and_unknown_fields(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, p struct<b: string>").schema
    (tmp_path / "ok.json").write_text('{"a": 1, "p": {"b": "x"}}\n\n{"a": null}\n')
    assert rows(lines.read_strict_json(spark, str(tmp_path / "ok.json"), schema).select("a").na.fill(0)) == [(0,), (1,)]
    for name, bad in [("1", '{"a": 1, "z": 2}'), ("2", '{"a": 1, "p": {"c": 2}}'), ("3", '{"a": '), ("4", '{"a": "x"}')]:
        (tmp_path / f"{name}.json").write_text(bad + "\n")
        with pytest.raises((PySparkException, Py4JJavaError)):
            lines.read_strict_json(spark, str(tmp_path / f"{name}.json"), schema).collect()


def test_row_counts_by_file_type(spark, tmp_path):
    root = str(tmp_path)
    spark.range(10).write.parquet(f"{root}/p")
    (tmp_path / "e.jsonl").write_text('{"a":1}\n\n{"a":2}\n')
    (tmp_path / "r.csv").write_text("h\n1\n2\n3\n")
    (tmp_path / "broken.parquet").write_text("this is not parquet")
    counted = lines.count_rows_by_file(spark, root).agg(F.sum("registros")).first()[0]
    assert counted == 10 + 2 + 3


def test_optional_source(spark, tmp_path):
    assert not lines.has_files(spark, str(tmp_path / "none"))
    assert not lines.has_files(spark, str(tmp_path), "*.jsonl")
    (tmp_path / "e.jsonl").write_text("{}\n")
    assert lines.has_files(spark, str(tmp_path), "*.jsonl")


EVENT_LOG = """{"Event":"SparkListenerLogStart","Spark Version":"4.1.2"}
{"Event":"SparkListenerJobStart","Job ID":0,"Submission Time":1704067200000,"Stage IDs":[0,1]}
{"Event":"SparkListenerTaskEnd","Stage ID":0,"Task Metrics":{"Input Metrics":{"Bytes Read":100}}}
{"Event":"SparkListenerTaskEnd","Stage ID":1,"Task Metrics":{"Input Metrics":{"Bytes Read":20}}}
{"Event":"SparkListenerJobEnd","Job ID":0,"Job Result":{"Result":"JobSucceeded"}}
{"Event":"SparkListenerJobStart","Job ID":1,"Submission Time":1704067201000,"Stage IDs":[2]}
{"Event":"SparkListenerTaskEnd","Stage ID":2,"Task Metrics":{"Input Metrics":{"Bytes Read":7}}}
{"Event":"SparkListenerJobEnd","Job ID":1,"Job Result":{"Result":"JobFailed"}}
{"Event":"SparkListenerJobStart","Job ID":2,"Submission Time":1704067202000,"Stage IDs":[3]}
"""


def test_job_history_from_event_logs(spark, tmp_path):
    (tmp_path / "app-1").write_text(EVENT_LOG)
    (tmp_path / "app-2").write_text(EVENT_LOG)
    jobs = job_history(spark, str(tmp_path))
    got = rows(jobs.select("state", "error_result", "total_bytes_processed").na.fill("-"))
    assert got == [("DONE", "-", 120)] * 2 + [("DONE", "JobFailed", 7)] * 2 + [("RUNNING", "-", 0)] * 2
    row = usage(jobs, F.timestamp_micros(F.lit(1704067300000000))).first()
    assert (row["quantidade_queries"], row["bytes_processados"]) == (2, 240)


def test_event_files_are_optional(spark, tmp_path):
    schema = spark.createDataFrame([], "a int").schema
    source = str(tmp_path / "in")
    assert not M.load_json_files(spark, source, schema, "none", "default.event_files")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    spark.sql(f"CREATE DATABASE event_test LOCATION '{tmp_path}/db'")
    assert M.load_json_files(spark, source, schema, "*.jsonl", "event_test.t")
    assert rows(spark.table("event_test.t")) == [(1,), (2,)]
    spark.sql("DROP DATABASE event_test CASCADE")


def test_json_lines_keep_nulls_and_accents(spark, tmp_path):
    sinks.write_json_lines(spark.createDataFrame([("ção", None)], "a string, b int"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":"ção","b":null}'


BOOM = "IF(id = 400, raise_error('boom'), id) AS id"


def test_a_failed_snapshot_leaves_the_one_before(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_snapshot(spark.range(10), path, "2026-01-01")
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.write_snapshot(spark.range(500).selectExpr(BOOM), path, "2026-01-01")
    with pytest.raises((PySparkException, Py4JJavaError)):
        S.write_snapshot(spark.range(500).selectExpr(BOOM), path, "2026-01-02")
    (tmp_path / "t" / "data_ingestao=2026-01-03").mkdir()
    assert S.latest_snapshot(spark, path, S.BRONZE_DATE) == "2026-01-01"
    assert S.read_latest(spark, path).count() == 10


def test_a_failed_load_leaves_the_table_before(spark, tmp_path):
    spark.sql(f"CREATE DATABASE reload_test LOCATION '{tmp_path}/db'")
    catalog.load_table(spark.range(10), "reload_test.T1")
    with pytest.raises((PySparkException, Py4JJavaError)):
        catalog.load_table(spark.range(500).selectExpr(BOOM), "reload_test.T1", ["id"])
    assert spark.table("reload_test.t1").count() == 10
    assert catalog.load_table(spark.range(20), "reload_test.T1", ["id"]) == 20
    assert [r["tableName"] for r in catalog.tables_of(spark, "reload_test").collect()] == ["t1"]
    yearly = spark.range(30).withColumn("ano", (F.col("id") % 3).cast("int"))
    for rows_left in (yearly, yearly.where("ano < 2")):
        catalog.load_table(rows_left, "reload_test.por_ano", partitioning=["ano"])
    with pytest.raises((PySparkException, Py4JJavaError)):
        catalog.load_table(yearly.withColumn("id", F.raise_error(F.lit("boom")).cast("long")), "reload_test.por_ano", partitioning=["ano"])
    assert spark.table("reload_test.por_ano").where("ano = 1").count() == 10 and spark.table("reload_test.por_ano").count() == 20
    situation = catalog.expected_objects(spark, ["T1", "t2"], catalog.tables_of(spark, "reload_test"), "tableName")
    assert rows(situation) == [("T1", "OK"), ("t2", "NÃO ENCONTRADA")]
    spark.sql("DROP DATABASE reload_test CASCADE")


def test_strict_json_looks_into_arrays(spark, tmp_path):
    schema = spark.createDataFrame([], "a array<struct<x: int>>, b array<int>").schema
    (tmp_path / "ok.json").write_text('{"a": [{"x": 1}, {"x": 2}], "b": [1]}\n{"a": null}\n{"a": []}\n')
    assert lines.read_strict_json(spark, str(tmp_path / "ok.json"), schema).count() == 3
    (tmp_path / "bad.json").write_text('{"a": [{"x": 1}, {"x": 1, "extra": 2}]}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        lines.read_strict_json(spark, str(tmp_path / "bad.json"), schema).collect()


def test_counts_of_loads_fail_on_broken_files(spark, tmp_path):
    (tmp_path / "broken.parquet").write_text("this is not parquet")
    with pytest.raises((PySparkException, Py4JJavaError)):
        lines.count_parquet_rows(spark, str(tmp_path)).collect()


def test_reconcile():
    sinks.reconcile("t", 3, 3)
    with pytest.raises(sinks.ReconciliationError):
        sinks.reconcile("t", 3, 2)


def test_clustered_load_spreads_a_frequent_value(spark, tmp_path):
    database = "cluster_test"
    catalog.create_database(spark, database, "it's a test", {"camada": "gold"}, str(tmp_path / "db"))
    catalog.create_database(spark, database, "again")
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("id_uf"), F.lit(1).alias("codigo_rede")
    )
    spread = catalog.cluster(df, V.GOLD_CLUSTERING)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 30_000 and max(sizes) < 10_000
    assert catalog.load_table(df, f"{database}.t", V.GOLD_CLUSTERING, description="Tabela d'água") == 30_000
    properties = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.t").collect()}
    assert properties["clustering"] == "id_uf, codigo_rede"
    assert spark.catalog.getTable(f"{database}.t").description == "Tabela d'água"
    situation = catalog.expected_objects(spark, ["t", "u"], catalog.tables_of(spark, database), "tableName")
    assert rows(situation) == [("t", "OK"), ("u", "NÃO ENCONTRADA")]
    assert catalog.retention_days(spark, database) is None
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_all_layers(spark, tmp_path):
    layers = M.Layers(str(tmp_path))
    proportions = ", ".join(f"1.0D AS proporcao_aluno_nivel_{n}" for n in range(9))
    results = spark.sql(f"""SELECT ano, id AS `Id Municipio`, '2' AS serie, '3' AS rede, '50.5' AS taxa_alfabetizacao,
      700.0D AS media_portugues, {proportions} FROM VALUES (2023, ' 3500001 '), (2024, '3500001'), (2024, '3500001') t(ano, id)""")
    wide = spark.sql("SELECT 2023 AS ano, '3500001' AS id_municipio, 'municipal' AS rede, 40.0D AS meta_alfabetizacao_2024")
    students = spark.sql("""SELECT ano, '3500001' AS id_municipio, id AS id_aluno, '1' AS presenca
      FROM VALUES (2023, 'a'), (2024, 'b'), (2024, 'b '), (2022, 'c') t(ano, id)""")
    for table in V.REFERENCE_TABLES:
        source = {V.SILVER_RESULTS: results, V.SILVER_TARGETS: wide}.get(table, wide.select("ano"))
        M.ingest_table(source, layers, table, "2026-01-01")
    assert M.ingest_students(students, layers, [2023, 2024], "2026-01-01") == 3
    counts = {t: M.refine_table(spark, layers, t, "2026-01-02") for t in V.REFERENCE_TABLES}
    assert counts[V.SILVER_RESULTS] == {"recebidas": 3, "duplicadas": 1, "salvas": 2}
    assert M.refine_students(spark, layers, "2026-01-02") == {"recebidas": 3, "duplicadas": 1, "salvas": 2}
    assert M.build_gold(spark, layers, "2026-01-03") == {
        V.GOLD_INDICATOR: 2,
        V.GOLD_TARGETS: 1,
        V.GOLD_COMPARISON: 1,
        V.GOLD_EVOLUTION: 1,
    }
    report = M.check_silver(spark, layers, {2023: 1, 2024: 1})
    failed = {(r["tabela"], r["verificacao"]) for r in report.where("status <> 'APROVADO'").collect()}
    assert report.count() == 21
    assert failed == {("municipio", "Reconciliação Bronze x Silver"), ("alunos", "Reconciliação Bronze x Silver")}
    assert M.check_gold(spark, layers).where("status = 'REPROVADO'").count() == 0
    assert os.path.isdir(f"{layers.gold(V.GOLD_INDICATOR)}/data_processamento=2026-01-03")


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("tasks", [100_000, 1])
def test_lines_are_numbered_without_a_shuffle(spark, tmp_path, monkeypatch, tasks):
    monkeypatch.setattr(lines, "LOOKED_UP_TASKS", tasks)
    for name, count in [("a.txt", 900), ("b.txt", 1), ("c.txt", 400), ("d.txt", 0)]:
        (tmp_path / name).write_text("".join(f"{name} {i}{' pad' * (i % 9)}\n" for i in range(1, count + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = lines.read_numbered_lines(spark, str(tmp_path))
        found = numbered.select("arquivo_origem", F.split("value", " ")[1].cast("long").alias("n"), "numero_linha_origem").collect()
        above = _plan(numbered).split("Subquery")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 1301 and all(r["n"] == r["numero_linha_origem"] for r in found)
    if tasks > 1:
        assert "Exchange" not in above and "Join" not in above


def test_a_broken_file_counts_nothing_and_the_others_in_full(spark, tmp_path):
    import gzip

    for k in range(5):
        (tmp_path / f"ok{k}.jsonl").write_text('{"a":1}\n' * (k + 1))
        spark.range(k + 1).coalesce(1).write.parquet(str(tmp_path / f"p{k}"))
    packed = gzip.compress(b'{"a":1}\n' * 200_000)
    (tmp_path / "cut.jsonl.gz").write_bytes(packed[: len(packed) // 2])
    (tmp_path / "whole [1].json.gz").write_bytes(gzip.compress(b'{"a":1}\n' * 7))
    (tmp_path / "latin.jsonl").write_bytes(b'{"a":1}\n{"a":"\xe9"}\n')
    (tmp_path / "broken.parquet").write_text("this is not parquet")
    (tmp_path / "r.csv").write_bytes(b"h\n\xe9\n2\n")
    found = {r["arquivo"].rpartition("/")[2]: r["registros"] for r in lines.count_rows_by_file(spark, str(tmp_path)).collect()}
    assert {k: v for k, v in found.items() if k.startswith("ok")} == {f"ok{k}.jsonl": k + 1 for k in range(5)}
    assert found["cut.jsonl.gz"] == found["latin.jsonl"] == found["broken.parquet"] == 0
    assert [v for k, v in found.items() if k.startswith("whole")] == [7] and found["r.csv"] == 2
    assert sum(v for k, v in found.items() if k.startswith("part-")) == 15
    assert lines.count_rows_by_file(spark, str(tmp_path / "p0")).count() == 1


def test_a_broken_file_is_told_from_an_empty_one_and_other_failures_fail(spark, tmp_path, monkeypatch):
    (tmp_path / "gold").mkdir()
    (tmp_path / "gold" / "ok.jsonl").write_text('{"a":1}\n' * 3)
    (tmp_path / "gold" / "empty.jsonl").write_text("\n")
    (tmp_path / "gold" / "latin.jsonl").write_bytes(b'{"a":"\xe9"}\n')
    (tmp_path / "gold" / "broken.parquet").write_text("this is not parquet")
    found = {r["arquivo"].rpartition("/")[2]: (r["registros"], r["erro"]) for r in lines.count_rows_by_file(spark, str(tmp_path)).collect()}
    assert found["ok.jsonl"] == (3, None) and found["empty.jsonl"] == (0, None) and found["latin.jsonl"] == (0, "not UTF-8")
    assert found["broken.parquet"][0] == 0 and "is not a Parquet file" in found["broken.parquet"][1]
    gold = next(r for r in layer_metrics(spark, str(tmp_path)).collect() if r["camada"] == "gold")
    assert (gold["arquivos"], gold["registros"], gold["ilegiveis"]) == (4, 3, 2)

    def lost(*_):
        raise RuntimeError("Job aborted due to stage failure: ExecutorLostFailure")

    monkeypatch.setattr(lines, "count_parquet_rows", lost)
    with pytest.raises(RuntimeError, match="ExecutorLostFailure"):
        lines.count_rows_by_file(spark, str(tmp_path))


def test_layer_metrics_fails_rather_than_count_less(spark, tmp_path, monkeypatch):
    (tmp_path / "gold").mkdir()
    spark.range(5).write.parquet(str(tmp_path / "gold" / "t"))
    monkeypatch.setattr(queries_of_sources, "_medallion", lambda *_: M.Layers(str(tmp_path)))
    whole = QUERIES["layer_metrics"](spark, "")
    assert {r["camada"]: r["registros"] for r in whole.collect()} == {"bronze": 0, "silver": 0, "gold": 5, "ausente": 0}
    (tmp_path / "gold" / "broken.parquet").write_text("this is not parquet")
    with pytest.raises((PySparkException, Py4JJavaError), match="could not be read in layer gold"):
        QUERIES["layer_metrics"](spark, "").collect()
