import pytest
from litmark import fixed_values as V
from litmark.operators import checks as Q
from litmark.operators import cleaning as C
from litmark.operators import costs as K
from litmark.operators import keys as O
from litmark.operators import runs as R
from litmark.plans import indicators as I
from litmark.plans.quality import gold_report, silver_report
from pyspark.sql import functions as F


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_rename_refuses_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_B` int")
    with pytest.raises(ValueError):
        C.rename_columns(df)


def test_reference_cleaning(spark):
    df = spark.createDataFrame([(" x ", 1.0), ("x", 1.0), ("nan", float("nan")), (None, None)], "`Nome Longo` string, v double")
    assert C.clean_reference(df).columns == ["nome_longo", "v"]
    assert set(map(tuple, C.clean_reference(df).collect())) == {("x", 1.0), (None, None)}


def test_latest_per_key_and_ties(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 5), ("a", 2, 7), ("b", 1, 1)], "k string, y int, v int")
    assert rows(O.latest_per_key(df, ["k"], [F.col("y"), F.col("v")])) == [("a", 2, 7), ("b", 1, 1)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "y"), (2, "y"), (2, "y")], "k int, v string")
    assert rows(O.count_duplicate_keys(df, ["k"])) == [(2,)]
    assert rows(O.count_excess_rows(df)) == [(3,)]


def test_orphans_ignore_null_keys(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, ano int")
    right = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows(O.orphan_keys(left, right, ["k"])) == [("a",)]
    assert rows(O.orphan_profile(left, right, "k", "ano")) == [("a", 2, 1, 2)]


def test_unseen_keys(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    history = spark.createDataFrame([("b",), ("b",), ("z",)], "k string")
    assert rows(O.unseen_keys(batch, history, "k")) == [("a", 1), ("c", 3)]


def test_anti_joins_see_each_right_key_once(spark):
    """A third of the right rows has one key; below the join's shuffle stands an aggregate."""
    left = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("ano"))
    right = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("k"))
    for made in (O.orphan_keys(left, right, ["k"]), O.orphan_profile(left, right, "k", "ano")):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftAnti") < plan.rindex("Aggregate [k#") or plan.count("Aggregate") >= 2
    missing = {str(i) for i in range(50) if i % 3 == 0 and i}
    assert {r[0] for r in O.orphan_keys(left, right, ["k"]).collect()} == missing | {"0"} - {"7"}


def test_frequent_key_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one key: after the partial aggregation each task sends one row for it."""
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v")
    )
    for grouped in (O.latest_per_key(df, ["k"], [F.col("v")]), O.duplicate_keys(df, ["k"])):
        text = plan(grouped)
        assert "partial_" in text
        assert "Window" not in text
    best = dict(map(tuple, O.latest_per_key(df, ["k"], [F.col("v")]).where("k = 'hot'").collect()))
    assert best == {"hot": 89_997}


def test_targets_take_the_newest_present_value(spark):
    wide = spark.createDataFrame(
        [
            (2023, "3500001", "municipal", 50.0, None),
            (2024, "3500001", "3", None, 70.123),
            (2024, "3500001", " Total ", 10.0, 11.0),
            (2024, "3500001", "desconhecida", 1.0, 1.0),
            (2024, None, "3", 1.0, 1.0),
        ],
        "ano int, id_municipio string, rede string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2025 double",
    )
    got = rows(I.targets(wide, stamped=False))
    assert got == [
        ("3500001", "35", 0, "Total", 2024, 10.0, 2024),
        ("3500001", "35", 0, "Total", 2025, 11.0, 2024),
        ("3500001", "35", 3, "Municipal", 2024, 50.0, 2023),
        ("3500001", "35", 3, "Municipal", 2025, 70.12, 2024),
    ]


def test_targets_scan_and_shuffle_once(spark, tmp_path):
    columns = ", ".join(f"meta_alfabetizacao_{y} double" for y in range(2024, 2031))
    empty = spark.createDataFrame([], f"ano int, id_municipio string, rede string, extra string, {columns}")
    empty.write.parquet(str(tmp_path / "t"))
    text = plan(I.targets(spark.read.parquet(str(tmp_path / "t"))))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert text.count("hashpartitioning") == 1
    assert "extra" not in text.split("ReadSchema")[1].split("\n")[0]


def gold(spark):
    columns = "ano int, id_municipio string, serie string, rede int, taxa_alfabetizacao double, media_portugues double"
    results = spark.createDataFrame(
        [
            (2023, "3500001", "2", 3, 40.0, 700.0),
            (2024, "3500001", "2", 3, 55.555, 710.0),
            (2024, "3500002", "2", 3, None, 710.0),
            (2024, "3500003", "2", 3, 10.0, 710.0),
        ],
        columns,
    )
    wide = spark.createDataFrame(
        [(2023, "3500001", "3", 50.0), (2023, "3500002", "3", 50.0), (2023, "3500003", "3", 50.0)],
        "ano int, id_municipio string, rede string, meta_alfabetizacao_2024 double",
    )
    indicator, targets = I.indicator(results, extra=[]), I.targets(wide)
    return indicator, targets, I.comparison(indicator, targets), I.evolution(indicator)


def test_gold_tables(spark):
    indicator, targets, compared, changes = gold(spark)
    assert indicator.columns[-2:] == ["fonte_gold", "gerado_em_utc"]
    statuses = {r["id_municipio"]: r["status_meta"] for r in compared.collect()}
    assert statuses == {"3500001": "Meta atingida", "3500002": "Sem resultado", "3500003": "Abaixo da meta"}
    trends = {r["id_municipio"]: r["tendencia"] for r in changes.collect()}
    assert trends == {"3500001": "Evolução positiva", "3500002": "Sem comparação", "3500003": "Sem comparação"}
    assert I.status_by_state(compared).count() == 3
    assert rows(I.mean_rate(indicator)) == [(2023, "35", 40.0), (2024, "35", pytest.approx((55.56 + 10) / 2))]


def test_gold_report_has_26_checks(spark):
    report = gold_report(*gold(spark))
    by_status = {r["status"]: r["quantidade"] for r in O.tally(report, "status").collect()}
    assert report.count() == 26
    assert by_status == {"APROVADO": 25, "AVISO": 1}
    assert Q.gate(report) == V.WARN


def silver(spark, duplicate=False):
    students = spark.createDataFrame(
        [(2023, "35", "a1", "1", "3"), (2024, "35", "a2", "1", "3"), (2024, "99", "a3", "1", "3")]
        + ([(2024, "35", "a2", "0", "3")] if duplicate else []),
        "ano int, id_municipio string, id_aluno string, presenca string, rede string",
    )
    reference = spark.createDataFrame([("35", 1)], "id_municipio string, v int")
    return {t: reference for t in V.REFERENCE_TABLES} | {"alunos": students}


def test_silver_report_has_21_checks(spark):
    tables = silver(spark)
    report = silver_report(tables, tables, {2023: 1, 2024: 2})
    by_status = {r["status"]: r["quantidade"] for r in O.tally(report, "status").collect()}
    assert report.count() == 21
    assert by_status == {"APROVADO": 20, "AVISO": 1}


def test_gate_fails_on_a_failed_check(spark):
    tables = silver(spark, duplicate=True)
    report = silver_report(tables, tables, {2023: 1, 2024: 2})
    failed = {r["verificacao"] for r in report.where(F.col("status") == V.FAIL).collect()}
    assert failed == {"Duplicidades", "Quantidade de alunos em 2024"}
    with pytest.raises(Q.QualityError):
        Q.gate(report)


def test_report_of_empty_tables(spark):
    empty = [df.limit(0) for df in gold(spark)]
    report = {(r["tabela"], r["verificacao"]): r["status"] for r in gold_report(*empty).collect()}
    assert len(report) == 26
    assert report[(V.GOLD_INDICATOR, "Tabela não vazia")] == V.FAIL


def test_storage_cost_uses_the_free_tier_on_active_bytes_first(spark):
    gib = 1024**3
    tables = spark.createDataFrame([(12 * gib, 5 * gib)], "bytes_ativos long, bytes_longo_prazo long")
    row = K.storage_cost(tables).first()
    assert (row["gib_ativos_cobraveis"], row["gib_longo_prazo_cobraveis"]) == (2.0, 5.0)
    assert row["custo_total_usd"] == pytest.approx(2 * 0.02 + 5 * 0.01)
    small = spark.createDataFrame([(4 * gib, 8 * gib)], "bytes_ativos long, bytes_longo_prazo long")
    assert K.storage_cost(small).first()["gib_longo_prazo_cobraveis"] == 2.0


def test_scenario_refuses_negative_runs(spark):
    sizes = spark.createDataFrame([(1024,)], "bytes_estimados long")
    with pytest.raises(ValueError):
        K.dashboard_scenario(sizes, -1)
    assert K.dashboard_scenario(sizes, 0).first()["bytes_mensais"] == 0


def test_advice_when_usage_is_unknown(spark):
    tables = spark.createDataFrame(
        [("d", "t", 60 * 1024**2, 1, 1, False, "Não", None)],
        "dataset string, tabela string, bytes_totais long, bytes_ativos long, bytes_longo_prazo long, "
        "particionada boolean, clusterizacao string, expiracao_padrao_dataset_dias double",
    )
    sizes = spark.createDataFrame([(1024,)], "bytes_estimados long")
    advice = K.recommendations(
        tables, K.usage_unavailable(spark, "x"), K.storage_cost(tables), K.dashboard_scenario(sizes)
    )
    texts = {r["ordem"]: r["recomendacao"] for r in advice.collect()}
    assert texts[1].startswith("Avaliar particionamento nas tabelas maiores: d.t.")
    assert texts[4] == V.ADVICE_USAGE_UNKNOWN
    assert 6 not in texts
    assert len(texts) == 10


def test_run_log(spark, tmp_path):
    root = str(tmp_path)
    spark.range(5).write.parquet(f"{root}/data/gold/t")
    log = R.RunLog(spark, f"{root}/log", "r1", "gold", f"{root}/data")
    started = log.started
    log.add_stage("a", "first", started)
    log.add_stage("b", "second", started, error="broken\nbadly" + "x" * 2000)
    summary = log.close().first()
    assert (summary["status"], summary["etapas_com_sucesso"], summary["etapas_com_falha"]) == ("FALHA", 1, 1)
    assert (summary["gold_registros"], summary["bronze_registros"]) == (5, 0)
    assert summary["gold_bytes"] > 0
    alert = spark.read.parquet(f"{root}/log/alertas").first()
    assert alert["etapa"] == "b" and alert["mensagem"].startswith("broken badly") and len(alert["mensagem"]) == 1000
    history = spark.read.schema(R.RUN_SCHEMA).json(f"{root}/log/historico")
    assert history.first()["metricas_depois"]["gold"]["registros"] == 5


def test_cleaning_strips_and_parses_each_value_once(spark):
    rows = [("2023", " 1\t", "1.5", "x"), ("nan", " None ", "", None), ("20.5", "\u00a0", "1e2 ", " nan ")]
    df = spark.createDataFrame(rows, "ano string, rede string, peso_aluno string, outra string")
    cleaned = C.coerce_numbers(C.clean_text(df, ["ano", "rede", "peso_aluno"]), iter(["ano"]), iter(["peso_aluno"]))
    plan = cleaned._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 3 and plan.count("as double") == 3  # the third: the whole number that ano is compared with
    assert [tuple(r) for r in cleaned.collect()] == [(2023, "1", 1.5, "x"), (None, None, None, None), (None, None, 100.0, " nan ")]


def test_targets_read_from_files_are_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(2024, "3500001", 3, 50.0)], "ano int, id_municipio string, codigo_rede int, taxa_alfabetizacao double").write.parquet(str(tmp_path / "i"))
    spark.createDataFrame([("3500001", 3, 2024, 60.0)], "id_municipio string, codigo_rede int, ano_meta int, meta_alfabetizacao double").write.parquet(str(tmp_path / "m"))
    joined = I.join_targets(spark.read.parquet(str(tmp_path / "i")), spark.read.parquet(str(tmp_path / "m")))
    assert [r.meta_alfabetizacao for r in joined.collect()] == [60.0]
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
