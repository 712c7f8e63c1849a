"""Quality reports."""

from __future__ import annotations

from litmark import fixed_values as V
from litmark.operators import checks as Q
from litmark.operators import cleaning as C
from litmark.operators import keys as K
from litmark.plans import indicators as I
from litmark.plans.quality import CHECK_NETWORK_DOMAIN, GOLD_KEYS, GOLD_REQUIRED, gold_report, silver_report
from litmark.session import scratch_folder
from litmark.sources.sinks import write_csv_report
from workload import fixtures as X
from workload.cleaning import STUDENTS_SQL, clean_sql
from workload.gold import (
    AFTER,
    BEFORE,
    EVOLUTION_SQL,
    INDICATOR_SQL,
    TARGETS_SQL,
    comparison_sql,
    indicator_frame,
    targets_frame,
)
from workload.registry import plain, query, table, view

ROWS_PER_YEAR = {1999: 10_000, 2000: 9_000}
_status = "CASE WHEN encontrado = esperado THEN 'APROVADO' ELSE 'REPROVADO' END"


def _check_sql(order, name, table_name, found, expected="0", detail="", status=_status):
    detail = detail.replace("'", "''")
    return f"""SELECT {order} AS ordem, '{name}' AS verificacao, '{table_name}' AS tabela, {status} AS status,
      encontrado AS valor_encontrado, esperado AS valor_esperado, '{detail}' AS detalhe
      FROM (SELECT CAST(({found}) AS BIGINT) AS encontrado, CAST(({expected}) AS BIGINT) AS esperado)"""


_warn = f"CASE WHEN encontrado > 0 THEN 'AVISO' ELSE {_status} END"
_filled = "CASE WHEN encontrado > 0 THEN 'APROVADO' ELSE 'REPROVADO' END"


def _silver_sql() -> str:
    def text(pair, **values):
        return {"name": pair[0].format(**values), "detail": pair[1].format(**values)}

    parts = []
    counted = [
        ("municipio", plain(X.PUBLISHED), f"SELECT DISTINCT * FROM ({plain(X.PUBLISHED)})"),
        ("meta_alfabetizacao_municipio", plain(X.PLANNED), f"SELECT DISTINCT * FROM ({plain(X.PLANNED)})"),
        ("uf", "SELECT text, lang, source, n_chars FROM documents", "SELECT DISTINCT text, lang, source, n_chars FROM documents"),
        ("meta_alfabetizacao_uf", plain(X.PLANNED_STATES), f"SELECT DISTINCT * FROM ({plain(X.PLANNED_STATES)})"),
        ("meta_alfabetizacao_brasil", plain(X.PLANNED_COUNTRY), f"SELECT DISTINCT * FROM ({plain(X.PLANNED_COUNTRY)})"),
    ]
    order = 0
    for name, bronze, silver in counted:
        parts.append(_check_sql(order + 1, table_name=name, found=f"SELECT count(*) FROM ({silver})",
                                expected=f"SELECT count(*) FROM ({bronze})", **text(V.CHECK_RECONCILED)))
        parts.append(_check_sql(order + 2, V.CHECK_DUPLICATES, name, "0", detail=V.DETAIL_DUPLICATE_ROWS))
        order += 2
    raw, students = plain(X.STUDENTS_RAW), "alunos_limpos"
    count = f"SELECT count(*) FROM {students}"
    parts.append(_check_sql(order + 1, table_name="alunos", found=count, expected=f"SELECT count(*) FROM ({raw})",
                            **text(V.CHECK_RECONCILED)))
    repeated = f"""SELECT count(*) FROM (SELECT 1 FROM {students} WHERE id_aluno IS NOT NULL
      GROUP BY ano, id_aluno HAVING count(*) > 1)"""
    parts.append(_check_sql(order + 2, V.CHECK_DUPLICATES, "alunos", repeated, detail=V.DETAIL_DUPLICATE_STUDENT))
    for i, c in enumerate(V.STUDENT_REQUIRED):
        parts.append(_check_sql(20 + i, table_name="alunos", **text(V.CHECK_REQUIRED, column=c),
                                found=f"{count} WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''"))
    parts.append(_check_sql(30, table_name="alunos", **text(V.CHECK_YEAR_DOMAIN, years="1999 e 2000"),
                            found=f"{count} WHERE ano NOT IN (1999, 2000) OR ano IS NULL"))
    for i, (year, rows) in enumerate(ROWS_PER_YEAR.items()):
        parts.append(_check_sql(31 + i, table_name="alunos", **text(V.CHECK_ROWS_IN_YEAR, year=year),
                                found=f"{count} WHERE ano = {year}", expected=str(rows)))
    codes = ", ".join(f"'{c}'" for c in V.NETWORK_LABELS)
    parts.append(_check_sql(90, table_name="alunos", **text(CHECK_NETWORK_DOMAIN),
                            found=f"{count} WHERE rede NOT IN ({codes}) OR rede IS NULL"))
    for order, name, source, pair, status in [
        (100, "alunos", students, V.CHECK_STUDENT_ORPHANS, _warn),
        (101, "meta_alfabetizacao_municipio", f"({plain(X.PLANNED)})", V.CHECK_TARGET_ORPHANS, _status),
    ]:
        orphans = f"""SELECT count(DISTINCT id_municipio) FROM {source}
          WHERE id_municipio NOT IN (SELECT id_municipio FROM ({plain(X.PUBLISHED)}))"""
        parts.append(_check_sql(order, table_name=name, found=orphans, status=status, **text(pair)))
    return f"WITH alunos_limpos AS (SELECT DISTINCT * FROM ({STUDENTS_SQL})) " + " UNION ALL ".join(parts)


GOLD_SQL_NAMES = {
    V.GOLD_INDICATOR: "indicador",
    V.GOLD_TARGETS: "metas",
    V.GOLD_COMPARISON: "comparacao",
    V.GOLD_EVOLUTION: "evolucao",
}


def _gold_sql() -> str:
    parts, order = [], 0
    for name, short in GOLD_SQL_NAMES.items():
        count = f"SELECT count(*) FROM {short}"
        parts.append(_check_sql(order + 1, V.CHECK_NOT_EMPTY[0], name, count, "1", V.CHECK_NOT_EMPTY[1], _filled))
        keys = ", ".join(GOLD_KEYS[name])
        repeated = f"SELECT count(*) FROM (SELECT 1 FROM {short} GROUP BY {keys} HAVING count(*) > 1)"
        parts.append(_check_sql(order + 2, V.CHECK_KEY_DUPLICATES[0], name, repeated, detail=V.CHECK_KEY_DUPLICATES[1]))
        for i, c in enumerate(GOLD_REQUIRED[name]):
            empty = f"{count} WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''"
            label, detail = (t.format(column=c) for t in V.CHECK_KEY_NULLS)
            parts.append(_check_sql(order + 3 + i, label, name, empty, detail=detail))
        order += 2 + len(GOLD_REQUIRED[name])
    for order, name, column in [(50, V.GOLD_INDICATOR, "taxa_alfabetizacao"), (51, V.GOLD_TARGETS, "meta_alfabetizacao")]:
        label, detail = (t.format(column=column) for t in V.CHECK_RANGE)
        found = f"SELECT count(*) FROM {GOLD_SQL_NAMES[name]} WHERE {column} < 0 OR {column} > 100"
        parts.append(_check_sql(order, label, name, found, detail=detail))
    joined = """SELECT count(*) FROM indicador i JOIN metas m ON i.id_municipio = m.id_municipio
      AND i.codigo_rede = m.codigo_rede AND i.ano = m.ano_meta"""
    compared, evolved = "SELECT count(*) FROM comparacao", "SELECT count(*) FROM evolucao"
    for order, name, pair, found, expected, status in [
        (52, V.GOLD_COMPARISON, V.CHECK_COMPARISON_RECONCILED, compared, joined, _status),
        (53, V.GOLD_COMPARISON, V.CHECK_STATUS_DOMAIN,
         f"{compared} WHERE status_meta NOT IN ('Meta atingida', 'Abaixo da meta', 'Sem resultado')", "0", _status),
        (54, V.GOLD_COMPARISON, V.CHECK_NULL_TARGETS, f"{compared} WHERE meta_alfabetizacao IS NULL", "0", _status),
        (55, V.GOLD_EVOLUTION, V.CHECK_TREND_DOMAIN,
         f"{evolved} WHERE tendencia NOT IN ('Evolução positiva', 'Queda', 'Estável', 'Sem comparação')", "0", _status),
        (56, V.GOLD_EVOLUTION, V.CHECK_NO_COMPARISON, f"{evolved} WHERE tendencia = 'Sem comparação'", "0", _warn),
    ]:
        parts.append(_check_sql(order, pair[0], name, found, expected, pair[1], status))
    return (
        f"WITH indicador AS ({INDICATOR_SQL}), metas AS ({TARGETS_SQL}), comparacao AS ({comparison_sql()}), "
        f"evolucao AS ({EVOLUTION_SQL}) " + " UNION ALL ".join(parts)
    )


SILVER_SQL = _silver_sql()
GOLD_SQL = _gold_sql()


def silver_frame(spark, folder):
    raw = view(spark, folder, X.STUDENTS_RAW)
    bronze = {
        "municipio": view(spark, folder, X.PUBLISHED),
        "meta_alfabetizacao_municipio": view(spark, folder, X.PLANNED),
        "uf": table(spark, folder, "documents").drop("doc_id"),
        "meta_alfabetizacao_uf": view(spark, folder, X.PLANNED_STATES),
        "meta_alfabetizacao_brasil": view(spark, folder, X.PLANNED_COUNTRY),
        "alunos": raw,
    }
    silver = {n: C.drop_exact_duplicates(df) for n, df in bronze.items()} | {"alunos": C.clean_students(raw)}
    return silver_report(bronze, silver, ROWS_PER_YEAR, check_networks=True)


def gold_frame(spark, folder):
    results, wanted = indicator_frame(spark, folder), targets_frame(spark, folder)
    compared = I.comparison(results, wanted, stamped=False)
    return gold_report(results, wanted, compared, I.evolution(results, BEFORE, AFTER, stamped=False))


@query(SILVER_SQL)
def dq_silver(spark, folder):
    return silver_frame(spark, folder)


@query(GOLD_SQL)
def dq_gold(spark, folder):
    return gold_frame(spark, folder)


@query(f"SELECT status, count(*) AS quantidade FROM ({GOLD_SQL}) GROUP BY status")
def dq_tally(spark, folder):
    return K.tally(gold_frame(spark, folder), "status")


@query(
    f"""SELECT count(*) AS verificacoes, count(*) FILTER (WHERE status = 'APROVADO') AS aprovadas,
    count(*) FILTER (WHERE status = 'AVISO') AS avisos, count(*) FILTER (WHERE status = 'REPROVADO') AS reprovadas
    FROM ({SILVER_SQL})"""
)
def dq_summary(spark, folder):
    return Q.summary(silver_frame(spark, folder))


@query(f"SELECT verificacao, tabela, status, valor_encontrado, valor_esperado, detalhe FROM ({SILVER_SQL})")
def dq_report_csv(spark, folder):
    """The report written as CSV and read back; it is stored before the gate is asked."""
    path = scratch_folder(spark, "relatorio")
    columns = ["verificacao", "tabela", "status", "valor_encontrado", "valor_esperado", "detalhe"]
    write_csv_report(silver_frame(spark, folder).orderBy("ordem").select(*columns), path)
    schema = "verificacao string, tabela string, status string, valor_encontrado long, valor_esperado long, detalhe string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@query(
    f"""SELECT {clean_sql("presenca")} AS presenca, count(*) AS quantidade FROM ({plain(X.STUDENTS_RAW)})
    GROUP BY 1 ORDER BY 1"""
)
def value_distribution(spark, folder):
    students = C.clean_text(view(spark, folder, X.STUDENTS_RAW).select("presenca"), ["presenca"])
    return K.distribution(students, ["presenca"])
