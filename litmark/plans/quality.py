"""The Silver and Gold quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark import fixed_values as V
from litmark.functions.numbers import out_of_domain, out_of_range
from litmark.functions.text import blank
from litmark.operators.checks import (
    EQUAL,
    NOT_EMPTY,
    WARN_IF_ANY,
    Check,
    measure_copies,
    measure_table,
    measures,
    results,
)
from litmark.operators.keys import orphan_keys
from litmark.plans.indicators import join_targets

GOLD_KEYS = {
    V.GOLD_INDICATOR: ["ano", "id_municipio", "codigo_rede", "serie"],
    V.GOLD_TARGETS: ["id_municipio", "codigo_rede", "ano_meta"],
    V.GOLD_COMPARISON: ["ano", "id_municipio", "codigo_rede"],
    V.GOLD_EVOLUTION: ["id_municipio", "codigo_rede"],
}
GOLD_REQUIRED = {**GOLD_KEYS, V.GOLD_INDICATOR: ["ano", "id_municipio", "codigo_rede"]}

# An extra check of this engine.
CHECK_NETWORK_DOMAIN = ("Domínio da rede", "O código de rede deve pertencer ao domínio definido.")


def _text(pair: tuple[str, str], **values) -> dict[str, str]:
    return {"name": pair[0].format(**values), "detail": pair[1].format(**values)}


def _total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def silver_report(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    rows_per_year: dict[int, int],
    check_networks: bool = False,
) -> DataFrame:
    """Checks of the Silver tables: preserved row counts, duplicates, required student columns, years, orphans.

    ``silver`` holds the student, results and targets tables and any other reference table; ``bronze`` the same names.
    ``rows_per_year`` gives the allowed years and their expected student rows. Tables are scanned once for all their
    own checks; Bronze tables are only counted.
    """
    parts: list[DataFrame] = []
    order = 0
    for name in [n for n in silver if n != V.SILVER_STUDENTS] + [V.SILVER_STUDENTS]:
        reconciled = {"order": order + 1, "table": name, **_text(V.CHECK_RECONCILED)}
        repeated = {"order": order + 2, "table": name, "name": V.CHECK_DUPLICATES}
        order += 2
        parts.append(measures(_total(bronze[name]), [Check(**reconciled, expected=F.col("total"))]))
        found = Check(**reconciled, found=F.col("total"))
        if name == V.SILVER_STUDENTS:
            parts += _student_measures(silver[name], found, repeated, rows_per_year, check_networks)
        else:
            surplus = Check(**repeated, detail=V.DETAIL_DUPLICATE_ROWS, found=F.col("excedentes"))
            parts.append(measures(measure_copies(silver[name]), [found, surplus]))

    results_table = silver[V.SILVER_RESULTS]
    for at, table, text, rule in [
        (100, V.SILVER_STUDENTS, V.CHECK_STUDENT_ORPHANS, WARN_IF_ANY),
        (101, V.SILVER_TARGETS, V.CHECK_TARGET_ORPHANS, EQUAL),
    ]:
        orphans = _total(orphan_keys(silver[table], results_table, ["id_municipio"]))
        parts.append(measures(orphans, [Check(at, table, **_text(text), found=F.col("total"), rule=rule)]))
    return results(parts)


def _student_measures(
    students: DataFrame, found: Check, repeated: dict, rows_per_year: dict[int, int], check_networks: bool
) -> list[DataFrame]:
    years = sorted(rows_per_year)
    violations = {f"nulos_{c}": blank(F.col(c)) for c in V.STUDENT_REQUIRED}
    violations["ano_fora"] = out_of_domain(F.col("ano"), years)
    violations |= {f"ano_{y}": F.col("ano") == y for y in years}
    if check_networks:
        codes = [str(code) for code in V.NETWORK_LABELS]
        violations["rede_fora"] = out_of_domain(F.col("rede"), codes)
    row = measure_table(students, violations, ["ano", "!id_aluno"])

    table = V.SILVER_STUDENTS
    checks = [found, Check(**repeated, detail=V.DETAIL_DUPLICATE_STUDENT, found=F.col("repetidas"))]
    checks += [
        Check(20 + i, table, **_text(V.CHECK_REQUIRED, column=c), found=F.col(f"nulos_{c}"))
        for i, c in enumerate(V.STUDENT_REQUIRED)
    ]
    listed = " e ".join(str(y) for y in years)
    checks.append(Check(30, table, **_text(V.CHECK_YEAR_DOMAIN, years=listed), found=F.col("ano_fora")))
    checks += [
        Check(31 + i, table, **_text(V.CHECK_ROWS_IN_YEAR, year=y), found=F.col(f"ano_{y}"), expected=rows_per_year[y])
        for i, y in enumerate(years)
    ]
    if check_networks:
        checks.append(Check(90, table, **_text(CHECK_NETWORK_DOMAIN), found=F.col("rede_fora")))
    return [measures(row, checks)]


def gold_report(indicator: DataFrame, targets: DataFrame, comparison: DataFrame, evolution: DataFrame) -> DataFrame:
    """The 26 checks of the four Gold tables. Each table is scanned once for its own checks."""
    rate, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    frames = {
        V.GOLD_INDICATOR: (indicator, {"faixa": out_of_range(rate)}),
        V.GOLD_TARGETS: (targets, {"faixa": out_of_range(target)}),
        V.GOLD_COMPARISON: (
            comparison,
            {"dominio": out_of_domain(F.col("status_meta"), V.STATUS_DOMAIN), "sem_meta": target.isNull()},
        ),
        V.GOLD_EVOLUTION: (
            evolution,
            {
                "dominio": out_of_domain(F.col("tendencia"), V.TREND_DOMAIN),
                "sem_comparacao": F.col("tendencia") == V.TREND_NONE,
            },
        ),
    }
    extra = {
        V.GOLD_INDICATOR: [
            Check(50, V.GOLD_INDICATOR, **_text(V.CHECK_RANGE, column="taxa_alfabetizacao"), found=F.col("faixa")),
        ],
        V.GOLD_TARGETS: [
            Check(51, V.GOLD_TARGETS, **_text(V.CHECK_RANGE, column="meta_alfabetizacao"), found=F.col("faixa")),
        ],
        V.GOLD_COMPARISON: [
            Check(52, V.GOLD_COMPARISON, **_text(V.CHECK_COMPARISON_RECONCILED), found=F.col("total")),
            Check(53, V.GOLD_COMPARISON, **_text(V.CHECK_STATUS_DOMAIN), found=F.col("dominio")),
            Check(54, V.GOLD_COMPARISON, **_text(V.CHECK_NULL_TARGETS), found=F.col("sem_meta")),
        ],
        V.GOLD_EVOLUTION: [
            Check(55, V.GOLD_EVOLUTION, **_text(V.CHECK_TREND_DOMAIN), found=F.col("dominio")),
            Check(
                56,
                V.GOLD_EVOLUTION,
                **_text(V.CHECK_NO_COMPARISON),
                found=F.col("sem_comparacao"),
                rule=WARN_IF_ANY,
            ),
        ],
    }
    parts: list[DataFrame] = []
    order = 0
    for name, (df, violations) in frames.items():
        nulls = {f"nulos_{c}": blank(F.col(c)) for c in GOLD_REQUIRED[name]}
        row = measure_table(df, {**nulls, **violations}, GOLD_KEYS[name])
        checks = [
            Check(order + 1, name, **_text(V.CHECK_NOT_EMPTY), found=F.col("total"), expected=1, rule=NOT_EMPTY),
            Check(order + 2, name, **_text(V.CHECK_KEY_DUPLICATES), found=F.col("repetidas")),
        ]
        checks += [
            Check(order + 3 + i, name, **_text(V.CHECK_KEY_NULLS, column=c), found=F.col(f"nulos_{c}"))
            for i, c in enumerate(GOLD_REQUIRED[name])
        ]
        order += len(checks)
        parts.append(measures(row, checks + extra[name]))

    expected = Check(52, V.GOLD_COMPARISON, **_text(V.CHECK_COMPARISON_RECONCILED), expected=F.col("total"))
    parts.append(measures(_total(join_targets(indicator, targets)), [expected]))
    return results(parts)
