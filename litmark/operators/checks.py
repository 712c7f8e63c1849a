"""Declarative quality checks: every check of a table is measured in one pass over it.

A *measure* is a small frame ``(ordem, tabela, verificacao, detalhe, regra, encontrado, esperado)``. Two sides of a
reconciliation are two measures of the same check; ``results`` adds them up, so no join is needed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmark import fixed_values as V

EQUAL = "igual"
WARN_IF_ANY = "aviso"
NOT_EMPTY = "minimo"


@dataclass(frozen=True)
class Check:
    """A check of ``table``; ``found`` and ``expected`` are columns over the measured row, or constants."""

    order: int
    table: str
    name: str
    detail: str
    found: Column | int = 0
    expected: Column | int = 0
    rule: str = EQUAL


def _long(value: Column | int) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("long")


def measures(row: DataFrame, checks: list[Check]) -> DataFrame:
    """The checks as rows, read from a one-row frame of measured values."""
    entries = [
        F.struct(
            F.lit(c.order).alias("ordem"),
            F.lit(c.table).alias("tabela"),
            F.lit(c.name).alias("verificacao"),
            F.lit(c.detail).alias("detalhe"),
            F.lit(c.rule).alias("regra"),
            F.coalesce(_long(c.found), F.lit(0).cast("long")).alias("encontrado"),
            F.coalesce(_long(c.expected), F.lit(0).cast("long")).alias("esperado"),
        )
        for c in checks
    ]
    return row.select(F.inline(F.array(*entries)))


def measure_table(df: DataFrame, violations: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """One row with ``total``, the count of each violation and, given ``keys``, ``repetidas``: keys met more than once.

    With keys, violations are counted inside the same grouping, so the table is scanned once. Rows whose key has a
    NULL in ``keys`` named with a leading ``!`` are not counted as repeated.
    """
    counters = {name: F.count_if(test) for name, test in violations.items()}
    if not keys:
        return df.agg(F.count("*").alias("total"), *[c.alias(n) for n, c in counters.items()])
    names = [k.lstrip("!") for k in keys]
    needed = [F.col(k.lstrip("!")).isNotNull() for k in keys if k.startswith("!")]
    repeated = reduce(lambda a, b: a & b, needed, F.col("_n") > 1)
    grouped = df.groupBy(*names).agg(F.count("*").alias("_n"), *[c.alias(n) for n, c in counters.items()])
    return grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.count_if(repeated).alias("repetidas"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counters],
    )


def measure_copies(df: DataFrame) -> DataFrame:
    """One row with ``total`` and ``excedentes``: rows beyond the first of each group of equal rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("excedentes"),
    )


def status_of(rule: Column, found: Column, expected: Column) -> Column:
    return (
        F.when(rule == NOT_EMPTY, F.when(found > 0, V.PASS).otherwise(V.FAIL))
        .when((rule == WARN_IF_ANY) & (found > 0), V.WARN)
        .when(found == expected, V.PASS)
        .otherwise(V.FAIL)
    )


def results(parts: list[DataFrame]) -> DataFrame:
    """The report: one row per check, in check order."""
    found, expected = F.sum("encontrado"), F.sum("esperado")
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("ordem", "tabela", "verificacao", "detalhe", "regra")
        .agg(found.alias("valor_encontrado"), expected.alias("valor_esperado"))
        .select(
            "ordem",
            "verificacao",
            "tabela",
            status_of(F.col("regra"), F.col("valor_encontrado"), F.col("valor_esperado")).alias("status"),
            "valor_encontrado",
            "valor_esperado",
            "detalhe",
        )
        .orderBy("ordem")
    )


def summary(report: DataFrame) -> DataFrame:
    """One row: checks run, passed, warned and failed."""
    return report.agg(
        F.count("*").alias("verificacoes"),
        F.count_if(F.col("status") == V.PASS).alias("aprovadas"),
        F.count_if(F.col("status") == V.WARN).alias("avisos"),
        F.count_if(F.col("status") == V.FAIL).alias("reprovadas"),
    )


class QualityError(RuntimeError):
    """At least one check failed."""


def gate(report: DataFrame) -> str:
    """Raise when a check failed, else the overall status (warnings pass). Call it after the report is written."""
    row = summary(report).first()
    if row["reprovadas"]:
        raise QualityError(f"{row['reprovadas']} of {row['verificacoes']} checks failed")
    return V.WARN if row["avisos"] else V.PASS
