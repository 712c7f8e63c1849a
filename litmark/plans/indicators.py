"""Gold tables: indicator, targets, comparison, evolution, and the dashboard aggregates over them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark import fixed_values as V
from litmark.functions.labels import network_code, network_label, state_of, target_status, trend
from litmark.functions.numbers import round2, strict_double, strict_int

PROPORTIONS = [f"proporcao_aluno_nivel_{level}" for level in range(9)]
COMPARISON_KEYS = ["id_municipio", "codigo_rede", "ano"]


def indicator(results: DataFrame, extra: list[str] = PROPORTIONS, stamped: bool = True) -> DataFrame:
    """Typed and labelled results; rows without a municipality are left out."""
    kinds = {f.name: f.dataType for f in results.schema.fields}

    def number(name: str):
        return strict_double(F.col(name), kinds[name], name)

    network = strict_int(F.col("rede"), kinds["rede"], "rede")
    municipality = F.col("id_municipio").cast("string")
    typed = results.where(F.col("id_municipio").isNotNull()).select(
        strict_int(F.col("ano"), kinds["ano"], "ano").alias("ano"),
        municipality.alias("id_municipio"),
        state_of(municipality).alias("id_uf"),
        F.col("serie").cast("string").alias("serie"),
        network.alias("codigo_rede"),
        round2(number("taxa_alfabetizacao")).alias("taxa_alfabetizacao"),
        round2(number("media_portugues")).alias("media_portugues"),
        *[number(c).alias(c) for c in extra],
    )
    columns = typed.columns
    at = columns.index("codigo_rede") + 1
    labelled = typed.select(
        *columns[:at], network_label(F.col("codigo_rede")).alias("rede"), *columns[at:]
    )
    return _stamp(labelled, V.INDICATOR_SOURCE) if stamped else labelled


def target_columns(wide: DataFrame, prefix: str = "meta_alfabetizacao_") -> dict[str, int]:
    """Columns named prefix + year, and their years."""
    found = {c: re.fullmatch(re.escape(prefix) + r"(\d{4})", c) for c in wide.columns}
    return {c: int(m.group(1)) for c, m in found.items() if m}


def latest_targets(wide: DataFrame, columns: dict[str, int]) -> DataFrame:
    """Per municipality and network, the newest present target of each target year, still one column per year.

    Grouping the wide rows and unpivoting afterwards shuffles one row per key instead of one per key and target year,
    and a frequent key is reduced before the shuffle. The larger target wins when a reference year repeats.
    """
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    base = wide.select(
        F.col("id_municipio").cast("string").alias("id_municipio"),
        network_code(F.col("rede"), kinds["rede"]).alias("codigo_rede"),
        strict_int(F.col("ano"), kinds["ano"], "ano").alias("ano_referencia_fonte"),
        *[strict_double(F.col(c), kinds[c], c).alias(c) for c in columns],
    ).where(F.col("id_municipio").isNotNull() & F.col("codigo_rede").isNotNull())
    newest = [
        F.max(
            F.when(F.col(c).isNotNull(), F.struct(F.col("ano_referencia_fonte"), F.col(c).alias("meta_alfabetizacao")))
        ).alias(c)
        for c in columns
    ]
    return base.groupBy("id_municipio", "codigo_rede").agg(*newest)


def targets(wide: DataFrame, columns: dict[str, int] | None = None, stamped: bool = True) -> DataFrame:
    """Targets in long form: one row per municipality, network and target year, newest present value."""
    columns = columns or target_columns(wide)
    entries = [F.struct(F.lit(year).alias("ano_meta"), F.col(c).alias("_valor")) for c, year in columns.items()]
    long = (
        latest_targets(wide, columns)
        .select("id_municipio", "codigo_rede", F.inline(F.array(*entries)))
        .where(F.col("_valor").isNotNull())
    )
    table = long.select(
        "id_municipio",
        state_of(F.col("id_municipio")).alias("id_uf"),
        "codigo_rede",
        network_label(F.col("codigo_rede")).alias("rede"),
        "ano_meta",
        round2(F.col("_valor.meta_alfabetizacao")).alias("meta_alfabetizacao"),
        F.col("_valor.ano_referencia_fonte").alias("ano_referencia_fonte"),
    )
    return _stamp(table, V.TARGETS_SOURCE) if stamped else table


def join_targets(indicators: DataFrame, target_table: DataFrame, how: str = "inner") -> DataFrame:
    """Results with the target of the same municipality, network and year.

    Both sides grow with the data, and read back from files they look small: compressed bytes would make the planner hold a whole side in
    every task. A merge join takes bounded memory at any size.
    """
    renamed = target_table.select(
        "id_municipio", "codigo_rede", F.col("ano_meta").alias("ano"), "meta_alfabetizacao"
    )
    return indicators.join(renamed.hint("merge"), COMPARISON_KEYS, how)


def comparison(
    indicators: DataFrame, target_table: DataFrame, how: str = "inner", stamped: bool = True
) -> DataFrame:
    """Result against target. ``how="left"`` keeps results without a target."""
    rate, target = F.col("taxa_alfabetizacao"), F.col("meta_alfabetizacao")
    table = join_targets(indicators, target_table, how).select(
        "ano",
        "id_municipio",
        "id_uf",
        "codigo_rede",
        "rede",
        "taxa_alfabetizacao",
        "meta_alfabetizacao",
        round2(rate - target).alias("diferenca_meta_pp"),
        target_status(rate, target).alias("status_meta"),
    )
    return _stamp(table) if stamped else table


def evolution(indicators: DataFrame, before: int = 2023, after: int = 2024, stamped: bool = True) -> DataFrame:
    """Change of the rate between two years, per municipality and network (the greatest rate over grades)."""
    old, new = f"taxa_alfabetizacao_{before}", f"taxa_alfabetizacao_{after}"
    rate = F.col("taxa_alfabetizacao")
    table = (
        indicators.groupBy("id_municipio", "id_uf", "codigo_rede", "rede")
        .agg(
            F.max(F.when(F.col("ano") == before, rate)).alias(old),
            F.max(F.when(F.col("ano") == after, rate)).alias(new),
        )
        .withColumns(
            {
                f"variacao_{before}_{after}_pp": round2(F.col(new) - F.col(old)),
                "tendencia": trend(F.col(old), F.col(new)),
            }
        )
    )
    return _stamp(table) if stamped else table


def mean_rate(indicators: DataFrame) -> DataFrame:
    """Mean rate per year and state. Rates have two decimals, so the sum is exact whatever the partitioning."""
    rate = F.col("taxa_alfabetizacao")
    total = F.sum(rate.cast("decimal(18,2)")).cast("double")
    return indicators.groupBy("ano", "id_uf").agg(F.try_divide(total, F.count(rate)).alias("taxa_media"))


def status_by_state(compared: DataFrame) -> DataFrame:
    return compared.groupBy("id_uf", "status_meta").agg(F.count("*").alias("quantidade"))


def trend_by_state(changes: DataFrame) -> DataFrame:
    return changes.groupBy("id_uf", "tendencia").agg(F.count("*").alias("quantidade"))


def _stamp(df: DataFrame, source: str | None = None) -> DataFrame:
    marks = {"fonte_gold": F.lit(source)} if source else {}
    return df.withColumns({**marks, "gerado_em_utc": F.current_timestamp()})
