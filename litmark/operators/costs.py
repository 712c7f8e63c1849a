"""Storage and query cost: usage, prices, advice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmark import fixed_values as V
from litmark.functions.numbers import gib, readable_bytes, tib
from litmark.functions.times import within_days

USAGE_COLUMNS = ["quantidade_queries", "quantidade_cache_hits", "bytes_processados", "bytes_faturados"]


def usage(jobs: DataFrame, now: Column | None = None, days: int = 30) -> DataFrame:
    """One row: finished queries of the last days, cache hits, bytes processed and billed."""
    recent = jobs.where(
        within_days(F.col("creation_time"), days, now)
        & (F.col("job_type") == "QUERY")
        & (F.col("state") == "DONE")
        & F.col("error_result").isNull()
        & (F.col("statement_type").isNull() | (F.col("statement_type") != "SCRIPT"))
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long")

    return recent.agg(
        F.lit(True).alias("disponivel"),
        F.count("*").alias("quantidade_queries"),
        F.count_if("cache_hit").alias("quantidade_cache_hits"),
        total("total_bytes_processed").alias("bytes_processados"),
        total("total_bytes_billed").alias("bytes_faturados"),
        F.lit("").alias("erro"),
    )


def usage_unavailable(spark: SparkSession, error: str) -> DataFrame:
    """The same row when the job history cannot be read."""
    schema = "disponivel boolean, " + ", ".join(f"{c} long" for c in USAGE_COLUMNS) + ", erro string"
    return spark.createDataFrame([(False, 0, 0, 0, 0, error)], schema)


def storage_cost(
    tables: DataFrame, active_price: float = V.ACTIVE_USD_PER_GIB, long_term_price: float = V.LONG_TERM_USD_PER_GIB
) -> DataFrame:
    """One row: monthly storage cost. Active bytes use up the free tier first."""
    totals = tables.agg(
        F.coalesce(F.sum("bytes_ativos"), F.lit(0)).alias("_active"),
        F.coalesce(F.sum("bytes_longo_prazo"), F.lit(0)).alias("_old"),
    ).select(gib(F.col("_active")).alias("gib_ativos"), gib(F.col("_old")).alias("gib_longo_prazo"))
    active, old = F.col("gib_ativos"), F.col("gib_longo_prazo")
    none, free = F.lit(0.0), F.lit(V.FREE_STORAGE_GIB)
    billed = totals.select(
        active,
        old,
        (active + old).alias("gib_totais"),
        F.greatest(none, active - free).alias("gib_ativos_cobraveis"),
        F.greatest(none, old - F.greatest(none, free - active)).alias("gib_longo_prazo_cobraveis"),
    )
    return billed.withColumns(
        {
            "custo_ativo_usd": F.col("gib_ativos_cobraveis") * F.lit(float(active_price)),
            "custo_longo_prazo_usd": F.col("gib_longo_prazo_cobraveis") * F.lit(float(long_term_price)),
        }
    ).withColumn("custo_total_usd", F.col("custo_ativo_usd") + F.col("custo_longo_prazo_usd"))


def query_cost(df: DataFrame, monthly_bytes: str, price: float = V.QUERY_USD_PER_TIB) -> DataFrame:
    """Adds the monthly TiB, the part beyond the free tier, and its price."""
    size = tib(F.col(monthly_bytes))
    billed = F.greatest(F.lit(0.0), size - F.lit(V.FREE_QUERY_TIB))
    return df.withColumns(
        {"tib_mensais": size, "tib_cobraveis": billed, "custo_total_usd": billed * F.lit(float(price))}
    )


def dashboard_scenario(sizes: DataFrame, runs: int = 100, price: float = V.QUERY_USD_PER_TIB) -> DataFrame:
    """One row: all queries run ``runs`` times a month."""
    if runs < 0:
        raise ValueError("runs must not be negative")
    cycle = F.coalesce(F.sum("bytes_estimados"), F.lit(0)).cast("long")
    month = sizes.agg(cycle.alias("bytes_por_ciclo")).select(
        "bytes_por_ciclo",
        (F.col("bytes_por_ciclo") * runs).alias("bytes_mensais"),
        F.lit(runs).cast("long").alias("execucoes_por_consulta"),
    )
    return query_cost(month, "bytes_mensais", price)


def recommendations(
    tables: DataFrame, usage_row: DataFrame, storage_row: DataFrame, scenario_row: DataFrame
) -> DataFrame:
    """``(ordem, recomendacao)``: the advice whose condition holds, in rule order.

    Only names of tables are gathered, one per catalogue entry.
    """
    name = F.concat_ws(".", "dataset", "tabela")
    large = F.col("bytes_totais")

    def offenders(test: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(test, name))), ", ")

    unpartitioned = (large >= V.PARTITION_ADVICE_BYTES) & ~F.col("particionada")
    unclustered = (large >= V.CLUSTER_ADVICE_BYTES) & (F.col("clusterizacao") == V.NOT_CLUSTERED)
    short_lived = F.col("expiracao_padrao_dataset_dias") <= V.SHORT_RETENTION_DAYS
    about_tables = tables.agg(
        offenders(unpartitioned).alias("_partition"),
        offenders(unclustered).alias("_cluster"),
        F.coalesce(F.bool_or(short_lived), F.lit(False)).alias("_short"),
    )

    def wrapped(names: str, text: tuple[str, str]) -> Column:
        return F.when(F.col(names) != "", F.concat(F.lit(text[0]), F.col(names), F.lit(text[1])))

    def either(test: Column, yes: str, no: str) -> Column:
        return F.when(test, yes).otherwise(no)

    used = tib(F.col("bytes_faturados")) <= V.FREE_QUERY_TIB
    parts = [
        _advice(
            about_tables,
            {
                1: wrapped("_partition", V.ADVICE_PARTITION),
                2: wrapped("_cluster", V.ADVICE_CLUSTER),
                6: F.when(F.col("_short"), V.ADVICE_RETENTION),
                **{7 + i: F.lit(text) for i, text in enumerate(V.ADVICE_ALWAYS)},
            },
        ),
        _advice(
            storage_row,
            {3: either(F.col("gib_totais") <= V.FREE_STORAGE_GIB, V.ADVICE_STORAGE_FREE, V.ADVICE_STORAGE_PAID)},
        ),
        _advice(
            usage_row,
            {
                4: F.when(~F.col("disponivel"), V.ADVICE_USAGE_UNKNOWN).otherwise(
                    either(used, V.ADVICE_USAGE_FREE, V.ADVICE_USAGE_PAID)
                )
            },
        ),
        _advice(
            scenario_row,
            {5: either(F.col("tib_mensais") <= V.FREE_QUERY_TIB, V.ADVICE_SCENARIO_FREE, V.ADVICE_SCENARIO_PAID)},
        ),
    ]
    return reduce(DataFrame.unionAll, parts).where(F.col("recomendacao").isNotNull()).orderBy("ordem")


def _advice(row: DataFrame, texts: dict[int, Column]) -> DataFrame:
    entries = [F.struct(F.lit(n).alias("ordem"), text.alias("recomendacao")) for n, text in texts.items()]
    return row.select(F.inline(F.array(*entries)))
