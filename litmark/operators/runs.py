"""Run records: layer metrics, stage rows, run summaries, alerts."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmark import fixed_values as V
from litmark.functions.text import one_line
from litmark.sources.lines import count_rows_by_file, has_files
from litmark.sources.sinks import write_json_lines

LAYERS = ["bronze", "silver", "gold"]
LAYER_METRICS = "struct<arquivos: long, bytes: long, registros: long, ilegiveis: long>"

STAGE_SCHEMA = (
    "run_id string, etapa string, descricao string, status string, "
    "inicio_utc timestamp, fim_utc timestamp, duracao_segundos double"
)

RUN_SCHEMA = (
    "run_id string, perfil string, status string, inicio_utc timestamp, fim_utc timestamp, duracao_segundos double, "
    "etapas_planejadas int, etapas_executadas int, etapas_com_sucesso int, etapas_com_falha int, "
    f"metricas_antes map<string, {LAYER_METRICS}>, metricas_depois map<string, {LAYER_METRICS}>, "
    "resultados_etapas array<struct<etapa: string, descricao: string, status: string, inicio_utc: timestamp, "
    "fim_utc: timestamp, duracao_segundos: double>>"
)


def layer_files(spark: SparkSession, path: str) -> DataFrame:
    """``(arquivo, bytes)`` of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("arquivo"), F.col("length").alias("bytes"))
    )


def layer_metrics(spark: SparkSession, root: str, layers: list[str] | None = None) -> DataFrame:
    """``(camada, arquivos, bytes, registros, ilegiveis)`` per layer folder below ``root``; a missing layer is all zeros.

    ``ilegiveis`` counts the files that could not be read: unless it is 0, ``registros`` lacks their rows.
    """
    layers = layers or LAYERS
    schema = "camada string, arquivos long, bytes long, registros long, ilegiveis long"
    parts = [spark.createDataFrame([(layer, 0, 0, 0, 0) for layer in layers], schema)]
    zero = F.lit(0).cast("long")
    for layer in layers:
        path = f"{root}/{layer}"
        if has_files(spark, path):
            name = F.lit(layer)
            sizes = layer_files(spark, path).agg(F.count("*").alias("arquivos"), F.sum("bytes").alias("bytes"))
            rows = count_rows_by_file(spark, path).agg(
                F.coalesce(F.sum("registros"), zero).alias("registros"), F.count("erro").alias("ilegiveis")
            )
            parts.append(sizes.select(name, "arquivos", "bytes", zero, zero))
            parts.append(rows.select(name, zero, zero, "registros", "ilegiveis"))
    return (
        reduce(DataFrame.unionAll, parts)
        .groupBy("camada")
        .agg(*[F.sum(c).alias(c) for c in ("arquivos", "bytes", "registros", "ilegiveis")])
    )


def run_status(failed: Column) -> Column:
    return F.when(failed == 0, V.RUN_OK).otherwise(V.RUN_FAILED)


def stage_totals(stages: DataFrame) -> DataFrame:
    """Stage rows to one row per run: stages run, passed, failed, and the run status."""
    failed = F.count_if(F.col("status") == V.RUN_FAILED)
    return stages.groupBy("run_id").agg(
        F.count("*").alias("etapas_executadas"),
        F.count_if(F.col("status") == V.RUN_OK).alias("etapas_com_sucesso"),
        failed.alias("etapas_com_falha"),
        run_status(failed).alias("status"),
    )


def run_summary(records: DataFrame) -> DataFrame:
    """Nested run records to flat 15-column summaries (metrics after the run)."""
    after = F.col("metricas_depois")
    metrics = [
        after[layer][measure].alias(f"{layer}_{measure}") for measure in ("registros", "bytes") for layer in LAYERS
    ]
    return records.select(
        "run_id",
        "perfil",
        "status",
        "inicio_utc",
        "fim_utc",
        "duracao_segundos",
        "etapas_executadas",
        "etapas_com_sucesso",
        "etapas_com_falha",
        *metrics,
    )


def close_record(records: DataFrame) -> DataFrame:
    """Stage counts and run status filled in from the nested stages."""

    def stages_with(status: str) -> Column:
        return F.size(F.filter("resultados_etapas", lambda s: s["status"] == status))

    return records.withColumns(
        {
            "etapas_executadas": F.size("resultados_etapas"),
            "etapas_com_sucesso": stages_with(V.RUN_OK),
            "etapas_com_falha": stages_with(V.RUN_FAILED),
            "status": run_status(stages_with(V.RUN_FAILED)),
        }
    )


def alerts(stages: DataFrame, message: str = "mensagem") -> DataFrame:
    """One alert per failed stage: when it ended, which run and stage, and the message on one line."""
    return stages.where(F.col("status") == V.RUN_FAILED).select(
        F.col("fim_utc").alias("momento_utc"),
        F.col("run_id"),
        F.col("etapa"),
        one_line(F.col(message)).alias("mensagem"),
    )


def _now() -> datetime:
    return datetime.now(timezone.utc)


class RunLog:
    """Collects the stage rows of one run and appends run, summary and alerts to tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, profile: str, data_root: str):
        self.spark, self.path, self.run_id, self.profile, self.data_root = spark, path, run_id, profile, data_root
        self.started = _now()
        self.before = self._metrics()
        self.stages: list[tuple] = []

    def _metrics(self) -> dict[str, tuple]:
        rows = layer_metrics(self.spark, self.data_root).collect()
        return {r["camada"]: (r["arquivos"], r["bytes"], r["registros"], r["ilegiveis"]) for r in rows}

    def add_stage(self, name: str, description: str, started: datetime, error: str | None = None) -> None:
        ended = _now()
        status = V.RUN_FAILED if error else V.RUN_OK
        seconds = round((ended - started).total_seconds(), 3)
        self.stages.append((name, description, status, started, ended, seconds, error))

    def close(self) -> DataFrame:
        """Append everything and return the flat summary of this run."""
        ended = _now()
        record = (
            self.run_id, self.profile, None, self.started, ended,
            round((ended - self.started).total_seconds(), 3), len(self.stages), 0, 0, 0,
            self.before, self._metrics(), [s[:6] for s in self.stages],
        )
        records = close_record(self.spark.createDataFrame([record], RUN_SCHEMA))
        write_json_lines(records, f"{self.path}/historico", "append")
        summary = run_summary(records)
        summary.write.mode("append").parquet(f"{self.path}/resumo")
        rows = [(self.run_id, *s) for s in self.stages]
        stage_rows = self.spark.createDataFrame(rows, STAGE_SCHEMA + ", mensagem string")
        stage_rows.drop("mensagem").write.mode("append").parquet(f"{self.path}/etapas")
        alerts(stage_rows).write.mode("append").parquet(f"{self.path}/alertas")
        return summary
