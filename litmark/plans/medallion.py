"""The table flow: Bronze snapshots, Silver tables, Gold tables, warehouse loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from litmark import fixed_values as V
from litmark.operators.cleaning import add_lineage, clean_reference, clean_students
from litmark.plans.indicators import comparison, evolution, indicator, target_columns, targets
from litmark.plans.quality import gold_report, silver_report
from litmark.session import sized_shuffles
from litmark.sources.catalog import create_database, load_table
from litmark.sources.lines import count_json_rows, has_files, read_strict_json
from litmark.sources.sinks import reconcile
from litmark.sources.snapshots import (
    BRONZE_DATE,
    SILVER_DATE,
    extract_year,
    newest_folder,
    newest_folders,
    read_latest,
    read_latest_per,
    snapshot_folder,
    write_snapshot,
    write_yearly_snapshot,
)


@dataclass(frozen=True)
class Layers:
    """Folders of the three layers below one root."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/batch/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def ingest_table(source: DataFrame, layers: Layers, table: str, date: str) -> int:
    """One reference table to a dated Bronze snapshot."""
    return write_snapshot(source, layers.bronze(table), date, BRONZE_DATE)


def ingest_students(
    source: DataFrame, layers: Layers, years: list[int], date: str, rows_per_file: int | None = None
) -> int:
    """The student rows of the given years to dated Bronze snapshots, one per year; ``rows_per_file`` bounds their files.

    All years are one job; the year predicate reaches the source scan.
    """
    wanted = extract_year(source, years[0]) if len(years) == 1 else source.where(F.col("ano").isin(years))
    path = layers.bronze(V.SILVER_STUDENTS)
    return write_yearly_snapshot(wanted, path, date, BRONZE_DATE, rows_per_file=rows_per_file)


def refine_table(spark: SparkSession, layers: Layers, table: str, date: str) -> dict[str, int]:
    """The newest Bronze snapshot of a reference table, cleaned, to Silver. The received rows are counted in
    the file footers, the saved rows while writing."""
    source = newest_folder(spark, layers.bronze(table), BRONZE_DATE)
    bronze = spark.read.parquet(source)
    silver = add_lineage(clean_reference(bronze))
    with sized_shuffles(spark, source):
        saved = write_snapshot(silver, layers.silver(table), date, SILVER_DATE)
    return _counts(bronze.count(), saved)


def refine_students(spark: SparkSession, layers: Layers, date: str, rows_per_file: int | None = None) -> dict[str, int]:
    """The newest Bronze snapshot of each year of the students, cleaned, to Silver."""
    bronze = read_latest_per(spark, layers.bronze(V.SILVER_STUDENTS), BRONZE_DATE)
    silver = add_lineage(clean_students(bronze))
    with sized_shuffles(spark, *newest_folders(spark, layers.bronze(V.SILVER_STUDENTS), BRONZE_DATE)):
        saved = write_yearly_snapshot(
            silver, layers.silver(V.SILVER_STUDENTS), date, SILVER_DATE, rows_per_file=rows_per_file
        )
    return _counts(bronze.count(), saved)


def _counts(received: int, saved: int) -> dict[str, int]:
    return {"recebidas": received, "duplicadas": received - saved, "salvas": saved}


def build_gold(
    spark: SparkSession,
    layers: Layers,
    date: str,
    years: tuple[int, int] = (2023, 2024),
    target_prefix: str = "meta_alfabetizacao_",
) -> dict[str, int]:
    """The four Gold tables from the newest Silver snapshots; returns the rows written to each.

    Indicator and targets are written first and read back, so the two derived tables do not repeat that work.
    """

    def save(df: DataFrame, table: str) -> int:
        return write_snapshot(df, layers.gold(table), date, SILVER_DATE)

    def saved(table: str) -> DataFrame:
        return spark.read.parquet(snapshot_folder(spark, layers.gold(table), date, SILVER_DATE))

    sources = {t: newest_folder(spark, layers.silver(t), SILVER_DATE) for t in (V.SILVER_RESULTS, V.SILVER_TARGETS)}
    municipal, wide = (spark.read.parquet(folder) for folder in sources.values())
    with sized_shuffles(spark, *sources.values()):
        counts = {
            V.GOLD_INDICATOR: save(indicator(municipal), V.GOLD_INDICATOR),
            V.GOLD_TARGETS: save(targets(wide, target_columns(wide, target_prefix)), V.GOLD_TARGETS),
        }
        results = saved(V.GOLD_INDICATOR)
        counts[V.GOLD_COMPARISON] = save(comparison(results, saved(V.GOLD_TARGETS)), V.GOLD_COMPARISON)
        counts[V.GOLD_EVOLUTION] = save(evolution(results, *years), V.GOLD_EVOLUTION)
    return counts


def check_silver(
    spark: SparkSession, layers: Layers, rows_per_year: dict[int, int], tables: list[str] | None = None
) -> DataFrame:
    """The Silver report over the newest snapshots."""
    tables = tables or V.REFERENCE_TABLES
    bronze = {t: read_latest(spark, layers.bronze(t), BRONZE_DATE) for t in tables}
    silver = {t: read_latest(spark, layers.silver(t), SILVER_DATE) for t in tables}
    bronze[V.SILVER_STUDENTS] = read_latest_per(spark, layers.bronze(V.SILVER_STUDENTS), BRONZE_DATE)
    silver[V.SILVER_STUDENTS] = read_latest_per(spark, layers.silver(V.SILVER_STUDENTS), SILVER_DATE)
    return silver_report(bronze, silver, rows_per_year)


def check_gold(spark: SparkSession, layers: Layers) -> DataFrame:
    """The Gold report over the newest snapshots."""
    names = [V.GOLD_INDICATOR, V.GOLD_TARGETS, V.GOLD_COMPARISON, V.GOLD_EVOLUTION]
    return gold_report(*[read_latest(spark, layers.gold(t), SILVER_DATE) for t in names])


def load_json_files(
    spark: SparkSession,
    source: str,
    schema: StructType,
    glob: str,
    table: str,
    description: str | None = None,
    labels: dict[str, str] | None = None,
) -> bool:
    """Line files into a table: strictly parsed, all files in one replacement, reconciled with the non-blank lines.

    The source is optional: without files nothing happens and False is returned.
    """
    if not has_files(spark, source, glob):
        return False
    loaded = load_table(read_strict_json(spark, source, schema, glob), table, description=description, labels=labels)
    lines = count_json_rows(spark, source, glob=glob).agg(F.coalesce(F.sum("registros"), F.lit(0))).first()[0]
    reconcile(table, lines, loaded)
    return True


def load_layer(
    frames: dict[str, DataFrame],
    database: str,
    layer: str,
    descriptions: dict[str, str] | None = None,
    clustering: dict[str, list[str]] | None = None,
    labels: dict[str, str] | None = None,
    location: str | None = None,
) -> dict[str, int]:
    """Tables of a layer into a database: replaced, clustered, described, labelled and reconciled."""
    spark = next(iter(frames.values())).sparkSession
    labels = {**(labels or {}), "camada": layer}
    create_database(spark, database, f"{layer} layer", labels, location)
    return {
        table: load_table(
            df,
            f"{database}.{table}",
            clustering=(clustering or {}).get(table),
            description=(descriptions or {}).get(table),
            labels=labels,
        )
        for table, df in frames.items()
    }
