"""Dated snapshots: ``<table>/<date column>=YYYY-MM-DD`` and ``<table>/ano=Y/<date column>=YYYY-MM-DD``.

Each run writes folders ``versao=…`` of its own below the dated ones, counts them, and then commits them (``commits``): the newest
commit file names the version of every snapshot, of all years of a run at once. A run that fails or dies anywhere leaves the snapshots
as they were. Finding the newest snapshot reads that file; no data folder is listed and no data file opened for it. Dated folders that
other programs wrote are found by their names, if they hold Spark's success mark (with years: files).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from litmark.sources.commits import commit, last_commit
from litmark.sources.publish import child_names
from litmark.sources.sinks import reconcile

BRONZE_DATE = "data_ingestao"
SILVER_DATE = "data_processamento"
VERSION = "versao"


def extract(spark: SparkSession, source: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A whole source: a table name (``fmt="table"``) or a path in any format Spark reads."""
    return spark.table(source) if fmt == "table" else spark.read.format(fmt).options(**options).load(source)


def extract_year(source: DataFrame, year: int, column: str = "ano") -> DataFrame:
    """The rows of one year; the predicate reaches the scan."""
    return source.where(F.col(column) == F.lit(year))


def query_year(spark: SparkSession, source: DataFrame, year: int) -> DataFrame:
    """The same extract as SQL with a bound parameter."""
    return spark.sql("SELECT * FROM {source} WHERE ano = :ano", args={"ano": year}, source=source)


def read_by_name(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files united by column name; missing columns are NULL, folder values are not added."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)


def union_by_name(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of one folder level, greatest first."""
    return sorted((n.partition("=")[2] for n in child_names(spark, path) if n.startswith(f"{column}=")), reverse=True)


def _committed(spark: SparkSession, path: str) -> dict[str, str]:
    """Folder of every committed snapshot, both below ``path``."""
    return last_commit(spark, path)[1].get("snapshots", {})


def _dated(spark: SparkSession, path: str, column: str) -> Iterator[tuple[str, str]]:
    """Date and folder of the snapshots of a table, newest first; folders are looked into only as far as asked for."""
    known = {k.partition("=")[2]: v for k, v in _committed(spark, path).items() if k.startswith(f"{column}=")}
    for date in sorted({*known, *_values(spark, path, column)}, reverse=True):
        if date in known:
            yield date, f"{path}/{known[date]}"
        elif "_SUCCESS" in child_names(spark, f"{path}/{column}={date}"):
            yield date, f"{path}/{column}={date}"


def _newest(spark: SparkSession, path: str, column: str) -> tuple[str, str]:
    for found in _dated(spark, path, column):
        return found
    raise FileNotFoundError(f"no {column}=… snapshot below {path}")


def latest_snapshot(spark: SparkSession, path: str, column: str) -> str:
    """The greatest snapshot value that was written to the end."""
    return _newest(spark, path, column)[0]


def newest_folder(spark: SparkSession, path: str, column: str = BRONZE_DATE) -> str:
    return _newest(spark, path, column)[1]


def snapshot_folder(spark: SparkSession, path: str, date: str, column: str = BRONZE_DATE) -> str:
    """Where the snapshot of one date lies."""
    known = _committed(spark, path).get(f"{column}={date}", f"{column}={date}")
    return f"{path}/{known}"


def read_latest(spark: SparkSession, path: str, column: str = BRONZE_DATE) -> DataFrame:
    """The newest snapshot, without the snapshot column. One job wrote it, so one footer gives its schema."""
    return spark.read.parquet(newest_folder(spark, path, column))


def _newest_per(spark: SparkSession, path: str, column: str, by: str) -> list[tuple[str, str, str]]:
    """Value of ``by``, date and folder of the newest snapshot of each value: a handful of years."""
    known: dict[str, dict[str, str]] = {}
    for name, folder in _committed(spark, path).items():
        if name.startswith(f"{by}="):
            value, _, date = name.partition("/")
            known.setdefault(value.partition("=")[2], {})[date.partition("=")[2]] = folder
    found = []
    for value in sorted({*known, *_values(spark, path, by)}):
        own = known.get(value, {})
        for date in sorted({*own, *_values(spark, f"{path}/{by}={value}", column)}, reverse=True):
            plain = f"{by}={value}/{column}={date}"
            if date in own or any(n.endswith(".parquet") for n in child_names(spark, f"{path}/{plain}")):
                found.append((value, date, f"{path}/{own.get(date, plain)}"))
                break
    if not found:
        raise FileNotFoundError(f"no {by}=…/{column}=… snapshot below {path}")
    return found


def latest_snapshots(spark: SparkSession, path: str, column: str, by: str = "ano") -> list[tuple[str, str]]:
    """The greatest snapshot of each value of ``by``: one pair per value."""
    return [(value, date) for value, date, _ in _newest_per(spark, path, column, by)]


def newest_folders(spark: SparkSession, path: str, column: str = BRONZE_DATE, by: str = "ano") -> list[str]:
    return [folder for _, _, folder in _newest_per(spark, path, column, by)]


def read_latest_per(
    spark: SparkSession, path: str, column: str = BRONZE_DATE, by: str = "ano", only: list[str] | None = None
) -> DataFrame:
    """The newest snapshot of each ``by`` value; ``by`` stays a column, the snapshot column does not.

    Folders with the same schema are one scan; otherwise they are united by name. Only one footer per folder is read for it.
    """
    folders = [folder for value, _, folder in _newest_per(spark, path, column, by) if only is None or value in only]
    reader = spark.read.option("basePath", path)
    frames = [reader.parquet(folder) for folder in folders]
    if all(df.schema == frames[0].schema for df in frames):
        return reader.schema(frames[0].schema).parquet(*folders).drop(column, VERSION)
    return union_by_name(*frames).drop(column, VERSION)


def write_snapshot(
    df: DataFrame, path: str, date: str, column: str = BRONZE_DATE, rows_per_file: int | None = None
) -> int:
    """Replace one dated snapshot (other dates stay); returns the rows written.

    The rows counted while writing must be those that the written footers hold before the snapshot is committed.
    """
    spark = df.sparkSession
    name = f"{column}={date}"
    folder = f"{name}/{_new_version()}"
    written = Observation("written")
    _writer(df.observe(written, F.count("*").alias("rows")), rows_per_file).parquet(f"{path}/{folder}")
    rows = written.get["rows"]
    reconcile(f"{path}/{name}", rows, spark.read.schema(df.schema).parquet(f"{path}/{folder}").count())
    _commit(spark, path, {name: folder})
    return rows


def _new_version() -> str:
    return f"{VERSION}=v{uuid.uuid4().hex}"


def _commit(spark: SparkSession, path: str, made: dict[str, str]) -> None:
    """The snapshots ``made`` are valid from now on, all of them at once, and the folders they replace go.

    Those are the committed ones, what runs that died have left behind, and files of other programs in the same dated folder.
    """
    number, state = last_commit(spark, path)
    replaced = []
    for name, folder in made.items():
        own = folder.rpartition("/")[2]
        replaced += [f"{name}/{n}" for n in child_names(spark, f"{path}/{name}") if n != own]
    commit(spark, path, number, {**state, "snapshots": {**state.get("snapshots", {}), **made}}, replaced)


def write_yearly_snapshot(
    df: DataFrame,
    path: str,
    date: str,
    column: str = BRONZE_DATE,
    by: str = "ano",
    rows_per_file: int | None = None,
) -> int:
    """Replace the dated snapshot of each year present in ``df``, of all these years or of none; returns the rows written.

    Rows are rebalanced by year before writing: small pieces are merged and an oversized year is split over tasks. The rows counted
    while writing must be those that the written footers hold; one commit then names the new folders of all years.
    """
    spark = df.sparkSession
    written = Observation("written")
    version = _new_version()
    rows = (
        df.withColumns({column: F.lit(date), VERSION: F.lit(version.partition("=")[2])})
        .hint("rebalance", by)
        .observe(written, F.count("*").alias("rows"))
    )
    _writer(rows, rows_per_file, "append").partitionBy(by, column, VERSION).parquet(path)
    made = {}
    for value in _values(spark, path, by):
        name = f"{by}={value}/{column}={date}"
        if version in child_names(spark, f"{path}/{name}"):
            made[name] = f"{name}/{version}"
    count = written.get["rows"]
    if made:
        stored = spark.read.schema(df.drop(by).schema).parquet(*[f"{path}/{folder}" for folder in made.values()])
        reconcile(path, count, stored.count())
        _commit(spark, path, made)
    return count


def _writer(df: DataFrame, rows_per_file: int | None, mode: str = "error"):
    writer = df.write.mode(mode).option("compression", "zstd")
    return writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer
