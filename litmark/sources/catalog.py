"""Catalogue tables: databases, loads with reconciliation, clustering, metadata, inventory."""

from __future__ import annotations

import json
import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark import fixed_values as V
from litmark.functions.numbers import readable_bytes
from litmark.sources.commits import commit, last_commit
from litmark.sources.publish import child_names, folder_bytes, remove_folder, staging_folder
from litmark.sources.sinks import reconcile

RETENTION_PROPERTY = "retention_ms"
MILLIS_PER_DAY = 86_400_000.0


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in values.items())


def create_database(
    spark: SparkSession,
    name: str,
    description: str = "",
    labels: dict[str, str] | None = None,
    location: str | None = None,
) -> None:
    """Create a database if it is absent."""
    statement = f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_quoted(description)}"
    if location:
        statement += f" LOCATION {_quoted(location)}"
    if labels:
        statement += f" WITH DBPROPERTIES ({_properties(labels)})"
    spark.sql(statement)


def cluster(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in ranges of ``columns`` and sorted inside each task.

    The range key goes on with a hash of the whole row, so a value that fills a large share of the table is spread over several
    ranges instead of one task, and a repeated task deals its rows as before. Only rows that are equal in every column are told apart by
    their position; ``load_table`` counts what arrives before it replaces anything. Ranges are drawn from a sample, for which ``df`` is run once
    more: give a table that is read.
    """
    spread = {"_spread": F.xxhash64(*df.columns), "_place": F.monotonically_increasing_id()}
    return (
        df.withColumns(spread)
        .repartitionByRange(*columns, *spread)
        .sortWithinPartitions(*columns)
        .drop(*spread)
    )


def load_table(
    df: DataFrame,
    table: str,
    clustering: list[str] | None = None,
    partitioning: list[str] | None = None,
    description: str | None = None,
    labels: dict[str, str] | None = None,
) -> int:
    """Replace ``table`` with ``df`` and check that every row arrived; returns the row count.

    The rows go to a new folder of the table. Only when its footers hold as many rows as the source gave is the folder committed
    (``commits``) and the table pointed to it. A run that dies before leaves the old table; one that dies in between is finished by
    ``restore_tables`` or the next load. The folder that was replaced stays until the next load, for readers still at work.
    The source runs once: for clustering it is written as it comes, and what lies there is put into ranges.
    """
    spark = df.sparkSession
    home = _home(spark, table)
    version = f"v{uuid.uuid4().hex}"
    arrived = f"{home}/_entrada-{version}" if clustering else f"{home}/{version}"
    sent = Observation("sent")
    try:
        _files(df.observe(sent, F.count("*").alias("rows")), None if clustering else partitioning).parquet(arrived)
        if clustering:
            _files(cluster(spark.read.schema(df.schema).parquet(arrived), clustering), partitioning).parquet(f"{home}/{version}")
        stored = spark.read.schema(df.schema).parquet(f"{home}/{version}").count()
        reconcile(table, sent.get["rows"], stored)
        number, state = last_commit(spark, home)
        size = folder_bytes(spark, f"{home}/{version}")
        made = {"folder": version, "schema": df.schema.jsonValue(), "partitioning": partitioning or [], "rows": stored, "bytes": size}
        commit(spark, home, number, {**state, **made}, [state["folder"]] if "folder" in state else [], grace=1)
    except Exception:
        remove_folder(spark, f"{home}/{version}")
        raise
    finally:
        if clustering:
            remove_folder(spark, arrived)
    point_table(spark, table)
    describe_table(spark, table, description, {**(labels or {}), **_clustering_property(clustering)})
    return stored


def _files(rows: DataFrame, partitioning: list[str] | None):
    writer = rows.write.format("parquet").option("compression", "zstd")
    return writer.partitionBy(*partitioning) if partitioning else writer


def _home(spark: SparkSession, table: str) -> str:
    """Where the versions and commits of a table lie, in a hidden folder of its database."""
    database = table.rpartition(".")[0] or spark.catalog.currentDatabase()
    return f"{_versions(spark, database)}/{table.rpartition('.')[2].lower()}"


def _versions(spark: SparkSession, database: str) -> str:
    return f"{spark.catalog.getDatabase(database).locationUri}/_versoes"


def _state(spark: SparkSession, table: str) -> tuple[str, T.StructType, list[str]]:
    home = _home(spark, table)
    state = last_commit(spark, home)[1]
    if "folder" not in state:
        raise FileNotFoundError(f"{table} has no commit")
    return f"{home}/{state['folder']}", T.StructType.fromJson(state["schema"]), state["partitioning"]


def read_committed(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the newest commit of a table, whatever the catalogue says of it."""
    location, schema, _ = _state(spark, table)
    return spark.read.schema(schema).parquet(location)


def point_table(spark: SparkSession, table: str) -> None:
    """Make the catalogue show the newest commit of ``table``. May be repeated.

    While the columns stay, the new location is one change of the catalogue. A table that is new, or whose columns or partitioning change,
    is made empty first. Partitions are found in the folder, so none of them has a location of its own.
    """
    location, schema, partitioning = _state(spark, table)
    fields = [f for f in schema if f.name not in partitioning] + [schema[c] for c in partitioning]
    shape = [(f.name, f.dataType.simpleString()) for f in fields], partitioning
    old = None
    if spark.catalog.tableExists(table):
        known = _metadata(spark, table)
        old = known["location"]
        if shape != ([(f.name, f.dataType.simpleString()) for f in spark.table(table).schema], known.get("partition_columns") or []):
            # Dropping a table deletes the folder it shows, so it shows an empty one first.
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(staging_folder(location))}")
            spark.sql(f"DROP TABLE {table}")
            old = None if "/_versoes/" in old else old
    if not spark.catalog.tableExists(table):
        before = spark.conf.get(_TRACKED)
        spark.conf.set(_TRACKED, "false")
        try:
            _files(spark.createDataFrame([], schema), partitioning).saveAsTable(table)
        finally:
            spark.conf.set(_TRACKED, before)
        old = old or _metadata(spark, table)["location"]
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(location)}")
    spark.catalog.refreshTable(table)
    if old and "/_versoes/" not in old:
        remove_folder(spark, old)


_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def restore_tables(spark: SparkSession, database: str) -> list[str]:
    """Make the catalogue show every table of a database that has a commit; returns their names."""
    names = child_names(spark, _versions(spark, database))
    for name in names:
        point_table(spark, f"{database}.{name}")
    return names


def _metadata(spark: SparkSession, table: str) -> dict:
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def _clustering_property(clustering: list[str] | None) -> dict[str, str]:
    return {"clustering": ", ".join(clustering)} if clustering else {}


def describe_table(
    spark: SparkSession, table: str, description: str | None = None, labels: dict[str, str] | None = None
) -> None:
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(description)}")
    if labels:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_properties(labels)})")


def expected_objects(spark: SparkSession, expected: list[str], found: DataFrame, column: str) -> DataFrame:
    """``(objeto, situacao)``: OK or missing, for each expected name. The catalogue keeps names in lower case."""
    wanted = spark.createDataFrame([(n, n.lower()) for n in expected], "objeto string, _name string")
    listed = found.select(F.lower(column).alias("_name"), F.lit(True).alias("_found")).distinct()
    situation = F.when(F.col("_found"), "OK").otherwise("NÃO ENCONTRADA")
    return wanted.join(listed, "_name", "left").select("objeto", situation.alias("situacao"))


def tables_of(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


_METADATA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("created_time", T.StringType()),
        T.StructField("partition_columns", T.ArrayType(T.StringType())),
        T.StructField("table_properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField(
            "statistics",
            T.StructType([T.StructField("size_in_bytes", T.LongType()), T.StructField("num_rows", T.LongType())]),
        ),
    ]
)

INVENTORY_SCHEMA = (
    "dataset string, metadados string, expiracao_padrao_dataset_dias double, agora timestamp, _rows long, _bytes long"
)


def retention_days(spark: SparkSession, database: str) -> float | None:
    """Default table retention of a database in days, from its property in milliseconds."""
    listed = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").collect()}
    found = re.search(rf"(?:^\(|, )\({RETENTION_PROPERTY},\s*(\d+)\)(?:, \(|\)$)", listed.get("Properties", ""))
    return round(int(found.group(1)) / MILLIS_PER_DAY, 2) if found else None


def inventory(spark: SparkSession, names: list[str], long_term_days: int = 90) -> DataFrame:
    """One row per table of the named databases, from catalogue metadata; no data is read.

    Rows and bytes of tables that ``load_table`` made are those of their commits; for others run ``refresh_statistics`` first. A table
    untouched for ``long_term_days`` is long-term storage.
    """
    now = datetime.now(timezone.utc)
    described = []
    for database in names:
        days = retention_days(spark, database)
        for table in tables_of(spark, database).collect():
            statement = f"DESCRIBE TABLE EXTENDED {database}.{table['tableName']} AS JSON"
            kept = _loaded(spark, database, table["tableName"])
            described.append((database, spark.sql(statement).first()[0], days, now, kept.get("rows"), kept.get("bytes")))
    rows = spark.createDataFrame(described, INVENTORY_SCHEMA)
    meta = F.col("_meta")
    size = F.coalesce("_bytes", meta["statistics"]["size_in_bytes"], F.lit(0).cast("long"))
    created = F.to_timestamp(meta["created_time"], "yyyy-MM-dd'T'HH:mm:ssX")
    is_old = F.coalesce(created < F.col("agora") - F.make_dt_interval(F.lit(long_term_days)), F.lit(False))
    return rows.withColumn("_meta", F.from_json("metadados", _METADATA)).select(
        "dataset",
        meta["table_name"].alias("tabela"),
        F.coalesce(meta["type"], F.lit("TABLE")).alias("tipo"),
        F.coalesce("_rows", meta["statistics"]["num_rows"], F.lit(0).cast("long")).alias("linhas"),
        size.alias("bytes_totais"),
        F.when(is_old, F.lit(0).cast("long")).otherwise(size).alias("bytes_ativos"),
        F.when(is_old, size).otherwise(F.lit(0).cast("long")).alias("bytes_longo_prazo"),
        readable_bytes(size).alias("tamanho_legivel"),
        (F.coalesce(F.size(meta["partition_columns"]), F.lit(0)) > 0).alias("particionada"),
        F.coalesce(F.try_element_at(meta["table_properties"], F.lit("clustering")), F.lit(V.NOT_CLUSTERED)).alias(
            "clusterizacao"
        ),
        F.try_element_at(meta["table_properties"], F.lit("expiration")).alias("expiracao_tabela"),
        "expiracao_padrao_dataset_dias",
    )


def _loaded(spark: SparkSession, database: str, table: str) -> dict:
    """The commit of a table, if the catalogue shows what it names."""
    home = f"{_versions(spark, database)}/{table}"
    state = last_commit(spark, home)[1]
    shown = state and _metadata(spark, f"{database}.{table}")["location"].rstrip("/").endswith(f"/_versoes/{table}/{state['folder']}")
    return state if shown else {}


def refresh_statistics(spark: SparkSession, database: str) -> None:
    """Row counts and sizes of the tables of a database that were not made by ``load_table``, kept in the catalogue."""
    for table in tables_of(spark, database).collect():
        if not _loaded(spark, database, table["tableName"]):
            spark.sql(f"ANALYZE TABLE {database}.{table['tableName']} COMPUTE STATISTICS")
