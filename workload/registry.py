"""Registered queries and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from litmark.session import apply_settings
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as the query of its own name, compared with ``sql`` if given."""

    def register(function):
        QUERIES[function.__name__] = lambda spark, folder: function(apply_settings(spark), folder)
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; its schema is looked up once per file."""
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """A fixture: ``sql`` names the given tables as ``{orders}`` and so on."""
    used = {t: table(spark, folder, t) for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SQL with bare table names, for the comparison side."""
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql
