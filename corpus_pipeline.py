"""A corpus made ready for training: poor text, copies, near copies and benchmark leaks go, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

from litmark.llm.common import saved
from litmark.llm.exact import drop_exact
from litmark.llm.leaks import drop_leaks
from litmark.llm.packing import pack
from litmark.llm.quality import drop_poor
from litmark.llm.simhash import drop_near
from litmark.session import apply_settings
from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(spark: SparkSession) -> None:
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    _ready(spark)
    return drop_poor(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    _ready(spark)
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    _ready(spark)
    return drop_near(docs)


def leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    _ready(spark)
    return drop_leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    _ready(spark)
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact", exact),
    ("near", near),
    ("leaks", leaks),
    ("packing", packing),
]
# The quality classifier and SimHash cannot be written in SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of ``folder``; what each returns is written and read again for the next."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
