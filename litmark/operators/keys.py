"""Operators on keys: latest row, duplicates, orphans, profiles.

Every grouping below combines rows before the shuffle, so a key that holds a large share of the rows sends one partial
row per task, and no operator gathers the rows of a key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key (later order entries break ties)."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("quantidade")).where("quantidade > 1")


def count_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many keys occur more than once."""
    return duplicate_keys(df, keys).agg(F.count("*").alias("chaves_repetidas"))


def count_excess_rows(df: DataFrame) -> DataFrame:
    """One row: rows minus distinct rows, in one pass (each distinct row contributes its surplus copies)."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("linhas_excedentes"))


def orphan_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``left`` (without NULLs) that ``right`` lacks. Both sides are reduced to their keys before the shuffle."""
    return left.select(*keys).na.drop().distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def orphan_profile(left: DataFrame, right: DataFrame, key: str, year: str) -> DataFrame:
    """Rows and first/last year of each orphan key, most frequent first.

    Both sides are grouped before the join: it sees one row per key instead of every row of a frequent key.
    """
    profile = (
        left.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("*").alias("quantidade_registros"),
            F.min(year).alias("primeiro_ano"),
            F.max(year).alias("ultimo_ano"),
        )
    )
    orphans = profile.join(right.select(key).distinct(), key, "left_anti")
    return orphans.orderBy(F.desc("quantidade_registros"), F.asc_nulls_last(key))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per combination of values, in the order of the first column."""
    return (
        df.groupBy(*columns)
        .agg(F.count("*").alias("quantidade"))
        .orderBy(*[F.asc_nulls_last(c) for c in columns])
    )


def tally(df: DataFrame, column: str) -> DataFrame:
    """Rows per value."""
    return df.groupBy(column).agg(F.count("*").alias("quantidade"))


def unseen_keys(batch: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows of a small ``batch`` whose key the large ``history`` lacks.

    An anti-join cannot broadcast its left side, so the history is first reduced to the keys of the batch by a semi-join,
    for which the adaptive planner broadcasts the batch keys if they are small. Give only the part of the history that can hold keys of the
    batch (see ``consumer.stored_events``).
    """
    seen = history.select(key).join(batch.select(key).distinct(), key, "left_semi").distinct()
    return batch.join(seen, key, "left_anti")
