"""Helpers that the text operators share: row numbers, saved tables, flat text batches, sorted groups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmark.session import scratch_folder

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


SPLITS = "spark.sql.files.minPartitionNum"


def pin_splits(spark: SparkSession) -> None:
    """Files are split alike for the rest of the session.

    Unset, the split size follows the number of cores, which changes when executors come or go; then two scans would number rows otherwise.
    """
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """``row`` (a number of its own for every row, repeated rows included), then ``columns`` (all others are dropped).

    Numbers follow the place of a row in the scan, so ``docs`` must be a table that is read, not the result of a shuffle.
    """
    pin_splits(docs.sparkSession)
    return docs.select(F.monotonically_increasing_id().alias("row"), *columns)


def keep_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose number by ``numbered`` is in ``rows``."""
    pin_splits(docs.sparkSession)
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("doc"))
    return whole.join(rows.select("row"), "row", "left_semi").select("doc.*")


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(frame: DataFrame, name: str, cleaned: bool = False) -> DataFrame:
    """``frame`` written as a table into the folder that the cluster shares, and read again: a cut in the lineage.

    With ``cleaned`` the shuffle files of the write are deleted when it ends, not when the driver next collects its garbage.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, name)
    before = spark.conf.get(_CLEANED, "false")
    spark.conf.set(_CLEANED, "true" if cleaned else before)
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.set(_CLEANED, before)
    return spark.read.schema(frame.schema).parquet(folder)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end (null as empty), and the n + 1 places where texts begin and end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring places of ``at``; stretches may be empty."""
    total = np.zeros(len(at) - 1, np.float64 if values.dtype.kind == "f" else np.int64)
    some = at[:-1] < at[1:]
    if some.any():
        total[some] = np.add.reduceat(values, at[:-1][some], dtype=total.dtype)
    return total


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], weight: Callable[[pa.Table], int], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``keys``; cut at the first group end past ``most`` weight."""
    held: list[pa.Table] = []
    heavy = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if held and heavy >= most:
            same = np.ones(table.num_rows, bool)
            for key in keys:
                same &= table[key].to_numpy() == held[-1][key][-1].as_py()
            ends = table.num_rows if same.all() else int(np.argmin(same))
            if ends < table.num_rows:
                yield pa.concat_tables([*held, table.slice(0, ends)]).combine_chunks()
                held, heavy, table = [], 0, table.slice(ends)
        held.append(table)
        heavy += weight(table)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the links (a, b) reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: for every node of the links (a, b) the smallest node of its component.

    Large and small stars in turn: every node hands its lowest neighbour to the others. Minima are aggregated before the
    shuffle and joined back, so no node's neighbours are gathered anywhere; each round is a saved table.
    """
    edges = saved(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        new = saved(small.select("e.*").where("a <> b").distinct(), "links")
        # Settled when every node has one link and no root hangs from another node.
        tally = new.agg(F.count("*").alias("n"), F.countDistinct("a").alias("nodes")).first()
        hanging = new.select("b").distinct().join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if tally.n == tally.nodes and hanging.isEmpty():
            break
        edges = new
    roots = new.select(F.col("b").alias("a"), "b").distinct()
    return new.union(roots).select(F.col("a").alias("node"), F.col("b").alias("root"))
