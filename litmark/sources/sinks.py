"""Report and history sinks, and counted writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from litmark.sources.publish import put_in_place, staging_folder


class ReconciliationError(RuntimeError):
    """The rows that arrived differ from the rows that were sent."""


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """ZSTD Parquet; returns the rows written, counted during the write instead of by reading back.

    Overwriting writes aside and puts the folder in place at the end, so a failed write leaves the old one.
    """
    written = Observation("written")
    staged = staging_folder(path) if mode == "overwrite" else path
    df.observe(written, F.count("*").alias("rows")).write.mode(mode).option("compression", "zstd").parquet(staged)
    if staged != path:
        put_in_place(df.sparkSession, staged, path)
    return written.get["rows"]


def reconcile(name: str, sent: int, found: int) -> None:
    if sent != found:
        raise ReconciliationError(f"{name}: {sent} rows sent, {found} rows found")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, UTF-8, NULL fields kept. ``mode="append"`` adds new files and leaves old ones alone."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header. Meant for reports; they are small, so one file is written."""
    df.coalesce(1).write.mode(mode).option("header", True).option("escape", '"').csv(path)
