"""The event consumer: validate, keep the last event of a key in a batch, skip keys already stored, append.

Within a batch the last line of a key wins; across batches the first batch wins. Both hold in batch and in stream mode.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from litmark.operators.keys import latest_per_key, unseen_keys
from litmark.sources.lines import mark_positions, number_lines, scan_lines
from litmark.sources.publish import put_in_place, staging_folder
from litmark.streaming.events import EventRules, invalid_events, parse_events, valid_events
from litmark.streaming.store import BATCH, EventStore, add_batch, compact, met_buckets, possible_history, stored_events

__all__ = ["BATCH", "EventStore", "InvalidEventsError", "consume", "counters", "keep_last", "merge_batches", "replay_all", "start_stream", "stored_events"]


class InvalidEventsError(ValueError):
    """A batch holds invalid events and the consumer was told to stop on them."""


def keep_last(events: DataFrame) -> DataFrame:
    """The last event of each key, by file name and line number."""
    order = [F.col("arquivo_origem"), F.col("numero_linha_origem")]
    return latest_per_key(events, ["event_id"], order).select(*events.columns)


def merge_batches(events: DataFrame, first: Column) -> DataFrame:
    """What is stored of valid ``events`` after a batch of those with ``first`` and then a batch of all, in one pass.

    Of a key's events in the first batch the last one stays; of a key that only the second batch holds, the last one of all.
    """
    rest = [c for c in events.columns if c != "event_id"]
    order = F.struct("arquivo_origem", "numero_linha_origem")
    row = F.struct(*rest)
    kept = events.groupBy("event_id").agg(
        F.coalesce(F.max_by(F.when(first, row), F.when(first, order)), F.max_by(row, order)).alias("_row")
    )
    return kept.select("event_id", *[F.col("_row")[c].alias(c) for c in rest]).select(*events.columns)


def counters(parsed: DataFrame, stored: Column) -> DataFrame:
    """One row: valid, invalid, repeated in the batch, already stored, new; one pass over the parsed batch.

    ``stored`` tells of a row whether its key is in the history by it. Invalid events share the key NULL, of which each task sends one row.
    """
    valid = F.col("regra").isNull()
    key = F.when(valid, F.col("event_id")).alias("_key")
    keys = parsed.groupBy(key).agg(F.count("*").alias("n"), F.max(F.coalesce(valid & stored, F.lit(False))).alias("_known"))
    known = F.col("_key").isNotNull()
    total = keys.agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("validos"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("invalidos"),
        F.count_if(known).alias("_unicos"),
        F.count_if(known & F.col("_known")).alias("ja_processados"),
    )
    return total.select(
        "validos",
        "invalidos",
        (F.col("validos") - F.col("_unicos")).alias("duplicados_no_lote"),
        "ja_processados",
        (F.col("_unicos") - F.col("ja_processados")).alias("novos"),
    )


def consume(
    lines: DataFrame,
    store: EventStore,
    batch: str,
    rules: EventRules | None = None,
    fail_fast: bool = False,
) -> dict[str, int]:
    """Store one batch of scanned lines under the name ``batch`` and return its counters.

    Running a batch again under the same name replaces what it wrote, so a retry after a lost executor or driver
    neither loses nor repeats events.
    """
    spark = lines.sparkSession
    last = None
    marked = mark_positions(lines)
    parsed = parse_events(marked, rules, keep_blank=True, fenced=False)
    # What was parsed is kept as one column of whole rows: columns of their own would each be encoded and decoded again.
    where = [c for c in marked.columns if c != "value"]
    packed = parsed.select(*where, F.struct(*[c for c in parsed.columns if c not in where]).alias("_parsed")).persist()
    parsed = packed.select(*where, "_parsed.*")
    try:
        numbered = number_lines(parsed).where("NOT em_branco")
        counts = parsed.where("NOT em_branco").agg(
            F.count_if(F.col("regra").isNull()).alias("validos"),
            F.count_if(F.col("regra").isNotNull()).alias("invalidos"),
        ).first()
        valid_rows, invalid_rows = counts["validos"], counts["invalidos"]
        if invalid_rows and fail_fast:
            raise InvalidEventsError(f"{invalid_rows} invalid events; nothing was stored")
        if invalid_rows:
            _write_batch(invalid_events(numbered), store.rejected, batch)
        unique = 0
        if not valid_rows:
            stored = add_batch(spark, store, None, 0, batch)
        else:
            last = keep_last(valid_events(numbered)).persist()
            met, _ = met_buckets(spark, store, last)
            unique = sum(met.values())
            history = possible_history(spark, store, last, met, batch)
            new = last if history is None else unseen_keys(last, history, "event_id")
            stored = add_batch(spark, store, new, unique, batch)
    finally:
        if last is not None:
            last.unpersist()
        packed.unpersist()
    totals = {
        "validos": valid_rows,
        "invalidos": invalid_rows,
        "duplicados_no_lote": valid_rows - unique,
        "ja_processados": unique - stored,
        "novos": stored,
    }
    schema = ", ".join(f"{name} long" for name in totals)
    _write_batch(spark.createDataFrame([tuple(totals.values())], schema), store.counters, batch)
    compact(spark, store)  # last: while a batch is not counted as run, its rows must lie in a segment of its own
    return totals


def _write_batch(df: DataFrame, path: str, batch: str) -> None:
    target = f"{path}/{BATCH}={batch}"
    staged = staging_folder(target)
    df.write.option("compression", "zstd").parquet(staged)
    put_in_place(df.sparkSession, staged, target)


def replay_all(
    spark: SparkSession,
    source: str,
    store: EventStore,
    batch: str,
    glob: str | None = None,
    rules: EventRules | None = None,
    fail_fast: bool = False,
) -> dict[str, int]:
    """Batch mode: read every file again, store what is not stored yet. Fits files that grow by appending."""
    return consume(scan_lines(spark.read, source, glob), store, batch, rules, fail_fast)


def start_stream(
    spark: SparkSession,
    source: str,
    store: EventStore,
    checkpoint: str,
    glob: str | None = None,
    rules: EventRules | None = None,
    fail_fast: bool = False,
    files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
    trigger: dict | None = None,
    after_batch: Callable[[dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Stream mode: each new file is read once. By default the query stops when all present files are read.

    A long backlog is taken in batches of at most ``files_per_batch`` files or ``bytes_per_batch`` (such as ``"500g"``).
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)

    def store_batch(rows: DataFrame, epoch: int) -> None:
        stream = json.loads(rows.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        totals = consume(rows, store, f"{stream}-{epoch:09d}", rules, fail_fast)
        if after_batch:
            after_batch(totals)

    return (
        scan_lines(reader, source, glob)
        .writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
