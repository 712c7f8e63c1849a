"""Where accepted events lie: segments in buckets by a hash of the key, each with a filter, under one commit.

Every batch adds a segment of its own. A segment has as many buckets (a power of two) as keep a bucket small, so the number of
buckets grows by splitting when segments are merged. Beside each bucket lies its filter: one 32-bit print per key. A batch reads the
filters of the buckets that can hold its keys, and opens only the buckets of which some print matches; those are then compared
exactly. What a batch reads therefore follows its own keys, not the history. When a size class holds ``fanout`` segments they are
merged into one of the next class, so there are few segments and small files, and a row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from litmark.sources.commits import commit, last_commit
from litmark.sources.publish import child_names
from litmark.streaming.events import EVENT_SCHEMA

BATCH, BUCKET, SEGMENT = "lote", "balde", "segmento"
EVENTS, FILTERS, REJECTED, COUNTERS = "eventos", "filtros", "rejeitados", "contadores"
#: Commits for which folders of merged segments stay, so that readers at work can finish.
GRACE = 2


@dataclass(frozen=True)
class EventStore:
    """Where events go: accepted rows, their filters, rejected rows, and counters, all below one folder.

    ``buckets`` is the least number of buckets of a segment, ``bucket_rows`` the rows from which a segment gets twice as many; both
    may change between runs.
    """

    path: str
    buckets: int = 1
    bucket_rows: int = 100_000
    fanout: int = 8

    @property
    def accepted(self) -> str:
        return f"{self.path}/{EVENTS}"

    @property
    def filters(self) -> str:
        return f"{self.path}/{FILTERS}"

    @property
    def rejected(self) -> str:
        return f"{self.path}/{REJECTED}"

    @property
    def counters(self) -> str:
        return f"{self.path}/{COUNTERS}"

    def level(self, rows: int) -> int:
        """A segment of ``rows`` rows has 2 ** level buckets."""
        needed = max(self.buckets, -(-rows // self.bucket_rows), 1)
        return min((needed - 1).bit_length(), 30)


def _hash() -> Column:
    return F.xxhash64("event_id")


def bucket(hashed: Column, level: int | Column) -> Column:
    """Bucket of a hashed key in a segment of 2 ** level buckets; splitting a bucket only looks at one more bit."""
    size = F.lit(1 << level) if isinstance(level, int) else F.call_function("shiftleft", F.lit(1), level)
    return hashed.bitwiseAND((size - 1).cast("long")).cast("int")


def _print(hashed: Column) -> Column:
    """The other half of the hash, of which the bucket is no part."""
    return F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def segments(spark: SparkSession, store: EventStore) -> list[dict]:
    """The valid segments: id, level, rows, the batch (none if merged), and names of batches whose rows in it no longer count."""
    return last_commit(spark, store.path)[1].get("segments", [])


def _folders(spark: SparkSession, root: str, segment: dict, wanted) -> list[str]:
    """Bucket folders of a segment for which ``wanted(bucket)`` holds."""
    names = child_names(spark, f"{root}/{SEGMENT}={segment['id']}")
    return [f"{root}/{SEGMENT}={segment['id']}/{n}" for n in names if n.startswith(f"{BUCKET}=") and wanted(int(n.partition("=")[2]))]


def _rows(spark: SparkSession, store: EventStore, chosen: list[dict], folders: list[str], schema: str) -> DataFrame:
    """Rows of the given folders that still count. The schema is given, so no footer is read for it."""
    rows = spark.read.option("basePath", store.accepted).schema(f"{schema}, {BATCH} string, {SEGMENT} string, {BUCKET} int").parquet(*folders)
    for segment in chosen:
        if segment["dropped"]:
            rows = rows.where((F.col(SEGMENT) != segment["id"]) | ~F.col(BATCH).isin(segment["dropped"]))
    return rows.drop(SEGMENT, BUCKET)


def stored_events(
    spark: SparkSession, store: EventStore, except_batch: str | None = None, buckets: list[int] | None = None
) -> DataFrame | None:
    """Accepted events of other batches, or None when there are none yet.

    ``buckets`` are numbers below ``store.buckets``: the buckets of those keys, into however many a segment has split them.
    """
    chosen = segments(spark, store)
    if buckets is None:
        folders = [f"{store.accepted}/{SEGMENT}={s['id']}" for s in chosen]
    else:
        base = 1 << store.level(0)
        folders = [f for s in chosen for f in _folders(spark, store.accepted, s, lambda b: b % base in set(buckets))]
    if not folders:
        return None
    rows = _rows(spark, store, chosen, folders, EVENT_SCHEMA)
    return rows if except_batch is None else rows.where(~F.col(BATCH).eqNullSafe(except_batch))


def met_buckets(spark: SparkSession, store: EventStore, keys: DataFrame) -> tuple[dict[int, int], int]:
    """Rows of ``keys`` by bucket, at the level of the finest segment, and that level."""
    level = max([s["level"] for s in segments(spark, store)], default=store.level(0))
    met = keys.groupBy(bucket(_hash(), level).alias(BUCKET)).agg(F.count("*").alias("n")).collect()
    return {r[BUCKET]: r["n"] for r in met}, level


def possible_history(spark: SparkSession, store: EventStore, keys: DataFrame, met: dict[int, int], except_batch: str | None = None) -> DataFrame | None:
    """``event_id`` of the stored buckets in which the filters find prints of ``keys``; None if there is no such bucket.

    Holds every stored event of these keys that another batch has written, and others. ``met`` comes from ``met_buckets``.
    """
    chosen = [s for s in segments(spark, store) if except_batch is None or s["batch"] != except_batch]
    folders = []
    for s in chosen:
        own = {b & ((1 << s["level"]) - 1) for b in met}
        folders += _folders(spark, store.filters, s, own.__contains__)
    if not folders:
        return None
    prints = spark.read.option("basePath", store.filters).schema(f"impressao int, {SEGMENT} string, {BUCKET} int").parquet(*folders)
    level = F.create_map(*[F.lit(x) for s in chosen for x in (s["id"], s["level"])])[F.col(SEGMENT)]
    asked = keys.select(_hash().alias("_hash"), _print(_hash()).alias("impressao"))
    hits = prints.join(asked, "impressao").where(F.col(BUCKET) == bucket(F.col("_hash"), level))
    found = {(r[SEGMENT], r[BUCKET]) for r in hits.select(SEGMENT, BUCKET).distinct().collect()}
    if not found:
        return None
    opened = [f"{store.accepted}/{SEGMENT}={s}/{BUCKET}={b}" for s, b in sorted(found)]
    rows = _rows(spark, store, chosen, opened, "event_id string")
    return (rows if except_batch is None else rows.where(~F.col(BATCH).eqNullSafe(except_batch))).select("event_id")


def _write_segment(spark: SparkSession, store: EventStore, rows: DataFrame, level: int, batch: str | None) -> dict:
    """A new segment, not committed yet: rows by bucket, and their prints, made from the files just written."""
    name = f"s{uuid.uuid4().hex}"
    folder = f"{store.accepted}/{SEGMENT}={name}"
    sent = Observation("sent")
    placed = rows.withColumn(BUCKET, bucket(_hash(), level)).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, "event_timestamp_utc")
    placed.observe(sent, F.count("*").alias("rows")).write.option("compression", "zstd").partitionBy(BUCKET).parquet(folder)
    segment = {"id": name, "level": level, "rows": sent.get["rows"], "batch": batch, "dropped": []}
    if segment["rows"]:
        keys = spark.read.schema(f"event_id string, {BUCKET} int").parquet(folder)
        prints = keys.select(_print(_hash()).alias("impressao"), BUCKET).sortWithinPartitions(BUCKET, "impressao")
        prints.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{store.filters}/{SEGMENT}={name}")
    return segment


def _commit(spark: SparkSession, store: EventStore, number: int, state: dict, kept: list[dict], gone: list[dict]) -> None:
    names = [f"{kind}/{SEGMENT}={s['id']}" for s in gone for kind in (EVENTS, FILTERS)]
    commit(spark, store.path, number, {**state, "segments": kept}, names, GRACE)


def add_batch(spark: SparkSession, store: EventStore, rows: DataFrame | None, count: int, batch: str) -> int:
    """Store the rows of a batch (or none) in place of those an earlier try has stored, and return their number.

    ``count`` is an estimate of the rows, which decides the number of buckets. All is valid from one commit on.
    """
    number, state = last_commit(spark, store.path)
    made = {"rows": 0}
    if rows is not None:
        made = _write_segment(spark, store, rows.withColumn(BATCH, F.lit(batch)), store.level(count), batch)
    kept = [s for s in state.get("segments", []) if s["batch"] != batch]
    gone = [s for s in state.get("segments", []) if s["batch"] == batch]
    if f"{BATCH}={batch}" in child_names(spark, store.counters):  # an earlier try may have been merged since
        kept = [s if s["batch"] is not None else {**s, "dropped": sorted({*s["dropped"], batch})} for s in kept]
    if "id" in made:
        (kept if made["rows"] else gone).append(made)
    if kept != state.get("segments", []) or gone:
        _commit(spark, store, number, state, kept, gone)
    return made["rows"]


def _size_class(store: EventStore, segment: dict) -> int:
    size, rows = 0, segment["rows"]
    while rows >= store.fanout:
        size, rows = size + 1, rows // store.fanout
    return size


def compact(spark: SparkSession, store: EventStore) -> int:
    """Merge size classes that hold ``fanout`` segments or more; returns how many segments are left.

    Readers see the segments before or the merged one. A merge that dies leaves folders that no commit names.
    """
    while True:
        number, state = last_commit(spark, store.path)
        every = state.get("segments", [])
        classes: dict[int, list[dict]] = {}
        for s in every:
            classes.setdefault(_size_class(store, s), []).append(s)
        full = next((members for _, members in sorted(classes.items()) if len(members) >= store.fanout), None)
        if full is None:
            return len(every)
        folders = [f"{store.accepted}/{SEGMENT}={s['id']}" for s in full]
        rows = _rows(spark, store, full, folders, EVENT_SCHEMA)
        made = _write_segment(spark, store, rows, store.level(sum(s["rows"] for s in full)), None)
        kept = [s for s in every if s not in full]
        _commit(spark, store, number, state, kept + ([made] if made["rows"] else []), full + ([] if made["rows"] else [made]))
