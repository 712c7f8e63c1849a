"""Repeated byte strings: suffix arrays over shards of what may repeat.

Every string of ``LEAST`` bytes is a window; the smallest hash among its ``GRAM``-byte pieces depends on its bytes alone, so equal
windows have the same one. A span is a run of neighbouring windows of a document with one smallest hash. Only spans whose hash
occurs again can hold a repeated window, and equal spans need to be looked at once. The distinct ones are dealt to shards by hash.
A shard is sorted by Larsson-Sadakane refinement, its common prefixes come from Kasai's algorithm, and neighbours that share
``LEAST`` bytes are repeated windows. A hash with many distinct spans is dealt to several shards; each hands on the sorted digests
of its windows, and a merge finds by binary search those that another shard has too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import flat, numbered, saved, whole_groups

LEAST, GRAM = 200, 64
# Bytes hashed at a time, bytes sorted at a time, and what a shard of one hash holds: distinct spans, and bytes of them (a span has
# less than a stretch and a window). They bound memory, at some 120 bytes for every byte sorted, and change no result.
STRETCH, SHARD, SPANS, SPAN_BYTES = 1 << 18, 1 << 21, 256, 1 << 19
_TABLE = np.random.default_rng(77).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
EMPTY = hashlib.sha256(b"").hexdigest()


def _powers(count: int, base: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_UP = _powers(STRETCH + LEAST + 1, _BASE)
_DOWN = _powers(STRETCH + LEAST + 1, pow(_BASE, -1, 2**64))


def spans(data: np.ndarray, at: np.ndarray, least: int = LEAST, gram: int = GRAM):
    """Spans of the texts between the places ``at`` of ``data``: (start, windows, hash, inner).

    ``inner`` tells that the smallest hash occurs more than once in the span, so a window may repeat inside it.
    """
    none = np.zeros(0, np.int64)
    windows = len(data) - least + 1
    width = least - gram + 1
    if windows < 1:
        return none, none, none.view(np.uint64), none.astype(bool)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * _UP[: len(data)], dtype=np.uint64)])
        h = (total[gram:] - total[:-gram]) * _DOWN[: len(data) - gram + 1]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
    low, reach = h, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
    # A window is inside one text if no text begins within it, behind its first byte.
    opens = np.zeros(len(data) + 1, np.int64)
    np.add.at(opens, at[(at > 0) & (at < len(data))], 1)
    opened = np.cumsum(opens)
    inside = opened[least - 1 : least - 1 + windows] == opened[:windows]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (low[1:] != low[:-1]) | (opens[1:windows] > 0)
    start = np.flatnonzero(new)
    stop = np.flatnonzero(~inside)
    end = np.append(start[1:], windows)
    if len(stop):
        following = np.searchsorted(stop, start)
        end = np.minimum(end, np.append(stop, windows)[following])
    count, value = end - start, low[start]
    first, last = [np.zeros(len(start), np.int64) for _ in range(2)], [np.zeros(len(start), np.int64) for _ in range(2)]
    for tally, base in ((first, start), (last, end - 1)):
        for k in range(width):
            hit = h[base + k] == value
            tally[0] += hit
            tally[1] += np.where(hit, base + k, 0)
    inner = (count > width) | (first[0] > 1) | (last[0] > 1) | (first[1] != last[1])
    return start, count, value, inner


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = flat(batch["text"])
        rows = batch["row"].to_numpy()
        out = []
        low = 0
        while low < len(rows):
            high = max(low + 1, int(np.searchsorted(at, at[low] + STRETCH, "right")) - 1)
            begin, end = int(at[low]), int(at[high])
            # A long text goes in stretches that share LEAST - 1 bytes, so each of its windows is in one stretch.
            for a in range(begin, max(begin + 1, end - LEAST + 1), STRETCH):
                b = min(end, a + STRETCH + LEAST - 1)
                start, count, value, inner = spans(data[a:b], np.clip(at[low : high + 1], a, b) - a)
                owner = low + np.searchsorted(at[low : high + 1], start + a, "right") - 1
                out.append((rows[owner], start + a - at[owner], count, value.view(np.int64), inner))
            low = high
        if out:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            for k in range(0, len(columns[0]), 100_000):
                part = [pa.array(c[k : k + 100_000]) for c in columns]
                yield pa.RecordBatch.from_arrays([part[0], part[1].cast(pa.int32()), part[2].cast(pa.int32()), *part[3:]], ["row", "start", "count", "hash", "inner"])


def _meta_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = flat(batch["text"])
        sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], pa.array(np.diff(at)), pa.array(sha, pa.string())], ["row", "doc_id", "n", "sha"])


def _content_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = flat(batch["text"])
        names = ("row", "start", "hash", "inner", "digest", "content")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
        out: dict[str, list] = {n: [] for n in names}
        held = 0
        for row, begin, own in zip(batch["row"].to_pylist(), at[:-1].tolist(), batch["spans"].to_pylist(), strict=True):
            for span in own:
                content = data[begin + span["start"] : begin + span["start"] + span["count"] + LEAST - 1].tobytes()
                digest = hashlib.blake2b(content, digest_size=16).digest()
                for name, value in zip(names, (row, span["start"], span["hash"], span["inner"], digest, content), strict=True):
                    out[name].append(value)
                held += len(content)
            if held > 1 << 23:
                yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], list(names))
                out, held = {n: [] for n in names}, 0
        yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds, strict=True)], list(names))


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes and the rank of each, for bytes with zeros as separators that all differ and end the text.

    Larsson-Sadakane: suffixes are sorted by eight bytes; then suffixes that still share a rank, and only they, are sorted by the
    rank of the suffix behind what they share, which doubles each time.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    ended = np.zeros(n, bool)
    for k in range(8):
        byte = padded[k : k + n]
        key = (key << np.uint64(8)) | np.where(ended, np.uint8(0), byte)
        ended |= byte == 0
    order = np.argsort(key, kind="stable")
    # Suffixes with a separator in their first eight bytes are all different, in the order of their separators.
    new = np.ones(n, bool)
    sorted_key = key[order]
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[order[1:]]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    size = np.append(new[1:], True) & new
    places = np.flatnonzero(~size)
    shared = 8
    while len(places):
        suffix = order[places]
        own, behind = rank[suffix], rank[suffix + shared]
        by = np.lexsort((behind, own))
        suffix, own, behind = suffix[by], own[by], behind[by]
        order[places] = suffix
        new = np.ones(len(places), bool)
        new[1:] = (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])
        rank[suffix] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        alone = np.append(new[1:], True) & new
        places = places[~alone]
        shared *= 2
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, most: int = LEAST, lane: int = 512) -> np.ndarray:
    """For each suffix the bytes, up to ``most``, that it shares with the one before it in ``order``.

    Kasai: the suffix one byte on shares at least one byte less. Stretches of ``lane`` suffixes go side by side.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    eight = np.ndarray((n + most + 8,), "<u8", padded.tobytes(), strides=(1,))
    zero = np.flatnonzero(text == 0)
    left = zero[np.searchsorted(zero, np.arange(n))] - np.arange(n)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    shared = np.zeros(len(starts), np.int64)
    for step in range(min(lane, n)):
        i = starts + step
        live = i < n
        i = i[live]
        j = before[i]
        h = np.maximum(shared[live] - 1, 0)
        limit = np.where(j < 0, 0, np.minimum(np.minimum(left[i], left[j]), most))
        h = np.minimum(h, limit)
        open_ = np.flatnonzero(h < limit)
        while len(open_):
            differ = eight[i[open_] + h[open_]] ^ eight[j[open_] + h[open_]]
            same = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
            h[open_] = np.minimum(h[open_] + same, limit[open_])
            open_ = open_[(same == 8) & (h[open_] < limit[open_])]
        out[i] = h
        shared[live] = h
    return out


def repeated(contents: list[bytes], least: int = LEAST) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Which windows of each content repeat among all of them; and of each distinct window one (content, place)."""
    sizes = np.array([len(c) for c in contents])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = np.zeros(int(sizes.sum()) + len(contents), np.uint8)
    for begin, content in zip(begins.tolist(), contents, strict=True):
        # UTF-8 has no byte above 244, so one more fits and zero is free for separators.
        text[begin : begin + len(content)] = np.frombuffer(content, np.uint8) + np.uint8(1)
    order, rank = suffix_array(text)
    shares = common_prefixes(text, order, rank, least) >= least
    mark = shares.copy()
    mark[order[np.maximum(rank[shares] - 1, 0)]] = True
    own = np.repeat(np.arange(len(contents)), sizes + 1)
    place = np.arange(len(text)) - begins[own]
    single = (place + least <= sizes[own]) & ~shares
    return [mark[b : b + max(0, s - least + 1)] for b, s in zip(begins.tolist(), sizes.tolist(), strict=True)], own[single], place[single]


def runs(mark: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


_SHARD_SHAPE = "digest binary, a int, b int, hash long, bucket int, windows binary, owners binary"


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (digest, a, b) of repeated windows; and of hashes in several shards the sorted window digests by bucket."""
    for table in whole_groups(batches, ["hash", "shard"], lambda t: t["content"].nbytes, SHARD):
        contents, digests = table["content"].to_pylist(), table["digest"].to_pylist()
        shards, hashes = table["shards"].to_numpy(), table["hash"].to_numpy()
        times = table["times"].to_numpy()
        marks, own, place = repeated(contents)
        out: dict[str, list] = {n: [] for n in ("digest", "a", "b", "hash", "bucket", "windows", "owners")}

        def add(*values, out=out):
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)

        for digest, mark, n in zip(digests, marks, times, strict=True):
            for a, b in runs(mark) if n < 2 else [(0, len(mark))]:
                add(digest, a, b, None, None, None, None)
        split: dict[tuple[int, int], list] = {}
        for k, p in zip(*(x[shards[own] > 1].tolist() for x in (own, place)), strict=True):
            window = hashlib.blake2b(contents[k][p : p + LEAST], digest_size=16).digest()
            bucket = int.from_bytes(window[:4], "little") % int(shards[k])
            split.setdefault((int(hashes[k]), bucket), []).append(window + digests[k] + p.to_bytes(4, "little"))
        for (value, bucket), found in split.items():
            found.sort()
            add(None, None, None, value, bucket, b"".join(f[:16] for f in found), b"".join(f[16:] for f in found))
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def _merge(table: pa.Table) -> pa.Table:
    """Windows that more than one shard has: each shard's sorted digests are searched in those of the others."""
    kind = np.dtype([("high", ">u8"), ("low", ">u8")])
    sorted_ = [np.frombuffer(w, kind) for w in table["windows"].to_pylist()]
    owners = [np.frombuffer(o, np.dtype([("digest", "V16"), ("place", "<u4")])) for o in table["owners"].to_pylist()]
    every = np.sort(np.concatenate(sorted_), order=["high", "low"])
    twice = every[1:][every[1:] == every[:-1]]
    digests, a = [], []
    for windows, owner in zip(sorted_, owners, strict=True):
        if not len(twice):
            break
        spot = np.searchsorted(twice, windows)
        found = twice[np.minimum(spot, len(twice) - 1)] == windows
        digests += [d.tobytes() for d in owner["digest"][found]]
        a += owner["place"][found].tolist()
    start = pa.array(a, pa.int32())
    return pa.table({"digest": pa.array(digests, pa.binary()), "a": start, "b": pa.array([x + 1 for x in a], pa.int32())})


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = flat(batch["text"])
        removed, count, sha = [], [], []
        for a, b, gone in zip(at[:-1], at[1:], batch["gone"].to_pylist(), strict=True):
            edge = np.zeros(b - a + 1, np.int64)
            np.add.at(edge, [g["from"] for g in gone], 1)
            np.add.at(edge, [g["to"] for g in gone], -1)
            drop = np.cumsum(edge[:-1]) > 0
            removed.append(int(drop.sum()))
            count.append(len(runs(drop)))
            sha.append(hashlib.sha256(data[a:b][~drop].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch["row"], pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())], ["row", "n_removed", "n_spans", "kept_sha256"])


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """``row``, ``gone``: for each document with repeated bytes the stretches [from, to) that its repeated windows cover.

    A window is repeated if the same ``LEAST`` bytes start anywhere else in ``docs``, the same document included. Rows that are copies of
    another row are left out: all of their bytes repeat (see ``remove_repeats``).
    """
    return _repeats(docs, saved(_meta(docs), "meta", True))


def _meta(docs: DataFrame) -> DataFrame:
    source = numbered(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_meta_rows, f"row long, doc_id {kind}, n long, sha string")


def _copies(meta: DataFrame) -> DataFrame:
    """``sha``, ``first``: of texts in more than one row the smallest row."""
    return meta.groupBy("sha").agg(F.count("*").alias("rows"), F.min("row").alias("first")).where("rows > 1").select("sha", "first")


def _dealt(contents: DataFrame) -> DataFrame:
    """Distinct spans with their number by hash, the number of shards of the hash by spans and by bytes, and the shard each goes to."""
    sizes = contents.groupBy("hash").agg(F.count("*").alias("distinct"), F.sum(F.length("content")).alias("bytes"))
    shards = F.greatest(F.ceil(F.col("distinct") / SPANS), F.ceil(F.col("bytes") / SPAN_BYTES))
    return contents.join(sizes, "hash").withColumn("shards", shards).withColumn("shard", F.pmod(F.xxhash64("digest"), "shards"))


def _repeats(docs: DataFrame, meta: DataFrame) -> DataFrame:
    texts = numbered(docs, "text")
    found = saved(texts.mapInArrow(_span_rows, "row long, start int, count int, hash long, inner boolean"), "spans", True)
    often = found.groupBy("hash").agg(F.sum(F.when(F.col("inner"), 2).otherwise(1)).alias("times")).where("times > 1").select("hash")
    later = meta.join(_copies(meta), "sha").where("row <> first").select("row")
    # Spans of one text, no more than it has bytes; of rows with equal texts only the first one's.
    candidates = (
        found.join(often, "hash")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "count", "hash", "inner")).alias("spans"))
        .join(later, "row", "left_anti")
    )
    members = saved(
        texts.join(candidates, "row").mapInArrow(_content_rows, "row long, start int, hash long, inner boolean, digest binary, content binary"), "members", True
    )
    contents = saved(
        members.groupBy("digest").agg(
            F.min("hash").alias("hash"), F.max("inner").alias("inner"), F.count("*").alias("times"), F.min("content").alias("content")
        ),
        "contents",
        True,
    )
    dealt = _dealt(contents)
    alone = dealt.where("distinct = 1 AND NOT inner")
    whole = alone.where("times > 1").select("digest", F.lit(0).alias("a"), (F.length("content") - LEAST + 1).alias("b"))
    together = (
        dealt.where("distinct > 1 OR inner")
        .select("hash", "shard", "shards", "times", "digest", "content")
        .repartition("hash", "shard")
        .sortWithinPartitions("hash", "shard")
    )
    sorted_ = saved(together.mapInArrow(_shard_rows, _SHARD_SHAPE), "shards", True)
    merged = sorted_.where("bucket IS NOT NULL").groupBy("hash", "bucket").applyInArrow(_merge, "digest binary, a int, b int")
    marks = whole.union(sorted_.where("digest IS NOT NULL").select("digest", "a", "b")).union(merged)
    marked = marks.groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("marks"))
    stretch = F.struct((F.col("start") + F.col("m.a")).alias("from"), (F.col("start") + F.col("m.b") + LEAST - 1).alias("to"))
    return (
        members.select("row", "start", "digest")
        .join(marked, "digest")
        .select("row", "start", F.explode("marks").alias("m"))
        .groupBy("row")
        .agg(F.collect_list(stretch).alias("gone"))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, row.

    Removed is every byte of a ``LEAST``-byte string that starts anywhere else too, judged on the texts as they come in; ``n_spans`` are
    maximal removed runs. Matches never cross texts. Null and empty texts have no bytes; shorter texts lose none. Rows that repeat
    are copies of each other. Other columns are ignored; an empty table gives an empty result.
    """
    meta = saved(_meta(docs), "meta", True)
    gone = _repeats(docs, meta)
    copies = _copies(meta).select("sha", F.lit(True).alias("copied"))
    tagged = meta.join(copies, "sha", "left").withColumn("whole", F.coalesce("copied", F.lit(False)) & (F.col("n") >= LEAST))
    partly = numbered(docs, "text").join(gone.join(tagged.where("NOT whole").select("row"), "row"), "row")
    cut = partly.mapInArrow(_cut_rows, "row long, n_removed long, n_spans long, kept_sha256 string")
    return tagged.join(cut, "row", "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.when(F.col("whole"), F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(F.col("whole"), F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        "row",
    )
