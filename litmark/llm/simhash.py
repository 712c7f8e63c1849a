"""Near duplicates by SimHash: pivot distance tables over fingerprints that share a band.

Every fingerprint gets its Hamming distances to fixed reference fingerprints (pivots) once. Two fingerprints within ``RADIUS`` bits
differ by at most ``RADIUS`` in each of these coordinates, so a larger difference in any of them discards a pair; what is left is
compared bit by bit. Fingerprints of such a pair also agree on some set of whole bands, which gives the groups in which pairs are
looked for at all. Equal fingerprints are one node, and a group hands on a spanning forest of its links, not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import components, flat, forest, keep_rows, numbered, saved, whole_groups

WORDS, SEED, RADIUS, PIVOTS = 4, 42, 4, 16
# A band group of more fingerprints is split into blocks of about this many, and the pairs of blocks are compared one by one.
BLOCK = 1024
# With n fingerprints, the coarsest bands are taken that leave about this many in a group.
GROUP = 256
# Bands as (number of bands, bands that agree): with RADIUS + agreeing bands, RADIUS differing bits leave that many untouched.
BANDS = ((RADIUS + 1, 1), (RADIUS + 2, 2), (RADIUS + 3, 3), (RADIUS + 4, 4))
REFERENCES = np.random.default_rng(20_240_401).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the word shingles of a text, A-Z lower-cased; words are split by ASCII white space. Zero without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    joined = b" ".join(parts)
    if count == 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        starts = [0, *ends[: count - 1].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]
    bits = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    for low in range(0, count, 1 << 14):
        bits += np.unpackbits(values[low : low + (1 << 14)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(bits * 2 > count, bitorder="little").view("<u8")[0])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = flat(batch["text"])
        made = np.array([fingerprint(data[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], np.uint64)
        yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], pa.array(made.view(np.int64))], ["row", "doc_id", "print"])


def distances(prints: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES[None, :])


def _with_bands(bands: int, agree: int):
    """Rows (band, key, print, pivots): one for every choice of agreeing bands."""
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen) for chosen in combinations(range(bands), agree)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch["print"].to_numpy().view(np.uint64)
            table = pa.array([bytes(x) for x in distances(prints)], pa.binary())
            for band, mask in enumerate(masks):
                key = pa.array((prints & np.uint64(mask)).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(prints), band, np.int32)), key, batch["print"], table], ["band", "key", "print", "pivots"])

    return rows


def close_pairs(prints: np.ndarray, pivots: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int = RADIUS):
    """Pairs of ``left`` with ``right`` places that differ in at most ``radius`` bits."""
    found = []
    for low in range(0, len(left), 256):
        a = left[low : low + 256]
        alive = np.ones((len(a), len(right)), bool)
        for x, y in zip(pivots[a].T, pivots[right].T, strict=True):
            # Distances are 0..64, so the difference shifted by the radius stays within a byte.
            alive &= (x[:, None] - y[None, :] + np.uint8(radius)).view(np.uint8) <= 2 * radius
        i, j = np.nonzero(alive)
        good = np.bitwise_count(prints[a[i]] ^ prints[right[j]]) <= radius
        found.append((a[i[good]], right[j[good]]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = ["band", "key", "i", "j"]
    for table in whole_groups(batches, keys, lambda t: t.num_rows, 20_000):
        columns = {name: table[name].to_numpy() for name in [*keys, "block"]}
        prints = table["print"].to_numpy().view(np.uint64)
        pivots = np.frombuffer(b"".join(table["pivots"].to_pylist()), np.uint8).reshape(-1, PIVOTS)
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([columns[k][1:] != columns[k][:-1] for k in keys], axis=0)
        starts = np.flatnonzero(new)
        a_out, b_out = [], []
        for low, high in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            if high - low < 2:
                continue
            place = np.arange(low, high)
            i, j = columns["i"][low], columns["j"][low]
            block = columns["block"][low:high]
            a, b = close_pairs(prints, pivots, place[block == i], place[block == j])
            root = forest(a - low, b - low, high - low)
            link = np.flatnonzero(root != np.arange(len(root)))
            a_out.append(prints[low + link].view(np.int64))
            b_out.append(prints[low + root[link]].view(np.int64))
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], ["a", "b"])


def links(prints: DataFrame, block: int = BLOCK, bands: tuple[int, int] | None = None) -> DataFrame:
    """Links (a, b) between the distinct values of ``print`` that join exactly those of a component within the radius."""
    if bands is None:
        n = prints.count()
        bands = next((b for b in BANDS if n / 2 ** (64 * b[1] // b[0]) <= GROUP), BANDS[-1])
    rows = prints.mapInArrow(_with_bands(*bands), "band int, key long, print long, pivots binary")
    key = ["band", "key"]
    # Joined by merge: a print gives a row in every band, which the planner does not see, so it would broadcast millions of groups as a small table.
    # Written before that: such a join has no aggregation in its stage, so a large group can be split over tasks.
    sizes = saved(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block)), "sizes")
    # Row of block x goes to the pairs (x, y) and (y, x) of blocks, so each pair of blocks meets in one task.
    placed = rows.join(sizes.hint("merge"), key).withColumn("block", F.pmod(F.xxhash64("print", "band"), "blocks"))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))).select(
        *key, "print", "pivots", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    keys = [*key, "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_group_links, "a long, b long")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, fingerprint, component_id, kept, row.

    Documents link if their fingerprints differ in at most ``RADIUS`` bits; ``component_id`` is the smallest doc_id reachable, null
    if a reachable row has no id. Texts without words have fingerprint zero and link like any other. Of each component one row
    is kept, also if rows repeat. Other columns are ignored; an empty table gives an empty result.
    """
    source = numbered(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    prints = saved(source.mapInArrow(_prints, f"row long, doc_id {kind}, print long"), "prints")
    distinct = saved(prints.groupBy("print").agg(F.min(F.struct("doc_id", "row")).alias("low")), "distinct")
    found = components(links(distinct.select("print"), **options)).withColumnRenamed("node", "print")
    rooted = saved(distinct.join(found, "print", "left").withColumn("root", F.coalesce("root", "print")), "rooted")
    # Written before it is joined: a join with a table has no aggregation in its stage, so a large component can be split over tasks.
    lowest = saved(rooted.groupBy("root").agg(F.min("low").alias("lowest")), "lowest")
    named = rooted.join(lowest, "root").select("print", "lowest")
    return prints.join(named, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("lowest.doc_id").alias("component_id"),
        (F.col("lowest.row") == F.col("row")).alias("kept"),
        "row",
    )


def drop_near(docs: DataFrame) -> DataFrame:
    """One row of each component of near duplicates, with all columns of ``docs``."""
    return keep_rows(docs, near_duplicates(docs).where("kept"))
