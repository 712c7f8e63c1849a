"""Exact duplicates by composable polynomial fingerprints and a chunkwise comparison.

A text, with each run of ASCII white space made one space, is cut into chunks of ``CHUNK`` bytes. Each chunk is hashed on its own
as a polynomial modulo two primes and shifted by the bytes behind it, so the fingerprint of a document of any length is the sum of
its chunks' hashes: a partial aggregation. Rows with equal fingerprints are compared with the row that would stay, chunk by
chunk; rows that differ from it are grouped again among themselves until none is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmark.llm.common import SPACES, flat, keep_rows, numbered, saved

CHUNK = 1 << 16
# Primes below 2**31 keep a chunk's sum of (byte * power) within 64 bits; the bases are fixed odd numbers.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 433_494_437)


def normalised(texts: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text with each run of ASCII white space as one space; null is the empty text."""
    data, at = flat(texts)
    for low, high in zip(at[:-1], at[1:], strict=True):
        part = data[low:high]
        space = SPACES[part]
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[:1] = True
        part = np.where(space, np.uint8(32), part)
        yield part[keep].tobytes()


def powers(prime: int, base: int, count: int = CHUNK) -> np.ndarray:
    """base ** (count - 1), ..., base, 1 modulo the prime; built by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), prime)) % np.uint64(prime)])
    return out[:count][::-1].copy()


def _chunk_rows(primes, bases):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(p, b) for p, b in zip(primes, bases, strict=True)]
        for batch in batches:
            out = {name: [] for name in ("row", "doc_id", "a", "b", "n", "sha")}
            for row, doc, text in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), normalised(batch["text"]), strict=True):
                for low in range(0, max(len(text), 1), CHUNK):
                    part = np.frombuffer(text, np.uint8)[low : low + CHUNK].astype(np.uint64)
                    behind = len(text) - low - len(part)
                    for name, table, prime, base in zip("ab", tables, primes, bases, strict=True):
                        own = int((part * table[CHUNK - len(part) :]).sum() % np.uint64(prime))
                        out[name].append(own * pow(base, behind, prime) % prime)
                    out["row"].append(row)
                    out["doc_id"].append(doc)
                    out["n"].append(len(part))
                    out["sha"].append(hashlib.sha256(text).hexdigest() if low == 0 else None)
            yield pa.RecordBatch.from_pydict(out, batch.schema.remove(2).append(pa.field("a", pa.int64())).append(pa.field("b", pa.int64())).append(pa.field("n", pa.int64())).append(pa.field("sha", pa.string())))

    return rows


def fingerprints(docs: DataFrame, primes=PRIMES, bases=BASES) -> DataFrame:
    """``row``, ``doc_id``, fingerprint ``a``, ``b`` and length ``n`` of the normalised text, and its ``sha``."""
    source = numbered(docs, "doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    chunks = source.mapInArrow(_chunk_rows(primes, bases), f"row long, doc_id {kind}, a long, b long, n long, sha string")
    return chunks.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        (F.sum("a") % primes[0]).alias("a"),
        (F.sum("b") % primes[1]).alias("b"),
        F.sum("n").alias("n"),
        F.max("sha").alias("sha"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, parts, pieces = [], [], []
        for row, text in zip(batch["row"].to_pylist(), normalised(batch["text"]), strict=True):
            for part, low in enumerate(range(0, max(len(text), 1), CHUNK)):
                rows.append(row)
                parts.append(part)
                pieces.append(text[low : low + CHUNK])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(parts, pa.int32()), pa.array(pieces, pa.binary())], ["row", "part", "piece"])


def exact_groups(docs: DataFrame, primes=PRIMES, bases=BASES) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256, row.

    Of equal texts the row with the smallest doc_id stays; of rows that repeat a doc_id too, exactly one. A null id counts as
    smaller than any other. Null and empty texts are equal. Other columns are ignored; an empty table gives an empty result.
    """
    prints = saved(fingerprints(docs, primes, bases), "fingerprints")
    key = ["a", "b", "n"]
    # Groups are written before they are joined: such a join has no aggregation in its stage, so a large group can be split over tasks.
    groups = saved(prints.groupBy(key).agg(F.count("*").alias("size")).where("size > 1").drop("size"), "groups")
    open_rows = prints.join(groups, key).select("row", "doc_id", F.concat_ws("-", *key).alias("group"))
    texts = numbered(docs, "text").join(open_rows.select("row"), "row")
    pieces = saved(texts.mapInArrow(_pieces, "row long, part int, piece binary"), "chunks")
    settled = None
    while True:
        low = saved(open_rows.groupBy("group").agg(F.min(F.struct("doc_id", "row")).alias("low")), "lowest")
        paired = open_rows.join(low, "group").select(
            "row", "doc_id", "group", F.col("low.row").alias("keep"), F.col("low.doc_id").alias("keep_id")
        )
        mine = pieces.join(paired, "row")
        kept = pieces.join(low.select(F.col("low.row").alias("row")), "row", "left_semi").select(
            F.col("row").alias("keep"), "part", F.col("piece").alias("other")
        )
        compared = mine.join(kept, ["keep", "part"], "left").groupBy("row").agg(
            F.max("doc_id").alias("doc_id"),
            F.max("group").alias("group"),
            F.max("keep").alias("keep"),
            F.max("keep_id").alias("keep_id"),
            F.min(F.coalesce(F.col("piece") == F.col("other"), F.lit(False))).alias("same"),
        )
        compared = saved(compared, "compared")
        same = compared.where("same").select("row", "keep", "keep_id")
        settled = same if settled is None else settled.union(same)
        open_rows = compared.where("NOT same").select("row", "doc_id", "group")
        if open_rows.isEmpty():
            break
    sizes = saved(settled.groupBy("keep").agg(F.count("*").alias("size")), "sizes")
    found = settled.join(sizes, "keep").select("row", "keep", "keep_id", "size")
    alone = F.col("keep").isNull()
    return prints.join(found, "row", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep") == F.col("row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "row",
    )


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, exact_groups(docs).where("kept"))
