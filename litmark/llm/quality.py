"""Text quality: histogram gradient-boosted trees over document statistics.

The statistics are byte and line counts made with numpy over whole Arrow batches. Trees are grown on histograms of binned
statistics and flattened into arrays (node i has the children 2i + 1 and 2i + 2), so a batch goes through all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark.llm.common import SPACES, flat, sums

# At most so many labelled documents are used for fitting, those with the lowest hash of their id.
LABELLED_ROWS = 20_000
# Scores from here on count as quality 1.
ACCEPTED = 0.7
TREES, DEPTH, BINS, RATE, LEAST_WEIGHT, SHRINK = 80, 4, 64, 0.15, 1.0, 1.0

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t",
    "line": b"\n\r",
    "stop": b".,;:",
    "loud": b"!?",
    "mark": b"#$%&*+=^~_@",
    "bar": b"|/\\",
    "bracket": b"<>(){}[]\"'`-",
    "other": bytes(range(128, 256)),
}
_TABLES = [np.isin(np.arange(256), list(members)).astype(np.uint8) for members in _CLASSES.values()]
_LETTERS = np.isin(np.arange(256), list(_CLASSES["upper"] + _CLASSES["lower"] + _CLASSES["digit"] + _CLASSES["other"]))


WIDTH = 19
# Texts go through numpy in stretches of about this many bytes, which bounds memory and fits the processor's cache.
STRETCH = 1 << 18


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics per text; all zero for an empty or null text."""
    data, at = flat(texts)
    parts, low = [], 0
    while low < len(at) - 1:
        high = max(low + 1, int(np.searchsorted(at, at[low] + STRETCH, "right")) - 1)
        parts.append(_measure(data[at[low] : at[high]], at[low : high + 1] - at[low]))
        low = high
    return np.concatenate(parts) if parts else np.zeros((0, WIDTH))


def _measure(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    size = np.diff(at)
    some = np.maximum(size, 1)
    begins = at[:-1][size > 0]
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    columns = [np.log1p(size)]
    for table in _TABLES:
        columns.append(sums(table[data], at) / some)
    space = SPACES[data]
    inside = ~space
    starts = inside.copy()
    starts[1:] &= space[:-1] | first[1:-1]
    words = sums(starts.view(np.uint8), at)
    columns += [np.log1p(words), sums(inside.view(np.uint8), at) / np.maximum(words, 1)]
    # How many words end without a letter or digit, and how often a byte repeats the one before.
    ends = inside.copy()
    ends[:-1] &= space[1:] | first[1:-1]
    columns.append(sums((ends & ~_LETTERS[data]).view(np.uint8), at) / np.maximum(words, 1))
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & inside[1:]
    same[begins] = False
    columns.append(sums(same.view(np.uint8), at) / some)
    # Lines: number, share of distinct ones by a 64-bit hash, mean length.
    cuts = np.union1d(np.flatnonzero(data == 10), begins) if len(data) else begins
    owner = np.searchsorted(at, cuts, "right") - 1
    lines = np.bincount(owner, minlength=len(size))
    distinct = np.zeros(len(size))
    if len(cuts):
        place = (np.arange(len(data)) - np.repeat(cuts, np.diff(np.append(cuts, len(data))))).astype(np.uint64)
        with np.errstate(over="ignore"):
            mixed = (data + np.uint64(1)) * (place * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed[data == 10] = 0
        hashed = np.add.reduceat(mixed, cuts)
        order = np.lexsort((hashed, owner))
        hashed, owned = hashed[order], owner[order]
        new = np.ones(len(hashed), bool)
        new[1:] = (hashed[1:] != hashed[:-1]) | (owned[1:] != owned[:-1])
        distinct = np.bincount(owned[new], minlength=len(size))
    columns += [np.log1p(lines), distinct / np.maximum(lines, 1), np.log1p(size / np.maximum(lines, 1))]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``cut``: (trees, inner nodes); ``leaf``: (trees, leaves); ``start``: the sum before any tree."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.start)
        if len(self.leaf) and len(x):
            tree, row = np.arange(len(self.leaf))[None, :], np.arange(len(x))[:, None]
            node = np.zeros((len(x), len(self.leaf)), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
            total += self.leaf[tree, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for log loss. Without labels, or with labels of one kind, there are none and every score is the same."""
    none = Trees(np.zeros((0, 2**DEPTH - 1), np.int64), np.zeros((0, 2**DEPTH - 1)), np.zeros((0, 2**DEPTH)), 0.0)
    if not len(y):
        return none
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Trees(none.feature, none.cut, none.leaf, start)
    width = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    table = np.full((width, BINS), np.inf)
    for f, c in enumerate(cuts):
        table[f, : len(c)] = c
    cell = np.arange(width) * BINS + binned
    total, trees = np.full(len(y), start), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            wide, base = 2**level, 2**level - 1
            spot = ((node - base)[:, None] * (width * BINS) + cell).ravel()
            shape = (wide, width, BINS)
            left_g = np.bincount(spot, np.repeat(g, width), wide * width * BINS).reshape(shape).cumsum(2)
            left_h = np.bincount(spot, np.repeat(h, width), wide * width * BINS).reshape(shape).cumsum(2)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - all_g**2 / (all_h + SHRINK)
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT) | ~np.isfinite(table)[None]] = 0
            best = gain.reshape(wide, -1).argmax(1)
            found = gain.reshape(wide, -1)[np.arange(wide), best] > 1e-9
            feature[base : base + wide] = np.where(found, best // BINS, 0)
            cut[base : base + wide] = np.where(found, table.ravel()[best], np.inf)
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - (2**DEPTH - 1)
        leaf = RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + SHRINK)
        total = total + leaf[at]
        trees.append((feature, cut, leaf))
    return Trees(*(np.array(part) for part in zip(*trees, strict=True)), start)


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> Trees:
    """Trees from ``labels`` (doc_id, quality) of ``docs`` (doc_id, text).

    At most ``bound`` labelled ids are used, those with the lowest hash, so the broadcast ids and the collected statistics have a
    fixed size at any scale. Null ids and null labels are left out; of several labels of an id the lowest counts, of several
    texts of an id the one of the lowest hash. Rows are reduced to that one by an aggregation with a partial step.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array(list(statistics(texts)), pa.list_(pa.float64()))

    # Every row is measured before the exchange, so what an id's rows leave there is one short array a task, not texts.
    measured = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", F.col("quality").cast("double").alias("y"), F.xxhash64("text").alias("hash"), measure("text").alias("x"))
    )
    low = F.min(F.struct("hash", "x")).alias("low")
    rows = measured.groupBy("doc_id", "y").agg(low).select("doc_id", "y", "low.x").toPandas().sort_values("doc_id", kind="stable")
    if rows.empty:
        return grow(np.zeros((0, WIDTH)), np.zeros(0))
    return grow(np.array(rows["x"].tolist()), (rows["y"].to_numpy() > 0).astype(float))


def score(trees: Trees, text: Column) -> Column:
    """Score of a text column, 0 to 1. Null counts as the empty text, which has a score too."""

    @F.arrow_udf("double")
    def apply(texts: pa.Array) -> pa.Array:
        return pa.array(trees.score(statistics(texts)))

    return apply(text)


def drop_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score ``ACCEPTED`` or more, with all their columns."""
    return docs.where(score(learn(docs, labels), docs["text"]) >= ACCEPTED)
