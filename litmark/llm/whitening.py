"""Whitening of embeddings by a weighted multiplicity covariance.

Vectors are put on an integer grid and identical ones grouped, with the number of rows that hold them. Every vector that occurs is
centred, multiplied and whitened once, with weight one or its number of rows; the whitened vectors are then joined back to the rows.
Tasks return sums and products of their own vectors only, so what reaches the driver has the size of the dimension, not of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from litmark.llm.common import saved
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this many grid steps count as this many, so that differences of entries fit into a long.
FURTHEST = float(1 << 40)
#: Components of less than this share of the largest variance are rounding errors of a vector space of lower rank.
LEAST = 1e-11
#: Vectors that hold more than one in so many rows are joined by a broadcast: there are fewer of them than this.
HEAVY = 1000

Batches = Iterator[pa.RecordBatch]


def on_grid(vector: Column) -> Column:
    """Entries as longs: floor(64 c) + 1,000,000; entries beyond ``FURTHEST`` steps count as that."""
    return F.transform(
        vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(FURTHEST)), F.lit(-FURTHEST))) + SHIFT
    )


def _whole(vector: Column) -> Column:
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~odd


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _reduced(frame: DataFrame, task: Callable[[Batches], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all tasks of the flat arrays that ``task`` makes of their batches."""

    def rows(batches: Batches) -> Iterator[pa.RecordBatch]:
        own = task(batches)
        if own is not None:
            values = pa.array(map(Decimal, own.tolist()), pa.decimal128(38)) if kind.startswith("decimal") else pa.array(own, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own))), values], ["place", "value"])

    parts = frame.mapInArrow(rows, f"place long, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    table = parts.toArrow().sort_by("place")
    return np.array([int(v) for v in table["value"].to_pylist()], object) if kind.startswith("decimal") else table["value"].to_numpy()


def _added(batches: Batches, one: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    total = None
    for batch in batches:
        if batch.num_rows:
            total = one(batch) if total is None else total + one(batch)
    return total


def _product(frame: DataFrame, centred: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """Weighted product of the centred vectors with themselves; only one triangle travels."""
    upper = np.triu_indices(width)

    def one(batch: pa.RecordBatch) -> np.ndarray:
        x = centred(batch)
        return ((x * batch["weight"].to_numpy()[:, None]).T @ x)[upper]

    out = np.zeros((width, width))
    out[upper] = _reduced(frame, lambda batches: _added(batches, one), "double")
    return out + np.triu(out, 1).T


@dataclass
class Fit:
    """Fitted on ``n`` weights with exact ``sums``: eigenvalues by falling size, unit eigenvectors as columns, ``trace`` of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def parted(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole steps from the whole part of the mean, and what is left of the mean as a share of a step."""
        whole = [s // self.n for s in self.sums]
        return x - np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])

    def centred(self, x: np.ndarray) -> np.ndarray:
        steps, rest = self.parted(x)
        return steps - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - sum) squared, exact; None where that is beyond a long."""
        steps, _ = self.parted(x)
        rest = [s % self.n for s in self.sums]
        if (self.n * (float(np.abs(steps).max(initial=0)) + 1)) ** 2 * max(x.shape[1], 1) >= 2.0**62:
            steps, rest = steps.astype(object), np.array(rest, object)
        else:
            rest = np.array(rest, np.int64)
        total = ((steps * self.n - rest) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in total]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(distinct: DataFrame, width: int, components: int) -> Fit:
    """Mean and components of ``distinct`` (x, weight), all vectors of ``width`` entries."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        x, weight = _matrix(batch["x"], width), batch["weight"].to_numpy()
        if float(np.abs(x).max(initial=0)) * float(weight.sum()) >= 2.0**62:
            x, weight = x.astype(object), weight.astype(object)
        return np.concatenate([(x * weight[:, None]).sum(0).astype(object), [int(weight.sum())]])

    *total, n = _reduced(distinct, lambda batches: _added(batches, sums), "decimal(38,0)").tolist()
    made = Fit(n, total, np.ones(0), np.zeros((width, 0)), 0.0)
    covariance = _product(distinct, lambda batch: made.centred(_matrix(batch["x"], width)), width) / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > max(values[0] * LEAST, 0.0)).sum()) if width else 0
    kept = min(some, components)
    vectors = vectors[:, :kept].copy()
    if kept:  # the largest entry of a component is positive, so that repeated runs agree
        vectors *= np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(0)[None], 0))
    return Fit(n, total, values[:kept].copy(), vectors, float(np.trace(covariance)))


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16, counted: bool = False
) -> tuple[DataFrame, Fit | None, float]:
    """Rows (``key``, deviation, whitened), what was fitted, and the largest difference of the whitened covariance from the identity.

    Rows whose vector is null or holds null, NaN or infinite entries are left out; so are vectors that are not of the commonest length (of
    equally common ones, the longest), which have no place in its space. Each distinct vector of the grid is fitted with weight one, or with
    its number of rows if ``counted``. Repeated rows and null keys give rows of their own. If no entry varies, or no row is left,
    there is no component: no rows for a table without vectors, empty ``whitened`` otherwise. ``deviation`` is null beyond a long.
    Other columns are ignored.
    """
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("x")).where(_whole(F.col("x")))
    rows = rows.select("key", on_grid(F.col("x")).alias("x"))
    groups = saved(rows.groupBy("x").agg(F.count("*").alias("rows")), "vectors")
    lengths = groups.groupBy(F.size("x").alias("width")).agg(F.sum("rows").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("width")).first()
    if common is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), None, 0.0
    width = common.width
    groups = groups.where(F.size("x") == width)
    weight = F.col("rows") if counted else F.lit(1).cast("long")
    distinct = groups.select("x", "rows", weight.alias("weight"))
    made = fit(distinct, width, components)
    kept = len(made.values)

    def apply(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["x"], width)
            out = made.whitened(x)
            at = pa.array(np.arange(len(x) + 1) * kept, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["x"], batch["rows"], batch["weight"], pa.array(made.deviations(x), pa.int64()), pa.ListArray.from_arrays(at, pa.array(out.ravel()))],
                ["x", "rows", "weight", "deviation", "whitened"],
            )

    white = saved(distinct.mapInArrow(apply, "x array<long>, rows long, weight long, deviation long, whitened array<double>"), "whitened")
    error = 0.0
    if kept:

        def total(batch: pa.RecordBatch) -> np.ndarray:
            return (_matrix(batch["whitened"], kept) * batch["weight"].to_numpy()[:, None]).sum(0)

        mean = _reduced(white, lambda batches: _added(batches, total), "double") / made.n
        found = _product(white, lambda batch: _matrix(batch["whitened"], kept) - mean, kept) / made.n
        error = float(np.abs(found - np.eye(kept)).max())
    many = F.col("rows") > common.rows // HEAVY
    white_rows = white.select("x", "rows", "deviation", "whitened")
    heavy = F.broadcast(white_rows.where(many).drop("rows"))
    often = rows.join(heavy, "x")
    rest = rows.join(heavy.select("x"), "x", "left_anti").join(white_rows.where(~many).drop("rows"), "x")
    return often.unionByName(rest).select(F.col("key").alias(key), "deviation", "whitened"), made, error
