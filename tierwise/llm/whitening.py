"""Whitening of embeddings with the leading components of their covariance.

Entries become whole numbers (``floor(scale * entry)``). The fit list holds each
distinct vector once. Its covariance is summed in tasks, over vectors centred on
the nearest whole numbers to their means; what is left of the means enters with
exact fractions, so no digits cancel and the order of the sums does not matter
while they stay below 2**53. The covariance is as wide as a vector; spectrum
slicing (``spectrum.py``) gives its leading eigenpairs on the driver.

Rows: a vector that is null, empty or holds a null or non-finite entry is
dropped, as is one whose length is not the most frequent one. Every other row,
repeated rows and null ids too, gives one row for each component. Components
without variance are left out, so one distinct vector, or an empty table, gives no
row. Entries beyond 2**40 after scaling count as 2**40. A deviation that a long
can't hold is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.scratch import Scratch
from tierwise.llm.spectrum import leading
from tierwise.llm.vectors import main_length, matrix, packed, unpacked, usable

LIMIT = float(2 ** 40)
#: Rows of a batch that are multiplied at once.
ROWS = 4096

Batches = Iterator[pa.RecordBatch]


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(np.floor(scale * values), -LIMIT, LIMIT).astype(np.int64)


def _distinct_in_task(scale: float, length: int) -> Callable[[Batches], Batches]:
    """Packed whole vectors, equal ones of a batch once."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = np.unique(whole(matrix(batch.column(0), length), scale), axis=0)
            yield pa.record_batch([packed(x)], names=["x"])
    return run


def _summed(batches: Batches) -> Batches:
    """Rows (part, values) of equal ``part`` of a task, added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, values in zip(batch.column(0).to_pylist(), batch.column(1)):
            row = values.values.to_numpy(zero_copy_only=False)
            sums[part] = sums[part] + row if part in sums else row.copy()
    yield pa.record_batch([pa.array(list(sums), pa.int32()),
                           pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["part", "v"])


def _total(vectors: DataFrame, rows: Callable[[np.ndarray], np.ndarray], length: int,
           parts: int, width: int) -> np.ndarray:
    """Sum over all packed vectors of ``rows(block)``, a (parts, width) matrix, added up by its rows."""
    def run(batches: Batches) -> Batches:
        out = np.zeros((parts, width))
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                out += rows(unpacked(batch.column(0).slice(a, ROWS), length, np.int64))
        yield pa.record_batch([pa.array(range(parts), pa.int32()),
                               pa.array(list(out), pa.list_(pa.float64()))], names=["part", "v"])
    schema = "part int, v array<double>"
    added = vectors.mapInArrow(run, schema).repartition("part").mapInArrow(_summed, schema)
    total = np.zeros((parts, width))
    for row in added.collect():  # one row for each row of the matrix
        total[row.part] = row.v
    return total


@dataclass
class Whitening:
    """The fitted components; ``sums`` and ``n`` give the means as exact fractions."""
    scale: float
    length: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - mean, from whole numbers: only the last division rounds."""
        whole_part = np.array([s // self.n for s in self.sums], dtype=np.float64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole_part) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)**2 over the entries, exactly; None beyond a long."""
        top = max(abs(s) for s in self.sums) + self.n * int(np.abs(x).max(initial=0))
        if top * top * self.length < 2 ** 63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [d if d < 2 ** 63 else None for d in (y * y).sum(axis=1)]


def _covariance(n: int, shifted: list[int], products: np.ndarray) -> np.ndarray:
    """(n * products - shifted shifted') / n**2, each entry rounded once."""
    out = np.empty(products.shape)
    for i, row in enumerate(products):
        for j, value in enumerate(row):
            out[i, j] = float(Fraction(n * int(value) - shifted[i] * shifted[j], n * n))
    return out


def fit_whitening(spark: SparkSession, vectors: DataFrame, components: int = 4, scale: float = 256,
                  column: str = "embedding") -> Whitening | None:
    """Components of all usable vectors, equal whole vectors counted once; None without any."""
    length = main_length(vectors, column)
    if not length:
        return None
    scratch = Scratch(spark, "whitening")
    fit, (n,) = scratch.save_observed(
        vectors.where(usable(column) & (F.size(column) == length)).select(column)
        .mapInArrow(_distinct_in_task(scale, length), "x binary").distinct(), "fit", ["count(1)"])

    def with_count(x: np.ndarray) -> np.ndarray:
        return x.sum(axis=0).astype(np.float64)[None, :]

    sums = [int(s) for s in _total(fit, with_count, length, 1, length)[0]]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        z = (x - centre).astype(np.float64)
        return z.T @ z

    covariance = _covariance(n, [s - n * int(c) for s, c in zip(sums, centre)],
                             _total(fit, products, length, length, length))
    pairs = leading(covariance, components)
    found = Whitening(scale, length, n, sums, np.array([p.value for p in pairs]),
                      np.array([p.vector for p in pairs]).reshape(len(pairs), length).T,
                      float(np.trace(covariance)), 0.0)
    k = len(pairs)

    def spread(x: np.ndarray) -> np.ndarray:
        """w w' and, in a last row, the sum of w, over whitened vectors w."""
        w = found.project(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    if k:
        measured = _total(fit, spread, length, k + 1, k) / n
        error = measured[:k] - np.outer(measured[k], measured[k]) - np.eye(k)
        found.identity_error = float(np.abs(error).max())
    return found


def whiten(vectors: DataFrame, fitted: Whitening | None, id_column: str = "vec_id",
           column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = (f"id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    length = fitted.length if fitted else 0

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = whole(matrix(part.column(1), length), fitted.scale)
                w, k = fitted.project(x), len(fitted.values)
                each = np.repeat(np.arange(len(x)), k)
                rows = len(each)
                yield pa.record_batch(
                    [part.column(0).take(pa.array(each)),
                     pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(rows, fitted.n)),
                     pa.array(fitted.deviations(x), pa.int64()).take(pa.array(each)),
                     pa.array(w.ravel()),
                     pa.array(np.tile(fitted.values / fitted.trace, len(x))),
                     pa.array(np.full(rows, fitted.identity_error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    some = F.lit(bool(fitted and len(fitted.values)))
    kept = vectors.where(some & usable(column) & (F.size(column) == length))
    return kept.select(F.col(id_column).alias("id"), F.col(column).alias("v")).mapInArrow(
        run, schema).withColumnRenamed("id", id_column)
