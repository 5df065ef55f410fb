"""A bit table of fixed size that tells which ids may be wanted.

It is a filter only: ids that share a bit with a wanted one pass too, so
callers join what passes with the wanted ids. Its size does not depend on the
input, which makes it safe to broadcast; a full table only filters less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tierwise.llm.text import mix

BITS = 1 << 24
_PIECE = 1 << 14


def _slots(ids: pa.Array) -> np.ndarray:
    known = pc.fill_null(ids.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return (mix(known.astype(np.int64).view(np.uint64)) % np.uint64(BITS)).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BITS // 8, np.uint8)
    for batch in batches:
        slot = _slots(batch.column(0))
        np.bitwise_or.at(table, slot >> 3, np.uint8(1) << (slot & 7).astype(np.uint8))
    pieces = table.reshape(-1, _PIECE)
    held = np.flatnonzero(pieces.any(axis=1))
    yield pa.record_batch([pa.array(held, pa.int64()),
                           pa.array([pieces[k].tobytes() for k in held], pa.binary())],
                          names=["piece", "bits"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the same number in a partition, combined."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            bits = np.frombuffer(raw, np.uint8)
            found[k] = found[k] | bits if k in found else bits
    yield pa.record_batch([pa.array(list(found), pa.int64()),
                           pa.array([v.tobytes() for v in found.values()], pa.binary())],
                          names=["piece", "bits"])


def mark_table(ids: DataFrame) -> np.ndarray:
    """The table of a one-column frame of long ids; a null counts as 0."""
    schema = "piece long, bits binary"
    pieces = ids.mapInArrow(_pieces, schema).repartition("piece").mapInArrow(_joined, schema)
    table = np.zeros(BITS // 8, np.uint8)
    for row in pieces.collect():  # the table's bytes, once
        table[row.piece * _PIECE:(row.piece + 1) * _PIECE] = np.frombuffer(row.bits, np.uint8)
    return table


def may_hold(table: np.ndarray, ids: pa.Array) -> np.ndarray:
    slot = _slots(ids)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def keep_marked(marks: object, wanted: bool = True) -> Callable[[Iterator[pa.RecordBatch]],
                                                               Iterator[pa.RecordBatch]]:
    """Rows whose first column may be (or, if not ``wanted``, surely is not) among the marked ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(marks.value, batch.column(0)) == wanted))
    return run
