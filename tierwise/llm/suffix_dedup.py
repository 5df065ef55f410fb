"""Suffix-array dedup: a run-length index over repetitive stretches of bytes.

Every byte covered by a 100-byte string that also starts earlier (in a document
with a smaller id, or earlier in the same one) is removed; strings are judged
on the input, not on what is left.

Candidate stretches come in memory-sized groups (see ``repeats``). A group's
stretches, in the order of their first occurrence, are one text with a distinct
end mark after each. Its Burrows-Wheeler transform is kept as runs, with the
suffix sampled at the first and last row of every run. Those samples alone give
matching statistics for the whole text in one pass: within a run of the
transform, the match of position i + 1 is the match of i moved on by one, one
byte shorter. Matches of 100 bytes or more link a position to the next suffix
before it in sorted order; following the links gathers the occurrences of one
string, and all but the first in text order are marked.

Defined results: a null or empty text has no bytes; rows with a null id come
after all others; of rows that share an id but not the text, the order is by a
hash of the text; repeated rows (equal id and text) remove nothing from each
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.repeats import (Units, covered_ranges, first_in_class, removed_units,
                                  with_ranges, with_row_ids)
from tierwise.llm.scratch import Scratch
from tierwise.llm.text import BYTE_HASH, chunks, mix

WINDOW_BYTES = 100
GRAM_BYTES = 32


def _split(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offs


def packed(values: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as one big-endian number, 0 past the end."""
    out = np.zeros(len(values) + 8, np.uint64)
    out[:len(values)] = values
    for step in (1, 2, 4):
        out[:len(out) - step] = (out[:len(out) - step] << np.uint64(8 * step)) | out[step:]
    return out[:len(values)]


def _grams(values: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive bytes; n is a multiple of 8."""
    count = max(0, len(values) - n + 1)
    eight = packed(values)
    h = np.full(count, n, np.uint64)
    for k in range(0, n, 8):
        h = (h ^ eight[k:k + count]) * BYTE_HASH[k % 256]
        h ^= h >> np.uint64(29)
    return mix(h)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of a text whose suffixes all differ, by doubling ranks of the unsettled ones."""
    n = len(symbols)
    head, step = symbols, 1
    if n and symbols.max() < (1 << 21) - 1:  # three symbols fit one number
        shifted = np.append(symbols + 1, [0, 0])
        head, step = (shifted[:n] << 42) | (shifted[1:n + 1] << 21) | shifted[2:n + 2], 3
    order = np.argsort(head, kind="stable")
    fresh = np.append(True, head[order][1:] != head[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    while True:
        # rows of the order that are not alone in their rank
        shared = ~(fresh & np.append(fresh[1:], True))
        if not shared.any():
            return order
        rows = np.flatnonzero(shared)
        at = order[rows]
        after = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        again = np.lexsort((after, rank[at]))
        order[rows] = at[again]
        pair_fresh = np.append(True, (after[again][1:] != after[again][:-1])
                               | (rank[at][again][1:] != rank[at][again][:-1]))
        fresh[rows] = pair_fresh
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        step *= 2


class RunLengthIndex:
    """Runs of the Burrows-Wheeler transform of a text, with the suffixes at their ends."""

    def __init__(self, symbols: np.ndarray) -> None:
        order = suffix_order(symbols)
        last = symbols[order - 1]  # the symbol before each suffix; the text is a cycle
        heads = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        self.size = len(symbols)
        self.symbols = last[heads]
        self.lengths = np.diff(np.append(heads, len(last)))
        self.head_suffix = order[heads]
        self.tail_suffix = order[np.append(heads[1:], len(last)) - 1]

    def matching_statistics(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position the suffix before it in sorted order and their common length."""
        heads = self.head_suffix[1:]
        before = self.tail_suffix[:-1]
        common = common_lengths(symbols, heads, before)
        by_place = np.argsort(heads)
        place, before, common = heads[by_place], before[by_place], common[by_place]
        every = np.arange(self.size)
        sample = np.searchsorted(place, every, "right") - 1
        known = sample >= 0
        sample = np.maximum(sample, 0)
        moved = every - place[sample] if len(place) else every
        if not len(place):
            return np.full(self.size, -1), np.zeros(self.size, np.int64)
        match = np.where(known, before[sample] + moved, -1)
        return match, np.where(known, np.maximum(common[sample] - moved, 0), 0)


def common_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at each pair of positions."""
    length = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + length[live], b[live] + length[live]
        same = (np.maximum(x, y) < len(symbols))
        same[same] = symbols[x[same]] == symbols[y[same]]
        live = live[same]
        length[live] += 1
    return length


def _resolver(window: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    def resolve(values: np.ndarray, offs: np.ndarray, docs: np.ndarray) -> np.ndarray:
        count = len(docs)
        # a distinct mark after each stretch: marks sort below all bytes
        symbols = np.empty(len(values) + count, np.int64)
        owner = np.repeat(np.arange(count), np.diff(offs))
        symbols[np.arange(len(values)) + owner] = values.astype(np.int64) + count
        symbols[offs[1:] + np.arange(count)] = np.arange(count)
        index = RunLengthIndex(symbols)
        match, length = index.matching_statistics(symbols)
        root = np.where(length >= window, match, np.arange(len(symbols)))
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
        at = np.arange(len(values)) + owner
        starts = np.flatnonzero(np.arange(len(values)) + window <= offs[1:][owner])
        found = np.zeros(len(values), bool)
        found[starts] = first_in_class(root[at[starts]], starts) < starts
        return found
    return resolve


def byte_units(window: int = WINDOW_BYTES) -> Units:
    return Units(window, GRAM_BYTES, _split, _grams, _resolver(window), False, "uint8")


KEPT = "doc_id long, n_bytes long, removed array<struct<s: int, e: int>>, kept binary"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offs in chunks(batch, "text"):
            counts, runs, kept = [], [], []
            for k, ranges in enumerate(part.column(2).to_pylist()):
                own = data[offs[k]:offs[k + 1]]
                counts.append(len(own))
                if not ranges:
                    runs.append([])
                    kept.append(own.tobytes())
                    continue
                gone, spans = removed_units(len(own), ranges)
                runs.append([{"s": s, "e": e} for s, e in spans])
                kept.append(own[~gone].tobytes())
            yield pa.record_batch([
                part.column(0), pa.array(counts, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])


def suffix_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW_BYTES) -> DataFrame:
    """doc_id, n_bytes, removed (runs of byte positions) and kept (the remaining bytes)."""
    rows = with_row_ids(docs)
    scratch = Scratch(spark, "suffix-dedup")
    ranges = scratch.save(covered_ranges(spark, rows, byte_units(window), scratch), "ranges")
    return with_ranges(spark, rows, ranges).mapInArrow(_keep, KEPT)
