"""Words, shingles and their hashes, by numpy over the UTF-8 bytes of a batch.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; those bytes
never occur inside a multi-byte character, so bytes and code points agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

_rng = np.random.default_rng(20240229)
BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHINGLE_HASH = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ROOT = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ROOT**i and ROOT**-i modulo 2**64 for i up to n."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + 1)
        for name, root in (("up", ROOT), ("down", pow(ROOT, -1, 2**64))):
            steps = np.full(size, root, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each row starts; null reads as empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    offs = np.frombuffer(offsets, np.int64, len(filled) + 1, filled.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(batch: pa.RecordBatch, column: str,
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows of about ``limit`` bytes of text at most, or one row."""
    data, offs = utf8(batch.column(batch.schema.get_field_index(column)))
    start, rows = 0, batch.num_rows
    while start < rows:
        end = int(np.searchsorted(offs, offs[start] + limit, "right")) - 1
        end = min(rows, max(start + 1, end))
        yield (batch.slice(start, end - start), data[offs[start]:offs[end]],
               offs[start:end + 1] - offs[start])
        start = end


def words(data: np.ndarray, offs: np.ndarray,
          space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each row's first word.

    ``space`` tells which bytes part words.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_HASH[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sequence_hashes(items: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive items, regardless of row borders."""
    count = max(0, len(items) - n + 1)
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h += items[k:k + count] * SHINGLE_HASH[k]
    return mix(h)


def row_shingles(data: np.ndarray, offs: np.ndarray, n: int,
                 lower: bool = True) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each row's n-word shingles.

    A row of fewer words has its whole sequence as one shingle, a row without
    words none.
    """
    text = LOWER[data] if lower else data
    starts, ends, first = words(text, offs)
    hashed = word_hashes(text, starts, ends)
    grams = sequence_hashes(hashed, n)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield sequence_hashes(hashed[a:b], b - a)
        else:
            yield grams[:0]
