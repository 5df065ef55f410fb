"""Substring dedup: prefix-partitioned suffix trees over words.

A window is 50 consecutive words. Every word covered by a window whose words
also start in a document with a smaller id is removed; windows are judged on
the input, not on what is left.

Suffixes (window starts) are dealt to memory-sized groups by their first 50
words: by the anchor gram in them, and for crowded anchors also by the anchors
of longer grams, as far as needed (see ``repeats``), so suffixes that share 50
words share a group. A group's suffixes are sorted, and the common-prefix
lengths of neighbours give its suffix tree: rows whose neighbours share 50 words
or more are the leaves of one internal node of at least that string depth. The
uppermost such nodes are read: their leaves share a repeat as long as the node
is deep, and all but those of the smallest document are marked. Deeper nodes hold
some of the same leaves and can mark no others.

Defined results: a null or empty text has no words; texts of fewer than 50
words lose nothing; rows with a null id come after all others; rows that share
an id remove nothing from each other; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.repeats import Units, covered_ranges, removed_units, with_ranges, with_row_ids
from tierwise.llm.scratch import Scratch
from tierwise.llm.suffix_dedup import common_lengths, suffix_order
from tierwise.llm.text import chunks, sequence_hashes, word_hashes, words

WINDOW_WORDS = 50
GRAM_WORDS = 6


def _split(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(data, offs)
    return word_hashes(data, starts, ends), first


def neighbour_lengths(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common-prefix length of each suffix in ``order`` (sorted) with the one before it.

    Words are compared only where the words before the two suffixes differ; any
    other suffix shares one word less than the suffix one place to its left.
    """
    before = np.full(len(symbols), -1, np.int64)
    before[order[1:]] = order[:-1]
    alone = before < 0
    fresh = (before <= 0) | (np.arange(len(symbols)) == 0) | (symbols[before - 1] != np.roll(symbols, 1))
    heads = np.flatnonzero(fresh)
    common = np.zeros(len(heads), np.int64)
    paired = ~alone[heads]
    common[paired] = common_lengths(symbols, heads[paired], before[heads[paired]])
    sample = np.cumsum(fresh) - 1
    return (common[sample] - (np.arange(len(symbols)) - heads[sample]))[order]


def deep_nodes(lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The uppermost internal nodes of at least ``depth`` words, by neighbours' common lengths.

    For each node its first leaf and the end of its leaves (rows of the sorted
    suffixes) and its string depth, the length that all its leaves share.
    """
    edge = np.diff(np.concatenate([[0], (lengths >= depth).astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return begin, end, begin
    # the smallest length inside [begin, end); every second piece lies between two nodes
    pieces = np.stack([begin, end], 1).ravel()
    shared = np.minimum.reduceat(np.append(lengths, 0), pieces)[::2]
    return begin - 1, end, shared


def _resolver(window: int) -> Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    def resolve(values: np.ndarray, offs: np.ndarray, docs: np.ndarray) -> np.ndarray:
        count = len(docs)
        # a mark of its own after each stretch ends all common prefixes there; marks sort below all words
        owner = np.repeat(np.arange(count), np.diff(offs))
        at = np.arange(len(values)) + owner
        symbols = np.empty(len(values) + count, np.int64)
        symbols[at] = np.unique(values, return_inverse=True)[1] + count
        symbols[offs[1:] + np.arange(count)] = np.arange(count)
        order = suffix_order(symbols)
        begin, end, _ = deep_nodes(neighbour_lengths(symbols, order), window)
        found = np.zeros(len(values), bool)
        if not len(begin):
            return found
        leaves = np.repeat(begin - np.append(0, np.cumsum(end - begin)[:-1]), end - begin) \
            + np.arange((end - begin).sum())
        # no leaf of a deep node is a mark, so each is a word of a stretch
        place = np.searchsorted(at, order[leaves])
        doc = docs[owner[place]]
        heads = np.append(0, np.cumsum(end - begin)[:-1])
        found[place] = doc > np.repeat(np.minimum.reduceat(doc, heads), end - begin)
        return found
    return resolve


def word_units(window: int = WINDOW_WORDS) -> Units:
    return Units(window, GRAM_WORDS, _split, sequence_hashes, _resolver(window), True, "uint64")


KEPT = "doc_id long, n_words long, removed array<struct<s: int, e: int>>, kept string"


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offs in chunks(batch, "text"):
            starts, ends, first = words(data, offs)
            raw, counts, runs, kept = data.tobytes(), [], [], []
            for k, ranges in enumerate(part.column(2).to_pylist()):
                a, b = first[k], first[k + 1]
                gone, spans = removed_units(b - a, ranges)
                left = np.flatnonzero(~gone) + a
                counts.append(b - a)
                runs.append([{"s": s, "e": e} for s, e in spans])
                kept.append(b" ".join([raw[s:e] for s, e in zip(starts[left].tolist(), ends[left].tolist())])
                            .decode())
            yield pa.record_batch([
                part.column(0), pa.array(counts, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                pa.array(kept, pa.string())], names=["doc_id", "n_words", "removed", "kept"])


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, n_words, removed (runs of word positions) and kept (words joined by one space)."""
    rows = with_row_ids(docs)
    scratch = Scratch(spark, "substring-dedup")
    ranges = scratch.save(covered_ranges(spark, rows, word_units(window), scratch), "ranges")
    return with_ranges(spark, rows, ranges).mapInArrow(_keep, KEPT)
