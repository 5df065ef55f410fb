"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are compared in lower case with white space collapsed. An
item of m characters may differ by k = floor(m * error_percent / 100) edits, so
if it is split into k + 1 pieces, one of them survives any such k edits
unchanged. One automaton finds every exact piece hit of a text in one pass; a
hit fixes where the item would lie, and Myers' bit-parallel algorithm gives the
smallest edit distance of the whole item there.

Items travel in blocks of at most ``block_bytes``; every block meets all texts.
Nothing is shuffled, and the work on a text depends on its own hits alone.

Defined results: null or blank texts and items match nothing; an item too short
for one error must occur exactly; rows with a null id keep it; repeated rows
each give their matches; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR_PERCENT = 6
BLOCK_BYTES = 8 << 20

MATCH_SCHEMA = "doc_id long, item_id long, distance int, text_start long, text_end long"


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def error_budget(length: int, error_percent: int) -> int:
    return length * error_percent // 100


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """The text cut into budget + 1 pieces of nearly equal length, with their offsets."""
    cuts = [len(text) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def best_match(masks: dict[str, int], m: int, window: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best place of a pattern in a window, if within the budget."""
    full = (1 << m) - 1
    top = 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end, last = budget + 1, -1, len(window)
    get = masks.get
    for j, c in enumerate(window):
        eq = get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, end = score, j + 1
            if best == 0:
                break
        elif score - (last - 1 - j) >= best:
            break  # each later column lowers the score by one at most
        up = (up << 1) & full
        plus = ((down << 1) & full) | (full & ~(vertical | up))
        minus = up & vertical
    return (best, end) if end >= 0 else None


class Matcher:
    """All items of one block, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int, str]], error_percent: int) -> None:
        self.items = [(i, t, error_budget(len(t), error_percent), pattern_masks(t))
                      for i, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, budget, _) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                found.setdefault(piece, []).append((k, offset + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, places)
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> Iterator[tuple[int | None, int, int, int]]:
        """(item id, distance, start, end) of the best place of each item found."""
        flat = normalized(text)
        if not flat or not len(self.automaton):
            return
        starts: dict[int, list[int]] = {}
        for at, places in self.automaton.iter(flat):
            for k, back in places:
                starts.setdefault(k, []).append(at - back)
        for k, begun in starts.items():
            item, pattern, budget, masks = self.items[k]
            best = None
            begun = sorted(set(begun))
            while begun and (best is None or best[0]):
                first = last = begun[0]
                rest = 0
                while rest < len(begun) and begun[rest] - last <= 2 * budget:
                    last = begun[rest]
                    rest += 1
                begun = begun[rest:]
                low = max(0, first - budget)
                got = best_match(masks, len(pattern),
                                 flat[low:last + len(pattern) + budget], budget)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], max(0, low + got[1] - len(pattern)), low + got[1])
            if best:
                yield item, *best


def _find(items: object, error_percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, error_percent)
        for batch in batches:
            rows = [(doc.as_py(), *match)
                    for doc, text in zip(batch.column(0), batch.column(1))
                    for match in matcher.matches(text.as_py())]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "distance", "text_start", "text_end"])
    return run


def _without_match(items: object, column: int, error_percent: int) -> Callable[
        [Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items.value, error_percent)
        for batch in batches:
            clean = [next(matcher.matches(text.as_py()), None) is None for text in batch.column(column)]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Normalized items, a bounded block at a time."""
    block, size = [], 0
    for row in items.toLocalIterator():
        text = normalized(row.text)
        if not text:
            continue
        if block and size + 4 * len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += 4 * len(text)
    if block:
        yield block


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                            F.col("text").cast("string").alias("text"))


def benchmark_matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                      error_percent: int = ERROR_PERCENT,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, distance, text_start, text_end) of each item found in each text.

    Places are code points of the normalized text; the start is the end less
    the item's length.
    """
    items = _items(benchmark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    found = [texts.mapInArrow(_find(spark.sparkContext.broadcast(block), error_percent), MATCH_SCHEMA)
             for block in _blocks(items, block_bytes)]
    if not found:
        return spark.createDataFrame([], MATCH_SCHEMA)
    return reduce(DataFrame.union, found)


def drop_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                      error_percent: int = ERROR_PERCENT,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found."""
    for block in _blocks(_items(benchmark), block_bytes):
        keep = _without_match(spark.sparkContext.broadcast(block), docs.columns.index("text"), error_percent)
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
