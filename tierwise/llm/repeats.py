"""Repeated windows across texts: where an earlier copy of a window exists.

Shared by the two substring operators, which differ in what a window is made
of and in how a group of candidate stretches is resolved.

Every window of ``window`` units has an anchor: the leftmost smallest hash of
its ``gram``-unit grams. Equal windows have equal anchors at equal offsets, so
consecutive windows with one anchor position form a stretch of at most
``window - gram + 1`` windows, and only stretches under one anchor hash can
hold equal windows. Stretches are about 2 / (window - gram + 2) of the units.

1. Scan: one small row for each stretch (anchor hash, content hash, place).
   Within a chunk of texts, equal stretches collapse to the first; the others
   are covered whole and need no comparison, so that a passage in a third of
   all texts sends one row for each chunk to its anchor.
2. Anchors that occur in one place drop out, in the one shuffle of all rows.
   Equal stretches left are covered whole but for the first occurrence.
3. Distinct stretches under one anchor that agree on one side of it are cut from the texts of their first
   occurrences and dealt by anchor to groups that fit in memory; an anchor with
   very many of them is dealt by further anchors of longer grams as well. The
   resolver marks the windows that have an earlier copy in the group. A group
   that is still above ``CROWDED_UNITS``, as a shared line a little shorter than a
   window makes in texts that differ around it, is never gathered: its windows
   meet by their hashes, each aggregated to its earliest place first.
4. Marked windows go back to the texts as ranges; texts without any are not
   shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.marks import keep_marked, mark_table
from tierwise.llm.scratch import Scratch
from tierwise.llm.text import chunks, mix, powers

#: Distinct stretches of one anchor from which on it is dealt by longer grams too.
WIDE_ANCHOR = 5_000
#: Units that a resolver takes at once (whole groups; one group may be larger).
GROUP_UNITS = 1 << 19

#: Units of a group from which on its windows meet by hash instead.
CROWDED_UNITS = 1 << 21
#: The list of crowded groups is broadcast up to this many rows, else joined.
SMALL_LIST = 100_000

PLACE = ["doc", "rid", "lo"]


@dataclass(frozen=True)
class Units:
    """What windows are made of."""
    window: int
    gram: int
    #: bytes and row offsets -> one value for each unit (bytes or word hashes), and row offsets in units
    split: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    #: values, n -> hash of every n consecutive units
    grams: Callable[[np.ndarray, int], np.ndarray]
    #: values of all stretches, their offsets, their first texts -> for each position whether a window
    #: that starts there has an earlier copy; stretches come in the order of their first occurrence
    resolve: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    #: whether only copies in other texts count
    across: bool
    dtype: str


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def stretches(grams: np.ndarray, first: np.ndarray, window: int,
              gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, anchor hash) of the stretches of windows that share an anchor.

    ``first`` holds the row offsets in units; windows lie within one row.
    """
    if len(grams) < window - gram + 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = sliding_min(grams, window - gram + 1)
    starts = np.arange(len(low))
    row_end = np.repeat(first[1:], np.diff(first))[:len(low)]
    inside = starts + window <= row_end
    # an anchor is left behind where it is the window's first gram, or beaten by a smaller one
    border = np.ones(len(low), bool)
    border[1:] = ((low[1:] != low[:-1]) | (grams[:len(low) - 1] == low[:-1]) | ~inside[:-1])
    border[first[:-1][first[:-1] < len(low)]] = True
    lo = np.flatnonzero(border & inside)
    ends = np.append(np.flatnonzero(border), len(low))
    hi = ends[np.searchsorted(ends, lo, "right")] - 1
    hi = np.minimum(hi, row_end[lo] - window)
    return lo, hi, low[lo]


def range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of values[lo:hi] for each pair."""
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)) * up[:len(values)], out=sums[1:])
    return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64))


#: span packs lo, hi - lo, and SIDE_BITS of a hash of what lies left and right of the anchor;
#: odd spans are covered for sure, from span div 2 up to ctx.
SCAN = "key long, ctx long, doc long, rid long, span long"
SIDE_BITS = 12
_SIDE = 1 << SIDE_BITS
_WIDTH = 1 << 7


def anchors_of(grams: np.ndarray, key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The anchor's position in each stretch: the first gram at or after its last window's start."""
    place = hi.copy()
    live = np.flatnonzero(grams[place] != key)
    while len(live):
        place[live] += 1
        live = live[grams[place[live]] != key[live]]
    return place


def _sides(units: Units, values: np.ndarray, first: np.ndarray, row: np.ndarray,
           anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the units left and right of each anchor, half a window's rest on either side.

    Equal windows agree on one of the two sides, whatever the anchor's offset.
    """
    half = -(-(units.window - units.gram) // 2)
    end = anchor + units.gram
    left = range_hashes(values, np.maximum(anchor - half, first[row]), anchor)
    right = range_hashes(values, end, np.minimum(end + half, first[row + 1]))
    return left >> np.uint64(64 - SIDE_BITS), right >> np.uint64(64 - SIDE_BITS)


def _merged(rid: np.ndarray, lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, start and end of the joint ranges of overlapping ones; rows sorted by (rid, lo)."""
    if not len(rid):
        return np.zeros(0, np.int64), lo, end
    group = np.cumsum(np.append(True, rid[1:] != rid[:-1])) - 1
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    fresh = np.append(True, (group[1:] != group[:-1]) | (lo[1:] > reach[:-1]))
    heads = np.flatnonzero(fresh)
    return heads, lo[heads], reach[np.append(heads[1:], len(lo)) - 1]


def _scan(units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in chunks(batch, "text"):
                values, first = units.split(data, offs)
                grams = units.grams(values, units.gram)
                lo, hi, key = stretches(grams, first, units.window, units.gram)
                row = np.searchsorted(first, lo, "right") - 1
                ctx = range_hashes(values, lo, hi + units.window)
                left, right = _sides(units, values, first, row, anchors_of(grams, key, lo, hi))
                doc = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[row]
                rid = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[row]
                lo, hi = lo - first[row], hi - first[row]
                order = np.lexsort((lo, rid, doc, ctx, key))
                key, ctx, doc, rid, lo, hi, left, right = (
                    x[order] for x in (key, ctx, doc, rid, lo, hi, left, right))
                fresh = np.append(True, (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1]))[:len(key)]
                head = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                sure = doc > doc[head]
                if not units.across:
                    sure |= (doc == doc[head]) & ((rid != rid[head]) | (lo > lo[head]))
                span = (((lo * _WIDTH + (hi - lo)) * _SIDE + left.astype(np.int64)) * _SIDE
                        + right.astype(np.int64)) * 2
                at = np.flatnonzero(sure)
                at = at[np.lexsort((lo[at], rid[at]))]
                heads, begin, end = _merged(rid[at], lo[at], hi[at] + units.window)
                own = at[heads]
                open_ = ~sure
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in (
                    # what is covered for sure needs no anchor and is dealt anywhere
                    (key[open_].view(np.int64), mix(rid[own].view(np.uint64) + begin.astype(np.uint64)).view(np.int64)),
                    (ctx[open_].view(np.int64), end), (doc[open_], doc[own]), (rid[open_], rid[own]),
                    (span[open_], begin * 2 + 1))], names=["key", "ctx", "doc", "rid", "span"])
    return run


CUT = "gkey long, doc long, rid long, lo int, units binary"


def _cut(units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The stretches of each text: (text, wanted) -> one row each, or several for wide anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in chunks(batch, "text"):
                values, first = units.split(data, offs)
                values = values.astype(units.dtype, copy=False)
                rows = []
                for k, wanted in enumerate(part.column(part.schema.get_field_index("wanted")).to_pylist()):
                    for w in wanted:
                        lo, end = first[k] + w["lo"], first[k] + w["hi"] + units.window
                        if not w["wide"]:
                            rows.append((w["key"], w["doc"], w["rid"], w["lo"], values[lo:end].tobytes()))
                            continue
                        for rel, to, deeper in _deeper(units, values[lo:end], w["key"]):
                            rows.append((deeper, w["doc"], w["rid"], w["lo"] + rel,
                                         values[lo + rel:lo + to + units.window].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (
                            pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                        names=["gkey", *PLACE, "units"])
    return run


def _deeper(units: Units, values: np.ndarray, key: int) -> Iterator[tuple[int, int, int]]:
    """Parts (lo, hi, group) of one stretch by its anchor and those of two, four, ... times longer grams."""
    count = len(values) - units.window + 1
    group = np.full(count, key, np.int64).view(np.uint64)
    gram = 2 * units.gram
    while gram <= units.window:
        low = sliding_min(units.grams(values, gram), units.window - gram + 1)[:count]
        group = mix(group * np.uint64(0x9E3779B97F4A7C15) + low)
        gram *= 2
    border = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    for lo, end in zip(border, np.append(border[1:], count)):
        yield int(lo), int(end) - 1, int(group[lo:lo + 1].view(np.int64)[0])


RESOLVED = "rid long, s int, e int"


def _resolve(units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by group -> ranges of a text that windows with an earlier copy cover."""
    def marked(rows: list[dict]) -> pa.RecordBatch | None:
        rows.sort(key=lambda r: (r["doc"], r["rid"], r["lo"]))
        parts = [np.frombuffer(r["units"], units.dtype) for r in rows]
        offs = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=offs[1:])
        found = units.resolve(np.concatenate(parts), offs, np.array([r["doc"] for r in rows], np.int64))
        edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(begins):
            return None
        owner = np.searchsorted(offs, begins, "right") - 1
        shift = np.array([r["lo"] for r in rows], np.int64)[owner] - offs[owner]
        return pa.record_batch([
            pa.array(np.array([r["rid"] for r in rows], np.int64)[owner]),
            pa.array((begins + shift).astype(np.int32)),
            pa.array((ends - 1 + units.window + shift).astype(np.int32))], names=["rid", "s", "e"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > GROUP_UNITS and row["gkey"] != rows[-1]["gkey"]:
                    got = marked(rows)
                    if got:
                        yield got
                    rows, size = [], 0
                rows.append(row)
                size += len(row["units"]) // np.dtype(units.dtype).itemsize
        if rows:
            got = marked(rows)
            if got:
                yield got
    return run


def _windows(units: Units) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stretches of crowded groups -> one narrow row for each of their windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, *place, raw = (batch.column(k) for k in range(5))
            doc, rid, lo = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in place)
            for at in range(0, batch.num_rows, _ROWS):
                parts = [np.frombuffer(b, units.dtype) for b in raw.slice(at, _ROWS).to_pylist()]
                offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                count = np.array([len(p) for p in parts]) - units.window + 1
                row = np.repeat(np.arange(len(parts)), count)
                start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                begin = offs[row] + start
                wide = range_hashes(np.concatenate(parts), begin, begin + units.window)
                yield pa.record_batch([pa.array(wide.view(np.int64)), pa.array(doc[at + row]),
                                       pa.array(rid[at + row]), pa.array((lo[at + row] + start).astype(np.int32))],
                                      names=["window", *PLACE])
    return run


_ROWS = 1 << 12


def _resolved_by_hash(crowded: DataFrame, units: Units) -> DataFrame:
    """(rid, r): windows of crowded groups with an earlier copy, of equal 64-bit hash."""
    windows = crowded.select("gkey", *PLACE, "units").mapInArrow(
        _windows(units), "window long, doc long, rid long, lo int").distinct()
    place = F.col("doc") if units.across else F.struct(*PLACE)
    first = (windows.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first < last").select("window", "first"))
    return (windows.join(first, "window").where(place > F.col("first"))
            .select("rid", F.struct(F.col("lo").alias("s"), (F.col("lo") + units.window).alias("e")).alias("r")))


def first_in_class(label: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of the positions ``at`` (ascending) the first position with the same label."""
    order = np.argsort(label, kind="stable")
    fresh = np.append(True, label[order][1:] != label[order][:-1])
    first = np.empty(len(at), np.int64)
    first[order] = at[order][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    return first


def with_row_ids(docs: DataFrame) -> DataFrame:
    """doc (ids; null ones last), rid (a hash of id and text), text (null: empty), doc_id."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).select("doc", F.xxhash64("doc", "text").alias("rid"), "text", "doc_id")


def covered_ranges(spark: SparkSession, rows: DataFrame, units: Units, scratch: Scratch) -> DataFrame:
    """(rid, ranges): the covered stretches [s, e) of each text that has any, in units."""
    seen = rows.select("doc", "rid", "text").mapInArrow(_scan(units), SCAN)
    side = 2 * _SIDE
    # dealt by anchor once, as narrow rows; all windows below are within one anchor
    seen = seen.repartition("key").selectExpr(
        "key", "ctx", "doc", "rid", "span", "span % 2 = 1 as sure",
        f"int((span div {side}) % {_SIDE}) as left", f"int((span div 2) % {_SIDE}) as right")
    place = F.col("doc") if units.across else F.struct("doc", "rid", "span")
    first = F.min(place).over(Window.partitionBy("key", "ctx"))
    places = ["doc"] if units.across else ["rid", "span"]
    ends = [f(name).over(Window.partitionBy("key")).alias(f"{end}_{name}")
            for name in places for end, f in (("low", F.min), ("high", F.max))]
    several = " or ".join(f"low_{name} < high_{name}" for name in places)
    placed = (seen.select("*", (place > first).alias("later"), *ends).where(f"sure or {several}")
              .select("key", "ctx", "doc", "rid", "span", "sure", "later", "left", "right",
                      F.expr("int(not sure and not later)").alias("own")))
    # stretches of one anchor are compared where they agree with another on one side of it
    counts = [F.sum("own").over(Window.partitionBy("key", *by)).alias(name)
              for name, by in (("n", []), ("n_left", ["left"]), ("n_right", ["right"]))]
    kept = scratch.save(
        placed.select("*", *counts).where("sure or later or n_left > 1 or n_right > 1")
        .selectExpr("key", "ctx", "doc", "rid", "sure or later as whole", f"n > {WIDE_ANCHOR} as wide",
                    f"int(if(sure, span div 2, span div {side * _SIDE * _WIDTH})) as lo",
                    f"int(if(sure, ctx - {units.window}, span div {side * _SIDE * _WIDTH}"
                    f" + (span div {side * _SIDE}) % {_WIDTH})) as hi"), "repeated")
    whole = kept.where("whole").select(
        "rid", F.struct(F.col("lo").alias("s"), (F.col("hi") + units.window).alias("e")).alias("r"))

    wanted = scratch.save(
        kept.where("not whole").groupBy("rid")
        .agg(F.collect_set(F.struct("key", "ctx", "doc", "rid", "lo", "hi", "wide")).alias("wanted")), "wanted")
    marks = spark.sparkContext.broadcast(mark_table(wanted.select("rid")))
    texts = (rows.select("rid", "text").mapInArrow(keep_marked(marks), "rid long, text string")
             .dropDuplicates(["rid"]).join(wanted, "rid"))
    cut = scratch.save(texts.mapInArrow(_cut(units), CUT), "cut")
    size = F.sum(F.length("units")) / np.dtype(units.dtype).itemsize
    crowded, (many,) = scratch.save_observed(
        cut.groupBy("gkey").agg(size.alias("size")).where(F.col("size") > CROWDED_UNITS).select("gkey"),
        "crowded", ["count(1)"])
    if many:
        listed = F.broadcast(crowded) if many <= SMALL_LIST else crowded
        whole = whole.union(_resolved_by_hash(cut.join(listed, "gkey", "left_semi"), units))
        cut = cut.join(listed, "gkey", "left_anti")
    groups = cut.repartition("gkey").sortWithinPartitions("gkey")
    inner = groups.mapInArrow(_resolve(units), RESOLVED).select("rid", F.struct("s", "e").alias("r"))
    return whole.union(inner).groupBy("rid").agg(F.collect_set("r").alias("ranges"))


def with_ranges(spark: SparkSession, rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, text, ranges) of every row; only texts that may have ranges are shuffled."""
    schema = "rid long, doc_id long, text string"
    texts = rows.select("rid", "doc_id", "text")
    marks = spark.sparkContext.broadcast(mark_table(ranges.select("rid")))
    some = texts.mapInArrow(keep_marked(marks), schema).join(ranges, "rid", "left").drop("rid")
    none = texts.mapInArrow(keep_marked(marks, False), schema) \
        .select("doc_id", "text", F.lit(None).cast("array<struct<s: int, e: int>>").alias("ranges"))
    return some.select("doc_id", "text", "ranges").union(none)


def removed_units(count: int, ranges: list[dict] | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Whether each unit is covered, and the maximal covered runs."""
    steps = np.zeros(count + 1, np.int64)
    for r in ranges or []:
        steps[r["s"]] += 1
        steps[r["e"]] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    return gone, list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
