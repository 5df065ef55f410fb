"""Bit masks: the labels or periods of a member in one row.

A mask replaces one row for each (member, label, period). Facts then join one row
a member, equal masks are counted together, and only those counts are taken apart
into labels, so no fact is multiplied by the labels or periods of its member.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels in one mask; further labels go to further words, a row each.
WORD = 63
_LABELS = "__labels"


def has_bit(mask: Column, bit: int) -> Column:
    return F.shiftright(mask, bit).bitwiseAND(1) == 1


def period_mask(day: Column, bounds: Mapping[str, tuple[Column, Column]]) -> Column:
    """Bit i tells whether ``day`` lies in the i-th period (inclusive); a null day in none."""
    return overlap_mask(day, day, bounds)


def overlap_mask(start: Column, end: Column, bounds: Mapping[str, tuple[Column, Column]]) -> Column:
    """Bit i tells whether ``[start, end]`` overlaps the i-th period."""
    mask = F.lit(0)
    for i, (first, last) in enumerate(bounds.values()):
        mask = mask + F.when((start <= last) & (end >= first), 1 << i).otherwise(0)
    return mask


def labels_of(df: DataFrame, label: str) -> DataFrame:
    """One row with the sorted distinct labels of ``df`` (a closed list of report labels)."""
    return F.broadcast(df.agg(F.array_sort(F.collect_set(label)).alias(_LABELS)))


def label_masks(df: DataFrame, keys: Sequence[str], label: str, labels: DataFrame,
                slots: Mapping[str, Column]) -> DataFrame:
    """(*keys, __word, a mask for each slot): the labels that a key has in the rows of a slot.

    One row a key, unless there are more than ``WORD`` labels."""
    place = F.array_position(_LABELS, F.col(label)).cast("int") - 1
    placed = df.crossJoin(labels).select(*keys, place.alias("__place"),
                                         *[test.alias(f"__in_{name}") for name, test in slots.items()])
    bit = F.expr(f"shiftleft(1L, pmod(__place, {WORD}))")
    return (placed.groupBy(*keys, F.floor(F.col("__place") / WORD).cast("int").alias("__word"))
            .agg(*[F.bit_or(F.when(F.col(f"__in_{name}"), bit).otherwise(0)).alias(name) for name in slots]))


def counted(masks: DataFrame, slots: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows of equal masks (and ``by``) counted together as ``__n``."""
    return masks.groupBy("__word", *by, *slots).agg(F.count(F.lit(1)).alias("__n"))


def by_label(counts: DataFrame, labels: DataFrame, slots: Sequence[str], label: str,
             slot: str = "__slot") -> DataFrame:
    """Counted masks as rows (slot, label) with the other columns of ``counts``."""
    rest = [c for c in counts.columns if c not in ("__word", *slots)]
    each = F.array(*[F.struct(F.lit(name).alias(slot), F.col(name).alias("__mask")) for name in slots])
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)),
                      lambda i: F.call_function("shiftright", F.col("__mask"), i).bitwiseAND(1) == 1)
    return (counts.select("__word", *rest, F.inline(each)).filter(F.col("__mask") != 0)
            .select("__word", *rest, slot, F.explode(places).alias("__bit")).crossJoin(labels)
            .select(slot, F.get(_LABELS, F.col("__word") * WORD + F.col("__bit")).alias(label), *rest))
