"""Grouping operators: top-1 per group, frequency tie-break, numbering,
distinct counts, crosstabs and shares of a total.

Scale notes. Top-1 uses ``row_number() == 1``; Catalyst plans it as a
partial ``WindowGroupLimit`` before the shuffle, so a hot group sends at most
one row per map task. The frequency tie-break aggregates to one row per
(entity, day, value) before any window, so its window groups are bounded by
the number of calendar days, however skewed the raw rows are. Numbering cuts a
group into buckets along its order, and crowded buckets into slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pct

Cols = Sequence[str | Column]


def _cols(names: Cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def latest_per_group(df: DataFrame, keys: Cols, order: Cols) -> DataFrame:
    """The first row of each ``keys`` group under ``order`` (ties must be
    broken by ``order`` itself for a deterministic result)."""
    rn = "__rn"
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def daily_counts(df: DataFrame, entity: str, day: str, value: str, ts: str) -> DataFrame:
    """One row per (entity, day, value) with its row count ``__n`` and latest
    timestamp ``__last`` (null values form their own group). A partial
    aggregation, so a hot entity is reduced on the map side; the result feeds
    both the frequency tie-break and the as-of look-back."""
    return df.groupBy(entity, day, value).agg(F.count(F.lit(1)).alias("__n"),
                                              F.max(ts).alias("__last"))


def frequency_tiebreak(df: DataFrame, entity: str, day: str, value: str,
                       count_col: str | None = None, freq_col: str = "FREQ") -> DataFrame:
    """One ``value`` per (entity, day): the one the entity gave most often over
    its whole history; equal counts go to the smallest value. Null values never
    take part (an equality join on the value would drop them).

    ``df`` holds raw rows, or per-(entity, day, value) counts in ``count_col``.
    After that aggregation an entity holds at most days x values rows, however
    skewed the raw rows are, so the reduced rows are hash-partitioned by the
    entity once: both windows - (entity, value) and (entity, day) - then run
    on that partitioning without another shuffle."""
    daily = df.filter(F.col(value).isNotNull())
    if count_col is None:
        daily = daily.groupBy(entity, day, value).agg(F.count(F.lit(1)).alias("__n"))
        count_col = "__n"
    daily = daily.repartition(entity)
    per_value = Window.partitionBy(entity, value)
    scored = daily.withColumn(freq_col, F.sum(count_col).over(per_value))
    best = latest_per_group(scored, [entity, day], [F.desc(freq_col), F.asc(value)])
    return best.select(entity, day, value)


#: Rows of a bucket from which it is cut, rows of the sketch that cuts come from, sketch rows a slice.
SLICE_ROWS = 100_000
SKETCH_ROWS = 1 << 14
SKETCH_PER_SLICE = 16


def _order_key(columns: Sequence[str]) -> Column:
    """A struct that sorts as ``columns`` do ascending with nulls last."""
    return F.struct(*[c for i, name in enumerate(columns)
                      for c in (F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}"))])


def _place(splits: Column, key: Column, most: int) -> Column:
    """How many of the sorted ``splits`` (at most ``most``) are not above ``key``, by halving."""
    def halve(at: Column, _: Column) -> Column:
        middle = F.shiftright(at["lo"] + at["hi"], 1)
        return (F.when(at["lo"] >= at["hi"], at)
                .when(F.get(splits, middle) <= key, F.struct((middle + 1).alias("lo"), at["hi"].alias("hi")))
                .otherwise(F.struct(at["lo"].alias("lo"), middle.alias("hi"))))
    start = F.struct(F.lit(0).alias("lo"), F.size(splits).alias("hi"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(most.bit_length())), start, halve, lambda at: at["lo"])
    return F.when(splits.isNull(), 0).otherwise(found)


def order_slices(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str,
                 rows: int = SLICE_ROWS, sketch: int = SKETCH_ROWS) -> DataFrame:
    """Adds ``name``: the slice of each row inside its ``keys`` group, rising along
    ``columns`` (ascending, nulls last); rows equal in them share a slice.

    The cuts are quantiles from a sketch: the ``sketch`` rows with the smallest
    hashes, which every task keeps for itself before they are merged, among one
    row in ``rows`` / 16. So a slice holds about ``rows`` rows, or a thousandth of
    all rows where that is more, however the groups' sizes differ; a group of
    fewer rows stays whole. The cuts are at most ``sketch`` keys whatever the
    input's size, which is what makes them safe to broadcast."""
    mark = F.xxhash64(*keys, *columns)
    every = max(1, rows // SKETCH_PER_SLICE)
    kept = (df.select(*keys, _order_key(columns).alias("__key"), mark.alias("__mark"))
            .filter(F.pmod("__mark", F.lit(every)) == 0).distinct()
            .orderBy("__mark").limit(sketch))
    splits = (kept.groupBy(*keys).agg(F.array_sort(F.collect_set("__key")).alias("__keys"))
              .select(*keys, F.filter("__keys", lambda _, i: i % SKETCH_PER_SLICE == SKETCH_PER_SLICE - 1)
                      .alias("__splits"))
              .filter(F.size("__splits") > 0))
    most = max(1, sketch // SKETCH_PER_SLICE)
    return (df.join(F.broadcast(splits), list(keys), "left")
            .withColumn(name, _place(F.col("__splits"), _order_key(columns), most)).drop("__splits"))


def number_in_group(df: DataFrame, keys: Sequence[str], order: Cols, name: str,
                    bucket: Column | None = None, groups: DataFrame | None = None,
                    slice_by: Sequence[str] = (), slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``row_number()`` of each row inside its ``keys`` group (column names)
    under ``order`` (a total order, for a deterministic result).

    Without ``bucket`` this is the plain window: one task per group. With it,
    a group is cut into buckets that follow the order (a non-null function of
    its first column that never falls along it): rows are counted per (group,
    bucket) with partial counts, the counts before each bucket are summed, and
    rows are numbered inside their bucket and shifted by that sum. Only the
    counts are brought together by group.

    ``slice_by`` names the columns of ``order``, where that is ascending with
    nulls last: buckets above about ``slice_rows`` rows are then cut further by
    ``order_slices``, so a group whose rows all share one bucket spreads too.

    ``groups`` (one row per group) adds its columns and drops the rows of all
    other groups; it meets the counts, so such rows go no further than the
    one join on (group, bucket). Null keys match nothing there."""
    key_names = list(keys)
    if bucket is None:
        w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
        numbered = df.withColumn(name, F.row_number().over(w).cast("long"))
        return numbered if groups is None else numbered.join(groups, key_names)
    cut, parts = df.withColumn("__bucket", bucket), ["__bucket"]
    if slice_by:
        cut = order_slices(cut, [*key_names, "__bucket"], slice_by, "__slice", slice_rows)
        parts.append("__slice")
    earlier = Window.partitionBy(*key_names).orderBy(*parts).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(*key_names, *parts).agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
               .drop("__n"))
    if groups is not None:
        offsets = offsets.join(groups, key_names)
    inside = Window.partitionBy(*key_names, *parts).orderBy(*_cols(order))
    return (cut.join(offsets, [*key_names, *parts])
            .withColumn(name, (F.row_number().over(inside) + F.col("__offset")).cast("long"))
            .drop("__offset", *parts))


def distinct_members(df: DataFrame, group: Cols, member: str,
                     name: str = "MEMBERS") -> DataFrame:
    """Exact distinct count of ``member`` per group (nulls not counted)."""
    return df.groupBy(*_cols(group)).agg(F.countDistinct(member).alias(name))


def one_row_totals(df: DataFrame, **aggs: Column) -> DataFrame:
    """A one-row aggregate, safe to broadcast (its size is one row by construction)."""
    return F.broadcast(df.agg(*[c.alias(n) for n, c in aggs.items()]))


def share_of_total(df: DataFrame, count_col: str, scale: int, name: str) -> DataFrame:
    """Adds ``name`` = ``count_col`` as a percentage of its column total.

    ``df`` is an aggregate (one row per label), so the one-row total is
    broadcast to it."""
    total = one_row_totals(df, __total=F.sum(count_col))
    return df.crossJoin(total).withColumn(name, pct(F.col(count_col), F.col("__total"), scale)) \
        .drop("__total")


def status_crosstab(df: DataFrame, group: Cols, column: str,
                    values: Sequence[tuple[str, str, str | None]], scale: int,
                    total_name: str | None = None) -> DataFrame:
    """Per group: for each (value, count name, pct name) the number of rows with
    ``column == value`` and its share of the group's rows (``pct name`` None
    skips the share). One aggregation pass, partial on the map side."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for value, count_name, _ in values:
        aggs.append(F.sum(F.when(F.col(column) == value, 1).otherwise(0)).cast("long")
                    .alias(count_name))
    out = df.groupBy(*_cols(group)).agg(*aggs)
    select: list[str | Column] = list(group)
    if total_name:
        select.append(F.col("__rows").alias(total_name))
    for _, count_name, pct_name in values:
        select.append(count_name)
        if pct_name:
            select.append(pct(F.col(count_name), F.col("__rows"), scale).alias(pct_name))
    return out.select(*select)
