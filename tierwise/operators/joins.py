"""Join operators: interval membership, period overlap, anti joins with
explicit null rules, and an as-of lookup with a day tolerance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def merge_intervals(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Disjoint intervals (``entity``, ``start``, ``end``) that cover the same days.

    Rows of one start are first cut to their latest end, so the windows hold at
    most one row per (entity, day), however many rows overlap. An interval opens a
    new island where it starts after the running maximum of the ends before it.
    Rows with a null in any column, or that end before they start, cover no day."""
    reach = (df.filter(F.col(entity).isNotNull() & (F.col(start) <= F.col(end)))
             .groupBy(F.col(entity).alias("__e"), F.col(start).alias("__s")).agg(F.max(end).alias("__t")))
    along = Window.partitionBy("__e").orderBy("__s")
    before = F.max("__t").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("__s") > F.date_add(before, 1)), 1).otherwise(0)
    island = F.sum("__opens").over(along.rowsBetween(Window.unboundedPreceding, 0))
    return (reach.withColumn("__opens", opens).withColumn("__island", island)
            .groupBy(F.col("__e").alias(entity), "__island")
            .agg(F.min("__s").alias(start), F.max("__t").alias(end)).drop("__island"))


def within_interval(left: DataFrame, right: DataFrame, entity: str, day: str,
                    start: str, end: str) -> DataFrame:
    """Rows of ``left`` whose ``day`` lies inside some ``[start, end]`` interval
    of ``right`` for the same ``entity`` (inclusive), each once; only ``left``'s
    columns are returned.

    The intervals are merged first, so a day can lie in one only: the last that
    starts on or before it. That one is carried along the entity's days by a
    running window, one step a row, where a join would compare each day with
    every interval of its entity. ``left`` should hold a bounded number of rows
    per (entity, day), as one call a day does, which bounds a window group by the
    calendar."""
    merged = merge_intervals(right, entity, start, end)
    none = F.lit(None).cast(T.StructType(left.schema.fields))
    days = left.select(F.col(entity).alias("__e"), F.col(day).alias("__d"), F.lit(1).alias("__kind"),
                       F.lit(None).cast("date").alias("__t"), F.struct(*left.columns).alias("__row"))
    opened = merged.select(F.col(entity).alias("__e"), F.col(start).alias("__d"), F.lit(0).alias("__kind"),
                           F.col(end).alias("__t"), none.alias("__row"))
    upto = (Window.partitionBy("__e").orderBy("__d", "__kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # both sides lie by entity already, so the window moves neither again
    known = days.filter(F.col("__e").isNotNull() & F.col("__d").isNotNull()).repartition("__e")
    return (known.unionByName(opened)
            .withColumn("__open", F.last("__t", ignorenulls=True).over(upto))
            .filter(F.col("__row").isNotNull() & (F.col("__open") >= F.col("__d"))).select("__row.*"))


def overlap_periods(df: DataFrame, start: str, end: str, periods: DataFrame,
                    p_start: str = "START_DATE", p_end: str = "END_DATE") -> DataFrame:
    """Pairs each row with every period its ``[start, end]`` overlaps.
    ``periods`` is a handful of rows (built from report parameters), so it is
    broadcast; rows multiply by at most the number of periods."""
    p = F.broadcast(periods)
    cond = (df[start] <= p[p_end]) & (df[end] >= p[p_start])
    return df.join(p, cond, "inner")


def in_periods(df: DataFrame, day: str, periods: DataFrame,
               p_start: str = "START_DATE", p_end: str = "END_DATE") -> DataFrame:
    """Pairs each row with every period containing ``day`` (inclusive)."""
    p = F.broadcast(periods)
    return df.join(p, (df[day] >= p[p_start]) & (df[day] <= p[p_end]), "inner")


def unresolved(left: DataFrame, *resolved: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no match in any of ``resolved`` on ``on``."""
    out = left
    for r in resolved:
        out = out.join(r.select(*on), list(on), "left_anti")
    return out


def not_in(left: DataFrame, key: str, members: DataFrame, member_key: str,
           drop_null_members: bool) -> DataFrame:
    """``left WHERE key NOT IN (SELECT member_key FROM members)``.

    SQL's rule: a null ``key`` never qualifies, and a single null in the set
    empties the result. ``drop_null_members=True`` removes nulls from the set
    first (the ``WHERE x IS NOT NULL`` form)."""
    m = members.select(F.col(member_key).alias("__k"))
    kept = left.filter(F.col(key).isNotNull()).join(
        m.filter(F.col("__k").isNotNull()), F.col(key) == F.col("__k"), "left_anti")
    if drop_null_members:
        return kept
    has_null = F.broadcast(m.filter(F.col("__k").isNull()).limit(1)
                           .select(F.lit(1).alias("__null_in_set")))
    return kept.join(has_null, how="left_anti")


def asof_within(left: DataFrame, right: DataFrame, entity: str, left_day: str,
                right_day: str, right_ts: str, value: str, days: int,
                out_value: str) -> DataFrame:
    """For each (entity, left_day) row of ``left``: the ``value`` of the latest
    ``right`` row (by ``right_ts``, then smallest value, nulls last) whose day
    lies in ``[left_day - days, left_day - 1]``. Rows without any candidate
    are dropped; a candidate with a null value is returned as null.

    No band join (which pairs each call-day with every answer-day of its
    window): the last answer is carried forward in two levels. The last answer of
    each calendar month with any is handed to the months after it, up to the next
    month with answers and as far as ``days`` reach. Then one running window over
    each entity's month holds that answer, the month's own answers and the keys,
    ordered by day (what was handed on first, keys before same-day answers, so only
    earlier days count), then time, then value descending with nulls first - the
    last row before a key is the latest answer, ties to the smallest value, nulls
    last. It counts when it is at most ``days`` old. No window holds more than an
    entity's month, or one row for each of its months, whatever the answer
    density; ``right`` should already be cut to (entity, day, value) rows
    (as ``daily_counts`` does).
    """
    def month(of: Column) -> Column:
        return F.year(of) * 12 + F.month(of)

    answers = right.filter(F.col(entity).isNotNull() & F.col(right_day).isNotNull()).select(
        F.col(entity).alias("__e"), month(F.col(right_day)).alias("__m"),
        F.unix_date(F.col(right_day)).alias("__d"), F.col(right_ts).alias("__ts"), F.col(value).alias("__v"),
        F.struct(F.unix_date(F.col(right_day)).alias("d"), F.col(value).alias("v")).alias("__c"),
    ).repartition("__e", "__m")  # once, for both levels
    kinds = {f.name: f.dataType for f in answers.schema.fields} | {"__day": T.DateType()}
    columns = ["__e", "__m", "__d", "__kind", "__ts", "__v", "__c", "__day"]

    def nothing(*names: str) -> list[Column]:
        return [F.lit(None).cast(kinds[n]).alias(n) for n in names]

    newest = Window.partitionBy("__e", "__m").orderBy(
        F.desc("__d"), F.desc_nulls_last("__ts"), F.asc_nulls_last("__v"))
    month_last = (answers.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1")
                  .select("__e", "__m", "__c"))
    reach = F.col("__m") + days // 28 + 1
    upto = F.least(F.lead("__m").over(Window.partitionBy("__e").orderBy("__m")), reach)
    handed = (month_last.withColumn("__upto", upto)
              .select("__e", F.explode(F.sequence(F.col("__m") + 1, "__upto")).alias("__m"), "__c",
                      F.lit(0).alias("__kind"), *nothing("__d", "__ts", "__v", "__day"))
              .repartition("__e", "__m"))
    keys = (left.filter(F.col(entity).isNotNull() & F.col(left_day).isNotNull())
            .select(F.col(entity).alias("__e"), month(F.col(left_day)).alias("__m"), F.col(left_day).alias("__day"))
            .repartition("__e", "__m").distinct()
            .select("*", F.unix_date("__day").alias("__d"), F.lit(1).alias("__kind"),
                    *nothing("__ts", "__v", "__c")))
    own = answers.select("*", F.lit(2).alias("__kind"), *nothing("__day"))
    before = (Window.partitionBy("__e", "__m")
              .orderBy(F.asc_nulls_first("__d"), "__kind", F.asc_nulls_first("__ts"), F.desc_nulls_first("__v"))
              .rowsBetween(Window.unboundedPreceding, -1))
    found = (own.select(*columns).union(keys.select(*columns)).union(handed.select(*columns))
             .withColumn("__last", F.last("__c", ignorenulls=True).over(before))
             .filter(F.col("__day").isNotNull() & F.col("__last").isNotNull()
                     & (F.col("__last.d") >= F.col("__d") - days)))
    return found.select(F.col("__e").alias(entity), F.col("__day").alias(left_day),
                        F.col("__last.v").alias(out_value))


def joined_count(facts: DataFrame, events: DataFrame, member: str, by: Sequence[str],
                 event_keys: Sequence[str] = (), mode: str = "joined",
                 name: str = "COUNT") -> DataFrame:
    """Counts of ``facts`` joined to ``events`` on ``member``, per
    (``event_keys``, ``by``) - ``by`` are columns of ``facts``, ``event_keys``
    of ``events`` (e.g. a period).

    ``mode="joined"``: the row count of the many-to-many join (each fact once
    per matching event), formed as sum(events of member x facts of member)
    from two per-member aggregates, so no row pair is ever materialized.
    ``mode="goals"``: each fact once when its member has any event (semi join).
    Null members never match."""
    ev = (events.filter(F.col(member).isNotNull())
          .groupBy(*event_keys, member).agg(F.count(F.lit(1)).alias("__events")))
    per_member = (facts.filter(F.col(member).isNotNull())
                  .groupBy(member, *by).agg(F.count(F.lit(1)).alias("__facts")))
    if mode == "joined":
        weight = F.col("__events") * F.col("__facts")
    elif mode == "goals":
        weight = F.col("__facts")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return (ev.join(per_member, member).groupBy(*event_keys, *by)
            .agg(F.sum(weight).cast("long").alias(name)))
