"""Time-ordered operators: gaps between events, day-window matching, nearest
events of another stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefns import day_diff


def with_previous(df: DataFrame, key: str, order: str, prev_name: str,
                  gap_name: str | None = None) -> DataFrame:
    """Add the previous ``order`` value per ``key`` and, optionally, the
    day gap to it.

    One shuffle on ``key``; rows of one key are sorted within its task.
    The input should be at (key, day) grain, which bounds a key's rows by
    the number of days it spans rather than by data volume.
    """
    # NULL days sort last, as in the source's warehouse (Spark's default
    # would put them first and change the lag of the rows around them)
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    out = df.withColumn(prev_name, F.lag(order, 1).over(w))
    if gap_name:
        out = out.withColumn(gap_name, day_diff(prev_name, order))
    return out


def within_days(left_time: Column, right_time: Column, days: int) -> Column:
    """``right_time::date BETWEEN left_time - days AND left_time + days``.

    The bounds keep the time of day of ``left_time`` (they are timestamps),
    so the lower-bound day only matches when ``left_time`` is at midnight.
    """
    lo = left_time - F.make_dt_interval(F.lit(days))
    hi = left_time + F.make_dt_interval(F.lit(days))
    d = F.to_date(right_time)
    return (d >= lo) & (d <= hi)


def with_nearest(events: DataFrame, others: DataFrame, key: str, at: str, last: str, next_: str) -> DataFrame:
    """``events`` with the times (``at``) of the latest row of ``others`` of the
    same ``key`` that is not later, and of the earliest that is not earlier.

    Both streams are put together and sorted by time within the key, and the
    last time seen is carried forwards, then backwards: one shuffle, no join
    and so no pairs, however many of the one stream lie near one of the other.
    Whether some row lies within given bounds around an event is told by these
    two alone.  Both frames only grow.

    Each stream should be at a grain that bounds a key's rows (days, say).
    NULL keys meet nothing, and a NULL time of ``others`` is never the nearest.
    Repeated events stay repeated.  ``key`` and ``at`` must have the same types
    on both sides.
    """
    found = others.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        key, at, *(F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name not in (key, at)),
        F.col(at).alias("_other"))
    both = events.withColumn("_other", F.lit(None).cast(others.schema[at].dataType)).unionByName(found)
    both = both.withColumn("_is_other", F.col("_other").isNotNull())
    # rows of one time are peers in a range frame: "not later" includes "at the same time"
    frame = lambda order: (Window.partitionBy(key).orderBy(order)
                           .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (both.withColumn(last, F.max("_other").over(frame(F.col(at).asc_nulls_first())))
            .withColumn(next_, F.min("_other").over(frame(F.col(at).desc_nulls_first())))
            .where(~F.col("_is_other")).drop("_other", "_is_other"))
