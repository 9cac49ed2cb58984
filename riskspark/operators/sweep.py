"""Distinct members per calendar week by signed deltas.

``count(distinct member)`` per (group, week) over members that are visible on
ranges of days needs no row per (member, week).  A member's ranges, taken to
the calendar weeks they meet and merged where they share a week, give +1 at
the first week and -1 behind the last; summed per (group, place) before the
shuffle, the deltas of a group are at most two a week, and their running sum
is the count from one place to the next.  Only these sums are spread over the
weeks they hold for, so rows are as many as the result has.

A calendar may have holes.  ``WeekLookup`` turns it into a table with a row
for each day of the report's range, which that range bounds whatever the data:
a range of days becomes a range of weeks by equi-joins with it.  All joins read
the same columns of it, so it is computed and broadcast once.  Weeks are named
by their Mondays.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEK_STEP = "INTERVAL 7 DAYS"


def monday(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


class WeekLookup:
    """Weeks by day of ``[lo, hi]``: for each kind of point (a calendar day, a
    week's first or last day), the first week with one at or after a day, and
    the last with one at or before it."""

    def __init__(self, calendar: DataFrame, lo: dt.date, hi: dt.date, points: Sequence[str] = ("report_date",),
                 week: str = "week"):
        self._lo, self._hi, self._points = lo, hi, list(points)
        stacked = calendar.select(F.col(week).alias("_week"), F.inline(F.array(*(
            F.struct(F.lit(p).alias("_kind"), F.col(p).alias("_day")) for p in points))))
        of = lambda p: F.when(F.col("_kind") == p, F.col("_week"))
        at = stacked.where(F.col("_day").between(F.lit(lo), F.lit(hi))).groupBy("_day").agg(
            *(F.min(of(p)).alias(f"{p}_first") for p in points), *(F.max(of(p)).alias(f"{p}_last") for p in points))
        days = calendar.sparkSession.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("_day"))
        back = Window.orderBy(F.col("_day").desc()).rowsBetween(Window.unboundedPreceding, 0)
        forth = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
        # one array, not columns: whatever a join needs of it, all read the same
        self._days = days.join(at, "_day", "left").select("_day", F.array(
            *(x for p in points for x in (F.min(f"{p}_first").over(back), F.max(f"{p}_last").over(forth),
                                          F.min(F.when(F.col(f"{p}_first").isNotNull(), F.col("_day"))).over(back)))
        ).alias("_near"))

    def _join(self, rows: DataFrame, day: Column, point: str, **places: int) -> DataFrame:
        joined, at = rows.join(F.broadcast(self._days), day == F.col("_day")), 3 * self._points.index(point)
        found = joined.select(*rows.columns, *(F.get("_near", F.lit(at + k)).alias(n) for n, k in places.items()))
        return found.where(F.col(next(iter(places))).isNotNull())

    def with_first_after(self, rows: DataFrame, day: Column, name: str, point: str = "report_date") -> DataFrame:
        """Rows with the first week at or after ``day``, and the point that it
        has there (``<name>_point``); rows without one go."""
        bounded = F.when(day.isNotNull(), F.greatest(day, F.lit(self._lo)))
        return self._join(rows, bounded, point, **{name: 0, f"{name}_point": 2})

    def with_last_before(self, rows: DataFrame, day: Column, name: str, point: str = "report_date") -> DataFrame:
        """Rows with the last week at or before ``day``; rows without one go."""
        return self._join(rows, F.when(day.isNotNull(), F.least(day, F.lit(self._hi))), point, **{name: 1})


def to_weeks(intervals: DataFrame, lookup: WeekLookup, start: str = "cover_start", end: str = "cover_end",
             first: str = "first_week", last: str = "last_week") -> DataFrame:
    """Day ranges as ranges of the calendar weeks they meet; ranges that meet
    no calendar day are dropped.  A week between the first and the last lies
    wholly in the range, so it is met if it has a calendar day at all."""
    out = lookup.with_first_after(intervals, F.col(start), first)
    out = lookup.with_last_before(out.where(F.col(f"{first}_point") <= F.col(end)), F.col(end), last)
    return out.drop(start, end, f"{first}_point")


def merge_overlaps(intervals: DataFrame, keys: Sequence[str], start: str = "first_week",
                   end: str = "last_week") -> DataFrame:
    """Per ``keys``, the union of the ranges as disjoint ranges."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = intervals.select(*keys, start, end, F.when(F.col(start) <= reach, 0).otherwise(1).alias("_new"))
    numbered = marked.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_run")


def deltas(first: Column, last: Column, **amounts: Column) -> Column:
    """The two events of a range, as an array: ``place`` and the amounts, and
    behind the last week the same amounts taken back.  Mondays are a week
    apart, so the day after one is behind it and before the next."""
    def event(place: Column, sign: int) -> Column:
        return F.struct(place.alias("place"), *((sign * a).alias(n) for n, a in amounts.items()))
    return F.array(event(first, 1), event(F.date_add(last, 1), -1))


def running_counts(events: DataFrame, keys: Sequence[str], amounts: Sequence[str], lookup: WeekLookup,
                   week: str = "week") -> DataFrame:
    """``keys``, ``week``, ``amounts``: the running sums of the events, at
    every week of the calendar at which some amount is not zero."""
    per_place = events.groupBy(*keys, "place").agg(*(F.sum(a).alias(a) for a in amounts))
    w = Window.partitionBy(*keys).orderBy("place")
    sums = per_place.select(
        *keys, "place", F.lead("place").over(w).alias("_next"),
        *(F.sum(a).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(a) for a in amounts))
    some = F.greatest(*(F.abs(F.col(a)) for a in amounts), F.lit(0)) > 0
    first, last = monday(F.date_add("place", 6)), monday(F.date_sub("_next", 1))
    spread = sums.where(some & (first <= last)).select(
        *keys, *amounts, F.explode(F.sequence(first, last, F.expr(WEEK_STEP))).alias(week))
    known = lookup.with_first_after(spread, F.col(week), "_known")  # a week that the calendar lacks has a later one
    return known.where(F.col("_known") == F.col(week)).select(*keys, week, *amounts)


def weekly_distinct(intervals: DataFrame, groups: Sequence[str], members: Sequence[str],
                    lookup: WeekLookup) -> DataFrame:
    """``groups``, ``week``, ``members``: distinct members per group and week,
    from ranges of weeks (``first_week``, ``last_week``)."""
    merged = merge_overlaps(intervals, [*groups, *members])
    events = merged.select(*groups, F.inline(deltas(F.col("first_week"), F.col("last_week"), members=F.lit(1))))
    return running_counts(events, groups, ["members"], lookup)
