"""Day-interval operators for trailing-window membership.

A fact on day ``p`` that stays visible for ``lookback`` days covers report
days ``p .. p + lookback``.  "Which members does report day ``d`` see" is a
pure range join (every day against every fact in its window).  These
operators answer the same question per calendar week without that join:

1. ``coverage_runs``: per member key, merge the facts' visibility intervals
   into maximal runs of covered days (window functions over the member's
   facts, which are at day grain, so a key's rows are bounded by days).
2. ``clip`` runs and label pieces to the report range, then
   ``overlay_labels``: cut the runs by the validity intervals of a
   slowly-changing attribute (with the uncovered gaps labelled by a
   default), an equi-join on the entity plus an overlap test.  Per entity
   the candidate pairs are (runs in range) x (pieces in range): at most one
   run per ``lookback`` days and one piece per day of the range, bounded by
   the range, not by the data volume.  (Both sides can also be split by
   week and joined on (entity, week); that bounds each key to one week but
   multiplies rows, and measured slower.)
3. ``spread_over_weeks``: ``split_by_week`` and ``on_calendar``, an
   equi-join on the week against the (broadcast) calendar.

A member counts for (week, label) exactly when some calendar day of that
week lies in one of its runs while the label is valid, which is what the
range join followed by ``count(distinct member)`` computes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _min_date() -> Column:
    return F.expr("DATE'0001-01-01'")


def _max_date() -> Column:
    return F.expr("DATE'9999-12-31'")


def coverage_runs(facts: DataFrame, keys: Sequence[str], day: str, lookback: int,
                  start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """Per ``keys``, maximal runs of days covered by ``[day, day + lookback]``."""
    w = Window.partitionBy(*keys).orderBy(day)
    prev = F.lag(day).over(w)
    new_run = F.when(prev.isNull() | (F.datediff(F.col(day), prev) > lookback + 1), 1).otherwise(0)
    runs = (facts.where(F.col(day).isNotNull()).select(*keys, day)
            .withColumn("_new", new_run)
            .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy(*keys, "_run")
            .agg(F.min(day).alias(start), F.date_add(F.max(day), lookback).alias(end))
            .drop("_run"))


def flagged_coverage_runs(facts: DataFrame, keys: Sequence[str], day: str, flag: str, lookback: int,
                          start: str = "cover_start", end: str = "cover_end",
                          flagged: str = "flagged_cover") -> DataFrame:
    """``coverage_runs``, and in each run the runs of its flagged facts alone,
    as an array of (``s``, ``e``): one pass over the facts for both.  Flagged
    facts near enough to share a run have no wider gap between them in all
    facts, so a flagged run lies in one run."""
    w = Window.partitionBy(*keys).orderBy(day)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    here = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = F.when(F.col(flag), F.col(day))
    since = lambda previous: previous.isNull() | (F.datediff(F.col(day), previous) > lookback + 1)
    f = facts.where(F.col(day).isNotNull()).select(
        *keys, day, marked.alias("_marked"), since(F.lag(day).over(w)).cast("int").alias("_new"),
        (F.coalesce(F.col(flag), F.lit(False)) & since(F.last(marked, ignorenulls=True).over(before))).cast("int").alias("_fnew"))
    f = f.withColumn("_run", F.sum("_new").over(here)).withColumn("_frun", F.sum("_fnew").over(here))
    inner = f.groupBy(*keys, "_run", "_frun").agg(
        F.min(day).alias("_s"), F.max(day).alias("_e"), F.min("_marked").alias("_fs"), F.max("_marked").alias("_fe"))
    return inner.groupBy(*keys, "_run").agg(
        F.min("_s").alias(start), F.date_add(F.max("_e"), lookback).alias(end),
        F.collect_list(F.when(F.col("_fs").isNotNull(), F.struct(
            F.col("_fs").alias("s"), F.date_add("_fe", lookback).alias("e")))).alias(flagged)).drop("_run")


def covered_days(facts: DataFrame, day: str, lookback: int) -> DataFrame:
    """Distinct days covered by any fact (at most ``lookback + 1`` per
    distinct fact day; the set is bounded by the calendar span)."""
    d = facts.where(F.col(day).isNotNull()).select(day).distinct()
    return (d.select(F.explode(F.sequence(F.col(day), F.date_add(F.col(day), lookback)))
                     .alias("covered_day")).distinct())


def label_pieces(segments: DataFrame, entity: str, label: str, begin: str, end: str,
                 default_label: str) -> DataFrame:
    """Validity intervals of ``label`` per ``entity``, plus the gaps between
    (and before and after) them labelled ``default_label``.

    Output: ``entity, label, piece_start, piece_end``.  Overlapping validity
    rows are kept as they are (each is a separate match, as in a join);
    gaps are the complement of their union.  One shuffle and one sort of
    the validity rows: each row emits itself, the gap before it (from the
    running maximum end of the rows before) and, for the entity's last row,
    the open tail after the overall maximum end.
    """
    s = (segments.where(F.col(begin).isNotNull() & F.col(end).isNotNull()
                        & (F.col(begin) <= F.col(end)))
         .select(F.col(entity), F.coalesce(F.col(label), F.lit(default_label)).alias(label),
                 F.col(begin).alias("_b"), F.col(end).alias("_e")))
    w = Window.partitionBy(entity).orderBy("_b", "_e")
    reach_before = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    reach_here = F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, 0))
    is_last = F.lead("_b").over(w).isNull()
    s = s.select(entity, label, "_b", "_e", reach_before.alias("_rb"), reach_here.alias("_rh"),
                 is_last.alias("_last"))
    dflt = F.lit(default_label)
    gap_start = F.coalesce(F.date_add("_rb", 1), _min_date())
    pieces = F.array(
        F.struct(F.lit(True).alias("ok"), F.col(label).alias("l"), F.col("_b").alias("s"),
                 F.col("_e").alias("e")),
        F.struct((F.col("_rb").isNull() | (F.col("_b") > F.date_add("_rb", 1))).alias("ok"),
                 dflt.alias("l"), gap_start.alias("s"), F.date_sub("_b", 1).alias("e")),
        F.struct((F.col("_last") & (F.col("_rh") < _max_date())).alias("ok"), dflt.alias("l"),
                 F.date_add("_rh", 1).alias("s"), _max_date().alias("e")))
    out = s.select(entity, F.inline(pieces))
    return (out.where(F.col("ok") & (F.col("s") <= F.col("e")))
            .select(entity, F.col("l").alias(label), F.col("s").alias("piece_start"),
                    F.col("e").alias("piece_end")))


def overlay_labels(runs: DataFrame, keys: str | Sequence[str], pieces: DataFrame, label: str,
                   default_label: str, start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """Cut each run by the label pieces with the same ``keys`` (the entity,
    and optionally a week both sides were split by); runs with no piece keep
    their whole interval under ``default_label``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    p = pieces
    for k in keys:
        p = p.withColumnRenamed(k, f"_p_{k}")
    cond = ((F.col("piece_start") <= F.col(end)) & (F.col("piece_end") >= F.col(start)))
    for k in keys:
        cond = (F.col(k) == F.col(f"_p_{k}")) & cond
    j = runs.join(p, cond, "left")
    matched = F.col(f"_p_{keys[0]}").isNotNull()
    return (j.withColumn(label, F.when(matched, F.col(label)).otherwise(F.lit(default_label)))
            .withColumn(start, F.when(matched, F.greatest(start, "piece_start")).otherwise(F.col(start)))
            .withColumn(end, F.when(matched, F.least(end, "piece_end")).otherwise(F.col(end)))
            .drop(*[f"_p_{k}" for k in keys], "piece_start", "piece_end"))


def split_by_week(intervals: DataFrame, start: str = "cover_start",
                  end: str = "cover_end") -> DataFrame:
    """One row per (interval, Monday-based week it meets), cut to that week.
    Bounded by the weeks an interval spans; clip first to bound that."""
    weeks = F.explode(F.sequence(F.date_trunc("week", F.col(start)).cast("date"),
                                 F.date_trunc("week", F.col(end)).cast("date"),
                                 F.expr("INTERVAL 7 DAYS")))
    out = intervals.withColumn("week", weeks)
    return (out.withColumn(start, F.greatest(F.col(start), F.col("week")))
            .withColumn(end, F.least(F.col(end), F.date_add("week", 6))))


def on_calendar(weekly: DataFrame, cal_pieces: DataFrame, start: str = "cover_start",
                end: str = "cover_end") -> DataFrame:
    """Keep (interval, week) rows that meet a calendar day of their week.
    The calendar side has at most one row per day of the parameter-fixed
    report range, so it is broadcast."""
    j = weekly.join(F.broadcast(cal_pieces), "week")
    return (j.where(F.greatest(F.col(start), F.col("cal_start")) <= F.least(F.col(end), F.col("cal_end")))
            .drop("cal_start", "cal_end"))


def clip(intervals: DataFrame, lo: dt.date, hi: dt.date, start: str = "cover_start",
         end: str = "cover_end") -> DataFrame:
    """Intersect intervals with ``[lo, hi]``; drop those outside it."""
    return (intervals.withColumn(start, F.greatest(F.col(start), F.lit(lo)))
            .withColumn(end, F.least(F.col(end), F.lit(hi)))
            .where(F.col(start) <= F.col(end)))


def pieces_within(pieces: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    """Label pieces that can meet ``[lo, hi]``.  Exact for overlaying runs
    already clipped to ``[lo, hi]``: an entity's pieces cover every day, so
    the days of ``[lo, hi]`` keep all their pieces."""
    return pieces.where((F.col("piece_end") >= F.lit(lo)) & (F.col("piece_start") <= F.lit(hi)))


def calendar_week_pieces(calendar: DataFrame, day: str = "report_date",
                         extra: Sequence[str] = ("week_begin", "week_end")) -> DataFrame:
    """Runs of consecutive calendar days per week (``week`` = Monday of
    ``day``), carrying the week attributes in ``extra``."""
    c = calendar.where(F.col(day).isNotNull()).select(
        F.date_trunc("week", F.col(day)).cast("date").alias("week"), *extra, day)
    w = Window.partitionBy("week", *extra).orderBy(day)
    prev = F.lag(day).over(w)
    c = (c.withColumn("_new", F.when(prev.isNull() | (F.datediff(F.col(day), prev) > 1), 1).otherwise(0))
         .withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (c.groupBy("week", *extra, "_run")
            .agg(F.min(day).alias("cal_start"), F.max(day).alias("cal_end"))
            .drop("_run"))


def spread_over_weeks(intervals: DataFrame, cal_pieces: DataFrame, lo: dt.date, hi: dt.date,
                      start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """Rows (interval, week) for every calendar week in which the interval
    meets a calendar day: clip to ``[lo, hi]`` (a superset of the calendar
    selection, so the split is bounded by the calendar span), split by week,
    keep the weeks that meet the calendar."""
    return on_calendar(split_by_week(clip(intervals, lo, hi, start, end), start, end),
                       cal_pieces, start, end)
