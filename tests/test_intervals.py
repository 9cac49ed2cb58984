"""The trailing-window operators against a literal per-day evaluation."""

import datetime as dt
import random
from collections import Counter

import pytest

from riskspark.operators.intervals import (calendar_week_pieces, clip, coverage_runs, covered_days,
                                           label_pieces, on_calendar, overlay_labels, pieces_within,
                                           flagged_coverage_runs, split_by_week, spread_over_weeks)
from riskspark.operators.sweep import WeekLookup, monday, to_weeks, weekly_distinct

D0 = dt.date(2000, 1, 3)
LOOKBACK = 20


def _brute(facts, segments, cal_days):
    out = set()
    for d in cal_days:
        week = d - dt.timedelta(days=d.weekday())
        for (u, m, c, p) in facts:
            if not (p <= d <= p + dt.timedelta(days=LOOKBACK)):
                continue
            labels = [s for (su, s, b, e) in segments if su == u and b <= d <= e]
            for s in labels or ["Inactive"]:
                out.add((week, c, s, m))
    return out


@pytest.mark.parametrize("seed,mode", [(1, "plain"), (2, "plain"), (3, "clipped"), (4, "clipped"),
                                       (5, "weekly"), (6, "weekly"), (7, "weekly"),
                                       (8, "sweep"), (9, "sweep"), (10, "sweep"), (11, "sweep")])
def test_weekly_membership_matches_per_day_join(spark, seed, mode):
    rnd = random.Random(seed)
    facts = [(u, u % 3, rnd.choice("AB"), D0 + dt.timedelta(days=rnd.randrange(0, 200)))
             for u in range(1, 7) for _ in range(rnd.randrange(0, 6))]
    segments = []
    for u in range(1, 6):       # user 6 has no segments at all
        for _ in range(rnd.randrange(0, 4)):
            b = D0 + dt.timedelta(days=rnd.randrange(-30, 220))
            segments.append((u, rnd.choice(["S", "L", None]), b, b + dt.timedelta(days=rnd.randrange(0, 60))))
    cal_days = [D0 + dt.timedelta(days=i) for i in range(10, 230) if i % 17 != 0]   # with holes
    lo, hi = min(cal_days), max(cal_days)

    fdf = spark.createDataFrame(facts, "unit bigint, merchant bigint, cat string, day date")
    sdf = spark.createDataFrame(segments, "user bigint, seg string, b date, e date")
    cdf = spark.createDataFrame([(d,) for d in cal_days], "report_date date")

    runs = coverage_runs(fdf, ["unit", "merchant", "cat"], "day", LOOKBACK).withColumnRenamed("unit", "user")
    pieces = label_pieces(sdf, "user", "seg", "b", "e", "Inactive")
    cal = calendar_week_pieces(cdf, extra=())
    want = {(w, c, s if s is not None else "Inactive", m) for (w, c, s, m) in _brute(facts, segments, cal_days)}
    if mode == "sweep":     # counted by signed deltas, without a row for each member and week
        lo, hi = lo - dt.timedelta(days=3), hi + dt.timedelta(days=3)
        lookup = WeekLookup(cdf.withColumn("week", monday(cdf["report_date"])), lo, hi)
        labelled = overlay_labels(clip(runs, lo, hi), "user", pieces_within(pieces, lo, hi), "seg", "Inactive")
        counts = weekly_distinct(to_weeks(labelled, lookup), ["cat", "seg"], ["merchant"], lookup)
        assert {(r.week, r.cat, r.seg): r.members for r in counts.collect()} == Counter(x[:3] for x in want)
        return
    if mode == "weekly":    # both sides clipped and split by week, joined per (user, week)
        runs = split_by_week(clip(runs, lo, hi))
        pieces = split_by_week(clip(pieces, lo, hi, "piece_start", "piece_end"), "piece_start", "piece_end")
        weekly = on_calendar(overlay_labels(runs, ["user", "week"], pieces, "seg", "Inactive"), cal)
    else:
        if mode == "clipped":   # restricting both sides to the calendar range first is exact
            runs, pieces = clip(runs, lo, hi), pieces_within(pieces, lo, hi)
        labelled = overlay_labels(runs, "user", pieces, "seg", "Inactive")
        weekly = spread_over_weeks(labelled, cal, lo, hi)
    got = {(r.week, r.cat, r.seg, r.merchant)
           for r in weekly.select("week", "cat", "seg", "merchant").distinct().collect()}
    assert got == want


def test_covered_days(spark):
    df = spark.createDataFrame([(D0,), (D0,), (D0 + dt.timedelta(days=5),)], "day date")
    got = {r.covered_day for r in covered_days(df, "day", 3).collect()}
    assert got == {D0 + dt.timedelta(days=i) for i in (0, 1, 2, 3, 5, 6, 7, 8)}


def test_sparse_calendar_weeks(spark):
    """Weeks without a calendar day are not counted, and a range that only
    meets holes is not either."""
    cal_days = [D0, D0 + dt.timedelta(days=1), D0 + dt.timedelta(days=16), D0 + dt.timedelta(days=20)]
    cdf = spark.createDataFrame([(d,) for d in cal_days], "report_date date")
    lookup = WeekLookup(cdf.withColumn("week", monday(cdf["report_date"])), D0, D0 + dt.timedelta(days=27))
    ranges = {"a": (0, 27), "b": (2, 15), "c": (2, 16), "d": (1, 1), "e": (17, 19), "f": (20, 20), "g": (21, 27)}
    rows = [(k, D0 + dt.timedelta(days=s), D0 + dt.timedelta(days=e)) for k, (s, e) in ranges.items()]
    rows += [("d", D0, D0)]     # the same week twice
    df = spark.createDataFrame(rows, "member string, cover_start date, cover_end date")
    got = weekly_distinct(to_weeks(df, lookup), [], ["member"], lookup).collect()
    assert {(r.week - D0).days: r.members for r in got} == {0: 2, 14: 3}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_flagged_runs_are_the_flagged_facts_runs(spark, seed):
    rnd = random.Random(seed)
    facts = [(u, D0 + dt.timedelta(days=rnd.randrange(0, 300)), rnd.choice([True, False, None]))
             for u in range(6) for _ in range(rnd.randrange(1, 14))]
    df = spark.createDataFrame(facts, "u bigint, day date, flag boolean")
    got = flagged_coverage_runs(df, ["u"], "day", "flag", LOOKBACK).collect()
    plain = coverage_runs(df, ["u"], "day", LOOKBACK).collect()
    assert {(r.u, r.cover_start, r.cover_end) for r in got} == {tuple(r) for r in plain} and len(got) == len(plain)
    inner = coverage_runs(df.where("flag"), ["u"], "day", LOOKBACK).collect()
    assert sorted((r.u, f.s, f.e) for r in got for f in r.flagged_cover) == sorted(tuple(r) for r in inner)
    assert all(r.cover_start <= f.s and f.e <= r.cover_end for r in got for f in r.flagged_cover)
