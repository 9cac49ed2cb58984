"""Weekly product adoption ("attach") rates over a trailing payment window
(C25-C30).

Both rates count merchants per (calendar week, category, online flag, size
segment) among those with a qualifying payment in the 92 days up to some day
of the week, with the segment looked up on that day.  The trailing window is
computed with ``operators.intervals`` (coverage runs -> segment overlay ->
calendar weeks) instead of joining every calendar day to every payment in
its window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalar import bps, flag, safe_ratio
from ..functions.timefns import ts_lit
from ..operators.intervals import (clip, coverage_runs, covered_days, flagged_coverage_runs, label_pieces,
                                   overlay_labels, pieces_within)
from ..operators.sweep import WeekLookup, deltas, merge_overlaps, monday, running_counts, to_weeks
from ..params import Params
from ..sources.catalog import Tables


def daily_qualifying_payments(t: Tables, p: Params) -> DataFrame:
    """Captured, non-voided, non-refunded online card volume per
    (unit, merchant, day, category) since ``p.payments_start``."""
    return t.derived("daily_qualifying_payments", p, lambda: _build_daily_qualifying_payments(t, p))


def _build_daily_qualifying_payments(t: Tables, p: Params) -> DataFrame:
    pt = t["payment"].where(
        (F.col("has_successful_capture") == 1) & (F.col("is_gpv") == 1) & (F.col("is_voided") == 0)
        & (F.col("is_refunded") == 0) & (F.col("is_card_payment") == 1)
        & (F.col("recognized_at") >= ts_lit(p.payments_start))
        & F.col("entry_method").isin(*P.ONLINE_ENTRY_METHODS))
    # Payments are reduced to (unit, day) before meeting the user dimension:
    # a unit with a huge share of payments becomes a handful of rows per day
    # before any shuffle.  Grouping again after the join keeps the source's
    # result even if a user had several dimension rows.
    per_day = (pt.groupBy("unit_token", F.to_date("recognized_at").alias("payment_trx_recognized_at"))
               .agg(F.sum("amount_base_unit").alias("_cents")))
    du = t["dim_user"].where(F.col("is_unit") == 1).select(
        F.col("user_token").alias("_du_user"), "merchant_token", "business_category")
    j = per_day.join(du, per_day["unit_token"] == du["_du_user"])
    return (j.groupBy("unit_token", "merchant_token", "payment_trx_recognized_at", "business_category")
            .agg((F.sum("_cents") / 100).alias("amount_base_unit")))


def first_online_signup(t: Tables, p: Params) -> DataFrame:
    """First online-store signup per enrolled merchant."""
    s = t["merchant_signup"].where(F.col("initially_enrolled_at").isNotNull())
    return (s.groupBy(F.col("token").alias("merchant_token"))
            .agg(F.min("online_signup_at").alias("online_signup_datetime")))


def _online_flags(t: Tables, p: Params) -> DataFrame:
    som = first_online_signup(t, p)
    return som.select(F.col("merchant_token").alias("_som_merchant"),
                      F.col("online_signup_datetime").isNotNull().alias("_online"))


def _segment_pieces(t: Tables, lo: dt.date, hi: dt.date) -> DataFrame:
    """Segment validity and gap pieces that can meet the report range."""
    pieces = label_pieces(t["user_segment"], "user_token", "segment", "effective_begin",
                          "effective_end", P.INACTIVE_SEGMENT)
    return pieces_within(pieces, lo, hi)


def _calendar(t: Tables, kept: Column, lo: dt.date, hi: dt.date) -> DataFrame:
    cal = t["dim_date"].where(kept & F.col("report_date").between(F.lit(lo), F.lit(hi)))
    return cal.withColumn("week", monday(F.col("report_date")))


def _segment_intervals(runs: DataFrame, t: Tables, lo: dt.date, hi: dt.date) -> DataFrame:
    """Runs of the paying units within ``[lo, hi]``, cut by the segment valid
    on each day."""
    return overlay_labels(clip(runs, lo, hi).withColumnRenamed("unit_token", "user_token"), "user_token",
                          _segment_pieces(t, lo, hi), "segment", P.INACTIVE_SEGMENT)


def _with_online(df: DataFrame, t: Tables, p: Params) -> DataFrame:
    j = df.join(_online_flags(t, p), df["merchant_token"] == F.col("_som_merchant"), "left")
    return j.withColumn("is_online_store", flag(F.col("_online") == F.lit(True))) \
            .drop("_som_merchant", "_online")


def _enrolment_weeks(t: Tables, p: Params, lookup: WeekLookup) -> DataFrame:
    """Per merchant, the disjoint ranges of weeks in which it counts as
    enrolled, as one array: weeks that end on or after the onboarding of an
    active enrolment, or that an ended one's last day lies in or within
    ``churn_lookback_days`` before."""
    active, ended = F.col("state").isin(*P.ACTIVE_ENROLLED_STATES), F.col("state").isin(*P.ENDED_ENROLLED_STATES)
    since = F.when(active, F.col("onboard_date")).when(ended, F.col("offboard_date"))
    until = F.when(active, F.lit(dt.date.max)).when(ended, F.date_add("offboard_date", p.churn_lookback_days))
    rows = t["enrolled_merchant"].where(F.col("merchant_token").isNotNull()).select(
        F.col("merchant_token").alias("_rm_merchant"), since.alias("_since"), until.alias("_until"))
    weeks = lookup.with_first_after(rows, F.col("_since"), "first_week", "week_end")
    weeks = lookup.with_last_before(weeks, F.col("_until"), "last_week", "week_begin")
    weeks = merge_overlaps(weeks.where("first_week <= last_week").drop("first_week_point"), ["_rm_merchant"])
    return weeks.groupBy("_rm_merchant").agg(F.collect_list(F.struct("first_week", "last_week")).alias("_enrolled"))


def paid_adoption_week(t: Tables, p: Params) -> DataFrame:
    """Of merchants with qualifying payments in the trailing window, how
    many are enrolled in the paid product in that week (active enrolment, or
    an ended one that ended within ``churn_lookback_days`` of the week).

    Counted by signed deltas (``operators.sweep``): a merchant's weeks in a
    (category, segment) are disjoint ranges, and so are those of them in which
    it is enrolled; online flag and enrolment are joined once a range.  The
    calendar's weeks must be in order (a later week neither begins nor ends
    before an earlier one), and a week's days and its end lie within a week of
    its first seven days."""
    first_week = p.payments_start + dt.timedelta(days=p.adoption_first_week_offset_days)
    last_week = p.as_of - dt.timedelta(days=p.as_of.weekday())
    lo, hi = first_week - dt.timedelta(days=7), last_week + dt.timedelta(days=13)
    cal = _calendar(t, F.col("week_begin").between(F.lit(first_week), F.lit(last_week)), lo, hi)
    lookup = WeekLookup(cal, lo, hi, ("report_date", "week_begin", "week_end"))
    api = daily_qualifying_payments(t, p)
    runs = coverage_runs(api, ["unit_token", "merchant_token", "business_category"],
                         "payment_trx_recognized_at", p.trailing_days)
    weeks = to_weeks(_segment_intervals(runs, t, lo, hi), lookup)
    members = _with_online(merge_overlaps(weeks, ["business_category", "segment", "merchant_token"]), t, p)
    members = members.join(_enrolment_weeks(t, p, lookup), F.col("merchant_token") == F.col("_rm_merchant"), "left")

    # a group with only unknown merchants appears, with zero counts
    known = F.col("merchant_token").isNotNull().cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    both = F.transform(F.coalesce("_enrolled", F.array().cast("array<struct<first_week:date,last_week:date>>")),
                       lambda e: F.struct(F.greatest(e["first_week"], F.col("first_week")).alias("f"),
                                          F.least(e["last_week"], F.col("last_week")).alias("l")))
    paid = F.flatten(F.transform(F.filter(both, lambda e: e["f"] <= e["l"]),
                                 lambda e: deltas(e["f"], e["l"], present=zero, total=zero, enrolled=one)))
    there = deltas(F.col("first_week"), F.col("last_week"), present=one, total=known, enrolled=zero)
    keys = ["business_category", "is_online_store", "segment"]
    events = members.select(*keys, F.inline(F.concat(there, paid)))
    rows = running_counts(events, keys, ["present", "total", "enrolled"], lookup).select(
        F.col("week").alias("week_start_date"), F.col("business_category").alias("mcc"), "is_online_store",
        F.col("segment").alias("gpv_segment"), "enrolled", "total")

    # Calendar days with no qualifying payment at all in their window still
    # form a group (no category, offline, default segment) with zero counts.
    uncovered = (cal.join(covered_days(api, "payment_trx_recognized_at", p.trailing_days),
                          F.col("report_date") == F.col("covered_day"), "left_anti")
                 .select(F.col("week").alias("week_start_date"))
                 .distinct()
                 .select("week_start_date", F.lit(None).cast("string").alias("mcc"),
                         F.lit(0).alias("is_online_store"),
                         F.lit(P.INACTIVE_SEGMENT).alias("gpv_segment"),
                         F.lit(0).cast("bigint").alias("enrolled"), F.lit(0).cast("bigint").alias("total")))
    counts = rows.unionByName(uncovered).groupBy("week_start_date", "mcc", "is_online_store", "gpv_segment").agg(
        F.sum("enrolled").alias("enrolled_merchants"), F.sum("total").alias("total_merchants"))
    return counts.select(
        "week_start_date", "mcc", "is_online_store", "gpv_segment", "enrolled_merchants",
        "total_merchants",
        safe_ratio("enrolled_merchants", "total_merchants").alias("paid_product_adoption_rate"),
        bps("enrolled_merchants", "total_merchants").alias("paid_product_adoption_rate_in_bps"))


def risky_payments(t: Tables, p: Params) -> DataFrame:
    """Evaluations above the normal risk level, by merchant, unit, bill
    and day."""
    pre = t["risk_evaluation"].where(F.col("risk_level") != P.NORMAL_RISK_LEVEL)
    du = t["dim_user"].select(F.col("user_token").alias("_du_user"), "merchant_token",
                              F.col("user_token"))
    j = pre.join(du, pre["unit_token"] == du["_du_user"], "left")
    return j.select("merchant_token", "user_token", "bill_token",
                    F.to_date("created_at").alias("risky_payment_date")).distinct()


def first_engagement(t: Tables, p: Params) -> DataFrame:
    """First day a bill was opened in the dashboard's transaction view
    (the bill token is a path segment; a short path gives ``''``)."""
    pv = t["page_view"]
    bill = F.split_part(F.col("webpage_path"), F.lit(P.BILL_PATH_SEPARATOR), F.lit(P.BILL_PATH_PART))
    v = pv.where((F.col("app_name") == P.ENGAGEMENT_APP)
                 & (F.col("recorded_at") >= ts_lit(p.engagement_activity_start))
                 & (F.col("catalog_name") == P.ENGAGEMENT_CATALOG)
                 & F.col("description").ilike(P.ENGAGEMENT_DESCRIPTION_PATTERN)
                 & bill.isNotNull())
    return (v.groupBy(bill.alias("dashboard_bill_token"), "merchant_token")
            .agg(F.min(F.to_date("recorded_at")).alias("earliest_engagement")))


def risk_eval_attach_week(t: Tables, p: Params) -> DataFrame:
    """Of merchants not enrolled in the paid product that had qualifying
    payments in the trailing window, how many opened a risky payment of the
    window in the dashboard (matched on unit and payment day, then bill)."""
    lo, hi = p.engagement_report_start, p.as_of
    enrolled = t["enrolled_merchant"].select(F.col("merchant_token").alias("_rm_merchant"))
    api = (daily_qualifying_payments(t, p)
           .where((F.col("payment_trx_recognized_at") >= F.lit(p.engagement_activity_start))
                  & F.col("merchant_token").isNotNull())
           .join(enrolled, F.col("merchant_token") == F.col("_rm_merchant"), "left_anti"))
    engaged_bills = first_engagement(t, p).select(F.col("dashboard_bill_token").alias("_bill")).distinct()
    risky = risky_payments(t, p)
    engaged = (risky.join(engaged_bills, risky["bill_token"].cast("string") == F.col("_bill"),
                          "left_semi")
               .select(F.col("user_token").alias("_r_user"),
                       F.col("risky_payment_date").alias("_r_date")).distinct())
    # One pass over the payments for both counts: the engaged days' own runs
    # stay inside the runs of all days, and are cut with them.
    facts = api.join(engaged.withColumn("_engaged", F.lit(True)),
                     (api["unit_token"] == F.col("_r_user"))
                     & (api["payment_trx_recognized_at"] == F.col("_r_date")), "left")
    runs = flagged_coverage_runs(facts, ["unit_token", "merchant_token", "business_category"],
                                 "payment_trx_recognized_at", "_engaged", p.trailing_days)
    cut = _segment_intervals(runs, t, lo, hi)
    active = F.filter(F.transform("flagged_cover", lambda c: F.struct(
        F.greatest(c["s"], F.col("cover_start")).alias("s"), F.least(c["e"], F.col("cover_end")).alias("e"),
        F.lit(1).alias("k"))), lambda c: c["s"] <= c["e"])
    whole = F.array(F.struct(F.col("cover_start").alias("s"), F.col("cover_end").alias("e"), F.lit(0).alias("k")))
    parts = cut.select("business_category", "segment", "merchant_token", F.inline(F.concat(whole, active)))
    lookup = WeekLookup(_calendar(t, F.lit(True), lo, hi), lo, hi)
    weeks = to_weeks(parts, lookup, "s", "e")
    members = _with_online(merge_overlaps(weeks, ["business_category", "segment", "merchant_token", "k"]), t, p)
    keys = ["business_category", "is_online_store", "segment"]
    events = members.select(*keys, F.inline(deltas(
        F.col("first_week"), F.col("last_week"), total=(F.col("k") == 0).cast("bigint"),
        active=(F.col("k") == 1).cast("bigint"))))
    out = running_counts(events, keys, ["total", "active"], lookup).select(
        F.col("week").alias("week_start_date"), F.col("segment").alias("gpv_segment"), "is_online_store",
        F.col("business_category").alias("mcc"), "total", "active")
    return (out.where(F.col("total") > 0)
            .withColumn("risk_evaluation_attach_rates", safe_ratio("active", "total")))
