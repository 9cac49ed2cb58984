"""Takeover detection quality and account structure.

Tagged audit-log entries are the detector's output; confirmed takeovers are
the ground truth.  Recall and precision match the two within a day window on
the same user.  Merchant lock status and headcounts come from the roster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import after_marker, flag, headcount_bucket, token_before
from ..functions.timefns import trunc_date, ts_lit
from ..operators.distinct_sets import count_states, distinct_states, merge_states
from ..operators.temporal import with_nearest, within_days
from ..params import Params
from ..sources.catalog import Tables


def tagged_events(t: Tables, p: Params) -> DataFrame:
    """Audit-log entries tagged as suspect logins (by comment tag or
    action), up to the log cutoff, with the address written in the comment
    and the matching known-false-positive entry.  (``date(t) <= cutoff`` is
    written as ``t < cutoff + 1 day`` so the scan can prune on it.)

    The false-positive list only matches entries inside its date window;
    other entries are kept, unmatched (the source's condition sits in the
    join, not in a filter).
    """
    return t.derived("tagged_events", p, lambda: _build_tagged_events(t, p))


def _build_tagged_events(t: Tables, p: Params) -> DataFrame:
    log = t["audit_log"].where(
        (F.col("comment").ilike(p.suspect_comment_pattern) | (F.col("action_name") == p.suspect_action))
        & (F.col("created_at") < ts_lit(p.log_cutoff + dt.timedelta(days=1))))
    fp = t["fp_login_list"].select(F.col("unit_token").alias("fp_unit_token"),
                                   F.col("ip").alias("fp_ip"))
    # Only entries inside the window can match the list: join just those and
    # pass the rest through unmatched, so the (long) history outside the
    # window is never shuffled for the join.  Both tests are ranges of the raw
    # column, so each branch's scan skips what the other reads.
    at, start, end = (F.col("created_at"), ts_lit(p.fp_window_start),
                      ts_lit(p.fp_window_end + dt.timedelta(days=1)))
    inside = log.where((at >= start) & (at < end)).join(fp, F.col("target_token") == F.col("fp_unit_token"), "left")
    outside = log.where((at < start) | (at >= end)).select(
        "*", F.lit(None).cast(fp.schema["fp_unit_token"].dataType).alias("fp_unit_token"),
        F.lit(None).cast("string").alias("fp_ip"))
    j = inside.unionByName(outside)
    ip = after_marker("comment")
    return j.select("target_token", "created_at", "comment", "fp_unit_token",
                    ip.alias("ip"), token_before(ip).alias("ip_cleaned"), "fp_ip")


def confirmed_takeovers(t: Tables, p: Params) -> DataFrame:
    """Confirmed takeovers up to the log cutoff (timestamp <= midnight)."""
    return t["ato_merchant"].where(F.col("earliest_confirmed_at") <= ts_lit(p.log_cutoff))


def _confirmed_users(t: Tables, p: Params, name: str) -> DataFrame:
    """Who is confirmed when, without repeats.  Nothing matches a missing
    user, so of those only the months are kept."""
    user, at = F.col("user_token"), F.col("earliest_confirmed_at")
    return (confirmed_takeovers(t, p)
            .select(user, F.when(user.isNull(), F.date_trunc("month", at).cast("timestamp_ntz")).otherwise(at).alias(name)).distinct())


def _recall_months(t: Tables, p: Params) -> DataFrame:
    """Per month the sets of confirmed users and of those the detector tagged
    around a confirmation (``distinct_sets`` states)."""
    return t.derived("recall_months", p, lambda: _build_recall_months(t, p))


def _build_recall_months(t: Tables, p: Params) -> DataFrame:
    ato = _confirmed_users(t, p, "at")
    # only the tagged day matters, so one row per (user, day)
    sk = (tagged_events(t, p).where(F.col("fp_unit_token").isNull())
          .select(F.col("target_token").alias("user_token"),
                  F.to_date("created_at").cast("timestamp_ntz").alias("at")).distinct())
    at = F.col("at")
    # of all tagged days, if any is in reach then the nearest before or after is
    j = with_nearest(ato, sk, "user_token", "at", "_tag_before", "_tag_after")
    tagged = within_days(at, F.col("_tag_before"), p.match_days) | within_days(at, F.col("_tag_after"), p.match_days)
    return distinct_states(j.withColumn("ato_month", trunc_date("month", at)), ["ato_month"], "user_token",
                           {"tagged_sellers": F.coalesce(tagged, F.lit(False))})


def detector_recall_month(t: Tables, p: Params) -> DataFrame:
    """Confirmed takeovers per month and how many of them the detector
    tagged within ``match_days`` of confirmation."""
    return (count_states(_recall_months(t, p), ["ato_month"], "confirmed_ato", ["tagged_sellers"])
            .orderBy(F.col("ato_month").desc()))


def detector_recall_year(t: Tables, p: Params) -> DataFrame:
    """C2 per year, merged from the months' sets."""
    years = merge_states(_recall_months(t, p), {"ato_year": trunc_date("year", "ato_month")}, ["tagged_sellers"])
    return (count_states(years, ["ato_year"], "confirmed_ato", ["tagged_sellers"])
            .orderBy(F.col("ato_year").desc()))


def _precision_months(t: Tables, p: Params) -> DataFrame:
    """Per month the sets of tagged users and of those with a confirmed
    takeover around a tag (``distinct_sets`` states)."""
    return t.derived("precision_months", p, lambda: _build_precision_months(t, p))


def _build_precision_months(t: Tables, p: Params) -> DataFrame:
    # Against a confirmation's day, bounds of +/- n days depend on the tag's
    # day and on whether it is at midnight, not on its time.  So a user has at
    # most two rows a day here, however often tagged, and a hot user stays
    # small in the window.  (Tags without a user match nothing, so of those
    # only the months are kept.)
    user, day = F.col("target_token"), F.to_date("created_at").cast("timestamp_ntz")
    late = (F.col("created_at") > day).cast("int")
    moment = F.when(user.isNull(), F.date_trunc("month", day).cast("timestamp_ntz")).otherwise(day + F.make_dt_interval(F.lit(0), late))
    sk = (tagged_events(t, p)
          .where(F.col("fp_unit_token").isNull() & (F.col("created_at") < ts_lit(p.precision_cutoff)))
          .select(user, moment.alias("at")).distinct())
    ato = (confirmed_takeovers(t, p)
           .select(F.col("user_token").alias("target_token"),
                   F.to_date("earliest_confirmed_at").cast("timestamp_ntz").alias("at")).distinct())
    at = F.col("at")
    j = with_nearest(sk, ato, "target_token", "at", "_ato_before", "_ato_after")
    found = within_days(at, F.col("_ato_before"), p.match_days) | within_days(at, F.col("_ato_after"), p.match_days)
    return distinct_states(j.withColumn("tagged_month", trunc_date("month", at)), ["tagged_month"], "target_token",
                           {"confirmed_ato": F.coalesce(found, F.lit(False))})


def detector_precision_month(t: Tables, p: Params) -> DataFrame:
    """Tagged users per month and how many of them were confirmed
    takeovers within ``match_days`` of the tag."""
    return count_states(_precision_months(t, p), ["tagged_month"], "tagged_users", ["confirmed_ato"])


def detector_precision_year(t: Tables, p: Params) -> DataFrame:
    """C3 per year, merged from the months' sets."""
    years = merge_states(_precision_months(t, p), {"tagged_year": trunc_date("year", "tagged_month")},
                         ["confirmed_ato"])
    return count_states(years, ["tagged_year"], "tagged_users", ["confirmed_ato"])


def _person_flags(t: Tables) -> DataFrame:
    """One row per (merchant, person): locked / active / authorized flags.

    Reducing to this grain first turns every per-merchant distinct count
    into a plain count or sum, and keeps a merchant with a huge roster from
    becoming one task's distinct set: the (merchant, person) aggregation is
    spread by both keys and partially aggregated before its shuffle.
    """
    e = t["employee"]
    locked = (t["credential"].where(F.col("locked_at").isNotNull())
              .select(F.col("person_token")).distinct())
    j = e.join(locked, e["person_id"] == locked["person_token"], "left")
    return (j.groupBy("merchant_id", "person_id")
            .agg(F.max(flag(F.col("person_token").isNotNull())).alias("locked"),
                 F.max(flag(F.col("is_active"))).alias("active"),
                 F.max(flag(F.col("is_authorized_user") == F.lit(True))).alias("authorized")))


def _merchant_profile(t: Tables) -> DataFrame:
    f = _person_flags(t)
    person = F.col("person_id")
    g = (f.groupBy("merchant_id")
         .agg(F.sum(F.when(person.isNotNull(), F.col("locked")).otherwise(0))
              .alias("total_person_locked"),
              F.count(person).alias("total_person"),
              F.sum(F.when(person.isNotNull(), F.col("active")).otherwise(0)).alias("active_persons"),
              F.sum(F.when(person.isNotNull(), F.col("authorized")).otherwise(0))
              .alias("authorized_persons")))
    return g.withColumn("is_locked",
                        flag(F.col("total_person_locked") == F.col("total_person")))


def group_fully_locked(t: Tables, p: Params) -> DataFrame:
    """C4: per merchant, locked people, all people, and whether every person
    is locked (also 1 for a merchant with no people, as in the source)."""
    return _merchant_profile(t).select(
        "merchant_id", F.col("total_person_locked").cast("bigint").alias("total_person_locked"),
        "total_person", "is_locked")


def headcount_profile(t: Tables, p: Params) -> DataFrame:
    """Per merchant, its lock status and how many people, active people
    and authorized users it has."""
    m = _merchant_profile(t)
    is_locked = F.when(F.col("merchant_id").isNotNull(), F.col("is_locked"))
    return m.select(F.col("merchant_id"), is_locked.alias("is_locked"),
                    F.col("total_person").alias("total_persons"),
                    F.col("active_persons").cast("bigint").alias("active_persons"),
                    F.col("authorized_persons").cast("bigint").alias("authorized_persons"))


def headcount_buckets(t: Tables, p: Params) -> DataFrame:
    """Merchants per headcount bucket, and how many of them are fully
    locked."""
    m = headcount_profile(t, p)
    return (m.groupBy(headcount_bucket("total_persons", p.headcount_zero_label).alias("total_person_buckets"))
            .agg(F.count("merchant_id").alias("merchants"),
                 F.count(F.when(F.col("is_locked") == 1, F.col("merchant_id"))).alias("locked_merchants")))


__all__ = ["tagged_events", "detector_recall_month", "detector_recall_year",
           "detector_precision_month", "detector_precision_year", "group_fully_locked",
           "headcount_profile", "headcount_buckets"]
