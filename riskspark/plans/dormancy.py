"""Payment and money-movement dormancy.

The chain: positive card-payment days -> gaps between them per unit ->
gap history with user attributes -> per-unit dormancy -> other money
movement -> last activity -> segmentation and its reports -> value brought
back by reactivated units.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions.predicates import active_unit
from ..functions.scalar import (dormancy_bucket, flag, ilike_any, minor_to_major,
                                unit_from_balance_fixed)
from ..functions.timefns import add_hours, day_diff, micros_to_ts, trunc_date, ts_lit
from ..operators.aggs import conditional_distinct_counts
from ..operators.temporal import with_previous
from ..params import Params
from ..sources.catalog import Tables
from . import detection
from .activity import activity_events, latest_activity

_USER_ATTRS = ("is_currently_frozen", "is_currently_deactivated", "merchant_token", "user_token",
               "is_deleted")


def payment_gaps(t: Tables, p: Params) -> DataFrame:
    """Every day with card payments, the previous such day of the same
    unit and the number of days between them."""
    return t.derived("payment_gaps", p, lambda: _build_payment_gaps(t, p))


def _build_payment_gaps(t: Tables, p: Params) -> DataFrame:
    days = (t["daily_payment"].where(F.col("card_payment_count") > 0)
            .select("unit_token", "payment_date", "card_payment_count"))
    return with_previous(days, "unit_token", "payment_date", "previous_payment_date", "difference")


def _units(t: Tables) -> DataFrame:
    return t["dim_user"].where(F.col("is_unit") == 1)


def _summary(t: Tables) -> DataFrame:
    return t["lifetime_payment"].select(
        F.col("user_token").alias("_s_user"), "first_card_payment_date",
        "latest_card_payment_date", "lifetime_gpv_cents")


def gap_history(t: Tables, p: Params) -> DataFrame:
    """Every unit with its gap rows (one all-NULL row when it never had
    a card-payment day) and profile attributes.

    The lifetime summary is attached through the gap rows, so a unit with
    no positive day shows NULL first/latest dates even when a summary row
    exists, as in the source's ``(gaps LEFT JOIN summary) RIGHT JOIN users``.
    """
    gaps = payment_gaps(t, p)
    with_summary = gaps.join(_summary(t), gaps["unit_token"] == F.col("_s_user"), "left")
    units = _units(t).select(*_USER_ATTRS, *p.user_profile_columns)
    joined = units.join(with_summary, units["user_token"] == with_summary["unit_token"], "left")
    return joined.select(
        "first_card_payment_date", "unit_token", "payment_date", "card_payment_count",
        "previous_payment_date", "difference", "is_currently_frozen", "is_currently_deactivated",
        "latest_card_payment_date",
        minor_to_major("lifetime_gpv_cents").alias("lifetime_gpv"),
        "merchant_token", "user_token", "is_deleted", *p.user_profile_columns)


def payment_dormancy(t: Tables, p: Params) -> DataFrame:
    """Per unit, days since the last card payment (as of ``p.as_of``),
    the longest gap between payments, and the larger of the two.

    Aggregates the gaps per unit before any join, so the user attributes
    are joined once per unit instead of being carried as grouping keys.
    """
    return t.derived("payment_dormancy", p, lambda: _build_payment_dormancy(t, p))


def _build_payment_dormancy(t: Tables, p: Params) -> DataFrame:
    per_unit = (payment_gaps(t, p).groupBy("unit_token")
                .agg(F.max("difference").alias("maximum_dormancy_in_between")))
    per_unit = per_unit.join(_summary(t), per_unit["unit_token"] == F.col("_s_user"), "left")
    fake = t["fake_unit"].select(F.col("unit_token").alias("fa_user")).distinct()
    # the source groups by the unit's attributes, so identical duplicate
    # dimension rows count once; deduplicating within the user partitioning
    # costs no extra shuffle before the join on the user
    units = _units(t).select(*_USER_ATTRS).repartition("user_token").dropDuplicates()
    df = (units.join(per_unit, units["user_token"] == per_unit["unit_token"], "left")
          .join(fake, F.col("user_token") == F.col("fa_user"), "left"))
    today = day_diff("latest_card_payment_date", F.lit(p.as_of))
    gap = F.col("maximum_dormancy_in_between")
    final = (F.when(F.col("first_card_payment_date").isNull(), F.lit(None).cast("bigint"))
             .when(gap.isNull(), F.col("dormancy_from_today"))
             .when(F.col("dormancy_from_today") > gap, F.col("dormancy_from_today"))
             .otherwise(gap))
    return (df.withColumn("dormancy_from_today", today)
            .select("user_token", "merchant_token", "first_card_payment_date",
                    "latest_card_payment_date", "is_currently_frozen", "is_currently_deactivated",
                    "is_deleted", "fa_user", "dormancy_from_today", "maximum_dormancy_in_between",
                    final.alias("dormant_final")))


def payment_dormancy_buckets(t: Tables, p: Params) -> DataFrame:
    """Distribution of units over the dormancy ladder of ``dormant_final``."""
    d = payment_dormancy(t, p)
    return (d.groupBy(dormancy_bucket("dormant_final").alias("dormancy_category"))
            .agg(F.count_distinct("user_token").alias("units")))


# ---------------------------------------------------------------- C9 - C10

def _movement_parts(t: Tables, p: Params) -> tuple[DataFrame, DataFrame]:
    ua = t["card_activity"]
    bb = (ua.where(~ilike_any("activity_type", P.NON_MOVEMENT_PATTERNS)
                   & (F.col("activity_state") == P.SETTLED_STATE)
                   & (F.col("created_at") < ts_lit(p.movement_cutoff)))
          .select(F.to_date("created_at").cast("timestamp_ntz").alias("latest_dt"),
                  unit_from_balance_fixed("balance_token").cast(p.unit_key_type).alias("unit_token")))
    se = t["settlement_entry"]
    shifted = add_hours(micros_to_ts("created_us"), p.ledger_hour_shift)
    # the cutoff is shifted instead of the column, so that the scan sees it
    days = (p.movement_cutoff - dt.date(1970, 1, 1)).days
    cutoff_us = (days * 24 - p.ledger_hour_shift) * 3_600_000_000
    ledger = (se.where((F.col("created_us") < cutoff_us) & (F.col("is_verification") == F.lit(False)))
              .select(shifted.alias("latest_dt"),
                      F.col("merchant_token").cast(p.unit_key_type).alias("unit_token")))
    return bb, ledger


def movement_history(t: Tables, p: Params) -> DataFrame:
    """Days (ledger exits) and times (bank settlements) at which each unit
    moved money other than by card payment, before ``p.movement_cutoff``,
    tagged by source.  Dates are widened to timestamps (midnight)."""
    bb, ledger = _movement_parts(t, p)
    return (bb.distinct().withColumn("type", F.lit("bb_exit"))
            .unionByName(ledger.distinct().withColumn("type", F.lit("ledger"))))


def movement_latest(t: Tables, p: Params) -> DataFrame:
    """Latest non-payment money movement per unit (one partially
    aggregated shuffle; the per-source de-duplication is redundant under
    ``max``)."""
    return t.derived("movement_latest", p, lambda: _build_movement_latest(t, p))


def _build_movement_latest(t: Tables, p: Params) -> DataFrame:
    bb, ledger = _movement_parts(t, p)
    return (bb.unionByName(ledger).groupBy("unit_token")
            .agg(F.max("latest_dt").alias("latest_dt")))


def last_money_movement(t: Tables, p: Params) -> DataFrame:
    """Per-unit dormancy with the latest non-payment movement and the
    later of that and the last card payment."""
    d = payment_dormancy(t, p)
    mm = movement_latest(t, p)
    j = d.join(mm, d["user_token"] == mm["unit_token"], "left")
    card = F.col("latest_card_payment_date").cast("timestamp_ntz")
    return j.withColumn("last_money_movement_date", F.greatest(card, F.col("latest_dt")))


# ---------------------------------------------------------------- C11

def last_activity(t: Tables, p: Params) -> DataFrame:
    """C11: latest sign of activity per merchant across logins (successful,
    by day), web and mobile clicks, and the legacy activity table.

    The source's nested per-person and per-source maxima collapse into one
    ``max`` over the union of the sources (max is associative), which is a
    single partially-aggregated shuffle on the merchant token.  The same
    plan runs incrementally in ``riskspark.streaming``.
    """
    return t.derived("last_activity", p, lambda: _build_last_activity(t))


def _build_last_activity(t: Tables) -> DataFrame:
    return latest_activity(activity_events(t["login_event"], t["page_click"], t["mobile_click"],
                                           t["legacy_activity"]))


def last_app_activity(t: Tables, p: Params) -> DataFrame:
    """C11, first stage: latest login or click per merchant, before the
    legacy activity source is added (published on its own by the source)."""
    return latest_activity(activity_events(t["login_event"], t["page_click"], t["mobile_click"],
                                           None))


# ---------------------------------------------------------------- C12 - C13

def _merchant_max(df: DataFrame, merchant: str, at: str, name: str) -> DataFrame:
    return df.groupBy(F.col(merchant).alias(f"{name}_merchant")).agg(F.max(at).alias(name))


def risk_segmentation(t: Tables, p: Params) -> DataFrame:
    """Every active unit with its three dormancy buckets (card payment,
    any money movement, any activity), its merchant's lock status, and 0/1
    risk flags.

    The source joins every tagged login and every confirmed takeover of the
    unit's merchant, multiplying rows; all its reports read the flags only
    through ``count(distinct unit)``, and each flag is "some row has
    ``t > movement``" or "some row exists", i.e. ``max(t) > movement`` or
    ``max(t) is not null``.  So both sides are reduced to their latest time
    per merchant first: one row per unit, the same reports.
    """
    return t.derived("risk_segmentation", p, lambda: _build_risk_segmentation(t, p))


def _build_risk_segmentation(t: Tables, p: Params) -> DataFrame:
    df = last_money_movement(t, p)
    me = last_activity(t, p)
    ml = detection.group_fully_locked(t, p)
    users = t["dim_user"].select(F.col("user_token").alias("_du_user"),
                                 F.col("merchant_token").alias("_du_merchant"))
    # latest tag per user before meeting the user dimension (max of maxima)
    sk = (detection.tagged_events(t, p).where(F.col("fp_unit_token").isNull())
          .groupBy("target_token").agg(F.max("created_at").alias("created_at")))
    sk = sk.join(users, sk["target_token"] == users["_du_user"], "left")
    sk = _merchant_max(sk, "_du_merchant", "created_at", "tagged_at")
    ato = detection.confirmed_takeovers(t, p)
    ato = ato.join(users, ato["user_token"] == users["_du_user"], "left")
    ato = _merchant_max(ato, "_du_merchant", "earliest_confirmed_at", "ato_at")

    m = F.col("merchant_token")
    j = (df.where(active_unit())
         .join(me, me["subject_merchant_token"] == m, "left")
         .join(ml, ml["merchant_id"] == m, "left")
         .join(sk, sk["tagged_at_merchant"] == m, "left")
         .join(ato, ato["ato_at_merchant"] == m, "left"))

    lmm = F.col("last_money_movement_date")
    act = F.col("last_activity_date")
    act_gap = day_diff(lmm, act)
    j = (j.withColumn("payment_dormancy_category", dormancy_bucket("dormancy_from_today"))
         .withColumn("last_act_dormancy", day_diff(act, F.lit(p.as_of)))
         .withColumn("last_act_dormancy_category", dormancy_bucket("last_act_dormancy"))
         .withColumn("last_money_movement_dormancy", day_diff(lmm, F.lit(p.as_of)))
         .withColumn("last_money_movement_dormancy_category",
                     dormancy_bucket("last_money_movement_dormancy")))
    return j.select(
        *[c for c in j.columns if not c.endswith("_merchant") or c == "subject_merchant_token"],
        flag(F.col("tagged_at") > lmm).alias("tagged_post_latest_money_movement"),
        flag(F.col("tagged_at").isNotNull()).alias("tagged_login"),
        flag(F.col("ato_at") > lmm).alias("ato_post_latest_money_movement"),
        flag(F.col("ato_at").isNotNull()).alias("ato"),
        flag(act.isNotNull()).alias("activity"),
        flag((act > lmm) & (act_gap > p.activity_gap_short)).alias("activity_post_90_day_from_money_movement"),
        flag((act > lmm) & (act_gap > p.activity_gap_long)).alias("activity_post_540_day_from_money_movement"),
        flag(act > lmm).alias("activity_post_payment"),
        flag(act.isNull()).alias("no_activity"),
    )

_MOVED_REPORT = {
    "locked_users": "is_locked",
    "activity_post_90_day_from_money_movement_users": "activity_post_90_day_from_money_movement",
    "activity_post_money_movement_users": "activity_post_payment",
    "tagged_post_money_movement_users": "tagged_post_latest_money_movement",
    "no_activity_post_money_movement_users": "no_activity",
    "activity_post_540_day_from_money_movement_users": "activity_post_540_day_from_money_movement",
    "ato_post_money_movement_users": "ato_post_latest_money_movement",
    "ato_users": "ato",
}

_NEVER_MOVED_REPORT = {
    "locked_users": "is_locked",
    "activity_users": "activity",
    "tagged_login_users": "tagged_login",
    "no_activity_post_money_movement_users": "no_activity",
    "ato_users": "ato",
}


def _segment_report(seg: DataFrame, by: list[str], report: dict[str, str] | None = None,
                    non_locked: bool = False) -> DataFrame:
    conds = {name: F.col(col) == 1 for name, col in (report or {}).items()}
    if non_locked:
        conds["non_locked_users"] = F.col("is_locked") == 0
    return conditional_distinct_counts(seg, by, "user_token", "all_users", conds)


def segment_moved(t: Tables, p: Params) -> DataFrame:
    """Units that moved money, per money-movement dormancy bucket, with
    how many carry each risk state."""
    seg = risk_segmentation(t, p).where(F.col("last_money_movement_date").isNotNull())
    return (_segment_report(seg, ["last_money_movement_dormancy_category"], _MOVED_REPORT)
            .orderBy("last_money_movement_dormancy_category"))


def segment_never_moved(t: Tables, p: Params) -> DataFrame:
    """The same for units that never moved money."""
    seg = risk_segmentation(t, p).where(F.col("last_money_movement_date").isNull())
    return _segment_report(seg, ["last_money_movement_dormancy_category"], _NEVER_MOVED_REPORT)


def segment_distribution(t: Tables, p: Params) -> DataFrame:
    """All units per money-movement dormancy bucket, and the unlocked."""
    return _segment_report(risk_segmentation(t, p), ["last_money_movement_dormancy_category"],
                           non_locked=True)


def segment_crosstab(t: Tables, p: Params) -> DataFrame:
    """Units per (money-movement bucket, activity bucket)."""
    return _segment_report(risk_segmentation(t, p),
                           ["last_money_movement_dormancy_category", "last_act_dormancy_category"],
                           non_locked=True)


def excluded_units(t: Tables, p: Params) -> DataFrame:
    """Units left out of the segmentation (deleted, deactivated or
    frozen): the complement of its filter."""
    u = t["dim_user"].where(~active_unit() & (F.col("is_unit") == 1))
    return u.agg(F.count_distinct("user_token").alias("excluded_units"))


# ---------------------------------------------------------------- C14 - C15

def reactivations(t: Tables, p: Params) -> DataFrame:
    """Card-payment days that end a gap longer than ``p.reactivation_gap``
    days, up to ``p.reactivation_cohort_end``, for units only."""
    return t.derived("reactivations", p, lambda: _build_reactivations(t, p))


def _build_reactivations(t: Tables, p: Params) -> DataFrame:
    g = payment_gaps(t, p).where(
        (F.col("payment_date") <= F.lit(p.reactivation_cohort_end))
        & (F.col("difference") > p.reactivation_gap)
        & F.col("previous_payment_date").isNotNull())
    # an inner join, not a semi-join: like the source's gap history, a unit
    # listed twice in the user dimension has its reactivations twice
    units = _units(t).select(F.col("user_token").alias("unit_token"))
    return g.join(units, "unit_token").select("unit_token", "payment_date",
                                              "previous_payment_date")


def _chargeback_usd(t: Tables, p: Params) -> DataFrame:
    """Chargebacks per (payment day, user) converted at the chargeback day's
    rate (0 when no rate).  Cents are summed per (user, both days, currency)
    before any join, so a user with very many chargebacks is a few rows."""
    cb = (t["chargeback"].groupBy("user_token", F.to_date("payment_created_at").alias("payment_dt"),
                                  F.to_date("chargeback_date").alias("_day"), "currency_code")
          .agg(F.sum("chargeback_cents").alias("_cents")))
    fx = (t["fx_rate"].where(F.col("counter") == p.fx_counter_currency)
          .select(F.col("report_date").alias("_fx_date"), F.col("base").alias("_fx_base"),
                  "rate", "multiplier"))
    j = cb.join(fx, (F.col("_fx_date") == F.col("_day")) & (F.col("_fx_base") == F.col("currency_code")), "left")
    usd = F.coalesce(F.col("_cents") * F.col("rate") * F.col("multiplier"), F.lit(0.0))
    return j.groupBy("payment_dt", "user_token").agg(F.sum(usd).alias("chargebacks_usd"))


def chargebacks_fx_daily(t: Tables, p: Params) -> DataFrame:
    """Chargebacks per (payment day, user) converted at the chargeback
    day's rate (0 when no rate).  As in the source, a user's chargebacks are
    counted once per reactivation of that user (its join to the cohort
    multiplies rows), so the multiplicity is applied as a factor."""
    cb = _chargeback_usd(t, p)
    if p.dedupe_reactivation_chargebacks:
        return cb
    n_react = (reactivations(t, p).groupBy(F.col("unit_token").alias("_r_user"))
               .agg(F.count(F.lit(1)).alias("_n")))
    j = cb.join(n_react, cb["user_token"] == n_react["_r_user"], "left")
    return j.select("payment_dt", "user_token",
                    (F.col("chargebacks_usd") * F.coalesce(F.col("_n"), F.lit(1))).alias("chargebacks_usd"))


def reactivation_value(t: Tables, p: Params) -> DataFrame:
    """C14: per month of reactivation, reactivated units and the card volume
    and chargebacks of their later payment days within 90 / 365 days and
    overall (each reactivation counts its own later days).

    The source joins every reactivation to every later payment day of its
    unit.  Here one pass over each unit's payment days gives every day its
    gap to the previous card-payment day and the sums over its own later days
    (days +1..+90, +1..+365, +1..end; the days are ordered latest first, so
    the open frame only grows).  The reactivation days are then kept and meet
    the user dimension; a unit's chargebacks are multiplied by its number of
    reactivations at the end (see ``chargebacks_fx_daily``).
    """
    cb = _chargeback_usd(t, p).select(F.col("user_token").alias("_cb_user"),
                                      F.col("payment_dt").alias("_cb_day"), "chargebacks_usd")
    days = t["daily_payment"].select("unit_token", "payment_date", "gpv_cents", "card_payment_count")
    days = days.join(cb, (F.col("_cb_user") == F.col("unit_token"))
                     & (F.col("_cb_day") == F.col("payment_date")), "left")
    unit = Window.partitionBy("unit_token")
    # rows without a day come last, outside every frame of later days
    latest_first = unit.orderBy((-F.unix_date("payment_date")).asc_nulls_last())
    near = latest_first.rangeBetween(1 - p.value_horizon_short, -1)
    year = latest_first.rangeBetween(1 - p.value_horizon_long, -1)
    rest = latest_first.rangeBetween(Window.unboundedPreceding, -1)
    positive = F.col("card_payment_count") > 0
    # the previous card-payment day; this frame grows too, in date order
    before = (unit.orderBy(F.col("payment_date").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    previous = F.last(F.when(positive, F.col("payment_date")), ignorenulls=True).over(before)
    ahead = days.select(
        "unit_token", "payment_date", positive.alias("_positive"), previous.alias("_previous"),
        F.sum("gpv_cents").over(near).alias("_g_short"), F.sum("gpv_cents").over(year).alias("_g_long"),
        F.sum("gpv_cents").over(rest).alias("_g_all"), F.sum("chargebacks_usd").over(year).alias("_cb_long"),
        F.sum("chargebacks_usd").over(rest).alias("_cb_all"))
    r = ahead.where(F.col("_positive") & (F.col("payment_date") <= F.lit(p.reactivation_cohort_end))
                    & (day_diff("_previous", "payment_date") > p.reactivation_gap))
    # an inner join, not a semi-join: see _build_reactivations
    r = r.join(_units(t).select(F.col("user_token").alias("unit_token")), "unit_token")
    times = F.lit(1) if p.dedupe_reactivation_chargebacks else F.count(F.lit(1)).over(unit)
    r = r.withColumn("_n", times)
    per_unit = (r.groupBy(trunc_date("month", "payment_date").alias("payment_month"), "unit_token")
                .agg(F.sum("_g_short").alias("_g_short"), F.sum("_g_long").alias("_g_long"),
                     F.sum("_g_all").alias("_g_all"), F.sum(F.col("_cb_long") * F.col("_n")).alias("_cb_long"),
                     F.sum(F.col("_cb_all") * F.col("_n")).alias("_cb_all")))
    return (per_unit.groupBy("payment_month")
            .agg(F.count("unit_token").alias("units"),
                 (F.sum("_g_short") / 100).alias("gpv_enabled_90"),
                 (F.sum("_g_long") / 100).alias("gpv_enabled_365"),
                 (F.sum("_g_all") / 100).alias("overall_gpv_enabled"),
                 F.sum("_cb_long").alias("cb_enabled_365"),
                 F.sum("_cb_all").alias("total_cb")))
