"""Report books: the analyses of one worksheet computed together.

Each book stages the intermediates its reports share as Parquet tables (under
``stage_root``, or the session's checkpoint directory), then derives every
report from them, instead of recomputing the shared parts once per report.
The returned DataFrames are lazy; write or collect them, then call
``t.drop_stages()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..params import Params
from ..sources.catalog import Tables
from . import attach, detection, disputes, dormancy, mart


def detection_book(t: Tables, p: Params, stage_root: str | None = None) -> dict[str, DataFrame]:
    t.materialize("tagged_events", p, lambda: detection._build_tagged_events(t, p), stage_root)
    # the months' sets of users: the year reports merge them
    t.materialize("recall_months", p, lambda: detection._build_recall_months(t, p), stage_root)
    t.materialize("precision_months", p, lambda: detection._build_precision_months(t, p), stage_root)
    names = ["tagged_event_extract", "confirmed_takeovers", "detector_recall_month", "detector_recall_year",
             "detector_precision_month", "detector_precision_year", "group_fully_locked",
             "headcount_profile", "headcount_buckets"]
    fns = {"tagged_event_extract": detection.tagged_events}
    return {n: fns.get(n, getattr(detection, n, None))(t, p) for n in names}


def dormancy_book(t: Tables, p: Params, stage_root: str | None = None) -> dict[str, DataFrame]:
    # in this order each is built from those before it; those that are joined
    # and grouped by unit are bucketed by it, so they are not shuffled again
    t.materialize("payment_gaps", p, lambda: dormancy._build_payment_gaps(t, p), stage_root, "unit_token")
    t.materialize("payment_dormancy", p, lambda: dormancy._build_payment_dormancy(t, p), stage_root,
                  "user_token")
    t.materialize("movement_latest", p, lambda: dormancy._build_movement_latest(t, p), stage_root, "unit_token")
    t.materialize("last_activity", p, lambda: dormancy._build_last_activity(t), stage_root)
    t.materialize("risk_segmentation", p, lambda: dormancy._build_risk_segmentation(t, p), stage_root)
    names = ["payment_gaps", "gap_history", "payment_dormancy", "payment_dormancy_buckets",
             "movement_history", "movement_latest", "last_money_movement", "last_app_activity",
             "last_activity",
             "risk_segmentation", "segment_moved", "segment_never_moved", "segment_distribution",
             "segment_crosstab", "excluded_units", "chargebacks_fx_daily", "reactivation_value"]
    return {n: getattr(dormancy, n)(t, p) for n in names}


def dispute_book(t: Tables, p: Params, stage_root: str | None = None) -> dict[str, DataFrame]:
    t.materialize("card_ledger", None, lambda: disputes._build_card_ledger(t), stage_root)
    names = ["transaction_rollup", "loss_bps_month", "dispute_rate_count", "dispute_rate_amount",
             "dispute_sellers", "high_dispute_share", "dispute_loss_split"]
    return {n: getattr(disputes, n)(t, p) for n in names}


def mart_book(t: Tables, p: Params, stage_root: str | None = None) -> dict[str, DataFrame]:
    return {"payment_risk_mart": mart.payment_risk_mart(t, p)}


def attach_book(t: Tables, p: Params, stage_root: str | None = None) -> dict[str, DataFrame]:
    t.materialize("daily_qualifying_payments", p, lambda: attach._build_daily_qualifying_payments(t, p), stage_root)
    names = ["daily_qualifying_payments", "first_online_signup", "paid_adoption_week",
             "risky_payments", "first_engagement", "risk_eval_attach_week"]
    return {n: getattr(attach, n)(t, p) for n in names}


BOOKS = {"detection": detection_book, "dormancy": dormancy_book, "disputes": dispute_book,
         "mart": mart_book, "attach": attach_book}
