"""Analyses: each is ``f(tables, params) -> DataFrame``.

``QUERIES`` registers every analysis under the name used by the driver
contract, the oracle and the benchmark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..params import Params
from ..sources.catalog import Tables
from . import attach, detection, disputes, dormancy, ledger_states, mart

Plan = Callable[[Tables, Params], DataFrame]

QUERIES: dict[str, Plan] = {
    "tagged_event_extract": detection.tagged_events,
    "confirmed_takeovers": detection.confirmed_takeovers,
    "detector_recall_month": detection.detector_recall_month,
    "detector_recall_year": detection.detector_recall_year,
    "detector_precision_month": detection.detector_precision_month,
    "detector_precision_year": detection.detector_precision_year,
    "group_fully_locked": detection.group_fully_locked,
    "headcount_profile": detection.headcount_profile,
    "headcount_buckets": detection.headcount_buckets,
    "payment_gaps": dormancy.payment_gaps,
    "gap_history": dormancy.gap_history,
    "payment_dormancy": dormancy.payment_dormancy,
    "payment_dormancy_buckets": dormancy.payment_dormancy_buckets,
    "movement_history": dormancy.movement_history,
    "movement_latest": dormancy.movement_latest,
    "last_money_movement": dormancy.last_money_movement,
    "last_app_activity": dormancy.last_app_activity,
    "last_activity": dormancy.last_activity,
    "risk_segmentation": dormancy.risk_segmentation,
    "segment_moved": dormancy.segment_moved,
    "segment_never_moved": dormancy.segment_never_moved,
    "segment_distribution": dormancy.segment_distribution,
    "segment_crosstab": dormancy.segment_crosstab,
    "excluded_units": dormancy.excluded_units,
    "chargebacks_fx_daily": dormancy.chargebacks_fx_daily,
    "reactivation_value": dormancy.reactivation_value,
    "transaction_rollup": disputes.transaction_rollup,
    "loss_bps_month": disputes.loss_bps_month,
    "dispute_rate_count": disputes.dispute_rate_count,
    "dispute_rate_amount": disputes.dispute_rate_amount,
    "dispute_sellers": disputes.dispute_sellers,
    "high_dispute_share": disputes.high_dispute_share,
    "dispute_loss_split": disputes.dispute_loss_split,
    "transaction_rollup_from_states": ledger_states.transaction_rollup_from_states,
    "loss_bps_month_from_states": ledger_states.loss_bps_month_from_states,
    "payment_risk_mart": mart.payment_risk_mart,
    "daily_qualifying_payments": attach.daily_qualifying_payments,
    "first_online_signup": attach.first_online_signup,
    "paid_adoption_week": attach.paid_adoption_week,
    "risky_payments": attach.risky_payments,
    "first_engagement": attach.first_engagement,
    "risk_eval_attach_week": attach.risk_eval_attach_week,
}
