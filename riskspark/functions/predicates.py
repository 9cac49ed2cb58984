"""Reusable row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import Params
from .scalar import not_flagged, not_positive
from .timefns import year_range


def fraud_in_year(p: Params, date_col: str = "transaction_date") -> Column:
    """Fraud-reason disputes whose transaction falls in ``p.kpi_year``."""
    return (F.col("reason_code") == p.fraud_reason) & year_range(date_col, p.kpi_year)


def resolution_counts(p: Params) -> Column:
    """A dispute counts when resolved with an allow-listed resolution, or
    still unresolved with an allow-listed status."""
    return (F.col("final_resolution").isin(*p.valid_final_resolutions)
            | (F.col("final_resolution").isNull() & F.col("status").isin(*p.valid_open_statuses)))


def valid_dispute(p: Params, date_col: str = "transaction_date") -> Column:
    return fraud_in_year(p, date_col) & resolution_counts(p)


def platform_borne(p: Params) -> Column:
    """Loss borne by the platform: credited back, or lost without the
    provisional credit having been debited."""
    return (F.col("final_resolution").ilike(p.platform_credit_resolution)
            | (F.col("status").ilike(p.lost_status)
               & F.col("provisional_credit_debited_date").isNull()))


def seller_borne(p: Params) -> Column:
    delay = F.datediff(F.col("seller_disputed_date"), F.to_date("transaction_date"))
    return ((F.col("final_resolution") == p.seller_liable_resolution)
            & (F.col("resolution_reason").isin(*p.seller_liable_reasons)
               | (delay > p.seller_dispute_delay_days)))


def active_unit(prefix: str = "") -> Column:
    """Not deleted, not deactivated, not frozen; NULL flags count as not set."""
    return (not_flagged(f"{prefix}is_deleted")
            & not_positive(f"{prefix}is_currently_deactivated")
            & not_positive(f"{prefix}is_currently_frozen"))
