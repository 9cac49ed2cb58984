"""Every literal the analyses depend on, as one frozen parameter set.

The worksheets this library re-expresses hard-code their cutoffs, windows,
bucket edges and allow-lists, and read the wall clock.  Here each of those is
a field, and ``as_of`` replaces the wall clock so that results are
reproducible.  ``Params()`` carries the production defaults;
``Params.for_driver_data()`` carries the values used on the synthetic
1995-2001 tables this repository is tested on.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

D = dt.date


# Ordered bucket ladders (upper bound exclusive, label) and the
# label used above the last edge.  Labels sort in ladder order.
DORMANCY_LADDER: tuple[tuple[int, str], ...] = (
    (180, "1. <180"),
    (365, "2. <1 year"),
    (545, "3. <1.5 year"),
    (730, "4. <2 year"),
    (1460, "5. <4 year"),
)
DORMANCY_TOP_LABEL = "6. 4+ year"

# Headcount ladder.  Exactly one person is its own bucket; the
# rest are "< edge" buckets (a headcount of 0 falls into "< 5", as in the
# source).
HEADCOUNT_ONE_LABEL = "1. 1"
HEADCOUNT_LADDER: tuple[tuple[int, str], ...] = (
    (5, "2. <5"),
    (10, "3. <10"),
    (20, "4. <20"),
    (50, "5. <50"),
)
HEADCOUNT_TOP_LABEL = "6. 50+"

# Ledger activity filters.
CARD_PAYMENT_PATTERN = "%card_payment%"
NON_MOVEMENT_PATTERNS = ("%CHARGEBACK%", "%CANCELLATION%", "UNKNOWN")
SETTLED_STATE = "SETTLED"
BALANCE_UNIT_SEPARATOR = "-c-"
BALANCE_UNIT_START = 19
BALANCE_UNIT_LENGTH = 13

# Tagged audit-log comments.
IP_MARKER = "IP"
IP_OFFSET = 3
IP_TERMINATOR = " #"

# Payment mart and attach rates.
ONLINE_ENTRY_METHODS = ("EXTERNAL_API", "EXTERNAL_API_ON_FILE")
ACTIVE_ENROLLED_STATES = ("in_trial", "subscribed")
ENDED_ENROLLED_STATES = ("trial_cancelled", "churned")
NORMAL_RISK_LEVEL = "NORMAL"
RISK_SEVERITY = (("HIGH", 3), ("MODERATE", 2), ("NORMAL", 1))
INACTIVE_SEGMENT = "Inactive"
ENGAGEMENT_APP = "dashboard"
ENGAGEMENT_CATALOG = "page_view"
ENGAGEMENT_DESCRIPTION_PATTERN = "Transactions: Show%"
BILL_PATH_SEPARATOR = "/"
BILL_PATH_PART = 5

# Payment attributes the risk mart carries as grouping keys, in
# the source's order (neutral names).  Minor-unit money columns are carried
# divided by 100 under the mapped name; the tip is carried both ways.
MART_PAYMENT_ATTRIBUTES = (
    "auth_intent_created_at", "country_code", "pan_token", "currency_code",
    "amount_base_unit", "auth_intent_amount", "tip_amount_base_unit", "decline_reasons",
    "is_refunded", "pan_masked", "is_gpv", "bin_country", "bin_prepaid_status", "card_brand",
    "entry_method", "auth_success", "auth_avs_status", "auth_cvv_status",
)
MART_MONEY_COLUMNS = {"amount_base_unit": "amount_base", "auth_intent_amount": "auth_amount",
                      "tip_amount_base_unit": "tip_amount"}
MART_MONEY_KEPT_RAW = ("tip_amount_base_unit",)


@dataclasses.dataclass(frozen=True)
class Params:
    # wall clock replacement
    as_of: dt.date = D(2022, 9, 13)

    # detection (takeover recall / precision)
    log_cutoff: dt.date = D(2022, 8, 1)
    fp_window_start: dt.date = D(2022, 7, 11)
    fp_window_end: dt.date = D(2022, 7, 29)
    precision_cutoff: dt.date = D(2022, 7, 1)
    match_days: int = 30

    # bucket of a merchant without people (None: the first "less than"
    # bucket, as in the source)
    headcount_zero_label: str | None = None

    # type of unit / merchant ids after extraction from balance tokens
    unit_key_type: str = "string"

    # dormancy: profile columns of the user dimension carried through the
    # gap history (C7) when the dimension has them
    user_profile_columns: tuple[str, ...] = (
        "user_created_at_date", "currently_frozen_at_date", "currently_deactivated_at_date")
    movement_cutoff: dt.date = D(2022, 9, 13)
    ledger_hour_shift: int = -5
    activity_gap_short: int = 90
    activity_gap_long: int = 540
    reactivation_gap: int = 540
    reactivation_cohort_end: dt.date = D(2022, 3, 1)
    value_horizon_short: int = 91
    value_horizon_long: int = 366
    fx_counter_currency: str = "USD"

    # tagged audit-log entries (fixed values of the source: its comment tag
    # and watch-list action)
    suspect_comment_pattern: str = "%#sketchylogin%"
    suspect_action: str = "Ato::Watchlist"

    # dispute key results; the allow-lists and resolution names below are
    # fixed values of the source, stated as it writes them
    kpi_year: int = 2021
    fraud_reason: str = "FRAUD_OR_UNAUTHORIZED"
    valid_final_resolutions: tuple[str, ...] = (
        "APPROVED", "DENIED", "CREDITED_FROM_SQUARE", "REJECTED_BY_MARQETA")
    valid_open_statuses: tuple[str, ...] = (
        "CLOSED", "FILED", "INITIATED", "LOST", "NETWORK_REJECTED",
        "PREARBITRATION", "REPRESENTMENT", "WON")
    platform_credit_resolution: str = "CREDITED_FROM_SQUARE"
    lost_status: str = "lost"
    seller_liable_resolution: str = "REJECTED_BY_SQUARE"
    seller_liable_reasons: tuple[str, ...] = ("PAYMENT_WITH_CHIP_AND_PIN", "CHIP_FALLBACK")
    dispute_share_threshold: float = 0.5
    seller_dispute_delay_days: int = 90

    # payment mart: start of the authorisation time window, the column it
    # applies to, and the payment attributes present in the payment table
    mart_start: dt.date = D(2020, 3, 31)
    mart_auth_time: str = "auth_intent_created_at"
    mart_payment_attributes: tuple[str, ...] = MART_PAYMENT_ATTRIBUTES

    # opt-in corrections of source behaviour (defaults keep the source's
    # results): rank risk levels by severity instead of text order (Q6/Q7),
    # and count a user's chargebacks once rather than once per reactivation
    # of that user (Q8)
    risk_level_by_severity: bool = False
    dedupe_reactivation_chargebacks: bool = False

    # attach rates
    payments_start: dt.date = D(2020, 3, 2)
    trailing_days: int = 92
    churn_lookback_days: int = 84
    adoption_first_week_offset_days: int = 84
    engagement_report_start: dt.date = D(2020, 5, 1)
    engagement_activity_start: dt.date = D(2020, 3, 1)

    @property
    def kpi_year_start(self) -> dt.date:
        return D(self.kpi_year, 1, 1)

    @property
    def kpi_year_end(self) -> dt.date:
        """First day of the following year (exclusive bound)."""
        return D(self.kpi_year + 1, 1, 1)

    @classmethod
    def for_driver_data(cls) -> "Params":
        """Parameters under which the synthetic 1995-2001 tables exercise
        every branch of every analysis."""
        return cls(
            as_of=D(2002, 1, 1),
            log_cutoff=D(2001, 8, 1),
            fp_window_start=D(1996, 1, 1),
            fp_window_end=D(2000, 12, 31),
            precision_cutoff=D(2001, 7, 1),
            unit_key_type="bigint",
            movement_cutoff=D(2002, 1, 1),
            reactivation_cohort_end=D(2001, 3, 1),
            suspect_comment_pattern="%#suspectlogin%",
            suspect_action="Watchlist",
            kpi_year=1998,
            fraud_reason="FRAUD",
            valid_final_resolutions=("APPROVED", "DENIED", "CREDITED"),
            platform_credit_resolution="CREDITED",
            seller_liable_resolution="SELLER_LIABLE",
            seller_liable_reasons=("CHIP",),
            seller_dispute_delay_days=150,
            mart_start=D(1997, 3, 31),
            payments_start=D(1998, 3, 2),
            engagement_report_start=D(1999, 1, 1),
            engagement_activity_start=D(1998, 3, 1),
        )
