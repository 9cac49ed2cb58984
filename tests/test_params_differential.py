"""Parameters drive both the plans and the oracle: with a second, shifted
parameter set every analysis still equals its oracle on the driver tables."""

import dataclasses
import datetime as dt

from riskspark.params import Params
from riskspark.plans import QUERIES
from riskspark.sources.driver_adapter import driver_tables
from riskspark.testing.compare import compare, duck_connection
from riskspark.testing.oracle_queries import oracle_queries

from .conftest import SF_ORACLE

D = dt.date

SHIFTED = dataclasses.replace(
    Params.for_driver_data(),
    as_of=D(2001, 6, 1), log_cutoff=D(2000, 12, 31), fp_window_start=D(1997, 6, 1),
    fp_window_end=D(1999, 6, 30), precision_cutoff=D(2000, 6, 1), match_days=10,
    movement_cutoff=D(2000, 1, 1), ledger_hour_shift=-9, activity_gap_short=60,
    activity_gap_long=400, reactivation_gap=400, reactivation_cohort_end=D(2000, 6, 1),
    value_horizon_short=31, value_horizon_long=181, kpi_year=1997, dispute_share_threshold=0.3,
    seller_dispute_delay_days=60, mart_start=D(1996, 1, 1), payments_start=D(1997, 6, 2),
    trailing_days=45, churn_lookback_days=30, adoption_first_week_offset_days=28,
    engagement_report_start=D(1999, 3, 1), engagement_activity_start=D(1998, 9, 1),
)


def test_shifted_parameters_match_oracle(spark):
    t = driver_tables(spark, SF_ORACLE)
    sql = oracle_queries(SHIFTED)
    con = duck_connection(SF_ORACLE)
    failures = []
    for name, plan in QUERIES.items():
        c = compare(name, plan(t, SHIFTED), con, sql[name])
        if not c.ok:
            failures.append((name, c.spark_rows, c.oracle_rows, c.detail[:200]))
    assert not failures
