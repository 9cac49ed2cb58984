"""Cross-query invariants on the driver tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_ORACLE


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda name: qs[name](spark, SF_ORACLE)


def _sum(df, col):
    return df.agg(F.sum(col)).first()[0] or 0


def test_segmentation_partitions_units(q, spark):
    seg = q("risk_segmentation")
    n_seg = seg.select("user_token").distinct().count()
    assert n_seg == seg.count()                          # one row per unit
    assert _sum(q("segment_distribution"), "all_users") == n_seg
    assert _sum(q("segment_moved"), "all_users") + _sum(q("segment_never_moved"), "all_users") == n_seg
    assert _sum(q("segment_crosstab"), "all_users") == n_seg
    units = E.driver_tables(spark, SF_ORACLE)["dim_user"].where("is_unit = 1").count()
    assert n_seg + q("excluded_units").first()[0] == units


def test_detection_matched_at_most_total(q):
    for name in ("detector_recall_month", "detector_recall_year"):
        assert q(name).where("tagged_sellers > confirmed_ato").count() == 0
    for name in ("detector_precision_month", "detector_precision_year"):
        assert q(name).where("confirmed_ato > tagged_users").count() == 0
    assert _sum(q("detector_recall_month"), "confirmed_ato") == _sum(q("detector_recall_year"), "confirmed_ato")


def test_headcount_buckets_cover_merchants(q):
    assert _sum(q("headcount_buckets"), "merchants") == q("headcount_profile").count()
    assert _sum(q("headcount_buckets"), "locked_merchants") == \
        q("group_fully_locked").where("is_locked = 1").count()


def test_attach_rates_bounded(q):
    assert q("paid_adoption_week").where("enrolled_merchants > total_merchants").count() == 0
    assert q("risk_eval_attach_week").where("active > total or total = 0").count() == 0


def test_dispute_kpis_consistent(q):
    rate = q("dispute_rate_amount")
    assert rate.where("disputed > spend").count() == 0
    split = q("dispute_loss_split")
    assert split.where("valid_fraud_dispute_amount > fraud_dispute_amount").count() == 0
