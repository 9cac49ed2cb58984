"""Sizes at sf0.01 that the analyses must reproduce: those of FIXTURES.md
section 3, computed there with independent DuckDB queries, and, where the
roster or the calendar was widened since, those of the DuckDB oracle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

from .conftest import SF_ORACLE


@pytest.fixture(scope="module")
def q(spark):
    qs = E.queries()
    return lambda n: qs[n](spark, SF_ORACLE)


def test_detection_and_roster_sizes(q):
    assert tuple(q("detector_recall_month").agg(F.sum("confirmed_ato"), F.sum("tagged_sellers")).first()) \
        == (38, 37)
    g = q("group_fully_locked")
    assert (g.where("is_locked = 1").count(), g.where("is_locked = 0").count()) == (69, 431)
    buckets = sorted((r.total_person_buckets, r.merchants) for r in q("headcount_buckets").collect())
    assert [n for _, n in buckets] == [8, 24, 40, 71, 259, 98]
    assert q("tagged_event_extract").count() == 1571


def test_dormancy_sizes(q):
    d = q("payment_dormancy")
    assert d.count() == 1425
    assert d.where("latest_card_payment_date is not null").count() == 1359
    assert d.where("maximum_dormancy_in_between is not null").count() == 1190
    assert tuple(d.agg(F.min("maximum_dormancy_in_between"), F.max("maximum_dormancy_in_between")).first()) \
        == (2, 2176)
    assert q("reactivation_value").count() == 56


def test_dispute_sizes(q):
    r = q("transaction_rollup")
    assert (r.count(), r.select("transaction_token").distinct().count()) == (2488, 2444)
    assert tuple(q("dispute_rate_count").agg(F.sum("count_card_transactions"),
                                             F.sum("count_card_disputes")).first()) == (2482, 613)
    assert tuple(q("high_dispute_share").agg(F.sum("total_active_sellers"),
                                             F.sum("seller_with_50pct_more_disputes")).first()) == (2295, 88)


def test_attach_sizes(q):
    a = q("paid_adoption_week")
    assert a.count() == 5327
    assert tuple(a.agg(F.sum("total_merchants"), F.sum("enrolled_merchants"),
                       F.countDistinct("gpv_segment"), F.countDistinct("week_start_date")).first()) \
        == (49757, 7437, 3, 189)
