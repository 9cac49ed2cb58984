"""Mergeable distinct sets and nearest events, against brute force in Python."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskspark.operators.distinct_sets import count_states, distinct_states, merge_states
from riskspark.operators.temporal import with_nearest
from riskspark.plans.books import detection_book
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


def _random_rows(seed, text):
    r = random.Random(seed)
    key = (lambda: r.choice([None, "", "ä", *(f"k{r.randrange(300)}" for _ in range(9))])) if text else (
        lambda: r.choice([None, *(r.randrange(-50, 250) for _ in range(9))]))
    return [(r.choice([None, 1, 2, 3, 7]), r.choice("ab"), key(), r.choice([None, True, False])) for _ in range(4000)] + [
        (9, "a", None, True)]


@pytest.mark.parametrize("text, parts", [(False, 1), (False, 16), (True, 5)])
def test_months_merge_to_years(spark, text, parts):
    rows = _random_rows(5, text)
    df = spark.createDataFrame(rows, f"month int, kind string, key {'string' if text else 'long'}, hit boolean")
    states = distinct_states(df, ["month", "kind"], "key", {"hits": F.col("hit")}, parts=parts)

    def brute(group):
        sets = {}
        for month, kind, key, hit in rows:
            total, hits = sets.setdefault(group(month, kind), (set(), set()))
            if key is not None:
                total.add(key)
                if hit:
                    hits.add(key)
        return {(*g, len(a), len(b)) for g, (a, b) in sets.items()}

    assert {tuple(x) for x in count_states(states, ["month", "kind"], "n", ["hits"]).collect()} == brute(
        lambda m, k: (m, k))
    merged = merge_states(states, {"half": F.col("month") > 2}, ["hits"])
    assert {tuple(x) for x in count_states(merged, ["half"], "n", ["hits"]).collect()} == brute(
        lambda m, k: (None if m is None else m > 2,))


def test_more_keys_than_a_piece_holds(spark):
    df = spark.range(100_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("key"))
    states = distinct_states(df, ["g"], "key", {}, parts=2)
    assert states.count() > 4
    assert {tuple(x) for x in count_states(states, ["g"], "n", []).collect()} == {(0, 50_000), (1, 50_000)}
    assert count_states(merge_states(states, {"all": F.lit(1)}, []), ["all"], "n", []).first().n == 100_000


def test_empty_sets(spark):
    states = distinct_states(spark.createDataFrame([], "g int, key long, hit boolean"), ["g"], "key",
                             {"hits": F.col("hit")})
    assert count_states(states, ["g"], "n", ["hits"]).collect() == []


def test_nearest_events(spark):
    r = random.Random(3)
    at = lambda: r.choice([None, *(dt.datetime(2001, 1, 1) + dt.timedelta(hours=12 * r.randrange(200))
                                   for _ in range(9))])
    events = [(r.choice([None, 1, 2, 3]), at(), i) for i in range(300)] + [(1, dt.datetime(2001, 1, 2), 999)] * 2
    others = [(r.choice([None, 1, 2, 4]), at()) for _ in range(60)]
    got = with_nearest(spark.createDataFrame(events, "k int, at timestamp_ntz, i int"),
                       spark.createDataFrame(others, "k int, at timestamp_ntz"), "k", "at", "before", "after")
    want = []
    for k, a, i in events:
        near = [b for c, b in others if c == k and k is not None and b is not None and a is not None]
        want.append((k, a, i, max((b for b in near if b <= a), default=None), min((b for b in near if b >= a), default=None)))
    # (an event without a time has no place: what it is told is not read)
    told = lambda rows: sorted(map(repr, (x for x in rows if x[1] is not None)))
    assert told(tuple(x) for x in got.select("k", "at", "i", "before", "after").collect()) == told(want)
    assert got.count() == len(events)


def test_reports_match_without_joins_and_years_read_the_months(spark):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    root = tempfile.mkdtemp(prefix="rs-stage-", dir="/tmp")
    reports = detection_book(t, E.PARAMS, root)
    for kind in ("recall", "precision"):
        plan = reports[f"detector_{kind}_year"]._jdf.queryExecution().toString()
        assert f"stage-{kind}_months" in plan and "bitmap_or_agg" in plan and "Join" not in plan
        assert plan.count("FileScan parquet") == 1
    t.drop_stages()


def test_one_shuffle_brings_tags_and_confirmations_together(spark):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    tags = t["audit_log"].select(F.col("target_token").alias("user_token"), F.col("created_at").alias("at"))
    ato = t["ato_merchant"].select("user_token", F.col("earliest_confirmed_at").alias("at"))
    plan = with_nearest(ato, tags, "user_token", "at", "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "rangebetween" not in plan.lower().replace("rangeframe", "")
    df = with_nearest(ato, tags, "user_token", "at", "a", "b")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert final.split("== Initial Plan ==")[0].count("hashpartitioning(user_token") == 1
