"""Property tests for the shared operators (hypothesis; few examples, as
each runs a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskspark import params as P
from riskspark.functions.scalar import dormancy_bucket, headcount_bucket
from riskspark.functions.timefns import micros_to_ts, ts_to_micros
from riskspark.operators.aggs import conditional_distinct_counts

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 6)),
                             st.integers(0, 3)), min_size=0, max_size=40)


@SETTINGS
@given(rows=rows_st)
def test_conditional_distinct_counts_equal_count_distinct(spark, rows):
    df = spark.createDataFrame(rows, "g string, k int, v int")
    got = conditional_distinct_counts(df, ["g"], "k", "n", {"n_odd": F.col("v") % 2 == 1,
                                                               "n_big": F.col("v") > 1})
    want = df.groupBy("g").agg(F.count_distinct("k").alias("n"),
                               F.count_distinct(F.when(F.col("v") % 2 == 1, F.col("k"))).alias("n_odd"),
                               F.count_distinct(F.when(F.col("v") > 1, F.col("k"))).alias("n_big"))
    order = lambda r: (r[0] is None, r[0] or "")
    assert sorted(map(tuple, got.select("g", "n", "n_odd", "n_big").collect()), key=order) == \
        sorted(map(tuple, want.select("g", "n", "n_odd", "n_big").collect()), key=order)


def _ladder(x, ladder, top, null_label=None, exact_one=None, null_arm=True):
    if x is None and null_arm:
        return null_label
    if exact_one is not None and x is not None and x == 1:
        return exact_one
    for edge, label in ladder:
        if x is not None and x < edge:
            return label
    return top


@SETTINGS
@given(xs=st.lists(st.one_of(st.none(), st.integers(-5, 2000)), min_size=1, max_size=30))
def test_bucket_ladders(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    got = [tuple(r) for r in df.select("x", dormancy_bucket("x"), headcount_bucket("x")).collect()]
    want = [(x, _ladder(x, P.DORMANCY_LADDER, P.DORMANCY_TOP_LABEL),
             _ladder(x, P.HEADCOUNT_LADDER, P.HEADCOUNT_TOP_LABEL, exact_one=P.HEADCOUNT_ONE_LABEL,
                     null_arm=False))
            for x in xs]
    assert sorted(got, key=str) == sorted(want, key=str)


@SETTINGS
@given(ts=st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1)),
                   min_size=1, max_size=20))
def test_epoch_micros_round_trip(spark, ts):
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    out = df.select("t", ts_to_micros("t").alias("us")).select("t", "us", micros_to_ts("us").alias("back"))
    for r in out.collect():
        assert r.back == r.t
        assert r.us == (r.t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
