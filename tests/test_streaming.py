"""Streaming C11 over files equals the batch result."""

import tempfile

import __spark_entry__ as E
from riskspark.plans import dormancy
from riskspark.sources.driver_adapter import driver_tables
from riskspark.streaming.activity import SOURCES, read_last_activity, start_last_activity

from .conftest import SF_SMALL


def test_streaming_last_activity_equals_batch(spark):
    t = driver_tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="rs-stream-", dir="/tmp")
    paths, schemas = {}, {}
    for s in SOURCES:
        df = t[s]
        paths[s] = f"{root}/{s}"
        df.write.mode("overwrite").parquet(paths[s])
        schemas[s] = df.schema
    q = start_last_activity(spark, paths, schemas, f"{root}/_checkpoint", query_name="rs_last_activity", in_memory=True)
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.table("rs_last_activity").collect()))
    want = sorted(map(tuple, dormancy.last_activity(t, E.PARAMS).collect()))
    assert got == want and got


def test_streaming_change_log_in_two_batches(spark):
    """Files arrive in two parts; the change log read back equals the batch
    result over everything."""
    t = driver_tables(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="rs-stream2-", dir="/tmp")
    paths, schemas, parts = {}, {}, {}
    for s in SOURCES:
        df = t[s]
        paths[s] = f"{root}/{s}"
        schemas[s] = df.schema
        parts[s] = df.randomSplit([0.5, 0.5], seed=7)
        parts[s][0].write.mode("append").parquet(paths[s])
    sink, ckpt = f"{root}/_sink", f"{root}/_checkpoint"
    start_last_activity(spark, paths, schemas, ckpt, sink_path=sink).awaitTermination(120)
    for s in SOURCES:
        parts[s][1].write.mode("append").parquet(paths[s])
    start_last_activity(spark, paths, schemas, ckpt, sink_path=sink).awaitTermination(120)
    got = sorted(map(tuple, read_last_activity(spark, sink).collect()))
    want = sorted(map(tuple, dormancy.last_activity(t, E.PARAMS).collect()))
    assert got == want and got
