"""Books (shared intermediates staged once) give the same rows as the
individually planned queries, and leave no stage behind."""

import pathlib
import tempfile

import __spark_entry__ as E
from riskspark.plans import QUERIES
from riskspark.plans.books import BOOKS
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_books_match_single_queries(spark):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    qs = E.queries()
    seen = set()
    for name, book in BOOKS.items():
        root = tempfile.mkdtemp(prefix="rs-stage-", dir="/tmp")
        for report, df in book(t, E.PARAMS, root).items():
            assert _rows(df) == _rows(qs[report](spark, SF_SMALL)), report
            seen.add(report)
        assert any(pathlib.Path(root).iterdir()) == (name != "mart")
        t.drop_stages()
        assert not any(pathlib.Path(root).iterdir())
    assert seen == {name for name in QUERIES if not name.endswith("_from_states")}  # these are the same reports


def test_stages_are_parquet_and_pruned(spark):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    reports = BOOKS["dormancy"](t, E.PARAMS, tempfile.mkdtemp(prefix="rs-stage-", dir="/tmp"))
    plan = reports["payment_dormancy_buckets"]._jdf.queryExecution().toString()
    assert "stage-payment_dormancy" in plan and "ReadSchema: struct<user_token:bigint,dormant_final:bigint>" in plan
    t.drop_stages()
