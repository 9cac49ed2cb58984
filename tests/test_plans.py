"""Guards on the physical plans of every registered query: no nested-loop or
cartesian joins, and no Python evaluation (everything stays in the JVM)."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from riskspark.plans import QUERIES

from .conftest import SF_SMALL

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_nested_loops_or_python(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    plan = buf.getvalue()
    assert not [f for f in FORBIDDEN if f in plan]
