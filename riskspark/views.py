"""Spark SQL access: logical tables and analyses as temporary views.

Users of the source worksheets work in SQL; after ``register_views`` they
can keep doing so (``spark.sql("select * from segment_moved")``), with
every analysis planned by this library.
"""

from __future__ import annotations

from collections.abc import Iterable

from .params import Params
from .plans import QUERIES
from .sources.catalog import LOGICAL_TABLES, Tables


def register_views(t: Tables, p: Params, analyses: Iterable[str] | None = None,
                   logical_tables: bool = True) -> list[str]:
    """Create (or replace) temporary views for the logical tables present in
    ``t`` and for the named analyses (all when ``analyses`` is None).
    Returns the view names.  Views are lazy: nothing runs until queried."""
    names = []
    if logical_tables:
        for n in LOGICAL_TABLES:
            if n in t:
                t[n].createOrReplaceTempView(n)
                names.append(n)
    for n in (QUERIES if analyses is None else analyses):
        QUERIES[n](t, p).createOrReplaceTempView(n)
        names.append(n)
    return names
