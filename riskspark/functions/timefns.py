"""Date and time helpers that stay inside Catalyst.

Source timestamps are wall-clock values without a zone (``timestamp_ntz``).
Everything here keeps them that way, so no result depends on the session
time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(d: dt.date) -> Column:
    """Midnight of ``d`` as a zone-less timestamp: what a date-only literal
    means when compared with a timestamp.  (A date cast to ``timestamp_ntz``
    does not depend on the session or Python time zone.)"""
    return F.lit(d).cast("timestamp_ntz")


def micros_to_ts(micros: str | Column) -> Column:
    """Epoch microseconds -> zone-less timestamp, exact to the microsecond."""
    c = col_(micros)
    return F.expr(_EPOCH_NTZ) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), c.cast("decimal(20,0)") / F.lit(1_000_000))


def ts_to_micros(ts: str | Column) -> Column:
    """Zone-less timestamp -> epoch microseconds (inverse of ``micros_to_ts``)."""
    c = col_(ts)
    return (F.unix_date(F.to_date(c)).cast("bigint") * F.lit(86_400_000_000)
            + F.hour(c).cast("bigint") * F.lit(3_600_000_000)
            + F.minute(c).cast("bigint") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("bigint"))


def add_hours(ts: str | Column, hours: int) -> Column:
    return col_(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


def trunc_date(unit: str, c: str | Column) -> Column:
    """``date_trunc`` returning a date (weeks start on Monday)."""
    return F.date_trunc(unit, col_(c)).cast("date")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end`` (bigint).

    Spark's two-argument ``datediff(end, start)`` counts date boundaries,
    which is what a warehouse ``datediff(day, start, end)`` does on both
    dates and timestamps.
    """
    return F.datediff(col_(end), col_(start)).cast("bigint")


def year_range(c: str | Column, year: int) -> Column:
    """``year(c) = year`` written as a range, so Parquet min/max statistics
    can prune row groups."""
    cc = col_(c)
    return (cc >= ts_lit(dt.date(year, 1, 1))) & (cc < ts_lit(dt.date(year + 1, 1, 1)))
