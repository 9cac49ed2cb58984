"""Column builders used across the analyses.  All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P
from .timefns import col_


def bucketize(c: str | Column, ladder: Sequence[tuple[int, str]], top_label: str,
              *, null_label: str | None = None, null_is_null: bool = True,
              exact_first: tuple[int, str] | None = None) -> Column:
    """First-match ``CASE`` ladder: ``c < edge -> label`` in ladder order.

    ``null_is_null`` returns ``null_label`` (default NULL) for a NULL input;
    otherwise a NULL input falls through every arm to ``top_label``, which
    is what a ladder without a null arm does.  ``exact_first`` adds a leading
    ``c = value -> label`` arm.
    """
    x = col_(c)
    expr = None

    def arm(cond, label):
        nonlocal expr
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))

    if null_is_null:
        arm(x.isNull(), null_label)
    if exact_first is not None:
        arm(x == exact_first[0], exact_first[1])
    for edge, label in ladder:
        arm(x < edge, label)
    return expr.otherwise(F.lit(top_label))


def dormancy_bucket(c: str | Column) -> Column:
    return bucketize(c, P.DORMANCY_LADDER, P.DORMANCY_TOP_LABEL)


def headcount_bucket(c: str | Column, zero_label: str | None = None) -> Column:
    """``zero_label`` gives a headcount of 0 a bucket of its own; by default
    it falls into the first "less than" bucket, as in the source."""
    bucket = bucketize(c, P.HEADCOUNT_LADDER, P.HEADCOUNT_TOP_LABEL, null_is_null=False,
                       exact_first=(1, P.HEADCOUNT_ONE_LABEL))
    return bucket if zero_label is None else F.when(col_(c) == 0, F.lit(zero_label)).otherwise(bucket)


def flag(cond: Column) -> Column:
    """0/1 integer flag; a NULL condition gives 0, like ``CASE WHEN``."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num: str | Column, den: str | Column, scale: float | int | None = None) -> Column:
    """``num / den`` (times ``scale`` first, if given); NULL when ``den`` is 0
    or NULL instead of an ANSI error."""
    n = col_(num)
    if scale is not None:
        n = F.lit(scale) * n
    return F.try_divide(n, col_(den))


def bps(num: str | Column, den: str | Column) -> Column:
    return safe_ratio(num, den, 10000)


def minor_to_major(c: str | Column) -> Column:
    """Integer minor units -> major units (double), divided once at the end."""
    return col_(c) / F.lit(100)


def after_marker(c: str | Column, marker: str = P.IP_MARKER, offset: int = P.IP_OFFSET) -> Column:
    """``substring(c, position(marker, c) + offset)``; a missing marker gives
    position 0, i.e. the text from character ``offset``."""
    x = col_(c)
    start = F.locate(marker, x) + F.lit(offset)
    return F.substr(x, start)


def token_before(c: str | Column, terminator: str = P.IP_TERMINATOR) -> Column:
    """Text before the first ``terminator`` (``split_part(c, t, 1)``)."""
    return F.split_part(col_(c), F.lit(terminator), F.lit(1))


def unit_from_balance_fixed(balance: str | Column) -> Column:
    """Unit id stored at a fixed position of a balance token."""
    return F.substring(col_(balance), P.BALANCE_UNIT_START, P.BALANCE_UNIT_LENGTH)


def unit_from_balance_split(balance: str | Column) -> Column:
    """Unit id stored after the ``-c-`` separator of a balance token."""
    return F.split_part(col_(balance), F.lit(P.BALANCE_UNIT_SEPARATOR), F.lit(2))


def ilike_any(c: str | Column, patterns: Sequence[str]) -> Column:
    """``c ILIKE ANY (patterns)`` with SQL null propagation."""
    x = col_(c)
    out = None
    for p in patterns:
        term = x.ilike(p)
        out = term if out is None else (out | term)
    return out


def not_flagged(c: str | Column) -> Column:
    """``c IS NULL OR c != 1``."""
    x = col_(c)
    return x.isNull() | (x != 1)


def not_positive(c: str | Column) -> Column:
    """``c <= 0 OR c IS NULL``."""
    x = col_(c)
    return (x <= 0) | x.isNull()
