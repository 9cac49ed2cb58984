"""The card ledger as mergeable states (C16, and C17-C22, which read it).

The rollup takes maxima, minima and counts per (transaction, unit, currency).
These merge, so the ledger need not be read again for every report: one state
per key and ledger day is kept in a published path (``manifest``), partitioned
by period.  A new day reads the ledger of that day only and adds a partition;
late or corrected rows replace the partitions of their days.  Once a month is
over, ``compact_ledger_states`` merges the states of its days into one period,
from the states alone.

A period is a day (``2024-05-03``), a compacted month (``2024-05``), or null
for ledger rows without a time.  Restating a day of a compacted month restates
the whole month, since a merged state can't give back what a day put in.
Years of history need not go through a directory a day: with ``days_from`` the
whole months before that day are stated as months at once.

The states are shuffled once by key when they are made and once when they are
read; there, a key brings at most one row per period.  Hot keys are combined
before both shuffles.  Writing deals rows by period and lets Spark split large
periods, so a busy day is several files, not one task.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalar import unit_from_balance_split
from ..functions.timefns import ts_lit
from ..manifest import Manifest, latest, publish_files, read_published, replace_partitions
from ..params import Params
from ..session import ensure_checkpoint_dir, shared_path
from ..sources.catalog import Tables
from . import disputes

PERIOD = "ledger_period"
KEYS = ("transaction_token", "unit_token", "currency_code")
_UNDATED = f"{PERIOD}=__HIVE_DEFAULT_PARTITION__"
_THROUGH = "through"


def _merged(states: DataFrame, *keys: str) -> DataFrame:
    """States of equal ``keys`` as one."""
    return states.groupBy(*keys).agg(
        F.max("settled_cents").alias("settled_cents"), F.min("settled_first_at").alias("settled_first_at"),
        F.sum("settled_rows").alias("settled_rows"), F.max("card_cents").alias("card_cents"),
        F.sum("card_rows").alias("card_rows"))


def _states(ledger: DataFrame, period: Column) -> DataFrame:
    """One state per period and key of the ledger's card payments, of which
    the settled ones are kept apart."""
    cents, settled = F.abs("amount_cents"), F.col("activity_state") == P.SETTLED_STATE
    return (ledger.where(F.col("activity_type").ilike(P.CARD_PAYMENT_PATTERN))
            .groupBy(period.alias(PERIOD), "transaction_token",
                     unit_from_balance_split("balance_token").alias("unit_token"), "currency_code")
            .agg(F.max(F.when(settled, cents)).alias("settled_cents"),
                 F.min(F.when(settled, F.col("created_at"))).alias("settled_first_at"),
                 F.count(F.when(settled, F.lit(1))).alias("settled_rows"),
                 F.max(cents).alias("card_cents"), F.count(F.lit(1)).alias("card_rows")))


def _dealt(states: DataFrame) -> DataFrame:
    """Rows as they are to be written: by period, large ones in several tasks."""
    return states.hint("rebalance", F.col(PERIOD)).sortWithinPartitions(PERIOD, "transaction_token")


def _day() -> Column:
    return F.to_date("created_at").cast("string")


def _period(days_from: dt.date | None, first: dt.date | None = None, last: dt.date | None = None) -> Column:
    """The period of a ledger row when the days ``first`` to ``last`` are
    stated: its month if all of that month is among them and before
    ``days_from``, else its day."""
    day = _day()
    if days_from is None:
        return day
    end = _month_start(days_from if last is None else min(days_from, last + dt.timedelta(days=1)))
    whole = F.col("created_at") < ts_lit(end)
    if first is not None:
        start = first if first == _month_start(first) else _next_month(first)
        whole = whole & (F.col("created_at") >= ts_lit(start))
    return F.when(whole, F.substring(day, 1, 7)).otherwise(day)


def _directory(period: str) -> str:
    return f"{PERIOD}={period}"


def ledger_periods(manifest: Manifest) -> list[str]:
    """The periods a version has states of, without the undated rows."""
    return sorted(d.partition("=")[2] for d in manifest.parts if d != _UNDATED)


def _months(manifest: Manifest) -> set[str]:
    return {period for period in ledger_periods(manifest) if len(period) == 7}


def _month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1)


def _last_day(period: str) -> dt.date:
    if len(period) == 7:
        return _next_month(dt.date.fromisoformat(f"{period}-01")) - dt.timedelta(days=1)
    return dt.date.fromisoformat(period)


def stated_through(manifest: Manifest) -> dt.date | None:
    """The last day whose ledger rows the version has (None: it has none)."""
    known = [_last_day(period) for period in ledger_periods(manifest)[-1:]]
    if _THROUGH in manifest.notes:
        known.append(dt.date.fromisoformat(manifest.notes[_THROUGH]))
    return max(known, default=None)


def _until(last: dt.date | None) -> Column:
    return F.lit(True) if last is None else F.col("created_at") < ts_lit(last + dt.timedelta(days=1))


def _noted(*days: dt.date | None) -> dict[str, str]:
    days = [d for d in days if d is not None]
    return {_THROUGH: max(days).isoformat()} if days else {}


def build_ledger_states(t: Tables, root: str, through: dt.date | None = None,
                        days_from: dt.date | None = None) -> Manifest:
    """Publish the states of all ledger rows up to the day ``through`` (None:
    of all days), and of those without a time, under ``root`` (shared
    storage): by month before ``days_from``, where months must be over, and
    by day from then on (None: all by day)."""
    wanted = _until(through) | F.col("created_at").isNull()
    return publish_files(_dealt(_states(t["card_activity"].where(wanted), _period(days_from, last=through))),
                         shared_path(t.spark, root), PERIOD, _noted(through))


def restate_ledger_days(t: Tables, root: str, first: dt.date, last: dt.date | None, undated: bool = False,
                        days_from: dt.date | None = None) -> Manifest:
    """State the ledger's days ``first`` to ``last`` (None: all from the first
    on) anew, be they new or with late or corrected rows, and keep all other
    periods as they are.  Only those days are read, or their whole months
    where these are compacted; with ``undated`` the rows without a time too.
    Months whose days are all stated anew become months at once before
    ``days_from``, as in ``build_ledger_states``."""
    root = shared_path(t.spark, root)
    base = latest(t.spark, root)
    if base is None:
        raise FileNotFoundError(f"no ledger states under {root}: build them first")
    if last is not None and last < first:
        raise ValueError(f"no days from {first} to {last}")
    noted = _noted(stated_through(base), last)
    months = _months(base)
    if first.isoformat()[:7] in months:
        first = _month_start(first)
    if last is not None and last.isoformat()[:7] in months:
        last = _next_month(last) - dt.timedelta(days=1)
    low, high = first.isoformat(), "9999-12-31" if last is None else last.isoformat()

    def replaced(directory: str) -> bool:
        if directory == _UNDATED:
            return undated
        period = directory.partition("=")[2]
        return low[:len(period)] <= period <= high[:len(period)]

    wanted = (F.col("created_at") >= ts_lit(first)) & _until(last)
    if undated:
        wanted = wanted | F.col("created_at").isNull()
    period = _period(days_from, first, last)
    if months:
        period = F.when(F.substring(period, 1, 7).isin(sorted(months)), F.substring(period, 1, 7)).otherwise(period)
    return replace_partitions(_dealt(_states(t["card_activity"].where(wanted), period)), root, base, replaced,
                              base.notes | noted)


def catch_up_ledger_states(t: Tables, root: str, through: dt.date) -> Manifest:
    """States up to the day ``through``: builds them the first time, later
    adds the days since the last one stated.  Nothing is read or written when
    that day is stated already."""
    base = latest(t.spark, shared_path(t.spark, root))
    if base is None:
        return build_ledger_states(t, root, through)
    done = stated_through(base)
    if done is None:
        return build_ledger_states(t, root, through)
    if done >= through:
        return base
    return restate_ledger_days(t, root, done + dt.timedelta(days=1), through)


def compact_ledger_states(spark: SparkSession, root: str, before: dt.date) -> Manifest:
    """Merge the day states of every month that ended before ``before`` (and
    whose days are all stated) into one period per month, reading the states
    of those days only.  Without such days the version stays as it is;
    ``manifest.vacuum`` deletes what no version names any more."""
    root = shared_path(spark, root)
    base = latest(spark, root)
    if base is None:
        raise FileNotFoundError(f"no ledger states under {root}: build them first")
    over = min(before, (stated_through(base) or before) + dt.timedelta(days=1))
    days = [d for d in ledger_periods(base) if len(d) == 10 and _next_month(dt.date.fromisoformat(d)) <= over]
    if not days:
        return base
    old = {_directory(d) for d in days}
    months = {_directory(d[:7]) for d in days}
    some = Manifest(base.number, base.schema, base.partition,
                    {k: v for k, v in base.parts.items() if k in old | months}, base.notes)
    states = read_published(spark, root, some).withColumn(PERIOD, F.substring(PERIOD, 1, 7))
    return replace_partitions(_dealt(_merged(states, PERIOD, *KEYS)), root, base,
                              old | months, base.notes)


def with_ledger_states(t: Tables, root: str, manifest: Manifest | None = None) -> Tables:
    """A catalog in which the dispute reports (C16-C22) read the published
    states (or those of ``manifest``) in place of the ledger."""
    states = read_published(t.spark, shared_path(t.spark, root), manifest)
    ledger = (_merged(states, *KEYS).where(F.col("settled_rows") > 0)
              .select(*KEYS, "settled_cents", "settled_first_at"))
    return t.with_derived({("card_ledger", None): ledger,
                           ("card_payments", None): states.select("transaction_token", "currency_code", "card_cents")})


def _states_in_steps(t: Tables, p: Params) -> Tables:
    """States built up to the middle of the key-result year (by month before
    that year), compacted, then caught up with one day and with all later ones
    (by month where the month is over on the as-of day): a directory for every
    day of a ledger's years costs more than its rows."""
    root = f"{ensure_checkpoint_dir(t.spark)}/ledger-states-{uuid.uuid4().hex}"
    t.drop_later(root)
    middle = dt.date(p.kpi_year, 7, 1)
    build_ledger_states(t, root, middle, days_from=dt.date(p.kpi_year, 1, 1))
    compact_ledger_states(t.spark, root, middle)
    catch_up_ledger_states(t, root, middle + dt.timedelta(days=1))
    restate_ledger_days(t, root, middle + dt.timedelta(days=2), None, days_from=p.as_of)
    return with_ledger_states(t, root)


def transaction_rollup_from_states(t: Tables, p: Params) -> DataFrame:
    """C16 from states that were built, compacted and caught up."""
    return disputes.transaction_rollup(_states_in_steps(t, p), p)


def loss_bps_month_from_states(t: Tables, p: Params) -> DataFrame:
    """C17 from states that were built, compacted and caught up."""
    return disputes.loss_bps_month(_states_in_steps(t, p), p)
