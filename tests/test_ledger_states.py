"""States of the card ledger: equal to the full scan however they came about,
and a new day touches that day only."""

import contextlib
import datetime as dt
import io
import random
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskspark import manifest as M
from riskspark.params import Params
from riskspark.plans import disputes
from riskspark.plans import ledger_states as L
from riskspark.sources.catalog import Tables
from riskspark.sources.driver_adapter import BALANCE_PREFIX, driver_tables

from .conftest import SF_SMALL

D = dt.date
DDL = ("transaction_token bigint, balance_token string, currency_code string, amount_cents bigint, "
       "activity_type string, activity_state string, created_at timestamp_ntz")
REPORTS = ("transaction_rollup", "loss_bps_month", "dispute_rate_count", "dispute_rate_amount", "dispute_sellers",
           "high_dispute_share", "dispute_loss_split")


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="rs-ledger-", dir="/tmp") + "/states"


def _ledger(seed=3, n=600, hot=200):
    """Rows over 80 days of 2021; a third on one token, some undated, some
    without amount, token or currency, some no card payments, repeated rows."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        token = 7 if i < hot else r.choice([None, *range(40)])
        at = None if r.random() < 0.03 else dt.datetime(2021, 1, 20) + dt.timedelta(
            days=r.randrange(80), microseconds=r.randrange(86_400_000_000))
        rows.append((token, f"{BALANCE_PREFIX}{r.randrange(5):04d}", r.choice(["USD", "CAD", None]),
                     r.choice([None, r.randrange(-9999, 9999)]), r.choice(["CARD_PAYMENT", "card_payment", "UNKNOWN", None]),
                     r.choice(["SETTLED", "PENDING", None]), at))
    return rows + rows[:30]


def _tables(spark, rows):
    return Tables(spark, {"card_activity": spark.createDataFrame(rows, DDL)})


def _got(df):
    return sorted(map(repr, df.collect()))


def _full(spark, rows):
    t = _tables(spark, rows)
    return _got(disputes.card_ledger(t, None)), _got(_largest(t))


def _largest(t):
    return disputes.card_payments(t).groupBy("transaction_token", "currency_code").agg(F.max("card_cents").alias("c"))


def _from_states(spark, root):
    t = L.with_ledger_states(Tables(spark), root)
    return _got(disputes.card_ledger(t, None)), _got(_largest(t))


def _upto(rows, last):
    return [r for r in rows if r[-1] is None or r[-1].date() <= last]


def test_states_equal_the_full_scan_at_every_step(spark, root):
    rows = _ledger()
    t = _tables(spark, rows)
    L.catch_up_ledger_states(t, root, D(2021, 2, 9))
    assert _from_states(spark, root) == _full(spark, _upto(rows, D(2021, 2, 9)))
    L.catch_up_ledger_states(t, root, D(2021, 2, 10))
    assert _from_states(spark, root) == _full(spark, _upto(rows, D(2021, 2, 10)))
    L.compact_ledger_states(spark, root, D(2021, 3, 1))
    assert "2021-01" in L.ledger_periods(M.latest(spark, root))
    assert "2021-02-10" in L.ledger_periods(M.latest(spark, root))  # its month is not all stated
    assert _from_states(spark, root) == _full(spark, _upto(rows, D(2021, 2, 10)))
    m = L.catch_up_ledger_states(t, root, D(2021, 5, 1))
    assert L.stated_through(m) == D(2021, 5, 1)
    m = L.compact_ledger_states(spark, root, D(2021, 4, 1))
    assert [p for p in L.ledger_periods(m) if len(p) == 7] == ["2021-01", "2021-02", "2021-03"]
    assert not [p for p in L.ledger_periods(m) if len(p) == 10 and p < "2021-04"]
    M.vacuum(spark, root, keep=0)
    assert _from_states(spark, root) == _full(spark, rows)


def test_counts_are_not_doubled(spark, root):
    rows = _ledger()
    t = _tables(spark, rows)
    L.build_ledger_states(t, root)
    L.compact_ledger_states(spark, root, D(2021, 3, 1))
    L.restate_ledger_days(t, root, D(2021, 1, 25), D(2021, 3, 5), undated=True)
    total = M.read_published(spark, root).agg(F.sum("card_rows"), F.sum("settled_rows")).first()
    card = [r for r in rows if (r[4] or "").lower() == "card_payment"]
    assert tuple(total) == (len(card), sum(r[5] == "SETTLED" for r in card))


def test_a_new_day_reads_and_writes_that_day_only(spark, root):
    rows = _ledger()
    day = D(2021, 3, 3)
    before = L.build_ledger_states(_tables(spark, _upto(rows, D(2021, 3, 2))), root, D(2021, 3, 2))
    # all other days of the ledger are others now: nobody may look at them
    others = [(*r[:3], 5_000_000, *r[4:]) for r in rows if r[-1] is None or r[-1].date() != day]
    today = [r for r in rows if r[-1] and r[-1].date() == day]
    after = L.catch_up_ledger_states(_tables(spark, others + today), root, day)
    assert set(after.parts) - set(before.parts) == {f"{L.PERIOD}={day}"}
    assert {k: after.parts[k] for k in before.parts} == before.parts
    assert _from_states(spark, root) == _full(spark, _upto(rows, day))
    # nothing to do the second time
    assert L.catch_up_ledger_states(_tables(spark, rows), root, day) == after


def test_the_days_reach_the_ledgers_scan(spark, root, monkeypatch):
    path = tempfile.mkdtemp(prefix="rs-ledger-", dir="/tmp") + "/ledger"
    spark.createDataFrame(_ledger(), DDL).write.parquet(path)
    t = Tables.from_parquet(spark, {"card_activity": path})
    L.build_ledger_states(t, root, D(2021, 3, 1))
    plans = []

    def seen(df, *args):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        plans.append(out.getvalue())
        return M.replace_partitions(df, *args)

    monkeypatch.setattr(L, "replace_partitions", seen)
    L.catch_up_ledger_states(t, root, D(2021, 3, 2))
    pushed = [line for line in plans[0].splitlines() if "PushedFilters" in line]
    assert len(pushed) == 1 and "GreaterThanOrEqual(created_at,2021-03-02" in pushed[0]
    assert "LessThan(created_at,2021-03-03" in pushed[0]
    assert "RebalancePartitions" in plans[0] or "REBALANCE" in plans[0]


def test_late_rows_restate_a_day_or_its_compacted_month(spark, root):
    rows = _ledger()
    L.build_ledger_states(_tables(spark, rows), root)
    base = L.compact_ledger_states(spark, root, D(2021, 3, 1))
    late = [(99, f"{BALANCE_PREFIX}0001", "USD", -77, "CARD_PAYMENT", "SETTLED", dt.datetime(2021, 2, 11, 5)),
            (7, f"{BALANCE_PREFIX}0001", "USD", 10 ** 9, "CARD_PAYMENT", "SETTLED", dt.datetime(2021, 3, 9, 23, 59))]
    t = _tables(spark, rows + late)
    L.restate_ledger_days(t, root, D(2021, 2, 11), D(2021, 2, 11))
    after = L.restate_ledger_days(t, root, D(2021, 3, 9), D(2021, 3, 9))
    changed = {k for k in after.parts if after.parts[k] != base.parts.get(k)}
    assert changed == {f"{L.PERIOD}=2021-02", f"{L.PERIOD}=2021-03-09"}
    assert _from_states(spark, root) == _full(spark, rows + late)
    # rows that are gone leave no state behind
    gone = [r for r in rows if not (r[-1] and r[-1].date() == D(2021, 3, 9))]
    after = L.restate_ledger_days(_tables(spark, gone), root, D(2021, 2, 1), None)
    assert f"{L.PERIOD}=2021-03-09" not in after.parts
    assert _from_states(spark, root) == _full(spark, gone)


def test_empty_ledgers_and_wrong_calls(spark, root):
    empty = _tables(spark, [])
    with pytest.raises(FileNotFoundError):
        L.restate_ledger_days(empty, root, D(2021, 1, 1), D(2021, 1, 2))
    with pytest.raises(FileNotFoundError):
        L.compact_ledger_states(spark, root, D(2021, 1, 1))
    m = L.build_ledger_states(empty, root)
    assert L.ledger_periods(m) == [] and L.stated_through(m) is None
    assert _from_states(spark, root) == ([], [])
    assert L.compact_ledger_states(spark, root, D(2021, 1, 1)) == m
    with pytest.raises(ValueError):
        L.restate_ledger_days(empty, root, D(2021, 1, 2), D(2021, 1, 1))
    rows = _ledger(n=60, hot=20)
    L.catch_up_ledger_states(_tables(spark, rows), root, D(2021, 12, 31))
    assert _from_states(spark, root) == _full(spark, rows)


def test_reports_read_the_states_in_place_of_the_ledger(spark, root):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    L.build_ledger_states(t, root)
    L.compact_ledger_states(spark, root, D(1998, 1, 1))
    s = L.with_ledger_states(t, root)
    for name in REPORTS:
        assert _got(getattr(disputes, name)(s, E.PARAMS)) == _got(getattr(disputes, name)(t, E.PARAMS)), name


def test_a_parameter_moves_the_reports_not_the_states(spark, root):
    t = driver_tables(spark, SF_SMALL, fresh=True)
    p = Params.for_driver_data()
    L.build_ledger_states(t, root)
    s = L.with_ledger_states(t, root)
    for year in (p.kpi_year - 1, p.kpi_year):
        q = E.PARAMS.__class__(**{**E.PARAMS.__dict__, "kpi_year": year})
        assert _got(disputes.transaction_rollup(s, q)) == _got(disputes.transaction_rollup(t, q))


def test_whole_months_are_stated_at_once(spark, root):
    rows = _ledger()
    t = _tables(spark, rows)
    m = L.build_ledger_states(t, root, D(2021, 3, 10), days_from=D(2021, 3, 5))
    periods = L.ledger_periods(m)
    assert [p for p in periods if len(p) == 7] == ["2021-01", "2021-02"]
    assert periods[2:] and all("2021-03-01" <= p <= "2021-03-10" for p in periods[2:])
    assert L.stated_through(m) == D(2021, 3, 10)
    assert _from_states(spark, root) == _full(spark, _upto(rows, D(2021, 3, 10)))
    # the rest of a month begun by day stays by day, and so does a month that is not all stated
    m = L.restate_ledger_days(t, root, D(2021, 3, 11), D(2021, 4, 8), days_from=D(2021, 12, 31))
    assert [p for p in L.ledger_periods(m) if len(p) == 7] == ["2021-01", "2021-02"]
    assert L.stated_through(m) == D(2021, 4, 8)
    assert _from_states(spark, root) == _full(spark, _upto(rows, D(2021, 4, 8)))
    # a month stated anew from its first day on takes the place of its days
    m = L.restate_ledger_days(t, root, D(2021, 3, 1), None, days_from=D(2021, 4, 1))
    assert [p for p in L.ledger_periods(m) if p < "2021-04"] == ["2021-01", "2021-02", "2021-03"]
    assert all(len(p) == 10 for p in L.ledger_periods(m) if p >= "2021-04")
    assert _from_states(spark, root) == _full(spark, rows)
    assert M.read_published(spark, root).agg(F.sum("card_rows")).first()[0] == sum(
        (r[4] or "").lower() == "card_payment" for r in rows)


def test_the_queries_write_no_directory_for_every_day_of_the_ledger(spark, monkeypatch):
    rows = [(i, f"{BALANCE_PREFIX}{i % 5:04d}", "USD", -100 - i, "CARD_PAYMENT", "SETTLED",
             dt.datetime(1996, 1, 1, 12) + dt.timedelta(days=i)) for i in range(1500)]
    found = []
    read = L.with_ledger_states
    monkeypatch.setattr(L, "with_ledger_states", lambda t, root: found.append(root) or read(t, root))
    t = _tables(spark, rows)
    p = Params.for_driver_data()
    assert _got(L.transaction_rollup_from_states(t, p)) == _got(disputes.transaction_rollup(t, p))
    kept = [M.load(spark, found[0], n) for n in M._numbers(spark, found[0])]
    assert len(kept) == 4  # built, compacted, caught up with a day, and with the rest
    written = {d for m in kept for d in m.parts.values()}
    assert len(written) < 350
    assert any(len(x) == 10 for x in L.ledger_periods(kept[0]))  # there are days to compact
    t.drop_stages()
