"""A book run publishes every report, as of the day it is asked for."""

import datetime as dt
import json
import tempfile

import pytest

import __spark_entry__ as E
from riskspark import session
from riskspark.jobs import job_params, main, run_book
from riskspark.manifest import latest, read_published
from riskspark.plans.ledger_states import ledger_periods, stated_through
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


def test_run_book_publishes_and_writes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS rs_jobs_test")
    out = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
    reports = run_book(driver_tables(spark, SF_SMALL, fresh=True), E.PARAMS, "disputes",
                       database="rs_jobs_test", base_path=out)
    for name, df in reports.items():
        want = E.queries()[name](spark, SF_SMALL).count()
        assert spark.table(f"rs_jobs_test.{name}").count() == want == df.count()
        assert spark.read.parquet(f"{out}/{name}").count() == want
    spark.sql("DROP DATABASE rs_jobs_test CASCADE")


def test_a_job_needs_somewhere_to_write(spark):
    with pytest.raises(ValueError):
        run_book(driver_tables(spark, SF_SMALL, fresh=True), E.PARAMS, "mart")


def test_job_at_two_dates_gives_different_dormancies(spark):
    found = {}
    for day in ("2001-01-01", "2002-01-01"):
        out = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
        reports = main(["--book", "dormancy", "--driver-data", SF_SMALL, "--output", out, "--as-of", day])
        found[day] = {r.user_token: r.dormancy_from_today for r in reports["payment_dormancy"].collect()}
    early, late = found.values()
    assert set(early) == set(late)
    assert {late[u] - early[u] for u in early if early[u] is not None} == {365}


def test_job_reads_mapped_tables_and_a_parameter_file(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS rs_mapped")
    t = driver_tables(spark, SF_SMALL)
    needed = ("dispute", "card_activity")
    for name in needed:
        t[name].write.mode("overwrite").saveAsTable(f"rs_mapped.{name}_v2")
    files = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
    p = E.PARAMS
    with open(f"{files}/tables.json", "w") as f:
        json.dump({n: f"rs_mapped.{n}_v2" for n in needed}, f)
    with open(f"{files}/params.json", "w") as f:
        json.dump({"kpi_year": p.kpi_year, "fraud_reason": p.fraud_reason,
                   "valid_final_resolutions": list(p.valid_final_resolutions),
                   "platform_credit_resolution": p.platform_credit_resolution,
                   "seller_liable_resolution": p.seller_liable_resolution,
                   "seller_liable_reasons": list(p.seller_liable_reasons),
                   "seller_dispute_delay_days": p.seller_dispute_delay_days}, f)
    reports = main(["--book", "disputes", "--tables", f"{files}/tables.json", "--params", f"{files}/params.json",
                    "--output", f"{files}/out", "--stage", f"{files}/stage"])
    for name, df in reports.items():
        want = E.queries()[name](spark, SF_SMALL)
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect())), name
    spark.sql("DROP DATABASE rs_mapped CASCADE")


def test_job_params():
    p = job_params(dt.date(2023, 5, 1), {"kpi_year": 2022, "mart_start": "2021-01-01", "valid_open_statuses": ["A"]})
    assert (p.as_of, p.movement_cutoff, p.kpi_year) == (dt.date(2023, 5, 1), dt.date(2023, 5, 1), 2022)
    assert p.mart_start == dt.date(2021, 1, 1) and p.valid_open_statuses == ("A",)
    with pytest.raises(ValueError):
        job_params(dt.date(2023, 5, 1), {"kpi_yaer": 2022})


def test_local_folders_are_refused_on_a_cluster(spark, monkeypatch):
    assert session.shared_path(spark, "file:///tmp/x/") == "file:///tmp/x"
    monkeypatch.setattr(session, "_is_local", lambda _: False)
    for path in ("file:///tmp/x", "/tmp/x"):
        with pytest.raises(RuntimeError):
            session.shared_path(spark, path)
    assert session.shared_path(spark, "hdfs://a/x") == "hdfs://a/x"


def test_a_job_adds_versions_of_its_reports(spark):
    out = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
    for n in (1, 2):
        reports = main(["--book", "mart", "--driver-data", SF_SMALL, "--published", out])
        for name, df in reports.items():
            assert latest(spark, f"{out}/{name}").number == n
            assert read_published(spark, f"{out}/{name}").count() == df.count() > 0


def test_a_job_leaves_the_session_as_it_was(spark):
    before = {k: spark.conf.get(k, None) for k in session.CLUSTER_DEFAULTS}
    out = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
    main(["--book", "mart", "--driver-data", SF_SMALL, "--output", out])
    assert {k: spark.conf.get(k, None) for k in session.CLUSTER_DEFAULTS} == before


def test_the_disputes_job_keeps_states_of_the_ledger(spark):
    base = tempfile.mkdtemp(prefix="rs-jobs-", dir="/tmp")
    args = ["--book", "disputes", "--driver-data", SF_SMALL, "--output", f"{base}/out", "--ledger-states", f"{base}/states"]
    main([*args, "--as-of", "1998-03-10"])
    first = latest(spark, f"{base}/states")
    assert stated_through(first) == dt.date(1998, 3, 9) and "1998-02" in ledger_periods(first)
    out = main([*args, "--as-of", "2002-01-01"])
    second = latest(spark, f"{base}/states")
    assert {k: second.parts[k] for k in first.parts if len(k.split("=")[1]) == 7} \
        == {k: v for k, v in first.parts.items() if len(k.split("=")[1]) == 7}
    for name, df in out.items():
        want = E.queries()[name](spark, SF_SMALL)
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect())), name
    with pytest.raises(SystemExit):
        main(["--book", "mart", "--output", base, "--ledger-states", base])
