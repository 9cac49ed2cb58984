"""Published paths: readers always see one whole version."""

import tempfile
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskspark import manifest as M
from riskspark.plans.mart import payment_risk_mart, refresh_payment_risk_mart
from riskspark.sources.driver_adapter import driver_tables

from .conftest import SF_SMALL


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="rs-manifest-", dir="/tmp") + "/t"


def _version(spark, v, n=200):
    return spark.range(n).select("id", F.lit(v).alias("v"), (F.col("id") % 4).cast("int").alias("k"))


def test_readers_during_publication_see_whole_versions(spark, root):
    M.publish_files(_version(spark, 0), root)
    seen, errors, stop = [], [], threading.Event()

    def read():
        try:
            while not stop.is_set():
                rows = M.read_published(spark, root).groupBy("v").count().collect()
                seen.append([tuple(r) for r in rows])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 8):
        M.publish_files(_version(spark, v, 200 + v), root)
    stop.set()
    reader.join()
    assert not errors and len(seen) > 1
    assert all(len(rows) == 1 and rows[0][1] == 200 + rows[0][0] for rows in seen)
    assert [r[0][0] for r in seen] == sorted(r[0][0] for r in seen)


def test_a_writer_that_dies_changes_nothing(spark, root):
    M.publish_files(_version(spark, 1), root)

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):  # the data is there, the manifest isn't
        M.publish_files(_version(spark, 2), root, before_commit=die)
    assert {r.v for r in M.read_published(spark, root).select("v").distinct().collect()} == {1}
    whole = M.Manifest(2, "{}", None, {}, {}).to_bytes()
    with open(M._file(root, 2), "wb") as f:  # dies within the manifest
        f.write(whole[:-3])
    assert {r.v for r in M.read_published(spark, root).select("v").distinct().collect()} == {1}
    assert M.publish_files(_version(spark, 3), root).number == 3  # the torn number is passed over
    assert {r.v for r in M.read_published(spark, root).select("v").distinct().collect()} == {3}
    with pytest.raises(Exception):  # a failing write publishes nothing
        M.publish_files(spark.range(5).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), root)
    assert M.latest(spark, root).number == 3


def test_two_writers_can_not_publish_one_number(spark, root):
    M.publish_files(_version(spark, 1), root)
    with pytest.raises(M.PublishedElsewhere):
        M.publish_files(_version(spark, 2), root, before_commit=lambda: M.publish_files(_version(spark, 3), root))
    assert {r.v for r in M.read_published(spark, root).select("v").distinct().collect()} == {3}


def test_partitions_are_replaced_and_kept(spark, root):
    first = M.publish_files(_version(spark, 1), root, "k")
    new = _version(spark, 2).where("k = 1 and id < 50")
    second = M.replace_partitions(new, root, first, ["k=1", "k=3"])
    got = {(r.k, r.v): r["count"] for r in M.read_published(spark, root).groupBy("k", "v").count().collect()}
    assert got == {(0, 1): 50, (2, 1): 50, (1, 2): 13}
    assert second.parts["k=0"] == first.parts["k=0"] and "k=3" not in second.parts
    assert M.read_published(spark, root, first).count() == 200  # the version before is still whole
    plan = M.read_published(spark, root).where("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan
    with pytest.raises(ValueError):
        M.replace_partitions(_version(spark, 3), root, second, ["k=1"])
    M.vacuum(spark, root, keep=0)
    assert M.read_published(spark, root).count() == 113
    with pytest.raises(Exception):
        M.read_published(spark, root, first).count()


def test_empty_and_missing(spark, root):
    with pytest.raises(FileNotFoundError):
        M.read_published(spark, root)
    M.publish_files(_version(spark, 1).where("false"), root, "k")
    assert M.read_published(spark, root).collect() == []
    with pytest.raises(ValueError):
        M.publish_files(spark.range(1).withColumnRenamed("id", "publication"), root)


def _same(one, two):
    assert one.columns == two.columns
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_late_chargebacks_rewrite_only_their_days(spark, root):
    p, t = E.PARAMS, driver_tables(spark, SF_SMALL, fresh=True)
    first = refresh_payment_risk_mart(t, p, root)
    full = payment_risk_mart(t, p)
    _same(M.read_published(spark, root).drop("payment_day"), full)
    assert refresh_payment_risk_mart(t, p, root) == first  # nothing changed, nothing written
    late = full.where("chargeback = 0").orderBy("payment_token").limit(3).select("payment_token")
    tokens = [r.payment_token for r in late.collect()]
    extra = t["chargeback"].limit(1).drop("payment_token").crossJoin(spark.createDataFrame([(x,) for x in tokens], "payment_token long"))
    changed = t.with_tables(chargeback=t["chargeback"].unionByName(extra.select(t["chargeback"].columns)))
    second = refresh_payment_risk_mart(changed, p, root)
    days = {f"payment_day={r.d}" for r in full.where(F.col("payment_token").isin(tokens)).select(
        F.to_date("payment_trx_recognized_at").alias("d")).collect()}
    assert {k for k in second.parts if second.parts[k] != first.parts.get(k)} == days
    assert {k for k in first.parts if first.parts[k] == second.parts[k]} == set(first.parts) - days
    _same(M.read_published(spark, root).drop("payment_day"), payment_risk_mart(changed, p))
    gone = changed.with_tables(payment=changed["payment"].where(~F.col("payment_token").isin(tokens)))
    refresh_payment_risk_mart(gone, p, root)  # payments that vanish
    _same(M.read_published(spark, root).drop("payment_day"), payment_risk_mart(gone, p))
