"""Publishing: the published name always resolves to a complete version."""

import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from riskspark.sinks import publish, write_parquet


def _failing(spark):
    return spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("x"))


def _tables(spark, prefix):
    return sorted(r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith(prefix))


def test_publish_switches_view_and_drops_old_versions(spark):
    name = "rs_test_published"
    v1 = publish(spark.range(3).toDF("x"), name)
    assert sorted(r.x for r in v1.collect()) == [0, 1, 2]
    publish(spark.range(5).toDF("x"), name, keep=0)
    assert spark.table(name).count() == 5
    versions = [r.tableName for r in spark.sql("SHOW TABLES").collect()
                if r.tableName.startswith(f"{name}__v")]
    assert len(versions) == 1
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {versions[0]}")


def test_publish_payment_risk_mart(spark):
    import __spark_entry__ as E
    from riskspark.plans.mart import publish_payment_risk_mart
    from riskspark.sources.driver_adapter import driver_tables
    t = driver_tables(spark, "/root/testdata/sf0.001", fresh=True)
    view = publish_payment_risk_mart(t, E.PARAMS, "rs_test_mart")
    assert view.count() == E.queries()["payment_risk_mart"](spark, "/root/testdata/sf0.001").count()
    for r in spark.sql("SHOW TABLES").collect():
        if r.tableName.startswith("rs_test_mart__v"):
            spark.sql(f"DROP TABLE {r.tableName}")
    spark.sql("DROP VIEW IF EXISTS rs_test_mart")


def test_publish_over_a_table_fails_before_writing(spark):
    name = "rs_test_over_table"
    spark.range(2).toDF("x").write.saveAsTable(name)
    with pytest.raises(ValueError):
        publish(spark.range(3).toDF("x"), name)
    assert _tables(spark, name) == [name] and spark.table(name).count() == 2
    publish(spark.range(3).toDF("x"), name, replace_table=True)
    assert spark.table(name).count() == 3 and spark.catalog.getTable(name).tableType == "VIEW"
    aside = [t for t in _tables(spark, name) if "__old" in t]
    assert spark.table(aside[0]).count() == 2
    publish(spark.range(4).toDF("x"), name, keep=0)
    assert spark.table(name).count() == 4
    assert len([t for t in _tables(spark, name) if "__v" in t]) == 1
    spark.sql(f"DROP VIEW {name}")
    for t in _tables(spark, name):
        spark.sql(f"DROP TABLE {t}")


def test_failed_publish_leaves_the_old_result_and_no_orphan(spark):
    name = "rs_test_failing"
    publish(spark.range(3).toDF("x"), name)
    before = _tables(spark, name)
    with pytest.raises(Exception):
        publish(_failing(spark), name)
    assert spark.table(name).count() == 3 and _tables(spark, name) == before
    spark.sql(f"DROP VIEW {name}")
    for t in _tables(spark, f"{name}__v"):
        spark.sql(f"DROP TABLE {t}")


def test_write_parquet_replaces_whole_or_not_at_all(spark):
    root = tempfile.mkdtemp(prefix="rs-write-", dir="/tmp")
    path = f"{root}/report"
    write_parquet(spark.range(3).toDF("x"), path)
    write_parquet(spark.range(5).toDF("x"), path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        write_parquet(_failing(spark), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in pathlib.Path(root).iterdir()] == ["report"]
