"""Publishing results.

``publish`` replaces a published dataset without a window in which it is
missing: the new result is written as a new versioned table, then the
published name (a view) is switched to it in one catalog operation, and only
then are older versions dropped.  Readers see the old or the new version,
never an empty or half-written one.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_VERSION = "__v"


def _versions(spark, name: str) -> list[str]:
    db, _, base = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES IN {db}" if db else "SHOW TABLES").collect()
    pat = re.compile(rf"^{re.escape(base)}{_VERSION}(\d+)$")
    found = [(int(m.group(1)), r.tableName) for r in rows
             if not r.isTemporary and (m := pat.match(r.tableName))]
    return [f"{db}.{t}" if db else t for _, t in sorted(found)]


def _is_table(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType not in ("VIEW", "TEMPORARY")


def publish(df: DataFrame, name: str, keep: int = 1, replace_table: bool = False) -> DataFrame:
    """Write ``df`` as a new version of ``name`` and point ``name`` at it.

    ``keep`` older versions stay available for readers still on them.  If a
    table (not a view) has the name, the call fails before anything is
    written; with ``replace_table`` the new version is complete first, then
    the table is set aside under ``<name>__old<time>`` and the view takes its
    name (catalog operations only; the table comes back if the second fails).
    A version whose publication fails is dropped.  Returns the published view.
    """
    spark = df.sparkSession
    in_the_way = _is_table(spark, name)
    if in_the_way and not replace_table:
        raise ValueError(f"{name} is a table; publish(replace_table=True) sets it aside for a view")
    stamp = time.time_ns()
    version, aside = f"{name}{_VERSION}{stamp}", f"{name}__old{stamp}"
    try:
        df.write.mode("errorifexists").saveAsTable(version)
        if in_the_way:
            spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
        except Exception:
            if in_the_way:
                spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    old = [v for v in _versions(spark, name) if v != version]
    for v in old[: max(0, len(old) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {v}")
    return spark.table(name)


def _filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a parquet location (optionally partitioned, so that date
    filters on readers prune directories).  The new result is written beside
    the old one and renamed into its place when complete; a failed write
    leaves the old result as it was."""
    spark, path = df.sparkSession, path.rstrip("/")
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.parquet(new)
    except Exception:
        delete_path(spark, new)
        raise
    fs, target = _filesystem(spark, path)
    _, new_path = _filesystem(spark, new)
    _, old_path = _filesystem(spark, old)
    had = fs.exists(target)
    if had and not fs.rename(target, old_path):
        delete_path(spark, new)
        raise OSError(f"{path} could not be set aside")
    if not fs.rename(new_path, target):
        if had:
            fs.rename(old_path, target)
        delete_path(spark, new)
        raise OSError(f"{new} could not be renamed to {path}")
    if had:
        fs.delete(old_path, True)
