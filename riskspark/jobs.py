"""Batch jobs: compute a book of reports and persist every report.

``python -m riskspark.jobs --book dormancy --database reports`` runs one
source worksheet end to end, as of today, over the metastore tables named
like the logical tables.  ``--as-of`` sets another day, ``--params`` names a
JSON file of ``Params`` fields (dates as ISO text), ``--tables`` a JSON file
that maps logical to physical table names, and ``--driver-data <dir>`` reads
the synthetic test tables instead.  Reports are published with
``sinks.publish`` (new version, then a view switch), written as parquet
under ``--output`` and/or added as a version under ``--published``
(``manifest``); with several, the files are written from the published table.
With ``--ledger-states`` the disputes book reads the card ledger's kept states
(``plans.ledger_states``): each run first adds the ledger days up to the one
before ``--as-of`` that are not stated yet, and merges the months that are over.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from .manifest import publish_files, read_published
from .params import Params
from .plans.books import BOOKS
from .plans.ledger_states import catch_up_ledger_states, compact_ledger_states, with_ledger_states
from .session import apply_cluster_defaults, ensure_checkpoint_dir
from .sinks import publish, write_parquet
from .sources.catalog import LOGICAL_TABLES, Tables


def run_book(t: Tables, p: Params, book: str, database: str | None = None,
             base_path: str | None = None, stage_root: str | None = None,
             published_path: str | None = None) -> dict[str, DataFrame]:
    """Compute ``book`` and persist each report as ``<database>.<report>``
    (published view), ``<base_path>/<report>`` (parquet) and/or the next
    version under ``<published_path>/<report>`` (``manifest.publish_files``).
    The shared intermediates are dropped at the end; the returned frames read
    what was persisted."""
    if not (database or base_path or published_path):
        raise ValueError("name a database or an output path")
    out = {}
    try:
        for name, df in BOOKS[book](t, p, stage_root).items():
            if database:
                df = publish(df, f"{database}.{name}")
            if base_path:
                path = f"{base_path.rstrip('/')}/{name}"
                write_parquet(df, path)
                df = df if database else t.spark.read.parquet(path)
            if published_path:
                root = f"{published_path.rstrip('/')}/{name}"
                version = publish_files(df, root)
                df = df if database or base_path else read_published(t.spark, root, version)
            out[name] = df
    finally:
        t.drop_stages()
    return out


def job_params(as_of: dt.date, overrides: dict | None = None, base: Params | None = None) -> Params:
    """``base`` (the production defaults) as of a day, with fields replaced.
    Movements are counted up to that day unless ``movement_cutoff`` is given."""
    base = base or Params()
    fields = {f.name: getattr(base, f.name) for f in dataclasses.fields(base)}
    changed = {"as_of": as_of, "movement_cutoff": as_of}
    for name, value in (overrides or {}).items():
        if name not in fields:
            raise ValueError(f"{name} is not a parameter")
        if isinstance(fields[name], dt.date):
            value = dt.date.fromisoformat(value)
        elif isinstance(fields[name], tuple):
            value = tuple(value)
        changed[name] = value
    return dataclasses.replace(base, **changed)


def main(argv: list[str] | None = None) -> dict[str, DataFrame]:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--book", choices=sorted(BOOKS), required=True)
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="day of the analysis (default: today)")
    ap.add_argument("--params", help="JSON file of parameter values")
    ap.add_argument("--tables", help="JSON file: logical table -> physical table")
    ap.add_argument("--driver-data", help="directory of the driver's parquet tables")
    ap.add_argument("--database", help="publish each report as <database>.<report>")
    ap.add_argument("--output", help="write each report as parquet under this path")
    ap.add_argument("--published", help="add a version of each report under this path, which readers see whole")
    ap.add_argument("--stage", help="shared folder for intermediates (default: spark.checkpoint.dir)")
    ap.add_argument("--ledger-states", help="keep states of the card ledger under this path (disputes book)")
    args = ap.parse_args(argv)
    if args.ledger_states and args.book != "disputes":
        ap.error("only the disputes book reads the ledger's states")
    spark = SparkSession.builder.getOrCreate()
    applied = apply_cluster_defaults(spark)
    try:
        return _run(spark, args)
    finally:  # the session may be someone else's too
        for key in applied:
            spark.conf.unset(key)


def _run(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    ensure_checkpoint_dir(spark)
    overrides = json.load(open(args.params)) if args.params else {}
    if args.driver_data:
        from .sources.driver_adapter import driver_tables
        t, base = driver_tables(spark, args.driver_data, fresh=True), Params.for_driver_data()
        p = job_params(args.as_of or base.as_of, overrides, base)
    else:
        names = {n: n for n in LOGICAL_TABLES} | (json.load(open(args.tables)) if args.tables else {})
        t = Tables.from_names(spark, names)
        p = job_params(args.as_of or dt.date.today(), overrides)
    if args.database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {args.database}")
    if args.ledger_states:
        catch_up_ledger_states(t, args.ledger_states, p.as_of - dt.timedelta(days=1))
        compact_ledger_states(spark, args.ledger_states, p.as_of)
        t = with_ledger_states(t, args.ledger_states)
    return run_book(t, p, args.book, args.database, args.output, args.stage, args.published)


if __name__ == "__main__":
    main()
