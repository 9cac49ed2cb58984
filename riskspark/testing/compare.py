"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass

import duckdb
import pyarrow as pa

from ..sources.driver_adapter import DRIVER_TABLES

EXTRA_DRIVER_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck_connection(sf_dir: str, tables=None) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in tables or (DRIVER_TABLES + EXTRA_DRIVER_TABLES):
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v, exact: bool = False):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return None
        return f if exact else round(f, 6)
    return v


def _rows(tbl: pa.Table, exact: bool = False) -> list[tuple]:
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    out = [tuple(_norm(v, exact) for v in rec) for rec in zip(*data)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@dataclass
class Comparison:
    name: str
    spark_rows: int
    oracle_rows: int
    same_columns: bool
    same_values: bool
    detail: str = ""
    same_types: bool = True

    @property
    def ok(self) -> bool:
        return (self.same_columns and self.same_types and self.same_values
                and self.spark_rows == self.oracle_rows)


def compare(name: str, spark_df, con: duckdb.DuckDBPyConnection, sql: str,
            exact: bool = True) -> Comparison:
    """Row count, column names, Arrow column types and order-insensitive
    values.  ``exact`` compares floating-point values bit for bit."""
    s = spark_df.toArrow()
    o = con.sql(sql).to_arrow_table()
    if not isinstance(o, pa.Table):
        o = o.read_all()
    same_cols = sorted(s.column_names) == sorted(o.column_names)
    detail = ""
    if not same_cols:
        detail = f"spark cols {sorted(s.column_names)} vs oracle {sorted(o.column_names)}"
        return Comparison(name, s.num_rows, o.num_rows, False, False, detail)
    rs, ro = _rows(s, exact), _rows(o, exact)
    same = rs == ro
    if not same:
        ss, so = set(rs), set(ro)
        detail = f"only spark: {list(ss - so)[:3]} only oracle: {list(so - ss)[:3]}"
    st = {f.name: str(f.type) for f in s.schema}
    ot = {f.name: str(f.type) for f in o.schema}
    diff = {k: (st[k], ot[k]) for k in st if st[k] != ot[k]}
    if diff:
        detail = (detail + " " if detail else "") + f"types differ: {diff}"
    return Comparison(name, s.num_rows, o.num_rows, True, same, detail, same_types=not diff)
