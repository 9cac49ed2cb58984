"""Seeded random tables with the driver's schemas, with NULLs injected into
keys, dates and statuses (which the driver's own tables never contain), for
differential tests of the Spark plans against the DuckDB oracle."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq


def _nullify(values: list, rng: np.random.Generator, rate: float) -> list:
    mask = rng.random(len(values)) < rate
    return [None if m else v for v, m in zip(values, mask)]


def _days(rng, n, start: dt.date, span_days: int) -> list:
    base = dt.datetime(start.year, start.month, start.day)
    return [base + dt.timedelta(days=int(d)) for d in rng.integers(0, span_days, n)]


def write_random_tables(path: str, seed: int, n_customers: int = 240, null_rate: float = 0.03,
                        duplicate_customers: float = 0.0, duplicate_orders: float = 0.0) -> None:
    """``duplicate_customers`` / ``duplicate_orders`` repeat that share of
    customer / order rows verbatim (keys listed twice)."""
    rng = np.random.default_rng(seed)
    nc = n_customers
    no, nl, ne = nc * 10, nc * 40, nc * 8
    cust = list(range(1, nc + 1))
    customer = pa.table({
        "c_custkey": pa.array(_nullify(cust, rng, null_rate / 3), pa.int64()),
        "c_name": [f"Customer#{k:09d}" for k in cust],
        "c_nationkey": pa.array(_nullify([int(x) for x in rng.integers(0, 25, nc)], rng, null_rate), pa.int32()),
        "c_acctbal": pa.array(_nullify([float(round(x, 2)) for x in rng.uniform(-999, 9999, nc)], rng,
                                       null_rate), pa.float64()),
        "c_mktsegment": _nullify([str(x) for x in rng.choice(["BUILDING", "MACHINERY", "HOUSEHOLD"], nc)],
                                 rng, null_rate),
    })
    if duplicate_customers:
        dup = [i for i in range(nc) if rng.random() < duplicate_customers]
        customer = pa.concat_tables([customer, customer.take(dup)])
    okeys = list(range(1, no + 1))
    orders = pa.table({
        "o_orderkey": pa.array(_nullify(okeys, rng, null_rate / 3), pa.int64()),
        "o_custkey": pa.array(_nullify([int(x) for x in rng.integers(1, nc + 1, no)], rng, null_rate),
                              pa.int64()),
        "o_orderstatus": _nullify([str(x) for x in rng.choice(["F", "O", "P"], no)], rng, null_rate),
        "o_totalprice": pa.array(_nullify([float(round(x, 2)) for x in rng.uniform(900, 400000, no)], rng,
                                          null_rate), pa.float64()),
        "o_orderdate": pa.array(_nullify(_days(rng, no, dt.date(1995, 1, 1), 2400), rng, null_rate),
                                pa.timestamp("us")),
        "o_orderpriority": _nullify([str(x) for x in rng.choice(
            ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], no)], rng, null_rate),
    })
    if duplicate_orders:
        dup = [i for i in range(no) if rng.random() < duplicate_orders]
        orders = pa.concat_tables([orders, orders.take(dup)])
    lok = [int(x) for x in rng.integers(1, no + 1, nl)]
    lineitem = pa.table({
        "l_orderkey": pa.array(_nullify(lok, rng, null_rate / 3), pa.int64()),
        "l_partkey": pa.array(_nullify([int(x) for x in rng.integers(1, 2000, nl)], rng, null_rate),
                              pa.int64()),
        "l_suppkey": pa.array(_nullify([int(x) for x in rng.integers(1, 100, nl)], rng, null_rate),
                              pa.int64()),
        "l_linenumber": pa.array(_nullify([int(x) for x in rng.integers(1, 8, nl)], rng, null_rate),
                                 pa.int32()),
        "l_quantity": pa.array(_nullify([float(x) for x in rng.integers(1, 51, nl)], rng, null_rate),
                               pa.float64()),
        "l_extendedprice": pa.array(_nullify([float(round(x, 2)) for x in rng.uniform(900, 100000, nl)],
                                             rng, null_rate), pa.float64()),
        "l_discount": pa.array(_nullify([float(x) / 100 for x in rng.integers(0, 11, nl)], rng, null_rate),
                               pa.float64()),
        "l_tax": pa.array(_nullify([float(x) / 100 for x in rng.integers(0, 9, nl)], rng, null_rate),
                          pa.float64()),
        "l_returnflag": _nullify([str(x) for x in rng.choice(["A", "N", "R"], nl)], rng, null_rate),
        "l_linestatus": _nullify([str(x) for x in rng.choice(["F", "O"], nl)], rng, null_rate),
        "l_shipdate": pa.array(_nullify(_days(rng, nl, dt.date(1995, 1, 2), 2500), rng, null_rate),
                               pa.timestamp("us")),
    })
    base = dt.datetime(2024, 1, 1)
    ets = [base + dt.timedelta(seconds=int(s), microseconds=int(u))
           for s, u in zip(rng.integers(0, 30 * 86400, ne), rng.integers(0, 10**6, ne))]
    users = max(30, nc // 10)
    events = pa.table({
        "event_id": pa.array(_nullify(list(range(ne)), rng, null_rate / 3), pa.int64()),
        "ts": pa.array(_nullify(ets, rng, null_rate), pa.timestamp("us")),
        "user_id": pa.array(_nullify([int(x) for x in rng.integers(0, users, ne)], rng, null_rate),
                            pa.int64()),
        "event_type": _nullify([str(x) for x in rng.choice(["signup", "click", "error", "purchase", "view"], ne)],
                               rng, null_rate),
        "value": pa.array([float(round(x, 2)) for x in rng.uniform(0, 50, ne)], pa.float64()),
        "props": ["{}"] * ne,
    })
    for name, tbl in (("customer", customer), ("orders", orders), ("lineitem", lineitem),
                      ("events", events)):
        pq.write_table(tbl, f"{path}/{name}.parquet")
    # tables the analyses do not read, present for the view registration
    for name, tbl in (("region", pa.table({"r_regionkey": pa.array([0], pa.int32())})),
                      ("nation", pa.table({"n_nationkey": pa.array([0], pa.int32())})),
                      ("supplier", pa.table({"s_suppkey": pa.array([0], pa.int64())})),
                      ("part", pa.table({"p_partkey": pa.array([0], pa.int64())}))):
        pq.write_table(tbl, f"{path}/{name}.parquet")
