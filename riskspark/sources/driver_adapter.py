"""Derive the library's logical tables from the driver's synthetic tables.

The production analyses read warehouse tables (users, ledgers, disputes,
evaluations, ...).  The test data is a TPC-H-like star schema plus an event
stream, so each logical table is re-expressed as a deterministic Spark
projection of those tables.  Attribute values (flags, states, reasons) are
assigned by fixed arithmetic rules on the source keys; every derivation reads
its whole source table.  The same rules, written in DuckDB SQL, live in
``riskspark/testing/oracle.py`` so both engines see identical inputs.
"""

from __future__ import annotations

import datetime as dt
import weakref

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefns import micros_to_ts, ts_to_micros
from .catalog import Tables

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events")

# Fixed values of the synthetic mapping.
BALANCE_PREFIX = "b-0123456789abc-c-"
TOKEN_WIDTH = 13
CALENDAR_END = dt.date(2002, 1, 1)  # as_of of Params.for_driver_data(); starts in the week of the first order
OPEN_END = dt.date(2100, 1, 1)
LOCK_DATE = dt.date(2000, 1, 1)
ONBOARD_BASE = dt.date(1996, 1, 1)
USER_BASE = dt.date(1993, 1, 1)
FROZEN_BASE = dt.date(2001, 1, 1)
OFFBOARD_BASE = dt.date(1998, 10, 1)
LARGE_SEGMENT_CENTS = 25_000_000


def _c(name: str):
    return F.col(name)


def _cents(x) -> F.Column:
    return F.round(x * 100).cast("bigint")


def _div3(x) -> F.Column:
    return F.floor(x / 3).cast("bigint")


def _text(*parts) -> F.Column:
    """String concatenation that skips NULL parts (the recipes' ``concat``)."""
    return F.concat_ws("", *parts)


def _pad_token(x) -> F.Column:
    return F.lpad(_text(x.cast("string")), TOKEN_WIDTH, "0")


def _shifted_events(t: Tables) -> DataFrame:
    """Events moved from their recording month back over 1995-2001 by a
    per-user, per-event number of days (``rec``)."""
    ev = t["events"]
    days = (F.lit(8400) + (_c("user_id") * 17 % 80) * 25 + (_c("event_id") % 7) * 15).cast("int")
    return ev.withColumn("rec", _c("ts") - F.make_dt_interval(days))


def _dim_user(t):
    c = t["customer"]
    k = _c("c_custkey")
    return c.select(
        k.alias("user_token"),
        _div3(k).alias("merchant_token"),
        F.when(k % 20 == 7, 0).otherwise(1).alias("is_unit"),
        F.when(k % 13 == 0, 1).when(k % 13 == 1, None).otherwise(0).alias("is_deleted"),
        F.when(_c("c_acctbal") < -500, 1).otherwise(0).alias("is_currently_frozen"),
        F.when(_c("c_nationkey") == 3, None).when(_c("c_nationkey") == 4, 1).otherwise(0)
        .alias("is_currently_deactivated"),
        _c("c_name").alias("business_name"),
        _c("c_mktsegment").alias("business_category"),
        F.date_add(F.lit(USER_BASE), (k % 700).cast("int")).alias("user_created_at_date"),
        F.when(_c("c_acctbal") < -500, F.date_add(F.lit(FROZEN_BASE), (k % 300).cast("int")))
        .alias("currently_frozen_at_date"),
        F.when(_c("c_nationkey") == 4, F.date_add(F.lit(FROZEN_BASE), (k % 200).cast("int")))
        .alias("currently_deactivated_at_date"),
    )


def _audit_log(t):
    e = t["_evt"].where(_c("event_type").isin("error", "view"))
    note = _text(F.lit("note IP 10.0."), _c("user_id").cast("string"), F.lit("."),
                 (_c("event_id") % 250).cast("string"), F.lit(" #SuspectLogin x"))
    return e.select(
        _c("user_id").alias("target_token"),
        _c("rec").alias("created_at"),
        F.when((_c("event_type") == "error") & (_c("event_id") % 3 != 0), note)
        .otherwise(F.lit("plain note")).alias("comment"),
        F.when(_c("event_id") % 11 == 0, "Watchlist").otherwise("Other").alias("action_name"),
    )


def _fp_login_list(t):
    return (t["events"].where(_c("user_id") % 10 == 3)
            .select(_c("user_id").alias("unit_token"),
                    _text(F.lit("10.0."), _c("user_id").cast("string"), F.lit(".0")).alias("ip"))
            .distinct())


def _ato_merchant(t):
    return (t["_evt"].where((_c("event_type") == "signup") & (_c("user_id") % 4 == 0))
            .groupBy(_c("user_id").alias("user_token"))
            .agg(F.min("rec").alias("earliest_confirmed_at")))


def _employee(t):
    m = F.floor(_c("l_partkey") / 4).cast("bigint")  # grows with the parts, and keeps rosters wide
    person = m * 100 + _c("l_orderkey") % (1 + m % 70)
    return (t["lineitem"]
            .select(m.alias("merchant_id"), person.alias("person_id"))
            .distinct()
            .select("merchant_id", "person_id",
                    (_c("person_id") % 3 != 0).alias("is_active"),
                    (_c("person_id") % 5 == 0).alias("is_authorized_user")))


def _credential(t):
    e = t["employee"]
    return e.select(
        _c("person_id").alias("person_token"),
        F.when((_c("merchant_id") % 8 == 0) | (_c("person_id") % 2 == 0), F.lit(LOCK_DATE))
        .alias("locked_at"))


def _daily_payment(t):
    o = t["orders"]
    return (o.groupBy(_c("o_custkey").alias("unit_token"),
                      _c("o_orderdate").cast("date").alias("payment_date"))
            .agg(F.count(F.when(_c("o_orderstatus") == "F", 1)).alias("card_payment_count"),
                 F.sum(_cents(_c("o_totalprice"))).alias("gpv_cents")))


def _lifetime_payment(t):
    o = t["orders"].where(_c("o_orderstatus").isin("F", "P"))
    d = _c("o_orderdate").cast("date")
    return (o.groupBy(_c("o_custkey").alias("user_token"))
            .agg(F.min(d).alias("first_card_payment_date"),
                 F.max(d).alias("latest_card_payment_date"),
                 F.sum(_cents(_c("o_totalprice"))).alias("lifetime_gpv_cents")))


def _fake_unit(t):
    return t["customer"].where(_c("c_custkey") % 17 == 0).select(_c("c_custkey").alias("unit_token"))


def _line_orders(t):
    return t["lineitem"].join(t["orders"].select("o_orderkey", "o_custkey", "o_orderdate"),
                              _c("l_orderkey") == _c("o_orderkey"))


def _card_activity(t):
    lo = t["_line_orders"]
    return lo.select(
        (_c("l_orderkey") * 2 + _c("l_linenumber") % 2).alias("transaction_token"),
        _text(F.lit(BALANCE_PREFIX), _pad_token(_c("o_custkey"))).alias("balance_token"),
        F.when(_c("l_suppkey") % 5 == 0, "CAD").otherwise("USD").alias("currency_code"),
        (-_cents(_c("l_extendedprice"))).alias("amount_cents"),
        F.when(_c("l_linenumber") % 7 == 4, "ATM_CHARGEBACK")
        .when(_c("l_linenumber") % 7 == 3, "UNKNOWN").otherwise("CARD_PAYMENT").alias("activity_type"),
        F.when(_c("l_linestatus") == "F", "SETTLED").otherwise("PENDING").alias("activity_state"),
        _c("l_shipdate").alias("created_at"),
    )


def _settlement_entry(t):
    e = t["_evt"].where(_c("event_type") == "purchase")
    return e.select(_c("user_id").alias("merchant_token"),
                    ts_to_micros("rec").alias("created_us"),
                    (_c("event_id") % 9 == 0).alias("is_verification"))


def _login_event(t):
    e = t["_evt"].where(_c("event_type") == "signup")
    return e.select(_div3(_c("user_id")).alias("merchant_token"),
                    _c("user_id").alias("person_token"),
                    _c("rec").alias("recorded_at"),
                    (_c("event_id") % 6 != 0).alias("success"))


def _page_click(t):
    e = t["_evt"].where(_c("event_type") == "click")
    return e.select(F.when(_c("event_id") % 50 == 0, F.lit(None).cast("bigint"))
                    .otherwise(_div3(_c("user_id"))).alias("merchant_token"),
                    _c("user_id").alias("person_token"),
                    _c("rec").alias("recorded_at"))


def _mobile_click(t):
    e = t["_evt"].where(_c("event_type") == "view")
    return e.select(_div3(_c("user_id")).alias("merchant_token"),
                    _c("user_id").alias("person_token"),
                    _c("rec").alias("recorded_at"))


def _legacy_activity(t):
    e = t["_evt"].where(_c("event_type") == "error")
    return e.select((_div3(_c("user_id")) + 20).alias("merchant_token"),
                    _c("rec").alias("last_activity_at"))


def _chargeback(t):
    lo = t["_line_orders"].where((_c("l_returnflag") == "A") & (_c("l_linenumber") == 1))
    return lo.select(
        _c("l_orderkey").alias("payment_token"),
        _c("o_custkey").alias("user_token"),
        _c("o_orderdate").alias("payment_created_at"),
        _c("l_shipdate").cast("date").alias("chargeback_date"),
        F.when(_c("l_suppkey") % 5 == 0, "CAD").otherwise("USD").alias("currency_code"),
        _cents(_c("l_extendedprice")).alias("chargeback_cents"),
        _cents(_c("l_extendedprice") * _c("l_discount")).alias("loss_cents"),
        F.when(_c("l_suppkey") % 2 == 0, "fraud").otherwise("other").alias("type"),
        F.when(_c("l_linestatus") == "F", "closed").otherwise("open").alias("status"),
    )


def _fx_rate(t):
    li = t["lineitem"]
    d = _c("l_shipdate").cast("date").alias("report_date")
    usd = li.select(d).distinct().select(
        "report_date", F.lit("USD").alias("base"), F.lit("USD").alias("counter"),
        F.lit(1.0).alias("rate"), F.lit(1.0).alias("multiplier"))
    cad = li.where(F.dayofmonth("l_shipdate") % 11 != 0).select(d).distinct().select(
        "report_date", F.lit("CAD").alias("base"), F.lit("USD").alias("counter"),
        F.lit(0.75).alias("rate"), F.lit(1.0).alias("multiplier"))
    return usd.unionByName(cad)


def _dispute(t):
    lo = t["_line_orders"].where((_c("l_returnflag") == "R") & (_c("l_quantity") > 25))
    pk = _c("l_partkey")
    ship = _c("l_shipdate").cast("date")
    return lo.select(
        (_c("l_orderkey") * 2 + _c("l_linenumber") % 2).alias("transaction_token"),
        _pad_token(_c("o_custkey")).alias("unit_token"),
        _c("l_shipdate").alias("transaction_date"),
        F.when(_c("l_suppkey") % 4 == 0, "OTHER").otherwise("FRAUD").alias("reason_code"),
        F.when(pk % 6 == 0, "APPROVED").when(pk % 6 == 1, "DENIED").when(pk % 6 == 2, "CREDITED")
        .when(pk % 6 == 3, "SELLER_LIABLE").when(pk % 6 == 4, "VOIDED").alias("final_resolution"),
        F.when(pk % 4 == 0, "LOST").when(pk % 4 == 1, "NEW").otherwise("FILED").alias("status"),
        F.when(_c("l_tax") >= 0.04, ship).alias("provisional_credit_debited_date"),
        F.when(pk % 9 == 3, "CHIP").otherwise("NONE").alias("resolution_reason"),
        F.date_add(ship, (_c("l_quantity") * 4).cast("int")).alias("seller_disputed_date"),
        F.round(_c("l_extendedprice") * 50).cast("bigint").alias("dispute_cents"),
    )


def _risk_evaluation(t):
    o = t["orders"]
    level = (F.when(_c("o_orderpriority") == "1-URGENT", "HIGH")
             .when(_c("o_orderpriority") == "2-HIGH", "MODERATE").otherwise("NORMAL"))
    cols = [_c("o_orderkey").alias("payment_token"), _c("o_custkey").alias("unit_token"),
            _c("o_orderkey").alias("bill_token")]
    first = o.select(*cols, level.alias("risk_level"), _c("o_orderdate").alias("created_at"))
    again = o.where(_c("o_orderkey") % 10 == 0).select(
        *cols, F.lit("NORMAL").alias("risk_level"), _c("o_orderdate").alias("created_at"))
    return first.unionByName(again)


def _payment(t):
    o = t["orders"]
    k = _c("o_orderkey")
    return o.select(
        k.alias("payment_token"), _c("o_custkey").alias("unit_token"),
        _c("o_orderdate").alias("recognized_at"),
        _cents(_c("o_totalprice")).alias("amount_base_unit"),
        F.lit("USD").alias("currency_code"),
        F.when(k % 23 == 0, 1).otherwise(0).alias("is_voided"),
        F.when(k % 19 == 0, 1).otherwise(0).alias("is_refunded"),
        F.when(k % 29 == 0, 0).otherwise(1).alias("is_card_payment"),
        F.when(k % 31 == 0, 0).otherwise(1).alias("is_gpv"),
        F.when(k % 37 == 0, 0).otherwise(1).alias("has_successful_capture"),
        (k % 43 != 0).alias("auth_success"),
        F.when(k % 3 == 0, "EXTERNAL_API").when(k % 3 == 1, "EXTERNAL_API_ON_FILE")
        .otherwise("SWIPED").alias("entry_method"),
        (_c("o_orderdate") - F.make_dt_interval(F.lit(0), (k % 50).cast("int"))).alias("auth_intent_created_at"),
        (_cents(_c("o_totalprice")) + k % 5 * 100).alias("auth_intent_amount"),
        F.when(k % 4 == 0, "CA").otherwise("US").alias("country_code"),
        F.when(k % 17 != 0, _text(F.lit("pan-"), (_c("o_custkey") * 7 + k % 3).cast("string"))).alias("pan_token"),
        _text(F.lit("****"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("pan_masked"),
        F.when(k % 6 == 0, k % 900).alias("tip_amount_base_unit"),
        F.when(k % 13 == 0, "insufficient_funds").when(k % 13 == 1, "do_not_honor").alias("decline_reasons"),
        F.when(k % 9 == 0, "MX").when(k % 9 == 1, None).otherwise("US").alias("bin_country"),
        F.when(k % 8 == 0, "PREPAID").otherwise("NOT_PREPAID").alias("bin_prepaid_status"),
        F.when(k % 3 == 0, "VISA").when(k % 3 == 1, "MASTERCARD").otherwise("AMEX").alias("card_brand"),
        F.when(k % 7 == 0, "AVS_REJECTED").when(k % 7 == 1, None).otherwise("AVS_ACCEPTED").alias("auth_avs_status"),
        F.when(k % 12 == 0, "CVV_REJECTED").otherwise("CVV_ACCEPTED").alias("auth_cvv_status"),
    )


def _enrolled_merchant(t):
    m = _c("merchant_token")
    q = F.floor(m / 4).cast("bigint") % 4
    base = t["dim_user"].select("merchant_token").distinct().where(m % 4 == 0)
    return base.select(
        m,
        F.date_add(F.lit(ONBOARD_BASE), (m * 5 % 1000).cast("int")).alias("onboard_date"),
        F.when(q >= 2, F.date_add(F.lit(OFFBOARD_BASE), (m % 400).cast("int"))).alias("offboard_date"),
        F.when(q == 0, "in_trial").when(q == 1, "subscribed").when(q == 2, "trial_cancelled")
        .otherwise("churned").alias("state"),
    )


def _allowed_payment(t):
    return t["orders"].where(_c("o_orderkey") % 41 == 0).select(_c("o_orderkey").alias("payment_token"))


def _risk_alert(t):
    return t["orders"].where(_c("o_orderkey") % 7 == 0).select(_c("o_orderkey").alias("payment_token"))


def _merchant_signup(t):
    o = t["orders"]
    tok = _div3(_c("o_custkey"))
    return o.select(tok.alias("token"),
                    F.when(_c("o_custkey") % 2 == 0, _c("o_orderdate")).alias("online_signup_at"),
                    F.when(tok % 3 != 0, _c("o_orderdate")).alias("initially_enrolled_at"))


def _dim_date(t):
    first = t["orders"].agg(F.date_trunc("week", F.min("o_orderdate")).cast("date").alias("first"))
    days = first.select(F.explode(F.sequence("first", F.lit(CALENDAR_END))).alias("report_date"))
    wb = F.date_trunc("week", _c("report_date")).cast("date")
    return days.select("report_date", wb.alias("week_begin"), F.date_add(wb, 6).alias("week_end"))


def _user_segment(t):
    w = Window.partitionBy("unit_token").orderBy(F.col("payment_date").asc_nulls_last())
    s = t["daily_payment"].select(
        _c("unit_token").alias("user_token"),
        F.when(_c("gpv_cents") > LARGE_SEGMENT_CENTS, "Large").otherwise("Small").alias("segment"),
        _c("payment_date").alias("effective_begin"),
        F.lead("payment_date").over(w).alias("nxt"),
        F.row_number().over(w).alias("rn"))
    return s.where(_c("rn") % 5 != 0).select(
        "user_token", "segment", "effective_begin",
        F.coalesce(F.date_sub("nxt", 1), F.lit(OPEN_END)).alias("effective_end"))


def _page_view(t):
    e = t["_evt"].where(_c("event_type") == "view")
    eid = _c("event_id")
    return e.select(
        F.when(eid % 40 == 0, "/home")
        .otherwise(_text(F.lit("/dashboard/sales/transactions/"), eid.cast("string")))
        .alias("webpage_path"),
        _div3(_c("user_id")).alias("merchant_token"),
        F.when(eid % 5 == 0, "pos").otherwise("dashboard").alias("app_name"),
        F.lit("page_view").alias("catalog_name"),
        F.when(eid % 3 == 0, "transactions: show list").otherwise("Home").alias("description"),
        _c("rec").alias("recorded_at"),
    )


_BUILDERS = {
    "_evt": _shifted_events,
    "_line_orders": _line_orders,
    "dim_user": _dim_user,
    "audit_log": _audit_log,
    "fp_login_list": _fp_login_list,
    "ato_merchant": _ato_merchant,
    "employee": _employee,
    "credential": _credential,
    "daily_payment": _daily_payment,
    "lifetime_payment": _lifetime_payment,
    "fake_unit": _fake_unit,
    "card_activity": _card_activity,
    "settlement_entry": _settlement_entry,
    "login_event": _login_event,
    "page_click": _page_click,
    "mobile_click": _mobile_click,
    "legacy_activity": _legacy_activity,
    "chargeback": _chargeback,
    "fx_rate": _fx_rate,
    "dispute": _dispute,
    "risk_evaluation": _risk_evaluation,
    "payment": _payment,
    "enrolled_merchant": _enrolled_merchant,
    "allowed_payment": _allowed_payment,
    "risk_alert": _risk_alert,
    "merchant_signup": _merchant_signup,
    "dim_date": _dim_date,
    "user_segment": _user_segment,
    "page_view": _page_view,
}


_READERS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table handle, one per (session, path): later analyses reuse
    its resolved file listing and schema instead of listing again."""
    per_session = _READERS.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


_CATALOGS: "weakref.WeakKeyDictionary[SparkSession, dict[str, Tables]]" = weakref.WeakKeyDictionary()


def driver_tables(spark: SparkSession, sf_dir: str, fresh: bool = False) -> Tables:
    """Catalog of logical tables derived from ``{sf_dir}/<table>.parquet``.

    One catalog per (session, directory), so analyses run one after another
    share their logical plans (the shared intermediates are planned once);
    nothing is cached as data.  ``fresh`` builds a new catalog."""
    key = sf_dir.rstrip("/")
    per_session = _CATALOGS.setdefault(spark, {})
    if fresh or key not in per_session:
        builders = dict(_BUILDERS)
        for name in DRIVER_TABLES:
            builders[name] = (lambda t, n=name: _read(t.spark, f"{key}/{n}.parquet"))
        per_session[key] = Tables(spark, builders=builders)
    return per_session[key]


__all__ = ["driver_tables", "DRIVER_TABLES", "micros_to_ts"]
