"""Perturbed logical tables: the driver-data tables with situations the
synthetic mapping never produces (overlapping segment validity, several
enrolment rows per merchant, calendar holes, users listed twice with
different attributes, duplicate list and rate rows, disputes repeated under
other units and statuses, ledger rows of one token under other units and
currencies, evaluations without a level, chargebacks without a rate,
signups without a token).  Used to test every
plan against the oracle on the logical tables directly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import LOGICAL_TABLES, Tables


def perturbed_tables(src: Tables) -> dict[str, DataFrame]:
    t = {n: src[n] for n in LOGICAL_TABLES}
    seg = t["user_segment"]
    extra_seg = (seg.where(F.col("user_token") % 5 == 1)
                 .select("user_token", F.lit("Medium").alias("segment"),
                         F.date_add("effective_begin", 3).alias("effective_begin"),
                         F.date_add("effective_begin", 40).alias("effective_end")))
    t["user_segment"] = seg.unionByName(extra_seg)
    em = t["enrolled_merchant"]
    t["enrolled_merchant"] = em.unionByName(
        em.where(F.col("merchant_token") % 3 == 0).select(
            "merchant_token", F.date_add("onboard_date", 200).alias("onboard_date"),
            F.date_add("onboard_date", 500).alias("offboard_date"), F.lit("churned").alias("state")))
    t["dim_date"] = t["dim_date"].where(F.dayofmonth("report_date") % 9 != 0)
    du = t["dim_user"]
    t["dim_user"] = du.unionByName(
        du.where(F.col("user_token") % 31 == 0).withColumn("merchant_token", F.col("merchant_token") + 1)
        .withColumn("business_category", F.lit("RETAIL")))
    fp = t["fp_login_list"]
    t["fp_login_list"] = fp.unionByName(fp.withColumn("ip", F.concat(F.col("ip"), F.lit("9"))))
    cr = t["credential"]
    t["credential"] = cr.unionByName(cr.where(F.col("person_token") % 7 == 0)
                                     .withColumn("locked_at", F.lit(None).cast("date")))
    for n in ("risk_alert", "allowed_payment"):
        t[n] = t[n].unionByName(t[n].where(F.col("payment_token") % 2 == 0))
    d = t["dispute"]
    t["dispute"] = d.unionByName(
        d.where(F.col("transaction_token") % 9 == 0)
        .withColumn("unit_token", F.concat(F.col("unit_token"), F.lit("x")))
        .withColumn("status", F.lit("WON")).withColumn("final_resolution", F.lit(None).cast("string")))
    ca = t["card_activity"]
    t["card_activity"] = ca.unionByName(
        ca.where(F.col("transaction_token") % 11 == 0)
        .withColumn("balance_token", F.concat(F.lit("b-0123456789abc-c-"), F.lit("9999999999999")))
        .withColumn("currency_code", F.lit("EUR")))
    ev = t["risk_evaluation"]
    t["risk_evaluation"] = ev.unionByName(
        ev.where(F.col("payment_token") % 13 == 0).withColumn("risk_level", F.lit(None).cast("string")))
    cb = t["chargeback"]
    t["chargeback"] = cb.unionByName(
        cb.where(F.col("payment_token") % 5 == 0).withColumn("currency_code", F.lit("EUR")))
    ms = t["merchant_signup"]
    t["merchant_signup"] = ms.unionByName(
        ms.where(F.col("token") % 10 == 0).withColumn("token", F.lit(None).cast("bigint")))
    fx = t["fx_rate"]
    t["fx_rate"] = fx.unionByName(fx.where(F.dayofmonth("report_date") == 5)
                                  .withColumn("rate", F.col("rate") * 2))
    return t
