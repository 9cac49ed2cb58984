"""Per-payment risk mart for enrolled merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.scalar import flag, minor_to_major
from ..functions.timefns import ts_lit
from ..params import Params
from ..manifest import Manifest, latest, load, publish_files, read_published, replace_partitions
from ..sinks import publish
from ..sources.catalog import Tables

PARTITION = "payment_day"

# Misspelt on purpose: the source rewrites this literal, which never occurs,
# so the MODERATE arm is an identity (kept for parity).
_MISSPELT_MODERATE = "MODERTATE"


def _risk_level_value() -> F.Column:
    lvl = F.col("risk_level")
    return (F.when(lvl == "HIGH", F.lit("HIGH"))
            .when(lvl == _MISSPELT_MODERATE, F.lit("MODERATE"))
            .otherwise(lvl))


def _max_risk_level(p: Params) -> F.Column:
    """Highest risk level per group: by text order as in the source (NORMAL
    sorts above HIGH), or by severity when ``p.risk_level_by_severity``."""
    if not p.risk_level_by_severity:
        return F.max(_risk_level_value())
    lvl = F.col("risk_level")
    sev = F.lit(0)
    for name, rank in P.RISK_SEVERITY:
        sev = F.when(lvl == name, F.lit(rank)).otherwise(sev)
    fixed = F.when(lvl == _MISSPELT_MODERATE, F.lit("MODERATE")).otherwise(lvl)
    return F.max_by(fixed, sev)


def _mart_payments(t: Tables, p: Params) -> DataFrame:
    return t["payment"].where((F.col("is_card_payment") == 1) & (F.col("auth_success") == F.lit(True))
                              & (F.col(p.mart_auth_time) >= ts_lit(p.mart_start)) & (F.col("is_voided") == 0))


def _enrolled_evaluations(t: Tables) -> DataFrame:
    pre = t["risk_evaluation"]
    du = t["dim_user"].select(F.col("user_token").alias("_du_user"), "merchant_token",
                              "business_name", "business_category")
    rm = t["enrolled_merchant"].select(F.col("merchant_token").alias("_rm_merchant"),
                                       "onboard_date", "state", "offboard_date")
    # Units of enrolled merchants first: a small set (AQE broadcasts it when
    # its measured size allows), so only enrolled merchants' evaluations
    # reach the aggregation shuffle instead of every evaluation.
    enrolled_units = du.join(rm, F.col("merchant_token") == F.col("_rm_merchant"))
    return (pre.join(enrolled_units, pre["unit_token"] == enrolled_units["_du_user"])
            .where(F.col("created_at") >= F.col("onboard_date")))


def payment_risk_mart(t: Tables, p: Params) -> DataFrame:
    """One row per (card payment of an enrolled merchant, chargeback
    state) with payment, merchant and enrolment attributes, the highest risk
    level (string order, as in the source) and alert / chargeback / allow
    flags.  With the default ``p.mart_payment_attributes`` the grain is the
    source's 32 keys; tables lacking some attributes pass a shorter list.

    Evaluations are reduced per payment and merchant before meeting the
    payment fact; alert and allow lists are reduced to one flag per payment
    token; every join is on ``payment_token``, so the final grouping reuses
    that partitioning instead of shuffling the wide rows again.
    """
    ev = (_enrolled_evaluations(t)
          # dealt by payment here rather than by the join's unit: the join of
          # a unit with very many evaluations can be split, and the joins and
          # the grouping that follow reuse this partitioning
          .repartition("payment_token")
          .groupBy("payment_token", "unit_token", "merchant_token", "business_name",
                   "business_category", "onboard_date", "state", "offboard_date")
          .agg(_max_risk_level(p).alias("risk_level")))
    attrs = []
    for a in p.mart_payment_attributes:
        if a in P.MART_MONEY_COLUMNS:
            attrs.append(minor_to_major(a).alias(P.MART_MONEY_COLUMNS[a]))
        if a not in P.MART_MONEY_COLUMNS or a in P.MART_MONEY_KEPT_RAW:
            attrs.append(F.col(a))
    pay = (_mart_payments(t, p)
           .select(F.col("payment_token").alias("_p_token"),
                   F.col("recognized_at").alias("payment_trx_recognized_at"), *attrs))
    pay_keys = [c for c in pay.columns if c != "_p_token"]
    cb = t["chargeback"].select(F.col("payment_token").alias("_cb_token"),
                                F.col("type").alias("chargeback_type"), "status",
                                minor_to_major("chargeback_cents").alias("chargeback_amt"),
                                minor_to_major("loss_cents").alias("loss_amt"))
    alerts = t["risk_alert"].select(F.col("payment_token").alias("_ra_token")).distinct()
    allowed = t["allowed_payment"].select(F.col("payment_token").alias("_ap_token")).distinct()
    tok = F.col("payment_token")
    j = (ev.join(pay, tok == F.col("_p_token"))
         .join(cb, tok == F.col("_cb_token"), "left")
         .join(alerts, tok == F.col("_ra_token"), "left")
         .join(allowed, tok == F.col("_ap_token"), "left"))
    keys = ["payment_token", "unit_token", "merchant_token", "business_name", "business_category",
            *pay_keys, "onboard_date", "state", "offboard_date",
            "chargeback_type", "status", "chargeback_amt", "loss_amt"]
    # risk_level is already one value per evaluation key (all of which are
    # grouping keys here), so it is a key rather than a string max: the
    # final aggregate stays a hash aggregate instead of a sort.
    return (j.groupBy(*keys, "risk_level")
            .agg(F.max(flag(F.col("_ra_token").isNotNull())).alias("alerted"),
                 F.max(flag(F.col("_cb_token").isNotNull())).alias("chargeback"),
                 F.max(flag(F.col("chargeback_type") == "fraud")).alias("fraud_chargeback"),
                 F.max(flag(F.col("_ap_token").isNotNull())).alias("allowed")))


def publish_payment_risk_mart(t: Tables, p: Params, name: str) -> DataFrame:
    """Build the mart and publish it under ``name`` (see ``sinks.publish``)."""
    return publish(payment_risk_mart(t, p), name)


def mart_fingerprints(t: Tables, p: Params) -> DataFrame:
    """``payment_day``, ``rows`` and a ``fingerprint`` of everything that the
    mart's rows of that day are made of: the payments and, by their token, the
    enrolled merchants' evaluations, chargebacks, alerts and allowed payments.
    Each input row is one hash; per token and per day they are summed, so the
    order of rows does not matter and repeated rows do.  Only tokens, days and
    hashes are shuffled."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))

    def hashed(rows: DataFrame, kind: str, columns: list[str]) -> DataFrame:
        return rows.select("payment_token", F.xxhash64(F.lit(kind), *(F.coalesce(F.col(c).cast("string"), F.lit("\0"))
                                                                       for c in columns)).alias("_h"))

    ev, cb = _enrolled_evaluations(t), t["chargeback"]
    about = (hashed(ev, "evaluation", ["unit_token", "merchant_token", "business_name", "business_category",
                                       "onboard_date", "state", "offboard_date", "risk_level"])
             .unionByName(hashed(cb, "chargeback", ["type", "status", "chargeback_cents", "loss_cents"]))
             .unionByName(hashed(t["risk_alert"], "alert", []))
             .unionByName(hashed(t["allowed_payment"], "allowed", [])))
    about = about.groupBy("payment_token").agg(total("_h").alias("_about"))
    pay = _mart_payments(t, p).select(
        "payment_token", F.to_date("recognized_at").alias(PARTITION),
        F.xxhash64(F.lit("payment"), *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in
                                       ("payment_token", "recognized_at", *p.mart_payment_attributes))).alias("_own"))
    both = pay.join(about, "payment_token", "left")
    return both.groupBy(PARTITION).agg(
        (total("_own") + F.coalesce(total("_about"), F.lit(0))).cast("string").alias("fingerprint"),
        F.count(F.lit(1)).alias("rows"))


def _mart_by_day(t: Tables, p: Params) -> DataFrame:
    return payment_risk_mart(t, p).withColumn(PARTITION, F.to_date("payment_trx_recognized_at"))


def refresh_payment_risk_mart(t: Tables, p: Params, root: str) -> Manifest:
    """C24 on a plain path: publish the mart under ``root``, partitioned by
    payment day, rewriting only the days whose inputs changed since the
    published version (all of them the first time, or when the parameters
    are others).  Read it with ``manifest.read_published``."""
    spark, root = t.spark, root.rstrip("/")
    base = latest(spark, root)
    prints = publish_files(mart_fingerprints(t, p), f"{root}/fingerprints")
    notes = {"params": repr(p), "fingerprints": str(prints.number)}
    if base is None or base.notes.get("params") != repr(p):
        return publish_files(_mart_by_day(t, p), root, PARTITION, notes)
    now = read_published(spark, f"{root}/fingerprints", prints)
    then = read_published(spark, f"{root}/fingerprints", load(spark, f"{root}/fingerprints", int(base.notes["fingerprints"])))
    known = then.select(PARTITION, F.col("fingerprint").alias("_f"), F.col("rows").alias("_n"))
    changed = now.join(known, now[PARTITION].eqNullSafe(known[PARTITION]), "full").where(
        ~(F.col("fingerprint").eqNullSafe(F.col("_f")) & F.col("rows").eqNullSafe(F.col("_n")))).select(
        F.coalesce(now[PARTITION], known[PARTITION]).alias("day"))
    days = [r.day for r in changed.collect()]  # at most one a payment day
    if not days:
        return base
    day = F.to_date("recognized_at")
    some = day.isin([d for d in days if d is not None])
    some = some | day.isNull() if None in days else some
    changed_only = t.with_tables(payment=t["payment"].where(some))
    names = [f"{PARTITION}={d if d is not None else '__HIVE_DEFAULT_PARTITION__'}" for d in days]
    return replace_partitions(_mart_by_day(changed_only, p), root, base, names, notes)
