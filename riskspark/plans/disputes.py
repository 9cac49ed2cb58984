"""Card-dispute key results.

Two inputs: the card activity ledger and the dispute table.  The settled
ledger is reduced once per (transaction, unit, currency) for spend; for the
amount lookup, only the disputed transactions' ledger rows are reduced per
token, so every dispute join is one-to-one on the token.  Where the source
joins a (token, currency) rollup and therefore counts a dispute once per
currency of its transaction, the reduction carries that multiplicity
explicitly and the sums stay exact.
Money is summed in integer cents and divided by 100 once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions.predicates import (fraud_in_year, platform_borne, resolution_counts, seller_borne,
                                   valid_dispute)
from ..functions.scalar import bps, safe_ratio, unit_from_balance_split
from ..functions.timefns import trunc_date, year_range
from ..operators.aggs import conditional_distinct_counts
from ..params import Params
from ..sources.catalog import Tables


def card_ledger(t: Tables, p: Params) -> DataFrame:
    """Settled card payments per (transaction, unit, currency): largest
    absolute amount and first time, before the key-result year filter.
    Partially aggregated before its shuffle; the book materialises it once
    for all the key results that read the rollup."""
    return t.derived("card_ledger", None, lambda: _build_card_ledger(t))


def _build_card_ledger(t: Tables) -> DataFrame:
    ua = t["card_activity"].where(F.col("activity_type").ilike(P.CARD_PAYMENT_PATTERN)
                                  & (F.col("activity_state") == P.SETTLED_STATE))
    return (ua.groupBy("transaction_token",
                       unit_from_balance_split("balance_token").alias("unit_token"),
                       "currency_code")
            .agg(F.max(F.abs("amount_cents")).alias("settled_cents"),
                 F.min("created_at").alias("settled_first_at")))


def _rollup(t: Tables, p: Params) -> DataFrame:
    """Settled card payments per (transaction, unit, currency): largest
    absolute amount and first time; only transactions first seen in the
    KPI year."""
    return t.derived("card_rollup", p, lambda: _build_rollup(t, p))


def _build_rollup(t: Tables, p: Params) -> DataFrame:
    g = card_ledger(t, p)
    return (g.where(year_range("settled_first_at", p.kpi_year))
            .select("transaction_token", "unit_token", "currency_code",
                    (F.col("settled_cents") / 100).alias("amount"),
                    F.col("settled_first_at").alias("created_at"),
                    F.col("settled_cents").alias("amount_cents")))


def transaction_rollup(t: Tables, p: Params) -> DataFrame:
    """Settled card payments per (transaction, unit, currency), first
    seen in the KPI year, with the largest absolute amount and first time."""
    return _rollup(t, p).drop("amount_cents")


def card_payments(t: Tables) -> DataFrame:
    """Card payments of any state: token, currency and absolute amount, of
    which only the largest per token and currency is read."""
    return t.derived("card_payments", None, lambda: t["card_activity"].where(
        F.col("activity_type").ilike(P.CARD_PAYMENT_PATTERN)).select(
        "transaction_token", "currency_code", F.abs("amount_cents").alias("card_cents")))


def _token_amounts(t: Tables, disputes: DataFrame) -> DataFrame:
    """Card payments (any state) of the disputed tokens: number of currencies
    and the sum over currencies of the largest absolute amount per token.
    Equivalent, for sums, to the source's row-by-row join of a (token,
    currency) rollup.  The ledger is first semi-joined to the disputed
    tokens (a small set: AQE broadcasts it or Spark bloom-filters the scan),
    so only their rows are aggregated, never the whole ledger."""
    tokens = disputes.select("transaction_token").distinct()
    ua = card_payments(t).join(tokens, "transaction_token", "left_semi")
    per_cur = (ua.groupBy("transaction_token", "currency_code")
               .agg(F.max("card_cents").alias("cents")))
    return (per_cur.groupBy("transaction_token")
            .agg(F.count(F.lit(1)).alias("n_currencies"), F.sum("cents").alias("ua_cents")))


def loss_bps_month(t: Tables, p: Params) -> DataFrame:
    """C17: platform-borne fraud dispute amount over settled card spend,
    per month, in basis points.  Months missing on either side drop out."""
    d = t["dispute"].where(valid_dispute(p))
    d = d.join(_token_amounts(t, d), "transaction_token", "left")
    losses = (d.groupBy(trunc_date("month", "transaction_date").alias("transaction_month"))
              .agg(F.sum(F.when(platform_borne(p), F.col("ua_cents"))).alias("loss_cents")))
    spend = (_rollup(t, p)
             .groupBy(trunc_date("month", "created_at").alias("transaction_month"))
             .agg(F.sum("amount_cents").alias("spend_cents")))
    j = losses.join(spend, "transaction_month")
    amount = F.col("loss_cents") / 100
    spend_amt = F.col("spend_cents") / 100
    return (j.select("transaction_month", amount.alias("dispute_amount"), spend_amt.alias("spend"),
                     bps(amount, spend_amt).alias("loss_bps"))
            .orderBy("transaction_month"))


def _valid_disputes(t: Tables, p: Params) -> DataFrame:
    return t["dispute"].where(valid_dispute(p))


def dispute_rate_count(t: Tables, p: Params) -> DataFrame:
    """Distinct valid fraud disputes per distinct settled card
    transaction, by month, in basis points (full outer join on token)."""
    vd = _valid_disputes(t, p).select(F.col("transaction_token").alias("vd_token"),
                                     "transaction_date").distinct()
    sqt = transaction_rollup(t, p).select(F.col("transaction_token").alias("card_token"),
                                          F.col("created_at").alias("ua_time")).distinct()
    j = vd.join(sqt, vd["vd_token"] == sqt["card_token"], "full")
    month = trunc_date("month", F.coalesce(F.col("ua_time"), F.col("transaction_date")))
    # both sides of a matched row carry the same token: count one key with
    # a flag per side instead of two distinct aggregates (no Expand)
    j = j.select(month.alias("transaction_month"),
                 F.coalesce("card_token", "vd_token").alias("_token"), "card_token", "vd_token")
    g = conditional_distinct_counts(j, ["transaction_month"], "_token", None,
                                    {"count_card_transactions": F.col("card_token").isNotNull(),
                                     "count_card_disputes": F.col("vd_token").isNotNull()})
    return (g.where(F.year("transaction_month") == p.kpi_year)
            .withColumn("bps_dispute_count",
                        bps("count_card_disputes", "count_card_transactions"))
            .orderBy("transaction_month"))


def dispute_rate_amount(t: Tables, p: Params) -> DataFrame:
    """Amount of settled card spend with a valid fraud dispute over all
    such spend, by month.  A transaction with several valid disputes is
    counted once per dispute, as in the source."""
    per_token = (_valid_disputes(t, p).groupBy(F.col("transaction_token"))
                 .agg(F.count(F.lit(1)).alias("n_disputes")))
    sqt = _rollup(t, p).join(per_token, "transaction_token", "left")
    c = F.col("amount_cents")
    g = (sqt.groupBy(trunc_date("month", "created_at").alias("transaction_month"))
         .agg(F.sum(c * F.coalesce(F.col("n_disputes"), F.lit(1))).alias("spend_cents"),
              F.sum(F.when(F.col("n_disputes").isNotNull(), c * F.col("n_disputes")))
              .alias("disputed_cents")))
    spend = F.col("spend_cents") / 100
    disputed = F.col("disputed_cents") / 100
    return (g.where(F.year("transaction_month") == p.kpi_year)
            .select("transaction_month", spend.alias("spend"), disputed.alias("disputed"),
                    bps(disputed, spend).alias("bps_dispute_amount"))
            .orderBy("transaction_month"))


def dispute_sellers(t: Tables, p: Params) -> DataFrame:
    """C20: per month of the KPI year, valid fraud disputes and the sellers
    filing valid fraud, any fraud and any disputes, and the key result
    itself (valid disputes per seller filing them).

    Only distinct counts are read, so each side of the source's self-join is
    first reduced to distinct (token, unit) pairs, and each count to its own
    small set of (month, key) pairs, counted plainly and joined by month.
    """
    d = t["dispute"]
    month = trunc_date("month", "transaction_date").alias("transaction_month")
    td = d.where(year_range("transaction_date", p.kpi_year)).select(month, "transaction_token", "unit_token")
    tokens = td.select("transaction_month", "transaction_token").distinct()
    fd = d.where(fraud_in_year(p)).select("transaction_token", "unit_token").distinct()
    vd = d.where(valid_dispute(p)).select("transaction_token", "unit_token").distinct()

    def counted(pairs: DataFrame, key: str, name: str) -> DataFrame:
        return (pairs.select("transaction_month", key).distinct()
                .groupBy("transaction_month").agg(F.count(key).alias(name)))

    out = counted(td, "unit_token", "count_unique_sellers_filing_disputes")
    valid = tokens.join(vd, "transaction_token")
    for part, key, name in (
            (valid, "transaction_token", "count_valid_fraud_disputes"),
            (valid, "unit_token", "count_unique_sellers_filing_valid_fraud_disputes"),
            (tokens.join(fd, "transaction_token"), "unit_token", "count_unique_sellers_filing_fraud_disputes")):
        out = (out.join(counted(part, key, name), "transaction_month", "left")
               .withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint"))))
    sellers = "count_unique_sellers_filing_valid_fraud_disputes"
    return (out.select("transaction_month", "count_valid_fraud_disputes", sellers,
                       "count_unique_sellers_filing_fraud_disputes", "count_unique_sellers_filing_disputes",
                       safe_ratio("count_valid_fraud_disputes", sellers).alias("disputes_per_disputing_seller"))
            .orderBy("transaction_month"))


def high_dispute_share(t: Tables, p: Params) -> DataFrame:
    """Sellers whose valid fraud disputes exceed ``p.dispute_share_threshold``
    of their settled card spend in a month, in basis points of the month's
    active sellers."""
    vd = (_valid_disputes(t, p)
          .groupBy(trunc_date("month", "transaction_date").alias("transaction_month"), "unit_token")
          .agg((F.sum("dispute_cents") / 100).alias("total_fraud_dispute")))
    sct = (_rollup(t, p)
           .groupBy(trunc_date("month", "created_at").alias("transaction_month"), "unit_token")
           .agg((F.sum("amount_cents") / 100).alias("total_spend_amount"))
           .where(F.col("total_spend_amount") > 0))
    j = sct.join(vd, ["transaction_month", "unit_token"], "left")
    share = F.try_divide(F.col("total_fraud_dispute"), F.col("total_spend_amount"))
    # one row per (month, unit) here, so the distinct counts are plain counts
    g = (j.groupBy("transaction_month")
         .agg(F.count(F.when(share > p.dispute_share_threshold, F.col("unit_token")))
              .alias("seller_with_50pct_more_disputes"),
              F.count("unit_token").alias("total_active_sellers")))
    return (g.withColumn("disp", bps("seller_with_50pct_more_disputes", "total_active_sellers"))
            .orderBy("transaction_month"))


def dispute_loss_split(t: Tables, p: Params) -> DataFrame:
    """Monthly fraud dispute amounts: valid, all, and seller-borne.

    One pass over the year's fraud disputes with three conditional sums
    replaces the source's three CTEs; each dispute is weighted by the number
    of currencies its transaction has in the ledger, which is what the
    source's (unused) ledger join does to the sums.
    """
    d = t["dispute"].where(fraud_in_year(p))
    mult = _token_amounts(t, d).select("transaction_token", "n_currencies")
    d = d.join(mult, "transaction_token", "left")
    w = F.col("dispute_cents") * F.coalesce(F.col("n_currencies"), F.lit(1))
    valid = resolution_counts(p)
    g = (d.groupBy(trunc_date("month", "transaction_date").alias("transaction_month"))
         .agg(F.count(F.when(valid, F.lit(1))).alias("_n_valid"),
              F.sum(F.when(valid, w)).alias("_valid"),
              F.sum(w).alias("_all"),
              F.sum(F.when(seller_borne(p), w)).alias("_seller")))
    return (g.where(F.col("_n_valid") > 0)
            .select("transaction_month",
                    (F.col("_valid") / 100).alias("valid_fraud_dispute_amount"),
                    (F.col("_all") / 100).alias("fraud_dispute_amount"),
                    (F.col("_seller") / 100).alias("seller_losses_amount"))
            .orderBy("transaction_month"))

