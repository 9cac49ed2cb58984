"""Hand-made fixtures for the semantics the source's queries carry
(SURVEY section 2.9): join placement, null arms, boundary days, fan-out."""

import datetime as dt

from pyspark.sql import functions as F

from riskspark.params import Params
from riskspark.plans import attach, detection, dormancy, mart
from riskspark.sources.catalog import Tables

D = dt.date
T = dt.datetime
P0 = Params()
# the fixtures' payment table has the driver-data columns only
MART = dict(mart_auth_time="recognized_at",
            mart_payment_attributes=("currency_code", "amount_base_unit", "is_refunded", "is_gpv",
                                     "entry_method", "auth_success"))


def _df(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


USER_DDL = ("user_token bigint, merchant_token bigint, is_unit int, is_deleted int, "
            "is_currently_frozen int, is_currently_deactivated int, business_name string, "
            "business_category string")


def test_gap_history_keeps_units_without_positive_days(spark):
    users = _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X"), (2, 10, 1, 0, 0, 0, "b", "X"),
                        (3, 11, 0, 0, 0, 0, "c", "Y")], USER_DDL)
    daily = _df(spark, [(1, D(2020, 1, 1), 1, 100), (1, D(2020, 1, 11), 2, 200),
                        (2, D(2020, 1, 1), 0, 50)],
                "unit_token bigint, payment_date date, card_payment_count bigint, gpv_cents bigint")
    life = _df(spark, [(1, D(2020, 1, 1), D(2020, 1, 11), 300), (2, D(2020, 1, 1), D(2020, 1, 1), 50)],
               "user_token bigint, first_card_payment_date date, latest_card_payment_date date, "
               "lifetime_gpv_cents bigint")
    fake = _df(spark, [(2,)], "unit_token bigint")
    t = Tables(spark, {"dim_user": users, "daily_payment": daily, "lifetime_payment": life,
                       "fake_unit": fake})
    p = Params(as_of=D(2020, 2, 1), user_profile_columns=())
    hist = {(r.user_token, r.payment_date): r for r in dormancy.gap_history(t, p).collect()}
    assert set(hist) == {(1, D(2020, 1, 1)), (1, D(2020, 1, 11)), (2, None)}
    assert hist[(1, D(2020, 1, 11))].difference == 10
    # summary attaches through the gap rows: unit 2 has a summary row but no
    # positive day, so its dates stay NULL
    assert hist[(2, None)].first_card_payment_date is None
    dorm = {r.user_token: r for r in dormancy.payment_dormancy(t, p).collect()}
    assert dorm[1].maximum_dormancy_in_between == 10
    assert dorm[1].dormancy_from_today == 21 and dorm[1].dormant_final == 21
    assert dorm[2].dormant_final is None and dorm[2].fa_user == 2


def _detection_tables(spark, confirmed_at):
    log = _df(spark, [
        (1, T(2000, 3, 1, 9), f"x IP 1.2.3.4 {P0.suspect_comment_pattern.strip('%').upper()} y", "Other"),
        (2, T(2000, 3, 1, 9), "plain", P0.suspect_action),
        (2, T(1999, 3, 1, 9), "plain", P0.suspect_action),
    ], "target_token bigint, created_at timestamp_ntz, comment string, action_name string")
    fp = _df(spark, [(2, "9.9.9.9")], "unit_token bigint, ip string")
    ato = _df(spark, [(1, confirmed_at), (2, T(2000, 3, 2))],
              "user_token bigint, earliest_confirmed_at timestamp_ntz")
    return Tables(spark, {"audit_log": log, "fp_login_list": fp, "ato_merchant": ato})


def test_tagged_events_extracts_address_and_keeps_fp_condition_in_join(spark):
    p = Params(fp_window_start=D(2000, 1, 1), fp_window_end=D(2000, 12, 31), log_cutoff=D(2001, 1, 1))
    rows = detection.tagged_events(_detection_tables(spark, T(2000, 3, 31)), p).collect()
    by = {(r.target_token, r.created_at.year): r for r in rows}
    assert by[(1, 2000)].ip_cleaned == "1.2.3.4" and by[(1, 2000)].fp_unit_token is None
    assert by[(2, 2000)].fp_unit_token == 2          # inside the window: flagged
    assert by[(2, 1999)].fp_unit_token is None       # outside: kept, unflagged
    assert by[(2, 2000)].ip == "ain"                 # no marker: text from char 3


def test_recall_day_window_depends_on_time_of_day(spark):
    p = Params(fp_window_start=D(2000, 1, 1), fp_window_end=D(2000, 12, 31), log_cutoff=D(2001, 1, 1))
    # tagged on 2000-03-01; confirmed 30 days later at midnight -> matched
    rec = detection.detector_recall_year(_detection_tables(spark, T(2000, 3, 31)), p).collect()
    assert rec[0].tagged_sellers == 1 and rec[0].confirmed_ato == 2
    # confirmed at noon: the lower bound is 2000-03-01 12:00, the tag day misses
    rec = detection.detector_recall_year(_detection_tables(spark, T(2000, 3, 31, 12)), p).collect()
    assert rec[0].tagged_sellers == 0


def test_precision_drops_false_positive_rows(spark):
    p = Params(fp_window_start=D(2000, 1, 1), fp_window_end=D(2000, 12, 31), log_cutoff=D(2001, 1, 1),
               precision_cutoff=D(2001, 1, 1))
    rows = detection.detector_precision_year(_detection_tables(spark, T(2000, 3, 31)), p).collect()
    got = {r.tagged_year.year: (r.tagged_users, r.confirmed_ato) for r in rows}
    # user 2's 2000 entry is a known false positive and is removed (WHERE);
    # its 1999 entry stays but has no confirmation within 30 days
    assert got == {2000: (1, 1), 1999: (1, 0)}


def test_headcount_zero_people_is_locked_and_small(spark):
    emp = _df(spark, [(1, None, True, False), (2, 21, True, True), (2, 22, False, False)],
              "merchant_id bigint, person_id bigint, is_active boolean, is_authorized_user boolean")
    cred = _df(spark, [(21, D(2000, 1, 1)), (22, None)], "person_token bigint, locked_at date")
    t = Tables(spark, {"employee": emp, "credential": cred})
    locked = {r.merchant_id: r for r in detection.group_fully_locked(t, P0).collect()}
    assert locked[1].total_person == 0 and locked[1].is_locked == 1
    assert locked[2].total_person_locked == 1 and locked[2].is_locked == 0
    buckets = {r.total_person_buckets: r for r in detection.headcount_buckets(t, P0).collect()}
    assert buckets["2. <5"].merchants == 2 and buckets["2. <5"].locked_merchants == 1
    prof = {r.merchant_id: r for r in detection.headcount_profile(t, P0).collect()}
    assert (prof[2].active_persons, prof[2].authorized_persons) == (1, 1)


def test_mart_risk_level_is_string_max(spark):
    pre = _df(spark, [(7, 1, 7, "HIGH", T(2021, 1, 2)), (7, 1, 7, "NORMAL", T(2021, 1, 2))],
              "payment_token bigint, unit_token bigint, bill_token bigint, risk_level string, "
              "created_at timestamp_ntz")
    pay = _df(spark, [(7, 1, T(2021, 1, 2), 1234, "USD", 0, 0, 1, 1, 1, True, "SWIPED")],
              "payment_token bigint, unit_token bigint, recognized_at timestamp_ntz, "
              "amount_base_unit bigint, currency_code string, is_voided int, is_refunded int, "
              "is_card_payment int, is_gpv int, has_successful_capture int, auth_success boolean, "
              "entry_method string")
    users = _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X")], USER_DDL)
    rm = _df(spark, [(10, D(2020, 1, 1), None, "subscribed")],
             "merchant_token bigint, onboard_date date, offboard_date date, state string")
    cb = _df(spark, [(7, 1, T(2021, 1, 2), D(2021, 2, 1), "USD", 500, 100, "fraud", "open")],
             "payment_token bigint, user_token bigint, payment_created_at timestamp_ntz, "
             "chargeback_date date, currency_code string, chargeback_cents bigint, loss_cents bigint, "
             "type string, status string")
    tok = "payment_token bigint"
    t = Tables(spark, {"risk_evaluation": pre, "payment": pay, "dim_user": users, "enrolled_merchant": rm,
                       "chargeback": cb, "risk_alert": _df(spark, [(7,)], tok),
                       "allowed_payment": _df(spark, [(8,)], tok)})
    [row] = mart.payment_risk_mart(t, Params(mart_start=D(2020, 1, 1), **MART)).collect()
    assert row.risk_level == "NORMAL"
    assert (row.alerted, row.chargeback, row.fraud_chargeback, row.allowed) == (1, 1, 1, 0)
    assert row.amount_base == 12.34 and row.loss_amt == 1.0


def test_reactivation_value_boundaries_and_multiplicity(spark):
    users = _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X")], USER_DDL)
    days = [(1, D(2000, 1, 1), 1, 100), (1, D(2002, 1, 1), 1, 1000),   # gap 731 -> reactivation
            (1, D(2002, 4, 2), 1, 10),     # +91: outside the 90-day horizon
            (1, D(2002, 3, 31), 1, 20),    # +89: inside
            (1, D(2004, 1, 1), 1, 5)]      # gap 640 -> second reactivation
    daily = _df(spark, days, "unit_token bigint, payment_date date, card_payment_count bigint, "
                             "gpv_cents bigint")
    cb = _df(spark, [(70, 1, T(2002, 3, 31), D(2002, 4, 1), "USD", 400, 0, "fraud", "open")],
             "payment_token bigint, user_token bigint, payment_created_at timestamp_ntz, "
             "chargeback_date date, currency_code string, chargeback_cents bigint, loss_cents bigint, "
             "type string, status string")
    fx = _df(spark, [(D(2002, 4, 1), "USD", "USD", 1.0, 1.0)],
             "report_date date, base string, counter string, rate double, multiplier double")
    t = Tables(spark, {"dim_user": users, "daily_payment": daily, "chargeback": cb, "fx_rate": fx})
    p = Params(reactivation_cohort_end=D(2005, 1, 1))
    cbs = dormancy.chargebacks_fx_daily(t, p).collect()
    assert [r.chargebacks_usd for r in cbs] == [800.0]   # counted once per reactivation
    once = Params(reactivation_cohort_end=D(2005, 1, 1), dedupe_reactivation_chargebacks=True)
    assert [r.chargebacks_usd for r in dormancy.chargebacks_fx_daily(t, once).collect()] == [400.0]
    rows = {r.payment_month: r for r in dormancy.reactivation_value(t, p).collect()}
    first = rows[D(2002, 1, 1)]
    assert first.units == 1
    assert first.gpv_enabled_90 == 0.2                      # reactivation day and +91 excluded
    assert first.overall_gpv_enabled == 0.35
    assert first.cb_enabled_365 == 800.0


def test_adoption_uncovered_week_has_null_rate(spark):
    users = _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X")], USER_DDL)
    pay = _df(spark, [(1, 1, T(2000, 1, 3), 1000, "USD", 0, 0, 1, 1, 1, True, "EXTERNAL_API")],
              "payment_token bigint, unit_token bigint, recognized_at timestamp_ntz, "
              "amount_base_unit bigint, currency_code string, is_voided int, is_refunded int, "
              "is_card_payment int, is_gpv int, has_successful_capture int, auth_success boolean, "
              "entry_method string")
    cal = (spark.range(1).select(F.explode(F.sequence(F.lit(D(2000, 1, 3)), F.lit(D(2000, 6, 4))))
                                 .alias("report_date"))
           .select("report_date", F.date_trunc("week", "report_date").cast("date").alias("week_begin"))
           .withColumn("week_end", F.date_add("week_begin", 6)))
    seg = _df(spark, [(1, "Large", D(2000, 1, 1), D(2000, 1, 31))],
              "user_token bigint, segment string, effective_begin date, effective_end date")
    rm = _df(spark, [(10, D(1999, 1, 1), None, "in_trial")],
             "merchant_token bigint, onboard_date date, offboard_date date, state string")
    su = _df(spark, [(10, None, T(1999, 1, 1))],
             "token bigint, online_signup_at timestamp_ntz, initially_enrolled_at timestamp_ntz")
    t = Tables(spark, {"dim_user": users, "payment": pay, "dim_date": cal, "user_segment": seg,
                       "enrolled_merchant": rm, "merchant_signup": su})
    p = Params(payments_start=D(1999, 10, 11), as_of=D(2000, 6, 5))
    rows = attach.paid_adoption_week(t, p).collect()
    by = {(r.week_start_date, r.gpv_segment, r.mcc): r for r in rows}
    large = by[(D(2000, 1, 3), "Large", "X")]
    assert (large.enrolled_merchants, large.total_merchants, large.paid_product_adoption_rate) == (1, 1, 1.0)
    # after 2000-01-31 the segment ends: the unit is 'Inactive' until its
    # payment leaves the window (92 days after 2000-01-03 is 2000-04-04)
    assert by[(D(2000, 4, 3), "Inactive", "X")].total_merchants == 1
    # weeks with no payment in any trailing window: one null group, rate NULL
    empty = by[(D(2000, 5, 1), "Inactive", None)]
    assert (empty.total_merchants, empty.paid_product_adoption_rate) == (0, None)


def test_engagement_short_path_gives_empty_bill(spark):
    pv = _df(spark, [("/home", 1, "dashboard", "page_view", "Transactions: Show all", T(2021, 1, 1)),
                     ("/a/b/c/42", 1, "dashboard", "page_view", "transactions: show", T(2021, 1, 2)),
                     ("/a/b/c/43", 1, "pos", "page_view", "Transactions: Show", T(2021, 1, 2))],
             "webpage_path string, merchant_token bigint, app_name string, catalog_name string, "
             "description string, recorded_at timestamp_ntz")
    t = Tables(spark, {"page_view": pv})
    got = {r.dashboard_bill_token for r in attach.first_engagement(t, P0).collect()}
    assert got == {"", "42"}


def test_opt_in_corrections(spark):
    # Q6: severity order instead of text order
    pre = _df(spark, [(7, 1, 7, "HIGH", T(2021, 1, 2)), (7, 1, 7, "NORMAL", T(2021, 1, 2)),
                      (7, 1, 7, "MODERTATE", T(2021, 1, 2))],
              "payment_token bigint, unit_token bigint, bill_token bigint, risk_level string, "
              "created_at timestamp_ntz")
    pay = _df(spark, [(7, 1, T(2021, 1, 2), 1234, "USD", 0, 0, 1, 1, 1, True, "SWIPED")],
              "payment_token bigint, unit_token bigint, recognized_at timestamp_ntz, "
              "amount_base_unit bigint, currency_code string, is_voided int, is_refunded int, "
              "is_card_payment int, is_gpv int, has_successful_capture int, auth_success boolean, "
              "entry_method string")
    users = _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X")], USER_DDL)
    rm = _df(spark, [(10, D(2020, 1, 1), None, "subscribed")],
             "merchant_token bigint, onboard_date date, offboard_date date, state string")
    cb = _df(spark, [], "payment_token bigint, user_token bigint, payment_created_at timestamp_ntz, "
                        "chargeback_date date, currency_code string, chargeback_cents bigint, "
                        "loss_cents bigint, type string, status string")
    tok = "payment_token bigint"
    t = Tables(spark, {"risk_evaluation": pre, "payment": pay, "dim_user": users, "enrolled_merchant": rm,
                       "chargeback": cb, "risk_alert": _df(spark, [], tok),
                       "allowed_payment": _df(spark, [], tok)})
    base = Params(mart_start=D(2020, 1, 1), **MART)
    [row] = mart.payment_risk_mart(t, base).collect()
    assert row.risk_level == "NORMAL" and row.chargeback == 0
    [row] = mart.payment_risk_mart(t, Params(mart_start=D(2020, 1, 1), risk_level_by_severity=True,
                                             **MART)).collect()
    assert row.risk_level == "HIGH"


def test_mart_default_grain_has_the_source_keys(spark):
    import riskspark.params as PP
    cols = ", ".join(f"{c} {'bigint' if c in PP.MART_MONEY_COLUMNS else 'string'}"
                     for c in PP.MART_PAYMENT_ATTRIBUTES if c not in ("auth_intent_created_at", "auth_success"))
    ddl = (f"payment_token bigint, unit_token bigint, recognized_at timestamp_ntz, "
           f"auth_intent_created_at timestamp_ntz, auth_success boolean, is_card_payment int, "
           f"is_voided int, {cols}")
    schema = spark.createDataFrame([], ddl).schema
    vals = {"payment_token": 7, "unit_token": 1, "recognized_at": T(2021, 1, 2),
            "auth_intent_created_at": T(2021, 1, 2), "auth_success": True, "is_card_payment": 1,
            "is_voided": 0}
    row = tuple(vals.get(f.name, 100 if f.dataType.simpleString() == "bigint" else "x")
                for f in schema.fields)
    pay = spark.createDataFrame([row], schema)
    pre = _df(spark, [(7, 1, 7, "HIGH", T(2021, 1, 2))],
              "payment_token bigint, unit_token bigint, bill_token bigint, risk_level string, "
              "created_at timestamp_ntz")
    t = Tables(spark, {"risk_evaluation": pre, "payment": pay,
                       "dim_user": _df(spark, [(1, 10, 1, 0, 0, 0, "a", "X")], USER_DDL),
                       "enrolled_merchant": _df(spark, [(10, D(2020, 1, 1), None, "subscribed")],
                                                "merchant_token bigint, onboard_date date, "
                                                "offboard_date date, state string"),
                       "chargeback": _df(spark, [], "payment_token bigint, type string, status string, "
                                                    "chargeback_cents bigint, loss_cents bigint"),
                       "risk_alert": _df(spark, [], "payment_token bigint"),
                       "allowed_payment": _df(spark, [], "payment_token bigint")})
    out = mart.payment_risk_mart(t, Params(mart_start=D(2020, 3, 31)))
    flags = {"risk_level", "alerted", "chargeback", "fraud_chargeback", "allowed"}
    assert len([c for c in out.columns if c not in flags]) == 32
    [r] = out.collect()
    assert (r.amount_base, r.tip_amount, r.tip_amount_base_unit) == (1.0, 1.0, 100)
