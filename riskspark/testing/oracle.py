"""DuckDB versions of the driver-data adapter, used as an independent oracle.

``RECIPES`` mirrors ``riskspark.sources.driver_adapter`` rule for rule, as
DuckDB SQL over the driver's tables.  ``compose(sql, relations)`` prepends, as
CTEs, exactly the relations a query names (and what they depend on), so
every oracle query is one self-contained statement.
"""

from __future__ import annotations

import re

EVT = ("select *, ts - to_days(cast(8400 + (user_id * 17 % 80) * 25 + (event_id % 7) * 15 "
       "as integer)) as rec from events")

RECIPES: dict[str, str] = {
    "evt": EVT,
    "dim_user": """select c_custkey as user_token, cast(floor(c_custkey / 3) as bigint) as merchant_token,
  cast(case when c_custkey % 20 = 7 then 0 else 1 end as integer) as is_unit,
  cast(case when c_custkey % 13 = 0 then 1 when c_custkey % 13 = 1 then null else 0 end as integer) as is_deleted,
  cast(case when c_acctbal < -500 then 1 else 0 end as integer) as is_currently_frozen,
  cast(case when c_nationkey = 3 then null when c_nationkey = 4 then 1 else 0 end as integer) as is_currently_deactivated,
  c_name as business_name, c_mktsegment as business_category,
  (date '1993-01-01' + cast(c_custkey % 700 as integer)) as user_created_at_date,
  case when c_acctbal < -500 then (date '2001-01-01' + cast(c_custkey % 300 as integer)) end as currently_frozen_at_date,
  case when c_nationkey = 4 then (date '2001-01-01' + cast(c_custkey % 200 as integer)) end as currently_deactivated_at_date
  from customer""",
    "audit_log": """select user_id as target_token, rec as created_at,
  case when event_type = 'error' and event_id % 3 <> 0 then concat('note IP 10.0.', user_id, '.', event_id % 250, ' #SuspectLogin x') else 'plain note' end as comment,
  case when event_id % 11 = 0 then 'Watchlist' else 'Other' end as action_name
  from evt where event_type in ('error', 'view')""",
    "fp_login_list": "select distinct user_id as unit_token, concat('10.0.', user_id, '.0') as ip from events where user_id % 10 = 3",
    "ato_merchant": "select user_id as user_token, min(rec) as earliest_confirmed_at from evt where event_type = 'signup' and user_id % 4 = 0 group by user_id",
    "employee": """select distinct merchant_id, person_id, person_id % 3 <> 0 as is_active, person_id % 5 = 0 as is_authorized_user
  from (select m as merchant_id, m * 100 + l_orderkey % (1 + m % 70) as person_id
        from (select cast(floor(l_partkey / 4) as bigint) as m, l_orderkey from lineitem) x) y""",
    "credential": "select person_id as person_token, case when merchant_id % 8 = 0 or person_id % 2 = 0 then date '2000-01-01' end as locked_at from employee",
    "daily_payment": """select o_custkey as unit_token, cast(o_orderdate as date) as payment_date,
  count(case when o_orderstatus = 'F' then 1 end) as card_payment_count,
  cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as gpv_cents from orders group by 1, 2""",
    "lifetime_payment": """select o_custkey as user_token, min(cast(o_orderdate as date)) as first_card_payment_date,
  max(cast(o_orderdate as date)) as latest_card_payment_date,
  cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as lifetime_gpv_cents
  from orders where o_orderstatus in ('F', 'P') group by 1""",
    "fake_unit": "select c_custkey as unit_token from customer where c_custkey % 17 = 0",
    "card_activity": """select l_orderkey * 2 + l_linenumber % 2 as transaction_token,
  concat('b-0123456789abc-c-', lpad(concat('', o_custkey), 13, '0')) as balance_token,
  case when l_suppkey % 5 = 0 then 'CAD' else 'USD' end as currency_code,
  -cast(round(l_extendedprice * 100) as bigint) as amount_cents,
  case when l_linenumber % 7 = 4 then 'ATM_CHARGEBACK' when l_linenumber % 7 = 3 then 'UNKNOWN' else 'CARD_PAYMENT' end as activity_type,
  case when l_linestatus = 'F' then 'SETTLED' else 'PENDING' end as activity_state,
  l_shipdate as created_at from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "settlement_entry": "select user_id as merchant_token, epoch_us(rec) as created_us, event_id % 9 = 0 as is_verification from evt where event_type = 'purchase'",
    "login_event": "select cast(floor(user_id / 3) as bigint) as merchant_token, user_id as person_token, rec as recorded_at, event_id % 6 <> 0 as success from evt where event_type = 'signup'",
    "page_click": "select case when event_id % 50 = 0 then null else cast(floor(user_id / 3) as bigint) end as merchant_token, user_id as person_token, rec as recorded_at from evt where event_type = 'click'",
    "mobile_click": "select cast(floor(user_id / 3) as bigint) as merchant_token, user_id as person_token, rec as recorded_at from evt where event_type = 'view'",
    "legacy_activity": "select cast(floor(user_id / 3) as bigint) + 20 as merchant_token, rec as last_activity_at from evt where event_type = 'error'",
    "chargeback": """select l_orderkey as payment_token, o_custkey as user_token, o_orderdate as payment_created_at,
  cast(l_shipdate as date) as chargeback_date, case when l_suppkey % 5 = 0 then 'CAD' else 'USD' end as currency_code,
  cast(round(l_extendedprice * 100) as bigint) as chargeback_cents,
  cast(round(l_extendedprice * l_discount * 100) as bigint) as loss_cents,
  case when l_suppkey % 2 = 0 then 'fraud' else 'other' end as type,
  case when l_linestatus = 'F' then 'closed' else 'open' end as status
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey where l_returnflag = 'A' and l_linenumber = 1""",
    "fx_rate": """select distinct cast(l_shipdate as date) as report_date, 'USD' as base, 'USD' as counter, cast(1.0 as double) as rate, cast(1.0 as double) as multiplier from lineitem
  union all select distinct cast(l_shipdate as date), 'CAD', 'USD', cast(0.75 as double), cast(1.0 as double) from lineitem where day(l_shipdate) % 11 <> 0""",
    "dispute": """select l_orderkey * 2 + l_linenumber % 2 as transaction_token, lpad(concat('', o_custkey), 13, '0') as unit_token,
  l_shipdate as transaction_date, case when l_suppkey % 4 = 0 then 'OTHER' else 'FRAUD' end as reason_code,
  case l_partkey % 6 when 0 then 'APPROVED' when 1 then 'DENIED' when 2 then 'CREDITED' when 3 then 'SELLER_LIABLE' when 4 then 'VOIDED' end as final_resolution,
  case l_partkey % 4 when 0 then 'LOST' when 1 then 'NEW' else 'FILED' end as status,
  case when l_tax >= 0.04 then cast(l_shipdate as date) end as provisional_credit_debited_date,
  case when l_partkey % 9 = 3 then 'CHIP' else 'NONE' end as resolution_reason,
  (cast(l_shipdate as date) + cast(l_quantity * 4 as integer)) as seller_disputed_date,
  cast(round(l_extendedprice * 50) as bigint) as dispute_cents
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey where l_returnflag = 'R' and l_quantity > 25""",
    "risk_evaluation": """select o_orderkey as payment_token, o_custkey as unit_token, o_orderkey as bill_token,
  case when o_orderpriority = '1-URGENT' then 'HIGH' when o_orderpriority = '2-HIGH' then 'MODERATE' else 'NORMAL' end as risk_level,
  o_orderdate as created_at from orders
  union all select o_orderkey, o_custkey, o_orderkey, 'NORMAL', o_orderdate from orders where o_orderkey % 10 = 0""",
    "payment": """select o_orderkey as payment_token, o_custkey as unit_token, o_orderdate as recognized_at,
  cast(round(o_totalprice * 100) as bigint) as amount_base_unit, 'USD' as currency_code,
  cast(case when o_orderkey % 23 = 0 then 1 else 0 end as integer) as is_voided,
  cast(case when o_orderkey % 19 = 0 then 1 else 0 end as integer) as is_refunded,
  cast(case when o_orderkey % 29 = 0 then 0 else 1 end as integer) as is_card_payment,
  cast(case when o_orderkey % 31 = 0 then 0 else 1 end as integer) as is_gpv,
  cast(case when o_orderkey % 37 = 0 then 0 else 1 end as integer) as has_successful_capture,
  o_orderkey % 43 <> 0 as auth_success,
  case o_orderkey % 3 when 0 then 'EXTERNAL_API' when 1 then 'EXTERNAL_API_ON_FILE' else 'SWIPED' end as entry_method,
  o_orderdate - to_hours(cast(o_orderkey % 50 as integer)) as auth_intent_created_at,
  cast(round(o_totalprice * 100) as bigint) + o_orderkey % 5 * 100 as auth_intent_amount,
  case when o_orderkey % 4 = 0 then 'CA' else 'US' end as country_code,
  case when o_orderkey % 17 <> 0 then concat('pan-', o_custkey * 7 + o_orderkey % 3) end as pan_token,
  concat('****', lpad(concat('', o_orderkey % 10000), 4, '0')) as pan_masked,
  case when o_orderkey % 6 = 0 then o_orderkey % 900 end as tip_amount_base_unit,
  case o_orderkey % 13 when 0 then 'insufficient_funds' when 1 then 'do_not_honor' end as decline_reasons,
  case when o_orderkey % 9 = 0 then 'MX' when o_orderkey % 9 = 1 then null else 'US' end as bin_country,
  case when o_orderkey % 8 = 0 then 'PREPAID' else 'NOT_PREPAID' end as bin_prepaid_status,
  case when o_orderkey % 3 = 0 then 'VISA' when o_orderkey % 3 = 1 then 'MASTERCARD' else 'AMEX' end as card_brand,
  case when o_orderkey % 7 = 0 then 'AVS_REJECTED' when o_orderkey % 7 = 1 then null else 'AVS_ACCEPTED' end as auth_avs_status,
  case when o_orderkey % 12 = 0 then 'CVV_REJECTED' else 'CVV_ACCEPTED' end as auth_cvv_status
  from orders""",
    "enrolled_merchant": """select merchant_token, (date '1996-01-01' + cast(merchant_token * 5 % 1000 as integer)) as onboard_date,
  case when cast(floor(merchant_token / 4) as bigint) % 4 >= 2 then (date '1998-10-01' + cast(merchant_token % 400 as integer)) end as offboard_date,
  case cast(floor(merchant_token / 4) as bigint) % 4 when 0 then 'in_trial' when 1 then 'subscribed' when 2 then 'trial_cancelled' else 'churned' end as state
  from (select distinct merchant_token from dim_user) m where merchant_token % 4 = 0""",
    "allowed_payment": "select o_orderkey as payment_token from orders where o_orderkey % 41 = 0",
    "risk_alert": "select o_orderkey as payment_token from orders where o_orderkey % 7 = 0",
    "merchant_signup": """select cast(floor(o_custkey / 3) as bigint) as token, case when o_custkey % 2 = 0 then o_orderdate end as online_signup_at,
  case when cast(floor(o_custkey / 3) as bigint) % 3 <> 0 then o_orderdate end as initially_enrolled_at from orders""",
    "dim_date": """select report_date, cast(date_trunc('week', report_date) as date) as week_begin,
  (cast(date_trunc('week', report_date) as date) + cast(6 as integer)) as week_end
  from (select cast(unnest(generate_series(cast(date_trunc('week', (select min(o_orderdate) from orders)) as date), date '2002-01-01', interval 1 day)) as date) as report_date) s""",
    "user_segment": """select user_token, segment, effective_begin, coalesce((nxt + cast(-1 as integer)), date '2100-01-01') as effective_end
  from (select unit_token as user_token, case when gpv_cents > 25000000 then 'Large' else 'Small' end as segment,
  payment_date as effective_begin, lead(payment_date) over (partition by unit_token order by payment_date) as nxt,
  row_number() over (partition by unit_token order by payment_date) as rn from daily_payment) s where rn % 5 <> 0""",
    "page_view": """select case when event_id % 40 = 0 then '/home' else concat('/dashboard/sales/transactions/', event_id) end as webpage_path,
  cast(floor(user_id / 3) as bigint) as merchant_token, case when event_id % 5 = 0 then 'pos' else 'dashboard' end as app_name,
  'page_view' as catalog_name, case when event_id % 3 = 0 then 'transactions: show list' else 'Home' end as description,
  rec as recorded_at from evt where event_type = 'view'""",
}


def compose(sql: str, relations: dict[str, str]) -> str:
    """Prefix ``sql`` with the relations it names, and those they name, as
    CTEs in the order of ``relations`` (a relation may name earlier ones)."""
    def named(text: str) -> set[str]:
        return {n for n in relations if re.search(rf"\b{n}\b", text)}

    need: set[str] = set()
    todo = list(named(sql))
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo.extend(named(relations[n]) - need)
    ctes = ",\n".join(f"{n} as (\n{relations[n].strip()}\n)" for n in relations if n in need)
    return f"with {ctes}\n{sql.strip()}" if ctes else sql.strip()
