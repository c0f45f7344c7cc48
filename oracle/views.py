"""DuckDB SQL for the domain relations (the oracle side of
:mod:`kpiforge.sources.domain`), written independently in plain SQL.

Only the base tables are registered in the checking engine, so every oracle
query inlines the views it uses as CTEs (:func:`with_views`).
"""

from __future__ import annotations

import re

MONEY = "DECIMAL(18,2)"

VIEWS: dict[str, str] = {
    "bets": f"""
select l.l_orderkey*10 + l.l_linenumber as id, o.o_custkey as customer_uid,
  o.o_orderkey as src_betslip_uuid,
  l.l_orderkey*1000 + l.l_linenumber*100 + l.l_suppkey%100 as bet_id,
  case o.o_orderstatus when 'F' then 'CLOSED' when 'O' then 'OPEN' end as betslip_status,
  case l.l_returnflag when 'R' then 'REJECTED' when 'A' then 'WON' end as bet_combination_status,
  case l.l_linenumber when 1 then 'FREE_BET' when 2 then 'RISK_FREE_BET_FREE_BET'
       when 3 then 'RISK_FREE_BET' end as bonus_campaign_type,
  case when l.l_linestatus = 'F' then 'PARLAY' else 'SINGLE' end as wager_type,
  o.o_orderpriority as sportsbook_source,
  case p.p_type when 'PROMO' then 'NFL' when 'SMALL' then 'NBA' when 'LARGE' then 'MLB Specials'
       when 'MEDIUM' then 'NHL' when 'STANDARD' then 'NCAAF Futures' else 'Premier League' end as league,
  case when p.p_size <= 15 then 'Soccer' when p.p_size <= 25 then 'Tennis' else 'Basketball' end as sport,
  l.l_partkey as src_campaign_id,
  cast(l.l_extendedprice as {MONEY}) as handle,
  cast(l.l_extendedprice as {MONEY}) * cast(l.l_discount as {MONEY}) as ggr,
  cast(l.l_extendedprice as {MONEY}) * (cast(l.l_discount as {MONEY}) - cast(l.l_tax as {MONEY})) as ngr,
  cast(l.l_extendedprice as {MONEY}) * cast(l.l_tax as {MONEY}) as bonus_total,
  l.l_shipdate as ticket_delivery_date, o.o_orderdate as kpi_date
from lineitem l join orders o on l.l_orderkey = o.o_orderkey join part p on p.p_partkey = l.l_partkey""",
    "campaigns": """
select p_partkey as src_campaign_id,
  case when p_size > 45 then null when p_size < 15 then 'C_NDB_' || p_name else 'C_' || p_name end as name,
  case p_type when 'PROMO' then 'MONEY' when 'ECONOMY' then null else p_type end as type
from part""",
    "bonuses": f"""
select o_custkey as customer_uid, o_orderkey as src_bonus_id, o_orderkey % 2100 as src_campaign_id,
  case when o_orderpriority in ('1-URGENT','2-HIGH','3-MEDIUM') then 'BONUS_DEPOSIT' else 'BONUS_PAYOUT' end
    as wallet_transaction_type,
  case when o_orderstatus = 'F' then 'BET_SLIP_PLACEMENT' else 'OTHER' end as wallet_transaction_type_action,
  case o_orderkey % 4 when 0 then 'RISK_FREE_BET' when 1 then 'FREE_BET' when 2 then 'RISK_FREE_BET_FREE_BET' end
    as bonus_campaign_type,
  case when o_orderstatus = 'P' then cast(o_totalprice as {MONEY}) else cast(0 as {MONEY}) end as bonus_idle,
  cast(o_totalprice as {MONEY}) * 0.10 as bonus_cost,
  cast(o_totalprice as {MONEY}) * 0.05 as bonus_claimed,
  o_orderdate as transaction_created_date
from orders""",
    "wallets": """
select c_custkey*2 as wallet_id, c_custkey as owner_id, 'USER' as wallet_owner_type from customer
union all
select c_custkey*2 + 1, c_custkey, case when c_custkey % 5 = 0 then 'HOUSE' else 'BONUS' end from customer""",
    "balances": f"""
select o_custkey*2 + o_orderkey % 2 as wallet_id, o_orderkey as balance_id,
  cast(o_totalprice as {MONEY}) as end_balance, cast(o_orderdate as date) as balanceasofdate
from orders""",
    "slips": "select o_orderkey as src_betslip_uuid, o_custkey as customer_uid from orders",
    "slip_bets": "select distinct l_orderkey as src_betslip_uuid, l_linenumber as bet_id from lineitem",
    "bet_map": """
select l_orderkey as src_betslip_uuid, l_linenumber as bet_id, l_partkey as bet_combination_id from lineitem""",
    "combinations": """
select p_partkey as bet_combination_id,
  case p_type when 'PROMO' then 'WON' when 'SMALL' then 'LOST' else 'OPEN' end as bet_combination_status
from part""",
    "missions": f"""
select user_id as customer_uid, event_id % 997 as assignment_id,
  case event_type when 'purchase' then 'COMPLETED' when 'click' then 'EXPIRED' end as finished_reason,
  case when event_type <> 'error' then ts end as assignment_completed_timestamp,
  case when event_type <> 'view' then cast(value as {MONEY}) end as payout_value_lc
from events""",
    "sessions": """
select user_id as customer_uid, event_id % 1009 as session_group_id,
  cast(floor(value) as bigint) as session_length_seconds
from events""",
    "bonus_activity": """
select event_id, user_id as customer_uid,
  case when event_type = 'purchase' then 'bonus-dispatch' else event_type end as subtype,
  case when value >= 5 then 1 else 0 end as value,
  json_extract_string(props, '$.k') as src_campaign_id, ts as message_timestamp
from events""",
    "predictions": f"""
select c_custkey as player_key,
  greatest(cast(c_acctbal as {MONEY}), cast(0 as {MONEY})) as predicted_revenue_next_30,
  greatest(cast(c_acctbal as {MONEY}), cast(0 as {MONEY})) * 1.1 + c_nationkey as predicted_revenue_next_30_bonus,
  greatest(cast(c_acctbal as {MONEY}), cast(0 as {MONEY})) * 0.03 as predicted_revenue_next_active_day,
  c_mktsegment as predicted_revenue_segment,
  cast(c_nationkey % 7 as bigint) as pred_real_money_active_days_next30_bonus_0,
  cast(c_nationkey % 7 + 1 as bigint) as pred_real_money_active_days_next30_bonus_1
from customer""",
    "customers": """
select c_name as customer_id, c_custkey as customer_uid,
  cast(date '1994-06-01' + cast(c_custkey % 200 as integer) as date) as registration_date,
  cast(date '1994-06-01' + cast(c_custkey % 200 as integer) as date) as created,
  case when c_acctbal > 0 then cast(date '1994-06-01' + cast(c_custkey % 200 as integer) + 3 as date) end as ftd_date,
  cast(date '1994-06-01' + cast(c_custkey % 200 as integer) as timestamp) as etl_created,
  cast(date '1994-06-01' + cast(c_custkey % 200 as integer) as timestamp) as etl_modified,
  c_mktsegment as acquisition_channel,
  c_acctbal < 0 as is_test_player,
  case c_mktsegment when 'AUTOMOBILE' then 'Wiseguy' when 'FURNITURE' then 'Monitoring 1'
       when 'HOUSEHOLD' then 'D' else c_mktsegment end as punter_category_current,
  c_nationkey as profile_country_uid,
  case when c_acctbal < 1000 then '18-25' when c_acctbal < 5000 then '26-40' else '41+' end as age_group,
  c_acctbal < 100 as is_locked,
  lower(c_name) as alias,
  'country_' || c_nationkey as profile_country_name,
  lower(c_mktsegment) as brand_alias,
  case c_custkey % 3 when 0 then 'F' when 1 then 'M' end as profile_gender,
  cast(c_custkey % 12 + 1 as bigint) as profile_month_of_birth,
  cast(c_custkey % 100 as bigint) as sb_ngr_percentile_last12months,
  c_acctbal < 50 as flag_rg,
  case when c_acctbal < 100
       then cast(date '1994-06-01' + cast(c_custkey % 200 as integer) + 365 as date) end as locked_until,
  case when c_acctbal < 0 then 'high' when c_acctbal < 5000 then 'medium' else 'low' end
    as predicted_risk_category_latest,
  case c_custkey % 4 when 0 then 'sports' when 1 then 'casino' end as profile_welcome_offer,
  c_custkey % 50 = 0 as self_exclusion_flag,
  c_custkey % 40 = 0 as is_bonus_abuser,
  c_custkey % 60 = 0 as is_suspended,
  'P' || c_custkey as person_id,
  cast(c_nationkey % 4 as bigint) as license_uid,
  'entity_' || (c_nationkey % 4) as legal_entity,
  c_acctbal < 0 as deposit_disabled,
  c_custkey % 60 = 0 as login_disabled,
  c_custkey % 50 = 0 as play_sports_disabled,
  c_custkey % 40 = 0 as receive_sports_promotions_disabled,
  c_acctbal < -500 as withdraw_disabled,
  case when c_custkey % 50 = 0 then cast(c_custkey % 365 as bigint) end as longest_restriction,
  case when c_custkey % 50 = 0
       then cast(date '1994-06-01' + cast(c_custkey % 200 as integer) + cast(c_custkey % 365 as integer) as date) end
    as longest_restriction_valid_to,
  case when c_custkey % 50 = 0 then 'self_exclusion' when c_custkey % 60 = 0 then 'suspension' end
    as longest_restriction_type,
  cast(cast(c_acctbal as decimal(18,2)) as double) as player_sb_ngr_last12months,
  cast(cast(c_acctbal as decimal(18,2)) * 3 as double) as player_cs_ngr_last12months
from customer""",
    "segmentation": f"""
select c_custkey as customer_uid, cast(c_acctbal as {MONEY}) as predicted_margin,
  cast(c_nationkey as bigint) as cross_product_historical_value_score_current,
  c_mktsegment as cross_product_historical_value_segment_current,
  cast(c_nationkey % 5 as bigint) as sports_historical_value_score_current,
  substr(c_mktsegment, 1, 3) as sports_historical_value_segment_current,
  cast(c_nationkey % 3 as bigint) as casino_historical_value_score_current,
  lower(c_mktsegment) as casino_historical_value_segment_current,
  cast(c_acctbal as {MONEY}) * 0.5 as daily_active_handle,
  cast(c_acctbal as {MONEY}) * 12 as lifetime_handle,
  cast(c_nationkey + 1 as bigint) as lifetime_bets
from customer where c_mktsegment <> 'MACHINERY'""",
    "classification": """
select c_name as customer_id, c_nationkey as classification_id, c_acctbal > 5000 as manually_classified
from customer where c_mktsegment <> 'BUILDING'""",
    "classification_ref": """
select n_nationkey as classification_id, n_name as classification_name from nation where n_regionkey <> 4""",
    "rating": f"""
select c_custkey as uuid, cast(c_acctbal as {MONEY}) * 0.001 as margin,
  cast(c_acctbal as {MONEY}) * 0.002 as margin_prematch, cast(c_acctbal as {MONEY}) * 0.003 as margin_live,
  cast(c_nationkey * 10 as bigint) as betsize_prematch, cast(c_nationkey * 20 as bigint) as betsize_live
from customer""",
    "sportsbook_stats": f"""
select c_custkey as customer_uid, abs(cast(c_acctbal as {MONEY})) as first_betslip_stake,
  cast(c_nationkey * 3 as {MONEY}) as last_betslip_stake,
  cast(c_nationkey % 5 + 1 as bigint) as totalaveragecombi
from customer""",
    "sportsbook_feed": "select o_custkey as customer_uid, o_orderdate as ticket_delivery_date from orders",
    "second_feed": """
select case when event_type = 'signup' and value < 2 then null else user_id end as customer_uid,
  case when event_type <> 'view' then ts end as ticket_delivery_date, ts as kpi_date
from events""",
    "profile_old": f"""
select o_custkey as customer_uid, count(*) as order_count,
  cast(sum(cast(o_totalprice as {MONEY})) as double) as total_price,
  min(cast(o_orderdate as date)) as first_order_date, max(cast(o_orderdate as date)) as last_order_date,
  min(o_orderpriority) as top_priority
from orders group by o_custkey""",
    "profile_new": f"""
select o_custkey as customer_uid, count(*) as order_count,
  cast(sum(cast(o_totalprice as {MONEY})) as double) as total_price,
  min(cast(o_orderdate as date)) as first_order_date, max(cast(o_orderdate as date)) as last_order_date,
  min(o_orderpriority) as top_priority
from orders where o_orderstatus <> 'P' group by o_custkey""",
    "events_level_keys": """
select cast(l.l_orderkey as varchar) || '-' || cast(l.l_linenumber as varchar) as id,
  case when l.l_returnflag = 'R' and l.l_linestatus = 'O' then null
       else cast(o.o_orderdate as timestamp) end as last_updated_date,
  cast(o.o_custkey as varchar) as customer_uid, cast(l.l_linenumber as bigint) as cashout_count,
  l.l_discount + 1.0 as requested_display_odds, cast(cast(l.l_extendedprice as decimal(18,2)) as double) as prorated_stake,
  cast(o.o_orderdate as timestamp) as start_date
from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
}

BASE = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations"}


def _refs(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def with_views(body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the view CTEs it (and ``ctes``) reference,
    followed by the query's own CTEs in the given order."""
    ctes = ctes or []
    if body.startswith("with "):  # a statement with its own CTEs
        body = f"select * from ({body})"
    own = {n for n, _ in ctes}
    text = body + " ".join(s for _, s in ctes)
    needed: list[str] = []
    frontier = _refs(text, [v for v in VIEWS if v not in own])
    while frontier:
        v = frontier.pop()
        if v in needed:
            continue
        needed.append(v)
        frontier += _refs(VIEWS[v], [w for w in VIEWS if w != v and w not in own])
    parts = [f"{v} as ({VIEWS[v]}\n)" for v in VIEWS if v in needed]
    parts += [f"{n} as ({s}\n)" for n, s in ctes]
    return ("with " + ",\n".join(parts) + "\n" + body) if parts else body
