"""Domain relations derived from the base tables.

The reference reads a sportsbook warehouse (bet facts, bonus facts, wallet
snapshots, missions, sessions, predictions, customer dimensions). Those
tables are not available, so each one is derived here from the TPC-H-style
base tables with plain column expressions. The derivations are pure
projections / joins, so their cost grows with the base tables and Catalyst
prunes every column an operator does not use.

Money columns are ``decimal(18,2)`` (the reference declares amounts as
NUMERIC): sums stay exact, so results do not depend on the order in which
partial aggregates are merged. Keys stay ``bigint``.

Each function takes a :class:`~kpiforge.sources.tables.Tables` and returns a
DataFrame whose columns use the reference's column names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.sources.tables import Tables

MONEY = "decimal(18,2)"


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


# --------------------------------------------------------------------------
# Bet fact (kpi_sportsbook_360): one row per bet line.
# --------------------------------------------------------------------------
#: The labels of a bet line, by the table that decides them: column -> (cases, otherwise).
#: The first condition (SQL) that holds gives the label; a NULL comparison does not hold.
BET_LABELS = {
    "lineitem": {
        "bet_combination_status": ([("l_returnflag = 'R'", "REJECTED"), ("l_returnflag = 'A'", "WON")], None),
        "bonus_campaign_type": ([("l_linenumber = 1", "FREE_BET"), ("l_linenumber = 2", "RISK_FREE_BET_FREE_BET"),
                                 ("l_linenumber = 3", "RISK_FREE_BET")], None),
        "wager_type": ([("l_linestatus = 'F'", "PARLAY")], "SINGLE")},
    "part": {
        "league": ([("p_type = 'PROMO'", "NFL"), ("p_type = 'SMALL'", "NBA"), ("p_type = 'LARGE'", "MLB Specials"),
                    ("p_type = 'MEDIUM'", "NHL"), ("p_type = 'STANDARD'", "NCAAF Futures")], "Premier League"),
        "sport": ([("p_size <= 15", "Soccer"), ("p_size <= 25", "Tennis")], "Basketball")},
    "orders": {
        "betslip_status": ([("o_orderstatus = 'F'", "CLOSED"), ("o_orderstatus = 'O'", "OPEN")], None)},
}
_LABELS = {name: label for labels in BET_LABELS.values() for name, label in labels.items()}


def _case(cases, otherwise) -> Column:
    expr = F
    for condition, value in cases:
        expr = expr.when(F.expr(condition), value)
    return expr.otherwise(otherwise)


def _label(name: str) -> Column:
    return _case(*_LABELS[name]).alias(name)


def _label_code(table: str) -> Column:
    """The numbers of the cases that hold for the labels of ``table``, as one number."""
    code = F.lit(0)
    for cases, _ in BET_LABELS[table].values():
        holds = _case([(c, F.lit(i)) for i, (c, _) in enumerate(cases)], F.lit(len(cases)))
        code = code * (len(cases) + 1) + holds
    return code


def _label_codes(table: str) -> int:
    """How many numbers :func:`_label_code` can give."""
    return math.prod(len(cases) + 1 for cases, _ in BET_LABELS[table].values())


#: What stands for NULL in :func:`_line_code`: no int, and no remainder by 100, is as large.
NO_LINE, NO_SUPP = 1 << 31, 100


def _line_code() -> Column:
    """The number of a line (an int) in its order and its supplier's number modulo 100
    (-99 to 99), as one number: the line's times 200, the supplier's from 0."""
    line = F.coalesce(F.col("l_linenumber").cast("bigint"), F.lit(NO_LINE))
    return line * 200 + F.coalesce(F.col("l_suppkey") % 100, F.lit(NO_SUPP)) + 99


def _line_of_code() -> tuple[Column, Column]:
    """(line number, supplier's number modulo 100) from the numbers of line and labels."""
    all_labels = math.prod(_label_codes(t) for t in BET_LABELS)

    def split(code, n):  # code = a * n + b with 0 <= b < n, in whole numbers
        b = F.pmod(code, F.lit(n).cast("bigint"))
        return F.call_function("div", code - b, F.lit(n).cast("bigint")), b
    line, supp = split(split(F.col("labels"), all_labels)[0], 200)
    return F.when(line != NO_LINE, line).cast("int"), F.when(supp != NO_SUPP + 99, supp - 99)


def _label_of_code(name: str) -> Column:
    """The label ``name`` from the numbers of line and labels, those of the tables in the order of BET_LABELS."""
    labels = F.pmod("labels", F.lit(math.prod(_label_codes(t) for t in BET_LABELS)).cast("bigint"))
    below = 1
    for label, (cases, otherwise) in reversed(_LABELS.items()):
        n = len(cases) + 1
        if label == name:
            values = F.array(*[F.lit(v).cast("string") for _, v in [*cases, (None, otherwise)]])
            return F.get(values, F.floor(labels / below).cast("int") % n).alias(name)
        below *= n
    raise KeyError(name)


def _bet_columns(label, partkey, linenumber, supp100) -> list[Column]:
    handle, discount, tax = money("l_extendedprice"), money("l_discount"), money("l_tax")
    return [
        (F.col("l_orderkey") * 10 + linenumber).alias("id"),
        F.col("o_custkey").alias("customer_uid"),
        F.col("l_orderkey").alias("src_betslip_uuid"),
        (F.col("l_orderkey") * 1000 + linenumber * 100 + supp100).alias("bet_id"),
        *[label(n) for n in ("betslip_status", "bet_combination_status", "bonus_campaign_type", "wager_type")],
        F.col("o_orderpriority").alias("sportsbook_source"),
        label("league"), label("sport"),
        partkey.alias("src_campaign_id"),
        handle.alias("handle"),
        (handle * discount).alias("ggr"),
        (handle * (discount - tax)).alias("ngr"),
        (handle * tax).alias("bonus_total"),
        F.col("l_shipdate").alias("ticket_delivery_date"),
        F.col("o_orderdate").alias("kpi_date"),
    ]


def bets(t: Tables) -> DataFrame:
    li, o, p = t["lineitem"], t["orders"], t["part"]
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
            .select(*_bet_columns(_label, F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey") % 100)))


def bet_lines(t: Tables) -> DataFrame:
    """What :func:`bets` derives its columns from, as narrow as its rows can be moved: line,
    supplier and all labels as one number, amounts as exact two-digit decimals, the products
    not yet made. Each table is cut down before the joins; the widest side is joined last."""
    amounts = ("l_extendedprice", "l_discount", "l_tax")
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_shipdate", *[money(c).alias(c) for c in amounts],
                              (_line_code() * _label_codes("lineitem") + _label_code("lineitem")).alias("line_labels"))
    p = t["part"].select("p_partkey", _label_code("part").alias("part_labels"))
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", _label_code("orders").alias("labels"))
    lines = li.join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_partkey", "l_shipdate", *amounts,
        (F.col("line_labels") * _label_codes("part") + F.col("part_labels")).alias("line_labels"))
    return lines.join(o, lines.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_partkey", "l_shipdate", *amounts, "o_custkey", "o_orderpriority", "o_orderdate",
        (F.col("line_labels") * _label_codes("orders") + F.col("labels")).alias("labels"))


def bets_of_lines(lines: DataFrame, *more: str) -> DataFrame:
    """:func:`bets` from :func:`bet_lines`, and the columns ``more`` unchanged."""
    return lines.select(*_bet_columns(_label_of_code, F.col("l_partkey"), *_line_of_code()), *more)


def campaigns(t: Tables) -> DataFrame:
    """dim_campaign: NULL names for large sizes, '_NDB_' names for small ones."""
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("src_campaign_id"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("string"))
         .when(F.col("p_size") < 15, F.concat(F.lit("C_NDB_"), "p_name"))
         .otherwise(F.concat(F.lit("C_"), "p_name")).alias("name"),
        F.when(F.col("p_type") == "PROMO", "MONEY")
         .when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("type"),
    )


def bonuses(t: Tables) -> DataFrame:
    """kpi_bonus_360: one bonus transaction per order."""
    o = t["orders"]
    total = money("o_totalprice")
    return o.select(
        F.col("o_custkey").alias("customer_uid"),
        F.col("o_orderkey").alias("src_bonus_id"),
        (F.col("o_orderkey") % 2100).alias("src_campaign_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"), "BONUS_DEPOSIT")
         .otherwise("BONUS_PAYOUT").alias("wallet_transaction_type"),
        F.when(F.col("o_orderstatus") == "F", "BET_SLIP_PLACEMENT")
         .otherwise("OTHER").alias("wallet_transaction_type_action"),
        F.when(F.col("o_orderkey") % 4 == 0, "RISK_FREE_BET")
         .when(F.col("o_orderkey") % 4 == 1, "FREE_BET")
         .when(F.col("o_orderkey") % 4 == 2, "RISK_FREE_BET_FREE_BET").alias("bonus_campaign_type"),
        F.when(F.col("o_orderstatus") == "P", total)
         .otherwise(F.lit(0).cast(MONEY)).alias("bonus_idle"),
        (total * F.lit(0.10).cast("decimal(3,2)")).alias("bonus_cost"),
        (total * F.lit(0.05).cast("decimal(3,2)")).alias("bonus_claimed"),
        F.col("o_orderdate").alias("transaction_created_date"),
    )


def wallets(t: Tables) -> DataFrame:
    """dim_wallet: a USER wallet and a BONUS (or HOUSE) wallet per customer."""
    c = t["customer"]
    user = c.select((F.col("c_custkey") * 2).alias("wallet_id"),
                    F.col("c_custkey").alias("owner_id"),
                    F.lit("USER").alias("wallet_owner_type"))
    bonus = c.select((F.col("c_custkey") * 2 + 1).alias("wallet_id"),
                     F.col("c_custkey").alias("owner_id"),
                     F.when(F.col("c_custkey") % 5 == 0, "HOUSE")
                      .otherwise("BONUS").alias("wallet_owner_type"))
    return user.unionByName(bonus)


def balances(t: Tables) -> DataFrame:
    """fact_wallet_balance: end-of-day balance snapshots."""
    o = t["orders"]
    return o.select(
        (F.col("o_custkey") * 2 + F.col("o_orderkey") % 2).alias("wallet_id"),
        F.col("o_orderkey").alias("balance_id"),
        money("o_totalprice").alias("end_balance"),
        F.to_date("o_orderdate").alias("balanceasofdate"),
    )


# Settled-bet chain: slip -> bet -> (slip, bet) mapping -> combination status.
def slips(t: Tables) -> DataFrame:
    return t["orders"].select(F.col("o_orderkey").alias("src_betslip_uuid"),
                              F.col("o_custkey").alias("customer_uid"),
                              F.col("o_orderdate").alias("ticket_delivery_date"))


def slip_bets(t: Tables) -> DataFrame:
    return t["lineitem"].select(F.col("l_orderkey").alias("src_betslip_uuid"),
                                F.col("l_linenumber").alias("bet_id")).distinct()


def bet_map(t: Tables) -> DataFrame:
    return t["lineitem"].select(F.col("l_orderkey").alias("src_betslip_uuid"),
                                F.col("l_linenumber").alias("bet_id"),
                                F.col("l_partkey").alias("bet_combination_id"))


def combinations(t: Tables) -> DataFrame:
    return t["part"].select(
        F.col("p_partkey").alias("bet_combination_id"),
        F.when(F.col("p_type") == "PROMO", "WON").when(F.col("p_type") == "SMALL", "LOST")
         .otherwise("OPEN").alias("bet_combination_status"))


def missions(t: Tables) -> DataFrame:
    """kpi_mission_activity."""
    e = t["events"]
    return e.select(
        F.col("user_id").alias("customer_uid"),
        (F.col("event_id") % 997).alias("assignment_id"),
        F.when(F.col("event_type") == "purchase", "COMPLETED")
         .when(F.col("event_type") == "click", "EXPIRED").alias("finished_reason"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("assignment_completed_timestamp"),
        F.when(F.col("event_type") != "view", money("value")).alias("payout_value_lc"),
    )


def sessions(t: Tables) -> DataFrame:
    """kpi_session_view (already sessionised upstream)."""
    e = t["events"]
    return e.select(F.col("user_id").alias("customer_uid"),
                    (F.col("event_id") % 1009).alias("session_group_id"),
                    F.floor("value").cast("bigint").alias("session_length_seconds"))


def bonus_activity(t: Tables) -> DataFrame:
    """fact_bonus_activity: purchase events are bonus dispatches."""
    e = t["events"]
    return e.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_uid"),
        F.when(F.col("event_type") == "purchase", "bonus-dispatch")
         .otherwise(F.col("event_type")).alias("subtype"),
        F.when(F.col("value") >= 5, 1).otherwise(0).alias("value"),
        F.get_json_object("props", "$.k").alias("src_campaign_id"),
        F.col("ts").alias("message_timestamp"),
    )


def predictions(t: Tables) -> DataFrame:
    """predicted_revenue: some customers have a zero base (epsilon branch)."""
    c = t["customer"]
    base = F.greatest(money("c_acctbal"), F.lit(0).cast(MONEY))
    return c.select(
        F.col("c_custkey").alias("player_key"),
        base.alias("predicted_revenue_next_30"),
        (base * F.lit(1.1).cast("decimal(2,1)") + F.col("c_nationkey")).alias("predicted_revenue_next_30_bonus"),
        (base * F.lit(0.03).cast("decimal(3,2)")).alias("predicted_revenue_next_active_day"),
        F.col("c_mktsegment").alias("predicted_revenue_segment"),
        (F.col("c_nationkey") % 7).cast("bigint").alias("pred_real_money_active_days_next30_bonus_0"),
        (F.col("c_nationkey") % 7 + 1).cast("bigint").alias("pred_real_money_active_days_next30_bonus_1"),
    )


def customers(t: Tables) -> DataFrame:
    """dim_customer_unified: keys, dates, profile, restriction and value columns."""
    c = t["customer"]
    uid, nation = F.col("c_custkey"), F.col("c_nationkey")
    balance = money("c_acctbal")
    excluded, suspended = uid % 50 == 0, uid % 60 == 0
    reg = F.date_add(F.lit("1994-06-01").cast("date"), (F.col("c_custkey") % 200).cast("int"))
    return c.select(
        F.col("c_name").alias("customer_id"),
        F.col("c_custkey").alias("customer_uid"),
        reg.alias("registration_date"),
        reg.alias("created"),
        F.when(F.col("c_acctbal") > 0, F.date_add(reg, 3)).alias("ftd_date"),
        reg.cast("timestamp").alias("etl_created"),
        reg.cast("timestamp").alias("etl_modified"),
        F.col("c_mktsegment").alias("acquisition_channel"),
        (F.col("c_acctbal") < 0).alias("is_test_player"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Wiseguy")
         .when(F.col("c_mktsegment") == "FURNITURE", "Monitoring 1")
         .when(F.col("c_mktsegment") == "HOUSEHOLD", "D")
         .otherwise(F.col("c_mktsegment")).alias("punter_category_current"),
        F.col("c_nationkey").alias("profile_country_uid"),
        F.when(F.col("c_acctbal") < 1000, "18-25").when(F.col("c_acctbal") < 5000, "26-40")
         .otherwise("41+").alias("age_group"),
        (F.col("c_acctbal") < 100).alias("is_locked"),
        F.lower("c_name").alias("alias"),
        F.concat(F.lit("country_"), nation.cast("string")).alias("profile_country_name"),
        F.lower("c_mktsegment").alias("brand_alias"),
        F.when(uid % 3 == 0, "F").when(uid % 3 == 1, "M").alias("profile_gender"),
        (uid % 12 + 1).cast("bigint").alias("profile_month_of_birth"),
        (uid % 100).cast("bigint").alias("sb_ngr_percentile_last12months"),
        (F.col("c_acctbal") < 50).alias("flag_rg"),
        F.when(F.col("c_acctbal") < 100, F.date_add(reg, 365)).alias("locked_until"),
        F.when(F.col("c_acctbal") < 0, "high").when(F.col("c_acctbal") < 5000, "medium")
         .otherwise("low").alias("predicted_risk_category_latest"),
        F.when(uid % 4 == 0, "sports").when(uid % 4 == 1, "casino").alias("profile_welcome_offer"),
        excluded.alias("self_exclusion_flag"),
        (uid % 40 == 0).alias("is_bonus_abuser"),
        suspended.alias("is_suspended"),
        F.concat(F.lit("P"), uid.cast("string")).alias("person_id"),
        (nation % 4).cast("bigint").alias("license_uid"),
        F.concat(F.lit("entity_"), (nation % 4).cast("string")).alias("legal_entity"),
        (F.col("c_acctbal") < 0).alias("deposit_disabled"),
        suspended.alias("login_disabled"),
        excluded.alias("play_sports_disabled"),
        (uid % 40 == 0).alias("receive_sports_promotions_disabled"),
        (F.col("c_acctbal") < -500).alias("withdraw_disabled"),
        F.when(excluded, (uid % 365).cast("bigint")).alias("longest_restriction"),
        F.when(excluded, F.date_add(reg, (uid % 365).cast("int"))).alias("longest_restriction_valid_to"),
        F.when(excluded, "self_exclusion").when(suspended, "suspension").alias("longest_restriction_type"),
        balance.cast("double").alias("player_sb_ngr_last12months"),
        (balance * F.lit(3).cast("decimal(1,0)")).cast("double").alias("player_cs_ngr_last12months"),
    )


def segmentation(t: Tables) -> DataFrame:
    """marketing_segmentation_metrics: no row for MACHINERY customers."""
    c = t["customer"].filter(F.col("c_mktsegment") != "MACHINERY")
    return c.select(
        F.col("c_custkey").alias("customer_uid"),
        money("c_acctbal").alias("predicted_margin"),
        F.col("c_nationkey").cast("bigint").alias("cross_product_historical_value_score_current"),
        F.col("c_mktsegment").alias("cross_product_historical_value_segment_current"),
        (F.col("c_nationkey") % 5).cast("bigint").alias("sports_historical_value_score_current"),
        F.substring("c_mktsegment", 1, 3).alias("sports_historical_value_segment_current"),
        (F.col("c_nationkey") % 3).cast("bigint").alias("casino_historical_value_score_current"),
        F.lower("c_mktsegment").alias("casino_historical_value_segment_current"),
        (money("c_acctbal") * F.lit(0.5).cast("decimal(2,1)")).alias("daily_active_handle"),
        (money("c_acctbal") * F.lit(12).cast("decimal(2,0)")).alias("lifetime_handle"),
        (F.col("c_nationkey") + 1).cast("bigint").alias("lifetime_bets"),
    )


def classification(t: Tables) -> DataFrame:
    """fact_customer_classification (keyed by customer_id); none for BUILDING."""
    c = t["customer"].filter(F.col("c_mktsegment") != "BUILDING")
    return c.select(F.col("c_name").alias("customer_id"),
                    F.col("c_nationkey").alias("classification_id"),
                    (F.col("c_acctbal") > 5000).alias("manually_classified"))


def classification_ref(t: Tables) -> DataFrame:
    """ref_customer_classification: nations of region 4 have no entry."""
    n = t["nation"].filter(F.col("n_regionkey") != 4)
    return n.select(F.col("n_nationkey").alias("classification_id"),
                    F.col("n_name").alias("classification_name"))


def rating(t: Tables) -> DataFrame:
    """rating: theoretical margins per customer (uuid)."""
    c = t["customer"]
    bal = money("c_acctbal")
    return c.select(
        F.col("c_custkey").alias("uuid"),
        (bal * F.lit(0.001).cast("decimal(4,3)")).alias("margin"),
        (bal * F.lit(0.002).cast("decimal(4,3)")).alias("margin_prematch"),
        (bal * F.lit(0.003).cast("decimal(4,3)")).alias("margin_live"),
        (F.col("c_nationkey") * 10).cast("bigint").alias("betsize_prematch"),
        (F.col("c_nationkey") * 20).cast("bigint").alias("betsize_live"),
    )


def sportsbook_stats(t: Tables) -> DataFrame:
    """dim_customer_sportsbook_statistics."""
    c = t["customer"]
    return c.select(
        F.col("c_custkey").alias("customer_uid"),
        F.abs(money("c_acctbal")).alias("first_betslip_stake"),
        (F.col("c_nationkey") * 3).cast(MONEY).alias("last_betslip_stake"),
        (F.col("c_nationkey") % 5 + 1).cast("bigint").alias("totalaveragecombi"),
    )


# --------------------------------------------------------------------------
# Activity feeds for the monthly status model.
# --------------------------------------------------------------------------
def sportsbook_feed(t: Tables) -> DataFrame:
    """fact_sportsbook: slips with their delivery timestamp."""
    return t["orders"].select(F.col("o_custkey").alias("customer_uid"),
                              F.col("o_orderdate").alias("ticket_delivery_date"))


def second_feed(t: Tables) -> DataFrame:
    """The second activity source: delivery date missing on 'view' rows (falls
    back to kpi_date), customer missing on low-value signups ('Undefined')."""
    e = t["events"]
    return e.select(
        F.when((F.col("event_type") == "signup") & (F.col("value") < 2), F.lit(None).cast("bigint"))
         .otherwise(F.col("user_id")).alias("customer_uid"),
        F.when(F.col("event_type") != "view", F.col("ts")).alias("ticket_delivery_date"),
        F.col("ts").alias("kpi_date"),
    )


class Domain:
    """Named access to the domain relations of one base-table folder.

    ``Domain(tables).bets`` etc.; each relation is built once per object so
    every use in a plan refers to the same logical subtree.
    """

    RELATIONS = (
        "bets", "campaigns", "bonuses", "wallets", "balances", "slips", "slip_bets", "bet_map",
        "combinations", "missions", "sessions", "bonus_activity", "predictions", "customers",
        "segmentation", "classification", "classification_ref", "rating", "sportsbook_stats",
        "sportsbook_feed", "second_feed", "events_level",
    )

    def __init__(self, tables: Tables, overrides: dict | None = None):
        self.tables = tables
        self._built: dict[str, DataFrame] = dict(overrides or {})

    def __getattr__(self, name: str) -> DataFrame:
        if name not in type(self).RELATIONS:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = globals()[name](self.tables)
        return self._built[name]


# --------------------------------------------------------------------------
# Event-level table under a declared contract (one row per bet line).
# Columns are produced by rule from the contract's declared types; a few are
# deliberately off-contract so the checks have something to find:
# ``cashout_count`` is an int (declared int64), ``requested_display_odds`` a
# double (declared BIGNUMERIC), ``last_updated_date`` is NULL on returned
# open lines, and ``id`` repeats wherever (order, line) does in the data.
# --------------------------------------------------------------------------
def events_level(t: Tables) -> DataFrame:
    from kpiforge.operators.contract import EVENTS_LEVEL

    li, o = t["lineitem"], t["orders"]
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    special = {
        "id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "event_id": F.col("l_partkey").cast("string"),
        "customer_uid": F.col("o_custkey").cast("string"),
        "src_betslip_uuid": F.col("o_orderkey").cast("string"),
        "bet_id": F.col("l_linenumber").cast("string"),
        "betslip_status": F.col("o_orderstatus"),
        "bet_combination_status": F.col("l_returnflag"),
        "ticket_delivery_date": F.col("l_shipdate").cast("timestamp"),
        "last_updated_date": F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
                                    F.lit(None).cast("timestamp")).otherwise(F.col("o_orderdate").cast("timestamp")),
        "start_date": F.col("o_orderdate").cast("timestamp"),
        "kpi_timestamp_id": F.to_date("o_orderdate"),
        "originproviderid": F.col("l_suppkey").cast("bigint"),
        "cashout_count": F.col("l_linenumber").cast("int"),
        "requested_display_odds": (F.col("l_discount") + 1.0).cast("double"),
    }
    amount = money("l_extendedprice").cast("decimal(38,9)")
    cols = []
    for c in EVENTS_LEVEL.columns:
        if c.name in special:
            expr = special[c.name]
        else:
            kind = c.data_type.lower()
            if kind == "string":
                expr = F.concat(F.lit(c.name[:3] + "_"), F.col("l_linenumber").cast("string"))
            elif kind in ("numeric", "bignumeric"):
                expr = amount
            elif kind == "timestamp":
                expr = F.col("l_shipdate").cast("timestamp")
            elif kind == "date":
                expr = F.to_date("l_shipdate")
            else:
                expr = F.col("l_linenumber").cast("bigint")
        cols.append(expr.alias(c.name))
    return j.select(*cols)


def customer_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two versions of a per-customer order profile for the reconciliation
    operators: over all orders ("old") and without pending orders ("new")."""
    def profile(o: DataFrame) -> DataFrame:
        return o.groupBy(F.col("o_custkey").alias("customer_uid")).agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum(money("o_totalprice")).cast("double").alias("total_price"),
            F.min(F.to_date("o_orderdate")).alias("first_order_date"),
            F.max(F.to_date("o_orderdate")).alias("last_order_date"),
            F.min("o_orderpriority").alias("top_priority"))
    o = t["orders"]
    return profile(o), profile(o.filter(F.col("o_orderstatus") != "P"))
