"""Customer-grain measures over the bet fact.

One catalog of named measures (:func:`base_measures` + ``DERIVED``) serves
every bet query: a query picks the names it needs and they are evaluated in
one aggregation per customer (conditional aggregation), the way the reference
folds a dozen metrics into one GROUP BY. The DISTINCT counts run through
:func:`~kpiforge.operators.grained.grained_agg` (one row copy per distinct
grain instead of one per distinct expression). Catalyst prunes the bet
columns to what the chosen measures read.

Money sums stay ``decimal`` (exact, order independent) and are exposed as
``double``; ratios divide the exact sums once, in double.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import guarded_ratio, label
from kpiforge.functions.predicates import (
    days_ago_at_most, on_day_before, real_money, settled_slip, valid_bet, within_days,
)

from kpiforge.operators.grained import Distinct, DistinctList, Plain, grained_agg
from kpiforge.operators.leagues import league_group, league_scope

KEY = "customer_uid"


def valid_bets(bets: DataFrame) -> DataFrame:
    """The shared valid-bet filter."""
    return bets.filter(valid_bet())


def valid_bets_with_campaign(bets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """S3: valid bets enriched with the campaign name and type (left join on
    the campaign id; the dimension is unique per id, so no row multiplies)."""
    camp = campaigns.select("src_campaign_id", F.col("name").alias("campaign_name"),
                            F.col("type").alias("campaign_type"))
    return valid_bets(bets).join(camp, "src_campaign_id", "left")


def bet_grains(as_of) -> dict[str, Column]:
    """Distinct-value grains of the bet KPIs (``league``: the league group of
    rows inside the 12-month league report scope)."""
    return {"day": F.to_date("ticket_delivery_date"), "slip": F.col("src_betslip_uuid"),
            "bet": F.col("bet_id"), "source": F.col("sportsbook_source"),
            "league": F.when(league_scope(as_of), league_group())}


def base_measures(as_of) -> dict[str, Plain | Distinct | DistinctList]:
    """Aggregates over (valid) bets for clock ``as_of``, before derivation."""
    tdd, kpi = "ticket_delivery_date", "kpi_date"
    day = F.to_date(tdd)
    l30 = days_ago_at_most(tdd, as_of, 30)
    rm = real_money()
    in7, in30 = within_days(kpi, as_of, 7), within_days(kpi, as_of, 30)
    handle, ggr, cost, ngr = F.col("handle"), F.col("ggr"), F.col("bonus_total"), F.col("ngr")

    def when_null(cond, c):   # CASE WHEN cond THEN c END  (sum is NULL if none)
        return F.when(cond, c)

    def when_zero(cond, c):   # CASE WHEN cond THEN c ELSE 0 END
        return F.when(cond, c).otherwise(F.lit(0))

    return {
        "handle_lt": Plain("sum", handle),
        "ggr_lt": Plain("sum", ggr),
        "bonus_cost_lt": Plain("sum", cost),
        "ngr_lt": Plain("sum", ngr),
        "active_days_lt": Distinct("day"),
        "handle_l30": Plain("sum", when_null(l30, handle)),
        "ggr_l30": Plain("sum", when_null(l30, ggr)),
        "bonus_cost_l30": Plain("sum", when_null(l30, cost)),
        "ngr_l30": Plain("sum", when_null(l30, ngr)),
        "active_days_l30": Distinct("day", l30),
        "first_sports_bet_date": Plain("min", day),
        "last_sports_bet_date": Plain("max", day),
        "bet_count_total": Distinct("slip"),
        "real_money_bet_cnt_lifetime": Distinct("bet", rm),
        "real_money_bet_cnt_last7": Distinct("bet", rm & in7),
        "real_money_bet_cnt_last30": Distinct("bet", rm & in30),
        "previous_day_ggr": Plain("sum", when_zero(on_day_before(kpi, as_of), ggr)),
        "_rm_handle": Plain("sum", when_zero(rm, handle)),
        "_handle_7": Plain("sum", when_zero(in7, handle)),
        "_rm_handle_7": Plain("sum", when_zero(rm & in7, handle)),
        "_handle_30": Plain("sum", when_zero(in30, handle)),
        "_rm_handle_30": Plain("sum", when_zero(rm & in30, handle)),
        "sportsbook_sources": DistinctList("source", ","),
        "placed_a_parlay_bet": Plain("bool_or", (F.col("wager_type") == "PARLAY") & (handle > 0)),
        "league_list": DistinctList("league", "/", descending=True, upper=True),
    }


# Derived measures: name -> (base measures used, expression over them).
DERIVED = {
    "turnover": (["handle_lt"], lambda: F.coalesce(F.col("handle_lt"), F.lit(0))),
    "average_bet_amount": (["handle_lt", "bet_count_total"],
                           lambda: guarded_ratio(F.coalesce(F.col("handle_lt"), F.lit(0)), "bet_count_total")),
    "real_money_pct_lifetime": (["_rm_handle", "handle_lt"], lambda: guarded_ratio("_rm_handle", "handle_lt")),
    "real_money_pct_7": (["_rm_handle_7", "_handle_7"], lambda: guarded_ratio("_rm_handle_7", "_handle_7")),
    "real_money_pct_30": (["_rm_handle_30", "_handle_30"], lambda: guarded_ratio("_rm_handle_30", "_handle_30")),
    "bet_sports": ([], lambda: F.lit(True)),
}

# Measures whose exact decimal sum is exposed as double.
MONEY_MEASURES = {
    "handle_lt", "ggr_lt", "bonus_cost_lt", "ngr_lt", "handle_l30", "ggr_l30",
    "bonus_cost_l30", "ngr_l30", "turnover", "previous_day_ggr",
}


def customer_measures(bets: DataFrame, as_of, names: Iterable[str], key: str = KEY,
                      money_as_double: bool = True) -> DataFrame:
    """Named measures per ``key`` in one two-level aggregation
    (:func:`kpiforge.operators.grained.grained_agg`)."""
    names = list(names)
    base = base_measures(as_of)
    need: list[str] = []
    for n in names:
        for b in (DERIVED[n][0] if n in DERIVED else [n]):
            if b not in need:
                need.append(b)
    agg = grained_agg(bets, key, bet_grains(as_of), {b: base[b] for b in need})
    cols = [F.col(key)]
    for n in names:
        c = DERIVED[n][1]() if n in DERIVED else F.col(n)
        if money_as_double and n in MONEY_MEASURES:
            c = c.cast("double")
        cols.append(c.alias(n))
    return agg.select(*cols)


# Names grouped the way the reference's CTEs group them.
LIFETIME = ["handle_lt", "ggr_lt", "bonus_cost_lt", "ngr_lt"]
ROLLING_30 = ["handle_l30", "ggr_l30", "bonus_cost_l30", "ngr_l30"]
ACTIVE_DAYS = ["active_days_lt", "active_days_l30"]
FIRST_LAST = ["first_sports_bet_date", "last_sports_bet_date"]
PER_SLIP = ["bet_count_total", "average_bet_amount"]
REAL_MONEY_COUNTS = ["real_money_bet_cnt_lifetime", "real_money_bet_cnt_last7", "real_money_bet_cnt_last30"]
REAL_MONEY_SHARE = ["real_money_pct_lifetime", "real_money_pct_7", "real_money_pct_30"]

# The combined build's lifetime/30-day CTE (C15 + C4 measures in one GROUP BY).
LIFETIME_AND_L30 = (LIFETIME + ["active_days_lt"] + ROLLING_30 + ["active_days_l30"] + FIRST_LAST
                    + PER_SLIP + REAL_MONEY_COUNTS + ["previous_day_ggr"] + REAL_MONEY_SHARE
                    + ["sportsbook_sources", "placed_a_parlay_bet", "bet_sports"])


def lifetime_and_l30(bets: DataFrame, as_of) -> DataFrame:
    """C15 (combined form): every bet KPI per customer over valid bets."""
    return customer_measures(valid_bets(bets), as_of, LIFETIME_AND_L30)


def bet_summary(bets: DataFrame, as_of) -> DataFrame:
    """C4 (batches form): turnover, slips, average bet, real-money counts and
    shares, previous-day ggr, first/last bet date and the source list."""
    names = (["turnover"] + PER_SLIP + REAL_MONEY_COUNTS + ["previous_day_ggr"] + REAL_MONEY_SHARE
             + FIRST_LAST + ["sportsbook_sources"])
    out = customer_measures(valid_bets(bets), as_of, names)
    return out.select(
        KEY, "turnover", F.coalesce("bet_count_total", F.lit(0)).alias("bet_count_total"),
        "average_bet_amount",
        F.col("real_money_bet_cnt_lifetime").alias("cnt_real_lifetime"),
        F.col("real_money_bet_cnt_last7").alias("cnt_real_7"),
        F.col("real_money_bet_cnt_last30").alias("cnt_real_30"),
        "previous_day_ggr", *REAL_MONEY_SHARE,
        F.col("first_sports_bet_date").alias("first_betslip_date"),
        F.col("last_sports_bet_date").alias("last_betslip_date"),
        "sportsbook_sources")


def final_ratios(lt: DataFrame) -> list[Column]:
    """The guarded ratios of the final SELECT, over a lifetime/30-day row."""
    return [
        guarded_ratio("ggr_l30", "handle_l30").alias("ggr_to_handle_l30"),
        guarded_ratio("ggr_lt", "handle_lt").alias("ggr_to_handle_lt"),
        guarded_ratio("handle_lt", "active_days_lt").alias("active_daily_handle_lt"),
        guarded_ratio("bonus_cost_l30", "ggr_l30").alias("bonus_to_ggr_l30"),
        guarded_ratio("bonus_cost_lt", "ggr_lt").alias("bonus_to_ggr_lt"),
    ]


def guarded_ratios(bets: DataFrame, as_of) -> DataFrame:
    """C24 per customer, computed from exact sums (decimal) before division."""
    lt = customer_measures(valid_bets(bets), as_of, LIFETIME + ROLLING_30 + ACTIVE_DAYS, money_as_double=False)
    return lt.select(KEY, *final_ratios(lt))


def parlay_bools(bets: DataFrame, mode: str = "combined") -> DataFrame:
    """C16 flags per customer as booleans.

    combined: ``logical_or(PARLAY and handle > 0)`` over all valid bets;
    batches:  valid bets with ``handle > 0`` first, then ``logical_or(PARLAY)``
    (customers without a positive bet drop out -> 'no' after a left join).
    """
    vb = valid_bets(bets)
    if mode == "batches":
        agg = vb.filter(F.col("handle") > 0).groupBy(KEY).agg(
            F.bool_or(F.col("wager_type") == "PARLAY").alias("placed_a_parlay_bet"))
    else:
        agg = vb.groupBy(KEY).agg(
            F.bool_or((F.col("wager_type") == "PARLAY") & (F.col("handle") > 0)).alias("placed_a_parlay_bet"))
    return agg.withColumn("bet_sports", F.lit(True))


def parlay_flag(bets: DataFrame, mode: str = "combined") -> DataFrame:
    """C16 as the final table shows it: 'yes' / 'no' labels."""
    b = parlay_bools(bets, mode)
    return b.select(KEY, label("placed_a_parlay_bet", "yes", "no").alias("placed_a_parlay_bet"),
                    label("bet_sports", "yes", "no").alias("bet_sports"))


def totals_by_dim_key(bets: DataFrame, customers: DataFrame) -> DataFrame:
    """Valid bets -> customer dimension (left) -> totals per customer_id.

    Bets whose customer is unknown collapse into the NULL customer_id group.
    The bets are first aggregated per customer_uid (map-side combined), and
    only that one-row-per-customer result is joined to the dimension: sums
    carry over exactly (a uid matching k dimension rows contributes its sum
    k times, as the row-level join would), min/max are unaffected. The big
    fact is never shuffled for the join.
    """
    day = F.to_date("ticket_delivery_date")
    per_uid = valid_bets(bets).groupBy(KEY).agg(
        F.sum("ngr").alias("_ngr"), F.sum("ggr").alias("_ggr"),
        F.min(day).alias("_first"), F.max(day).alias("_last"))
    dim = customers.select(F.col(KEY).alias("_uid"), "customer_id")
    return (per_uid.join(dim, F.col(KEY) == F.col("_uid"), "left")
            .groupBy("customer_id")
            .agg(F.sum("_ngr").cast("double").alias("ngr"), F.sum("_ggr").cast("double").alias("ggr"),
                 F.min("_first").alias("first_sports_bet_date"), F.max("_last").alias("last_sports_bet_date")))


# --------------------------------------------------------------------------
# Batches build: its bet-side inputs -- the bet summary (valid bets), the
# parlay flags (valid bets with handle > 0), the league list (settled-status
# bets) and the bet side of the bets x bonuses product (all bets) -- come
# from ONE pass over the bet fact. Every measure carries its own population
# condition; columns of a population a customer has no row in are NULL, as
# when the reference left-joins a separate CTE that lacks the customer.
# --------------------------------------------------------------------------
SUMMARY_COLUMNS = ["turnover", "bet_count_total", "average_bet_amount", "cnt_real_lifetime", "cnt_real_7",
                   "cnt_real_30", "previous_day_ggr", *REAL_MONEY_SHARE, "first_betslip_date",
                   "last_betslip_date", "sportsbook_sources"]


def batches_rollup(bets: DataFrame, as_of) -> DataFrame:
    tdd, kpi = "ticket_delivery_date", "kpi_date"
    valid = valid_bet()
    positive = valid & (F.col("handle") > 0)
    settled_scope = settled_slip() & league_scope(as_of)
    rm = real_money()
    in7, in30 = within_days(kpi, as_of, 7), within_days(kpi, as_of, 30)
    day = F.to_date(tdd)
    handle, ggr = F.col("handle"), F.col("ggr")

    def vsum(cond, c, zero=False):
        e = F.when(valid & cond, c)
        return Plain("sum", e.otherwise(F.lit(0)) if zero else e)

    grains = {"slip": F.col("src_betslip_uuid"), "bet": F.col("bet_id"),
              "source": F.when(valid, F.col("sportsbook_source")),
              "league": F.when(settled_scope, league_group())}
    m = {
        "_n_valid": Plain("sum", F.when(valid, F.lit(1)).otherwise(F.lit(0))),
        "_handle": vsum(F.lit(True), handle),
        "bet_count_total": Distinct("slip", valid),
        "cnt_real_lifetime": Distinct("bet", valid & rm),
        "cnt_real_7": Distinct("bet", valid & rm & in7),
        "cnt_real_30": Distinct("bet", valid & rm & in30),
        "previous_day_ggr": vsum(on_day_before(kpi, as_of), ggr, zero=True),
        "_rm_handle": vsum(rm, handle, zero=True),
        "_handle_7": vsum(in7, handle, zero=True),
        "_rm_handle_7": vsum(rm & in7, handle, zero=True),
        "_handle_30": vsum(in30, handle, zero=True),
        "_rm_handle_30": vsum(rm & in30, handle, zero=True),
        "first_betslip_date": Plain("min", F.when(valid, day)),
        "last_betslip_date": Plain("max", F.when(valid, day)),
        "sportsbook_sources": DistinctList("source", ","),
        "placed_a_parlay_bet": Plain("bool_or", F.when(positive, F.col("wager_type") == "PARLAY")),
        "bet_sports": Plain("bool_or", positive),
        "league_list": DistinctList("league", "/", descending=True, upper=True),
        "n_bets": Plain("sum", F.lit(1)),
        "h": Plain("sum", handle), "g": Plain("sum", ggr), "n": Plain("sum", F.col("ngr")),
    }
    agg = grained_agg(bets, KEY, grains, m)
    has_valid = F.col("_n_valid") > 0
    derived = {
        "turnover": F.coalesce(F.col("_handle"), F.lit(0)).cast("double"),
        "average_bet_amount": guarded_ratio(F.coalesce(F.col("_handle"), F.lit(0)), "bet_count_total"),
        "real_money_pct_lifetime": guarded_ratio("_rm_handle", "_handle"),
        "real_money_pct_7": guarded_ratio("_rm_handle_7", "_handle_7"),
        "real_money_pct_30": guarded_ratio("_rm_handle_30", "_handle_30"),
        "previous_day_ggr": F.col("previous_day_ggr").cast("double"),
    }
    summary = [F.when(has_valid, derived.get(c, F.col(c))).alias(c) for c in SUMMARY_COLUMNS]
    return agg.select(KEY, *summary, "placed_a_parlay_bet", "bet_sports", "league_list",
                      F.col("n_bets").cast("bigint").alias("n_bets"), "h", "g", "n")
