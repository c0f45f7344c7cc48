"""Bonus-side operators: promotion kinds (C12-C14), availability labels
and the batches build's bets x bonuses activity (C11 + its lifetime CTE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import label
from kpiforge.functions.predicates import FREE_PROMO_TYPES, days_ago_at_most
from kpiforge.operators.grained import Distinct, Plain, grained_agg
from kpiforge.operators.latest import first_by_rank, latest_per_key

KEY = "customer_uid"


def bonus_kind(name: str = "campaign_name", kind: str = "campaign_type") -> Column:
    """MONEY campaigns split by an ``_NDB_`` marker in the name (one character
    required on each side); no campaign type -> 'Non_Campaign'. A NULL name
    with type MONEY matches neither LIKE branch and keeps the plain type."""
    n, t = F.col(name), F.col(kind)
    return (F.when(n.like("%_NDB_%") & (t == "MONEY"), F.concat(t, F.lit("_NDB")))
             .when(~n.like("%_NDB_%") & (t == "MONEY"), F.concat(t, F.lit("_DB")))
             .when(t.isNull(), F.lit("Non_Campaign"))
             .otherwise(t))


def promo_kind(bonuses: DataFrame, campaigns: DataFrame) -> DataFrame:
    """C12 (combined): bonus deposits with their campaign and bonus kind."""
    camp = campaigns.select("src_campaign_id", F.col("name").alias("campaign_name"),
                            F.col("type").alias("campaign_type"))
    return (bonuses.filter(F.col("wallet_transaction_type").isin("BONUS_DEPOSIT"))
            .join(camp, "src_campaign_id", "left")
            .select(KEY, "src_bonus_id", "campaign_name", "campaign_type",
                    bonus_kind().alias("bonus_type"), "transaction_created_date"))


def kind_counts(kinds: DataFrame) -> DataFrame:
    return kinds.groupBy(KEY, "bonus_type").agg(
        F.count_distinct("src_bonus_id").alias("cnt_promos_by_type"))


def rarest_promo_kind(kinds: DataFrame) -> DataFrame:
    """C13 as written: ``ORDER BY count(DISTINCT bonus) , bonus_type DESC`` --
    the *least* frequent kind, ties to the greatest kind name."""
    picked = first_by_rank(kind_counts(kinds), KEY,
                           [F.col("cnt_promos_by_type").asc(), F.col("bonus_type").desc()])
    return picked.select(KEY, "bonus_type", "cnt_promos_by_type")


def commonest_promo_kind(kinds: DataFrame) -> DataFrame:
    """C13 as the column name intends: the most frequent kind (same tie rule)."""
    picked = first_by_rank(kind_counts(kinds), KEY,
                           [F.col("cnt_promos_by_type").desc(), F.col("bonus_type").desc()])
    return picked.select(KEY, "bonus_type", "cnt_promos_by_type")


def latest_promo_kind(kinds: DataFrame) -> DataFrame:
    """C14: kind and campaign of each customer's latest deposit (ties: the
    greater bonus id)."""
    return latest_per_key(kinds, KEY, ["transaction_created_date", "src_bonus_id"],
                          ["bonus_type", "campaign_name"]) \
        .select(KEY, "bonus_type", "campaign_name")


def bonus_availability(bonuses: DataFrame) -> DataFrame:
    """C10: 'true'/'false' when idle bonus money of a kind is positive, plus
    two columns the reference leaves as typed NULLs."""
    def idle_sum(cond):
        return F.sum(F.when(cond, F.col("bonus_idle")).otherwise(F.lit(0)))
    t = F.col("bonus_campaign_type")
    agg = bonuses.groupBy(KEY).agg(idle_sum(t == "RISK_FREE_BET").alias("_protected"),
                                   idle_sum(t.isin(*FREE_PROMO_TYPES)).alias("_credits"))
    return agg.select(KEY, label(F.col("_protected") > 0, "true", "false").alias("available_protected_bets"),
                      label(F.col("_credits") > 0, "true", "false").alias("available_bet_credits"),
                      F.lit(None).cast("string").alias("available_deposit_matches"),
                      F.lit(None).cast("string").alias("available_bet_and_gets"))


# --------------------------------------------------------------------------
# Batches build: every bet row is left-joined to every bonus row of the same
# customer. The reference materialises that product; here the same numbers
# are derived from one aggregate per side, so no (bet, bonus) pair is ever
# produced -- a customer with a third of all bets and bonuses would
# otherwise emit (N/3)*(M/3) rows.
#   sum over pairs of a bet column   = (bet sum)   * (#bonus rows, or 1 if none)
#   sum over pairs of a bonus column = (bonus sum) * (#bet rows)
#   a condition on the bonus side    = count only qualifying bonus rows
#   DISTINCT counts of bonus days    = unaffected by the multiplicity
# --------------------------------------------------------------------------
def bonus_side(bonuses: DataFrame, as_of) -> DataFrame:
    """Per-customer bonus aggregate the fan-out measures need (one pass; the
    two distinct-day counts share one grain)."""
    l30 = days_ago_at_most("transaction_created_date", as_of, 30)
    placement = F.col("wallet_transaction_type_action").like("BET_SLIP_PLACEMENT")
    return grained_agg(bonuses, KEY, {"day": F.to_date("transaction_created_date")}, {
        "k": Plain("sum", F.lit(1)),
        "k30": Plain("sum", F.when(l30, F.lit(1)).otherwise(F.lit(0))),
        "cost": Plain("sum", F.col("bonus_cost")),
        "cost30": Plain("sum", F.when(l30, F.col("bonus_cost"))),
        "claimed": Plain("sum", F.col("bonus_claimed")),
        "days": Distinct("day", placement),
        "days30": Distinct("day", placement & l30),
    })


def bonus_rollup(bonuses: DataFrame, as_of) -> DataFrame:
    """The batches build's two bonus inputs in one pass: the fan-out bonus
    side (:func:`bonus_side`) and the availability labels
    (:func:`bonus_availability`) -- both per customer over all bonus rows."""
    l30 = days_ago_at_most("transaction_created_date", as_of, 30)
    placement = F.col("wallet_transaction_type_action").like("BET_SLIP_PLACEMENT")
    t = F.col("bonus_campaign_type")

    def idle_sum(cond):
        return Plain("sum", F.when(cond, F.col("bonus_idle")).otherwise(F.lit(0)))

    agg = grained_agg(bonuses, KEY, {"day": F.to_date("transaction_created_date")}, {
        "k": Plain("sum", F.lit(1)),
        "k30": Plain("sum", F.when(l30, F.lit(1)).otherwise(F.lit(0))),
        "cost": Plain("sum", F.col("bonus_cost")),
        "cost30": Plain("sum", F.when(l30, F.col("bonus_cost"))),
        "claimed": Plain("sum", F.col("bonus_claimed")),
        "days": Distinct("day", placement),
        "days30": Distinct("day", placement & l30),
        "_protected": idle_sum(t == "RISK_FREE_BET"),
        "_credits": idle_sum(t.isin(*FREE_PROMO_TYPES)),
    })
    return agg.select(
        KEY, "k", "k30", "cost", "cost30", "claimed", "days", "days30",
        label(F.col("_protected") > 0, "true", "false").alias("available_protected_bets"),
        label(F.col("_credits") > 0, "true", "false").alias("available_bet_credits"),
        F.lit(None).cast("string").alias("available_deposit_matches"),
        F.lit(None).cast("string").alias("available_bet_and_gets"))


def fanout_columns(present: Column | None = None) -> list[Column]:
    """Fan-out measures from a row holding the bet side (``n_bets``, ``h``,
    ``g``, ``n``) and the bonus side (``k`` ... ``days30``, NULL when the
    customer has no bonus). ``present``: the customer has a bet-side row."""
    mult = F.when(F.col("k").isNotNull(), F.col("k")).otherwise(F.lit(1))

    def times_k(c):        # bet column over all pairs
        return (F.col(c) * mult).cast("double")

    def times_k30(c):      # bet column over pairs whose bonus is in the window
        return F.when(F.col("k30") > 0, F.col(c) * F.col("k30")).cast("double")

    def times_bets(c):     # bonus column over all pairs
        return (F.col(c) * F.col("n_bets")).cast("double")

    cols = {
        "handle_lt": times_k("h"), "ggr_lt": times_k("g"), "bonus_cost_lt": times_bets("cost"),
        "ngr_lt": times_k("n"), "bonus_claimed": times_bets("claimed"),
        "active_days_lt": F.coalesce("days", F.lit(0)),
        "handle_l30": times_k30("h"), "ggr_l30": times_k30("g"), "bonus_cost_l30": times_bets("cost30"),
        "ngr_l30": times_k30("n"), "active_days_l30": F.coalesce("days30", F.lit(0)),
    }
    return [(F.when(present, e) if present is not None else e).alias(n) for n, e in cols.items()]


def fanout_activity(bets: DataFrame, bonuses: DataFrame, as_of) -> DataFrame:
    """C11 + the batches lifetime/30-day CTE, exactly as the fan-out join
    computes them (all bets, no status filter; 30 days by bonus date)."""
    b = bets.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_bets"), F.sum("handle").alias("h"),
        F.sum("ggr").alias("g"), F.sum("ngr").alias("n"))
    return b.join(bonus_side(bonuses, as_of), KEY, "left").select(KEY, *fanout_columns())


def bet_side_kinds(bets: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Bonus kind of each customer's bets, from the *bet's* campaign."""
    camp = campaigns.select("src_campaign_id", F.col("name").alias("campaign_name"),
                            F.col("type").alias("campaign_type"))
    # distinct (customer, campaign) pairs first: the dimension join then
    # sees one row per pair instead of one per bet
    pairs = bets.select(KEY, "src_campaign_id").distinct()
    return (pairs.join(camp, "src_campaign_id", "left")
            .select(KEY, "campaign_name", bonus_kind().alias("bonus_type")))


def fanout_promo_kinds(bets: DataFrame, bonuses: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Batches C13/C14 over the bets x deposits product, without the product.

    In the product every bet kind of a customer meets every deposit of that
    customer, so the distinct-deposit count is the same for each kind: the
    as-written "most common" (ascending count, kind descending) is the
    greatest kind, and the latest deposit meets every bet -- ties there are
    broken by kind, then campaign name, descending.
    """
    deposits = bonuses.filter(F.col("wallet_transaction_type").isin("BONUS_DEPOSIT"))
    d = deposits.groupBy(KEY).agg(F.count_distinct("src_bonus_id").alias("n_deposits"))
    kinds = bet_side_kinds(bets, campaigns).groupBy(KEY).agg(
        F.max("bonus_type").alias("most_common_bonus_type"),
        F.max(F.struct("bonus_type", "campaign_name")).alias("_top"))
    return (kinds.join(d, KEY)
            .select(KEY, "most_common_bonus_type",
                    F.col("_top.bonus_type").alias("most_recent_bonus_type"),
                    F.col("_top.campaign_name").alias("most_recent_campaign_name")))
