"""Settled-bet count (C3) and current bonus-wallet balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.predicates import SETTLED_COMBINATION_STATUSES
from kpiforge.operators.latest import latest_per_key


def settled_counts(slips: DataFrame, slip_bets: DataFrame, bet_map: DataFrame,
                   combinations: DataFrame) -> DataFrame:
    """Distinct bets per customer whose combination is WON or LOST.

    Four-way inner join. Join order is chosen by hand (Catalyst does not
    reorder joins without cost-based optimisation): the status predicate of
    the reference's ON clause is applied to the combinations first (pushed
    into their scan) and joined to the mapping, so the two bet-sized
    relations meet only on the surviving rows; the slip (customer) side
    comes last. Inner joins, so the result equals the reference's order.
    """
    settled = combinations.filter(F.col("bet_combination_status").isin(*SETTLED_COMBINATION_STATUSES)) \
        .select("bet_combination_id")
    return (bet_map.join(settled, "bet_combination_id")
            .select("src_betslip_uuid", "bet_id")
            .join(slip_bets, ["src_betslip_uuid", "bet_id"])
            .join(slips.select("src_betslip_uuid", "customer_uid"), "src_betslip_uuid")
            .groupBy("customer_uid")
            .agg(F.count_distinct("bet_id").alias("settled_bet_count")))


def latest_balance(wallets: DataFrame, balances: DataFrame) -> DataFrame:
    """Latest snapshot per wallet, BONUS wallets summed per owner.

    ``row_number() over (partition by wallet order by balanceasofdate desc)
    = 1`` is evaluated as a max-struct aggregate per wallet (ties broken by
    the snapshot id) *before* the join, which is equivalent because the join
    is an inner equi-join on the window's partition key. Owners that only
    have USER wallets get 0.
    """
    latest = latest_per_key(balances, "wallet_id", ["balanceasofdate", "balance_id"], ["end_balance"])
    w = wallets.filter(F.col("wallet_owner_type").isin("USER", "BONUS"))
    return (w.join(latest, "wallet_id")
            .groupBy(F.col("owner_id").alias("customer_uid"))
            .agg(F.coalesce(F.sum(F.when(F.col("wallet_owner_type") == "BONUS", F.col("end_balance"))),
                            F.lit(0)).cast("double").alias("bonus_wallet_balance")))
