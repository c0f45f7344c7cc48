"""League grouping (C17) and the per-customer league list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import lists
from kpiforge.functions.predicates import settled_slip, valid_bet, within_months

# League names folded into the five canonical leagues, and the
# filter that admits a bet into the league report.
LEAGUE_GROUPS = {
    "NFL": ("NFL", "NFL - Unreal Matchups", "NFL Preseason", "NFL Specials",
            "NFL Weekly Specials", "Season Specials", "Specials", "Weekly Specials"),
    "NCAAF": ("NCAAF", "NCAAF Futures", "NCAA Division I, FCS National Championship"),
    "MLB": ("MLB", "MLB All Star Week", "MLB Specials", "MLB Spring Training",
            "Triple-A East", "Triple-A West"),
    "NHL": ("NHL", "NHL All Star Game", "NHL Preseason"),
    "NBA": ("NBA", "NBA All Star Game", "NBA Preseason", "NBA Specials", "NBA Summer League"),
}
CANONICAL_LEAGUES = ("NBA", "MLB", "NCAAF", "NFL", "NHL")
SPORTS_ALWAYS_LISTED = ("Soccer", "Tennis")


def league_group(league: str = "league", sport: str = "sport") -> Column:
    """League name -> canonical group, else the sport."""
    expr = None
    for group, names in LEAGUE_GROUPS.items():
        cond = F.col(league).isin(*names)
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr.otherwise(F.col(sport))


def league_scope(as_of) -> Column:
    """Rows the league report looks at: last 12 months, a canonical league
    or one of the always-listed sports."""
    return (within_months("ticket_delivery_date", as_of, 12)
            & (F.col("league").isin(*CANONICAL_LEAGUES) | F.col("sport").isin(*SPORTS_ALWAYS_LISTED)))


def league_group_counts(bets: DataFrame, as_of, mode: str = "combined") -> DataFrame:
    """Distinct slips per (customer, league group) over the last 12 months.

    combined: valid-bet filter (W1); batches: settled-status filter only (W2).
    """
    row_filter = valid_bet() if mode == "combined" else settled_slip()
    return (bets.filter(row_filter & league_scope(as_of))
            .groupBy("customer_uid", league_group().alias("league_group"))
            .agg(F.count_distinct("src_betslip_uuid").alias("num_bets")))


def league_list(bets: DataFrame, as_of, mode: str = "combined") -> DataFrame:
    """``UPPER(STRING_AGG(league_group, '/' ORDER BY league_group DESC))``.

    Second aggregation level over the (customer, group) counts: at most a few
    groups per customer, so the collected list is small by construction.
    """
    counts = league_group_counts(bets, as_of, mode)
    return counts.groupBy("customer_uid").agg(
        F.upper(lists.sorted_join("league_group", "/", descending=True)).alias("league_list"))
