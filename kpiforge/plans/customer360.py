"""The three customer-grain wide tables (C25 initial, C26 batches, C27
combined).

Shape of every plan: each input is first aggregated to one row per customer
(one shuffle per aggregate, partial aggregation map-side), then folded onto
the customer dimension with left joins on ``customer_uid``. All customer-grain
inputs are hash-partitioned on the same key with the same partition count, so
the sort-merge joins of the star need no further exchange for them; joins
"via" an earlier nullable side (J3) are expressed on the base key plus a
"matched" test so the partitioning survives (see
:func:`kpiforge.operators.customer.chained_join`). Small, bounded reference
inputs are left to AQE, which broadcasts from measured sizes.

``as_of`` replaces ``current_date()``/``current_timestamp()``: the load time
column is the ``as_of`` instant, so a rebuild is reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import label
from kpiforge.functions.predicates import as_timestamp
from kpiforge.operators import bets as B
from kpiforge.operators import bonus as BO
from kpiforge.operators import campaigns as CA
from kpiforge.operators import customer as CU
from kpiforge.operators import engagement as EN
from kpiforge.operators import settlement as ST
from kpiforge.sources import published
from kpiforge.sources.domain import Domain

KEY = "customer_uid"


def _rename_key(df: DataFrame, alias: str) -> DataFrame:
    return df.withColumnRenamed(KEY, alias)


def _left(base: DataFrame, other: DataFrame, key_alias: str, cond_extra=None) -> DataFrame:
    """Left join ``other`` (customer grain) on the base key; ``other``'s key is
    kept under ``key_alias`` so presence can be tested afterwards."""
    o = _rename_key(other, key_alias)
    cond = F.col(KEY) == F.col(key_alias)
    if cond_extra is not None:
        cond = cond & cond_extra
    return base.join(o, cond, "left")


# Columns of the customer dimension that the tables carry unchanged.
BATCHES_PASSTHROUGH = [
    "profile_country_name", "brand_alias", "is_locked", "flag_rg", "locked_until",
    "predicted_risk_category_latest", "profile_welcome_offer", "self_exclusion_flag",
    "is_bonus_abuser", "is_suspended", "person_id", "license_uid", "legal_entity",
    "deposit_disabled", "login_disabled", "play_sports_disabled",
    "receive_sports_promotions_disabled", "withdraw_disabled",
    "longest_restriction", "longest_restriction_valid_to", "longest_restriction_type",
    "player_sb_ngr_last12months",
]
DIM_PASSTHROUGH = ["sb_ngr_percentile_last12months", "profile_month_of_birth", "age_group",
                   "profile_country_uid", "profile_gender", *BATCHES_PASSTHROUGH,
                   "player_cs_ngr_last12months"]


def _yes_no(name: str):
    """``CASE WHEN flag THEN 'yes' ELSE 'no' END`` (a missing row says 'no')."""
    return label(F.col(name), "yes", "no").alias(name)


def _customer_dim(d: Domain, as_of, as_of_events) -> DataFrame:
    """The customer dimension with its classification and the class's name."""
    manual = d.classification.select("customer_id", "classification_id", "manually_classified")
    return d.customers.join(manual, "customer_id", "left").join(d.classification_ref, "classification_id", "left")


def _stakes(d: Domain, as_of, as_of_events) -> DataFrame:
    return d.sportsbook_stats.select(KEY, F.col("first_betslip_stake").cast("double").alias("first_sports_bet_amount"),
                                     F.col("last_betslip_stake").cast("double").alias("last_sports_bet_amount"),
                                     F.col("totalaveragecombi").alias("average_combination_length"))


def _segments(d: Domain, as_of, as_of_events) -> DataFrame:
    return d.segmentation.select(KEY, *CU.SEGMENT_SCORES,
                                 F.col("lifetime_handle").cast("double").alias("lifetime_handle"),
                                 F.col("daily_active_handle").cast("double").alias("daily_active_handle"),
                                 "lifetime_bets")


def _deposit_kinds(d: Domain) -> DataFrame:
    return BO.promo_kind(d.bonuses, d.campaigns)


#: The inputs of the three stars by name, each a function of (domain, bet clock,
#: event clock) with one row per customer.
INPUTS = {
    "customer_dim": _customer_dim,
    "stakes": _stakes,
    "segments": _segments,
    "margins": lambda d, as_of, ev: CU.theoretical_margin(d.rating),
    "dim_totals": lambda d, as_of, ev: B.totals_by_dim_key(d.bets, d.customers),
    "sessions": lambda d, as_of, ev: EN.session_metrics(d.sessions),
    "mission_counts": lambda d, as_of, ev: EN.mission_counts(d.missions),
    "missions": lambda d, as_of, ev: EN.mission_metrics(d.missions, ev),
    # lifetime and 30-day measures and the league list share their passes over the bets
    "bet_measures": lambda d, as_of, ev: B.customer_measures(B.valid_bets(d.bets), as_of, B.LIFETIME_AND_L30 + ["league_list"]),
    "settled_bets": lambda d, as_of, ev: ST.settled_counts(d.slips, d.slip_bets, d.bet_map, d.combinations),
    "balance": lambda d, as_of, ev: ST.latest_balance(d.wallets, d.balances),
    "latest_campaign": lambda d, as_of, ev: CA.latest_campaign(d.bonus_activity),
    "enrolled": lambda d, as_of, ev: CA.enrolled_list(d.bonus_activity, ev),
    "predicted": lambda d, as_of, ev: EN.relative_lift_table(d.predictions),
    "availability": lambda d, as_of, ev: BO.bonus_availability(d.bonuses),
    "common_kind": lambda d, as_of, ev: BO.rarest_promo_kind(_deposit_kinds(d)).select(
        KEY, F.col("bonus_type").alias("most_common_bonus_type")),
    "recent_kind": lambda d, as_of, ev: BO.latest_promo_kind(_deposit_kinds(d)).select(
        KEY, F.col("bonus_type").alias("most_recent_bonus_type"), F.col("campaign_name").alias("most_recent_campaign_name")),
    "test_players": lambda d, as_of, ev: CU.test_players(d.customers).select(KEY),
    "customer_base": lambda d, as_of, ev: CU.customer_base(d.customers, d.classification, d.segmentation),
    # one pass over the bets: summary, parlay flags, league list, bet side of the product
    "bet_rollup": lambda d, as_of, ev: B.batches_rollup(d.bets, as_of),
    # one pass over the bonuses: availability labels and the bonus side of the product
    "bonus_rollup": lambda d, as_of, ev: BO.bonus_rollup(d.bonuses, as_of),
    "product_kinds": lambda d, as_of, ev: BO.fanout_promo_kinds(d.bets, d.bonuses, d.campaigns),
}

Inputs = Callable[[str], DataFrame]


def limited_inputs(d: Domain, as_of, as_of_events=None) -> Inputs:
    """Inputs computed where they are used, with the reference's limits."""
    events = as_of if as_of_events is None else as_of_events
    return lambda name: INPUTS[name](d, as_of, events)


def direct_inputs(d: Domain, as_of, as_of_events=None) -> Inputs:
    """As :func:`limited_inputs`, with every campaign of the look-back in the enrolled
    list, in full: neither of the reference's two limits holds."""
    events = as_of if as_of_events is None else as_of_events
    limited = limited_inputs(d, as_of, as_of_events)
    return lambda name: (CA.enrolled_list(d.bonus_activity, events, top_n=None, max_chars=None)
                         if name == "enrolled" else limited(name))


def kpi_initial(d: Domain, as_of, inputs: Inputs | None = None) -> DataFrame:
    """The first, 8-join customer table."""
    get = inputs or direct_inputs(d, as_of)
    totals = get("dim_totals")
    j = get("customer_dim")
    j = _left(j, get("stakes"), "_stakes")
    j = _left(j, get("margins"), "_margins")
    j = _left(j, totals, "_totals") if KEY in totals.columns else j.join(totals, "customer_id", "left")
    j = _left(j, get("segments"), "_segments")
    j = _left(j, get("sessions"), "_sessions")
    j = _left(j, get("mission_counts"), "_missions")
    return j.select(
        "customer_id", KEY, "alias",
        F.coalesce("classification_name", "punter_category_current").alias("classification_name_current"),
        "predicted_margin", "margin_prematch_predicted", "margin_live_predicted",
        "avg_prematch_betslip_predicted", "avg_live_betslip_predicted",
        "first_sports_bet_amount", "last_sports_bet_amount", "average_combination_length",
        "ggr", "ngr", *CU.SEGMENT_SCORES, "first_sports_bet_date", "last_sports_bet_date",
        "lifetime_handle", "daily_active_handle", "lifetime_bets",
        "avg_session_min", "avg_session_sec", "total_sessions",
        F.to_date("registration_date").alias("registration_date"), "ftd_date",
        F.lit(None).cast("string").alias("welcome_offer"),
        F.lit(None).cast("string").alias("welcome_offer_short_name"),
        "manually_classified", F.col("is_test_player").alias("test_account_flag"),
        "created", *DIM_PASSTHROUGH,
        F.coalesce("active_mission_count", F.lit(0)).alias("active_mission_count"),
        F.coalesce("completed_mission_count", F.lit(0)).alias("completed_mission_count"))


def kpi_combined(d: Domain, as_of, as_of_events=None, inputs: Inputs | None = None, unique: bool = False) -> DataFrame:
    """The combined customer table (19 left joins, DISTINCT).

    ``as_of`` is the clock of the bet measures; ``as_of_events`` (default
    ``as_of``) the clock of the mission / campaign look-backs. ``unique`` says that
    every input is known to have one row per key; then the DISTINCT is a no-op
    and left out.
    """
    get = inputs or direct_inputs(d, as_of, as_of_events)
    j = get("customer_dim")
    j = _left(j, get("stakes"), "_stakes")
    j = _left(j, get("margins"), "_margins")
    j = _left(j, get("segments").drop("lifetime_bets"), "_segments")
    j = _left(j, get("sessions"), "_sessions")
    j = _left(j, get("missions"), "_missions")
    # From here on the reference joins on the segmentation's key (J3): an unscored
    # customer loses every later KPI. Same rows: base key + "segmentation matched".
    via = F.col("_segments").isNotNull()
    for name in ("settled_bets", "balance", "latest_campaign", "enrolled", "predicted", "availability",
                 "common_kind", "recent_kind", "bet_measures", "test_players"):
        j = _left(j, get(name), f"_{name}", via)

    classification = F.coalesce("classification_name", "punter_category_current")
    out = j.select(
        "predicted_margin", "margin_prematch_predicted", "margin_live_predicted",
        "avg_prematch_betslip_predicted", "avg_live_betslip_predicted",
        "first_sports_bet_date", "last_sports_bet_date", "average_bet_amount",
        F.col("bet_count_total").alias("lifetime_bets"),
        *B.REAL_MONEY_SHARE, *B.REAL_MONEY_COUNTS, "sportsbook_sources",
        "avg_session_min", "avg_session_sec", "total_sessions",
        F.coalesce("active_mission_count", F.lit(0)).alias("active_mission_count"),
        "completed_mission_count", "tiger_lifetime_cashback_lc", "tiger_l30_cashback_lc",
        "tiger_l30_missions_completed",
        F.coalesce("bonus_wallet_balance", F.lit(0.0)).alias("bonus_wallet_balance"),
        F.coalesce("settled_bet_count", F.lit(0)).alias("settled_bet_count"),
        F.col("_latest_campaign").isNotNull().alias("is_bonus_campaign_enrolled"),
        "most_recent_active_campaign_id", "enrolled_bonus_campaigns",
        "pred_real_money_active_days_next30_bonus_0", "pred_real_money_active_days_next30_bonus_1",
        "pred_active_days_next30_bonus_lift", "predicted_revenue_next_30",
        "predicted_revenue_next_active_day", "predicted_revenue_segment",
        "available_protected_bets", "available_bet_credits", "available_deposit_matches",
        "available_bet_and_gets", "most_common_bonus_type", "most_recent_bonus_type",
        "most_recent_campaign_name",
        F.col("ggr_lt").alias("ggr"), F.col("ngr_lt").alias("ngr"), "handle_lt", "active_days_lt",
        "handle_l30", "ggr_l30", "previous_day_ggr", "ngr_l30", "bonus_cost_lt", "bonus_cost_l30",
        "active_days_l30",
        *B.final_ratios(j),
        _yes_no("bet_sports"),
        _yes_no("placed_a_parlay_bet"),
        "league_list", "average_combination_length", "first_sports_bet_amount", "last_sports_bet_amount",
        classification.alias("classification_name_current"),
        "daily_active_handle", "lifetime_handle",
        "customer_id", KEY,
        F.col("registration_date").alias("tiger_registration_date"),
        F.col("created").alias("lv_registration_date"),
        "etl_created", "etl_modified", "acquisition_channel",
        F.col("_test_players").isNotNull().alias("test_account_flag"),
        *DIM_PASSTHROUGH, "alias",
        *CU.SEGMENT_SCORES,
        "manually_classified", "ftd_date", F.col("ftd_date").isNotNull().alias("deposited"),
        F.lit(None).cast("string").alias("welcome_offer"),
        F.lit(None).cast("string").alias("welcome_offer_short_name"),
        "tiger_lifetime_missions_completed",
        CU.do_not_bonus(classification).alias("do_not_bonus"),
        as_timestamp(as_of).cast("timestamp").alias("data_update_time"))
    return out if unique else out.distinct()


def kpi_batches(d: Domain, as_of, as_of_events=None, initial: DataFrame | None = None, inputs: Inputs | None = None,
                unique: bool = False) -> DataFrame:
    """The batches customer table. Reads the initial table (built here
    when not given) and joins its later inputs on the initial table's key.

    Its lifetime/30-day measures come from the bets x bonuses product and its
    bonus kinds from the bet's campaign -- both computed without producing
    the product (see :mod:`kpiforge.operators.bonus`). ``unique`` as in
    :func:`kpi_combined`.
    """
    get = inputs or direct_inputs(d, as_of, as_of_events)
    kpi = initial if initial is not None else kpi_initial(d, as_of, inputs)
    kpi_cols = kpi.select(KEY, "created", "age_group", "ftd_date", "classification_name_current",
                          *BATCHES_PASSTHROUGH)
    j = get("customer_base")
    for name in ("bet_rollup", "settled_bets", "balance", "latest_campaign", "enrolled"):
        j = _left(j, get(name), f"_{name}")
    j = _left(j, kpi_cols, "_kpi")
    missions = get("missions").drop("active_mission_count", "completed_mission_count")
    for name, df in (("predicted", get("predicted")), ("missions", missions), ("bonus_rollup", get("bonus_rollup")),
                     ("product_kinds", get("product_kinds"))):
        j = _left(j, df, f"_{name}")
    # The reference joins the lifetime/30-day, parlay, league and test inputs
    # on kpi.customer_uid (J3): without an initial-table row they are NULL.
    via = F.col("_kpi").isNotNull()
    j = _left(j, get("test_players"), "_test_players", via)
    j = j.select("*", *BO.fanout_columns(via & F.col("_bet_rollup").isNotNull()),
                 F.when(via, F.col("placed_a_parlay_bet")).alias("_parlay"),
                 F.when(via, F.col("bet_sports")).alias("_sports"),
                 F.when(via, F.col("league_list")).alias("_leagues"))
    j = j.drop("placed_a_parlay_bet", "bet_sports", "league_list") \
        .withColumnRenamed("_parlay", "placed_a_parlay_bet").withColumnRenamed("_sports", "bet_sports") \
        .withColumnRenamed("_leagues", "league_list")

    out = j.select(
        "customer_id", KEY, F.col("registration_date").alias("tiger_registration_date"),
        F.col("created").alias("lv_registration_date"), "etl_created", "etl_modified",
        "age_group", "first_betslip_date", "last_betslip_date", "sportsbook_sources",
        "average_bet_amount", F.col("bet_count_total").alias("lifetime_bets"),
        F.col("bonus_claimed").alias("bonus_amount_claimed"), "manually_classified",
        *CU.SEGMENT_SCORES,
        F.coalesce("settled_bet_count", F.lit(0)).alias("settled_bet_count"),
        F.coalesce("bonus_wallet_balance", F.lit(0.0)).alias("bonus_wallet_balance"),
        F.col("_latest_campaign").isNotNull().alias("is_bonus_campaign_enrolled"),
        F.col("most_recent_active_campaign_id").alias("most_recent_active_campign_id"),
        "enrolled_bonus_campaigns", F.col("ftd_date").isNotNull().alias("deposited"), "ftd_date",
        "pred_real_money_active_days_next30_bonus_0", "pred_real_money_active_days_next30_bonus_1",
        "pred_active_days_next30_bonus_lift", "predicted_revenue_next_30",
        "predicted_revenue_next_active_day", "predicted_revenue_segment",
        CU.do_not_bonus("classification_name_current").alias("do_not_bonus"),
        "predicted_margin", *B.REAL_MONEY_SHARE, "cnt_real_lifetime", "cnt_real_7", "cnt_real_30",
        "tiger_lifetime_cashback_lc", "tiger_lifetime_missions_completed", "tiger_l30_cashback_lc",
        "tiger_l30_missions_completed", "available_protected_bets", "available_bet_credits",
        "available_deposit_matches", "available_bet_and_gets",
        "most_common_bonus_type", "most_recent_bonus_type", "most_recent_campaign_name",
        "ggr_lt", "ngr_lt", "handle_lt", "active_days_lt", "active_days_l30", "handle_l30",
        "ggr_l30", "ngr_l30", "bonus_cost_lt", "bonus_cost_l30",
        *B.final_ratios(j),
        _yes_no("bet_sports"),
        _yes_no("placed_a_parlay_bet"),
        "classification_name_current", "league_list", *BATCHES_PASSTHROUGH,
        "acquisition_channel",
        F.col("_test_players").isNotNull().alias("test_account_flag"),
        as_timestamp(as_of).cast("timestamp").alias("data_update_time"))
    return out if unique else out.distinct()


def write_table(df: DataFrame, path: str) -> None:
    """``CREATE OR REPLACE TABLE ... AS`` -- full replace of a parquet table,
    range-clustered by customer. The new version is published whole: readers see
    the old table until it is complete."""
    published.publish(df.repartitionByRange(KEY), path, cluster_by=KEY)


def read_table(spark, path: str) -> DataFrame:
    """The table that :func:`write_table` last published at ``path``."""
    return published.read(spark, path)


def batches_two_hop(d: Domain, as_of, as_of_events, initial_path: str) -> DataFrame:
    """S4 + S5 as the reference runs them: build and persist the initial
    table, then build the batches table reading the persisted copy (the
    written table also cuts the lineage between the two builds)."""
    write_table(kpi_initial(d, as_of), initial_path)
    initial = read_table(d.tables.spark, initial_path)
    return kpi_batches(d, as_of, as_of_events, initial=initial, inputs=limited_inputs(d, as_of, as_of_events))
