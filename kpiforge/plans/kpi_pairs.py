"""Column pairs for reconciling the batches table (left) against the
combined table (right), after the reference's batches-vs-combined test:
text/date/bool columns compared null-safe, measures as ``try_cast`` doubles
with a tolerance. Pairs are data; the quirks of the original list are kept
(``cnt_real_7`` is compared with the *lifetime* count, L10; the string
labels of ``available_*`` become NULL under ``try_cast`` and never differ).
"""

from kpiforge.operators.reconcile import Pair


def _t(left, right=None, label=None):
    return Pair(left, right or left, label or left, "text")


def _n(left, right=None, label=None):
    return Pair(left, right or left, label or left, "numeric")


# Fixed values, in the order and with the names of the report.
BATCHES_VS_COMBINED = [
    _t("customer_id"),
    _t("customer_uid"),
    _t("tiger_registration_date", label="registration_date"),
    _t("predicted_margin"),
    _t("ftd_date"),
    _t("first_betslip_date", "first_sports_bet_date"),
    _t("last_betslip_date", "last_sports_bet_date", label="last_sports_bet_date"),
    _t("classification_name_current"),
    _t("cross_product_historical_value_score_current"),
    _t("cross_product_historical_value_segment_current"),
    _t("sports_historical_value_score_current"),
    _t("sports_historical_value_segment_current"),
    _t("casino_historical_value_score_current"),
    _t("casino_historical_value_segment_current"),
    _t("manually_classified"),
    _t("lifetime_bets"),
    _t("test_account_flag"),
    _t("age_group"),
    _t("profile_country_name"),
    _t("brand_alias"),
    _t("is_locked"),
    _t("flag_rg"),
    _t("locked_until"),
    _t("predicted_risk_category_latest"),
    _t("profile_welcome_offer"),
    _t("self_exclusion_flag"),
    _t("is_bonus_abuser"),
    _t("is_suspended"),
    _t("person_id"),
    _t("license_uid"),
    _t("legal_entity"),
    _t("deposit_disabled"),
    _t("login_disabled"),
    _t("play_sports_disabled"),
    _t("receive_sports_promotions_disabled"),
    _t("withdraw_disabled"),
    _t("longest_restriction"),
    _t("longest_restriction_valid_to"),
    _t("longest_restriction_type"),
    _t("player_sb_ngr_last12months"),
    _t("enrolled_bonus_campaigns"),
    _t("is_bonus_campaign_enrolled"),
    _t("most_recent_active_campign_id", "most_recent_active_campaign_id", label="most_recent_active_campaign_id"),
    _t("most_recent_campaign_name"),
    _t("most_common_bonus_type"),
    _t("most_recent_bonus_type"),
    _t("sportsbook_sources"),
    _t("bet_sports"),
    _t("league_list"),
    _t("etl_created"),
    _t("etl_modified"),
    _t("data_update_time"),
    _t("predicted_revenue_segment"),
    _t("placed_a_parlay_bet"),
    _n("active_daily_handle_lt"),
    _n("active_days_lt"),
    _n("active_days_l30"),
    _n("bonus_cost_l30"),
    _n("bonus_cost_lt"),
    _n("bonus_to_ggr_l30"),
    _n("bonus_to_ggr_lt"),
    _n("handle_lt"),
    _n("handle_l30"),
    _n("ggr_l30"),
    _n("ggr_lt", "ggr"),
    _n("ggr_to_handle_l30"),
    _n("ggr_to_handle_lt"),
    _n("ngr_l30"),
    _n("ngr_lt", "ngr"),
    _n("bonus_wallet_balance"),
    _n("real_money_pct_lifetime"),
    _n("real_money_pct_7"),
    _n("real_money_pct_30"),
    _n("cnt_real_lifetime", "real_money_bet_cnt_lifetime"),
    _n("cnt_real_7", "real_money_bet_cnt_lifetime"),
    _n("cnt_real_30", "real_money_bet_cnt_last30"),
    _n("available_bet_and_gets"),
    _n("available_protected_bets"),
    _n("available_bet_credits"),
    _n("available_deposit_matches"),
    _n("average_bet_amount"),
    _n("settled_bet_count"),
    _n("predicted_revenue_next_30"),
    _n("predicted_revenue_next_active_day"),
    _n("pred_real_money_active_days_next30_bonus_0"),
    _n("pred_real_money_active_days_next30_bonus_1"),
    _n("pred_active_days_next30_bonus_lift"),
    _n("tiger_lifetime_cashback_lc"),
    _n("tiger_lifetime_missions_completed"),
    _n("tiger_l30_cashback_lc"),
    _n("tiger_l30_missions_completed"),
    _t("do_not_bonus"),
    _t("deposited"),
]
KPI_TOLERANCE = 1.0


# The initial-vs-combined check compares every column as text (its declared
# numeric tolerance is never used).
# Fixed values, in the order of the report.
INITIAL_VS_COMBINED = [
    _t("customer_id"),
    _t("customer_uid"),
    _t("registration_date", "tiger_registration_date"),
    _t("predicted_margin"),
    _t("ftd_date"),
    _t("first_sports_bet_date"),
    _t("last_sports_bet_date"),
    _t("classification_name_current"),
    _t("cross_product_historical_value_score_current"),
    _t("cross_product_historical_value_segment_current"),
    _t("sports_historical_value_score_current"),
    _t("sports_historical_value_segment_current"),
    _t("casino_historical_value_score_current"),
    _t("casino_historical_value_segment_current"),
    _t("manually_classified"),
    _t("lifetime_bets"),
    _t("test_account_flag"),
    _t("age_group"),
    _t("profile_country_name"),
    _t("brand_alias"),
    _t("is_locked"),
    _t("flag_rg"),
    _t("locked_until"),
    _t("predicted_risk_category_latest"),
    _t("profile_welcome_offer"),
    _t("self_exclusion_flag"),
    _t("is_bonus_abuser"),
    _t("is_suspended"),
    _t("person_id"),
    _t("license_uid"),
    _t("legal_entity"),
    _t("deposit_disabled"),
    _t("login_disabled"),
    _t("play_sports_disabled"),
    _t("receive_sports_promotions_disabled"),
    _t("withdraw_disabled"),
    _t("longest_restriction"),
    _t("longest_restriction_valid_to"),
    _t("longest_restriction_type"),
    _t("player_sb_ngr_last12months"),
]
