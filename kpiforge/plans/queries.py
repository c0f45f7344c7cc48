"""Query registry: one callable per operator key of the survey inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
parquet tables in ``sf_dir``; computed columns carry the same names as the
matching oracle SQL in :mod:`oracle.queries`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.operators import activity as AC
from kpiforge.operators import bets as B
from kpiforge.operators import bonus as BO
from kpiforge.operators import campaigns as CA
from kpiforge.operators import contract as CO
from kpiforge.operators import customer as CU
from kpiforge.operators import daily as DA
from kpiforge.operators import engagement as EN
from kpiforge.operators import leagues as LG
from kpiforge.operators import reconcile as RE
from kpiforge.operators import settlement as ST
from kpiforge.plans import customer360 as K
from kpiforge.plans.stored_kpi import StoredKpi
from kpiforge.functions.predicates import as_timestamp
from kpiforge.session import ensure_checkpoint_dir
from kpiforge.sources.domain import Domain, customer_versions, events_level
from kpiforge.sources.tables import Tables

# Fixed clocks of the fixtures: the bet data ends 2001-08-01, the event data
# (missions, sessions, campaign dispatches) covers January 2024.
BETS_AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Column pairs compared by the reconciliation queries (old vs new profile).
PROFILE_PAIRS = [
    RE.Pair("customer_uid", "customer_uid", "customer_uid", "text"),
    RE.Pair("order_count", "order_count", "order_count", "numeric"),
    RE.Pair("total_price", "total_price", "total_price", "numeric"),
    RE.Pair("first_order_date", "first_order_date", "first_order_date", "text"),
    RE.Pair("last_order_date", "last_order_date", "last_order_date", "text"),
    RE.Pair("top_priority", "top_priority", "top_priority", "exact"),
]
EXACT_PAIRS = [RE.Pair(p.left, p.right, p.label, "exact" if p.kind == "numeric" else p.kind)
               for p in PROFILE_PAIRS]
RECONCILE_TOL = 1.0


def _domain(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(Tables(spark, sf_dir))


def _money(c: str):
    return F.col(c).cast("double").alias(c)


# ---------------------------------------------------------------- bets
def q_scan_project(spark, sf):
    b = _domain(spark, sf).bets
    return b.select("customer_uid", "src_betslip_uuid", "bet_id", "wager_type", "league", "sport",
                    _money("handle"), F.col("bonus_total").cast("double").alias("bonus_cost"),
                    F.to_date("ticket_delivery_date").alias("delivery_date"))


def q_valid_bets(spark, sf):
    b = B.valid_bets(_domain(spark, sf).bets)
    return b.select("customer_uid", "src_betslip_uuid", "bet_id", "betslip_status",
                    "bet_combination_status", _money("handle"))


def q_valid_bets_shared(spark, sf):
    d = _domain(spark, sf)
    b = B.valid_bets_with_campaign(d.bets, d.campaigns)
    return b.select("customer_uid", "bet_id", "src_campaign_id", "campaign_name", "campaign_type",
                    _money("ggr"))


def _measures(names):
    def q(spark, sf):
        return B.customer_measures(B.valid_bets(_domain(spark, sf).bets), BETS_AS_OF, names)
    return q


def q_lifetime_and_l30(spark, sf):
    return B.lifetime_and_l30(_domain(spark, sf).bets, BETS_AS_OF)


def q_bet_summary(spark, sf):
    return B.bet_summary(_domain(spark, sf).bets, BETS_AS_OF)


def q_guarded_ratios(spark, sf):
    return B.guarded_ratios(_domain(spark, sf).bets, BETS_AS_OF)


def q_parlay_flag(spark, sf):
    return B.parlay_flag(_domain(spark, sf).bets, "combined")


def q_league_group_counts(spark, sf):
    return LG.league_group_counts(_domain(spark, sf).bets, BETS_AS_OF, "combined")


def q_league_list(spark, sf):
    return LG.league_list(_domain(spark, sf).bets, BETS_AS_OF, "combined")


def q_settled_counts(spark, sf):
    d = _domain(spark, sf)
    return ST.settled_counts(d.slips, d.slip_bets, d.bet_map, d.combinations)


def q_totals_by_dim_key(spark, sf):
    d = _domain(spark, sf)
    return B.totals_by_dim_key(d.bets, d.customers)


def q_latest_balance(spark, sf):
    d = _domain(spark, sf)
    return ST.latest_balance(d.wallets, d.balances)


# ---------------------------------------------------------------- campaigns / bonuses
def q_latest_campaign(spark, sf):
    return CA.latest_campaign(_domain(spark, sf).bonus_activity)


def q_enrolled_list(spark, sf):
    return CA.enrolled_list(_domain(spark, sf).bonus_activity, EVENTS_AS_OF)


def _kinds(spark, sf):
    d = _domain(spark, sf)
    return BO.promo_kind(d.bonuses, d.campaigns)


def q_promo_kind(spark, sf):
    k = _kinds(spark, sf)
    return k.select("customer_uid", "src_bonus_id", "campaign_name", "campaign_type", "bonus_type",
                    F.to_date("transaction_created_date").alias("created_date"))


def q_rarest_promo_kind(spark, sf):
    return BO.rarest_promo_kind(_kinds(spark, sf))


def q_commonest_promo_kind(spark, sf):
    return BO.commonest_promo_kind(_kinds(spark, sf))


def q_latest_promo_kind(spark, sf):
    return BO.latest_promo_kind(_kinds(spark, sf))


def q_bonus_availability(spark, sf):
    return BO.bonus_availability(_domain(spark, sf).bonuses)


def q_fanout_activity(spark, sf):
    d = _domain(spark, sf)
    return BO.fanout_activity(d.bets, d.bonuses, BETS_AS_OF)


def q_fanout_promo_kinds(spark, sf):
    d = _domain(spark, sf)
    return BO.fanout_promo_kinds(d.bets, d.bonuses, d.campaigns)


# ---------------------------------------------------------------- engagement
def q_mission_metrics(spark, sf):
    return EN.mission_metrics(_domain(spark, sf).missions, EVENTS_AS_OF)


def q_session_metrics(spark, sf):
    return EN.session_metrics(_domain(spark, sf).sessions)


def q_relative_lift(spark, sf):
    return EN.relative_lift_table(_domain(spark, sf).predictions)


# ---------------------------------------------------------------- customer dims
def q_customer_base(spark, sf):
    d = _domain(spark, sf)
    return CU.customer_base(d.customers, d.classification, d.segmentation)


def q_distinct_dim(spark, sf):
    return CU.theoretical_margin(_domain(spark, sf).rating)


def q_flag_join(spark, sf):
    d = _domain(spark, sf)
    return CU.flag_join(d.customers, d.classification)


def q_chained_key_join(spark, sf):
    d = _domain(spark, sf)
    base = d.customers.select("customer_uid")
    msm = d.segmentation.select("customer_uid", F.col("customer_uid").alias("segment_uid"))
    abb = BO.bonus_availability(d.bonuses).select("customer_uid", "available_protected_bets")
    sbc = ST.settled_counts(d.slips, d.slip_bets, d.bet_map, d.combinations)
    return CU.chained_join(base, msm, "segment_uid", [abb, sbc])


def q_classification_fallback(spark, sf):
    d = _domain(spark, sf)
    return CU.classification_fallback(d.customers, d.classification, d.classification_ref)


def q_labels_from_flags(spark, sf):
    return CU.labels_from_flags(_domain(spark, sf).customers)


# ---------------------------------------------------------------- wide tables
def q_kpi_initial(spark, sf):
    return K.kpi_initial(_domain(spark, sf), BETS_AS_OF)


def q_kpi_combined(spark, sf):
    return K.kpi_combined(_domain(spark, sf), BETS_AS_OF, EVENTS_AS_OF)


def q_kpi_batches(spark, sf):
    return K.kpi_batches(_domain(spark, sf), BETS_AS_OF, EVENTS_AS_OF)


# ---------------------------------------------------------------- reconciliation
def _versions(spark, sf):
    return customer_versions(Tables(spark, sf))


def q_reconcile_cells(spark, sf):
    old, new = _versions(spark, sf)
    return RE.diff_flags(new, old, "customer_uid", EXACT_PAIRS)


def q_reconcile_numeric(spark, sf):
    old, new = _versions(spark, sf)
    return RE.diff_flags(new, old, "customer_uid", PROFILE_PAIRS, tol=RECONCILE_TOL)


def q_reconcile_rows(spark, sf):
    old, new = _versions(spark, sf)
    flags = RE.diff_flags(new, old, "customer_uid", PROFILE_PAIRS, tol=RECONCILE_TOL)
    return RE.mismatch_rows(flags, "customer_uid", RE.pair_labels(PROFILE_PAIRS))


def q_reconcile_columns(spark, sf):
    old, new = _versions(spark, sf)
    flags = RE.diff_flags(new, old, "customer_uid", PROFILE_PAIRS, tol=RECONCILE_TOL)
    return RE.mismatch_columns(flags, RE.pair_labels(PROFILE_PAIRS))


def q_drift_count(spark, sf):
    old, new = _versions(spark, sf)
    pred = F.abs(F.col("l.total_price") - F.col("r.total_price")) > 0.1
    return RE.drift_count(new, old, "customer_uid", pred)


# ---------------------------------------------------------------- activity status
def _feeds(spark, sf):
    d = _domain(spark, sf)
    return d.sportsbook_feed, d.second_feed


def q_activity_months(spark, sf):
    return AC.activity_months(*_feeds(spark, sf))


def q_monthly_status(spark, sf):
    return AC.monthly_status(*_feeds(spark, sf))


def _history_target(spark, sf):
    """Status table as an earlier run left it: built from the first feed only."""
    f1, _ = _feeds(spark, sf)
    return AC.monthly_status(f1, None)


def q_activity_new_keys(spark, sf):
    f1, f2 = _feeds(spark, sf)
    return AC.new_activity_keys(f1, f2, _history_target(spark, sf), BETS_AS_OF)


def q_activity_upsert(spark, sf):
    """Full build of everything before the as-of month, then one incremental
    run; the table read back must equal a full refresh."""
    f1, f2 = _feeds(spark, sf)
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/kpiforge-activity/{uuid.uuid4().hex}"
    cut = as_timestamp(AC.first_incremental_month(BETS_AS_OF))
    before1 = f1.filter(F.col("ticket_delivery_date") < cut)
    before2 = f2.filter(F.coalesce("ticket_delivery_date", "kpi_date") < cut)
    AC.write_full(AC.monthly_status(before1, before2), path)
    AC.upsert_increment(spark, f1, f2, path, BETS_AS_OF)
    return AC.read_target(spark, path)


def q_append_columns(spark, sf):
    f1, f2 = _feeds(spark, sf)
    existing = _history_target(spark, sf)
    incoming = (AC.new_activity_keys(f1, f2, existing, BETS_AS_OF)
                .withColumn("source_count", F.lit(2).cast("bigint")))
    return AC.append_new_columns(existing, incoming)


# ---------------------------------------------------------------- contract
def _events_level(spark, sf):
    return events_level(Tables(spark, sf))


def q_contract_check(spark, sf):
    return CO.check(_events_level(spark, sf), CO.EVENTS_LEVEL)


def q_dq_not_null(spark, sf):
    return CO.not_null_report(_events_level(spark, sf), ["id", "last_updated_date", "customer_uid"])


def q_dq_unique(spark, sf):
    return CO.duplicate_keys(_events_level(spark, sf), "id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_project": q_scan_project,
    "valid_bets": q_valid_bets,
    "valid_bets_shared": q_valid_bets_shared,
    "lifetime_totals": _measures(B.LIFETIME),
    "rolling_30d": _measures(B.ROLLING_30),
    "lifetime_and_l30": q_lifetime_and_l30,
    "active_days": _measures(B.ACTIVE_DAYS),
    "first_last_activity": _measures(B.FIRST_LAST),
    "avg_per_slip": _measures(B.PER_SLIP),
    "guarded_ratios": q_guarded_ratios,
    "previous_day_sum": _measures(["previous_day_ggr"]),
    "real_money_counts": _measures(B.REAL_MONEY_COUNTS),
    "real_money_share": _measures(B.REAL_MONEY_SHARE),
    "bet_summary": q_bet_summary,
    "parlay_flag": q_parlay_flag,
    "distinct_sources": _measures(["sportsbook_sources"]),
    "league_group_counts": q_league_group_counts,
    "league_list": q_league_list,
    "settled_counts": q_settled_counts,
    "totals_by_dim_key": q_totals_by_dim_key,
    "latest_balance": q_latest_balance,
    "latest_campaign": q_latest_campaign,
    "enrolled_list": q_enrolled_list,
    "promo_kind": q_promo_kind,
    "rarest_promo_kind": q_rarest_promo_kind,
    "commonest_promo_kind": q_commonest_promo_kind,
    "latest_promo_kind": q_latest_promo_kind,
    "bonus_availability": q_bonus_availability,
    "fanout_activity": q_fanout_activity,
    "fanout_promo_kinds": q_fanout_promo_kinds,
    "mission_metrics": q_mission_metrics,
    "session_metrics": q_session_metrics,
    "relative_lift": q_relative_lift,
    "customer_base": q_customer_base,
    "distinct_dim": q_distinct_dim,
    "flag_join": q_flag_join,
    "chained_key_join": q_chained_key_join,
    "classification_fallback": q_classification_fallback,
    "labels_from_flags": q_labels_from_flags,
    "kpi_initial": q_kpi_initial,
    "kpi_batches": q_kpi_batches,
    "kpi_combined": q_kpi_combined,
    "reconcile_cells": q_reconcile_cells,
    "reconcile_numeric": q_reconcile_numeric,
    "reconcile_rows": q_reconcile_rows,
    "reconcile_columns": q_reconcile_columns,
    "drift_count": q_drift_count,
    "activity_months": q_activity_months,
    "monthly_status": q_monthly_status,
    "activity_new_keys": q_activity_new_keys,
    "activity_upsert": q_activity_upsert,
    "append_columns": q_append_columns,
    "contract_check": q_contract_check,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
}


def q_activity_stream(spark, sf):
    """The monthly status maintained by a file stream over both feeds
    (``foreachBatch`` upserts, ``availableNow``); read back, it equals the
    full refresh."""
    from kpiforge.streaming.activity_stream import run_activity_stream

    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/kpiforge-activity-stream/{uuid.uuid4().hex}"
    run_activity_stream(spark, sf, path)
    return AC.read_target(spark, path)


QUERIES["activity_stream"] = q_activity_stream


def _stored(spark, sf) -> StoredKpi:
    return StoredKpi(spark, sf, BETS_AS_OF, EVENTS_AS_OF)


def q_reconcile_kpi_columns(spark, sf):
    """The reference's own check: batches vs combined table, mismatching
    customers per column (over the full outer join of both tables). Both tables
    and their flags are stored once and read by every key below."""
    return RE.mismatch_columns(*_stored(spark, sf).batches_flags())


def q_reconcile_kpi_rows(spark, sf):
    flags, labels = _stored(spark, sf).batches_flags()
    return RE.mismatch_rows(flags, "customer_uid", labels)


QUERIES["reconcile_kpi_columns"] = q_reconcile_kpi_columns
QUERIES["reconcile_kpi_rows"] = q_reconcile_kpi_rows


def q_kpi_batches_two_hop(spark, sf):
    """The batches table built from the persisted initial table (written to
    the shared checkpoint folder first)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/kpiforge-kpi-initial/{uuid.uuid4().hex}"
    return K.batches_two_hop(_domain(spark, sf), BETS_AS_OF, EVENTS_AS_OF, path)


QUERIES["kpi_batches_two_hop"] = q_kpi_batches_two_hop


def q_drift_count_kpi(spark, sf):
    """The ad-hoc check on the real tables: combined RIGHT JOIN batches,
    distinct combined customers whose lifetime ggr/handle differs by > 0.1."""
    stored = _stored(spark, sf)
    new, old = stored.batches(), stored.combined()
    pred = F.abs(F.col("l.ggr_to_handle_lt") - F.col("r.ggr_to_handle_lt")) > 0.1
    return RE.drift_count(old, new, "customer_uid", pred)


QUERIES["drift_count_kpi"] = q_drift_count_kpi


def q_drift_counts_kpi(spark, sf):
    """Every predicate of the ad-hoc check, over one join of the real tables."""
    stored = _stored(spark, sf)
    new, old = stored.batches(), stored.combined()

    def unequal(name):
        return F.col(f"l.{name}") != F.col(f"r.{name}")

    def apart(left, right=None):
        return F.abs(F.col(f"l.{left}") - F.col(f"r.{right or left}")) > 0.1

    return RE.drift_counts(old, new, "customer_uid", {
        "bet_sports": unequal("bet_sports"),
        "all_rows": F.lit(True),
        "ggr_to_handle_lt": apart("ggr_to_handle_lt"),
        "most_common_bonus_type": unequal("most_common_bonus_type"),
        "most_recent_bonus_type": unequal("most_recent_bonus_type"),
        "most_recent_campaign_name": unequal("most_recent_campaign_name"),
        "bonus_to_ggr_l30": apart("bonus_to_ggr_l30"),
        "ggr_to_handle_l30": apart("ggr_to_handle_l30"),
        "cnt_real_7": apart("real_money_bet_cnt_last7", "cnt_real_7"),
        "bonus_to_ggr_lt": apart("bonus_to_ggr_lt"),
        "active_daily_handle_lt": apart("active_daily_handle_lt"),
        "manually_classified": unequal("manually_classified"),
    })


QUERIES["drift_counts_kpi"] = q_drift_counts_kpi


def q_last_stake(spark, sf):
    return CU.last_stake(_domain(spark, sf).sportsbook_stats)


QUERIES["last_stake"] = q_last_stake


def q_reconcile_initial_columns(spark, sf):
    """The other reference check: initial vs combined table, per column."""
    return RE.mismatch_columns(*_stored(spark, sf).initial_flags())


def q_reconcile_initial_rows(spark, sf):
    """Initial vs combined table, per customer."""
    flags, labels = _stored(spark, sf).initial_flags()
    return RE.mismatch_rows(flags, "customer_uid", labels)


QUERIES["reconcile_initial_columns"] = q_reconcile_initial_columns
QUERIES["reconcile_initial_rows"] = q_reconcile_initial_rows


# ---------------------------------------------------------------- stored tables
def q_bet_fact_stored(spark, sf):
    b = _stored(spark, sf).bet_fact()
    return b.select("customer_uid", "src_betslip_uuid", "bet_id", "wager_type", "league", "sport",
                    _money("handle"), F.col("bonus_total").cast("double").alias("bonus_cost"),
                    F.to_date("ticket_delivery_date").alias("delivery_date"))


def q_lifetime_and_l30_stored(spark, sf):
    return _stored(spark, sf).bet_measures()


def q_kpi_initial_stored(spark, sf):
    return _stored(spark, sf).initial()


def q_kpi_combined_stored(spark, sf):
    return _stored(spark, sf).combined()


def q_kpi_batches_stored(spark, sf):
    return _stored(spark, sf).batches()


def q_lifetime_and_l30_daily(spark, sf):
    """One load of everything before the last KPI day, one of that day alone,
    then the roll-up at the clock."""
    bets = _stored(spark, sf).bet_fact()
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpiforge-daily/{uuid.uuid4().hex}"
    last = BETS_AS_OF - dt.timedelta(days=1)
    DA.load(DA.bets_before(bets, last), root, "history")
    for day in (last, BETS_AS_OF):
        DA.load(DA.bets_of_day(bets, day), root, day.isoformat())
    later = bets.where(F.col("kpi_date") >= as_timestamp(BETS_AS_OF + dt.timedelta(days=1)))
    DA.load(later, root, "later")
    return DA.rolled_up(spark, root, BETS_AS_OF)


# ---------------------------------------------------------------- activity status as a stored model
def q_activity_new_keys_as_written(spark, sf):
    f1, f2 = _feeds(spark, sf)
    return AC.new_activity_keys(f1, f2, _history_target(spark, sf), BETS_AS_OF, match="as_written")


def _activity_path(spark):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpiforge-activity/{uuid.uuid4().hex}"


def q_build_status_full(spark, sf):
    path = _activity_path(spark)
    AC.build_status(spark, *_feeds(spark, sf), path, mode="full")
    return AC.read_target(spark, path)


def q_build_status_incremental(spark, sf):
    """From an empty target, in two runs of the incremental mode: the first month
    of the second run lies in the middle of the data."""
    f1, f2 = _feeds(spark, sf)
    path = _activity_path(spark)
    cut = as_timestamp(AC.first_incremental_month(BETS_AS_OF))
    first = f1.filter(F.col("ticket_delivery_date") < cut), f2.filter(F.coalesce("ticket_delivery_date", "kpi_date") < cut)
    AC.build_status(spark, *first, path, dt.date(1900, 1, 1), mode="incremental")
    AC.build_status(spark, f1, f2, path, BETS_AS_OF, mode="incremental")
    return AC.read_target(spark, path)


def q_evolved_target(spark, sf):
    """The stored target gains a column with an append; months written before show NULL."""
    f1, f2 = _feeds(spark, sf)
    path = _activity_path(spark)
    AC.write_full(_history_target(spark, sf), path)
    incoming = AC.new_activity_keys(f1, f2, AC.read_target(spark, path), BETS_AS_OF).withColumn("source_count", F.lit(2).cast("bigint"))
    AC.append_evolving(spark, incoming, path)
    return AC.read_target(spark, path)


# ---------------------------------------------------------------- contract at the moment of writing
def _gate(spark, sf) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpiforge-gate/{uuid.uuid4().hex}"
    CO.write_gate(_events_level(spark, sf), CO.EVENTS_LEVEL, path)
    return path


def q_contract_enforce(spark, sf):
    """The rows that keep the contract, as the gate wrote them."""
    t = CO.gate_target(spark, _gate(spark, sf))
    return t.select("id", "customer_uid", "cashout_count", F.col("requested_display_odds").cast("double").alias("requested_display_odds"),
                    F.col("prorated_stake").cast("double").alias("prorated_stake"), "start_date", "last_updated_date")


def q_contract_quarantine(spark, sf):
    """The rows that do not, and why."""
    q = CO.gate_quarantine(spark, _gate(spark, sf))
    return q.select("id", "customer_uid", "cashout_count", F.array_join("violations", ",").alias("violations"))


def q_contract_check_status(spark, sf):
    """The status table as built, against its declared contract."""
    path = _activity_path(spark)
    AC.build_status(spark, *_feeds(spark, sf), path, mode="full")
    return CO.check(AC.read_target(spark, path), CO.MONTHLY_STATUS)


def q_num_diff_sql(spark, sf):
    """R2 as a function of the session's catalog, called from SQL text."""
    from kpiforge.functions import sql as functions

    functions.register(spark)
    old, new = _versions(spark, sf)
    return spark.sql("""
        SELECT coalesce(n.customer_uid, o.customer_uid) AS customer_uid,
               num_diff(n.total_price, o.total_price, {tol}) AS diff_total_price,
               guarded_ratio(n.total_price, o.total_price) AS price_ratio
        FROM {old} o FULL OUTER JOIN {new} n ON n.customer_uid = o.customer_uid""", old=old, new=new, tol=RECONCILE_TOL)


# ---------------------------------------------------------------- forms that ran inside a wide table only
def q_league_group_counts_batches(spark, sf):
    return LG.league_group_counts(_domain(spark, sf).bets, BETS_AS_OF, "batches")


def q_parlay_flag_batches(spark, sf):
    return B.parlay_flag(_domain(spark, sf).bets, "batches")


def q_enrolled_list_uncapped(spark, sf):
    return CA.enrolled_list(_domain(spark, sf).bonus_activity, EVENTS_AS_OF, top_n=None, max_chars=None)


QUERIES |= {
    "bet_fact_stored": q_bet_fact_stored,
    "lifetime_and_l30_stored": q_lifetime_and_l30_stored,
    "lifetime_and_l30_daily": q_lifetime_and_l30_daily,
    "kpi_initial_stored": q_kpi_initial_stored,
    "kpi_combined_stored": q_kpi_combined_stored,
    "kpi_batches_stored": q_kpi_batches_stored,
    "activity_new_keys_as_written": q_activity_new_keys_as_written,
    "build_status_full": q_build_status_full,
    "build_status_incremental": q_build_status_incremental,
    "evolved_target": q_evolved_target,
    "contract_enforce": q_contract_enforce,
    "contract_quarantine": q_contract_quarantine,
    "contract_check_status": q_contract_check_status,
    "num_diff_sql": q_num_diff_sql,
    "league_group_counts_batches": q_league_group_counts_batches,
    "parlay_flag_batches": q_parlay_flag_batches,
    "enrolled_list_uncapped": q_enrolled_list_uncapped,
}
