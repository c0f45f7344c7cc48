"""Engagement measures: missions (C9), sessions (C20), predicted-revenue
lift (C8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import relative_lift
from kpiforge.functions.predicates import since_instant
from kpiforge.operators.grained import Distinct, Plain, grained_agg

KEY = "customer_uid"


def mission_metrics(missions: DataFrame, as_of) -> DataFrame:
    """Active / completed mission counts, lifetime and 30-day cashback."""
    done = F.col("finished_reason") == "COMPLETED"
    recent = since_instant("assignment_completed_timestamp", as_of, 30)
    aid = F.col("assignment_id")
    # four conditional DISTINCT counts on one grain (the assignment)
    agg = grained_agg(missions, KEY, {"assignment": aid}, {
        "active_mission_count": Distinct("assignment", F.col("assignment_completed_timestamp").isNull()),
        "completed_mission_count": Distinct("assignment", done),
        "tiger_lifetime_cashback_lc": Plain("sum", F.col("payout_value_lc")),
        "tiger_l30_cashback_lc": Plain("sum", F.when(recent, F.col("payout_value_lc")).otherwise(F.lit(0))),
        "tiger_l30_missions_completed": Distinct("assignment", recent & done),
    })
    return agg.select(
        KEY, "active_mission_count", "completed_mission_count",
        F.col("tiger_lifetime_cashback_lc").cast("double").alias("tiger_lifetime_cashback_lc"),
        F.col("completed_mission_count").alias("tiger_lifetime_missions_completed"),
        F.col("tiger_l30_cashback_lc").cast("double").alias("tiger_l30_cashback_lc"),
        "tiger_l30_missions_completed")


def mission_counts(missions: DataFrame) -> DataFrame:
    """The initial build's mission CTE: active and completed mission counts
    only (two DISTINCT counts on one grain, one aggregate)."""
    aid = F.col("assignment_id")
    return grained_agg(missions, KEY, {"assignment": aid}, {
        "active_mission_count": Distinct("assignment", F.col("assignment_completed_timestamp").isNull()),
        "completed_mission_count": Distinct("assignment", F.col("finished_reason") == "COMPLETED"),
    })


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Average session length in minutes and seconds, distinct sessions.

    ``avg(seconds / 60)`` is evaluated as one division of the exact integer
    sum, so the value does not depend on the summation order.
    """
    s = F.col("session_length_seconds")
    agg = sessions.groupBy(KEY).agg(F.sum(s).alias("_sum"), F.count(s).alias("_n"),
                                    F.count_distinct("session_group_id").alias("total_sessions"))
    n = F.col("_n").cast("double")
    return agg.select(
        KEY,
        F.when(F.col("_n") > 0, F.col("_sum").cast("double") / (n * 60.0)).alias("avg_session_min"),
        F.when(F.col("_n") > 0, F.col("_sum").cast("double") / n).alias("avg_session_sec"),
        "total_sessions")


def relative_lift_table(predictions: DataFrame) -> DataFrame:
    """Predictions per customer with the bonus lift (epsilon for a zero base)."""
    return predictions.select(
        F.col("player_key").alias(KEY),
        "pred_real_money_active_days_next30_bonus_0",
        "pred_real_money_active_days_next30_bonus_1",
        relative_lift("predicted_revenue_next_30", "predicted_revenue_next_30_bonus")
        .alias("pred_active_days_next30_bonus_lift"),
        F.col("predicted_revenue_next_30").cast("double").alias("predicted_revenue_next_30"),
        F.col("predicted_revenue_next_active_day").cast("double").alias("predicted_revenue_next_active_day"),
        "predicted_revenue_segment")
