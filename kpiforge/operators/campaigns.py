"""Campaign dispatch operators: most recent campaign (C6) and the ordered
list of enrolled campaigns (C7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.functions import lists
from kpiforge.functions.predicates import since_instant
from kpiforge.operators.latest import latest_per_key, top_n_per_key

KEY = "customer_uid"
DISPATCH = "bonus-dispatch"
ENROLLED_DAYS = 180        # look-back of the enrolled list
ENROLLED_TOP_N = 2000      # newest dispatches kept per customer
ENROLLED_MAX_CHARS = 10000  # text cap of the joined list


def dispatches(activity: DataFrame) -> DataFrame:
    return activity.filter((F.col("subtype") == DISPATCH) & (F.col("value") == 1))


def latest_campaign(activity: DataFrame) -> DataFrame:
    """Latest dispatched campaign per customer (ties: greater event id)."""
    top = latest_per_key(dispatches(activity), KEY, ["message_timestamp", "event_id"], ["src_campaign_id"])
    return top.select(KEY, F.col("src_campaign_id").alias("most_recent_active_campaign_id"))


def enrolled_list(activity: DataFrame, as_of, top_n: int | None = ENROLLED_TOP_N,
                  salt_buckets: int = 16, max_chars: int | None = ENROLLED_MAX_CHARS) -> DataFrame:
    """Campaigns dispatched in the last 180 days (to the instant), newest
    first, at most ``top_n`` per customer, joined by ',' and cut at
    ``max_chars`` characters. Both limits are the reference's; ``None`` lifts
    them (then the list grows with a customer's dispatches). The top-N runs salted (exact) so a customer with a huge
    dispatch history is ranked in parallel; the per-customer list that is
    finally collected holds at most ``top_n`` entries. Without ``top_n`` each
    day of a customer is joined by itself first, and then the days: no task
    sorts all dispatches of a customer."""
    recent = dispatches(activity).filter(since_instant("message_timestamp", as_of, ENROLLED_DAYS))
    order = [F.col("message_timestamp").desc(), F.col("event_id").desc()]
    kept = recent.select(KEY, "event_id", "src_campaign_id", "message_timestamp")
    joined = lists.join_by_order_desc("src_campaign_id", "message_timestamp", "event_id", ",")
    if top_n is not None:
        kept = top_n_per_key(kept, KEY, order, top_n, salt_col="event_id", salt_buckets=salt_buckets)
    else:  # a day without any campaign id adds nothing to the text, not even a comma
        kept = kept.groupBy(KEY, F.to_date("message_timestamp").alias("_day")).agg(
            F.when(F.count("src_campaign_id") > 0, joined).alias("_text"))
        joined = lists.join_by_order_desc("_text", "_day", "_text", ",")
    if max_chars is not None:
        joined = F.substring(joined, 1, max_chars)
    return kept.groupBy(KEY).agg(joined.alias("enrolled_bonus_campaigns"))
