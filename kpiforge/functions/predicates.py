"""Row predicates used by the KPI operators.

All of them are ``Column`` builders over built-in functions, so Catalyst can
push the column-only ones into the Parquet scan and keep the rest inside
whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The status and promotion vocabularies of the bet fact.
SETTLED_SLIP_STATUSES = ("CLOSED", "VOIDED", "CASHED_OUT")
REJECTED_COMBINATION = "REJECTED"
FREE_PROMO_TYPES = ("FREE_BET", "RISK_FREE_BET_FREE_BET")
SETTLED_COMBINATION_STATUSES = ("WON", "LOST")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)))


def as_timestamp(value) -> Column:
    """Midnight of ``as_of`` (or the given instant) as a zone-less timestamp."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        ts = value
    else:
        d = value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))
        ts = dt.datetime(d.year, d.month, d.day)
    return F.lit(ts).cast("timestamp_ntz")


def valid_bet(slip_status="betslip_status", combo_status="bet_combination_status") -> Column:
    """Settled slip whose combination is not rejected, or a row with neither
    status. Three-valued: a NULL combination status passes only explicitly."""
    s, c = col(slip_status), col(combo_status)
    return ((s.isin(*SETTLED_SLIP_STATUSES) & ((c != REJECTED_COMBINATION) | c.isNull()))
            | (s.isNull() & c.isNull()))


def settled_slip(slip_status="betslip_status") -> Column:
    """Status-only variant (no rejected-combination test)."""
    return col(slip_status).isin(*SETTLED_SLIP_STATUSES)


def real_money(promo_type="bonus_campaign_type", free_types=FREE_PROMO_TYPES) -> Column:
    """Not a free-bet promotion. NULL promotion counts as real money."""
    return ~F.coalesce(col(promo_type), F.lit("")).isin(*free_types)


def within_days(ts, as_of, days: int) -> Column:
    """``date(ts) >= as_of - days`` with no upper bound (future rows pass)."""
    return F.to_date(col(ts)) >= F.date_sub(as_date(as_of), days)


def days_ago_at_most(ts, as_of, days: int) -> Column:
    """``date_diff(as_of, date(ts), day) <= days`` -- same rows as
    :func:`within_days`; kept as its own spelling for the lifetime/30-day CTE."""
    return F.datediff(as_date(as_of), F.to_date(col(ts))) <= days


def on_day_before(ts, as_of) -> Column:
    return F.to_date(col(ts)) == F.date_sub(as_date(as_of), 1)


def since_instant(ts, as_of, days: int) -> Column:
    """Timestamp look-back to the instant: ``ts >= as_of_ts - INTERVAL days``."""
    return col(ts) >= as_timestamp(as_of) - F.make_interval(days=F.lit(days))


def within_months(ts, as_of, months: int) -> Column:
    """``date(ts) >= as_of - INTERVAL months MONTH`` (month-end clamped)."""
    return F.to_date(col(ts)) >= F.add_months(as_date(as_of), -months)
