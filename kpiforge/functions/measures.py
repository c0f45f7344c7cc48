"""Scalar measure helpers: guarded ratios, lifts, labels, null-safe diffs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiforge.functions.predicates import col


def dbl(c) -> Column:
    return col(c).cast("double")


def guarded_ratio(num, den) -> Column:
    """``CASE WHEN den = 0 THEN NULL ELSE num / den END`` in double.

    Both operands are cast to double first so the quotient is one IEEE
    division of exactly summed values (engine-independent); a NULL
    denominator gives NULL, as in SQL.
    """
    d = dbl(den)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(dbl(num) / d)


def relative_lift(base, with_bonus, epsilon: float = 0.01) -> Column:
    """(with_bonus - base) / base, with ``epsilon`` standing in for a zero base."""
    b, w = dbl(base), dbl(with_bonus)
    return (F.when(b == 0, (w - F.lit(epsilon)) / F.lit(epsilon))
             .otherwise((w - b) / b))


def label(cond, yes: str, no: str) -> Column:
    """Boolean to text label; NULL falls to the ``no`` label (CASE WHEN c)."""
    return F.when(col(cond), F.lit(yes)).otherwise(F.lit(no))


def distinct_from(a, b) -> Column:
    """SQL ``a IS DISTINCT FROM b``."""
    return ~col(a).eqNullSafe(col(b))


def num_diff(a, b, tol) -> Column:
    """Numeric mismatch: exactly one side NULL, or both set and ``|a-b| > tol``."""
    a, b = col(a), col(b)
    return ((a.isNull() != b.isNull())
            | (a.isNotNull() & b.isNotNull() & (F.abs(a - b) > F.lit(tol))))
