"""Latest-row and top-N-per-key operators.

* :func:`latest_per_key` is ``row_number() over (partition by k order by ...
  desc) = 1`` written as an aggregate of ``max(struct(order..., payload...))``.
  The aggregate is combined map-side, so a key holding a third of all rows
  still leaves every map task as one row per key -- no window sort of a hot
  key in a single task.
* :func:`top_n_per_key` keeps the ``n`` first rows per key. It runs the
  window twice: first per ``(key, salt)`` and then per key over at most
  ``salt_buckets * n`` survivors, so a hot key is sorted in ``salt_buckets``
  tasks. The salt is a hash of a row column (deterministic: a retried task
  recomputes the same split after an executor loss). The result is exact.
* :func:`first_by_rank` picks the first row per key from an already
  aggregated, key-bounded relation (e.g. counts per key x category).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, key, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` tuple.

    ``order`` is compared lexicographically, NULLs lowest (``ORDER BY ... DESC
    NULLS LAST``); include a unique column last for a deterministic pick.
    """
    keys = _names(key)
    order, payload = list(order), [c for c in payload if c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload])).alias("_top")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_top.{c}").alias(c) for c in order + payload])


def top_n_per_key(df: DataFrame, key, order: Sequence[Column], n: int,
                  salt_col: str | None = None, salt_buckets: int = 16,
                  rank_name: str = "rn") -> DataFrame:
    """Rows with ``row_number() over (partition by key order by order) <= n``.

    ``order`` must be a total order within a key for the result to be
    deterministic. With ``salt_col`` the selection is done in two exact
    rounds (see module docstring).
    """
    keys = _names(key)
    if salt_col is not None and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salt_buckets))
        df = (df.withColumn("_salt", salt)
                .withColumn("_rn1", F.row_number().over(
                    Window.partitionBy(*keys, "_salt").orderBy(*order)))
                .filter(F.col("_rn1") <= n)
                .drop("_salt", "_rn1"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= n)


def first_by_rank(df: DataFrame, key, order: Sequence[Column], rank_name: str = "rn") -> DataFrame:
    """``QUALIFY row_number() over (partition by key order by ...) = 1`` on a
    relation with few rows per key."""
    w = Window.partitionBy(*_names(key)).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) == 1)
