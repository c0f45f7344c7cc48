"""Reconciliation of two versions of a keyed table.

The reference diffs two builds of the customer table with one boolean flag
per compared column over a full outer join, then reports mismatches per row
and per column. Here the column pairs are data (a list of :class:`Pair`), so
the same operators serve any two tables.

Scale notes: the flag table is row-local (one projection over the full
join, no explode); the per-column report is ONE global aggregate of
``count_if`` per flag followed by an unpivot of that single row, instead of
unnesting every row into (column, flag) pairs first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.functions.measures import distinct_from, num_diff


@dataclass(frozen=True)
class Pair:
    """One compared column: ``left`` vs ``right`` reported as ``label``.

    kind: ``"exact"`` typed null-safe inequality; ``"text"`` the same after
    casting both sides to string (the reference's spelling); ``"numeric"``
    :func:`num_diff` after ``try_cast`` to double with the tolerance.
    """
    left: str
    right: str
    label: str
    kind: str = "exact"


def _flag(pair: Pair, tol: float) -> Column:
    a, b = F.col(f"l.{pair.left}"), F.col(f"r.{pair.right}")
    if pair.kind == "numeric":
        return num_diff(a.try_cast("double"), b.try_cast("double"), tol)
    if pair.kind == "text":
        return distinct_from(a.cast("string"), b.cast("string"))
    return distinct_from(a, b)


def diff_flags(left: DataFrame, right: DataFrame, key: str, pairs: Sequence[Pair],
               tol: float = 0.01, ignore: Sequence[str] = ()) -> DataFrame:
    """``key`` (coalesced over a full outer join) + ``diff_<label>``.

    A key present on one side only differs in every column whose other side
    is non-NULL. ``ignore`` drops labels (e.g. a load timestamp that differs
    on every build).
    """
    pairs = [p for p in pairs if p.label not in set(ignore)]
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "full")
    return j.select(F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key),
                    *[_flag(p, tol).alias(f"diff_{p.label}") for p in pairs])


def mismatch_rows(flags: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Per key, the number and comma-joined names of differing columns;
    only keys with at least one difference."""
    names = F.array_compact(F.array(*[F.when(F.col(f"diff_{n}"), F.lit(n)) for n in labels]))
    return (flags.select(key, names.alias("_cols"))
            .filter(F.size("_cols") > 0)
            .select(key, F.size("_cols").cast("bigint").alias("mismatch_count"),
                    F.array_join("_cols", ",").alias("mismatched_fields"))
            .orderBy(F.col("mismatch_count").desc(), F.col(key).asc()))


def mismatch_columns(flags: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Per column label, the number of keys that differ (only > 0)."""
    counts = flags.agg(*[F.count_if(F.col(f"diff_{n}")).alias(n) for n in labels])
    pairs = F.inline(F.array(*[F.struct(F.lit(n).alias("col_name"),
                                        F.col(n).alias("mismatched_customer_count")) for n in labels]))
    return (counts.select(pairs).filter(F.col("mismatched_customer_count") > 0)
            .orderBy(F.col("mismatched_customer_count").desc(), F.col("col_name").asc()))


def drift_count(left: DataFrame, right: DataFrame, key: str, predicate) -> DataFrame:
    """Distinct left keys after ``left RIGHT JOIN right`` under a required
    predicate over ``l.*`` / ``r.*`` columns (NULL comparisons drop rows)."""
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "right")
    return j.filter(predicate).agg(F.count_distinct(F.col(f"l.{key}")).alias("drift_count"))


def drift_counts(left: DataFrame, right: DataFrame, key: str, predicates: dict) -> DataFrame:
    """R6 for several named predicates at once: one join, then per left key whether
    any of its rows meets each predicate (on the join's own partitioning), then one
    row per name with the number of such keys."""
    j = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "right")
    per_key = j.where(F.col(f"l.{key}").isNotNull()).groupBy(F.col(f"l.{key}")).agg(
        *[F.bool_or(p).alias(n) for n, p in predicates.items()])
    counts = per_key.agg(*[F.count_if(F.col(n)).alias(n) for n in predicates])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("predicate"), F.col(n).alias("drift_count")) for n in predicates])))


def pair_labels(pairs: Sequence[Pair], ignore: Sequence[str] = ()) -> list[str]:
    return [p.label for p in pairs if p.label not in set(ignore)]


def reconcile(left: DataFrame, right: DataFrame, key: str, pairs: Sequence[Pair], tol: float = 0.01,
              ignore: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R1-R5 as one script: the flag table is materialised once (S6, the
    reference's temp table; ``persist`` spills to disk and is recomputed from
    lineage if an executor is lost) and feeds both reports. Returns
    ``(flags, per_row_report, per_column_report)``; call ``flags.unpersist()``
    when done."""
    from pyspark import StorageLevel

    flags = diff_flags(left, right, key, pairs, tol, ignore).persist(StorageLevel.MEMORY_AND_DISK)
    labels = pair_labels(pairs, ignore)
    return flags, mismatch_rows(flags, key, labels), mismatch_columns(flags, labels)
