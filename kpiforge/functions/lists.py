"""Ordered string aggregates built from arrays.

Spark's ``listagg ... WITHIN GROUP`` cannot sit next to a DISTINCT aggregate
in the same ``agg`` (runtime failure in 4.1), so ordered lists are written as
``collect_set``/``collect_list`` + sort + ``array_join``. Every list gets a
total order and becomes NULL (not '') when no value qualifies, like the SQL
aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiforge.functions.predicates import col


def _null_if_empty(arr: Column, sep: str) -> Column:
    return F.when(F.size(arr) > 0, F.array_join(arr, sep))


def distinct_sorted_join(value, sep: str = ",") -> Column:
    """``STRING_AGG(DISTINCT v, sep ORDER BY v)``."""
    return _null_if_empty(F.array_sort(F.collect_set(col(value))), sep)


def sorted_join(value, sep: str = ",", descending: bool = False) -> Column:
    """``STRING_AGG(v, sep ORDER BY v [DESC])`` (duplicates kept)."""
    arr = F.sort_array(F.collect_list(col(value)), asc=not descending)
    return _null_if_empty(arr, sep)


def join_by_order_desc(value, order, tiebreak, sep: str = ",") -> Column:
    """``STRING_AGG(v, sep ORDER BY order DESC)``, ties broken by ``tiebreak``
    descending so the text is deterministic."""
    items = F.sort_array(
        F.collect_list(F.struct(col(order).alias("o"), col(tiebreak).alias("t"),
                                col(value).alias("v"))),
        asc=False)
    return _null_if_empty(F.transform(items, lambda s: s["v"]), sep)
