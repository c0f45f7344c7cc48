"""Several DISTINCT measures per key in two hash-aggregation levels.

Spark plans ``count(DISTINCT a), count(DISTINCT CASE WHEN c THEN a END),
count(DISTINCT b) ...`` by expanding every input row once per distinct
expression and, when an object aggregate such as ``collect_set`` sits in the
same SELECT, by switching the whole aggregate to sort-based object
aggregation. For the bet KPIs that is 7 copies of every row.

Here distinct measures are declared on a *grain* (the distinct value) plus a
row condition; measures that share a grain share one copy of the row:

level 1  ``groupBy(key, grain id, grain value)`` with one ``bit_or`` of a mask
         that holds the conditions of the grain's distinct measures, a bit
         each -- narrow, fixed-width buffers, a codegen'd HashAggregate with
         a map-side partial step. Grains of one type share the value column
         (:func:`_column_type`). The shuffle is on (key, grain value), so a
         key holding a third of all rows is still spread over all reducers.
level 2  ``groupBy(key)``: ``count_if(grain = g AND bit)`` per distinct
         measure and small ordered lists collected from their (already
         distinct) grain rows; partial aggregation map-side again.

Plain aggregates (sums, min/max) run as a separate ``groupBy(key)`` combined
with the distinct result per key (see :func:`grained_agg`). That reads the source twice, but
the two passes read mostly different columns of a columnar table (amounts
for the sums; ids, dates and labels for the grains), so the extra I/O is the
shared key and condition columns -- far less than widening every shuffled
grain row with all sum buffers.

Results equal the SQL aggregates exactly (NULL grain values are not counted;
a NULL or false condition does not count).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Plain:
    """An ordinary aggregate over all rows: ``fn`` in sum/min/max/bool_or."""
    fn: str
    expr: Column


@dataclass(frozen=True)
class Distinct:
    """``count(DISTINCT CASE WHEN cond THEN value END)`` on grain ``grain``."""
    grain: str
    cond: Column | None = None


@dataclass(frozen=True)
class DistinctList:
    """``string_agg(DISTINCT value, sep ORDER BY value [DESC])`` on grain
    ``grain`` (NULL when no value), optionally upper-cased afterwards. A row
    condition goes into the grain expression (``when(cond, value)``). The
    list is collected per key, so use it for grains with a small vocabulary
    per key (sources, league groups), not for ids."""
    grain: str
    sep: str = ","
    descending: bool = False
    upper: bool = False


_FN = {"sum": F.sum, "min": F.min, "max": F.max, "bool_or": F.bool_or}


def _column_type(dtype: str, listed: bool) -> str:
    """The type of the column that carries a grain of type ``dtype``. Integers and
    dates are carried as bigint, one to one, unless their values are ``listed``."""
    return "bigint" if not listed and dtype in ("tinyint", "smallint", "int", "date") else dtype


def grained_agg(df: DataFrame, key: str, grains: dict[str, Column],
                measures: dict[str, Plain | Distinct | DistinctList]) -> DataFrame:
    """Aggregate ``measures`` per ``key``; ``grains`` maps a grain name to the
    column expression whose distinct values it counts.

    Plain aggregates run as their own ``groupBy(key)`` (map-side combined,
    narrow buffers); the distinct grains run through the two-level path
    below; the two per-key results are combined by a union and a per-key
    max (both sides are hash-partitioned on the key, so no exchange). Keeping the plain buffers out of the grain rows
    matters: an aggregate's buffer schema is shared by all its groups, so
    riding along would put every sum buffer into every grain row shuffled.
    """
    used = [g for g in grains if any(isinstance(m, (Distinct, DistinctList)) and m.grain == g
                                     for m in measures.values())]
    gid = {g: i + 1 for i, g in enumerate(used)}
    plain = {n: m for n, m in measures.items() if isinstance(m, Plain)}
    dist = {n: m for n, m in measures.items() if isinstance(m, Distinct)}

    # Plain path; it also fixes the key universe (every key with a row).
    # Without plain measures there is no plain path: a narrow presence row
    # per input row (grain 0) keeps every key, and the result is a single
    # aggregate on the key -- which Catalyst knows is unique per key (so an
    # unused left join to it can be eliminated).
    plain_df = None
    if plain or not used:
        plain_df = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"),
                                       *[_FN[m.fn](m.expr).alias(n) for n, m in plain.items()])
    if not used:
        return plain_df.select(key, *measures.keys())

    # Distinct path. One struct per grain with the same fields: its number, a
    # column per type of value, the mask of its measures. A copy whose
    # grain value is NULL, or for which no condition of the grain's measures
    # holds, can never be counted or listed: it is not emitted.
    src = df.select(
        F.col(key),
        *[grains[g].alias(f"_gv{gid[g]}") for g in used],
        *[F.coalesce(m.cond if m.cond is not None else F.lit(True), F.lit(False)).alias(f"_fv_{n}")
          for n, m in dist.items()],
    )
    types = dict(src.dtypes)
    listed = {m.grain for m in measures.values() if isinstance(m, DistinctList)}
    carried = {g: _column_type(types[f"_gv{gid[g]}"], g in listed) for g in used}
    column = {t: f"_k{i}" for i, t in enumerate(dict.fromkeys(carried.values()), 1)}
    bit: dict[str, int] = {}
    for g in used:
        here = [n for n, m in dist.items() if m.grain == g]
        if len(here) > 63:
            raise ValueError(f"grain {g}: more than 63 distinct measures")
        bit.update({n: 1 << i for i, n in enumerate(here)})

    def value(g):
        v = F.col(f"_gv{gid[g]}")
        return (F.unix_date(v) if types[f"_gv{gid[g]}"] == "date" and carried[g] == "bigint" else v).cast(carried[g])

    def mask(g):
        bits = [F.when(F.col(f"_fv_{n}"), F.lit(bit[n])).otherwise(F.lit(0)) for n, m in dist.items() if m.grain == g]
        return reduce(Column.bitwiseOR, bits, F.lit(0)).cast("bigint")

    def counts(g):
        here = [m for m in measures.values() if isinstance(m, (Distinct, DistinctList)) and m.grain == g]
        emitted = F.col(f"_gv{gid[g]}").isNotNull()
        if all(isinstance(m, Distinct) and m.cond is not None for m in here):
            emitted &= reduce(Column.__or__, [F.col(f"_fv_{n}") for n, m in dist.items() if m.grain == g])
        return emitted

    structs = []
    nothing = {t: F.lit(None).cast(t) for t in column}
    masks = [F.lit(0).cast("bigint").alias("_m")] if dist else []
    if plain_df is None:
        structs.append(F.struct(F.lit(0).alias("_g"), *[v.alias(column[t]) for t, v in nothing.items()], *masks))
    for g in used:
        values = [(value(g) if t == carried[g] else v).alias(column[t]) for t, v in nothing.items()]
        structs.append(F.when(counts(g), F.struct(F.lit(gid[g]).alias("_g"), *values, *([mask(g).alias("_m")] if dist else []))))
    rows = src.select(F.col(key), F.inline(F.array_compact(F.array(*structs))))

    # level 1: dedup per (key, grain, value); shuffle spreads a hot key
    group_cols = [key, "_g", *column.values()]
    lvl1 = rows.groupBy(*group_cols).agg(F.bit_or("_m").alias("_m")) if dist else rows.select(*group_cols).distinct()

    # level 2: per key counts (and short ordered lists)
    outs = []
    for n, m in measures.items():
        if isinstance(m, Distinct):
            outs.append(F.count_if((F.col("_g") == gid[m.grain]) & (F.col("_m").bitwiseAND(F.lit(bit[n]).cast("bigint")) != 0)).alias(n))
        elif isinstance(m, DistinctList):
            # the grain's rows are already distinct per key: a short list
            g = gid[m.grain]
            vals = F.sort_array(F.collect_list(F.when(F.col("_g") == g, F.col(column[carried[m.grain]]))), asc=not m.descending)
            text = F.array_join(vals, m.sep)
            outs.append(F.when(F.size(vals) > 0, F.upper(text) if m.upper else text).alias(n))
    dist_df = lvl1.groupBy(key).agg(*outs)
    if plain_df is None:
        return dist_df.select(key, *measures.keys())

    # Combine the two per-key results: UNION ALL + groupBy(key) with max.
    # Each side has at most one row per key and each measure comes from one
    # side, so max picks it; GROUP BY keeps the NULL key as one group (a join
    # would drop it, a NULL-safe join would re-shuffle both sides on
    # coalesced keys). Both inputs are hash-partitioned on the key and the
    # union keeps that partitioning, so this adds no exchange, and the
    # result is one aggregate per key.
    both = plain_df.select(key, *plain.keys()).unionByName(dist_df, allowMissingColumns=True)
    out = both.groupBy(key).agg(*[F.max(n).alias(n) for n in measures])
    cols = []
    for n, m in measures.items():
        # a key with no countable grain row has count 0 (and no list)
        cols.append(F.coalesce(F.col(n), F.lit(0)).alias(n) if isinstance(m, Distinct) else F.col(n))
    return out.select(key, *cols)
