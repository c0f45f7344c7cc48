"""Declared column contracts and data tests.

A :class:`Contract` is a list of typed columns with tests. :func:`check`
compares a DataFrame with it and runs the data tests in ONE aggregation pass
(``count_if(col IS NULL)`` per not_null column, ``count - count(distinct)``
per unique column), returning a per-column report instead of raising;
:func:`enforce` casts to the declared types and fails on a value that does
not fit; :func:`write_gate` splits the rows into a target and a quarantine in
one pass and counts both while it writes.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.sources import published

# Declared type names -> Spark types. BIGNUMERIC (76,38) has no Spark
# equivalent; decimal(38,18) keeps the integer range of NUMERIC and values
# beyond it become NULL (reported as cast failures).
TYPE_MAP = {
    "string": "string", "numeric": "decimal(38,9)", "bignumeric": "decimal(38,18)",
    "int64": "bigint", "integer": "bigint", "float64": "double", "bool": "boolean",
    "boolean": "boolean", "date": "date", "timestamp": "timestamp",
}


def spark_type(declared: str) -> str:
    return TYPE_MAP[declared.strip().lower()]


@dataclass(frozen=True)
class Column_:
    name: str
    data_type: str
    tests: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Column_, ...]
    enforced: bool = True
    on_schema_change: str = "append_new_columns"
    tags: tuple[str, ...] = field(default_factory=tuple)

    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, T._parse_datatype_string(spark_type(c.data_type)), "not_null" not in c.tests,
                          metadata={"comment": c.description} if c.description else {})
            for c in self.columns])


#: What the columns mean, for readers of the stored tables.
DESCRIPTIONS = {
    "id": "key of the row", "event_id": "the sports event", "location": "where the bet was placed",
    "src_betslip_uuid": "the slip the line belongs to", "customer_uid": "the customer", "bet_id": "the bet within its slip",
    "betslip_status": "state of the slip", "bet_combination_status": "state of the bet's combination",
    "ticket_delivery_date": "when the ticket reached the customer", "last_updated_date": "last change of the row",
    "src_campaign_id": "campaign the bet was placed under", "start_date": "start of the event",
    "kpi_timestamp_id": "day the row counts for", "originproviderid": "provider the event comes from",
    "requested_display_odds": "odds the customer saw", "cashout_count": "number of cash-outs", "prorated_stake": "stake shared out over the lines",
    "year_month": "first day of a month with activity",
    "activity_status": "Acquired in the first month, Retained after a month with activity, else Reactivated",
}


def _cols(spec: str, tests: dict[str, tuple[str, ...]] | None = None) -> tuple[Column_, ...]:
    tests = tests or {}
    out = []
    for line in spec.strip().splitlines():
        name, typ = line.split()
        out.append(Column_(name, typ, tests.get(name, ()), DESCRIPTIONS.get(name, "")))
    return tuple(out)


# The declared contract of the event-level sportsbook table
# (column name and declared type, in declaration order) and its tests.
EVENTS_LEVEL = Contract("kpi_sportsbook360_events_level_data", _cols("""
id string
event_id string
location string
prorated_stake NUMERIC
prorated_stake_lc NUMERIC
prorated_stake_tx NUMERIC
src_betslip_uuid string
bonus_campaign_type string
betslip_status string
origin_stake NUMERIC
betslip_type string
customer_uid string
ticket_delivery_date timestamp
last_updated_date timestamp
src_campaign_id string
event_name string
home string
away string
bet_outcome_id string
bet_combination_id STRING
bet_id STRING
event_status string
event_type string
start_date TIMESTAMP
event_group_name string
event_root_group_name string
event_parent_group_name string
channel string
wager_description string
requested_display_odds BIGNUMERIC
combination_odds NUMERIC
combination_payout_odds NUMERIC
market_id string
market_type string
originproviderid int64
selection string
currency string
void_by string
void_reason string
bet_combination_status string
market_name string
player_prop_flag string
market_line STRING
section STRING
team_player STRING
choice_parameter STRING
selection_granular STRING
kpi_timestamp_id date
possible_winnings numeric
possible_winnings_lc numeric
what_if_possible_winnings numeric
what_if_possible_winnings_lc numeric
cashout_count INTEGER
cash_out_type_name string
customer_placement_delay numeric
event_placement_delay numeric
applied_placement_delay NUMERIC
bet_outcome_status string
src_outcome_id string
prebuilt_boostfactor numeric
origin_possible_winnings numeric
origin_possible_winnings_lc numeric
origin_total_odds numeric
src_bonus_id string
""", {"id": ("not_null", "unique"), "last_updated_date": ("not_null",)}),
    enforced=True, on_schema_change="append_new_columns", tags=("mqt", "event", "kpi_mqt", "sportsbook"))

# The declared contract of the monthly status table.
MONTHLY_STATUS = Contract("customer_monthly_activity_status", _cols("""
customer_uid string
year_month DATE
activity_status string
"""), enforced=True, on_schema_change="append_new_columns", tags=("predicted", "revenue"))


def _type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """I7 + I9 + I10: one row per declared (or extra) column with
    ``expected_type``, ``actual_type``, ``issue`` ('missing', 'type',
    'extra' or NULL), ``null_count`` (not_null tests), ``duplicate_count``
    (unique tests), ``cast_failures`` (for a type issue: non-NULL values the
    declared type cannot hold, e.g. BIGNUMERIC beyond decimal(38,18)). Schema facts are metadata; the counts come from one
    aggregate over ``df``."""
    actual = {f.name: _type_name(f.dataType) for f in df.schema.fields}
    aggs = []
    for c in contract.columns:
        if c.name not in actual:
            continue
        if actual[c.name] != spark_type(c.data_type):
            # values the declared type cannot hold (overflow, bad text)
            col = F.col(c.name)
            aggs.append(F.count_if(col.isNotNull() & col.try_cast(spark_type(c.data_type)).isNull())
                        .alias(f"c__{c.name}"))
        if "not_null" in c.tests:
            aggs.append(F.count_if(F.col(c.name).isNull()).alias(f"n__{c.name}"))
        if "unique" in c.tests:
            # non-NULL values minus distinct non-NULL values = extra copies
            aggs.append((F.count(c.name) - F.count_distinct(c.name)).alias(f"u__{c.name}"))
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    rows = []
    declared = set()
    for c in contract.columns:
        declared.add(c.name)
        exp = spark_type(c.data_type)
        act = actual.get(c.name)
        issue = "missing" if act is None else (None if act == exp else "type")
        n = F.col(f"n__{c.name}") if act is not None and "not_null" in c.tests else F.lit(None).cast("bigint")
        u = F.col(f"u__{c.name}") if act is not None and "unique" in c.tests else F.lit(None).cast("bigint")
        cf = F.col(f"c__{c.name}") if issue == "type" else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(c.name).alias("column_name"), F.lit(exp).alias("expected_type"),
                             F.lit(act).cast("string").alias("actual_type"),
                             F.lit(issue).cast("string").alias("issue"),
                             n.cast("bigint").alias("null_count"), u.cast("bigint").alias("duplicate_count"),
                             cf.cast("bigint").alias("cast_failures")))
    for name, act in actual.items():
        if name not in declared:
            rows.append(F.struct(F.lit(name).alias("column_name"), F.lit(None).cast("string").alias("expected_type"),
                                 F.lit(act).alias("actual_type"), F.lit("extra").alias("issue"),
                                 F.lit(None).cast("bigint").alias("null_count"),
                                 F.lit(None).cast("bigint").alias("duplicate_count"),
                                 F.lit(None).cast("bigint").alias("cast_failures")))
    return counts.select(F.inline(F.array(*rows)))


def enforce(df: DataFrame, contract: Contract, strict: bool = False,
            append_new_columns: bool = True, on_loss: str = "fail") -> DataFrame:
    """Cast ``df`` to the contract. A value that does not fit its declared type
    fails the job (``on_loss="fail"``) or becomes NULL (``on_loss="null"``; see
    :func:`quarantined` for the rows concerned). Missing declared columns are added as typed NULLs; extra
    columns are kept when the policy is ``append_new_columns``. With
    ``strict`` a missing column raises."""
    have = set(df.columns)
    missing = [c.name for c in contract.columns if c.name not in have]
    if strict and missing:
        raise ValueError(f"contract {contract.name}: missing columns {missing}")
    if on_loss not in ("fail", "null"):
        raise ValueError(f"unknown on_loss {on_loss!r}")

    def fitted(c):
        value = F.col(c.name).try_cast(spark_type(c.data_type))
        if on_loss == "null":
            return value
        message = F.concat(F.lit(f"contract {contract.name}: {c.name} does not fit {c.data_type}: "), F.col(c.name).cast("string"))
        return F.when(_lost(c), F.raise_error(message)).otherwise(value)

    actual = dict(df.dtypes)
    cols = [(F.col(c.name) if actual.get(c.name) == spark_type(c.data_type) else fitted(c) if c.name in have
             else F.lit(None).cast(spark_type(c.data_type))).alias(c.name) for c in contract.columns]
    declared = {c.name for c in contract.columns}
    if append_new_columns:
        cols += [F.col(n) for n in df.columns if n not in declared]
    return df.select(*cols)


def _lost(c):
    """Whether the declared type cannot hold a non-NULL value."""
    return F.col(c.name).isNotNull() & F.col(c.name).try_cast(spark_type(c.data_type)).isNull()


def quarantined(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows with a value that does not fit the contract, and the names of
    those columns as ``lost_columns``; the others can be enforced without loss."""
    actual = dict(df.dtypes)
    some = [c for c in contract.columns if c.name in actual and actual[c.name] != spark_type(c.data_type)]
    lost = F.array_compact(F.array(*[F.when(_lost(c), F.lit(c.name)) for c in some])) if some else F.array().cast("array<string>")
    return df.withColumn("lost_columns", lost).where(F.size("lost_columns") > 0)


def not_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])))


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values present more than once, with their row count.
    (Partial aggregation map-side: a key with a third of all rows is
    combined per task before the shuffle.)"""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


# --------------------------------------------------------------------------
# Write gate: the enforced contract of a table, at the moment of writing.
# --------------------------------------------------------------------------
GATE = "gate"


def violations(df: DataFrame, contract: Contract):
    """An array column with one ``column:rule`` entry per value of the row that
    breaks the contract: ``type`` for a value the declared type cannot hold,
    ``not_null`` for a missing one."""
    actual = dict(df.dtypes)
    found = []
    for c in contract.columns:
        if c.name in actual and actual[c.name] != spark_type(c.data_type):
            found.append(F.when(_lost(c), F.lit(f"{c.name}:type")))
        if "not_null" in c.tests:
            missing = F.col(c.name).isNull() if c.name in actual else F.lit(True)
            found.append(F.when(missing, F.lit(f"{c.name}:not_null")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def gated(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` cast to the contract, with the column ``violations``; values that do
    not fit are NULL, their rows are the ones with a violation."""
    return documented(enforce(df.withColumn("violations", violations(df, contract)), contract, on_loss="null"), contract)


def documented(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` with the contract's descriptions as column comments; they are part of the schema a table is stored with."""
    text = {c.name: c.description for c in contract.columns if c.description}
    return df.select(*[F.col(n).alias(n, metadata={"comment": text[n]}) if n in text else F.col(n) for n in df.columns])


@contextmanager
def _conf(spark, settings: dict[str, str]):
    """The ``settings`` of the session, for as long as the block lasts."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_gate(df: DataFrame, contract: Contract, path: str) -> dict[str, int]:
    """Write ``df`` under its contract: rows without a violation to the target,
    the others to the quarantine, both published together by one pointer swap.

    One pass over ``df``; the rows and the violations of each rule are counted
    while they pass (``DataFrame.observe``). Returns these counts: ``rows``,
    ``quarantined`` and one per ``column:rule`` that occurred."""
    from pyspark.sql import Observation

    rules = [f"{c.name}:{rule}" for c in contract.columns for rule in ("type", "not_null")]
    seen = Observation()
    rows = gated(df, contract).withColumn(GATE, F.when(F.size("violations") > 0, "quarantine").otherwise("target"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("violations") > 0).alias("quarantined"),
                        *[F.count_if(F.array_contains("violations", r)).alias(r) for r in rules])
    folder = published.fresh_folder(path)
    # the two folders are written side by side: else Spark sorts the wide rows by folder
    # first, and plans that sort before it looks at the number of writers (at which it
    # sorts too: it must be above the two in use)
    with _conf(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.optimizer.plannedWrite.enabled": "false"}):
        rows.write.partitionBy(GATE).option("compression", "zstd").parquet(folder)
    published.point(df.sparkSession, path, {"folder": folder, "schema": rows.schema.json(), "buckets": None, "cluster_by": None,
                                            "partition_by": [GATE], "schema_version": 1})
    return {k: v for k, v in seen.get.items() if v or k in ("rows", "quarantined")}


def gate_target(spark, path: str) -> DataFrame:
    """The rows that passed the gate, in the contract's types."""
    return published.read(spark, path).where(F.col(GATE) == "target").drop(GATE, "violations")


def gate_quarantine(spark, path: str) -> DataFrame:
    """The rows that did not, with their ``violations``."""
    return published.read(spark, path).where(F.col(GATE) == "quarantine").drop(GATE)
