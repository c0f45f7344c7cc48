"""Monthly activity status (I1-I6): Acquired / Retained / Reactivated /
Undefined per (customer, month), as a full build or incrementally into a
month-partitioned parquet table.

Scale notes
* The two feeds are reduced to distinct (customer, month) pairs first; the
  dedup aggregates map-side, so a customer with a third of all activity rows
  still leaves each map task as at most one row per month. After that a
  customer has at most one row per calendar month, so the per-customer
  window (first month, previous active month) is bounded by the calendar.
* Incremental runs filter the feeds on the raw timestamps (pushed into the
  Parquet scan) instead of on ``trunc(date(ts))``.
* The target is month-partitioned. A full build publishes a new version of it
  by swapping a pointer. An upsert appends: it reads only the partitions of
  the months it brings and of the months before these, and takes the first
  month of a customer from a small index beside the data, not from the
  history. Re-runs are idempotent.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kpiforge.functions.predicates import as_timestamp
from kpiforge.session import ensure_checkpoint_dir
from kpiforge.sources import published

KEY = "customer_uid"
MONTH = "year_month"
STATUS = "activity_status"


def month_of(ts: Column) -> Column:
    """``date_trunc(date(ts), month)`` as a DATE."""
    return F.trunc(F.to_date(ts), "MM")


def first_incremental_month(as_of) -> dt.date:
    d = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    # months > trunc(as_of - 1 month)  <=>  months >= first day of as_of's month
    return dt.date(d.year, d.month, 1)


def feed_months(feed: DataFrame, second_feed: DataFrame | None, since=None) -> DataFrame:
    """(customer, month) of every activity row of both feeds, duplicates kept
    (usable on streaming DataFrames). The second feed's activity time is its
    delivery time, else its KPI time. ``since`` (a date) keeps only activity
    at or after that instant; ``second_feed=None`` uses the first feed alone."""
    t1 = F.col("ticket_delivery_date")
    t2 = F.coalesce(F.col("ticket_delivery_date"), F.col("kpi_date"))
    f1 = feed.filter(t1.isNotNull())
    f2 = None if second_feed is None else second_feed.filter(t2.isNotNull())
    if since is not None:
        lo = as_timestamp(since)
        f1 = f1.filter(t1 >= lo)
        if f2 is not None:
            # written per column so each half can be pushed to the scan
            f2 = f2.filter((F.col("ticket_delivery_date") >= lo)
                           | (F.col("ticket_delivery_date").isNull() & (F.col("kpi_date") >= lo)))
    a = f1.select(KEY, month_of(t1).alias(MONTH))
    if f2 is None:
        return a
    return a.unionByName(f2.select(KEY, month_of(t2).alias(MONTH)))


def activity_months(feed: DataFrame, second_feed: DataFrame | None, since=None) -> DataFrame:
    """Distinct (customer, month) from both feeds (UNION DISTINCT)."""
    return feed_months(feed, second_feed, since).distinct()


def status_expr(first: Column, prev_active: Column, month: Column, known: Column) -> Column:
    """The CASE of the model. ``known`` is false for rows whose customer is
    NULL: their lookups never match, so they end as 'Undefined'."""
    return (F.when(known & (first == month), F.lit("Acquired"))
             .when(known & prev_active, F.lit("Retained"))
             .when(known & (first < month) & ~prev_active, F.lit("Reactivated"))
             .otherwise(F.lit("Undefined")))


def classify_months(months: DataFrame) -> DataFrame:
    """I2 (full refresh): first active month and previous-month activity per
    customer, by a window over the customer's (bounded) month rows."""
    w = Window.partitionBy(KEY).orderBy(MONTH)
    prev = F.lag(MONTH).over(w)
    first = F.min(MONTH).over(Window.partitionBy(KEY))
    m = F.col(MONTH)
    prev_active = F.coalesce(prev == F.add_months(m, -1), F.lit(False))
    return months.select(KEY, MONTH, status_expr(first, prev_active, m, F.col(KEY).isNotNull()).alias(STATUS))


def monthly_status(feed: DataFrame, second_feed: DataFrame | None) -> DataFrame:
    return classify_months(activity_months(feed, second_feed))


def new_activity_keys(feed: DataFrame, second_feed: DataFrame, target: DataFrame, as_of,
                      match: str = "keys") -> DataFrame:
    """I3 + I4: months after the previous month that the target lacks.

    match="keys" (default, the unique key of the model): anti join on
    (customer, month), NULL-safe on the customer so re-runs are idempotent.
    match="as_written" is the reference's correlated NOT EXISTS, whose unqualified
    ``customer_uid`` binds to the target itself (L6): any target row with a
    customer in that month blocks every customer of the month. match="month"
    is the same condition as a join.
    """
    months = activity_months(feed, second_feed, since=first_incremental_month(as_of))
    if match == "as_written":
        same_month = F.col(f"t.{MONTH}") == F.col(f"m.{MONTH}").outer()
        captured = F.col(f"t.{KEY}") == F.col(f"t.{KEY}")
        return months.alias("m").where(~target.alias("t").where(same_month & captured).exists())
    if match == "month":
        blocked = target.filter(F.col(KEY).isNotNull()).select(MONTH).distinct()
        return months.join(blocked, MONTH, "left_anti")
    # NULL-safe on the customer: a (NULL, month) row already in the target
    # must block its re-insert, or every re-run would duplicate it.
    t = target.select(F.col(KEY).alias("_tk"), F.col(MONTH).alias("_tm"))
    cond = F.col(KEY).eqNullSafe(F.col("_tk")) & (F.col(MONTH) == F.col("_tm"))
    return months.join(t, cond, "left_anti")


def classify_increment(new_keys: DataFrame, target: DataFrame) -> DataFrame:
    """Status of the new (customer, month) rows with history from the target.

    (The reference classifies the increment on its own, which makes every
    customer 'Acquired'; looking up target + increment gives the same answer
    as a full refresh.) History = first month per customer over target and
    increment (one aggregate) and the previous month's presence (one join).
    """
    hist = target.select(KEY, MONTH).unionByName(new_keys.select(KEY, MONTH))
    first = hist.groupBy(KEY).agg(F.min(MONTH).alias("_first"))
    prev = hist.select(F.col(KEY).alias("_pk"), F.add_months(F.col(MONTH), 1).alias("_pm")).distinct()
    j = (new_keys.join(first, KEY, "left")
         .join(prev, (F.col(KEY) == F.col("_pk")) & (F.col(MONTH) == F.col("_pm")), "left"))
    return j.select(KEY, MONTH, status_expr(F.col("_first"), F.col("_pk").isNotNull(), F.col(MONTH),
                                            F.col(KEY).isNotNull()).alias(STATUS))


def _clustered(df: DataFrame) -> DataFrame:
    """Partition by month, cluster (sort) by customer within each file. Rebalanced:
    AQE splits a month of many rows over several write tasks and merges small ones."""
    return df.hint("rebalance", MONTH).sortWithinPartitions(MONTH, KEY)


TARGET_SCHEMA = f"{KEY} bigint, {MONTH} date, {STATUS} string"

#: Folder of the first-month index inside a version of the target. Readers of
#: the data skip names that begin with an underscore.
FIRST = "_first_month"


def write_full(df: DataFrame, path: str) -> None:
    """Full refresh of the partitioned target: a new version (data and first-month
    index) is written beside the old one, then the pointer is swapped."""
    spark = df.sparkSession
    folder = published.fresh_folder(path)
    _clustered(df).write.partitionBy(MONTH).parquet(folder)
    schema = df.schema
    _first_months(spark.read.schema(schema).parquet(folder)).write.parquet(f"{folder}/{FIRST}")
    before = published.current(spark, path)
    published.point(spark, path, {"folder": folder, "schema": schema.json(), "buckets": None, "cluster_by": KEY, "partition_by": [MONTH],
                                  "schema_version": (before or {}).get("schema_version", 0) + 1})


def _first_months(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min(MONTH).alias("first_month"))


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """The target with all columns it has gained so far; months written before a
    column was added show NULL in it."""
    return published.read(spark, path)


def first_months(spark: SparkSession, path: str) -> DataFrame:
    """(customer, first month) of the target. Late months of known customers are
    further rows of the index, so the least counts."""
    folder = published.current(spark, path)["folder"]
    index = spark.read.schema(f"{KEY} bigint, first_month date").parquet(f"{folder}/{FIRST}")
    return index.groupBy(KEY).agg(F.min("first_month").alias("first_month"))


def _hadoop_path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder on its file system (not a single file)."""
    p, fs = _hadoop_path(spark, path)
    return fs.getFileStatus(p).isDirectory()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (shared) file system."""
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p)


def ensure_target(spark: SparkSession, path: str) -> None:
    """Create an empty partitioned target if ``path`` holds none yet."""
    if published.current(spark, path) is None:
        write_full(spark.createDataFrame([], TARGET_SCHEMA), path)


def touched(target: DataFrame, months: list[dt.date]) -> DataFrame:
    """The target's partitions of these months: a partition filter, so no other file is listed or read."""
    return target.where(F.col(MONTH).isin(months))


def new_rows(months: DataFrame, batch_months: list[dt.date], target: DataFrame, first: DataFrame) -> DataFrame:
    """The (customer, month) pairs of ``months`` that the target lacks, with their
    status. Only the target's partitions of ``batch_months`` and of the months
    before these are read; ``first`` holds each customer's first month so far."""
    before = [(m - dt.timedelta(days=1)).replace(day=1) for m in batch_months]
    have = touched(target, batch_months).select(F.col(KEY).alias("_tk"), F.col(MONTH).alias("_tm"))
    cond = F.col(KEY).eqNullSafe(F.col("_tk")) & (F.col(MONTH) == F.col("_tm"))
    new_keys = months.select(KEY, MONTH).distinct().join(have, cond, "left_anti")
    known = touched(target, sorted({*batch_months, *before})).select(KEY, MONTH)
    prev = (known.unionByName(new_keys).where(F.col(KEY).isNotNull())
            .select(F.col(KEY).alias("_pk"), F.add_months(F.col(MONTH), 1).alias("_pm")).distinct())
    firsts = (first.toDF("_fk", "_fm").unionByName(_first_months(new_keys).toDF("_fk", "_fm"))
              .groupBy("_fk").agg(F.min("_fm").alias("_fm")))
    j = (new_keys.join(firsts, F.col(KEY) == F.col("_fk"), "left")
         .join(prev, (F.col(KEY) == F.col("_pk")) & (F.col(MONTH) == F.col("_pm")), "left"))
    return j.select(KEY, MONTH, status_expr(F.col("_fm"), F.col("_pk").isNotNull(), F.col(MONTH), F.col(KEY).isNotNull()).alias(STATUS))


def upsert_months(spark: SparkSession, months: DataFrame, path: str, staging_root: str | None = None) -> int:
    """I5 core: insert the (customer, month) pairs the target lacks, with
    their status. Returns the number of new rows.

    The batch's pairs are staged in the shared checkpoint folder; their distinct
    months (a handful: the calendar bounds them) become the partition filter of
    the target. The new rows are staged too, which cuts the lineage back to the
    target, then appended: first to the first-month index, then to the data --
    existing rows never change, so none is written again. Re-running with the
    same input inserts nothing, also after a run that failed in between: an index
    row without its data row gives the same status when the data row comes.
    """
    staging_root = staging_root or ensure_checkpoint_dir(spark)
    stage = f"{staging_root.rstrip('/')}/kpiforge-staging/{uuid.uuid4().hex}"
    months.select(KEY, MONTH).distinct().write.parquet(f"{stage}/pairs")
    pairs = spark.read.schema(f"{KEY} bigint, {MONTH} date").parquet(f"{stage}/pairs")
    batch_months = sorted(r[0] for r in pairs.select(MONTH).distinct().collect())
    n_new = 0
    if batch_months:
        record = published.current(spark, path)
        rows = new_rows(pairs, batch_months, read_target(spark, path), first_months(spark, path))
        rows.write.parquet(f"{stage}/rows")
        staged = spark.read.schema(TARGET_SCHEMA).parquet(f"{stage}/rows")
        n_new = staged.count()
        if n_new:
            _first_months(staged).write.mode("append").parquet(f"{record['folder']}/{FIRST}")
            _clustered(staged).write.mode("append").partitionBy(MONTH).parquet(record["folder"])
    p, fs = _hadoop_path(spark, stage)
    fs.delete(p, True)
    return n_new


def append_evolving(spark: SparkSession, rows: DataFrame, path: str, on_schema_change: str = "append_new_columns") -> list[str]:
    """I8 on the stored target: append ``rows``, which may bring columns the target
    does not have yet. Returns the names of the columns added.

    ``append_new_columns`` (the model's setting) adds them: the pointer's schema
    and schema version change once the rows are in; older files show NULL.
    ``ignore`` drops them, ``fail`` refuses them. A column of another type than
    the target's is refused always. Columns that ``rows`` lacks are NULL."""
    record = published.current(spark, path)
    have = read_target(spark, path).schema
    known = dict(read_target(spark, path).dtypes)
    changed = [name for name, kind in rows.dtypes if known.get(name, kind) != kind]
    if changed:
        raise ValueError(f"columns of another type than the target's: {changed}")
    added = [f for f in rows.schema.fields if f.name not in known]
    if added and on_schema_change == "fail":
        raise ValueError(f"columns that the target does not have: {[f.name for f in added]}")
    if on_schema_change not in ("append_new_columns", "ignore", "fail"):
        raise ValueError(f"unknown on_schema_change {on_schema_change!r}")
    if on_schema_change == "ignore":
        added = []
    full = [*have.fields, *added]
    out = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in full])
    _first_months(out).write.mode("append").parquet(f"{record['folder']}/{FIRST}")
    _clustered(out).write.mode("append").partitionBy(MONTH).parquet(record["folder"])
    if added:
        published.point(spark, path, {**record, "schema": StructType([StructField(f.name, f.dataType) for f in full]).json(),
                                      "schema_version": record["schema_version"] + 1})
    return [f.name for f in added]


def upsert_increment(spark: SparkSession, feed: DataFrame, second_feed: DataFrame | None,
                     path: str, as_of, staging_root: str | None = None) -> int:
    """I5 as the reference schedules it: only months from the as-of month on
    (``month > trunc(as_of - 1 month)``), read with a pushed-down timestamp
    range, then :func:`upsert_months`."""
    months = feed_months(feed, second_feed, since=first_incremental_month(as_of))
    return upsert_months(spark, months, path, staging_root)


def build_status(spark: SparkSession, feed: DataFrame, second_feed: DataFrame | None, path: str,
                 as_of=None, mode: str = "incremental") -> int | None:
    """The model's two run modes. ``full`` rebuilds the whole partitioned
    target; ``incremental`` upserts the months from ``as_of``'s on (the
    target is created empty on first use)."""
    if mode == "full":
        write_full(monthly_status(feed, second_feed), path)
        return None
    if mode != "incremental":
        raise ValueError(f"unknown mode {mode!r}")
    ensure_target(spark, path)
    return upsert_increment(spark, feed, second_feed, path, as_of)


def append_new_columns(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """I8: ``on_schema_change: append_new_columns`` -- union by name, columns
    missing on either side become NULL."""
    return existing.unionByName(incoming, allowMissingColumns=True)
