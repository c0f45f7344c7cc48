"""Monthly status (incremental = full refresh), reconciliation invariants,
contract checks."""

import datetime as dt
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from kpiforge.operators import activity as AC
from kpiforge.operators import contract as CO
from kpiforge.operators import reconcile as RE
from kpiforge.plans import queries as Q
from kpiforge.sources.domain import Domain, customer_versions, events_level
from kpiforge.sources.tables import Tables

TS = dt.datetime


def _feed(spark, data):
    return spark.createDataFrame(data, "customer_uid long, ticket_delivery_date timestamp_ntz")


def _second(spark, data):
    return spark.createDataFrame(data, "customer_uid long, ticket_delivery_date timestamp_ntz, "
                                       "kpi_date timestamp_ntz")


def test_status_branches(spark):
    f1 = _feed(spark, [(1, TS(2024, 1, 5)), (1, TS(2024, 2, 5)), (1, TS(2024, 4, 5)), (2, TS(2024, 3, 1))])
    f2 = _second(spark, [(None, TS(2024, 1, 1), TS(2024, 1, 1)), (2, None, TS(2024, 4, 9))])
    got = rows(AC.monthly_status(f1, f2))
    assert got == [
        (None, dt.date(2024, 1, 1), "Undefined"),
        (1, dt.date(2024, 1, 1), "Acquired"), (1, dt.date(2024, 2, 1), "Retained"),
        (1, dt.date(2024, 4, 1), "Reactivated"),
        (2, dt.date(2024, 3, 1), "Acquired"), (2, dt.date(2024, 4, 1), "Retained"),
    ]


def test_as_written_anti_join_blocks_whole_month(spark):
    f1 = _feed(spark, [(1, TS(2024, 3, 5)), (2, TS(2024, 3, 6))])
    target = spark.createDataFrame([(1, dt.date(2024, 3, 1), "Acquired")],
                                   "customer_uid long, year_month date, activity_status string")
    intent = AC.new_activity_keys(f1, None, target, dt.date(2024, 3, 10))
    written = AC.new_activity_keys(f1, None, target, dt.date(2024, 3, 10), match="month")
    assert rows(intent) == [(2, dt.date(2024, 3, 1))]
    assert rows(written) == []


def test_incremental_month_by_month_equals_full(spark):
    """Property: running the upsert month after month reproduces the full
    refresh (including 'Reactivated' and NULL-customer rows)."""
    d = Domain(Tables(spark, SF_SMALL))
    f1, f2 = d.sportsbook_feed, d.second_feed
    path = os.path.join(tempfile.mkdtemp(prefix="kpiforge-test-"), uuid.uuid4().hex)
    months = ["2001-06-01", "2001-07-01", "2001-08-01"]
    cut = AC.as_timestamp(dt.date(2001, 6, 1))
    AC.write_full(AC.monthly_status(f1.filter(F.col("ticket_delivery_date") < cut),
                                    f2.filter(F.coalesce("ticket_delivery_date", "kpi_date") < cut)), path)
    for m in months:
        nxt = F.add_months(F.lit(dt.date.fromisoformat(m)), 1).cast("timestamp_ntz")
        AC.upsert_increment(spark, f1.filter(F.col("ticket_delivery_date") < nxt),
                            f2.filter(F.coalesce("ticket_delivery_date", "kpi_date") < nxt), path,
                            dt.date.fromisoformat(m))
    # the rest (2024 events) in one run
    AC.upsert_increment(spark, f1, f2, path, dt.date(2001, 9, 1))
    got = rows(AC.read_target(spark, path))
    want = rows(AC.monthly_status(f1, f2))
    assert got == want
    # idempotent re-run
    assert AC.upsert_increment(spark, f1, f2, path, dt.date(2001, 9, 1)) == 0


def test_reconcile_invariants(spark):
    old, new = customer_versions(Tables(spark, SF_SMALL))
    flags = RE.diff_flags(new, old, "customer_uid", Q.PROFILE_PAIRS, tol=Q.RECONCILE_TOL).cache()
    labels = RE.pair_labels(Q.PROFILE_PAIRS)
    per_row = RE.mismatch_rows(flags, "customer_uid", labels)
    per_col = RE.mismatch_columns(flags, labels)
    total_rows = per_row.agg(F.sum("mismatch_count")).collect()[0][0]
    total_cols = per_col.agg(F.sum("mismatched_customer_count")).collect()[0][0]
    assert total_rows == total_cols > 0
    # tolerance masks small numeric drift; exact pairs see more
    exact = RE.diff_flags(new, old, "customer_uid", Q.EXACT_PAIRS)
    n_exact = exact.filter("diff_total_price").count()
    n_tol = flags.filter("diff_total_price").count()
    assert n_exact >= n_tol
    flags.unpersist()


def test_reconcile_text_vs_typed(spark):
    a = spark.createDataFrame([(1, "2024-01-01")], "customer_uid long, d string")
    b = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "customer_uid long, d date")
    typed = RE.diff_flags(a, b, "customer_uid", [RE.Pair("d", "d", "d", "text")]).collect()[0]
    assert typed.diff_d is False


def test_contract_report(spark):
    df = events_level(Tables(spark, SF_SMALL))
    rep = {r.column_name: r for r in CO.check(df, CO.EVENTS_LEVEL).collect()}
    assert len(rep) == len(CO.EVENTS_LEVEL.columns)
    assert rep["cashout_count"].issue == "type"
    assert rep["requested_display_odds"].issue == "type"
    assert rep["prorated_stake"].issue is None
    assert rep["last_updated_date"].null_count > 0
    assert rep["id"].duplicate_count > 0
    assert rep["id"].null_count == 0


def test_contract_enforce_and_strict(spark):
    df = spark.createDataFrame([("1", "2024-01-02", "x")], "customer_uid string, year_month string, extra string")
    out = CO.enforce(df, CO.MONTHLY_STATUS)
    assert [f.name for f in out.schema.fields] == ["customer_uid", "year_month", "activity_status", "extra"]
    assert dict(out.dtypes)["year_month"] == "date"
    with pytest.raises(ValueError):
        CO.enforce(df, CO.MONTHLY_STATUS, strict=True)


def test_append_new_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(2, 5)], "k long, b long")
    assert rows(AC.append_new_columns(a, b), ["k", "a", "b"]) == [(1, "x", None), (2, None, 5)]


def test_build_status_modes_and_stream_agree(spark):
    """full mode, incremental mode from an empty target, and the streaming
    job all produce the full-refresh table."""
    from kpiforge.streaming.activity_stream import run_activity_stream

    d = Domain(Tables(spark, SF_SMALL))
    f1, f2 = d.sportsbook_feed, d.second_feed
    want = rows(AC.monthly_status(f1, f2))
    base = tempfile.mkdtemp(prefix="kpiforge-test-")
    full, inc, stream = (os.path.join(base, n) for n in ("full", "inc", "stream"))
    AC.build_status(spark, f1, f2, full, mode="full")
    AC.build_status(spark, f1, f2, inc, as_of=dt.date(1990, 1, 1), mode="incremental")
    run_activity_stream(spark, SF_SMALL, stream)
    for p in (full, inc, stream):
        assert rows(AC.read_target(spark, p)) == want
    with pytest.raises(ValueError):
        AC.build_status(spark, f1, f2, full, mode="merge")


def test_reconcile_reports_are_ordered(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 5.0, "y"), (3, 1.0, "z")], "customer_uid long, v double, s string")
    b = spark.createDataFrame([(1, 9.0, "q"), (2, 5.0, "q"), (4, 1.0, "z")], "customer_uid long, v double, s string")
    pairs = [RE.Pair("v", "v", "v", "numeric"), RE.Pair("s", "s", "s", "exact")]
    flags = RE.diff_flags(a, b, "customer_uid", pairs, tol=0.5)
    got = [tuple(r) for r in RE.mismatch_rows(flags, "customer_uid", ["v", "s"]).collect()]
    assert got == [(1, 2, "v,s"), (3, 2, "v,s"), (4, 2, "v,s"), (2, 1, "s")]
    cols = [tuple(r) for r in RE.mismatch_columns(flags, ["v", "s"]).collect()]
    assert cols == [("s", 4), ("v", 3)]


def test_reconcile_script_reuses_flags(spark):
    old, new = customer_versions(Tables(spark, SF_SMALL))
    flags, per_row, per_col = RE.reconcile(new, old, "customer_uid", Q.PROFILE_PAIRS, tol=Q.RECONCILE_TOL)
    assert flags.is_cached
    total_rows = per_row.agg(F.sum("mismatch_count")).collect()[0][0]
    total_cols = per_col.agg(F.sum("mismatched_customer_count")).collect()[0][0]
    assert total_rows == total_cols
    flags.unpersist()


def test_contract_reports_cast_overflow(spark):
    c = CO.Contract("t", (CO.Column_("odds", "BIGNUMERIC"), CO.Column_("n", "int64")))
    df = spark.createDataFrame([(1.5, 1), (1e25, 2), (None, 3)], "odds double, n int")
    rep = {r.column_name: r for r in CO.check(df, c).collect()}
    assert rep["odds"].issue == "type" and rep["odds"].cast_failures == 1   # 1e25 overflows decimal(38,18)
    assert rep["n"].issue == "type" and rep["n"].cast_failures == 0
    with pytest.raises(Exception, match="odds does not fit"):
        CO.enforce(df, c).collect()
    assert [(r.n, r.lost_columns) for r in CO.quarantined(df, c).collect()] == [(2, ["odds"])]
    assert CO.enforce(df.where("n <> 2"), c).count() == 2
    out = CO.enforce(df, c, on_loss="null")
    assert [r.odds for r in out.orderBy("n").collect()][1] is None


def test_stream_reads_tables_stored_as_folders(spark, tmp_path):
    from kpiforge.sources.domain import second_feed, sportsbook_feed
    from kpiforge.streaming.activity_stream import run_activity_stream
    for name in ("orders", "events"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    run_activity_stream(spark, str(tmp_path), f"{tmp_path}/target")
    t = Tables(spark, SF_SMALL)
    got, want = AC.read_target(spark, f"{tmp_path}/target"), AC.monthly_status(sportsbook_feed(t), second_feed(t))
    assert got.count() > 0 and rows(got, want.columns) == rows(want)


def test_upsert_appends_without_touching_other_files(spark, tmp_path):
    path = str(tmp_path / "target")
    day = dt.date(2024, 1, 1)
    months = spark.createDataFrame([(1, day)], "customer_uid long, year_month date").toDF(AC.KEY, AC.MONTH)
    AC.ensure_target(spark, path)
    assert AC.upsert_months(spark, months, path) == 1
    before = {f: os.stat(f).st_mtime_ns for d, _, n in os.walk(path) for f in (os.path.join(d, x) for x in n) if f.endswith(".parquet")}
    more = months.union(spark.createDataFrame([(2, day)], months.schema))
    assert AC.upsert_months(spark, more, path) == 1 and AC.upsert_months(spark, more, path) == 0
    assert AC.read_target(spark, path).count() == 2
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
