"""Stored and published tables: layout, plans, sharing, failures between write and publish."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from kpiforge.operators import activity as AC
from kpiforge.operators import contract as CO
from kpiforge.operators import daily as DA
from kpiforge.plans import customer360 as K
from kpiforge.plans import queries as Q
from kpiforge.plans.stored_kpi import StoredKpi, one_row_per_key
from kpiforge.sources import published
from kpiforge.sources.domain import Domain, bet_lines
from kpiforge.sources.stored import input_version
from kpiforge.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are when no side is small."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    s = StoredKpi(spark, SF_SMALL, Q.BETS_AS_OF, Q.EVENTS_AS_OF, root=str(tmp_path_factory.mktemp("stored")))
    s.batches_flags()
    return s


def test_wide_star_over_buckets_needs_no_exchange(stored, no_broadcast):
    star = K.kpi_combined(stored.plain, Q.BETS_AS_OF, Q.EVENTS_AS_OF, stored.input, unique=True)
    plan = plan_of(star)
    assert plan.count("SortMergeJoin") >= 15 and "Exchange" not in plan
    assert "lineitem" not in plan and "orders" not in plan


def test_only_tables_of_fixed_size_are_broadcast(spark, stored):
    """Small files of many rows (F1 to F5): with Spark's own threshold, every table here is below it."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    star = K.kpi_combined(stored.plain, Q.BETS_AS_OF, Q.EVENTS_AS_OF, stored.input, unique=True)
    batches = K.kpi_batches(stored.plain, Q.BETS_AS_OF, Q.EVENTS_AS_OF, stored.initial(), stored.input, unique=True)
    drift = stored.combined().alias("l").join(stored.batches().alias("r"), K.KEY, "right").groupBy().count()
    for df in (star, batches, drift, bet_lines(stored.plain.tables)):
        assert "SortMergeJoin" in plan_of(df) and "Broadcast" not in plan_of(df)
    broadcast = {n: plan_of(stored._build_input(n)).count("BroadcastExchange") for n in K.INPUTS}
    assert {n: k for n, k in broadcast.items() if k} == {"customer_dim": 1}  # the classes, one per nation


def test_flags_join_is_co_located_and_reports_read_flags_only(spark, stored, no_broadcast):
    from kpiforge.operators import reconcile as RE
    from kpiforge.plans.kpi_pairs import BATCHES_VS_COMBINED
    assert "Exchange" not in plan_of(RE.diff_flags(stored.batches(), stored.combined(), K.KEY, BATCHES_VS_COMBINED))
    flags, labels = stored.batches_flags()
    plan = plan_of(RE.mismatch_columns(flags, labels))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_a_wide_table_is_written_once_per_version(spark, stored):
    again = StoredKpi(spark, SF_SMALL, Q.BETS_AS_OF, Q.EVENTS_AS_OF, root=stored.store.root)
    before = published.current(spark, again.store.path("kpi_combined"))
    again.combined()
    assert published.current(spark, again.store.path("kpi_combined")) == before
    other = StoredKpi(spark, SF_SMALL, Q.BETS_AS_OF - dt.timedelta(days=1), Q.EVENTS_AS_OF, root=stored.store.root)
    assert not other.store.has("kpi_combined") and other.store.version != again.store.version


def test_measures_read_the_fact_twice_without_a_join(stored):
    plan = plan_of(stored.bet_measures())
    assert "lineitem" not in plan and "Join" not in plan
    assert plan.count("FileScan") == 2 and "PushedFilters" in plan


def test_version_follows_the_files(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    first = input_version(spark, [f"{tmp_path}/t"], "a")
    assert input_version(spark, [f"{tmp_path}/t"], "a") == first != input_version(spark, [f"{tmp_path}/t"], "b")
    spark.range(3).write.mode("append").parquet(f"{tmp_path}/t")
    assert input_version(spark, [f"{tmp_path}/t"], "a")[0] != first[0]


def test_a_session_that_did_not_write_the_buckets_can_use_them(spark, tmp_path, no_broadcast):
    root = str(tmp_path / "t")
    for name in ("a", "b"):
        published.publish(spark.range(100).withColumnRenamed("id", "k").withColumn(name, F.col("k") * 2), f"{root}/{name}", cluster_by="k", buckets=4)
        spark.sql(f"DROP TABLE {published.table_name(published.current(spark, f'{root}/{name}')['folder'])}")
    a, b = (published.read(spark, f"{root}/{n}") for n in "ab")
    joined = a.join(b, "k")
    assert joined.count() == 100 and "Exchange" not in plan_of(joined)


def test_repeated_dimension_row_fails_the_build_with_input_and_key(spark, tmp_path):
    rows_ = spark.sql("select explode(array(1L, 2L, 2L, null, null)) customer_uid")
    assert one_row_per_key({"margins": (rows_.distinct(), "customer_uid")}).count() == 0
    with pytest.raises(Exception, match="input margins: several rows with customer_uid = 2"):
        one_row_per_key({"fine": (rows_.distinct(), "customer_uid"), "margins": (rows_, "customer_uid")}).collect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    os.remove(f"{tmp_path}/customer.parquet")
    c.union(c.where("c_custkey = 7")).write.parquet(f"{tmp_path}/customer.parquet")
    with pytest.raises(Exception, match="several rows with customer_uid = 7"):
        StoredKpi(spark, str(tmp_path), Q.BETS_AS_OF, Q.EVENTS_AS_OF, root=f"{tmp_path}/out").initial()


def test_readers_see_the_old_table_until_the_pointer_moves(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    K.write_table(spark.range(5).withColumnRenamed("id", K.KEY), path)
    real = published.point

    def die(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(published, "point", die)
    with pytest.raises(KeyboardInterrupt):
        K.write_table(spark.range(9).withColumnRenamed("id", K.KEY), path)
    assert K.read_table(spark, path).count() == 5
    monkeypatch.setattr(published, "point", real)
    K.write_table(spark.range(7).withColumnRenamed("id", K.KEY), path)
    assert K.read_table(spark, path).count() == 7 and published.current(spark, path)["schema_version"] == 2
    assert published.vacuum(spark, path) == 2 and K.read_table(spark, path).count() == 7


def test_full_build_that_dies_leaves_the_old_target(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "status")
    d = Domain(Tables(spark, SF_SMALL))
    AC.build_status(spark, d.sportsbook_feed, None, path, mode="full")
    n = AC.read_target(spark, path).count()

    def die(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(published, "point", die)
    with pytest.raises(KeyboardInterrupt):
        AC.build_status(spark, d.sportsbook_feed, d.second_feed, path, mode="full")
    assert AC.read_target(spark, path).count() == n > 0


MONTHS = "customer_uid long, year_month date"


def _target(spark, tmp_path, data):
    path = str(tmp_path / "target")
    AC.write_full(AC.classify_months(spark.createDataFrame(data, MONTHS)), path)
    return path


def test_upsert_reads_the_batch_months_only(spark, tmp_path):
    path = _target(spark, tmp_path, [(c, dt.date(2020 + m // 12, 1 + m % 12, 1)) for c in (1, 2) for m in range(24)])
    batch = spark.createDataFrame([(1, dt.date(2022, 1, 1)), (3, dt.date(2021, 5, 1))], MONTHS)
    new = AC.new_rows(batch, [dt.date(2021, 5, 1), dt.date(2022, 1, 1)], AC.read_target(spark, path), AC.first_months(spark, path))
    plan = plan_of(new)
    assert plan.count("PartitionFilters: [isnotnull(year_month") + plan.count("PartitionFilters: [year_month") >= 2
    scans = [line for line in plan.splitlines() if "FileScan" in line and "activity_status" not in line and "first_month#" not in line.split("Batched")[0]]
    assert all("PartitionFilters: []" not in line for line in scans if "year_month" in line.split("Batched")[0])
    assert rows(new) == [(1, dt.date(2022, 1, 1), "Retained"), (3, dt.date(2021, 5, 1), "Acquired")]


def test_late_months_and_a_crash_between_index_and_data(spark, tmp_path, monkeypatch):
    path = _target(spark, tmp_path, [(1, dt.date(2024, 3, 1))])
    late = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 5, 1)), (None, dt.date(2024, 5, 1))], MONTHS)
    real = AC._clustered

    def die(df):
        raise KeyboardInterrupt
    monkeypatch.setattr(AC, "_clustered", die)
    with pytest.raises(KeyboardInterrupt):
        AC.upsert_months(spark, late, path)
    monkeypatch.setattr(AC, "_clustered", real)
    assert AC.upsert_months(spark, late, path) == 3 and AC.upsert_months(spark, late, path) == 0
    assert rows(AC.read_target(spark, path)) == [
        (None, dt.date(2024, 5, 1), "Undefined"), (1, dt.date(2024, 1, 1), "Acquired"),
        (1, dt.date(2024, 3, 1), "Acquired"), (2, dt.date(2024, 5, 1), "Acquired")]
    next_month = spark.createDataFrame([(2, dt.date(2024, 6, 1)), (1, dt.date(2024, 6, 1))], MONTHS)
    AC.upsert_months(spark, next_month, path)
    got = {(r.customer_uid, r.year_month.month): r.activity_status for r in AC.read_target(spark, path).collect()}
    assert got[2, 6] == "Retained" and got[1, 6] == "Reactivated"


def test_stored_target_gains_columns(spark, tmp_path):
    path = _target(spark, tmp_path, [(1, dt.date(2024, 3, 1))])
    more = spark.sql("select 2L customer_uid, date'2024-04-01' year_month, 'Acquired' activity_status, 5L n, array('x') tags")
    with pytest.raises(ValueError, match="does not have"):
        AC.append_evolving(spark, more, path, "fail")
    assert AC.append_evolving(spark, more, path) == ["n", "tags"]
    t = AC.read_target(spark, path)
    assert dict(t.dtypes)["n"] == "bigint" and published.current(spark, path)["schema_version"] == 2
    assert [(r.customer_uid, r.n, r.tags) for r in t.orderBy("customer_uid").collect()] == [(1, None, None), (2, 5, ["x"])]
    assert AC.append_evolving(spark, more.withColumn("other", F.lit(1)), path, "ignore") == []
    with pytest.raises(ValueError, match="another type"):
        AC.append_evolving(spark, more.withColumn("n", F.lit("five")), path)
    assert AC.upsert_months(spark, spark.createDataFrame([(2, dt.date(2024, 5, 1))], MONTHS), path) == 1
    assert AC.read_target(spark, path).where("year_month = '2024-05-01'").first().n is None


def test_write_gate_splits_and_counts_in_one_pass(spark, tmp_path):
    c = CO.Contract("t", (CO.Column_("id", "string", ("not_null",)), CO.Column_("n", "int64"), CO.Column_("d", "date")))
    df = spark.createDataFrame([("a", "1", "x"), (None, "2", "y"), ("c", "three", "z"), (None, "four", "w")], "id string, n string, extra string")
    path = str(tmp_path / "g")
    assert CO.write_gate(df, c, path) == {"rows": 4, "quarantined": 3, "id:not_null": 2, "n:type": 2}
    t = CO.gate_target(spark, path)
    assert t.dtypes == [("id", "string"), ("n", "bigint"), ("d", "date"), ("extra", "string")] and [r.id for r in t.collect()] == ["a"]
    q = {r.extra: r.violations for r in CO.gate_quarantine(spark, path).collect()}
    assert q == {"y": ["id:not_null"], "z": ["n:type"], "w": ["id:not_null", "n:type"]}
    described = CO.Contract("t", (CO.Column_("id", "string", (), "the key"), *c.columns[1:]))
    CO.write_gate(df, described, path)
    assert CO.gate_target(spark, path).schema["id"].metadata["comment"] == "the key"
    assert CO.write_gate(df.limit(0), c, path) == {"rows": 0, "quarantined": 0} and CO.gate_target(spark, path).count() == 0


def test_write_gate_does_not_sort_by_folder(spark, tmp_path, monkeypatch):
    """Spark sorts rows by their folder unless it may keep a writer open for each."""
    from pyspark.sql.readwriter import DataFrameWriter
    names, seen, write = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.optimizer.plannedWrite.enabled"), [], DataFrameWriter.parquet

    def settings():
        return [spark.conf.get(n) for n in names]
    before = settings()
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, path: seen.append(settings()) or write(w, path))
    c = CO.Contract("t", (CO.Column_("n", "int64", ("not_null",)),))
    df = spark.createDataFrame([(i if i % 3 else None,) for i in range(99)], "n long").coalesce(1)
    assert CO.write_gate(df, c, str(tmp_path / "g"))["quarantined"] == 33
    assert seen == [["8", "false"]] and settings() == before
    assert [r.n for r in CO.gate_target(spark, str(tmp_path / "g")).collect()] == [i for i in range(99) if i % 3]


def test_daily_loads_in_any_order_and_again(spark, tmp_path):
    bets = Domain(Tables(spark, SF_SMALL)).bets
    root = str(tmp_path / "daily")
    cuts = [dt.date(2001, 6, 1), dt.date(2001, 7, 1), dt.date(2001, 7, 2)]
    DA.load(DA.bets_of_day(bets, cuts[1]), root, "b")
    DA.load(bets.where(F.col("kpi_date") >= AC.as_timestamp(cuts[2])), root, "c")
    DA.load(DA.bets_before(bets, cuts[1]), root, "a")
    DA.load(DA.bets_of_day(bets, cuts[1]), root, "b")
    from kpiforge.operators.bets import lifetime_and_l30
    for as_of in (Q.BETS_AS_OF, dt.date(2001, 7, 15)):
        want = lifetime_and_l30(bets, as_of)
        assert rows(DA.rolled_up(spark, root, as_of), want.columns) == rows(want)


def test_a_day_reads_one_month_of_the_stored_fact(stored):
    plan = plan_of(DA.daily_sums(DA.bets_of_day(stored.bet_fact(), dt.date(2001, 7, 31))))
    assert "kpi_month" in plan.split("PartitionFilters")[1].split("]")[0] and "GreaterThanOrEqual(kpi_date" in plan


def test_sql_function_is_inlined(spark):
    from kpiforge.functions import sql
    sql.register(spark)
    df = spark.sql("select id, num_diff(id, 3, 1.5) d, guarded_ratio(id, 0) r from range(3)")
    assert [r.d for r in df.orderBy("id").collect()] == [True, True, False]
    assert "num_diff" not in plan_of(df).replace("num_diff(", "", 0).split("AS d")[0] and "Python" not in plan_of(df)


def test_as_written_not_exists_equals_its_join_form(spark):
    f1, f2 = Q._feeds(spark, SF_SMALL)
    target = Q._history_target(spark, SF_SMALL)
    a, b = (AC.new_activity_keys(f1, f2, target, Q.BETS_AS_OF, match=m) for m in ("as_written", "month"))
    assert rows(a, ["customer_uid", "year_month"]) == rows(b, ["customer_uid", "year_month"])
