"""The bet fact is moved and sorted as narrow lines; its columns are derived when it is written."""

import datetime as dt
import re

from pyspark.sql import functions as F

from kpiforge.sources import domain as D
from kpiforge.sources import published
from kpiforge.sources.tables import Tables

TS = dt.datetime(2001, 7, 31)


def tables(spark):
    types = ["F", "O", "P", None], ["R", "A", "N", None], ["PROMO", "SMALL", "LARGE", "MEDIUM", "STANDARD", "ECONOMY", None]
    orders = [(i, i % 5 if i else None, types[0][i % 4], "2-HIGH" if i % 3 else None, TS + dt.timedelta(days=i) if i % 7 else None) for i in range(40)]
    part = [(i, types[2][i % 7], [10, 20, 30, None][i % 4]) for i in range(28)]
    lines = [(i % 44, i % 31, None if i % 13 == 0 else i * 37, None if i % 17 == 0 else i % 6, None if i % 11 == 0 else i / 7, 0.05, None if i % 19 == 0 else 0.02,
              types[1][i % 4], ["F", "O", None][i % 3], TS) for i in range(400)]
    frames = {
        "orders": spark.createDataFrame(orders + orders[:3], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp_ntz"),
        "part": spark.createDataFrame(part + part[:2], "p_partkey long, p_type string, p_size int"),
        "lineitem": spark.createDataFrame(lines + lines[:9], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double,"
                                          " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")}
    return Tables(spark, "none", frames)


def test_lines_give_the_bets(spark):
    t = tables(spark)
    want, got = D.bets(t), D.bets_of_lines(D.bet_lines(t))
    assert got.dtypes == want.dtypes and want.count() == got.count() > 250
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    labels = [n for names in D.BET_LABELS.values() for n in names]
    assert {n: {r[0] for r in got.select(n).distinct().collect()} for n in labels} == {
        n: {r[0] for r in want.select(n).distinct().collect()} for n in labels}
    assert got.select("league").distinct().count() == 6


def test_fact_is_dealt_and_sorted_before_its_columns_are_derived(spark, tmp_path, monkeypatch):
    from kpiforge.plans.stored_kpi import StoredKpi

    t, plans, real = tables(spark), [], published.publish
    monkeypatch.setattr(published, "publish", lambda df, root, **kw: plans.append(
        kw["finish"](df.hint("rebalance", *kw["partition_by"]).sortWithinPartitions(*kw["partition_by"], kw["cluster_by"]))) or real(df, root, **kw))
    s = StoredKpi(spark, "/root/testdata/sf0.001", dt.date(2001, 8, 1), dt.date(2024, 1, 31), root=str(tmp_path))
    s.plain = D.Domain(t)
    fact = s.bet_fact()
    want = D.bets(t).withColumn("kpi_month", F.trunc(F.to_date("kpi_date"), "MM"))
    assert fact.dtypes == want.dtypes and fact.exceptAll(want).isEmpty() and want.exceptAll(fact).isEmpty()
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RebalancePartitions"):]
    assert not re.search(r"CLOSED|Premier League|AS (ggr|ngr|bet_id|bonus_total)", below)


def test_line_and_supplier_are_moved_with_the_labels(spark):
    types = "l_linenumber int, l_suppkey long"
    given = [(n, s) for n in (None, 0, 1, 7, -1, -2**31, 2**31 - 1) for s in (None, 0, 1, 99, 100, 12345, -1, -99, -100, -12345)]
    n = D.math.prod(D._label_codes(t) for t in D.BET_LABELS)
    for label in (0, n - 1):
        df = spark.createDataFrame(given, types).withColumn("labels", D._line_code() * n + label)
        line, supp = D._line_of_code()
        assert df.where(~(line.eqNullSafe(F.col("l_linenumber")) & supp.eqNullSafe(F.col("l_suppkey") % 100))).isEmpty()
    assert not {"l_linenumber", "supp100"} & set(D.bet_lines(tables(spark)).columns)
