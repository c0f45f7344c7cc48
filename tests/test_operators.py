"""Branch tests on small hand-made inputs (NULL semantics, ties, edges)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from kpiforge.functions.measures import guarded_ratio, num_diff, relative_lift
from kpiforge.functions.predicates import valid_bet
from kpiforge.operators import bets as B
from kpiforge.operators import bonus as BO
from kpiforge.operators import campaigns as CA
from kpiforge.operators import leagues as LG
from kpiforge.operators.grained import Distinct, DistinctList, Plain, grained_agg
from kpiforge.operators.latest import latest_per_key, top_n_per_key
from kpiforge.sources.domain import Domain
from kpiforge.sources.tables import Tables

AS_OF = dt.date(2001, 8, 1)
TS = dt.datetime


def test_valid_bet_three_valued(spark):
    statuses = ["CLOSED", "OPEN", None]
    combos = ["REJECTED", "WON", None]
    data = [(s, c) for s in statuses for c in combos]
    df = spark.createDataFrame(data, "betslip_status string, bet_combination_status string")
    got = rows(df.filter(valid_bet()))
    assert got == [(None, None), ("CLOSED", None), ("CLOSED", "WON")]


def test_guarded_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "n double, d double")
    got = [r[0] for r in df.select(guarded_ratio("n", "d")).collect()]
    assert got == [None, None, 1.5]


def test_relative_lift_epsilon(spark):
    df = spark.createDataFrame([(0.0, 1.01), (2.0, 3.0)], "b double, w double")
    got = [round(r[0], 9) for r in df.select(relative_lift("b", "w")).collect()]
    assert got == [100.0, 0.5]


def test_num_diff(spark):
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 1.5), (1.0, 3.0)], "a double, b double")
    got = [r[0] for r in df.select(num_diff("a", "b", 1.0)).collect()]
    assert got == [False, True, False, True]


def _bets(spark, data):
    schema = ("customer_uid long, src_betslip_uuid long, bet_id long, betslip_status string, "
              "bet_combination_status string, bonus_campaign_type string, wager_type string, "
              "sportsbook_source string, league string, sport string, handle decimal(18,2), "
              "ggr decimal(18,4), ngr decimal(18,4), bonus_total decimal(18,4), "
              "ticket_delivery_date timestamp_ntz, kpi_date timestamp_ntz")
    return spark.createDataFrame(data, schema)


def _bet(c, slip, bet, promo=None, wager="SINGLE", src="A", handle="10.00", day=TS(2001, 7, 31),
         kpi=TS(2001, 7, 31), status="CLOSED", combo="WON", league="NBA", sport="Basketball"):
    d = Decimal(handle)
    return (c, slip, bet, status, combo, promo, wager, src, league, sport, d, d / 10, d / 20, d / 100, day, kpi)


def test_rolling_sum_null_vs_zero(spark):
    # customer 1 has no bet in the last 30 days: SUM(CASE .. END) is NULL,
    # SUM(CASE .. ELSE 0 END) is 0.
    data = [_bet(1, 1, 1, day=TS(2000, 1, 1), kpi=TS(2000, 1, 1)), _bet(2, 2, 2)]
    out = B.customer_measures(_bets(spark, data), AS_OF, ["handle_l30", "previous_day_ggr", "handle_lt"])
    got = {r.customer_uid: (r.handle_l30, r.previous_day_ggr, r.handle_lt) for r in out.collect()}
    assert got[1] == (None, 0.0, 10.0)
    assert got[2] == (10.0, 1.0, 10.0)


def test_future_rows_count_in_window(spark):
    data = [_bet(1, 1, 1, day=TS(2001, 9, 30))]
    out = B.customer_measures(_bets(spark, data), AS_OF, ["handle_l30"]).collect()
    assert out[0].handle_l30 == 10.0


def test_real_money_counts_and_share(spark):
    data = [_bet(1, 1, 1, promo="FREE_BET", handle="30.00"),
            _bet(1, 1, 2, promo=None, handle="10.00"),
            _bet(1, 2, 2, promo="RISK_FREE_BET", handle="10.00", kpi=TS(2001, 6, 1)),
            _bet(1, 3, 3, promo=None, handle="0.00", kpi=TS(2001, 5, 1))]
    out = B.customer_measures(_bets(spark, data), AS_OF,
                              B.REAL_MONEY_COUNTS + B.REAL_MONEY_SHARE + ["bet_count_total",
                                                                         "average_bet_amount"]).collect()[0]
    assert (out.real_money_bet_cnt_lifetime, out.real_money_bet_cnt_last7, out.real_money_bet_cnt_last30) == (2, 1, 1)
    assert out.real_money_pct_lifetime == 20.0 / 50.0
    assert out.real_money_pct_7 == 10.0 / 40.0
    assert out.bet_count_total == 3
    assert out.average_bet_amount == 50.0 / 3


def test_grained_agg_matches_count_distinct(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).alias("a"),
                                     (F.col("id") % 5).alias("b"), F.col("id").alias("v"))
    df = df.withColumn("a", F.when(F.col("v") % 11 == 0, None).otherwise(F.col("a")))
    out = grained_agg(df, "k", {"a": F.col("a"), "b": F.col("b")}, {
        "n_a": Distinct("a"), "n_a_even": Distinct("a", F.col("v") % 2 == 0), "n_b": Distinct("b"),
        "s": Plain("sum", F.col("v")), "mx": Plain("max", F.col("v")), "l": DistinctList("b", "|")})
    ref = df.groupBy("k").agg(F.count_distinct("a").alias("n_a"),
                              F.count_distinct(F.when(F.col("v") % 2 == 0, F.col("a"))).alias("n_a_even"),
                              F.count_distinct("b").alias("n_b"), F.sum("v").alias("s"), F.max("v").alias("mx"),
                              F.array_join(F.array_sort(F.collect_set(F.col("b").cast("string"))), "|").alias("l"))
    assert rows(out) == rows(ref.select(*out.columns))


def test_sources_list_null_when_empty_and_sorted(spark):
    data = [_bet(1, 1, 1, src="b"), _bet(1, 1, 2, src="a"), _bet(1, 2, 3, src="b"), _bet(2, 3, 4, src=None)]
    out = B.customer_measures(_bets(spark, data), AS_OF, ["sportsbook_sources"])
    assert rows(out) == [(1, "a,b"), (2, None)]


def test_league_group_fold_and_list(spark):
    data = [_bet(1, 1, 1, league="NBA"), _bet(1, 2, 2, league="NFL Preseason", sport="Soccer"),
            _bet(1, 3, 3, league="Premier League", sport="Tennis"),
            _bet(1, 4, 4, league="Premier League", sport="Cricket"),  # filtered out
            _bet(2, 5, 5, league="NHL", day=TS(1999, 1, 1))]          # older than 12 months
    lst = LG.league_list(_bets(spark, data), AS_OF)
    assert rows(lst) == [(1, "TENNIS/NFL/NBA")]


def test_latest_per_key_matches_window(spark):
    df = spark.createDataFrame([(1, TS(2024, 1, 1), 5, "x"), (1, TS(2024, 1, 2), 3, "y"),
                                (1, TS(2024, 1, 2), 4, "z"), (2, None, 1, "w")],
                               "k long, ts timestamp_ntz, id long, v string")
    got = latest_per_key(df, "k", ["ts", "id"], ["v"]).select("k", "v")
    assert rows(got) == [(1, "z"), (2, "w")]


def test_top_n_salted_equals_plain(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), F.col("id"),
                                     (F.col("id") * 7919 % 1000).alias("o"))
    order = [F.col("o").desc(), F.col("id").desc()]
    a = top_n_per_key(df, "k", order, 50, salt_col="id", salt_buckets=8)
    b = top_n_per_key(df, "k", order, 50)
    assert rows(a, ["k", "id", "rn"]) == rows(b, ["k", "id", "rn"])
    assert a.count() == 150


def test_enrolled_list_order_and_cap(spark):
    data = [(i, 7, "bonus-dispatch", 1, str(i), TS(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(30)]
    data.append((99, 7, "bonus-dispatch", 0, "x", TS(2024, 1, 20)))       # value <> 1
    data.append((98, 7, "bonus-dispatch", 1, "old", TS(2023, 1, 1)))      # older than 180 days
    df = spark.createDataFrame(data, "event_id long, customer_uid long, subtype string, value int, "
                                     "src_campaign_id string, message_timestamp timestamp_ntz")
    out = CA.enrolled_list(df, dt.date(2024, 1, 31), top_n=5).collect()[0]
    assert out.enrolled_bonus_campaigns == "29,28,27,26,25"
    latest = CA.latest_campaign(df).collect()[0]
    assert latest.most_recent_active_campaign_id == "29"


def test_bonus_kind_wildcards(spark):
    df = spark.createDataFrame([("C_NDB_x", "MONEY"), ("NDB", "MONEY"), ("C_NDB", "MONEY"), (None, "MONEY"),
                                ("a", None), ("a", "OTHER")], "campaign_name string, campaign_type string")
    got = [r[0] for r in df.select(BO.bonus_kind()).collect()]
    assert got == ["MONEY_NDB", "MONEY_DB", "MONEY_DB", "MONEY", "Non_Campaign", "OTHER"]


def test_rarest_vs_commonest_differ(spark):
    kinds = spark.createDataFrame([(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (2, 4, "A"), (2, 5, "B")],
                                  "customer_uid long, src_bonus_id long, bonus_type string")
    assert rows(BO.rarest_promo_kind(kinds).select("customer_uid", "bonus_type")) == [(1, "B"), (2, "B")]
    assert rows(BO.commonest_promo_kind(kinds).select("customer_uid", "bonus_type")) == [(1, "A"), (2, "B")]


def test_fanout_equals_brute_force_product(spark):
    """The pair-free fan-out equals aggregating the real bets x bonuses join."""
    bets = _bets(spark, [_bet(1, 1, 1, handle="10.00"), _bet(1, 2, 2, handle="5.00", day=TS(2001, 7, 20)),
                         _bet(2, 3, 3, handle="7.00"), _bet(3, 4, 4, handle="1.00")])
    bon = spark.createDataFrame(
        [(1, 10, "BET_SLIP_PLACEMENT", Decimal("1.00"), Decimal("0.50"), TS(2001, 7, 25)),
         (1, 11, "OTHER", Decimal("2.00"), Decimal("0.50"), TS(2001, 1, 1)),
         (1, 12, "BET_SLIP_PLACEMENT", Decimal("3.00"), None, TS(2001, 7, 25)),
         (2, 13, "OTHER", Decimal("4.00"), Decimal("1.00"), TS(2000, 1, 1)),
         (4, 14, "OTHER", Decimal("9.00"), Decimal("9.00"), TS(2001, 7, 30))],
        "customer_uid long, src_bonus_id long, wallet_transaction_type_action string, bonus_cost decimal(18,2), "
        "bonus_claimed decimal(18,2), transaction_created_date timestamp_ntz")
    fast = BO.fanout_activity(bets, bon, AS_OF)
    pairs = bets.join(bon, "customer_uid", "left")
    l30 = F.datediff(F.lit(AS_OF), F.to_date("transaction_created_date")) <= 30
    place = F.col("wallet_transaction_type_action") == "BET_SLIP_PLACEMENT"
    day = F.to_date("transaction_created_date")
    brute = pairs.groupBy("customer_uid").agg(
        F.sum("handle").cast("double").alias("handle_lt"), F.sum("ggr").cast("double").alias("ggr_lt"),
        F.sum("bonus_cost").cast("double").alias("bonus_cost_lt"), F.sum("ngr").cast("double").alias("ngr_lt"),
        F.sum("bonus_claimed").cast("double").alias("bonus_claimed"),
        F.count_distinct(F.when(place, day)).alias("active_days_lt"),
        F.sum(F.when(l30, F.col("handle"))).cast("double").alias("handle_l30"),
        F.sum(F.when(l30, F.col("ggr"))).cast("double").alias("ggr_l30"),
        F.sum(F.when(l30, F.col("bonus_cost"))).cast("double").alias("bonus_cost_l30"),
        F.sum(F.when(l30, F.col("ngr"))).cast("double").alias("ngr_l30"),
        F.count_distinct(F.when(place & l30, day)).alias("active_days_l30"))
    assert rows(fast) == rows(brute.select(*fast.columns))


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows: the skew-safe operators still give
    the exact answers of the straightforward formulations."""
    n = 30000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id"), (F.col("id") * 7919 % 10007).alias("o"), (F.col("id") % 113).alias("d"))
    got = grained_agg(df, "k", {"d": F.col("d")}, {"n": Distinct("d"), "s": Plain("sum", F.col("o"))})
    ref = df.groupBy("k").agg(F.count_distinct("d").alias("n"), F.sum("o").alias("s"))
    assert rows(got) == rows(ref.select(*got.columns))
    top = latest_per_key(df, "k", ["o", "id"], []).select("k", "o", "id")
    ref_top = df.groupBy("k").agg(F.max(F.struct("o", "id")).alias("m")).select("k", "m.o", "m.id")
    assert rows(top) == rows(ref_top)
    order = [F.col("o").desc(), F.col("id").desc()]
    a = top_n_per_key(df, "k", order, 2000, salt_col="id", salt_buckets=16)
    b = top_n_per_key(df, "k", order, 2000)
    assert rows(a, ["k", "id", "rn"]) == rows(b, ["k", "id", "rn"])


def test_reads_keep_their_splits_unless_told(spark):
    from conftest import SF_SMALL
    from kpiforge.sources.tables import Tables
    plain = Tables(spark, SF_SMALL)["orders"]
    assert "RoundRobin" not in plain._jdf.queryExecution().executedPlan().toString()
    assert Tables(spark, SF_SMALL, repartition=3)["orders"].rdd.getNumPartitions() == 3


def test_enrolled_list_limits_can_be_crossed_and_lifted(spark):
    rows = [(1, CA.DISPATCH, 1, i, f"c{i:05d}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(2100)]
    df = spark.createDataFrame(rows, "customer_uid long, subtype string, value int, event_id long, src_campaign_id string, message_timestamp timestamp_ntz")
    as_of = dt.date(2024, 1, 31)
    full = ",".join(f"c{i:05d}" for i in reversed(range(2100)))
    def of(**kw): return CA.enrolled_list(df, as_of, **kw).first().enrolled_bonus_campaigns
    assert of() == full[:10000] and of(top_n=None, max_chars=None) == full
    assert of(max_chars=None) == full[:7 * 2000 - 1]

def test_enrolled_list_without_limits_joins_days(spark):
    """Nulls, empty ids, ties and a null customer: as one sort of all dispatches gives it."""
    start, rng = dt.datetime(2024, 1, 1), random.Random(5)
    ids = [None, "", "a", "b,c", "d"]
    rows_ = [(rng.choice([None, 1, 2]), CA.DISPATCH, 1, i, rng.choice(ids), start + dt.timedelta(hours=7 * rng.randrange(60))) for i in range(400)]
    rows_ += [(3, CA.DISPATCH, 1, 900 + i, None, start + dt.timedelta(days=i)) for i in range(3)]  # no id at all
    rows_ += [(4, CA.DISPATCH, 1, 950, "x", start), (4, CA.DISPATCH, 1, 951, None, start + dt.timedelta(days=1)), (4, CA.DISPATCH, 1, 952, "y", start + dt.timedelta(days=2))]
    df = spark.createDataFrame(rows_, "customer_uid long, subtype string, value int, event_id long, src_campaign_id string, message_timestamp timestamp_ntz")
    want = {}
    for r in sorted(rows_, key=lambda r: (r[5], r[3]), reverse=True):
        want.setdefault(r[0], []).extend([] if r[4] is None else [r[4]])
    got = CA.enrolled_list(df, dt.date(2024, 1, 31), top_n=None, max_chars=None).collect()
    assert {r[0]: r[1] for r in got} == {k: ",".join(v) for k, v in want.items()} and len(got) == len(want)


@pytest.mark.parametrize("table", ["kpi_batches", "kpi_combined"])
def test_wide_tables_hold_every_campaign_of_the_look_back(spark, table):
    """More dispatches and characters than the reference's limits."""
    from kpiforge.plans import customer360 as K
    t = Tables(spark, SF_SMALL)
    uid = t["customer"].where("c_mktsegment != 'MACHINERY'").first().c_custkey
    rows_ = [(i, uid, CA.DISPATCH, 1, f"c{i:05d}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i)) for i in range(2500)]
    d = Domain(t, {"bonus_activity": spark.createDataFrame(rows_, "event_id long, customer_uid long, subtype string, value int, src_campaign_id string, message_timestamp timestamp_ntz")})
    wide = getattr(K, table)(d, dt.date(2001, 8, 1), dt.date(2024, 1, 31))
    assert wide.where(F.col("customer_uid") == uid).first().enrolled_bonus_campaigns == ",".join(f"c{i:05d}" for i in reversed(range(2500)))


def test_grained_agg_null_key_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (None, 2, "b"), (1, 1, "a")],
                               "k long, d long, s string")
    got = grained_agg(df, "k", {"d": F.col("d"), "s": F.col("s")},
                      {"n": Distinct("d"), "c": Plain("sum", F.col("d")), "l": DistinctList("s", "|")})
    assert rows(got, ["k", "n", "c", "l"]) == [(None, 2, 5, "a|b"), (1, 1, 1, "a")]


def test_grained_agg_distinct_only_keeps_every_key(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (2, 6), (None, 7)], "k long, d long")
    got = grained_agg(df, "k", {"d": F.col("d")}, {"n": Distinct("d"), "l": DistinctList("d", "|")})
    assert rows(got, ["k", "n", "l"]) == [(None, 1, "7"), (1, 0, None), (2, 2, "5|6")]
