"""Daily partial aggregates of the bets, rolled up to any look-back window.

The bets of one load are reduced to two small tables, each in a folder named by
the load:

* sums: per customer, day of delivery and KPI day, the exact sums (all of them
  add up) and whether a positive parlay was among them;
* values: per customer and counted id (slip, bet) or source the last KPI day it
  was seen on, over all its bets and over those with real money. The look-backs
  have no upper end, so "seen since" is all that a window asks.

Rolling up reads these tables alone. A further day reads the facts of that day
and writes one more folder; doing a load again replaces its folder, so a failed
run is simply run again. Facts that arrive late belong to the load they arrive
in: sums add up and last days take the maximum, so their order does not matter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.functions.measures import guarded_ratio
from kpiforge.functions.predicates import as_date, real_money
from kpiforge.operators.bets import KEY, LIFETIME_AND_L30, valid_bets

SUMS = ("handle", "ggr", "bonus_total", "ngr")


def daily_sums(bets: DataFrame) -> DataFrame:
    """One row per customer, delivery day and KPI day of the valid bets."""
    rm = real_money()
    return valid_bets(bets).groupBy(KEY, F.to_date("ticket_delivery_date").alias("day"), F.to_date("kpi_date").alias("kpi_day")).agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.sum(F.when(rm, F.col("handle")).otherwise(F.lit(0))).alias("rm_handle"),
        F.bool_or((F.col("wager_type") == "PARLAY") & (F.col("handle") > 0)).alias("parlay"))


def last_seen(bets: DataFrame) -> DataFrame:
    """(customer, kind, id, source, last KPI day with real money) of the valid bets."""
    day = F.to_date("kpi_date")
    none = F.lit(None)
    valid = valid_bets(bets)
    slip = F.struct(F.lit("slip").alias("kind"), F.col("src_betslip_uuid").alias("id"), none.cast("string").alias("source"), none.cast("date").alias("rm_day"))
    bet = F.struct(F.lit("bet").alias("kind"), F.col("bet_id").alias("id"), none.cast("string").alias("source"),
                   F.when(real_money(), F.coalesce(day, F.lit("0001-01-01").cast("date"))).alias("rm_day"))
    source = F.struct(F.lit("source").alias("kind"), none.cast("bigint").alias("id"), F.col("sportsbook_source").alias("source"), none.cast("date").alias("rm_day"))
    rows = valid.select(KEY, F.inline(F.array(slip, bet, source)))
    return _merged(rows.where("id IS NOT NULL OR source IS NOT NULL"))


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy(KEY, "kind", "id", "source").agg(F.max("rm_day").alias("rm_day"))


def load(bets: DataFrame, root: str, name: str) -> None:
    """Write the partial tables of ``bets`` as the load ``name`` (a date, say)."""
    for table, rows in (("sums", daily_sums(bets)), ("values", last_seen(bets))):
        rows.write.mode("overwrite").parquet(f"{root}/{table}/load={name}")


def bets_of_day(bets: DataFrame, day: dt.date) -> DataFrame:
    """The facts of one KPI day; on a fact in folders by ``kpi_month`` only that month's files are read."""
    lo, hi = (F.lit(dt.datetime(d.year, d.month, d.day)).cast("timestamp_ntz") for d in (day, day + dt.timedelta(days=1)))
    out = bets.where((F.col("kpi_date") >= lo) & (F.col("kpi_date") < hi))
    if "kpi_month" in bets.columns:
        out = out.where(F.col("kpi_month") == F.lit(day.replace(day=1)))
    return out


def bets_before(bets: DataFrame, day: dt.date) -> DataFrame:
    return bets.where(F.col("kpi_date").isNull() | (F.col("kpi_date") < F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")))


def rolled_up(spark: SparkSession, root: str, as_of) -> DataFrame:
    """All lifetime and 30-day measures at the clock ``as_of``, as
    :func:`kpiforge.operators.bets.lifetime_and_l30` gives them."""
    today = as_date(as_of)
    sums = spark.read.parquet(f"{root}/sums")
    # days of one customer come together from all loads first: a day counts once
    recent = F.col("day") >= F.date_sub(today, 30)
    since7, since30 = (F.col("kpi_day") >= F.date_sub(today, n) for n in (7, 30))

    def total(cond, c, zero=False):
        e = F.when(cond, F.col(c))
        return F.sum(e.otherwise(F.lit(0)) if zero else e)

    by_day = sums.groupBy(KEY, "day").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        *[F.sum(F.when(recent, F.col(c))).alias(f"{c}_l30") for c in SUMS],
        F.sum("rm_handle").alias("rm_handle"),
        total(since7, "handle", True).alias("handle_7"), total(since7, "rm_handle", True).alias("rm_handle_7"),
        total(since30, "handle", True).alias("handle_30"), total(since30, "rm_handle", True).alias("rm_handle_30"),
        total(F.col("kpi_day") == F.date_sub(today, 1), "ggr", True).alias("previous_day_ggr"),
        F.bool_or("parlay").alias("parlay"))
    added = by_day.groupBy(KEY).agg(
        *[F.sum(c).alias(c) for c in by_day.columns if c not in (KEY, "day", "parlay")],
        F.bool_or("parlay").alias("placed_a_parlay_bet"),
        F.count("day").alias("active_days_lt"), F.count_if(recent).alias("active_days_l30"),
        F.min("day").alias("first_sports_bet_date"), F.max("day").alias("last_sports_bet_date"))
    values = _merged(spark.read.parquet(f"{root}/values"))
    bet = F.col("kind") == "bet"
    counted = values.where("kind <> 'source'").groupBy(KEY).agg(
        F.count_if(F.col("kind") == "slip").alias("bet_count_total"),
        F.count_if(bet & F.col("rm_day").isNotNull()).alias("real_money_bet_cnt_lifetime"),
        F.count_if(bet & (F.col("rm_day") >= F.date_sub(today, 7))).alias("real_money_bet_cnt_last7"),
        F.count_if(bet & (F.col("rm_day") >= F.date_sub(today, 30))).alias("real_money_bet_cnt_last30"))
    sources = values.where("kind = 'source'").groupBy(KEY).agg(
        F.array_join(F.sort_array(F.collect_list("source")), ",").alias("sportsbook_sources"))
    j = added
    for side, df in (("_counted", counted), ("_sources", sources)):
        j = j.join(df.withColumnRenamed(KEY, side), F.col(KEY).eqNullSafe(F.col(side)), "left")
    money = {"handle_lt": "handle", "ggr_lt": "ggr", "bonus_cost_lt": "bonus_total", "ngr_lt": "ngr", "handle_l30": "handle_l30",
             "ggr_l30": "ggr_l30", "bonus_cost_l30": "bonus_total_l30", "ngr_l30": "ngr_l30", "previous_day_ggr": "previous_day_ggr"}
    counts = ["bet_count_total", "real_money_bet_cnt_lifetime", "real_money_bet_cnt_last7", "real_money_bet_cnt_last30"]
    columns = {name: F.col(c).cast("double") for name, c in money.items()}
    columns |= {c: F.coalesce(F.col(c), F.lit(0)) for c in counts}
    columns |= {"average_bet_amount": guarded_ratio(F.coalesce(F.col("handle"), F.lit(0)), F.coalesce(F.col("bet_count_total"), F.lit(0))),
                "real_money_pct_lifetime": guarded_ratio("rm_handle", "handle"),
                "real_money_pct_7": guarded_ratio("rm_handle_7", "handle_7"),
                "real_money_pct_30": guarded_ratio("rm_handle_30", "handle_30"),
                "bet_sports": F.lit(True)}
    return j.select(KEY, *[columns.get(n, F.col(n)).alias(n) for n in LIFETIME_AND_L30])
