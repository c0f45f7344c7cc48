"""Rows that no distinct measure counts do not reach the shuffle."""

import re

from pyspark.sql import functions as F

from kpiforge.operators.grained import Distinct, DistinctList, Plain, grained_agg


def test_rows_that_no_measure_counts_are_not_widened(spark):
    df = spark.createDataFrame([(1, 10, True, "a"), (1, 11, False, "b"), (1, 10, False, None), (2, 12, False, None), (None, 13, True, "c"), (3, None, True, None)],
                               "k long, v long, c boolean, s string")
    out = grained_agg(df, "k", {"v": F.col("v"), "s": F.col("s")}, {
        "n": Distinct("v", F.col("c")), "names": DistinctList("s"), "rows": Plain("sum", F.lit(1))})
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 1, "a,b", 3), (2, 0, None, 1), (3, 0, None, 1), (None, 1, "c", 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    copies = next(line for line in plan.splitlines() if "Generate inline" in line)
    assert re.search(r"isnotnull\(_gv1#\d+L?\) AND _fv_n#", copies) and not re.search(r"isnotnull\(_gv2#\d+\) AND _fv", copies)


def test_grains_share_columns_and_flags_share_a_mask(spark):
    df = spark.createDataFrame([(1, 10, 10, "2001-01-01", True, "a"), (1, 11, 10, "1969-12-30", False, "b"), (1, 10, 10, "2001-01-01", False, None),
                                (2, None, -1, None, None, "a"), (None, 13, 3, "2001-01-02", True, "c"), (None, 13, 4, "2001-01-02", False, "c")],
                               "k long, id long, i int, day string, c boolean, s string")
    grains = {"id": F.col("id"), "i": F.col("i"), "day": F.to_date("day"), "s": F.col("s"), "t": F.upper("s")}
    out = grained_agg(df, "k", grains, {
        "ids": Distinct("id"), "ids_c": Distinct("id", F.col("c")), "is_c": Distinct("i", ~F.col("c")), "days": Distinct("day"),
        "days_c": Distinct("day", F.col("c")), "names": DistinctList("s"), "caps": DistinctList("t", "/", descending=True), "rows": Plain("sum", F.lit(1))})
    assert sorted(map(tuple, out.collect()), key=str) == [
        (1, 2, 1, 1, 2, 1, "a,b", "B/A", 3), (2, 0, 0, 0, 0, 0, "a", "A", 1), (None, 1, 1, 1, 1, 1, "c", "C", 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    copies = next(line for line in plan.splitlines() if "Generate inline" in line)
    moved = copies[copies.rindex("["):]
    assert len(re.findall(r"#\d+", moved)) == 4  # number, whole numbers, text, mask


def test_days_that_are_listed_stay_days(spark):
    df = spark.createDataFrame([(1, "2001-01-02"), (1, "2001-01-01"), (1, None)], "k long, day string")
    out = grained_agg(df, "k", {"d": F.to_date("day"), "e": F.to_date("day")}, {"n": Distinct("e"), "l": DistinctList("d")})
    assert list(map(tuple, out.collect())) == [(1, 2, "2001-01-01,2001-01-02")]
