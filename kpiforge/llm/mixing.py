"""Mixing sources to target weights by Pfair scheduling.

A source's rows form blocks. With weight w, its j-th block (from 1) is released
at slot floor((j - 1) / w) and due at ceil(j / w); earliest deadline first among
the released blocks keeps every source within one block of its target at every
slot. The weights are exact fractions (a float counts as the decimal number it
is written as), so nothing drifts however many slots there are. When a source
runs out, the others go on with their weights scaled up: a phase for each such
end, counted from its first slot. Every row is placed exactly once.

The driver works out one slot after the other, from the row counts alone, and
writes the schedule to the shared folder piece by piece: its time grows with the
number of blocks, its memory does not."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.llm.common import global_rank, work_path

BLOCK = 32
PERIOD = 1024
MAX_SOURCES = 20_000
#: Slots of the schedule the driver holds at once.
PIECE = 1 << 18
#: A release or deadline beyond this is shown as this: a long holds no more.
FAR = 1 << 62

LAYOUT = ("_kf_source", "block", "phase", "release", "deadline", "slot", "_kf_before")


def period_shares(weights: list[float], period: int = PERIOD) -> list[int]:
    """Whole shares in exactly the ratio of the positive ``weights``. Their sum
    is the shortest period, or as many whole ones as ``period`` slots hold."""
    exact = [Fraction(str(w)) for w in weights]
    unit = math.lcm(*(w.denominator for w in exact))
    share = [int(w * unit) for w in exact]
    by = math.gcd(*share)
    times = max(1, period // (sum(share) // by))
    return [s // by * times for s in share]


def in_turn(shares: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(source, block, release, deadline) slot by slot, without end: earliest
    deadline first among the released blocks; ties by the share (larger first),
    then the index."""
    period = sum(shares)
    done = [0] * len(shares)
    coming = [(0, i) for i in range(len(shares))]
    ready: list[tuple] = []
    slot = 0
    while True:
        while coming and coming[0][0] <= slot:
            i = heapq.heappop(coming)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * period // shares[i]), -shares[i], i))
        deadline, _, i = heapq.heappop(ready)
        yield i, done[i], done[i] * period // shares[i], deadline
        done[i] += 1
        slot += 1
        heapq.heappush(coming, (max(slot, done[i] * period // shares[i]), i))


def one_period(shares: list[int]) -> np.ndarray:
    """The source of each slot of a period."""
    turn = in_turn(shares)
    return np.array([next(turn)[0] for _ in range(sum(shares))], np.int64)


def schedule(blocks: list[int], weights: list[float], period: int = PERIOD) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(source, block, phase, release, deadline, slot) of all blocks, by slot;
    ``blocks[i]`` blocks of each source. Sources of weight 0 come when all others
    have run out, in equal shares."""
    if any(not 0 <= w < math.inf for w in weights):
        raise ValueError("weights must be finite numbers of 0 or more")
    left, done, start, phase = list(blocks), [0] * len(blocks), 0, 0
    while alive := [i for i, n in enumerate(left) if n]:
        alive = [i for i in alive if weights[i]] or alive
        turn = in_turn(period_shares([weights[i] or 1 for i in alive], period))
        for slot, (k, _, release, deadline) in enumerate(turn, start):
            i = alive[k]
            yield i, done[i], phase, min(FAR, start + release), min(FAR, start + deadline), slot
            done[i] += 1
            left[i] -= 1
            if not left[i]:
                break
        start, phase = slot + 1, phase + 1


def _layout(spark, parts: list[tuple[int, list[int], list[float]]], block: int, period: int) -> DataFrame:
    """The schedules of ``parts`` (number of the first source, row counts,
    weights) as a table in the shared folder, with the rows before each slot."""
    import pyarrow as pa

    path = work_path(spark, "layout")
    rows: list[tuple] = []

    def write():
        spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], list(LAYOUT))).write.mode("append").parquet(path)
        rows.clear()
    for first, counts, weights in parts:
        before = 0
        for i, *line in schedule([-(-n // block) for n in counts], weights, period):
            rows.append((first + i, *line, before))
            before += min(block, counts[i] - line[0] * block)
            if len(rows) == PIECE:
                write()
    if rows:
        write()
    return spark.read.schema(", ".join(f"{c} long" for c in LAYOUT)).parquet(path)


def mixed(docs: DataFrame, weights: dict | None = None, alpha: float = 0.5, block: int = BLOCK, period: int = PERIOD,
          within: str | None = None) -> DataFrame:
    """``docs`` with ``block``, ``phase``, ``release``, ``deadline``, ``slot``
    (of the block, from 0) and ``position`` (of the row, from 0, without gaps).

    ``weights`` maps a source to its target weight; sources it lacks, or all
    without it, weigh their row count to the power ``alpha``. Rows of a source
    come in the order of a hash of ``doc_id``; its last block may be short.
    Weights hold exactly, whatever their ratio and the number of sources: while
    all sources last, after every slot each is less than one block from its
    target. ``period`` (slots per repetition of the shares) does not change the
    order. Sources of weight 0 come last; a negative or infinite weight is an
    error. With ``within``, the rows of each value of that column are mixed by
    themselves, all to the same weights. Sources are taken to be few: more than MAX_SOURCES is an error, since
    their counts (by value of ``within``) are held by the driver.

    A null source is a source of its own. Null texts and ids, repeated rows and
    extra columns pass through (columns named like the added ones are
    replaced). An empty table gives an empty table."""
    added = ("block", "phase", "release", "deadline", "slot", "position")
    docs = docs.drop(*added)
    spark = docs.sparkSession
    part = F.col(within) if within else F.lit(0)
    ranked = global_rank(docs.withColumn("_kf_part", part).withColumn("_kf_key", F.xxhash64("doc_id")), [
        F.col("_kf_part").asc_nulls_first(), F.col("source").asc_nulls_first(), F.col("_kf_key"), F.col("doc_id").asc_nulls_first()], "_kf_rank").drop("_kf_key")
    if ranked.select("source").distinct().limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    counts = ranked.groupBy("_kf_part", "source").agg(F.count(F.lit(1)).alias("n"), F.min("_kf_rank").alias("first")).collect()
    counts = sorted(counts, key=lambda r: r["first"])
    if not counts:
        return ranked.select(*docs.columns, *[F.lit(None).cast("long").alias(c) for c in added])
    total: Counter = Counter()
    for r in counts:
        total[r["source"]] += r["n"]
    parts: list[tuple[int, list[int], list[float]]] = []
    for i, r in enumerate(counts):
        if not i or r["_kf_part"] != counts[i - 1]["_kf_part"]:
            parts.append((i, [], []))
        parts[-1][1].append(r["n"])
        parts[-1][2].append((weights or {}).get(r["source"], total[r["source"]] ** alpha))
    layout = _layout(spark, parts, block, period)
    kinds = ranked.select(F.col("_kf_part").alias("_kf_p"), F.col("source").alias("_kf_s")).schema
    source = spark.createDataFrame([(r["_kf_part"], r["source"], i, r["first"]) for i, r in enumerate(counts)],
                                   T.StructType([*kinds.fields, *T.StructType.fromDDL("_kf_source long, _kf_first long").fields]))
    rows = (ranked.join(F.broadcast(source), F.col("_kf_part").eqNullSafe(F.col("_kf_p")) & F.col("source").eqNullSafe(F.col("_kf_s")))
            .withColumn("_kf_in", F.col("_kf_rank") - F.col("_kf_first")).withColumn("block", F.floor(F.col("_kf_in") / block)))
    # a key holds one block of rows at most; Spark broadcasts the schedule while it is small
    return (rows.join(layout, ["_kf_source", "block"])
            .withColumn("position", F.col("_kf_before") + F.pmod(F.col("_kf_in"), F.lit(block)))
            .select(*docs.columns, "block", "phase", "release", "deadline", "slot", "position"))


def in_mixed_order(docs: DataFrame, **params) -> DataFrame:
    """All rows of ``docs``, its columns only, in the order of the mix (files
    written from it hold consecutive stretches)."""
    return mixed(docs, **params).orderBy("position").select(*docs.columns)


def op4_pfair_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"))
