"""Shards by balanced label propagation.

Linked documents move, round by round, to the shard where most of their
neighbours are, as far as that shard has room; then a rank over all documents
makes the sizes exact: what a shard holds beyond its quota, groups of equal
texts that found no common shard, and documents without links, fill the shards
with room, group by group."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import ascii_lower, global_rank, step, stored, unit_hash
from kpiforge.llm.linededup import line_key
from kpiforge.llm.mixing import mixed

ROUNDS = 3


def _running(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        out.append(total)
        total += v
    return out


def propagate_labels(members: DataFrame, n_shards: int, capacity: int, rounds: int | None = ROUNDS) -> DataFrame:
    """(row, label) for the rows of ``members(row, hub)``: rows that share a hub
    are neighbours. Labels start by hash of the row. ``rounds`` None: until no
    round adds to the rows that are where they ask to be.

    In each round a hub names the label most of its rows have (as many labels,
    most frequent first, as its rows need at ``capacity`` each), each row asks
    for the label its strongest hub names, and a label with less room than
    requests takes a share of them, drawn by hub so that neighbours move
    together. Reaching the driver: one load per label."""
    labels = members.select("row").distinct().select(
        "row", F.pmod(F.xxhash64(F.lit("start"), "row"), F.lit(n_shards)).cast("int").alias("label"))
    labels = stored(labels, "labels")
    best, best_labels = -1, labels
    for turn in count() if rounds is None else range(rounds):
        counts = members.join(labels, "row").groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
        # at most n_shards entries a hub
        tops = stored(counts.groupBy("hub").agg(F.sum("n").alias("size"), F.sort_array(F.collect_list(
            F.struct((-F.col("n")).alias("n"), F.xxhash64("hub", "label").alias("tie"), "label"))).alias("ranked")).select(
                "hub", "ranked", F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)).cast("int").alias("wanted")), "tops")
        named = tops.select("hub", "wanted", F.explode(F.transform("ranked", lambda x, i: F.struct(
            x["label"].alias("label"), (-x["n"]).alias("n"), i.alias("place"),
            F.when(i < F.col("wanted"), x["label"]).otherwise(F.get(F.col("ranked"), F.pmod(i, F.col("wanted")))["label"]).alias("target")))).alias("v"))
        named = named.select("hub", F.col("v.label").alias("label"), F.col("v.n").alias("n"), F.col("v.target").alias("target"))
        named = stored(named, "named")
        # a hub that very many rows share: both sides are plain tables or scans, AQE splits them
        asked = (members.join(labels, "row").join(named, ["hub", "label"]).groupBy("row", "label")
                 .agg(F.max(F.struct("n", F.col("hub"), F.col("target"))).alias("v"))
                 .select("row", "label", F.col("v.hub").alias("hub"), F.col("v.target").alias("target")))
        asked = stored(asked, "asked")
        load = [0] * n_shards
        coming = [0] * n_shards
        for r in asked.groupBy("label", "target").count().collect():
            if r["label"] == r["target"]:
                load[r["label"]] += r["count"]
            else:
                coming[r["target"]] += r["count"]
        if rounds is None and sum(load) <= best:
            return best_labels
        best, best_labels = sum(load), labels
        share = [min(1.0, max(0, capacity - load[t]) / coming[t]) if coming[t] else 1.0 for t in range(n_shards)]
        accept = unit_hash(F.lit(turn), F.col("hub")) < F.element_at(F.array(*map(F.lit, share)), F.col("target") + 1)
        labels = stored(asked.select("row", F.when((F.col("label") == F.col("target")) | accept, F.col("target"))
                                     .otherwise(F.col("label")).alias("label")), "labels")
    return labels


def _together(placed: DataFrame, capacity: int) -> DataFrame:
    """The (hub, label, large) at which rows of equal texts stay: the one label of a
    group that has one, the most frequent ones, as many as it needs, of a group
    beyond ``capacity``, none of a group that is split without need."""
    tops = (placed.where("label is not null").groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("hub").agg(F.sum("n").alias("size"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "label"))).alias("ranked")))
    labels = (F.when(F.col("size") > capacity, F.slice("ranked", 1, F.ceil(F.col("size") / capacity).cast("int")))
              .when(F.size("ranked") == 1, F.col("ranked")).otherwise(F.slice("ranked", 1, 0)))
    return stored(tops.select("hub", (F.col("size") > capacity).alias("large"), F.explode(labels).alias("v"))
                  .select("hub", "large", F.col("v.label").alias("label")), "together")


def _groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, group): of a row's hubs the one that most rows of its label share."""
    at = members.join(labels, "row")
    counts = stored(at.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n")), "counts")
    strongest = at.join(counts, ["hub", "label"]).groupBy("row").agg(F.max(F.struct("n", "hub")).alias("v"))
    return stored(strongest.select("row", F.col("v.hub").alias("group")), "groups")


def _lines(text: Column, min_chars: int) -> Column:
    """The distinct keys of the lines of at least ``min_chars`` code points, by 128 bits
    of hash; keys as in :func:`kpiforge.llm.linededup.dedup_lines`."""
    long = F.filter(F.transform(F.split(text, "\n", -1), lambda x: ascii_lower(line_key(x))), lambda x: F.char_length(x) >= min_chars)
    return F.array_distinct(F.transform(long, lambda x: F.concat_ws(":", F.lit("line"), F.xxhash64(x), F.xxhash64(F.lit(9), x))))


def balanced_shards(docs: DataFrame, n_shards: int = 24, links: DataFrame | None = None, rounds: int | None = ROUNDS,
                    source: str | None = None, weights: dict | None = None, order: Sequence[str] = (),
                    line_chars: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of
    ``docs(doc_id, text)``. Law ``rows``: counts of any two shards are at most
    one apart; slots run from 0 without gaps.

    Documents with equal texts are linked, and so are the documents of a row of
    ``links(a, b)``, if given, and those with a line of at least ``line_chars``
    characters in common, if given. As many as the quotas allow come to one shard; a
    group larger than a shard fills several. Of the others, only those that lie
    across the end of a shard's quota or room are split: fewer than 2 a shard.

    With ``source``, a column of ``docs``, the slots of each shard run in the mix
    of its sources to the target ``weights`` (see :func:`kpiforge.llm.mixing.mixed`).

    With ``order``, columns of ``docs`` that give its rows an order, the slots of each
    shard run in that order, and documents without links are dealt to the shards in
    turn: a shard takes its rows from all of the order evenly.

    Null text counts as empty (size 8, crc32 0), so null and empty texts are
    one group. Null and repeated ids are placed row by row. Extra columns are
    ignored. An empty table gives an empty table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"),
        F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(3), text)).alias("hub"),
        *([_lines(text, line_chars).alias("_lines")] if line_chars else []),
        *([F.col(source).alias("source")] if source else []), *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)])
        .withColumn("row", F.monotonically_increasing_id()), "base")
    lines = base.select("row", F.explode("_lines").alias("hub")) if line_chars else None
    base = base.drop("_lines")
    dealt = []
    if order:
        by = [f"_order_{i}" for i in range(len(order))]
        base = stored(global_rank(base, [*map(F.col, by), F.col("row")], "order").drop(*by), "ordered")
        dealt = [F.pmod("_turn", F.lit(n_shards)), F.col("_turn")]
    total = base.count()
    members = base.select("row", "hub")
    if lines is not None:
        members = members.union(lines)
    if links is not None:
        # the two ends of a link share a hub of their own
        named = links.select("a", "b").distinct().withColumn("hub", F.concat_ws("-", "a", "b"))
        ends = named.select(F.col("a").alias("doc_id"), "hub").union(named.select("b", "hub")).distinct()
        members = members.union(base.join(ends.withColumnRenamed("hub", "pair"), "doc_id").select("row", "pair"))
    linked_hubs = stored(members.groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "hubs")
    members = stored(members.join(linked_hubs, "hub").select("row", "hub"), "members")
    capacity = max(1, total // n_shards)
    labels = propagate_labels(members, n_shards, capacity, rounds)
    placed, group = base.join(labels, "row", "left"), "hub"
    if line_chars:  # rows that give way to others move with those they stand with most
        group = "group"
        placed = placed.join(_groups(members, labels), "row", "left").withColumn(group, F.coalesce(group, "hub"))
    placed = stored(placed, "labelled")
    placed = (placed.join(_together(placed, capacity).withColumn("_together", F.lit(True)), ["hub", "label"], "left")
              .withColumn("label", F.when(F.col("_together"), F.col("label")).otherwise(F.lit(n_shards))))
    if order:  # a group has the turn of its first row
        first = placed.groupBy(group).agg(F.min("order").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select(group, "_first")
        placed = placed.join(stored(first, "first"), group, "left").withColumn("_turn", F.coalesce("_first", "order"))
    # a group beyond a shard keeps its shards; what gives way there moves as whole groups
    placed = global_rank(placed, [F.col("label"), F.coalesce("large", F.lit(False)).desc(), *dealt, *([F.col(group)] if line_chars else []), F.col("hub"), F.col("doc_id"), F.col("row")], "rank")
    held = [0] * (n_shards + 1)
    for r in placed.groupBy("label").count().collect():
        held[r["label"]] = r["count"]
    quota = [total // n_shards + (t < total % n_shards) for t in range(n_shards)]
    kept = [min(h, q) for h, q in zip(held, quota)] + [0]
    need = [q - k for q, k in zip(quota, kept)]
    before = _running(need) + [sum(need)]
    label = F.col("label")
    at = F.col("rank") - step(_running(held), label)
    stays = at < step(kept, label)
    free = step(_running([h - k for h, k in zip(held, kept)]), label) + at - step(kept, label)
    shard = F.lit(n_shards - 1)
    for t in reversed(range(n_shards - 1)):
        shard = F.when(F.col("_free") < before[t + 1], F.lit(t)).otherwise(shard)
    out = (placed.withColumn("_at", at).withColumn("_stays", stays).withColumn("_free", free)
            .withColumn("shard", F.when(F.col("_stays"), label).otherwise(shard).cast("int"))
            .withColumn("slot", F.when(F.col("_stays"), F.col("_at"))
                        .otherwise(step(kept, F.col("shard")) + F.col("_free") - step(before, F.col("shard")))))
    if order:
        out = global_rank(out.select("doc_id", "size", "text_crc32", "order", "shard"), [F.col("shard"), F.col("order")], "at")
        out = out.withColumn("slot", F.col("at") - step(_running(quota), F.col("shard")))
    elif source:
        out = mixed(out.select("doc_id", "size", "text_crc32", "source", "shard"), weights, within="shard").withColumn("slot", F.col("position"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_label_propagation(spark, sf_dir: str) -> DataFrame:
    return balanced_shards(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), 24)
