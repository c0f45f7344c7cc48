"""Connected components of an edge table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; ``component`` is the
    smallest node that can be reached. An empty edge table gives no rows.

    Each round points every node at the smallest of its neighbours and itself,
    follows these pointers to their ends, and goes on with the edges between
    different ends only, each once: edges and nodes shrink from round to round.
    Pointers and edges are written to the shared folder; only row counts reach
    the driver."""
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    while True:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        ends = _roots(stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                             .select("node", F.least("node", "m").alias("label")), "pointers"))
        if found is None:
            found = ends
        else:
            later = ends.select(F.col("node").alias("_n"), F.col("label").alias("_end"))
            found = stored(found.join(later, F.col("label") == F.col("_n"), "left")
                           .select("node", F.coalesce("_end", "label").alias("label")), "labels")
        of = [ends.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")) for c in ("a", "b")]
        edges = stored(edges.join(of[0], "a").join(of[1], "b").where("of_a <> of_b")
                       .select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct(), "edges")
        if not edges.limit(1).count():
            return found.select("node", F.col("label").alias("component"))


def _roots(pointers: DataFrame) -> DataFrame:
    """Follow ``label`` of (node, label) to its end; labels never exceed nodes.
    Each step doubles the length followed."""
    while True:
        # both sides are plain tables: a label that very many nodes share is split by AQE
        up = pointers.select(F.col("node").alias("_n"), F.col("label").alias("_up"))
        jumped = stored(pointers.join(up, F.col("label") == F.col("_n"), "left")
                        .select("node", F.col("label").alias("old"), F.coalesce("_up", "label").alias("label")), "jumped")
        pointers = jumped.select("node", "label")
        if not jumped.where("old <> label").limit(1).count():
            return pointers
