"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. ``run`` writes each stage's rows to the
shared folder and reads them back for the next. The order of the mix is the order
of the files' rows: sharding reads it from file names and row numbers, deals the
rows to the shards in turn and keeps it within each. Equal texts are gone by then;
documents with a long line in common are linked, and labels are propagated along these
links until no round brings more of them together. Rows that come from no files
have no order; sharding then mixes them within each shard, to the same weights.

Nulls: a null text is never toxic, a copy or contaminated, and counts as empty
for sharding; rows with a null ``doc_id`` are judged by their text where a stage
can and are never removed as copies. Repeated rows of one ``doc_id`` are one
document: they stay or go together. Extra columns pass through, whatever their
names. Empty input gives empty output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm import forest, mixing, sharding, templates, toxicity
from kpiforge.llm.common import stored, table

N_SHARDS = 24
LINE_CHARS = 40  # of a line that links the documents it stands in


def _apart(docs: DataFrame, names: tuple[str, ...], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keep`` on ``docs`` with all columns but ``names`` under names no operator uses."""
    columns = docs.columns
    inner = [c if c in names else f"_in_{i}" for i, c in enumerate(columns)]
    return keep(docs.toDF(*inner)).select(*[F.col(i).alias(c) for i, c in zip(inner, columns, strict=True)])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _apart(docs, ("doc_id", "text"), lambda d: toxicity.scored(d, grammar).where("predicted = 0"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = forest.near_duplicates(docs.select("doc_id", "text"), k=5, percent=80)
    copies = stored(judged.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select(
        F.col("doc_id").alias("_copy")), "copies")
    return docs.join(copies, docs["doc_id"] == copies["_copy"], "left_anti")


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, ("doc_id", "text"), lambda d: templates.decontaminate(d, table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, ("doc_id", "source"), mixing.in_mixed_order)


def in_file_order(docs: DataFrame, *columns: str) -> tuple[DataFrame, list[str]]:
    """``columns`` of ``docs`` and, if its rows are those of files, two more: the name
    of the file, as Spark numbers the files of a write, and the row's number in it."""
    try:
        return docs.select(*columns, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at")), ["_file", "_at"]
    except AnalysisException:
        return docs.select(*columns), []


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, order = in_file_order(docs, "doc_id", "text", "source")
    return sharding.balanced_shards(rows, N_SHARDS, rounds=None, source="source", order=order, line_chars=LINE_CHARS)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Toxicity and mixing cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
