"""Monthly activity status maintained by Structured Streaming.

The reference's incremental model is a scheduled batch job. The streaming
form reads both activity feeds as file streams, reduces every micro-batch to
distinct (customer, month) pairs and hands them to the same upsert the batch
job uses (:func:`kpiforge.operators.activity.upsert_months`) through
``foreachBatch``: new keys are anti-joined against the target (NULL-safe, so
a replayed micro-batch after a failure inserts nothing twice), classified
against the target's first-month index and neighbouring months, and appended.

``trigger(availableNow=True)`` processes everything present and stops, which
is how a scheduled run uses it; a long-running job would use a processing
time trigger instead. Progress is kept in a checkpoint folder under the
session's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kpiforge.operators import activity as AC
from kpiforge.session import ensure_checkpoint_dir
from kpiforge.sources.domain import second_feed, sportsbook_feed
from kpiforge.sources.tables import Tables


def feed_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds as one stream of (customer_uid, year_month) rows; the feed
    definitions are the batch ones, applied to streaming scans."""
    streams = {}
    for name in ("orders", "events"):
        schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
        reader = spark.readStream.schema(schema)
        # a file stream watches a folder: the table's own, or, for a table
        # stored as one file, the folder around it with only that file
        if AC.is_folder(spark, f"{sf_dir}/{name}.parquet"):
            streams[name] = reader.parquet(f"{sf_dir}/{name}.parquet")
        else:
            streams[name] = reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    tables = Tables(spark, sf_dir, overrides=streams)
    return AC.feed_months(sportsbook_feed(tables), second_feed(tables))


def run_activity_stream(spark: SparkSession, sf_dir: str, target: str, checkpoint: str | None = None) -> None:
    """Process all available feed files into the month-partitioned target."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    checkpoint = checkpoint or f"{root}/kpiforge-stream/{uuid.uuid4().hex}"

    AC.ensure_target(spark, target)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        # dedup per micro-batch (no unbounded streaming state); the upsert
        # itself skips keys already in the target, so a replay is harmless
        AC.upsert_months(batch.sparkSession, batch, target)

    q = (feed_streams(spark, sf_dir).writeStream
         .foreachBatch(upsert)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
