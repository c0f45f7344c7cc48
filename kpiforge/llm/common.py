"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.session import ensure_checkpoint_dir

_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
_MADE: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{label}"
    _MADE.append((spark, path.rpartition("/")[0]))
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives the loss of executors, and later joins see two plain inputs, so
    AQE may split skewed partitions of either."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Delete the work tables this process made in ``spark``'s session. Call it
    once the results that read them have been written."""
    keep = []
    jvm = spark.sparkContext._jvm
    for owner, path in _MADE:
        if owner is spark:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        else:
            keep.append((owner, path))
    _MADE[:] = keep


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _ASCII_UPPER, _ASCII_LOWER)


def is_held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A deterministic number in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / float(1 << 30)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based rank in the total order ``order`` as column ``name``.

    Range-partitioned sort, local positions, then offsets of the partitions.
    Only one row count per shuffle partition reaches the driver; the sorted
    rows are written once, so a retried task cannot renumber them. Rows that
    tie in ``order`` get distinct ranks in an arbitrary but fixed order."""
    spark = df.sparkSession
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_kf_mid", F.monotonically_increasing_id()), "ranked")
    rows = rows.withColumn("_kf_pid", F.shiftright("_kf_mid", 33))
    sizes = sorted((r[0], r[1]) for r in rows.groupBy("_kf_pid").count().collect())
    offsets, total = [], 0
    for pid, n in sizes:
        offsets.append((pid, total))
        total += n
    first = spark.createDataFrame(offsets, "_kf_pid long, _kf_first long")
    return (rows.join(F.broadcast(first), "_kf_pid")
            .withColumn(name, F.col("_kf_first") + F.col("_kf_mid").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_kf_pid", "_kf_first", "_kf_mid"))


def step(values: list[int], index: Column) -> Column:
    """``values[index]`` for a short list the driver knows."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index.cast("int") + 1)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column, without copying.
    A null row has no bytes."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def slices(offsets: np.ndarray, most: int = 1 << 21):
    """Ranges of rows with about ``most`` bytes each; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j
