"""Tables that are replaced as a whole, without a moment in which half of one can be read.

A table is a folder that holds versions and one small pointer file. A write goes
to a fresh version folder; when it is complete, the pointer is swapped by an
atomic rename. Readers follow the pointer, so they see the old version or the
new one. A job that dies between write and swap leaves an unused folder, which
:func:`vacuum` deletes. The pointer also keeps the schema of the table, so a
column that a later write adds is typed for all files without opening them, and
the bucket layout, so a session that did not write the table can use it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTER = "_CURRENT"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, root: str) -> dict | None:
    """What the pointer of ``root`` says, or None if nothing is published."""
    path, fs = _hadoop(spark, f"{root}/{POINTER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point(spark: SparkSession, root: str, record: dict) -> None:
    """Swap the pointer of ``root``."""
    jvm = spark.sparkContext._jvm
    temp, fs = _hadoop(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = _hadoop(spark, f"{root}/{POINTER}")[0]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(temp, target, options)


def fresh_folder(root: str) -> str:
    return f"{root}/v-{uuid.uuid4().hex}"


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, cluster_by: str | None = None,
            buckets: int | None = None, extra: dict | None = None,
            finish: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """Replace the table at ``root`` by ``df`` and return its record.

    ``partition_by`` gives folders; ``cluster_by`` sorts by that column within the
    files, and with ``buckets`` deals the rows by its hash into as many files, so
    that joins and aggregates on it need no exchange. Use buckets for columns
    that no value fills: a bucket is one task. ``finish`` derives the table's
    columns from ``df`` row by row, in order, after the rows have been dealt and
    sorted: what it can derive is then neither moved nor sorted. It keeps the
    ``partition_by`` columns; ``cluster_by`` names a column of ``df``."""
    spark = df.sparkSession
    folder = fresh_folder(root)
    before = current(spark, root)
    finish = finish or (lambda rows: rows)
    if buckets:
        df = finish(df)
        name = table_name(folder)
        (df.repartition(buckets, cluster_by).write.format("parquet").bucketBy(buckets, cluster_by).sortBy(cluster_by)
         .option("path", folder).option("compression", "zstd").saveAsTable(name))
    else:
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        if cluster_by:
            df = df.sortWithinPartitions(*(partition_by or []), cluster_by)
        df = finish(df)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.option("compression", "zstd").parquet(folder)
    record = {"folder": folder, "schema": df.schema.json(), "schema_version": (before or {}).get("schema_version", 0) + 1,
              "buckets": buckets, "cluster_by": cluster_by, "partition_by": partition_by, **(extra or {})}
    point(spark, root, record)
    return record


def table_name(folder: str) -> str:
    return "kpiforge_" + folder.rpartition("/v-")[2]


def read(spark: SparkSession, root: str, record: dict | None = None) -> DataFrame:
    """The published table at ``root``."""
    record = record or current(spark, root)
    if record is None:
        raise ValueError(f"nothing is published at {root}")
    schema = StructType.fromJson(json.loads(record["schema"]))
    if not record["buckets"]:
        return spark.read.schema(schema).parquet(record["folder"]).select(*schema.names)
    name = table_name(record["folder"])
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = record["cluster_by"]
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) "
                  f"INTO {record['buckets']} BUCKETS LOCATION '{record['folder']}'")
    return spark.table(name)


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the version folders that the pointer does not name. Call it when no
    reader of an older version is left. Returns the number deleted."""
    keep = (current(spark, root) or {}).get("folder", "").rpartition("/")[2]
    path, fs = _hadoop(spark, root)
    gone = 0
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v-") and name != keep:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone
