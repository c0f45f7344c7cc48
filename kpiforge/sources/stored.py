"""Derived tables that are built once per version of their inputs and read by every job after that."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.sources import published


def input_version(spark: SparkSession, paths: list[str], *facts) -> tuple[str, int]:
    """(version, bytes) of the files below ``paths``: a digest of their names,
    lengths and modification times, and of ``facts`` (clocks, layout). The files
    are listed and hashed by Spark; one row comes back, and no content is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
             .select("path", "length", "modificationTime"))
    row = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return hashlib.sha256(repr((tuple(row), facts)).encode()).hexdigest()[:20], int(row[1] or 0)


class StoredTables:
    """Tables below ``root`` (a shared folder), found by name and input version."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/{self.version}"

    def has(self, name: str) -> bool:
        return published.current(self.spark, self.path(name)) is not None

    def table(self, name: str, build: Callable[[], DataFrame], **layout) -> DataFrame:
        """The table ``name``; built and published if this version has none yet.
        Two jobs that build it at the same time each publish a whole table. Joins with
        it are sort-merge joins, as with :class:`Tables` that have ``merge_joins``."""
        record = published.current(self.spark, self.path(name))
        if record is None:
            record = published.publish(build(), self.path(name), **layout)
        return published.read(self.spark, self.path(name), record).hint("merge")
