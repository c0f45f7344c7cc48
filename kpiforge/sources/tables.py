"""Base tables: one parquet file (or folder) per logical name.

A ``Tables`` object maps logical names to lazily read DataFrames, which is
how the reference's fully qualified warehouse names (and dbt ``ref``/``xref``)
are re-aimed: every operator receives DataFrames, never table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)
#: Tables of fixed size; all others grow with the data.
FIXED_TABLES = ("region", "nation")


class Tables:
    """Lazy name -> DataFrame mapping over a folder of parquet tables.

    Reads are cached per name so that every use of ``orders`` in one plan is
    the same relation (lets Spark reuse exchanges over identical subplans).
    Scans keep the splits their files have; ``repartition`` spreads every read
    over that many partitions, for tables stored in too few row groups. With
    ``merge_joins``, a join next to a table that grows is a sort-merge join: Spark
    would broadcast it by the size of its files, which for narrow, well compressed
    columns is a small part of what the driver then holds.
    """

    def __init__(self, spark: SparkSession, root: str, overrides: dict | None = None,
                 repartition: int | None = None, merge_joins: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.repartition = repartition
        self.merge_joins = merge_joins
        self._cache: dict[str, DataFrame] = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            df = df.repartition(self.repartition) if self.repartition else df
            self._cache[name] = df.hint("merge") if self.merge_joins and name not in FIXED_TABLES else df
        return self._cache[name]

    def with_override(self, name: str, df: DataFrame) -> "Tables":
        t = Tables(self.spark, self.root, dict(self._cache), self.repartition, self.merge_joins)
        t._cache[name] = df
        return t
