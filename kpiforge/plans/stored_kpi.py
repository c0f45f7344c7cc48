"""The wide customer tables over stored inputs.

Everything that several jobs need is written once per version of the base tables
and clocks, below the shared folder, and found again by that version:

* the bet fact, derived and joined once, in folders by month and sorted by
  customer. A customer with a third of all bets is spread over many files.
* every input of the stars with one row per customer, in buckets by customer, so
  the 8, 16 and 19 joins of a wide table need no exchange;
* the three wide tables and the flag tables of the two reconciliations.

Before a wide table is written, its inputs are checked for one row per key in
one job that fails with the input and key; the DISTINCT over the whole row is
then left out.

Joins with anything that grows are sort-merge joins: no side is broadcast for the
small size of its files, so what the driver holds does not grow with the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.operators import bets as B
from kpiforge.operators import reconcile as RE
from kpiforge.plans import customer360 as K
from kpiforge.plans.kpi_pairs import BATCHES_VS_COMBINED, INITIAL_VS_COMBINED, KPI_TOLERANCE
from kpiforge.session import ensure_checkpoint_dir
from kpiforge.sources.domain import Domain, bet_lines, bets_of_lines
from kpiforge.sources.stored import StoredTables, input_version
from kpiforge.sources.tables import Tables

#: Part of every version: raise it when a stored table changes its meaning.
LAYOUT = 1
SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
BYTES_PER_BUCKET = 256 << 20  # of base tables; the customer grain is a fraction of them


def one_row_per_key(inputs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """A table that is empty if in each input ``name: (rows, key)`` no key but NULL
    occurs twice, and else fails with the input's name and the key."""
    def repeated(name, df, key):
        return (df.groupBy(F.col(key).alias("key")).count().where("count > 1 AND key IS NOT NULL")
                .select(F.raise_error(F.concat(F.lit(f"input {name}: several rows with {key} = "), F.col("key").cast("string"))).alias("failed")))
    return reduce(DataFrame.unionAll, [repeated(n, df, key) for n, (df, key) in inputs.items()])


class StoredKpi:
    """Lazy, stored tables of one folder of base tables and one pair of clocks."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of, as_of_events, root: str | None = None, buckets: int | None = None):
        self.spark, self.as_of, self.as_of_events = spark, as_of, as_of_events
        paths = [f"{sf_dir}/{t}.parquet" for t in SOURCES]
        version, size = input_version(spark, paths, LAYOUT, str(as_of), str(as_of_events), buckets)
        self.buckets = buckets or max(8, -(-size // BYTES_PER_BUCKET))
        self.store = StoredTables(spark, root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpiforge-tables", version)
        self.plain = Domain(Tables(spark, sf_dir, merge_joins=True))

    def bet_fact(self) -> DataFrame:
        """The bet fact, one read of which feeds any measure: no join is left."""
        def build():
            return bet_lines(self.plain.tables).withColumn("kpi_month", F.trunc(F.to_date("o_orderdate"), "MM"))
        return self.store.table("bet_fact", build, partition_by=["kpi_month"], cluster_by="o_custkey",
                                finish=lambda lines: bets_of_lines(lines, "kpi_month"))

    def domain(self) -> Domain:
        return Domain(self.plain.tables, {"bets": self.bet_fact()})

    def _build_input(self, name: str) -> DataFrame:
        d = self.domain()
        df = K.INPUTS[name](d, self.as_of, self.as_of_events)
        if K.KEY not in df.columns:  # keyed by customer_id: brought to the key of the star
            df = d.customers.select("customer_id", K.KEY).join(df, "customer_id").drop("customer_id")
        return df

    def input(self, name: str) -> DataFrame:
        return self.store.table(f"input_{name}", lambda: self._build_input(name), cluster_by=K.KEY, buckets=self.buckets)

    def _wide(self, name: str, build) -> DataFrame:
        def checked():
            used: dict[str, DataFrame] = {}

            def get(part):
                used[part] = self.input(part)
                return used[part]
            out = build(get)
            one_row_per_key({n: (df, K.KEY) for n, df in used.items()}).write.format("noop").mode("overwrite").save()
            return out
        return self.store.table(name, checked, cluster_by=K.KEY, buckets=self.buckets)

    def initial(self) -> DataFrame:
        return self._wide("kpi_initial", lambda get: K.kpi_initial(self.plain, self.as_of, get))

    def combined(self) -> DataFrame:
        return self._wide("kpi_combined", lambda get: K.kpi_combined(self.plain, self.as_of, self.as_of_events, get, unique=True))

    def batches(self) -> DataFrame:
        return self._wide("kpi_batches", lambda get: K.kpi_batches(
            self.plain, self.as_of, self.as_of_events, self.initial(), get, unique=True))

    def batches_flags(self) -> tuple[DataFrame, list[str]]:
        """The flags of batches against combined, and their labels."""
        flags = self.store.table("flags_batches", lambda: RE.diff_flags(
            self.batches(), self.combined(), K.KEY, BATCHES_VS_COMBINED, tol=KPI_TOLERANCE))
        return flags, RE.pair_labels(BATCHES_VS_COMBINED)

    def initial_flags(self) -> tuple[DataFrame, list[str]]:
        flags = self.store.table("flags_initial", lambda: RE.diff_flags(self.initial(), self.combined(), K.KEY, INITIAL_VS_COMBINED))
        return flags, RE.pair_labels(INITIAL_VS_COMBINED)

    def bet_measures(self) -> DataFrame:
        """Lifetime and 30-day measures over the stored fact."""
        return B.lifetime_and_l30(self.bet_fact(), self.as_of)
