"""Spark session settings the operators rely on.

* session time zone UTC: ``to_date(ts)`` must mean the UTC calendar day;
* AQE on: runtime coalescing of shuffle partitions and skew-join splitting;
* the Spark UI stays off (no server is opened);
* ``spark.checkpoint.dir`` is read from the session and only set when the
  cluster left it unset (tests, local runs).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session we build. They are plain SQL confs, so a
# cluster job can pass the same values with --conf instead.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # Parquet scans: vectorised reader, filter pushdown (both defaults, stated
    # here because the operators depend on them for pruning).
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "kpiforge", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    The master is only set when given: otherwise the one that was submitted
    holds (Spark's own default without one is ``local[*]``).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. the one a
    driver hands us). Only runtime-modifiable keys are touched."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(k, None) != SESSION_CONF[k]:
            spark.conf.set(k, SESSION_CONF[k])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/object-store) folder and is
    used as is. When it is unset, a fresh folder under the system temp dir is
    created and registered, in local mode only: executors on other machines
    would not see it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = current.get() if current.isDefined() else None
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        current = tempfile.mkdtemp(prefix="kpiforge-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current
