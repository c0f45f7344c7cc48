import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("KPIFORGE_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from kpiforge.session import apply_sql_conf, ensure_checkpoint_dir, SESSION_CONF

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    apply_sql_conf(s)
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, cols=None):
    """Sorted list of tuples (None sorts first)."""
    cols = cols or df.columns
    recs = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(recs, key=lambda t: tuple((v is not None, v) for v in t))
