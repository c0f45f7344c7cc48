"""Every registered query against its DuckDB oracle (exact values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
LLM_QUERIES, LLM_ORACLE = E._llm_queries()  # tested in tests/llm
ORACLE = {k: v for k, v in E.oracle_sql().items() if k not in LLM_ORACLE}
QUERIES = {k: v for k, v in E.queries().items() if k not in LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int, float)):
        return (1, float(v)) if not (isinstance(v, float) and math.isnan(v)) else (2, "nan")
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


def test_every_query_has_an_oracle_or_is_declared():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == E.NO_ORACLE


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_ORACLE)
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_uid" in df.columns


def test_pair_lists_agree():
    """Two lists written apart: same columns, names, kinds and order."""
    from kpiforge.plans import kpi_pairs
    from oracle import pairs
    for ours, theirs in ((kpi_pairs.BATCHES_VS_COMBINED, pairs.BATCHES), (kpi_pairs.INITIAL_VS_COMBINED, pairs.INITIAL)):
        assert [(p.left, p.right, p.label, p.kind) for p in ours] == theirs
    assert (len(pairs.BATCHES), len(pairs.INITIAL)) == (93, 40)
    assert kpi_pairs.KPI_TOLERANCE == pairs.TOLERANCE
