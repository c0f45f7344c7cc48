"""Queries that SQL can express, against DuckDB on whole tables; and the registry."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from kpiforge.llm import queries

SF = "/root/testdata/sf0.01"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_registry_has_each_operator_once():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{n}" for n in range(1, len(queries.QUERIES) + 1)]
    assert {*queries.QUERIES, "pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(queries.ORACLE[key])
    names = [d[0] for d in cur.description]
    got = queries.QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
