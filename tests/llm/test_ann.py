import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiforge.llm import ann as A
from kpiforge.llm import queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, ids, vectors):
    return spark.createDataFrame([(i if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in zip(ids, vectors, strict=True)], SCHEMA)


def brute(ids, vectors, queries, k):
    out = {}
    for q in queries:
        at = [i for i, x in enumerate(ids) if x == q][0]
        score = [(-float((vectors[at] * v).sum()), x) for x, v in zip(ids, vectors, strict=True) if x != q]
        out[q] = [(x, -s) for s, x in sorted(score)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_recall_on_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 32))
    v = np.concatenate([rng.normal(size=(3000, 32)), np.repeat(centre, 50, 0) + 0.05 * rng.normal(size=(2000, 32))]).astype(np.float32).astype(float)
    ids = rng.permutation(20_000)[:5000].tolist()
    asked = sorted(i for i in ids if i % 20 == 0)
    got = found(A.nearest(frame(spark, ids, v), F.col("vec_id") % 20 == 0, k=20, sample_rows=2000, query_block=100))
    want = brute(ids, v, asked, 20)
    assert sorted(got) == asked and all(len(x) == 20 for x in got.values())
    hit = sum(s >= want[q][-1][1] - 1e-12 for q in asked for _, s in got[q])
    assert hit >= 0.93 * 20 * len(asked)
    at = dict(zip(ids, v, strict=True))
    assert all(s == (at[q] * at[i]).sum() for q in asked for i, s in got[q])


def test_query_meets_the_recall_on_the_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    asked = [i for i in ids if i % 20 == 0]
    got = found(queries.QUERIES["op1_multiprobe_lsh"](spark, SF))
    want = brute(ids, v, asked, 20)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in asked) >= 0.9 * 20 * len(asked)


def test_buckets_are_visited_from_the_likeliest_on():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(8000, 16))
    index = A.fit(v, 200_000, float(np.linalg.norm(v, axis=1).max()), 10)
    assert index.planes.shape[2] >= 3
    few, many = index.visited(v[:50], 0.5), index.visited(v[:50], 0.9)
    assert (few <= many).all() and few.sum() < many.sum() < many.size
    bucket = index.buckets(v)
    assert bucket.min() >= 0 and bucket.max() < index.n_buckets


def test_ties_go_to_the_smaller_id_in_a_large_group_of_copies(spark):
    ids = list(range(3000))
    v = [[1.0, 0.0, 0.0, 0.0]] * 2000 + np.random.default_rng(1).normal(size=(1000, 4)).tolist()
    got = found(A.nearest(frame(spark, ids, v), F.col("vec_id").isin(0, 700, 2500), k=5))
    same = [i for i, x in enumerate(v) if i >= 2000 and np.float32(x[0]) > 1]
    if not same:
        assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[700]] == [0, 1, 2, 3, 4]
    ranks = [(-s, i) for i, s in got[700]]
    assert ranks == sorted(ranks)


def test_vectors_that_take_no_part_and_other_lengths(spark):
    ids = [20, 40, 60, 80, 100, 120, 1, 2, None, 3, 4, 140, 160]
    v = [None, [], [0, 0], [1, None], [float("nan"), 1], [float("inf"), 1], [1, 2], [3, 4], [5, 6], [1, 1, 1], [2, 2, 2], [1, 1], [1, 0, 0]]
    got = found(A.nearest(frame(spark, ids, v), F.col("vec_id") % 20 == 0, k=20))
    assert got == {140: [(2, 7.0), (1, 3.0)], 160: [(4, 2.0), (3, 1.0)]}


def test_repeated_ids_empty_table_and_clashing_columns(spark):
    got = found(A.nearest(frame(spark, [20, 20, 1, 1], [[1, 0], [1, 0], [2, 0], [2, 0]]), F.col("vec_id") % 20 == 0))
    assert got == {20: [(1, 2.0)]}
    assert A.nearest(frame(spark, [], []), F.col("vec_id") % 20 == 0).count() == 0
    assert found(A.nearest(frame(spark, [20], [[1, 2]]), F.col("vec_id") % 20 == 0)) == {}
    clash = spark.sql("select id as vec_id, array(1.0f, id) embedding, 'a' rank, 'b' score, 'c' t, 'd' dim, 'e' v, 'f' query_id from range(3)")
    assert found(A.nearest(clash, F.col("vec_id") % 20 == 0)) == {0: [(1, 1.0), (2, 1.0)]}


@pytest.mark.parametrize("p", [1e-3, 0.2, 0.5, 0.9])
def test_normal_distribution_function(p):
    from statistics import NormalDist
    assert A._phi(np.array([NormalDist().inv_cdf(p)]))[0] == pytest.approx(p, abs=5e-4)
