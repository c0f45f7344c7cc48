"""Nearest neighbours by multiprobe p-stable hashing.

A table has a few Gaussian (2-stable) projections, each cut into cells of one
width; a bucket is a combination of cells. A query visits its own bucket and
perturbed ones in the order of their estimated success: how much likelier a
neighbour's projections are to fall there than any row's. It goes on until the
estimated share of its neighbours is reached; that share is set on a bounded
sample, where true neighbours are known, so that the wanted recall results.
Candidates of all tables merge and are reranked by their exact inner product.

Largest inner product becomes smallest distance by one more coordinate,
sqrt(M^2 - |x|^2) with M the largest norm (0 for a query)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.common import stored

TABLES, CELLS = 2, 4
#: Rows a bucket should hold; most projections of a table (CELLS ** 6 buckets).
BUCKET_ROWS, MAX_PROJECTIONS = 1500, 6
#: Bounds: rows of the sample the index is fitted on, queries handled at a time.
SAMPLE, QUERY_BLOCK = 8192, 4096
RECALL = 0.96
FOUND = "query_id long, vec_id long, score double"


def usable(v: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


@dataclass
class Index:
    """planes: (tables, dim + 1, projections), unit columns; edges: inner cell
    borders (tables, projections, CELLS - 1); spread: of a row's projections;
    norm: the largest; near: cosine at which neighbours are looked for; share:
    estimated share of the neighbours at which a query stops."""
    planes: np.ndarray
    edges: np.ndarray
    spread: np.ndarray
    norm: float
    near: float = 0.5
    share: float = 1.0

    @property
    def n_buckets(self) -> int:
        return CELLS ** self.planes.shape[2]

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """(tables, rows) bucket numbers."""
        z = self._lifted(x) @ self.planes  # (tables, rows, projections)
        cell = (z[:, :, :, None] >= self.edges[:, None]).sum(3)
        return (cell * CELLS ** np.arange(z.shape[2])).sum(2)

    def _lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.norm ** 2 - (x * x).sum(1)))
        return np.concatenate([x, rest[:, None]], 1)

    def visited(self, q: np.ndarray, share: float | None = None) -> np.ndarray:
        """(tables, queries, buckets): the buckets each query visits."""
        share = self.share if share is None else share
        length = np.linalg.norm(q, axis=1, keepdims=True)
        out = np.zeros((len(self.planes), len(q), self.n_buckets), bool)
        if share >= 1:
            out[:] = True
            return out
        for t, plane in enumerate(self.planes):
            # a neighbour's projection: near * that of the query's direction, plus Gaussian noise
            mean = self.near * self.norm * ((q / length) @ plane[:-1])
            log_hit, log_any = np.zeros((len(q), 1)), np.zeros((1, 1))
            for j in reversed(range(plane.shape[1])):
                s = self.spread[t, j]
                border = np.concatenate([[-np.inf], self.edges[t, j], [np.inf]])
                hit = np.diff(_phi((border[None] - mean[:, j:j + 1]) / (s * np.sqrt(max(1e-6, 1 - self.near ** 2)))), axis=1)
                some = np.diff(_phi(border[None] / s), axis=1)
                log_hit = (log_hit[:, :, None] + np.log(hit + 1e-12)[:, None]).reshape(len(q), -1)
                log_any = (log_any[:, :, None] + np.log(some + 1e-12)[:, None]).reshape(1, -1)
            order = np.argsort(log_any - log_hit, axis=1, kind="stable")
            gained = np.cumsum(np.take_along_axis(np.exp(log_hit), order, 1), axis=1)
            last = (gained < share).sum(1, keepdims=True)
            np.put_along_axis(out[t], order, np.arange(self.n_buckets)[None] <= last, 1)
        return out


def _phi(x: np.ndarray) -> np.ndarray:
    """The normal distribution function (logistic form, error below 2e-4)."""
    x = np.clip(x, -8, 8)
    return 1 / (1 + np.exp(-(1.5976 * x + 0.07056 * x ** 3)))


def fit(sample: np.ndarray, total: int, norm: float, k: int, recall: float = RECALL, tables: int = TABLES, seed: int = 11) -> Index:
    """An index for ``total`` rows like those of ``sample``. Of the sample, up to
    512 rows serve as queries: their true neighbours in it set ``near`` and
    ``share``. Neighbours among fewer rows are farther away, so the recall over
    all rows is at least about that of the sample."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + 1
    p = int(np.clip(round(np.log(max(2.0, total / BUCKET_ROWS)) / np.log(CELLS)), 1, min(MAX_PROJECTIONS, dim)))
    planes = np.stack([np.linalg.qr(rng.normal(size=(dim, p)))[0] for _ in range(tables)])
    index = Index(planes, np.zeros((tables, p, CELLS - 1)), np.ones((tables, p)), norm)
    z = index._lifted(sample) @ planes
    index.spread = np.maximum(z.std(1), 1e-9)
    width = 1.2 * index.spread
    inner = np.arange(CELLS - 1) - (CELLS - 2) / 2
    index.edges = (z.mean(1) + rng.uniform(-0.2, 0.2, index.spread.shape) * width)[:, :, None] + inner * width[:, :, None]
    q = sample[np.linspace(0, len(sample) - 1, min(512, len(sample))).astype(int)]
    score = q @ sample.T
    score[np.arange(len(q)), np.linspace(0, len(sample) - 1, len(q)).astype(int)] = -np.inf
    n = min(k, len(sample) - 1)
    if n < 1:
        return index
    best = np.argpartition(-score, n - 1, axis=1)[:, :n]
    cosine = np.take_along_axis(score, best, 1) / (np.linalg.norm(q, axis=1, keepdims=True) * norm)
    index.near = float(np.clip(np.quantile(cosine, 0.1), 0.05, 0.95))
    bucket = index.buckets(sample)
    for share in (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.93, 0.96, 0.98, 0.99, 0.995):
        seen = index.visited(q, share)
        hit = np.zeros(best.shape, bool)
        for t in range(tables):
            hit |= np.take_along_axis(seen[t], bucket[t][best], 1)
        if hit.mean() >= recall:
            index.share = share
            break
    return index


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, sample_rows: int = SAMPLE,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors(vec_id,
    embedding)`` that ``is_query`` marks, the ``k`` rows found with the largest
    inner product (double precision), nearest first, ties to the smaller id; all
    that were found, if fewer. A row is no neighbour of its own id.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part, nor do null ids; vectors meet those of their own length only.
    Rows that repeat an id count once, with their best score. Extra columns are
    ignored. An empty table gives an empty table.

    The index holds every row, once a table, sorted by bucket over the cluster;
    a bucket that very many rows share spreads over several partitions. The
    queries come in blocks of ``query_block``: a block and the buckets it visits
    go to all tasks, and a task returns at most ``k`` rows for a query. A block's
    result is written before the next block."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("_kf_q", F.coalesce(is_query, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), "_kf_q").where(
        usable(F.col("v")) & F.col("vec_id").isNotNull())
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    out = None
    for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("m")).collect():
        own = rows.where(F.col("dim") == r["dim"])
        drawn = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vec_id", "v").collect()
        sample_ids = np.array([x[0] for x in drawn], np.int64)
        sample = np.array([x[1] for x in drawn])
        index = fit(sample, r["n"], float(np.sqrt(r["m"])), k, recall)
        table = stored(_indexed(own, index), "index")
        asked = own.where("_kf_q")
        n_blocks = max(1, -(-asked.count() // query_block))
        for b in range(n_blocks):
            block = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).select("vec_id", "v").collect()
            if not block:
                continue
            one = stored(_probe(spark, table, index, block, sample_ids, sample, k), "found")
            out = one if out is None else out.union(one)
    if out is None:
        out = spark.createDataFrame([], FOUND)
    best = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _indexed(rows: DataFrame, index: Index) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1))
            for t, bucket in enumerate(held.value.buckets(v)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(bucket.astype(np.int32)), *batch.columns],
                                                 ["t", "bucket", "vec_id", "v"])
    return (rows.select("vec_id", "v").mapInArrow(run, "t int, bucket int, vec_id long, v array<double>")
            .repartitionByRange("t", "bucket", "vec_id").sortWithinPartitions("t", "bucket"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order: equal vectors tie exactly."""
    return (a * b).sum(1)


def _top(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    keep = np.ones(len(q), bool)
    keep[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score = q[keep], ids[keep], score[keep]
    start = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - start < k
    return q[keep], ids[keep], score[keep]


def _probe(spark, table: DataFrame, index: Index, block, sample_ids, sample, k: int) -> DataFrame:
    ids = np.array([x[0] for x in block], np.int64)
    q = np.array([x[1] for x in block])
    seen = index.visited(q)
    # the sample's rows in the visited buckets: their k-th best score bounds the result from below, and where
    # they are too few to fill a result the query visits every bucket; rows are found by the buckets alone
    bucket = index.buckets(sample)
    floor = np.full(len(q), -np.inf)
    for part in range(0, len(q), 256):
        own = slice(part, part + 256)
        met = ids[own, None] != sample_ids[None]
        met &= np.any([seen[t][own][:, bucket[t]] for t in range(len(bucket))], axis=0)
        few = met.sum(1) < k
        seen[:, part:part + len(few)][:, few] = True
        if not few.all():
            score = np.where(met, q[own] @ sample.T, -np.inf)
            worst = -np.partition(-score, k - 1, axis=1)[:, k - 1]
            floor[own] = np.where(few, -np.inf, worst - 1e-9 * (1 + np.abs(np.where(few, 0, worst))))
    seen = np.packbits(seen, axis=1)  # a bit for each query
    held = spark.sparkContext.broadcast((ids, q, seen, floor))

    def run(batches):
        import pyarrow as pa

        ids, q, seen, floor = held.value
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            t, bucket, vec = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            v = _matrix(batch.column(3))
            key = t.astype(np.int64) * (1 << 32) + bucket
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            found = [kept]
            for s, e in zip(cut[:-1], cut[1:], strict=True):
                asking = np.flatnonzero(np.unpackbits(seen[t[s], :, bucket[s]], count=len(ids)))
                for part in range(0, len(asking), 512):
                    who = asking[part:part + 512]
                    i, j = np.nonzero(q[who] @ v[s:e].T >= floor[who, None])
                    far = ids[who[i]] != vec[s + j]
                    i, j = who[i[far]], s + j[far]
                    if len(i) > 4 * k * len(who):  # many ties or no floor: cut at once
                        found.append(_top(i, vec[j], _exact(q[i], v[j]), k))
                    elif len(i):
                        found.append((i, vec[j], _exact(q[i], v[j])))
            kept = _top(*(np.concatenate(x) for x in zip(*found, strict=True)), k)
        if len(kept[0]):
            yield pa.RecordBatch.from_arrays([pa.array(ids[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], ["query_id", "vec_id", "score"])
    return table.mapInArrow(run, FOUND)


def op1_multiprobe_lsh(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, F.col("vec_id") % 20 == 0, k=20)
