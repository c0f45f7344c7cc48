"""Near-duplicates with an LSH forest over MinHash signatures.

1. Every text becomes its set of k-word shingles (64-bit hashes), a fingerprint
   of the set and a MinHash signature. Equal sets collapse to one
   representative, the smallest ``doc_id``.
2. Each representative enters several trees. A tree is one order of the
   signature positions; its rows are sorted by the reordered signature over the
   whole cluster (range partitions, so a dense region spreads by itself).
3. Candidates are neighbours with the longest common prefixes. The depth adapts
   per region: where at most ``small_region`` rows share the base depth, all of
   them are compared; in a denser region only the ``reach`` nearest on either
   side are, which are those that agree to the greatest depth there. A pair
   must also agree in ``AGREE`` of the tree's positions.
4. Candidates are confirmed on the full shingle sets; confirmed links give the
   components.
5. Dense regions that still hold several components are closed by an exact
   prefix filter: of their rows, those in different components that share one of
   their rarest shingles are compared on the full sets, where these are many in
   blocks of bounded size. So ``reach`` costs no link, and pages that only share
   a template do not meet.

Chance to lose a link: a pair of similarity s shares a base depth of d in one
tree with s^d, so 16 trees miss a pair at exactly 0.8 with depth 3 with about
2e-5, tests of agreement included."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import slices, stored, text_buffers
from kpiforge.llm.components import connected_components

N_HASH, N_TREES, DEPTH, BASE_DEPTH = 128, 16, 16, 3
SMALL_REGION, REACH = 32, 4
AGREE = 10  # of the DEPTH positions of a path
RARE = 1e-9  # chance that a linked pair agrees in fewer positions than `least_agreement`
BLOCK = 1 << 20  # shingles on either side of one comparison of blocks, about
SKETCH_BITS = 20
SEED = 20231


def _hash_params():
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, N_HASH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, N_HASH, dtype=np.uint64)


def _tree_orders() -> np.ndarray:
    """For each tree the signature positions in its order: own positions first
    (disjoint between trees), then others."""
    rng = np.random.default_rng(SEED + 1)
    own = N_HASH // N_TREES
    out = []
    for t in range(N_TREES):
        first = np.arange(t * own, (t + 1) * own)
        rest = np.setdiff1d(np.arange(N_HASH), first)
        out.append(np.concatenate([first, rng.permutation(rest)])[:DEPTH])
    return np.array(out)


def signatures(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """16-bit MinHash digests, one row per non-empty set."""
    from kpiforge.llm.tokens import U

    full = sizes[sizes > 0]
    first = np.zeros(len(full), np.int64)
    np.cumsum(full[:-1], out=first[1:])
    sig = np.empty((len(full), N_HASH), np.uint16)
    a, b = _hash_params()
    with np.errstate(over="ignore"):
        for k in range(N_HASH):
            low = np.minimum.reduceat(sets * a[k] + b[k], first)
            sig[:, k] = (low * U(0x9E3779B97F4A7C15)) >> U(48)
    return sig


def shingle_rows(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig) of every row; ``sig`` is null for an empty set."""
    def run(batches):
        import pyarrow as pa

        from kpiforge.llm import tokens as T

        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            for i, j in slices(off):
                _, _, h, first = T.words(raw, off[i:j + 1])
                sets, sizes = T.shingle_sets(h, first, k)
                full = np.flatnonzero(sizes)
                f1, f2 = np.zeros(j - i, np.int64), np.zeros(j - i, np.int64)
                sig: list = [None] * (j - i)
                if len(full):
                    at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                    with np.errstate(over="ignore"):
                        f1[full] = np.add.reduceat(T.mix(sets), at).view(np.int64)
                        f2[full] = np.add.reduceat(T.mix(sets ^ T.U(0xA0761D6478BD642F)), at).view(np.int64)
                    for r, s in zip(full, signatures(sets, sizes), strict=True):
                        sig[r] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(sizes), pa.array(f1), pa.array(f2), pa.array(sig, pa.binary())],
                    ["doc_id", "n_shingles", "f1", "f2", "sig"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, sig binary")


def tree_rows(reps: DataFrame) -> DataFrame:
    """One row per representative and tree: (tree, path, id); ``path`` holds the
    tree's first DEPTH digests, big-endian, so bytes sort as the digests do."""
    def run(batches):
        import pyarrow as pa

        orders = _tree_orders()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(n, N_HASH)
            path = sig[:, orders.ravel()].astype(">u2").tobytes()
            width = 2 * DEPTH
            paths = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n * N_TREES, [None, pa.py_buffer(path)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(N_TREES, dtype=np.int32), n)), paths, pa.array(np.repeat(ids, N_TREES))],
                ["tree", "path", "id"])
    return reps.select("id", "sig").mapInArrow(run, "tree int, path binary, id long")


def neighbour_pairs(tree: np.ndarray, path: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs within one sorted run of rows."""
    n = len(ids)
    same = np.empty(n, bool)
    same[0] = False
    same[1:] = (tree[1:] == tree[:-1]) & (path[1:, :BASE_DEPTH] == path[:-1, :BASE_DEPTH]).all(1)
    region = np.cumsum(~same) - 1
    dense = (np.bincount(region) > SMALL_REGION)[region]
    a, b = [], []
    for step in range(1, min(SMALL_REGION, n)):
        at = np.flatnonzero((region[:-step] == region[step:]) & ((step <= REACH) | ~dense[:-step]))
        if not len(at):
            break
        at = at[((path[at] == path[at + step]).sum(1) >= AGREE) & (ids[at] != ids[at + step])]
        a.append(np.minimum(ids[at], ids[at + step]))
        b.append(np.maximum(ids[at], ids[at + step]))
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def candidate_pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of prefix neighbours in the sorted trees. Windows
    run over the batches of a partition; only the last rows of one are held.
    Neighbours that a partition's end parts can still meet in the other trees."""
    def run(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tree = batch.column(0).to_numpy(zero_copy_only=False)
            path = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(n, DEPTH)
            ids = batch.column(2).to_numpy(zero_copy_only=False)
            if held is not None:
                tree, path, ids = (np.concatenate(x) for x in zip(held, (tree, path, ids), strict=True))
            a, b = neighbour_pairs(tree, path, ids)
            if len(a):
                both = np.unique(np.stack([a, b], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])
            held = tuple(x[-SMALL_REGION:] for x in (tree, path, ids))
    ordered = rows.repartitionByRange("tree", "path", "id").sortWithinPartitions("tree", "path", "id")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def shingle_sets_of(docs: DataFrame, k: int) -> DataFrame:
    """(id, items): the sorted 64-bit shingle hashes as bytes."""
    def run(batches):
        import pyarrow as pa

        from kpiforge.llm import tokens as T

        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            for i, j in slices(off):
                _, _, h, first = T.words(raw, off[i:j + 1])
                sets, sizes = T.shingle_sets(h, first, k)
                end = np.cumsum(sizes)
                items = [sets[e - s:e].tobytes() for e, s in zip(end, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(items, pa.binary())], ["id", "items"])
    return docs.select("id", "text").mapInArrow(run, "id long, items binary")


def confirmed(pairs_with_sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets meet ``100 * intersection >= percent * union``."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for r, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                meet = len(x) + len(y) - len(np.union1d(x, y))
                keep[r] = 100 * meet >= percent * (len(x) + len(y) - meet)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])
    return pairs_with_sets.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def region_rows(reps: DataFrame) -> DataFrame:
    """One row per representative and tree: (tree, base, id, component, n);
    ``base`` holds the digests at the base depth."""
    def run(batches):
        import pyarrow as pa

        own = _tree_orders()[:, :BASE_DEPTH]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(n, N_HASH)
            base = np.zeros((n, N_TREES), np.int64)
            for d in range(BASE_DEPTH):
                base = base << 16 | sig[:, own[:, d]]
            names = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), N_TREES) for c in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(N_TREES, dtype=np.int32), n)), pa.array(base.ravel()), *map(pa.array, names)],
                ["tree", "base", "id", "component", "n"])
    return reps.select("id", "sig", "component", "n").mapInArrow(run, "tree int, base long, id long, component long, n long")


def _bucket(s: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((s * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def shingle_counts(sets: DataFrame) -> np.ndarray:
    """How many of ``sets(id, items)`` hold a shingle of each of 2^SKETCH_BITS hash
    buckets: a table of fixed size, added up by Spark."""
    def run(batches):
        import pyarrow as pa

        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            raw, off = text_buffers(batch.column(0))
            for i, j in slices(off):
                at, n = np.unique(_bucket(np.frombuffer(raw[off[i]:off[j]].tobytes(), np.uint64)), return_counts=True)
                counts[at] += n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])
    found = sets.select("items").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SKETCH_BITS, np.int32)
    counts[found["bucket"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.int32).max)
    return counts


def prefix_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(id, left, s): of each set's shingles, those of rare buckets (:func:`shingle_counts`)
    first, as many that two sets of the wanted similarity must share one of them; those
    in the prefix of a single set are left out. A set of n can lose n - ceil(n * percent / 100)
    shingles to a partner. ``left`` counts the set's shingles from this one on, itself included.

    Any one order of the shingles finds every link, so the buckets' counts will do:
    the first shingle two sets share is in the prefix of both. No row is made of a
    shingle outside the prefixes."""
    counts = shingle_counts(sets)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in slices(off):
                s = np.frombuffer(raw[off[i]:off[j]].tobytes(), np.uint64)
                size = np.diff(off[i:j + 1]) // 8
                of = np.repeat(np.arange(j - i), size)
                often = counts[_bucket(s)]
                order = np.lexsort((s, often, of))  # set by set, as before
                pos = np.arange(len(s)) - np.repeat(np.cumsum(size) - size, size)
                keep = (pos <= np.repeat(size - -(-size * percent // 100), size)) & (often[order] > 1)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][of[keep]]), pa.array((size[of] - pos)[keep]), pa.array(s[order][keep].view(np.int64))],
                                                 ["id", "left", "s"])
    rows = stored(sets.select("id", "items").mapInArrow(run, "id long, left long, s long"), "prefix")
    met = stored(rows.groupBy("s").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("s"), "met")
    return rows.join(met, "s", "left_semi").select("id", "left", "s")


def _can_link(percent: int, n_x, n_y, left_x, left_y, least):
    """Whether two sets that first meet at a prefix shingle can still share enough:
    no more than what either has left from there on. Columns or arrays."""
    return (100 + percent) * least(left_x, left_y) >= percent * (n_x + n_y)


def least_agreement(percent: int) -> int:
    """Of all positions: two sets of that similarity agree in fewer with a chance below ``RARE``."""
    from math import comb

    p, at, chance = percent / 100, 0, 0.0
    while at < N_HASH:
        chance += comb(N_HASH, at) * p ** at * (1 - p) ** (N_HASH - at)
        if chance >= RARE:
            break
        at += 1
    return at


def links_out(percent: int):
    """For one block: the linked pairs of components, its outsiders against its rows.
    Sets meet only where sizes, places of the shared shingle and signatures allow a link."""
    least = least_agreement(percent)

    def run(part):
        import pyarrow as pa

        outside = part.column("outside").to_numpy()
        of = part.column("component").to_numpy()
        items = part.column("items").to_pylist()
        sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16).reshape(len(items), N_HASH)
        size = np.array([len(x) for x in items], np.int64) // 8
        left = part.column("left").to_numpy()
        names, at = np.unique(np.frombuffer(b"".join(items), np.uint64), return_inverse=True)
        begin = np.cumsum(size) - size
        row = np.flatnonzero(~outside)
        has = np.zeros(len(names), np.int64)
        found = [np.zeros((2, 0), np.int64)]
        for i in np.flatnonzero(outside):
            to = row[(of[row] != of[i]) & _can_link(percent, size[row], size[i], left[row], left[i], np.minimum)]
            to = to[(sig[to] == sig[i]).sum(1) >= least]
            if not len(to):
                continue
            own = at[begin[i]:begin[i] + size[i]]
            has[own] = 1
            start = np.cumsum(size[to]) - size[to]
            meet = np.add.reduceat(has[at[np.arange(size[to].sum()) + np.repeat(begin[to] - start, size[to])]], start)
            has[own] = 0
            other = np.unique(of[to[100 * meet >= percent * (size[to] + size[i] - meet)]])
            found.append(np.stack([np.minimum(other, of[i]), np.maximum(other, of[i])]))
        pairs = np.unique(np.concatenate(found, 1), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})
    return run


def closing_links(docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of components of ``reps(id, sig, component, n)`` with
    a link between two rows of dense regions that hold several components.

    Two linked rows share one of their prefix shingles (exact, see
    :func:`prefix_shingles`): rows that only share a template mostly do not, and never
    meet; a pair also needs enough shingles left from there on. Rows of the largest component at a shingle meet its other rows only. At a
    shingle of few rows these pairs are joined and confirmed; the rows of another are
    split by hash, on both sides, into blocks of about ``BLOCK`` shingles, and each block
    of one side meets each of the other, so no task holds a frequent shingle's rows."""
    trees = stored(region_rows(reps), "regions")
    key = ["tree", "base"]
    mixed = (trees.groupBy(*key, "component").agg(F.count("*").alias("rows"))
             .groupBy(*key).agg(F.sum("rows").alias("rows"), F.count("*").alias("parts")).where((F.col("rows") > SMALL_REGION) & (F.col("parts") > 1)))
    ids = stored(trees.join(stored(mixed.select(*key), "mixed"), key).select("id").distinct(), "dense")
    dense = stored(reps.join(ids, "id", "left_semi"), "rows")
    sets = stored(shingle_sets_of(docs.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi"), k)
                  .withColumn("h", F.xxhash64("items")).dropDuplicates(["id", "h"]).where("length(items) > 0"), "sets")
    at = stored(prefix_shingles(sets, percent).join(dense.select("id", "component", "n"), "id"), "prefixes")
    lists = (at.groupBy("s", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("w"))
             .groupBy("s").agg(F.sum("rows").alias("rows"), F.count("*").alias("parts"), F.sum("w").alias("w"),
                               F.max(F.struct("rows", "component", "w")).alias("main"))
             .where(F.col("parts") > 1)
             .select("s", "rows", F.col("main.component").alias("main"), F.ceil(F.col("w") / BLOCK).cast("int").alias("blocks"),
                     F.ceil((F.col("w") - F.col("main.w")) / BLOCK).cast("int").alias("chunks")))
    at = stored(at.join(stored(lists, "lists"), "s"), "meeting")

    few = at.where(F.col("rows") <= SMALL_REGION)
    x = few.where("component <> main").select("s", F.col("id").alias("x"), F.col("component").alias("of_x"), F.col("n").alias("n_x"), F.col("left").alias("left_x"))
    y = few.select("s", F.col("id").alias("y"), F.col("component").alias("of_y"), F.col("n").alias("n_y"), F.col("left").alias("left_y"))
    pairs = stored(x.join(y, "s").where((F.col("of_x") != F.col("of_y")) & _can_link(percent, F.col("n_x"), F.col("n_y"), "left_x", "left_y", F.least))
                   .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "pairs")
    of = [dense.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b")]
    joined = (links_among(docs, pairs, k, percent).join(of[0], "a").join(of[1], "b")
              .select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")))

    rows = (at.where(F.col("rows") > SMALL_REGION).select("s", "id", "left", "component", "main", "blocks", "chunks")
            .join(dense.select("id", "sig"), "id").join(sets, "id"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    payload = ["component", "left", "sig", "items"]
    members = rows.select("s", own("blocks").alias("block"), every("chunks").alias("chunk"), F.lit(False).alias("outside"), *payload)
    outsiders = rows.where("component <> main").select("s", every("blocks").alias("block"), own("chunks").alias("chunk"), F.lit(True).alias("outside"), *payload)
    blocked = members.union(outsiders).groupBy("s", "block", "chunk").applyInArrow(links_out(percent), "a long, b long")
    return joined.union(blocked).distinct()


def links_among(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the stored ``pairs`` that the full sets of ``docs(doc_id, text)`` confirm."""
    ends = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ends")
    # the size of a written table is known: Spark broadcasts it only below its threshold
    sets = stored(shingle_sets_of(docs.withColumnRenamed("doc_id", "id").join(ends, "id", "left_semi"), k)
                  .withColumn("h", F.xxhash64("items")).dropDuplicates(["id", "h"]), "sets")
    x, y = sets.select(F.col("id").alias("a"), F.col("items").alias("x")), sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    return confirmed(pairs.join(x, "a").join(y, "b"), percent)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs(doc_id, text)``.

    Words are runs of non-blank characters with A-Z lower-cased. Documents are
    linked when their sets of distinct ``k``-word shingles have a similarity of
    at least ``percent`` hundredths (fewer words: the whole sequence is the one
    shingle); ``component_id`` is the smallest ``doc_id`` reachable and ``kept``
    marks it.

    Null, empty or blank text: an empty set, linked with nothing. A null
    ``doc_id`` gets a null component and is kept. Repeated rows give repeated
    results. An empty table gives an empty table. Extra columns are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = stored(shingle_rows(docs, k), "shingles")
    named = sigs.where("doc_id is not null and n_shingles > 0")
    classes = stored(named.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("id")), "classes")
    reps = stored(named.join(classes.withColumnRenamed("id", "doc_id"), ["doc_id", "f1", "f2", "n_shingles"], "left_semi")
                  .select(F.col("doc_id").alias("id"), "sig", F.col("n_shingles").alias("n")), "reps")
    pairs = stored(candidate_pairs(stored(tree_rows(reps), "trees")), "pairs")
    parts = connected_components(links_among(docs, pairs, k, percent))
    tagged = stored(reps.join(parts, F.col("id") == F.col("node"), "left")
                    .select("id", "sig", F.coalesce("component", "id").alias("component"), "n"), "tagged")
    of = tagged.select("id", "component").distinct()
    merged = connected_components(closing_links(docs, tagged, k, percent)).select(F.col("node").alias("was"), F.col("component").alias("now"))
    parts = (of.join(merged, of.component == merged.was, "left")
             .select(F.col("id").alias("node"), F.coalesce("now", "component").alias("component")))
    member = stored(classes.join(parts, F.col("id") == F.col("node"), "left")
                    .select("f1", "f2", F.col("n_shingles").alias("n"), F.coalesce("component", "id").alias("component")), "members")
    m = member.select(F.col("f1").alias("m1"), F.col("f2").alias("m2"), "n", "component")
    s = sigs.select("doc_id", "n_shingles", "f1", "f2")
    return (s.join(m, (s.f1 == m.m1) & (s.f2 == m.m2) & (s.n_shingles == m.n) & s.doc_id.isNotNull(), "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def op5_lsh_forest(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=80)


#: Words as in the contract, sets of distinct 4-word shingles, all pairs that share one, and reachability.
OP5_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 3], ' ') END AS sh
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT c FROM n WHERE n.doc_id = a.doc_id) + (SELECT c FROM n WHERE n.doc_id = b.doc_id) - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""
