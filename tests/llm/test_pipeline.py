"""The pipeline's stages against brute force, each on its own input."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline as C
from kpiforge.llm import toxicity
from llm.test_forest import brute as brute_components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows before, rows after) of every stage on the whole documents."""
    from kpiforge.llm.common import stored
    rows, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in C.STAGES:
        after = stored(stage(spark, rows, SF), name)
        out.append((name, rows, after))
        rows = after
    return {n: (a, b) for n, a, b in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_toxicity_stage_removes_what_the_grammar_rejects(spark, stages):
    before, after = stages["toxicity"]
    assert after.columns == before.columns
    grammar = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(after) == sorted(r.doc_id for r in before.collect() if grammar.score(r.text) < toxicity.THRESHOLD)
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = set(ids(before)) - toxic
    assert len(clean - set(ids(after))) <= 0.08 * len(clean)  # unlabelled toxic rows are among these


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    assert after.columns == before.columns
    rows = [(r.doc_id, r.text) for r in before.collect()]
    from llm.test_forest import set_of
    every = [(i, set_of(t, 5)) for i, t in rows]
    holders = defaultdict(list)
    for i, s in every:
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for v in holders.values():
        for x in range(len(v)):
            for y in range(x):
                shared[v[y], v[x]] += 1
    size = {i: len(s) for i, s in every}
    up = {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (size[a] + size[b] - n):
            p, q = sorted((root(a), root(b)))
            up[q] = p
    assert ids(after) == sorted(i for i, _ in rows if root(i) == i)


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    assert after.columns == before.columns
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    planted = {r.doc_id for r in before.collect() if any(t in (r.text or "") for t in items)}
    gone = set(ids(before)) - set(ids(after))
    assert planted and gone == planted


def test_mixing_stage_keeps_all_rows(stages):
    before, after = stages["mixing"]
    assert after.columns == before.columns
    assert sorted(map(repr, before.collect())) == sorted(map(repr, after.collect()))


def test_sharding_stage(stages):
    before, after = stages["sharding"]
    assert ids(after) == ids(before)
    n = [r["count"] for r in after.groupBy("shard").count().collect()]
    assert len(n) == C.N_SHARDS and max(n) - min(n) <= 1


def test_run_equals_the_stages(spark, stages):
    assert ids(C.run(spark, SF)) == ids(stages["sharding"][1])


def messy(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:30] + [f"x{rng.randrange(9)}"] + base[31:]), "en", None if i % 2 else "s", 1, f"e{i}", 1, "k") for i in range(12)]
    rows += [(None, None, None, None, None, None, None, None)] * 2 + [(50, "", None, "s", 0, "a", 2, "q"), (51, "z" * 200_000, "de", "t", 0, "b", 3, "p")]
    rows += [(60, "one and the same", "en", "s", 1, "c", 4, "r")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string, position int, matches string")


def test_messy_rows_and_clashing_columns(spark):
    rows = messy(spark)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, rows, SF)
        assert out.columns == rows.columns
        assert sum(r.doc_id is None for r in out.collect()) == 2, name
        rows = out
    kept = [r.doc_id for r in rows.collect() if r.doc_id is not None]
    assert sorted(kept) == sorted([min(i for i, _, c, _ in brute_components([(r.doc_id, r.text) for r in messy(spark).collect()], 5) if c == 0), 50, 51, 60, 60])
    assert C.STAGES[-1][1](spark, rows, SF).count() == rows.count()


def test_empty_documents(spark):
    rows = messy(spark).limit(0)
    for _, stage in C.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        assert rows.count() == 0
    assert C.STAGES[-1][1](spark, rows, SF).count() == 0


def test_the_slots_of_each_shard_follow_the_target_weights(spark, monkeypatch):
    monkeypatch.setattr(C, "N_SHARDS", 3)
    counts = {"a": 9000, "b": 2250, None: 750}
    rows = [(f"{s}{i}", s) for s, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    got = C.STAGES[-1][1](spark, docs, SF).collect()
    total = sum(n ** 0.5 for n in counts.values())
    for shard in range(3):
        order = [rows[r.doc_id][1] for r in sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)]
        assert len(order) == 4000
        done = dict.fromkeys(counts, 0)
        for t, s in enumerate(order[:1000], 1):
            done[s] += 1
            if t % 32 == 0:
                assert all(abs(done[k] - t * counts[k] ** 0.5 / total) <= 32 for k in counts)


def test_documents_with_a_long_line_in_common_come_to_one_shard(spark, tmp_path):
    """Unequal texts, as the near-duplicate stage leaves them; lines differ in case and blanks."""
    line = "the line number {} of these documents is a long one".format
    rows = [(i, f"own {i}\n{line(i % 300)}" if i < 300 else f" {line(i % 300).upper()} \nother {i}\nshort", "s") for i in range(600)]
    rows += [(i, f"text {i}\nshort" if i % 2 else None, "t") for i in range(600, 1800)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/mixed")
    for docs in (spark.read.parquet(f"{tmp_path}/mixed"), spark.createDataFrame(rows, "doc_id long, text string, source string")):
        got = {r.doc_id: r.shard for r in C.STAGES[-1][1](spark, docs, SF).collect()}
        assert sum(got[i] == got[i + 300] for i in range(300)) >= 300 - 2 * C.N_SHARDS  # without links a pair meets by chance
        assert {list(got.values()).count(k) for k in range(C.N_SHARDS)} == {75}


def test_sharding_keeps_the_order_of_the_mix(spark, tmp_path):
    """The mix of two kinds of rows is read from the files as it was written."""
    counts = {"a": 1800, "b": 600}
    rows = [(i, f"{s}{i}", s) for s, n in counts.items() for i in range(n * 10, n * 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    C.mix_sources(spark, docs, SF).write.parquet(f"{tmp_path}/mixed")
    files = sorted(tmp_path.glob("mixed/part-*"))
    order = [r.doc_id for f in files for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    at = {d: p for p, d in enumerate(order)}
    got = C.shard(spark, spark.read.parquet(f"{tmp_path}/mixed"), SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(at)
    source = {i: s for i, _, s in rows}
    for shard in range(C.N_SHARDS):
        mine = [r.doc_id for r in sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)]
        assert len(mine) == 100 and mine == sorted(mine, key=at.get)
        for t in range(1, 100):  # as even as the mix itself
            assert abs(sum(source[d] == "a" for d in mine[:t]) - sum(source[d] == "a" for d in order[:t * C.N_SHARDS]) / C.N_SHARDS) <= 4
    assert sorted(r.slot for r in got if r.shard == 0) == list(range(100))
    spark.read.parquet(f"{tmp_path}/mixed").orderBy("doc_id").write.parquet(f"{tmp_path}/turned")
    other = {r.doc_id: (r.shard, r.slot) for r in C.shard(spark, spark.read.parquet(f"{tmp_path}/turned"), SF).collect()}
    assert other != {r.doc_id: (r.shard, r.slot) for r in got}
