import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kpiforge.llm import mixing, sharding

SF = "/root/testdata/sf0.01"


def check_rows_law(rows, n_shards, n):
    by = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(n_shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sizes_slots_and_groups_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.balanced_shards(docs).collect()
    check_rows_law(rows, 24, docs.count())
    texts = {r.doc_id: r.text for r in docs.collect()}
    groups = defaultdict(set)
    for r in rows:
        b = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(b) + 8, zlib.crc32(b))
        groups[texts[r.doc_id]].add(r.shard)
    assert all(len(v) == 1 for v in groups.values())


def test_a_group_larger_than_a_shard_fills_whole_shards(docs):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(800)]
    got = sharding.balanced_shards(docs(*rows), 12).collect()
    check_rows_law(got, 12, 1200)
    assert len({r.shard for r in got if r.doc_id < 400}) <= 6  # 4 at best, 12 without links


def test_links_bring_documents_together(spark, docs):
    rows = [(i, f"text {i}") for i in range(300)]
    links = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 3 != 2 and i < 299], "a long, b long")
    got = {r.doc_id: r.shard for r in sharding.balanced_shards(docs(*rows), 5, links=links, rounds=6).collect()}
    def cut(s): return sum(s[r.a] != s[r.b] for r in links.collect())
    alone = {r.doc_id: r.shard for r in sharding.balanced_shards(docs(*rows), 5).collect()}
    assert cut(got) < 0.5 * cut(alone)
    assert max(Counter(got.values()).values()) - min(Counter(got.values()).values()) <= 1


def test_propagation_without_a_number_of_rounds_ends_where_no_row_wants_to_move(spark):
    members = spark.createDataFrame([(r, f"h{h}") for h in range(200) for r in (2 * h, 2 * h + 1, 2 * h + 2)], "row long, hub string")
    label = {r.row: r.label for r in sharding.propagate_labels(members, 2, 400, rounds=None).collect()}
    three = {r.row: r.label for r in sharding.propagate_labels(members, 2, 400).collect()}
    def cut(x): return sum(len({x[2 * h], x[2 * h + 1], x[2 * h + 2]}) > 1 for h in range(200))
    assert len(label) == 401 and cut(label) <= cut(three)


@pytest.mark.parametrize("n", [0, 1, 5, 24, 49])
def test_few_rows_nulls_repeats(docs, n):
    rows = [((None if i % 5 == 0 else i // 2), (None if i % 3 == 0 else "" if i % 3 == 1 else f"t{i // 6}")) for i in range(n)]
    got = sharding.balanced_shards(docs(*rows)).collect()
    check_rows_law(got, 24, n)
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((i, len(t or "") + 8) for i, t in rows if i is not None)


def test_very_long_text_and_clashing_columns(spark):
    one = spark.sql("select 1L doc_id, repeat('é', 300000) text, 'a' shard, 'b' slot, 'c' hub, 'd' row, 'e' label")
    r = sharding.balanced_shards(one).first()
    assert (r.size, r.shard, r.slot) == (600008, 0, 0)


@pytest.mark.parametrize("weights", [[5, 3, 2], [1] * 7, [100, 1, 1], list(range(1, 40)), [0.3, 0.7], [1]])
def test_every_prefix_of_a_period_is_within_a_block(weights):
    shares = mixing.period_shares(weights)
    order = mixing.one_period(shares)
    assert sum(shares) == len(order) and min(shares) >= 1
    t = np.arange(1, len(order) + 1)
    for k, a in enumerate(shares):
        done = np.cumsum(order == k)
        assert np.abs(done - a * t / len(order)).max() < 1
    assert Counter(order.tolist()) == Counter(dict(enumerate(shares)))


def brute_schedule(blocks, weights, period):
    """Slot by slot, with whole-number release times and deadlines."""
    left, out = list(blocks), []
    while any(left):
        alive = [i for i, n in enumerate(left) if n]
        shares = mixing.period_shares([weights[i] for i in alive], period)
        size, done, t = sum(shares), Counter(), 0
        while all(left[i] for i in alive):
            ready = [(-(-(done[k] + 1) * size // a), -a, k) for k, a in enumerate(shares) if done[k] * size // a <= t]
            k = min(ready)[2]
            done[k] += 1
            left[alive[k]] -= 1
            out.append(alive[k])
            t += 1
    return out


def test_positions_equal_the_brute_force_schedule(docs):
    counts = {"a": 700, "b": 90, None: 41, "d": 33, "e": 1}
    rows, i = [], 0
    for s, n in counts.items():
        for _ in range(n):
            rows.append((i, f"t{i}", "en", s))
            i += 1
    got = mixing.mixed(docs(*rows).select("doc_id", "source"), block=8, period=64).collect()
    assert sorted(r.position for r in got) == list(range(i))
    names = sorted(counts, key=lambda s: (s is not None, s or ""))
    blocks = [-(-counts[s] // 8) for s in names]
    want = brute_schedule(blocks, [counts[s] ** 0.5 for s in names], 64)
    by_slot = {r.slot: r.source for r in got}
    assert [by_slot[t] for t in range(len(want))] == [names[k] for k in want]
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert [r.slot for r in sorted(got, key=lambda r: r.position)] == sorted(r.slot for r in got)
    sizes = Counter(r.slot for r in got)
    assert set(sizes.values()) <= {8, 700 % 8 or 8, 90 % 8, 41 % 8, 33 % 8, 1}


def test_given_weights_hold_while_all_sources_last(docs):
    rows = [(i, "t", "en", "a" if i % 2 else "b") for i in range(4000)]
    got = mixing.mixed(docs(*rows).select("doc_id", "source"), weights={"a": 3, "b": 1}, block=10).collect()
    first = [r.source for r in sorted(got, key=lambda r: r.position)][:2000]
    assert abs(first.count("a") - 1500) <= 10


def test_mixing_keeps_rows_and_columns(spark, docs):
    rows = [(i % 7 if i % 4 else None, None if i % 3 else "x" * 100_000, "en", "s" if i % 2 else None) for i in range(60)]
    frame = docs(*rows)
    out = mixing.in_mixed_order(frame)
    assert out.columns == frame.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, frame.collect()))
    empty = mixing.mixed(docs())
    assert empty.count() == 0 and {"slot", "position", "block", "phase", "release", "deadline"} <= set(empty.columns)
    clash = spark.sql("select 1L doc_id, 's' source, 'mine' slot, 'p' position, 'q' a, 'r' n")
    r = mixing.mixed(clash).first()
    assert (r.slot, r.position, r.a, r.n) == (0, 0, "q", "r")


SKEWED = {"half of 10": [0.5] + [0.5 / 9] * 9, "half of 500": [499] + [1] * 499, "half of 600": [599] + [1] * 599,
          "many, skewed": [1 + i % 3 for i in range(700)], "one in 5000": [4999, 1]}


@pytest.mark.parametrize("weights", SKEWED.values(), ids=SKEWED.keys())
def test_every_prefix_is_within_a_block_of_the_given_weights(weights):
    turn, n = [], 20_000
    for row in mixing.schedule([n] * len(weights), weights):
        turn.append(row[0])
        if len(turn) == n:
            break
    turn, t = np.array(turn), np.arange(1, n + 1)
    for k, w in enumerate(weights):
        assert np.abs(np.cumsum(turn == k) - w / sum(weights) * t).max() < 1 + 1e-9


def test_mixed_rows_follow_skewed_weights(docs):
    rows = [(i, "t", "en", f"s{i % 10}" if i % 2 else "s0") for i in range(12_000)]
    weights = {f"s{k}": 0.5 if k == 0 else 0.5 / 9 for k in range(10)}
    got = mixing.mixed(docs(*rows).select("doc_id", "source"), weights=weights, block=4).where("phase = 0").collect()
    turn = [s for _, s in sorted({(r.slot, r.source) for r in got})]
    assert len(turn) > 1500
    t = np.arange(1, len(turn) + 1)
    for s, w in weights.items():
        if any(r.source == s for r in got):
            have = {r.source for r in got}
            share = w / sum(weights[x] for x in have)
            assert np.abs(np.cumsum(np.array(turn) == s) - share * t).max() < 1 + 1e-9


def test_zero_weights_come_last_and_bad_ones_fail():
    assert [r[0] for r in mixing.schedule([2, 2, 1], [1, 0, 0])] == [0, 0, 1, 2, 1]
    with pytest.raises(ValueError):
        list(mixing.schedule([1, 1], [1, -1]))


def test_small_groups_stay_whole_beside_a_hot_group(spark):
    rows = spark.range(12_000).selectExpr("id doc_id", "if(id < 4000, 'the same text', concat('text ', id div 4)) text")
    got = sharding.balanced_shards(rows, 24).collect()
    check_rows_law(got, 24, 12_000)
    groups = defaultdict(set)
    for r in got:
        groups[r.doc_id // 4 if r.doc_id >= 4000 else -1].add(r.shard)
    assert sum(len(v) > 1 for g, v in groups.items() if g >= 0) < 2 * 24
