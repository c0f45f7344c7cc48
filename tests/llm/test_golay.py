import numpy as np
import pytest
import xxhash

from kpiforge.llm import golay as G
from tests.llm.conftest import SF


def brute_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def brute(rows, k=4):
    """Rows (doc_id, text) -> sorted (doc_id, fingerprint, component)."""
    fps = [brute_fingerprint(t, k) for _, t in rows]
    return [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, components([i for i, _ in rows], fps), strict=True)]


def components(ids, fps):
    x = np.array(fps, np.uint64)
    part = np.arange(len(x))
    for a in range(len(x)):
        if ids[a] is None:
            continue
        for b in np.flatnonzero(np.bitwise_count(x ^ x[a]) <= 4):
            if ids[b] is not None and part[b] != part[a]:
                part[part == part[b]] = part[a]
    least = {}
    for i, p in zip(ids, part, strict=True):
        if i is not None:
            least[p] = min(least.get(p, i), i)
    return [None if i is None else least[p] for i, p in zip(ids, part, strict=True)]


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_code_is_perfect():
    check, near, other = G.code_tables()
    weights = np.bitwise_count(near.astype(np.uint32))
    assert (np.bincount(weights) == [1, 23, 253, 1771]).all()
    assert ((other[:, 0] >= 0) == (weights == 3)).all()
    words = np.arange(1 << 12) << 11 | check
    assert set(np.bitwise_count(words.astype(np.uint32)).tolist()) == {0, 7, 8, 11, 12, 15, 16, 23}


@pytest.mark.parametrize("flips", [0, 1, 2])
def test_segments_within_two_bits_share_a_key(flips):
    rng = np.random.default_rng(flips)
    x = rng.integers(0, 1 << 23, 20000)
    y = x.copy()
    for bits in rng.permuted(np.tile(np.arange(23), (len(x), 1)), axis=1)[:, :flips].T:
        y ^= 1 << bits
    a, b = G.segment_keys(x), G.segment_keys(y)
    assert ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2)).all()


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    y = x.copy()
    for bits in rng.permuted(np.tile(np.arange(64, dtype=np.uint64), (len(x), 1)), axis=1)[:, :4].T:
        y ^= np.uint64(1) << bits
    (ka, ia), (kb, ib) = G.keys_of(x.view(np.int64)), G.keys_of(y.view(np.int64))
    mine = set(zip(ka.tolist(), ia.tolist(), strict=True))
    assert len(mine) == len(ka)
    met = {i for k, i in zip(kb.tolist(), ib.tolist(), strict=True) if (k, i) in mine}
    assert len(met) == len(x)


def near(rng, base, n, bits):
    out = np.full(n, base, np.uint64)
    for b in rng.integers(0, 64, (bits, n)).astype(np.uint64):
        out ^= np.uint64(1) << b
    return out


@pytest.mark.parametrize("most_rows", [3, 40, 8192])
def test_links_equal_brute_force_for_any_run_limit(spark, most_rows):
    rng = np.random.default_rng(11)
    fps = [near(rng, base, 60, bits) for bits in (2, 5, 9) for base in rng.integers(0, 1 << 63, 2, dtype=np.uint64)]
    fps = np.unique(np.concatenate([*fps, rng.integers(0, 1 << 63, 200, dtype=np.uint64)]))
    from kpiforge.llm.components import connected_components

    table = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long").repartition(3)
    links = G.fingerprint_links(table, most_rows)
    for a, b in links.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    got = {r.node: r.component for r in connected_components(links).collect()}
    want = components(fps.view(np.int64).tolist(), fps)
    assert [got.get(int(f), int(f)) for f in fps.view(np.int64)] == want


def test_documents_equal_brute_force(spark, docs):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(40):
        base = rng.choice(words, int(rng.integers(1, 400))).tolist()
        for _ in range(int(rng.integers(1, 4))):
            text = list(base)
            text[int(rng.integers(0, len(text)))] = "Other"
            rows.append((len(rows) + 1, " ".join(text)))
    assert result(G.near_duplicates(docs(*rows), k=4)) == sorted(brute(rows), key=repr)


def test_nulls_empties_repeats_and_blanks(spark, docs):
    rows = [(5, None), (2, ""), (9, " \t\n"), (None, "a b c d"), (None, None), (7, "A b C d"), (7, "A b C d"), (8, "a\tb\x0bc\x0cd"),
            (11, "one"), (12, "ONE"), (13, "é É"), (14, "É é"), (3, "x y z")]
    assert result(G.near_duplicates(docs(*rows), k=4)) == sorted(brute(rows), key=repr)


def test_very_long_text_and_empty_table(spark, docs):
    rows = [(1, "z" * 300_000), (2, "word " * 100_000), (3, "word " * 100_000 + "more")]
    assert result(G.near_duplicates(docs(*rows), k=4)) == sorted(brute(rows), key=repr)
    assert G.near_duplicates(docs(), k=4).count() == 0


def test_clashing_columns(spark):
    df = spark.sql("select 1L doc_id, 'a' text, 'x' fp, 'y' key, 'z' component, 'n' node, 'c' component_id")
    assert result(G.near_duplicates(df)) == [(1, f"{brute_fingerprint('a'):016x}", 1)]


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(G.op11_golay_simhash(spark, SF)) == sorted(brute(rows), key=repr)
