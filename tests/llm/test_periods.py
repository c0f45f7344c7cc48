import hashlib
import itertools
import zlib

import numpy as np
import pytest

from kpiforge.llm import periods as P
from tests.llm.conftest import SF


def brute_runs(w, repeats=4, least=6):
    out = []
    n = len(w)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            s, size = i, e + q - i
            i = e
            if size >= max(least, repeats * q) and not any(all(w[t] == w[t + p] for t in range(s, s + size - p)) for p in range(1, q)):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(i, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    kept = [w for t, w in enumerate(words) if not any(s + q <= t < s + size for s, size, q in runs)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *head, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(" ".join(kept)))


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def result(df):
    return sorted((tuple(r[c] for c in NAMES) for r in df.collect()), key=repr)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_groups_are_the_longest_lyndon_prefixes():
    def lyndon(w):
        return all(w < w[t:] for t in range(1, len(w)))
    for n in range(1, 8):
        for x in itertools.product(range(3), repeat=n):
            length, group = P.lyndon_groups(list(x))
            assert length == [max(e for e in range(1, n - i + 1) if lyndon(x[i:i + e])) for i in range(n)]
            for i, j in itertools.combinations(range(n), 2):
                assert (group[i] == group[j]) == (x[i:i + length[i]] == x[j:j + length[j]])


def texts(seed, n):
    """Random texts with runs of all kinds planted, some within others."""
    rng = np.random.default_rng(seed)
    for _ in range(n):
        x = rng.integers(0, rng.integers(1, 4), rng.integers(0, 12)).tolist()
        for _ in range(int(rng.integers(0, 4))):
            root = rng.integers(0, 3, rng.integers(1, 9)).tolist() * int(rng.integers(1, 4))
            x += (root * 7)[:int(rng.integers(1, 7 * len(root)))] + rng.integers(0, 40, rng.integers(0, 9)).tolist()
        yield [f"w{v}" for v in x]


@pytest.mark.parametrize("seed", range(3))
def test_runs_equal_brute_force(seed):
    for words in texts(seed, 150):
        x = P._as_numbers(words)
        assert P.runs_of(x) == brute_runs(words)
        assert P.runs_of(x, repeats=2, least=2) == brute_runs(words, 2, 2)


def test_zones_hold_every_run():
    for seed in range(3, 9):
        sample = list(texts(seed, 60))
        first = np.cumsum([0, *map(len, sample)])
        x = P._as_numbers([w for t in sample for w in t])
        starts, ends = P.zones(x, first)
        assert (starts < ends).all() and (ends[:-1] <= starts[1:]).all()
        for d, words in enumerate(sample):
            for s, size, _ in brute_runs(words):
                z = np.searchsorted(starts, first[d] + s, "right") - 1
                assert starts[z] <= first[d] + s and first[d] + s + size <= ends[z] and first[d] <= starts[z] and ends[z] <= first[d + 1]


def test_table_equals_brute_force(spark, docs):
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(20, 120))]
    rows += [(500, None), (501, ""), (502, " \n\t "), (None, "a " * 9), (None, None), (503, "a " * 9), (503, "a " * 9),
             (504, "A a " * 4), (505, "a\x0bb\x0ca\rb a b a b\ta b"), (506, "é " * 6), (507, "x y z " * 3 + "x y"), (508, "x y z " * 4)]
    got = P.periodic_runs(docs(*rows))
    assert result(got) == sorted((brute_row(i, split(t)) for i, t in rows), key=repr)
    one = got.where("doc_id = 508").first()
    assert one.collapsed == "x y z" and [tuple(r) for r in one.runs] == [(0, 12, 3)] and one.n_words == 12


def test_very_long_texts(spark, docs):
    unit = " ".join(f"w{i}" for i in range(30_000))
    r = P.periodic_runs(docs((1, f"{unit} " * 5 + "end"), (2, "a " * 200_000), (3, "z" * 300_000))).orderBy("doc_id").collect()
    assert [(x.n_runs, x.start, x.length, x.period) for x in r] == [(1, 0, 150_000, 30_000), (1, 0, 200_000, 1), (0, None, None, None)]


def test_empty_table_and_clashing_columns(spark, docs):
    assert P.periodic_runs(docs()).count() == 0
    r = P.periodic_runs(spark.sql("select 1L doc_id, 'a a a a a a' text, 'x' runs, 'y' start, 'z' length")).first()
    assert (r.n_runs, r.start, r.length, r.period) == (1, 0, 6, 1)


def test_query_equals_brute_force_on_short_documents(spark):
    """The whole query; documents of over 1,500 words are compared by the SQL test."""
    want = []
    for i, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w = split(text)
        if len(w) > 1500:
            continue
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            a = (h // 10) % len(w)
            p = 1 + (len(w) - a) // (3 + (h // 10) % 8)
            w = [w[t] if t < a else w[a + (t - a) % p] for t in range(len(w))]
        want.append(brute_row(i, w))
    got = {r[0]: r for r in result(P.op13_baier_runs(spark, SF))}
    assert [got[r[0]] for r in want] == want
