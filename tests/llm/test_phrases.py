import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from kpiforge.llm import phrases as P


def brute(rows, min_count=30, top=2000, cover=80):
    """Rows (text, lang) -> the contract's rows."""
    out = []
    per: dict = {}
    for text, lang in rows:
        counts, size = per.setdefault(lang or "und", (Counter(), [0]))
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            size[0] += len(ws)
            for k in range(1, 5):
                counts.update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    for lang, (f, (n,)) in per.items():
        found = []
        often = {p: c for p, c in f.items() if c >= min_count}
        for p, a in often.items():
            if len(p) == 1:
                continue
            if any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= cover * a for q, b in often.items()):
                continue
            score, _, left, right = min((int(Fraction(2_000_000 * a, f[p[:k]] + f[p[k:]])), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(3)


def sample(seed, n, vocabulary=12):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "é", "Word", "WORD"]
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for _ in range(n):
        ws = rng.choice(words, int(rng.integers(0, 60)), p=weights / weights.sum())
        text = "".join(w + str(rng.choice([" ", "  ", "\t", ", ", ".", "\n", " \x0b"], p=[.7, .1, .1, .04, .03, .02, .01])) for w in ws)
        rows.append((text, str(rng.choice(["en", "de"]))))
    return rows


@pytest.mark.parametrize("budget", [1 << 20, 300, 60])
def test_equals_brute_force_for_any_budget(spark, budget):
    rows = sample(1, 250)
    got = result(P.collocations(table(spark, rows), min_count=5, budget=budget))
    assert got == brute(rows, 5) and any(r[2].count(" ") == 3 for r in got)


def test_other_seed_top_and_cover(spark):
    rows = sample(2, 120, 5)
    assert result(P.collocations(table(spark, rows), min_count=4, top=7, cover=50, seed=3)) == brute(rows, 4, 7, 50)


def test_covered_phrases_and_overlaps(spark):
    rows = [("a a a a a. x Y z q", "en")] * 10 + [("x y z", "en")] * 2 + [("x y", "en")] * 10
    assert result(P.collocations(table(spark, rows), min_count=5)) == brute(rows, 5)


def test_nulls_empties_and_repeats(spark):
    rows = [(None, "en"), ("", "en"), (" \t.", "en"), (None, None), ("one two", None), ("one two", "und"), ("One\ttwo!", None)] * 2
    assert result(P.collocations(table(spark, rows), min_count=3)) == brute(rows, 3) != []


def test_no_candidates_and_empty_table(spark, docs):
    assert result(P.collocations(table(spark, [("a b c", "en")]))) == []
    assert result(P.collocations(docs())) == []


def test_very_long_texts(spark):
    rows = [("z" * 300_000, "en"), ("tick tock " * 30_000, "en"), ("many words " * 40, "de")]
    assert result(P.collocations(table(spark, rows))) == brute(rows)


def test_clashing_columns(spark):
    df = spark.sql("select explode(array_repeat('a b', 31)) text, 'en' lang, 1 h1, 2 f, 'x' phrase, 3 n, 4 word")
    assert [tuple(r) for r in P.collocations(df).collect()] == [("en", 1, "a b", 31, 31, 31, 62, 1_000_000)]


def test_counts_are_exact_beyond_64_bits(spark):
    """Products of counts this large pass 64 bits."""
    big = 7_000_000_000_000_000
    rows = [(1, 0, 0, 0, big + 1), (2, 0, 0, 0, big + 3), (1, 2, 0, 0, big)]
    got = P.scored(spark.createDataFrame(rows, "h1 long, h2 long, h3 long, h4 long, f long"), 80).first()
    assert got.score == 2_000_000 * big // (2 * big + 4)


def test_packing_fills_groups_up_to_the_budget(spark):
    rng = np.random.default_rng(0)
    rows = [(int(a), int(b), int(f)) for a, b, f in zip(rng.integers(-2**63, 2**63, 500), rng.integers(-2**63, 2**63, 500), rng.integers(30, 90, 500), strict=True)]
    rows.append((5, 6, 100_000))
    pairs = spark.createDataFrame(rows, "h1 long, h2 long, f long")
    group, n, over = P.packed_groups(pairs, 1000)
    assert len(over) == 1 and (np.diff(group) >= 0).all() and n == group[-1] + 1
    load = Counter()
    for a, b, f in rows[:-1]:
        h = P.pair_hash(np.array([a]).view(np.uint64), np.array([b]).view(np.uint64))
        load[int(group[int(h[0] >> np.uint64(48))])] += f
    assert max(load.values()) < 1000 + 200
