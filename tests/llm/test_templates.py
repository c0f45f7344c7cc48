import random

import pytest

from kpiforge.llm import templates as M

ITEM = "A train leaves the station at 60 km per hour and a second train follows 30 minutes later at 90 km per hour how far"


@pytest.fixture
def bench(spark):
    def make(*rows):
        return spark.createDataFrame(rows, "item_id long, text string")
    return make


def found(docs, bench, **kw):
    rows = M.benchmark_matches(docs, bench, **kw).select("doc_id", "matches").collect()
    return {r.doc_id: [(m.item_id, m.n_matched, m.n_windows, m.n_changed) for m in r.matches or []] for r in rows}


def test_copy_and_reparameterised_copy(docs, bench):
    other = ITEM.replace("60", "75").replace("30", "20").replace("90", "120")
    rows = [(1, f"Some text before. {ITEM} and after."), (2, f"Other words. {other} end."), (3, "Nothing of the kind is in here at all, it is clean.")]
    got = found(docs(*rows), bench((7, ITEM)))
    (item, matched, windows, changed), = got[1]
    assert item == 7 and matched >= 0.9 * windows and changed == 0
    (item, matched, windows, changed), = got[2]
    assert item == 7 and matched >= 0.9 * windows and changed == 3
    assert got[3] == []
    assert [r.doc_id for r in M.decontaminate(docs(*rows), bench((7, ITEM))).collect()] == [3]


def test_slots_must_be_consistent(docs, bench):
    item = "if there are 5 apples in the box and 5 apples on the table then add 7 more of them now"
    same = item.replace("5", "8")
    broken = item.replace("5", "8", 1)          # one item value, two document values
    merged = item.replace("7", "5")             # two item values, one document value
    got = found(docs((1, same), (2, broken), (3, merged)), bench((1, item)))
    assert got[1] and got[1][0][3] == 1
    assert not got[2] and not got[3]


def test_names_and_units_are_slots(docs, bench):
    item = "yesterday our neighbour Martin walked 12 miles to see his old friend Julia in the big city"
    other = "yesterday our neighbour Pedro walked 15 kilometers to see his old friend Agnes in the big city"
    other = other.replace("kilometers", "km")
    got = found(docs((1, other)), bench((3, item)))
    assert got[1] and got[1][0][3] == 4


def test_exact_windows_against_brute_force(docs, bench):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in "bcdfgklmnprst" for b in ("a", "el", "in", "or", "ust")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(3, 40)))) for i in range(30)]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0:
            piece = items[rng.randrange(30)][1].split()
            cut = piece[:rng.randint(1, len(piece))]
            at = rng.randint(0, len(words))
            words[at:at] = cut
        rows.append((i, " ".join(words)))

    def brute(text):
        w, out = text.split(), []
        for i, t in items:
            v = t.split()
            k = min(len(v), M.WINDOW)
            have = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
            n = sum(tuple(v[j:j + k]) in have for j in range(len(v) - k + 1))
            if n and n >= M.MIN_COVER * (len(v) - k + 1):
                out.append((i, n, len(v) - k + 1, 0))
        return out
    got = found(docs(*rows), bench(*items))
    assert got == {i: brute(t) for i, t in rows}
    # a benchmark in several blocks gives the same
    assert {k: sorted(v) for k, v in found(docs(*rows), bench(*items), block_words=40).items()} == got


def test_nulls_empty_long_ties_repeats_clashes(spark, docs, bench):
    short = "two words"
    rows = [(1, None), (2, ""), (3, "..."), (4, short), (None, ITEM), (5, "x " * 200_000 + ITEM), (6, ITEM), (6, ITEM), (7, "é" * 50_000)]
    table = bench((1, ITEM), (1, ITEM), (2, None), (3, ""), (4, short), (None, ITEM))
    got = M.benchmark_matches(docs(*rows), table).select("doc_id", "matches").collect()
    ids = sorted(((r.doc_id, sorted(m.item_id for m in r.matches)) for r in got if r.matches), key=repr)
    assert ids == [(4, [4]), (5, [1, 1]), (6, [1, 1]), (6, [1, 1]), (None, [1, 1])]
    assert M.benchmark_matches(docs(), table).count() == 0
    assert M.benchmark_matches(docs(*rows), bench()).where("matches is not null").count() == 0
    one = spark.sql(f"select 1L doc_id, '{ITEM}' text, 'a' matches, 'b' item_id, 'c' template")
    row = M.benchmark_matches(one, table).first()
    assert row.item_id == "b" and row.template == "c" and [m.item_id for m in row.matches] == [1, 1]


def test_partial_passages_and_near_copies_count_by_their_longest_run(docs, bench):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(59))
    short = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango"
    equal = "if there are 5 apples in the box and 5 apples on the table then add 7 more of them now"
    clash = "a farmer has 2 cows in the barn behind the old house near the river and 3 goats on the hill above the town"
    rows = [(1, "here: " + " ".join(long.split()[:29]) + " and so on"), (2, short.replace("kilo", "other")),
            (3, equal.replace("5", "8", 1)), (4, clash.replace("2", "5").replace("3", "5")), (5, " ".join(long.split()[:9]) + " no more")]
    items = bench((1, long), (2, short), (3, equal), (4, clash))
    got = found(docs(*rows), items, min_run=M.RUN)
    assert {d: [m[0] for m in v] for d, v in got.items()} == {1: [1], 2: [2], 3: [3], 4: [4], 5: []}
    assert got[1][0][1:] == (22, 52, 0) and got[3][0][3] == 0
    assert [r.doc_id for r in M.decontaminate(docs(*rows), items).collect()] == [5]


def test_longest_run_against_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        words = sorted(rng.sample(range(14), rng.randint(1, 14)))
        pairs = {w: (rng.randrange(3), rng.randrange(3)) for w in words if rng.random() < 0.5}
        best = max((b - a, -a) for a in words for b in range(a + 1, 16) if set(range(a, b)) <= set(words)
                   and M._mapping([pairs[w] for w in range(a, b) if w in pairs]) is not None)
        first, end = M._longest_run(words, pairs)
        assert (end - first, -first) == best


def test_names_that_begin_a_sentence_and_other_case(docs, bench):
    sold = "Natalia sold 48 clips to friends in April. Natalia sold half as many clips in May"
    mid = "yesterday our neighbour Martin walked 12 miles to see his old friend Julia in the city"
    who = "Who wrote the first of these books"
    quoted = 'he said "Martin has 5 dogs" to her'
    rows = [(1, sold.replace("Natalia", "Pedro").replace("48", "50")), (2, mid.lower()), (3, mid.upper()), (4, f"this is the question {who} and more"),
            (5, quoted.replace("Martin", "Julia").replace("5", "7")), (6, f"so {sold.lower()}"), (7, "John and Mary. Then Paul"), (8, "Pedro bought 48 clips")]
    got = found(docs(*rows), bench((1, sold), (2, mid), (3, who), (4, quoted), (5, "Anna and Rome. Who Knows")))
    assert {d: [m[0] for m in v] for d, v in got.items()} == {1: [1], 2: [2], 3: [2], 4: [3], 5: [4], 6: [1], 7: [], 8: []}
    assert got[1][0][1] == got[1][0][2] and got[1][0][3] == 2 and got[2][0][3] == got[3][0][3] == got[6][0][3] == 0
