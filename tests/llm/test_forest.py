import random

import numpy as np

from kpiforge.llm import forest, tokens
from kpiforge.llm.components import connected_components


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def set_of(text, k):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent=80):
    sets = [(i, set_of(t, k)) for i, t in rows]
    ids = sorted({i for i, _ in rows if i is not None})
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (a, s) in enumerate(sets):
        for b, t in sets[:x]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return [(i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets]


def check(docs, rows, k=4):
    got = forest.near_duplicates(docs(*rows), k=k)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, k), key=repr)


def corpus(n, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows = []
    while len(rows) < n:
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        for _ in range(rng.choice([1, 1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 7, " ".join(copy)))
    rng.shuffle(rows)
    return rows


def test_links_equal_brute_force(spark, docs):
    check(docs, corpus(160))
    check(docs, corpus(120, seed=2), k=5)


def test_edges_of_the_contract(spark, docs):
    rows = [(5, "a b c"), (2, "A\tB\x0bC"), (9, "a b c d"), (11, None), (12, ""), (13, " \n\t "), (14, "one"), (4, "ONE"),
            (20, "ä b c d e"), (21, "Ä b c d e"), (None, "a b c"), (None, None), (9, "a b c d"), (30, "x y z a b")]
    check(docs, rows)


def test_chain_and_large_group_of_near_copies(spark, docs):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        copy = list(base)
        copy[rng.randrange(80)] = f"x{i}"
        rows.append((1000 - i, " ".join(copy)))
    got = forest.near_duplicates(docs(*rows), k=4).collect()
    want = brute(rows, 4)
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((w[0], w[2]) for w in want)


def test_very_long_text(spark, docs):
    rng = random.Random(9)
    long = [f"v{rng.randrange(10 ** 6)}" for _ in range(60_000)]
    other = list(long)
    other[500:900] = [f"q{i}" for i in range(400)]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, "x" * 300_000)]
    got = {r.doc_id: r.component_id for r in forest.near_duplicates(docs(*rows), k=4).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_empty_table_and_extra_columns(spark, docs):
    assert forest.near_duplicates(docs()).count() == 0
    one = spark.sql("select 3L doc_id, 'a b c d e f' text, 1 n_shingles, 2 component_id, 3 f1, 4 kept, 5 id, 6 sig")
    assert [tuple(r) for r in forest.near_duplicates(one, k=5).collect()] == [(3, 2, 3, True)]


def test_word_hashes_do_not_depend_on_position():
    def hashes(text):
        raw = text.encode()
        return tokens.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[2].tolist()
    assert hashes("alpha beta")[1] == hashes("x y z Beta q")[3] == hashes("BETA")[0]
    assert len({*hashes("a b c aa ab ba")}) == 6


def test_neighbours_in_a_dense_region_keep_the_deepest_prefixes():
    rng = np.random.default_rng(0)
    path = np.tile(rng.integers(0, 9, forest.DEPTH), (100, 1))
    path[:, forest.DEPTH - 4:] = rng.integers(0, 9, (100, 4))
    path = path[np.lexsort(path.T[::-1])].astype(">u2")
    a, b = forest.neighbour_pairs(np.zeros(100, int), path, np.arange(100))
    assert len(a) <= 100 * forest.REACH and (a < b).all() and {*a, *b} == set(range(100))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 450)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 450: 400, 500: 400}
    assert connected_components(edges.limit(0)).count() == 0


def test_dense_regions_are_closed(spark, docs):
    """One region of 120 rows in three given components: the pairs of
    components with a link between them come out, each once."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=200)
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.randint(1, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    part = [0 if i < 90 else i if i < 100 else i % 2 + 200 for i in range(120)]
    parts = spark.createDataFrame([(i, p) for i, p in enumerate(part)], "id long, component long")
    reps = forest.shingle_rows(docs(*rows), 4).selectExpr("doc_id as id", "sig", "n_shingles as n").join(parts, "id")
    got = [tuple(r) for r in forest.closing_links(docs(*rows), reps, 4, 96).collect()]
    sets = [set_of(t, 4) for _, t in rows]
    want = {tuple(sorted((part[a], part[b]))) for b in range(120) for a in range(b)
            if part[a] != part[b] and 100 * len(sets[a] & sets[b]) >= 96 * len(sets[a] | sets[b])}
    everything = {tuple(sorted((p, q))) for p in part for q in part if p != q}
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < len(everything)


def test_components_of_long_paths(spark):
    n = 300
    order = random.Random(3).sample(range(n), n)
    edges = spark.createDataFrame(list(zip(order[:-1], order[1:], strict=True)) + [(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def templated(n, shared, own, seed=6):
    """Texts with ``shared`` words in common and ``own`` of their own."""
    rng = random.Random(seed)
    head = [f"t{i}" for i in range(shared)]
    return [(i, " ".join(head + [f"o{rng.randrange(10 ** 9)}" for _ in range(own)])) for i in range(n)]


def test_templated_pages_equal_brute_force(spark, docs):
    """One dense region: pages far from each other, pages near the limit, and near copies of some."""
    rng = random.Random(7)
    rows = templated(500, 60, 22) + [(i + 1000, t) for i, t in templated(150, 68, 10, 8)]
    for i, t in rng.sample(rows, 60):
        w = t.split()
        w[rng.randrange(len(w))] = f"z{i}"
        rows.append((i + 5000, " ".join(w)))
    check(docs, rows)


def test_rows_that_only_share_a_template_do_not_meet(spark, docs):
    sets = forest.shingle_sets_of(docs(*templated(300, 60, 22)).withColumnRenamed("doc_id", "id"), 4)
    assert forest.prefix_shingles(sets, 80).count() == 0
    near = forest.prefix_shingles(forest.shingle_sets_of(docs(*templated(40, 60, 4)).withColumnRenamed("doc_id", "id"), 4), 80)
    assert {r.s for r in near.collect()} and near.select("id").distinct().count() == 40


def test_frequent_prefix_shingles_are_compared_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 2000)
    rows = templated(90, 50, 9)
    for i, t in templated(90, 50, 9)[:20]:
        rows.append((i + 500, t + " end"))
    parts = spark.createDataFrame([(i, i) for i, _ in rows], "id long, component long")
    reps = forest.shingle_rows(docs(*rows), 4).selectExpr("doc_id as id", "sig", "n_shingles as n").join(parts, "id")
    got = {tuple(r) for r in forest.closing_links(docs(*rows), reps, 4, 80).collect()}
    sets = {i: set_of(t, 4) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert got == want and len(want) >= 20


def test_the_least_agreement_of_a_link():
    assert 68 <= forest.least_agreement(80) <= 76 and forest.least_agreement(100) == 128


def test_no_row_is_made_of_a_shingle_outside_the_prefixes(spark, docs, monkeypatch):
    made = []
    monkeypatch.setattr(forest, "stored", lambda df, label, keep=forest.stored: made.append(keep(df, label)) or made[-1])
    rows = templated(60, 200, 4)
    sets = forest.shingle_sets_of(docs(*rows).withColumnRenamed("doc_id", "id"), 4)
    got = {(r.id, r.s) for r in forest.prefix_shingles(sets, 80).collect()}
    n = [len(set_of(t, 4)) for _, t in rows]
    assert made and max(df.count() for df in made) <= sum(x - -(-x * 80 // 100) + 1 for x in n) < sum(n) / 3
    held = {i: {s for j, s in got if j == i} for i, _ in rows}
    assert all(held[a] & held[b] for a in held for b in held)
