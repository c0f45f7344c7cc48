import random

import pytest

from kpiforge.llm import toxicity as X
from kpiforge.llm.common import is_held_out
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def grammar():
    rng = random.Random(5)
    fill = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("ara", "elo", "inu", "ost", "ume", "ird", "anto")]
    def text(*extra):
        w = rng.choices(fill, k=40)
        for e in extra:
            w.insert(rng.randrange(len(w)), e)
        return " ".join(w) + "."
    rows = [(text(), 0) for _ in range(300)]
    rows += [(text(rng.choice(["snarp", "glimwad"])), 1) for _ in range(100)]
    rows += [(text("zorkel" + rng.choice(["a", "en", "ist", "ung", "o", "eur"])), 1) for _ in range(60)]
    rows += [(f"he said {w} about it. " + text(), 0) for w in ("snarp", "glimwad") for _ in range(6)]
    rows += [(f"this is not snarp. " + text(), 0) for _ in range(6)]
    return X.learn(rows)


def test_words_and_stems_are_learned(grammar):
    assert grammar.weight("snarp") > 3 and grammar.weight("glimwad") > 3
    assert all(grammar.weight("zorkel" + e) > 3 for e in ("a", "ist", "never-seen"[:5]))
    assert grammar.weight("bara") == 0


def test_patterns_of_clauses(grammar):
    def of(words): return [p for p, _ in grammar.clause(words.split())]
    assert of("such a snarp") == ["plain"]
    assert of("you are a snarp") == ["addressed"]
    assert of("this is not a snarp") == ["negated"]
    assert of("they said snarp") == ["reported"]
    assert of('" snarp "') == ["reported"]
    assert of("not a snarp but a glimwad") == ["negated", "plain"]
    assert of("i will hurt you") == ["threat"]
    assert of("they never hurt you") == [] and of("hurt the sand") == []


def test_score_reads_clauses_not_words(grammar):
    plain, addressed = grammar.score("what a snarp."), grammar.score("you are a snarp.")
    assert addressed >= plain > 0.3
    assert grammar.score("that is not a snarp.") < plain and grammar.score("they said snarp.") < plain
    assert grammar.score("they said so. what a snarp.") == pytest.approx(plain)  # the frame ends with its clause
    assert 0 <= grammar.score(None) == grammar.score("") == grammar.score("bara elo") < 0.3


def test_clause_spans_cover_the_match(grammar):
    text = "First one. İstanbul SNARP here; next"
    (pattern, weight, s, e), = grammar.matches(text)
    assert "SNARP" in text[s:e] and "First" not in text[s:e] and "next" not in text[s:e] and weight > 0


def test_copies_of_one_toxic_text_do_not_make_a_lexicon():
    rng = random.Random(8)
    def rare(): return " ".join(f"u{rng.randrange(10 ** 8)}" for _ in range(30))
    copied = rare() + " snarp"
    rows = [(copied, 1)] * 30 + [(rare() + " snarp", 1) for _ in range(30)] + [(rare(), 0) for _ in range(100)]
    g = X.learn(rows)
    assert set(g.words) | set(g.stems) == {"snarp"}


def test_held_out_accuracy_on_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    grammar = X.fit(docs, labels)
    got = X.scored(docs.select("doc_id", "text"), grammar).join(labels, "doc_id").where(is_held_out(F.col("doc_id"))).collect()
    clean = [r for r in got if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    toxic = [r for r in got if r.toxic]
    # every toxic row counts; insults of the smaller languages are in too few labelled rows here
    assert toxic and sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def every_path(machine, tape):
    """Brute force: all accepted paths of a machine, as (value, written)."""
    def go(state, rest):
        if not rest:
            return [(0.0, [])] if state in machine.final else []
        (symbol, own), out = rest[0], []
        for written, w, n in machine.arcs[state].get(symbol, ()):
            out += [(w * own + v if written else v, [(written, own)] * bool(written) + said) for v, said in go(n, rest[1:])]
        return out
    return go(machine.start, tape)


def through_the_cascade(machines, tape):
    """Brute force without composition: each machine reads all that the one before can write."""
    tapes = [(1.0, tape)]
    for m in machines:
        tapes = [(1.0, said) for _, t in tapes for _, said in every_path(m, t)]
    return [said for _, said in tapes]


def test_the_composed_machine_equals_all_paths(grammar):
    rng = random.Random(11)
    single = (X.NEGATION, X.REPORTED, X.TARGET, X.THREATENING, X.scoring(grammar.patterns))
    composed = single[0]
    for m in single[1:]:
        composed = composed.then(m)
    words = ["snarp", "zorkelist", "you", "not", "said", '"', "hurt", "bara"]
    for _ in range(400):
        said = rng.choices(words, k=rng.randrange(8))
        tape = grammar.tape(said)
        paths = every_path(composed, tape)
        value, written = grammar._machine.best(tape)
        assert len(paths) == 1 and paths[0][0] == pytest.approx(value) and paths[0][1] == written == grammar.clause(said)
        assert through_the_cascade(single, tape) == [written]
        assert value == pytest.approx(sum(grammar.patterns[p] * w for p, w in written))


def test_threat_weights_and_reporting_words_are_learned():
    rng = random.Random(3)
    def rare(): return " ".join(f"u{c}{rng.choice('abcdefgh')}{rng.choice('klmnopq')}{rng.choice('rstuvw')}" for c in rng.choices("bcdfg", k=30))
    rows = [(f"snarp {rare()}.", 1) for _ in range(120)] + [(f"you will be shot {rare()}. i will shoot you.", 1) for _ in range(20)]
    rows += [(f"{rare()}.", 0) for _ in range(1000)] + [(f"we beat them {rare()}.", 0) for _ in range(20)]
    rows += [(f"{rare()}. the paper printed snarp again.", 0) for _ in range(5)]
    g = X.learn(rows)
    assert g.weight("snarp") > 3 and "printed" in g.reporting and "shot" not in g.reporting
    assert g.threats["shoot"] > 3 and g.threats["beat"] == 0
    assert [p for p, _ in g.clause("they printed snarp".split())] == ["reported"]


def test_no_labels_empty_tables_nulls_and_clashes(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    g = X.fit(docs((1, "a")), none)
    assert X.scored(docs(), g).count() == 0
    nulls = spark.createDataFrame([(None, None, 1), (1, 1, None), (2, 1, 1), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    g = X.fit(docs((1, "x y"), (2, None), (3, "clean words"), (2, None)), nulls)
    rows = X.scored(docs((1, None), (2, ""), (None, "z" * 400_000), (2, "")), g).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    one = X.scored(spark.sql("select 1L doc_id, 'a' text, 'mine' score, 'q' predicted, 'w' words"), g).first()
    assert one.words == "w" and isinstance(one.score, float) and one.predicted in (0, 1)


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    other = labels.withColumn("toxic", F.when(is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.fit(docs, labels) == X.fit(docs, other)
