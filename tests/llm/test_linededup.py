import pytest

from kpiforge.llm.linededup import BLANKS, dedup_lines

LONG = "this line is certainly longer than forty characters"


def brute(rows, min_docs=5, min_chars=40):
    def key(line):
        line = line.strip(BLANKS)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                holders.setdefault(key(line), set()).add(i)
    over = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if over.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, docs, rows):
    got = dedup_lines(docs(*rows)).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)


def test_frequent_lines_stay_in_the_largest_id(spark, docs):
    check(spark, docs, [(i, f"head {i}\n {LONG.upper()}\t\nmiddle\n{LONG}\n\ntail") for i in range(6)] + [(9, "short")])


def test_under_the_threshold_nothing_goes(spark, docs):
    check(spark, docs, [(i, f"{LONG}\n{LONG}") for i in range(4)])


def test_null_empty_repeated_and_adjacent_lines(spark, docs):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n" + LONG), (None, LONG + "\nx"), (None, None)]
    rows += [(i, f"{LONG}\n{LONG}\nz") for i in (5, 6, 7, 8)] + [(8, f"{LONG}\n{LONG}\nz"), (7, f"q\n{LONG}")]
    check(spark, docs, rows)


def test_code_points_not_bytes_and_ascii_case_only(spark, docs):
    at_limit = "é" * 40
    rows = [(i, at_limit) for i in range(5)] + [(10 + i, "É" * 40) for i in range(5)] + [(20 + i, "ü" * 39) for i in range(5)]
    check(spark, docs, rows)


def test_very_long_text(spark, docs):
    rows = [(i, "\n".join([LONG, f"own line {i} " + "x" * 40] * 3000)) for i in range(5)]
    check(spark, docs, rows)


def test_empty_table_and_clashing_columns(spark, docs):
    assert dedup_lines(docs()).count() == 0
    got = dedup_lines(spark.sql("select 1L doc_id, 'a' text, 'mine' n_lines, 'h' h1, 'p' pos, 'k' keeper")).first()
    assert (got.n_lines, got.h1, got.pos, got.keeper) == (1, "h", "p", "k")


@pytest.mark.parametrize("n", [1, 2])
def test_plan_has_no_python(spark, docs, n):
    plan = dedup_lines(docs((1, LONG)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
