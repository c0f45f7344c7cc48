import hashlib
import re

import pytest

from kpiforge.llm import pii as P
from kpiforge.llm import queries

SF = "/root/testdata/sf0.01"


def brute_base(text):
    """The contract's expressions as they stand, with no shortcut before them."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c not in " -"]
        odd = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 13 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(odd)) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


TEXTS = [
    "", "no data", "mail a.b+c@x-y.example.co.uk, or A@b.c! x@y @z", "1.2.3.4 256.1.1.1 001.02.3.255 1.2.3.4.5 9999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559", "+1 (212) 555-0153 +49.30.1234567 +12345678 +1234567890123456",
    "é+4420 7946 0958ü 测试 a@例.com b@c.例 mail@host.comé", "+1-1.2.3.4 5500 0055 5555 5559 1.2.3.4", "0000000000000000 12345678901234567890",
    "x" * 2_000 + " q@w.e " + "1 " * 3000, "1" * 5000 + "." + "2" * 5000 + ".3.4", "a@b.c" * 50, "+1" * 40, "٣٤.١.٢.٣ ４１１１", "a@b\n.c 1.2.\n3.4",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_equal_the_expressions(text):
    if "1" * 5000 in text:
        import sys
        sys.set_int_max_str_digits(0)
    assert P.base_spans(text) == brute_base(text)


def test_query_equals_brute_force_on_the_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_information_sanitisation"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute_base(texts[r.doc_id])
        said = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x[0] for x in base) for k in P.KINDS)
        assert r.spans.startswith(said) and all(x.startswith("term:") for x in r.spans[len(said):].strip(",").split(",") if x)


def people(docs):
    """The word Zanthor stands beside one address only; the rest is common."""
    rows = [(i, f"write to Zanthor boss of works at boss@corp.example now\nplain line {i} of words") for i in range(6)]
    rows += [(100 + i, f"write to somebody of works at p{i}@corp.example now\nother line") for i in range(80)]
    rows += [(500 + i, f"plain words about works, somebody and write now {i}") for i in range(200)]
    return rows + [(900, "Zanthor was seen without an address"), (901, None)]


def test_terms_that_reveal_an_entity(spark, docs):
    frame = docs(*people(docs))
    risky = P.risky_terms(frame).collect()
    got = {r.doc_id: r for r in P.found(frame, P.risky_terms(frame)).collect()}
    names = {got[0].text[s.start:s.end] for s in got[0].spans if s.kind == "term"}
    assert names == {"Zanthor", "boss"} and len(risky) == 2
    assert "Zanthor" not in got[0].sanitised and "[EMAIL]" in got[0].sanitised and "boss@" not in got[0].sanitised
    assert [(s.kind, s.start, s.end) for s in got[900].spans] == [("term", 0, 7)]
    assert all(s.kind == "email" for s in got[100].spans) and "somebody" in got[100].sanitised
    assert got[500].sanitised == got[500].text and got[901].sanitised == ""


def test_disclosure_equals_brute_force(docs):
    import math
    rows = people(docs)
    frame = docs(*rows)
    got = {r.disclosure for r in P.risky_terms(frame, generalise=0.0).collect()}
    n, n_e = len(rows), 6
    def share(term): return sum(term in re.findall(r"[a-z]+", (t or "").lower()) for _, t in rows)
    def value(term, n_te): return math.log2(n * n_te / (share(term) * n_e)) / -math.log2(n_e / n)
    want = {value("zanthor", 6), value("boss", 6)}
    assert all(any(abs(w - g) < 1e-9 for g in got) for w in want)


def test_copies_of_one_text_are_no_evidence(docs):
    rows = [(i, "Quorvix stands beside one@only.example here") for i in range(50)] + [(100 + i, f"other {i}") for i in range(50)]
    assert P.risky_terms(docs(*rows)).count() == 0


def test_offsets_are_code_points(docs):
    rows = [(i, f"日本é Zanthor😀 x@y.zz {'v' * i}") for i in range(5)] + [(50 + i, f"nothing {i}") for i in range(60)]
    frame = docs(*rows)
    got = P.found(frame, P.risky_terms(frame)).where("doc_id = 0").first()
    assert {(s.kind, got.text[s.start:s.end]) for s in got.spans} >= {("email", "x@y.zz")}
    for s in got.spans:
        if s.kind == "term":
            assert got.text[s.start:s.end] in "日本é Zanthor😀 x@y.zz"


def test_several_blocks_give_the_same(docs):
    frame = docs(*people(docs))
    terms = P.risky_terms(frame)
    one = {r.doc_id: r.spans for r in P.found(frame, terms).collect()}
    two = {r.doc_id: r.spans for r in P.found(frame, terms, most=1).collect()}
    assert one == two


def test_nulls_repeats_empty_tables_clashes(spark, docs):
    frame = docs((1, None), (None, "a@b.cc"), (2, ""), (2, ""), (3, "z" * 300_000))
    rows = P.found(frame, P.risky_terms(frame)).collect()
    assert len(rows) == 5 and sum(len(r.spans) for r in rows) == 1
    assert P.found(docs(), P.risky_terms(docs())).count() == 0
    one = P.found(spark.sql("select 1L doc_id, 'a@b.cc' text, 'mine' spans, 'm' sanitised, 't' term, 'k' kind")).first()
    assert (one.term, one.kind, one.sanitised, len(one.spans)) == ("t", "k", "[EMAIL]", 1)


@pytest.mark.parametrize("text", ["x" * 1_000_000 + " q@w.e", "1" * 1_000_000, "a." * 500_000 + "@", "1." * 500_000, "@" * 1_000_000,
                                  "+1" + "(" * 1_000_000, "a@b" * 300_000, "1 " * 500_000 + "+"])
def test_one_megabyte_without_a_break_takes_seconds(text):
    import time
    t = time.perf_counter()
    P.base_spans(text)
    assert time.perf_counter() - t < 10


def test_a_short_name_on_the_line_above_an_address_in_two_texts(docs):
    rows = [(i, f"entry {i}\nName: Bob\nEmail: bob.smith@corp.example\nend {'x' * i}") for i in range(2)]
    rows += [(10 + i, f"entry {i}\nName: somebody{i}\nEmail: p{i}@corp.example\nend") for i in range(150)]
    frame = docs(*rows)
    got = P.found(frame, P.risky_terms(frame)).where("doc_id = 0").first()
    assert "Bob" in {got.text[s.start:s.end] for s in got.spans if s.kind == "term"} and "Bob" not in got.sanitised
    assert "Name" in got.sanitised and "Email" in got.sanitised


def test_long_line_of_entities_and_words(docs):
    import time
    text = " ".join(f"word{i} p{i}@corp.example" for i in range(20_000))
    t = time.perf_counter()
    frame = docs((1, text), (2, "other"))
    got = P.found(frame, P.risky_terms(frame)).where("doc_id = 1").first()
    assert len(got.spans) == 20_000 and time.perf_counter() - t < 60
