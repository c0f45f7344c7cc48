"""Toxicity by a weighted finite-state pattern grammar.

Insult words and stems, weights of threat words and further reporting words are
learned from labelled rows, with log-odds weights. Texts are searched for insults
and threats; each clause that holds one is read by transducers, which are data
(states, arcs, weights) and are composed into one machine:

* lexical: word -> symbol with a weight (insult, threat, target, negation,
  reporting verb, quotation mark, other), between marks of the clause's ends;
* negation, reported speech, target, threat: each rewrites the symbols it knows
  (insult -> negated, reported, addressed insult) and passes the others on; the
  target machine guesses at the start whether someone is addressed, and only the
  right guess ends in a final state;
* scoring: one arc for each pattern, with the pattern's weight.

Composition multiplies arc weights. A clause counts as its best path: the sum of
arc weight times the word's own weight.

A text's score is a logistic function of its matched clauses, not of isolated
words: a negated or reported insult counts as its pattern has earned."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.llm.common import is_held_out, unit_hash

#: Bound on the labelled rows that training reads, per label.
SAMPLE = 2500
THRESHOLD = 0.3
MIN_STEM, MAX_STEM = 4, 7

#: Closed word classes of the grammar.
TARGETS = frozenset("you your yours u ur he she they them him her these those tu vous toi du dich ihr euch sie usted ustedes ellos ellas vosotros".split())
NEGATIONS = frozenset("not never no nor isn't aren't wasn't don't doesn't ne pas jamais nicht kein keine nie nunca jamás".split())
REPORTING = frozenset("said says say called calls claimed claims wrote writes reported reports quoted dit disait sagte sagt schrieb dijo dice escribió".split())
THREATS = frozenset("kill hurt beat destroy punch shoot stab burn crush attack tuer frapper töten schlagen matar golpear".split())
PATTERNS = ("plain", "addressed", "negated", "reported", "threat")
#: Weights the patterns start from; labelled rows move them.
PRIOR = {"plain": 1.0, "addressed": 1.2, "negated": 0.6, "reported": 0.6, "threat": 0.8}

#: Weight of a threat word that the labelled rows do not hold often enough.
THREAT = 2.0

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")
CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol]``: the (output, weight, next state) to choose from; an
    output of "" writes nothing. A path counts if it ends in one of ``final``."""
    start: object
    arcs: dict
    final: frozenset

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this machine writes. Only states that
        can be reached from the start are built; weights are multiplied."""
        start = (self.start, other.start)
        arcs, todo = {}, [start]
        while todo:
            here = todo.pop()
            if here in arcs:
                continue
            a, b = here
            arcs[here] = {}
            for symbol, choices in self.arcs[a].items():
                out = []
                for written, w, a2 in choices:
                    for said, v, b2 in [("", 1.0, b)] if written == "" else other.arcs[b].get(written, []):
                        out.append((said, w * v, (a2, b2)))
                        todo.append((a2, b2))
                if out:
                    arcs[here][symbol] = out
        return Transducer(start, arcs, frozenset(x for x in arcs if x[0] in self.final and x[1] in other.final))

    def numbered(self) -> Transducer:
        """The same machine with whole numbers as states."""
        name = {x: i for i, x in enumerate(self.arcs)}
        return Transducer(name[self.start], {name[x]: {s: [(o, w, name[n]) for o, w, n in c] for s, c in by.items()} for x, by in self.arcs.items()},
                          frozenset(name[x] for x in self.final))

    def best(self, tape: list[tuple[str, float]]) -> tuple[float, list[tuple[str, float]]] | None:
        """(value, written symbols with the weight of the word they were read at) of the
        best path over the weighted symbols; None if no path ends in a final state."""
        at = {self.start: (0.0, None)}
        for symbol, own in tape:
            to: dict = {}
            for state, (value, trail) in at.items():
                for written, w, n in self.arcs[state].get(symbol, ()):
                    v = value + w * own if written else value
                    if n not in to or v > to[n][0]:
                        to[n] = (v, (trail, written, own) if written else trail)
            at = to
        ends = [at[x] for x in sorted(self.final & at.keys())]
        if not ends:
            return None
        value, trail = max(ends, key=lambda e: e[0])
        out = []
        while trail:
            trail, written, own = trail
            out.append((written, own))
        return value, out[::-1]


#: What the lexical machine writes: clause start and end, insult, threat, target, negation, reporting verb, quotation mark, other word.
SYMBOLS = ("^", "$", "I", "K", "T", "N", "R", "Q", "o")
#: What further machines write of these: negated, reported, addressed insult, end of a clause that cannot threaten.
MARKED = ("I-", "Ir", "Ia", "$-")


def _machine(start: str, final: str, rules: dict[str, dict[str, tuple[str, str] | list | None]]) -> Transducer:
    """A machine from the rules that do more than pass a symbol on and stay; None: no arc."""
    arcs: dict = {}
    for state, special in rules.items():
        arcs[state] = {s: [(s, 1.0, state)] for s in SYMBOLS + MARKED}
        for s, to in special.items():
            arcs[state][s] = [(o, 1.0, n) for o, n in (to if isinstance(to, list) else [to])] if to else []
    return Transducer(start, arcs, frozenset(final.split()))


NEGATION = _machine("open", "open negated", {
    "open": {"N": ("N", "negated")},
    "negated": {"I": ("I-", "open"), "$": ("$-", "negated")}})
_TOLD = {"I": "Ir", "I-": "Ir"}
REPORTED = _machine("own", "own quoted told both", {
    "own": {"R": ("R", "told"), "Q": ("Q", "quoted")},
    "quoted": {s: (o, "quoted") for s, o in _TOLD.items()} | {"R": ("R", "both"), "Q": ("Q", "own")},
    "told": {s: (o, "told") for s, o in _TOLD.items()} | {"Q": ("Q", "both"), "$": ("$-", "told")},
    "both": {s: (o, "both") for s, o in _TOLD.items()} | {"Q": ("Q", "told"), "$": ("$-", "both")}})
TARGET = _machine("start", "nobody somebody", {
    "start": {"^": [("^", "nobody"), ("^", "awaited")]},
    "nobody": {"T": None, "$": ("$-", "nobody")},
    "awaited": {"I": ("Ia", "awaited"), "T": ("T", "somebody")},
    "somebody": {"I": ("Ia", "somebody")}})
THREATENING = _machine("calm", "calm raised", {
    "calm": {"K": ("", "raised"), "$": ("", "calm"), "$-": ("", "calm")},
    "raised": {"K": ("", "raised"), "$": ("threat", "raised"), "$-": ("", "raised")}})
CASCADE = NEGATION.then(REPORTED).then(TARGET).then(THREATENING)


def scoring(patterns: dict[str, float]) -> Transducer:
    """One state; an arc for each pattern, all other symbols are dropped."""
    named = {"I": "plain", "Ia": "addressed", "I-": "negated", "Ir": "reported", "threat": "threat"}
    return Transducer(0, {0: {s: [(named[s], patterns[named[s]], 0)] if s in named else [("", 1.0, 0)]
                              for s in (*SYMBOLS, *MARKED, "threat")}}, frozenset([0]))


@dataclass
class Grammar:
    """words: insult -> log-odds; stems: the same for beginnings of words;
    patterns: weight of each; bias: score of a text without any match; threats:
    learned weights of threat words; reporting: learned reporting words."""
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    patterns: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    bias: float = -3.0
    threats: dict[str, float] = field(default_factory=dict)
    reporting: frozenset[str] = frozenset()

    def __post_init__(self):
        heads = sorted({*self.words, *self.stems, *THREATS}, key=lambda w: (-len(w), w))
        self._find = re.compile(rf"(?<![^\W\d_])(?:{_trie(heads)})") if heads else None
        self._machine = CASCADE.then(scoring(self.patterns)).numbered()

    def weight(self, word: str) -> float:
        """Of an insult; 0 for other words. The longest learned stem decides."""
        if word in self.words:
            return self.words[word]
        for n in range(min(len(word), MAX_STEM), MIN_STEM - 1, -1):
            if word[:n] in self.stems:
                return self.stems[word[:n]]
        return 0.0

    def tape(self, words: list[str]) -> list[tuple[str, float]]:
        """The lexical machine: symbols of a clause with the weight of each word. The end
        carries the weight of the strongest threat word."""
        out, threat = [("^", 0.0)], 0.0
        for w in words:
            if w in "\"“”«»":
                out.append(("Q", 0.0))
            elif w in NEGATIONS:
                out.append(("N", 0.0))
            elif w in REPORTING or w in self.reporting:
                out.append(("R", 0.0))
            elif w in TARGETS:
                out.append(("T", 0.0))
            elif w in THREATS:
                out.append(("K", 0.0))
                threat = max(threat, self.threats.get(w, THREAT))
            else:
                weight = self.weight(w)
                out.append(("I", weight) if weight else ("o", 0.0))
        return [*out, ("$", threat)]

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """Patterns of one clause, with the weight of the insult or threat in each."""
        found = self._machine.best(self.tape(words))
        return found[1] if found else []

    def matches(self, text: str) -> list[tuple[str, float, int, int]]:
        """(pattern, weight, first and end character of the clause) of a whole text."""
        if not self._find:
            return []
        low = text.lower()
        if len(low) != len(text):  # a few capitals change length in lower case
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        out, done = [], 0
        for m in self._find.finditer(low):
            if m.start() < done:
                continue
            start = max((low.rfind(c, done, m.start()) for c in ".!?;:\n"), default=-1) + 1
            start = max(start, done)
            end = CLAUSE_END.search(low, m.end())
            done = end.end() if end else len(low)
            out.extend((p, w, start, done) for p, w in self.clause(WORD.findall(low[start:done])))
        return out

    def strength(self, text: str) -> float:
        return sum(self.patterns[p] * w for p, w, _, _ in self.matches(text))

    def score(self, text: str | None) -> float:
        x = self.bias + (self.strength(text) if text else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _trie(words: list[str]) -> str:
    """One expression for many words that shares their beginnings."""
    tree: dict = {}
    for w in words:
        at = tree
        for c in w:
            at = at.setdefault(c, {})
        at[""] = {}

    def said(at: dict) -> str:
        parts = [re.escape(c) + said(x) for c, x in sorted(at.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"
        return f"(?:{body})?" if "" in at else body
    return said(tree)


def one_of_each_family(texts: list[str]) -> list[str]:
    """One text (the first) of each family of near copies: families share four
    MinHash values of their word triples in one of twelve bands."""
    from kpiforge.llm import tokens as K
    from kpiforge.llm.forest import signatures

    raw = "\0".join(texts).encode()
    data = np.frombuffer(raw, np.uint8)
    ends = np.cumsum([len(t.encode()) + 1 for t in texts])
    off = np.minimum(np.concatenate([[0], ends]), len(data))
    _, _, h, first = K.words(data, off)
    sets, sizes = K.shingle_sets(h, first, 3)
    full = np.flatnonzero(sizes)
    if not len(full):
        return texts[:1]
    sig = signatures(sets, sizes)
    up = {int(i): int(i) for i in full}

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i
    for band in range(12):
        seen: dict[bytes, int] = {}
        for row, i in enumerate(full):
            a, b = root(int(i)), root(seen.setdefault(sig[row, 4 * band:4 * band + 4].tobytes(), int(i)))
            up[max(a, b)] = min(a, b)
    return [texts[i] for i in sorted({root(int(i)) for i in full})]


FRAMES = NEGATIONS | REPORTING | {"\"", "“", "”", "«", "»"}
CLOSED = FRAMES | TARGETS | THREATS


def _keys(text: str) -> set[tuple[str, str]]:
    """Words and stems of the clauses that neither negate nor report: others
    show how a word is spoken of, not what it does."""
    found: set[str] = set()
    for clause in CLAUSE_END.split(text.lower()):
        words = set(WORD.findall(clause))
        if words.isdisjoint(FRAMES):
            found |= words
    found = {w for w in found - CLOSED if len(w) > 2}
    return {("w", w) for w in found} | {("s", w[:n]) for w in found for n in range(MIN_STEM, min(len(w), MAX_STEM) + 1)}


def _threat_keys(text: str) -> set[tuple[str, str]]:
    return {("t", w) for w in THREATS.intersection(WORD.findall(text.lower()))}


def learn(rows: list[tuple[str | None, int]], min_docs: int = 3, min_odds: float = 4.0) -> Grammar:
    """A grammar from (text, label) rows. Entries are words and stems whose
    smoothed log-odds reach ``min_odds`` and that ``min_docs`` toxic texts hold;
    near copies count as one text, or the rare words of a copied text would
    qualify. Entries come by the toxic texts that hold them; of a stem and its
    longer forms, the first is kept. Then the weights of patterns and the bias
    are fitted by logistic regression drawn to the prior."""
    n1, n0 = sum(1 for _, y in rows if y), sum(1 for _, y in rows if not y)
    if not n1 or not n0:
        return Grammar(bias=math.log((n1 + 0.5) / (n0 + 0.5)) if rows else -3.0)
    toxic, clean = Counter(), Counter()
    families = {y: one_of_each_family([t for t, label in rows if t and bool(label) == y]) if any(t and bool(label) == y for t, label in rows) else []
                for y in (True, False)}
    for text in families[True]:
        toxic.update(_keys(text) | _threat_keys(text))
    often = {k for k, c in toxic.items() if c >= min_docs and k[0] != "t"}
    for text in families[False]:
        clean.update(_keys(text) & often | _threat_keys(text))
    m1, m0 = len(families[True]), len(families[False])
    odds = {k: math.log((toxic[k] + 0.5) / (m1 + 1)) - math.log((clean[k] + 0.5) / (m0 + 1)) for k in often}
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    least = max(min_docs, 0.005 * m1)
    for kind, w in sorted((k for k in often if odds[k] >= min_odds and toxic[k] >= least), key=lambda k: (-toxic[k], k[0] == "s", -len(k[1]), k)):
        if any(w[:n] in stems for n in range(MIN_STEM, len(w) + 1)) or kind == "s" and any(x.startswith(w) for x in words):
            continue
        if kind == "s" and any(x.startswith(w) and odds[k, x] > odds["s", w] + 0.3 and toxic[k, x] >= 0.7 * toxic["s", w] for k, x in often):
            continue  # a longer form says nearly as much and is more certain
        (words if kind == "w" else stems)[w] = odds[kind, w]
    threats = {w: max(0.0, math.log((toxic["t", w] + 0.5) / (m1 + 1)) - math.log((clean["t", w] + 0.5) / (m0 + 1)))
               for w in THREATS if toxic["t", w] + clean["t", w] >= min_docs}
    return _fitted(Grammar(words, stems, threats=threats, reporting=_reporting_words(Grammar(words, stems), families, min_docs, min_odds)), rows)


def _reporting_words(grammar: Grammar, families: dict[bool, list[str]], min_docs: int, min_odds: float) -> frozenset[str]:
    """Words that stand before an insult in its clause, with no listed negation or
    reporting word there, in at least ``min_docs`` clean texts and whose log-odds for clean ones, among texts with an insult, reach
    ``min_odds``: they tell of the insult, as the listed reporting verbs do."""
    seen = {y: Counter() for y in families}
    texts = dict.fromkeys(families, 0)
    for label, group in families.items():
        for text in group:
            before: set[str] = set()
            hit = False
            for clause in CLAUSE_END.split(text.lower()) if grammar.matches(text) else ():
                said = WORD.findall(clause)
                if not FRAMES.isdisjoint(said):
                    continue  # a listed word explains this clause
                last = max((i for i, w in enumerate(said) if grammar.weight(w)), default=-1)
                hit = hit or last >= 0
                before.update(w for w in said[:max(last, 0)] if len(w) > 2 and w not in CLOSED and not grammar.weight(w))
            seen[label].update(before)
            texts[label] += hit
    clean, toxic = seen[False], seen[True]
    return frozenset(w for w, c in clean.items() if c >= min_docs and
                     math.log((c + 0.5) / (texts[False] + 1)) - math.log((toxic[w] + 0.5) / (texts[True] + 1)) >= min_odds)


def _fitted(grammar: Grammar, rows: list[tuple[str | None, int]], steps: int = 600, pull: float = 0.002) -> Grammar:
    """Pattern weights and bias by gradient descent; ``pull`` draws to the prior."""
    unit = max([1.0, *grammar.words.values(), *grammar.stems.values()])
    x = np.zeros((len(rows), len(PATTERNS)))
    y = np.array([1.0 if label else 0.0 for _, label in rows])
    for i, (text, _) in enumerate(rows):
        for p, w, _, _ in grammar.matches(text or ""):
            x[i, PATTERNS.index(p)] += w / unit
    x = np.minimum(x, 2.0)  # further matches add nothing the label can teach
    prior = np.array([PRIOR[p] for p in PATTERNS]) * unit
    w, b = prior.copy(), -3.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        e = (p - y) / len(y)
        w -= 2.0 * (x.T @ e + pull * (w - prior) / unit)
        b -= 2.0 * e.sum()
    grammar.patterns = {p: float(max(0.1, v / unit)) for p, v in zip(PATTERNS, w, strict=True)}
    grammar.patterns["addressed"] = max(grammar.patterns["addressed"], grammar.patterns["plain"])  # an address never weakens
    return Grammar(grammar.words, grammar.stems, grammar.patterns, float(b), grammar.threats, grammar.reporting)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> list[tuple[str | None, int]]:
    """At most about ``most`` (text, label) rows of each label outside the
    held-out fold, by a hash of the id. Only the ids drawn, a bounded table, are
    broadcast to find their texts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").where(~is_held_out(F.col("doc_id")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy(F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")).count().collect()}
    rate = F.when(F.col("toxic") > 0, most / max(most, counts.get(1, 0))).otherwise(most / max(most, counts.get(0, 0)))
    drawn = known.where(unit_hash(F.lit("toxic"), F.col("doc_id")) < rate).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).limit(3 * most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    return sorted(((r["text"], r["toxic"]) for r in rows.select("text", "toxic").collect()), key=lambda r: (r[1], r[0] or ""))


def scored(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if at least the
    threshold) added. Null, empty and very short texts get the score of a text
    without matches. Repeated rows are scored alike; extra columns pass through
    (ones named like the added columns are replaced). Map-side: no shuffle."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    held = docs.sparkSession.sparkContext.broadcast((grammar.words, grammar.stems, grammar.patterns, grammar.bias, grammar.threats, grammar.reporting))

    def run(batches):
        import pyarrow as pa

        g = Grammar(*held.value)
        for batch in batches:
            score = [g.score(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())],
                [*batch.schema.names, "score", "predicted"])
    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Grammar:
    return learn(labelled_sample(docs, labels, most))


def op10_toxicity_grammar(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    grammar = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, grammar).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
