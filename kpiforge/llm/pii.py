"""Personal data: patterns, and information-theoretic sanitisation around them.

Base entities (email, ip, card, phone) are found by pattern. Corpus
co-occurrence then says how strongly a term near an entity reveals it: with
p(e) the share of documents that hold entity e, its information is
IC(e) = -log2 p(e), and a term t discloses PMI(t; e) = log2(p(t, e) / p(t)p(e))
of it. Terms that disclose at least ``generalise`` of an entity's information
are replaced by their kind of word, from ``remove`` on they are deleted."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.llm.common import slices, stored, text_buffers

#: The base patterns and their order. An address is searched from
#: its @: the local part is what stands before it, and DOMAIN what follows. A
#: number is tried at the start of its run of digits only; the possessive runs
#: never give back. So each character is looked at a few times, however long the
#: runs are.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")

#: Words on either side of an entity, on its line and the neighbouring ones, that count as its context.
REACH = 8
MIN_TEXTS, GENERALISE, REMOVE = 2, 0.9, 0.97
#: Terms a task holds at once (8 bytes each); more take several passes.
BLOCK_TERMS = 1_000_000


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out = []
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
        low = domain.end() if domain else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start.
    Leftmost non-overlapping matches per kind; those that fail are dropped."""
    out = [("email", *span) for span in _emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split("."))]
    for m in CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


def said(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _entity(kind: str, value: str) -> int:
    value = value.lower() if kind == "email" else "".join(c for c in value if c.isdigit() or c == ".")
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "little", signed=True)


def _terms(raw: np.ndarray, off: np.ndarray):
    """Words that may be terms: (start, end, hash, first of each text)."""
    from kpiforge.llm import tokens as K

    start, end, h, first = K.words(raw, off, K.ALNUM)
    lead = raw[start] if len(start) else np.zeros(0, np.uint8)
    use = ~((lead >= 0x30) & (lead <= 0x39))  # numbers are the patterns' business
    count = np.concatenate([[0], np.cumsum(use)])
    return start[use], end[use], h[use].view(np.int64), count[first]


def _maybe(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows with an @ or with four digits: no other text can hold an entity."""
    part, at = raw[int(off[0]):int(off[-1])], off - off[0]
    out = np.zeros(len(off) - 1, bool)
    for mask, least in ((part == 0x40, 1), ((part >= 0x30) & (part <= 0x39), 4)):
        total = np.concatenate([[0], np.cumsum(mask)])
        out |= total[at[1:]] - total[at[:-1]] >= least
    return out


def contexts(docs: DataFrame) -> DataFrame:
    """(text, entity, term), one for each distinct pair of a row; term 0 stands
    for the entity itself, ``text`` is a hash of the whole text."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = text_buffers(batch.column(0))
            rows = []
            for i, j in slices(off):
                maybe = np.flatnonzero(_maybe(raw, off[i:j + 1]))
                if not len(maybe):
                    continue
                start, end, h, first = _terms(raw, off[i:j + 1])
                for r in maybe.tolist():
                    b = raw[off[i + r]:off[i + r + 1]]
                    text = b.tobytes().decode()
                    spans = base_spans(text)
                    if not spans:
                        continue
                    digest = int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)
                    byte = np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b)) + off[i + r]  # of each code point
                    own = slice(int(first[r]), int(first[r + 1]))
                    starts, ends, terms = start[own], end[own], h[own]
                    pairs = set()
                    for kind, s, e in spans:
                        entity = _entity(kind, text[s:e])
                        pairs.add((entity, 0))
                        left, right = int(np.searchsorted(ends, byte[s], "right")), int(np.searchsorted(starts, byte[e], "left"))
                        pairs.update((entity, t) for t in terms[max(left - REACH, 0):left].tolist())
                        pairs.update((entity, t) for t in terms[right:right + REACH].tolist())
                    rows.extend((digest, a, t) for a, t in pairs)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["text", "entity", "term"])
    return docs.select("text").mapInArrow(run, "text long, entity long, term long")


def hash_blocks(terms: DataFrame, most: int = BLOCK_TERMS):
    """Sorted arrays of the distinct hashes in column ``term``, each of about
    ``most`` or fewer: the count decides how many blocks there are."""
    n = max(1, -(-terms.count() // most))
    for b in range(n):
        rows = terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == b).select("term").distinct().collect()
        if rows:
            yield np.sort(np.array([r[0] for r in rows], np.int64))


def document_counts(docs: DataFrame, terms: DataFrame, most: int = BLOCK_TERMS) -> DataFrame:
    """(term, n_t): the number of all documents that hold each term of ``terms``."""
    spark, out = docs.sparkSession, None
    for block in hash_blocks(terms, most):
        held = spark.sparkContext.broadcast(block)

        def run(batches, held=held):
            import pyarrow as pa

            wanted = held.value
            for batch in batches:
                raw, off = text_buffers(batch.column(0))
                total = np.zeros(len(wanted), np.int64)
                for i, j in slices(off):
                    _, _, h, first = _terms(raw, off[i:j + 1])
                    at = np.searchsorted(wanted, h)
                    at[at == len(wanted)] = 0
                    hit = np.flatnonzero(wanted[at] == h)
                    text = np.searchsorted(first, hit, "right") - 1
                    pair = np.unique(text * len(wanted) + at[hit])
                    total += np.bincount(pair % len(wanted), minlength=len(wanted))
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(total[some])], ["term", "n"])
        one = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n_t"))
        out = one if out is None else out.union(one)
    return out if out is not None else terms.select("term", F.lit(0).cast("long").alias("n_t")).limit(0)


def risky_terms(docs: DataFrame, min_texts: int = MIN_TEXTS, generalise: float = GENERALISE) -> DataFrame:
    """(term, disclosure): the share of an entity's information that a term
    discloses, where it reaches ``generalise`` for some entity. Evidence are at
    least ``min_texts`` distinct texts with both (copies of one text say it
    once); the probabilities count all documents."""
    total = docs.count()
    seen = stored(contexts(docs), "contexts")
    pairs = stored(seen.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"), F.count_distinct("text").alias("texts"))
                   .where(F.col("texts") >= min_texts), "pairs")
    entity = pairs.where("term = 0").select("entity", F.col("n_te").alias("n_e"))
    pairs = pairs.where("term <> 0")
    count = document_counts(docs, pairs.select("term").distinct())
    rated = (pairs.join(entity, "entity").join(count, "term").where(F.col("n_e") < total)
             .withColumn("d", F.log2(F.lit(total) * F.col("n_te") / (F.col("n_t") * F.col("n_e"))) / -F.log2(F.col("n_e") / F.lit(total))))
    return stored(rated.groupBy("term").agg(F.max("d").alias("disclosure")).where(F.col("disclosure") >= generalise), "risky")


def found(docs: DataFrame, risky: DataFrame | None = None, remove: float = REMOVE, most: int = BLOCK_TERMS) -> DataFrame:
    """``docs`` with ``spans`` (array of kind, start, end; code points, end
    exclusive; base kinds first, in their order, then ``term``) and
    ``sanitised`` text added: entities become [KIND], terms that disclose
    ``remove`` or more are deleted, others become [WORD] or [NAME].

    A null text counts as empty, an empty table stays empty. A term within a base
    span is no span of its own. Repeated rows are treated alike; extra columns
    pass through (ones named like the added columns are replaced). A very long
    text is searched in time linear in its length. Map-side: no shuffle."""
    docs = docs.drop("spans", "sanitised")
    spark = docs.sparkSession
    blocks = list(_flagged_blocks(risky, remove, most)) if risky is not None else []
    rows = docs.withColumn("_kf_terms", F.lit(None).cast("array<struct<start:long,end:long,removed:boolean>>"))
    # one block is looked up in the pass that finds the entities; more take a pass each
    for block in blocks[1:]:
        rows = rows.mapInArrow(_term_pass(spark.sparkContext.broadcast(block)), rows.schema)
    held = spark.sparkContext.broadcast(blocks[0] if blocks else None)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(
        "spans array<struct<kind:string,start:long,end:long>>, sanitised string").fields])

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            names = batch.schema.names
            raw, off = text_buffers(batch.column(names.index("text")))
            for i, j in slices(off):
                part = batch.slice(i, j - i)
                extra = part.column(names.index("_kf_terms")).to_pylist()
                if held.value is not None:
                    _add_terms(raw, off[i:j + 1], held.value, extra)
                maybe = _maybe(raw, off[i:j + 1])
                spans, clean = [], []
                for r in range(j - i):
                    text = raw[off[i + r]:off[i + r + 1]].tobytes().decode()
                    own = base_spans(text) if maybe[r] else []
                    more = sorted((x["start"], x["end"], x["removed"]) for x in extra[r] or ())
                    more = _outside(more, own)
                    spans.append([dict(zip(("kind", "start", "end"), x, strict=True)) for x in [*own, *(("term", s, e) for s, e, _ in more)]])
                    clean.append(_sanitised(text, own, more) if own or more else text)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c, n in enumerate(names) if n != "_kf_terms"), pa.array(spans, kind), pa.array(clean, pa.string())],
                    [*(n for n in names if n != "_kf_terms"), "spans", "sanitised"])
    return rows.mapInArrow(run, schema)


def _outside(terms: list[tuple], spans: list[tuple]) -> list[tuple]:
    """Those of the sorted ``terms`` (start, end, ...) that overlap none of ``spans``."""
    out, at, reach = [], 0, -1
    ends = sorted((s, e) for _, s, e in spans)
    for term in terms:
        while at < len(ends) and ends[at][0] < term[1]:
            reach = max(reach, ends[at][1])
            at += 1
        if reach <= term[0]:
            out.append(term)
    return out


def _flagged_blocks(risky: DataFrame, remove: float, most: int):
    """Sorted term hashes with the flag that a term is deleted, in bounded blocks."""
    n = max(1, -(-risky.count() // most))
    for b in range(n):
        rows = sorted((r[0], r[1] >= remove) for r in risky.where(F.pmod(F.xxhash64("term"), F.lit(n)) == b).select("term", "disclosure").collect())
        if rows:
            yield np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], bool)


def _add_terms(raw: np.ndarray, off: np.ndarray, block, out: list) -> None:
    """Add the places of the block's terms, in code points, to ``out``, a list for each text."""
    wanted, removed = block
    start, end, h, first = _terms(raw, off)
    at = np.searchsorted(wanted, h)
    at[at == len(wanted)] = 0
    hit = np.flatnonzero(wanted[at] == h)
    row = np.searchsorted(first, hit, "right") - 1
    for t in np.unique(row):
        b = raw[off[t]:off[t + 1]]
        point = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])  # code points before each byte
        of = hit[row == t]
        out[t] = (out[t] or []) + [
            {"start": int(point[s]), "end": int(point[e]), "removed": bool(g)}
            for s, e, g in zip(start[of] - off[t], end[of] - off[t], removed[at[of]], strict=True)]


def _term_pass(held):
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("removed", pa.bool_())]))
        for batch in batches:
            names = batch.schema.names
            raw, off = text_buffers(batch.column(names.index("text")))
            for i, j in slices(off):
                part = batch.slice(i, j - i)
                terms = part.column(names.index("_kf_terms")).to_pylist()
                _add_terms(raw, off[i:j + 1], held.value, terms)
                yield pa.RecordBatch.from_arrays([pa.array(terms, kind) if n == "_kf_terms" else part.column(c) for c, n in enumerate(names)], names)
    return run


def _sanitised(text: str, own, more) -> str:
    marks = sorted([(s, e, f"[{k.upper()}]") for k, s, e in own]
                   + [(s, e, "" if gone else "[NAME]" if text[s].isupper() else "[WORD]") for s, e, gone in more])
    out, done = [], 0
    for s, e, mark in marks:
        if s >= done:
            out += [text[done:s], mark]
        done = max(done, e)
    return "".join([*out, text[done:]])


def op7_information_sanitisation(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = found(docs, risky_terms(docs))
    base = F.filter("spans", lambda x: x["kind"] != "term")
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
