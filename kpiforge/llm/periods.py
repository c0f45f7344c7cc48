"""Periodic runs of words, found from Lyndon groups (Baier grouping).

1. Where a run of period q can lie at all is read from the distance of every
   word to its next occurrence: in a run with at least ``repeats`` periods, the
   words of all but its last period recur within q. Stretches of such words,
   taken for every doubling of q and joined, are the zones; a run lies within
   one zone as a whole, and words outside take no further part.
2. Phase one of Baier's suffix sorter groups the suffixes of a zone by their
   longest Lyndon prefix. Groups are taken from the highest down; each member
   points at the nearest position before it that no group has reached yet, and
   the positions pointed at move up from their group by the number of pointers:
   their prefix has grown by as many copies of the group's. The prefix lengths
   are the Lyndon array.
3. Under one of the two orders of the words, every occurrence of a run's Lyndon
   root is the longest Lyndon prefix at its place. So chains of equal groups at
   the distance of their length are the candidates, and each is extended to
   both sides by its longest common extension into the maximal run."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import slices, text_buffers

REPEATS, MIN_WORDS = 4, 6

Rewrite = Callable[[int, int], "np.ndarray | None"]


# ------------------------------------------------------------------ Lyndon groups
def lyndon_groups(x: list[int]) -> tuple[list[int], list[int]]:
    """For each position of ``x`` (symbols 0, 1, ...) the length of the longest
    Lyndon word that begins there, and the number of its group; equal words have
    equal groups. Time is close to linear in ``len(x)``."""
    n = len(x)
    symbols = max(x) + 1 if n else 0
    members: list[list[int]] = [[] for _ in range(symbols)]
    for i, c in enumerate(x):
        members[c].append(i)
    length = [1] * symbols
    above = list(range(1, symbols + 1))
    if symbols:
        above[-1] = -1
    below = list(range(-1, symbols - 1))
    group = list(x)
    # place p stands for position p - 1; place 0 is never reached
    reached = bytearray(n + 1)
    before = list(range(-1, n))
    g = symbols - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            reached[i + 1] = 1
        pointers: dict[int, int] = {}
        for i in own:
            p = i
            while reached[p]:
                up = before[p]
                if reached[up]:
                    before[p] = up = before[up]
                p = up
            before[i + 1] = p
            if p:
                pointers[p - 1] = pointers.get(p - 1, 0) + 1
        moves: dict[tuple[int, int], list[int]] = {}
        for j, count in pointers.items():
            moves.setdefault((count, group[j]), []).append(j)
        for (count, old), places in sorted(moves.items(), reverse=True):
            new = len(members)
            members.append(places)
            length.append(length[old] + count * length[g])
            for j in places:
                group[j] = new
            over = above[old]
            above.append(over)
            below.append(old)
            above[old] = new
            if over >= 0:
                below[over] = new
        g = below[g]
    return [length[k] for k in group], group


# ------------------------------------------------------------------ runs of one text
def zones(word: np.ndarray, first: np.ndarray, repeats: int = REPEATS, least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Ranges (start, end) of words that hold all runs of the texts; ``word``
    numbers the words of all texts end to end (equal numbers may stand for
    unequal words), ``first`` is each text's first word, and the end."""
    n = len(word)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((word, text))
    again = (word[order[1:]] == word[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    gap = np.full(n, n + 1, np.int64)
    gap[order[:-1][again]] = (order[1:] - order[:-1])[again]
    end_of = first[1:][text]
    cover = np.zeros(n + 1, np.int64)
    high = 1
    while (repeats - 1) * (high // 2 + 1) < n:  # periods in (high / 2, high]
        low = high // 2 + 1
        near = np.concatenate([[False], gap <= high, [False]])
        change = np.flatnonzero(near[1:] != near[:-1])
        s, e = change[::2], change[1::2]
        keep = e - s >= max((repeats - 1) * low, least - high)
        s, e = s[keep], e[keep]
        if len(s):
            # the last period of a run need not recur; no stretch leaves its text but for this tail
            e = np.minimum(e + high, end_of[e - 1])
            np.add.at(cover, s, 1)
            np.add.at(cover, e, -1)
        high *= 2
    covered = np.cumsum(cover[:-1]) > 0
    edge = np.zeros(n + 1, bool)
    edge[first] = True  # zones of neighbouring texts that touch stay apart
    starts = np.flatnonzero(covered & (edge[:-1] | ~np.concatenate([[False], covered[:-1]])))
    ends = np.flatnonzero(covered & (edge[1:] | ~np.concatenate([covered[1:], [False]]))) + 1
    return starts, ends


def _ahead(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        to = min(at + step, n)
        unequal = np.flatnonzero(a[at:to] != b[at:to])
        if len(unequal):
            return at + int(unequal[0])
        at, step = to, 2 * step
    return n


def runs_of(x: np.ndarray, repeats: int = REPEATS, least: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``x`` (symbols 0, 1, ...)
    of at least ``repeats`` periods and ``least`` words, by start, then period."""
    n = len(x)
    found: dict[tuple[int, int], int] = {}
    if n < max(repeats, least):
        return []
    top = int(x.max())
    for order in (x, top - x):
        length, group = (np.array(v) for v in lyndon_groups(order.tolist()))
        at = np.arange(n)
        ok = at + (repeats - 1) * length <= n
        for t in range(1, repeats - 1):
            ok &= group[np.minimum(at + t * length, n - 1)] == group
        # of a chain of equal roots only the first is extended
        back = at - length
        ok &= (back < 0) | (group[np.maximum(back, 0)] != group)
        for i in np.flatnonzero(ok).tolist():
            q = int(length[i])
            end = i + q + _ahead(x[i:n - q], x[i + q:])
            start = i - _ahead(x[:i][::-1], x[:i + q][::-1])
            if end - start >= max(least, repeats * q):
                found[(start, q)] = end - start
    return sorted((s, size, q) for (s, q), size in found.items())


def _as_numbers(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


SCHEMA = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The columns of SCHEMA after ``doc_id``."""
    best = (None, None, None, None)
    if runs:
        s, size, q = runs[0]
        for run in runs[1:]:  # by start, then period: only a greater exponent takes over
            if run[1] * q > size * run[2]:
                s, size, q = run
        best = (s, size, q, 1000 * size // q)
    dropped = np.zeros(len(words) + 1, np.int64)
    for s, size, q in runs:
        dropped[s + q] += 1
        dropped[s + size] -= 1
    if runs:
        gone = np.cumsum(dropped)
        kept = b" ".join([w for w, d in zip(words, gone[:-1].tolist(), strict=True) if not d])
    else:
        kept = b" ".join(words)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (len(words), len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
            [{"start": s, "length": size, "period": q} for s, size, q in runs], kept.decode())


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, repeats: int = REPEATS, least: int = MIN_WORDS,
                  with_text: bool = True) -> DataFrame:
    """One row of SCHEMA per row of ``docs(doc_id, text)``.

    Words are runs of non-blank characters (space and 0x09 to 0x0D are blank),
    numbered from 0 and compared as they stand. A run is a stretch of words of
    smallest period q (words q apart are equal), of at least ``repeats`` * q and
    ``least`` words, that no neighbouring word extends. The four columns after
    ``n_runs`` are of the run with the greatest length / period (ties: smallest
    start, then period). A word is dropped if a run holds it after its first q
    words; ``collapsed`` joins the others by a space, ``runs`` lists the runs by
    start, then period. ``with_text=False`` leaves ``runs`` and ``collapsed`` null.

    ``rewrite(doc_id, n)`` may give the numbers of the words to take in place of
    0 to n - 1 (None: no change).

    Null, empty or blank text: no words, no runs, four nulls. A null ``doc_id``
    is never rewritten. Repeated rows give repeated results, an empty table an
    empty table; extra columns are ignored. A very long text is searched by one
    task; its time is close to linear in its words, times a logarithm."""
    def run(batches):
        import pyarrow as pa

        from kpiforge.llm import tokens as T

        types = [("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
                 ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
                 ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())]
        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            data = memoryview(raw)
            ids = batch.column(0).to_pylist()
            for i, j in slices(off):
                texts = [bytes(data[off[r]:off[r + 1]]).split() for r in range(i, j)]
                _, _, h, first = T.words(raw, off[i:j + 1])
                for r in range(i, j):
                    take = None
                    if rewrite is not None and ids[r] is not None:
                        take = rewrite(ids[r], len(texts[r - i]))
                    if take is not None:
                        texts[r - i] = [texts[r - i][t] for t in take.tolist()]
                        s, e = int(first[r - i]), int(first[r - i + 1])
                        h[s:e] = h[s:e][take]
                starts, ends = zones(h, first, repeats, least)
                runs: list[list] = [[] for _ in texts]
                for s, e, d in zip(starts.tolist(), ends.tolist(), (np.searchsorted(first, starts, "right") - 1).tolist(), strict=True):
                    s, e = s - int(first[d]), e - int(first[d])
                    runs[d] += [(s + a, size, q) for a, size, q in runs_of(_as_numbers(texts[d][s:e]), repeats, least)]
                rows = [described(w, r) for w, r in zip(texts, runs, strict=True)]
                if not with_text:
                    rows = [(*r[:-2], None, None) for r in rows]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)]],
                    ["doc_id", *[name for name, _ in types]])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def repeated_tail(doc_id: int, n: int) -> np.ndarray | None:
    """The planted repetition of the query: in a tenth of the documents, by the
    CRC-32 of the id, the words from some place on repeat with one period."""
    import zlib

    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or n == 0:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    take = np.arange(n)
    take[a:] = a + (take[a:] - a) % p
    return take


def op13_baier_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return periodic_runs(docs, repeated_tail, with_text=False).drop("n_words", "runs", "collapsed")


#: Equal words at every distance, their stretches, and the smallest period of each.
OP13_SQL = """
WITH bytes AS (
  SELECT [list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
          FOR x IN range(256)] AS tab),
base AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS ws,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
               lambda s, c: xor(tab[1 + (xor(s, c) & 255)], s >> 8))) AS h
  FROM documents, bytes),
sized AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g FROM base),
tailed AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized),
folded AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
           THEN [ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] ELSE ws END AS ws
  FROM tailed),
pos AS (SELECT doc_id, n, unnest(ws) AS w, unnest(range(n)) AS i FROM folded),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM pos x JOIN pos y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS size
  FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches r WHERE NOT EXISTS (
    SELECT 1 FROM stretches m WHERE m.doc_id = r.doc_id AND m.q < r.q AND r.q % m.q = 0 AND m.s <= r.s AND m.s + m.size >= r.s + r.size)),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size::DOUBLE / q DESC, s, q) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words FROM pos ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.size AS length, b.q AS period, 1000 * b.size // b.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
