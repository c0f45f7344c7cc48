"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question with other
values keeps its template. Template windows of the documents are hash-joined
with those of the benchmark items; matches along one alignment must fill every
slot consistently (one item value, one document value, and the other way
round). An item counts by the share of its windows, or by a long run of
consecutive words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.llm.common import slices, text_buffers

WINDOW = 8
MIN_COVER = 0.5
#: Consecutive words, equal or in consistent slots, that make a document hold an item.
RUN = 10
#: Benchmark words held by a task at once; a larger benchmark takes several passes.
BLOCK_WORDS = 2_000_000

#: Words taken as units when a number stands before them.
UNITS = ("km m cm mm mi mile miles meter meters metre metres foot feet inch inches yard yards kg g mg lb lbs oz pound pounds "
         "ton tons gram grams kilogram kilograms l ml liter liters litre litres gallon gallons s sec second seconds min minute "
         "minutes h hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur "
         "hz khz mhz w kw v c f degree degrees mph kmh").split()

MATCH = "array<struct<item_id:long,n_matched:long,n_windows:long,n_slots:long,n_changed:long>>"


def _word_bytes(b: np.ndarray) -> np.ndarray:
    """ASCII letters, digits, non-ASCII, and points or commas between digits."""
    from kpiforge.llm.tokens import ALNUM

    w = ALNUM[b]
    digit = (b >= 0x30) & (b <= 0x39)
    if len(b) > 2:
        w[1:-1] |= ((b[1:-1] == 0x2E) | (b[1:-1] == 0x2C)) & digit[:-2] & digit[2:]
    return w


def canonical(raw: np.ndarray, off: np.ndarray):
    """(template hashes, value hash, is a slot, first word of each text) of the
    words. A template for each reading: names in mid-sentence are slots; all
    capitalised words are; none is. The slots are those of the first reading."""
    from kpiforge.llm import tokens as K

    start, end, value, first = K.words(raw, off, _word_bytes)
    if not len(start):
        return [value] * 3, value, np.zeros(0, bool), first
    lead = raw[start]
    number = (lead >= 0x30) & (lead <= 0x39)
    digits = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(((raw >= 0x30) & (raw <= 0x39)) | (raw == 0x2E) | (raw == 0x2C), out=digits[1:])
    number &= digits[end] - digits[start] == end - start
    second = raw[np.minimum(start + 1, len(raw) - 1)]
    upper = ((lead >= 0x41) & (lead <= 0x5A) & ((second >= 0x61) & (second <= 0x7A) | (second >= 0x80))
             | (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)) & (end - start > 1)
    b1, b2 = raw[np.maximum(start - 1, 0)], raw[np.maximum(start - 2, 0)]
    lone = np.zeros(len(start) + 1, bool)
    lone[first] = True
    name = upper & ~lone[:-1] & (b1 == 0x20) & (K.ALNUM[b2] | (b2 == 0x2C))
    unit = np.isin(value, _unit_hashes())
    unit[0] = False
    unit[1:] &= number[:-1]
    unit &= ~lone[:-1]
    templates = []
    for names in (name, upper, np.zeros(len(start), bool)):
        template = value.copy()
        for kind, mask in ((1, number), (2, names), (3, unit)):
            template[mask] = K.U(kind)
        templates.append(template)
    return templates, value, number | name | unit, first


def readings(templates: list[np.ndarray], k: int):
    """(window hashes, windows to use) for each reading. The first is used
    throughout, the others where they differ from it. Windows whose words are
    for the most part slots say little: a capitalised word out of mid-sentence
    is a slot only where half of the words or more are none."""
    from kpiforge.llm import tokens as K

    plain = K.windows(templates[0], k)
    yield plain, np.ones(len(plain), bool)
    for template, name in zip(templates[1:], (True, False), strict=True):
        h = K.windows(template, k)
        use = h != plain
        if name and len(h):
            total = np.concatenate([[0], np.cumsum(template <= K.U(3))])
            use &= 2 * (total[k:] - total[:-k]) <= k
        yield h, use


def _unit_hashes() -> np.ndarray:
    from kpiforge.llm import tokens as K

    raw = " ".join(UNITS).encode()
    return K.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[2]


class Items:
    """Template windows of a block of benchmark items, for lookup in a task."""

    def __init__(self, rows: list[tuple[int, str]], window: int):
        from kpiforge.llm import tokens as K

        texts = [(t or "").encode() for _, t in rows]
        off = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        raw = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
        templates, self.value, self.slot, self.first = canonical(raw, off)
        self.ids = [i for i, _ in rows]
        n = np.diff(self.first)
        self.width = np.minimum(n, window)
        self.n_windows = n - self.width + 1
        hashes, item, at = [], [], []
        for k in np.unique(self.width[n > 0]):
            of = np.flatnonzero((self.width == k) & (n > 0))
            for h, use in readings(templates, int(k)):
                for i in of:
                    s, m = int(self.first[i]), int(self.n_windows[i])
                    hold = np.flatnonzero(use[s:s + m])
                    hashes.append(h[s + hold] ^ K.U(k))
                    item.append(np.full(len(hold), i))
                    at.append(hold)
        self.widths = [int(k) for k in np.unique(self.width[n > 0])]
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.item = (np.concatenate(item) if item else np.zeros(0, int))[order]
        self.at = (np.concatenate(at) if at else np.zeros(0, int))[order]
        self.distinct = np.unique(self.hash)

    def find(self, raw: np.ndarray, off: np.ndarray, min_cover: float, min_run: int | None = None) -> dict[int, list[tuple]]:
        """Matches (item_id, n_matched, n_windows, n_slots, n_changed) by text."""
        from kpiforge.llm import tokens as K

        templates, value, _, first = canonical(raw, off)
        hits: dict[int, dict[int, dict[int, set]]] = {}
        for k in self.widths:
            for every, use in readings(templates, k):
                place = np.flatnonzero(use)
                h = every[place] ^ K.U(k)
                at = np.searchsorted(self.distinct, h)
                at[at == len(self.distinct)] = 0
                for x in np.flatnonzero(self.distinct[at] == h):
                    p = place[x]
                    text = int(np.searchsorted(first, p, "right")) - 1
                    if p + k > first[text + 1]:
                        continue
                    for j in range(np.searchsorted(self.hash, h[x], "left"), np.searchsorted(self.hash, h[x], "right")):
                        i = int(self.item[j])
                        hits.setdefault(text, {}).setdefault(i, {}).setdefault(int(p - self.at[j]), set()).add(int(self.at[j]))
        out: dict[int, list[tuple]] = {}
        for text, items in hits.items():
            for i, lines in items.items():
                if found := self._consistent(i, lines, value, min_run):
                    matched, slots, changed, run = found
                    if matched >= min_cover * self.n_windows[i] or min_run and run >= min_run:
                        out.setdefault(text, []).append((int(self.ids[i]), matched, int(self.n_windows[i]), slots, changed))
        return {t: sorted(m) for t, m in out.items()}

    def _consistent(self, i: int, lines: dict[int, set], value, min_run: int | None):
        """Distinct windows of item ``i`` matched on alignments whose slots agree
        both ways; the slots filled and those with another value; the words of
        the longest run. With ``min_run``, an alignment with a conflict counts
        with its longest run without one."""
        s, k = int(self.first[i]), int(self.width[i])
        seen: set[int] = set()
        slots = changed = longest = 0
        for shift, ats in sorted(lines.items(), key=lambda x: (-len(x[1]), x[0])):
            words = sorted({a + x for a in ats for x in range(k)})
            pairs = {w: (x, y) for w in words if (x := int(self.value[s + w])) != (y := int(value[shift + w])) or self.slot[s + w]}
            there = _mapping(pairs.values())
            if there is not None or min_run:
                first, end = _longest_run(words, pairs)
                if there is None:
                    ats = [a for a in ats if first <= a and a + k <= end]
                    there = _mapping(p for w, p in pairs.items() if first <= w < end)
                longest = max(longest, end - first)
                if ats and not seen:
                    slots, changed = len(there), sum(x != y for x, y in there.items())
                seen.update(ats)
        return (len(seen), slots, changed, longest) if longest else None


def _mapping(pairs) -> dict | None:
    """The pairs as a mapping; None if one side of a pair has another partner elsewhere."""
    there: dict = {}
    back: dict = {}
    for x, y in pairs:
        if there.setdefault(x, y) != y or back.setdefault(y, x) != x:
            return None
    return there


def _longest_run(words: list[int], pairs: dict[int, tuple]) -> tuple[int, int]:
    """The longest stretch [first, end) of consecutive ``words`` whose ``pairs``
    agree both ways; the first of several."""
    best, first = (0, 0), words[0]
    there: dict = {}
    back: dict = {}
    before = words[0] - 1
    for w in words:
        if w != before + 1:
            first, there, back = w, {}, {}
        if w in pairs:
            x, y = pairs[w]
            # the last place where either value has another partner ends the stretch to the left
            for seen, a, b in ((there, x, y), (back, y, x)):
                for other, at in seen.get(a, {}).items():
                    if other != b:
                        first = max(first, at + 1)
                seen.setdefault(a, {})[b] = w
        if w + 1 - first > best[1] - best[0]:
            best = first, w + 1
        before = w
    return best


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """Blocks of (item_id, text), each of about ``block_words`` words or fewer.
    The size is counted first, so no block outgrows a task's memory however
    many items there are (one item is never split)."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    words = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(words) // (4 * block_words)))
    for b in range(n):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == b).collect()]


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_cover: float = MIN_COVER,
                      block_words: int = BLOCK_WORDS, min_run: int | None = None) -> DataFrame:
    """``docs`` with a column ``matches`` added: the benchmark items of which a
    document holds at least ``min_cover`` of the template windows of ``window``
    words, as (item_id, n_matched, n_windows, n_slots, n_changed); ``n_changed``
    counts slots with another value than the item has (0: a plain copy). With
    ``min_run`` also those of which it holds that many consecutive words (at
    least ``window``), equal or in consistent slots; where slots conflict, the
    longest run without a conflict counts instead of nothing.

    Items with fewer words count as one window of all their words. Null, empty
    and word-less texts match nothing; items without words or with a null id
    match nothing. Repeated rows and items are each reported. Extra columns
    pass through; one called ``matches`` is replaced. Map-side: no shuffle."""
    docs = docs.drop("matches")
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(f"_kf_found {MATCH}").fields])
    out = docs.withColumn("_kf_found", F.lit(None).cast(MATCH))
    spark = docs.sparkSession
    for rows in item_blocks(benchmark, block_words):
        held = spark.sparkContext.broadcast(rows)

        def run(batches, held=held):
            import pyarrow as pa

            items = Items(held.value, window)
            for batch in batches:
                names = batch.schema.names
                at_text, at_found = names.index("text"), names.index("_kf_found")
                raw, off = text_buffers(batch.column(at_text))
                found = batch.column(at_found).to_pylist()
                for i, j in slices(off):
                    part = raw[off[i]:off[j]]
                    for t, m in items.find(part, off[i:j + 1] - off[i], min_cover, min_run).items():
                        found[i + t] = (found[i + t] or []) + [
                            dict(zip(("item_id", "n_matched", "n_windows", "n_slots", "n_changed"), x, strict=True)) for x in m]
                kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "n_matched", "n_windows", "n_slots", "n_changed")]))
                columns = [*batch.columns]
                columns[at_found] = pa.array(found, kind)
                yield pa.RecordBatch.from_arrays(columns, names)
        out = out.mapInArrow(run, schema)
    return out.withColumnRenamed("_kf_found", "matches")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, nor RUN consecutive words
    of one; columns as they were. See :func:`benchmark_matches` for the cases."""
    return benchmark_matches(docs, benchmark, **{"min_run": RUN, **params}).where("matches is null").select(*docs.columns)


def op6_template_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    found = benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), min_run=RUN)
    return (found.where("matches is not null").select("doc_id", F.explode("matches").alias("m"))
            .select("doc_id", "m.item_id", "m.n_matched", "m.n_windows", "m.n_slots", "m.n_changed",
                    F.when(F.expr("m.n_changed = 0"), "copy").otherwise("reparameterised").alias("kind")))
