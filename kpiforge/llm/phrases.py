"""Collocations from depth-truncated suffix subtrees (vertical partitioning, as ERA does).

1. Word prefixes are counted level by level. Words come first; a prefix that
   occurs less often than a candidate must is not extended, since no candidate
   lies in its subtree.
2. The prefixes of two words that are left are packed into groups by the number
   of their leaves, up to a memory budget. A prefix over the budget is lengthened
   to its whole leaf, so that its subtree spreads over all groups.
3. Every text position below a kept prefix gives one suffix, cut off after four
   words, at the end of its piece and before a pair of words that is too rare.
   Equal suffixes of one slice of texts leave as one row with a count.
4. Each group builds its subtrees on its own: its suffixes are sorted, and the
   count of a phrase is the total of the leaves below it.
5. Scores, containment and ranks are joins over the table of frequent phrases.

Words travel as 64-bit symbols that stand for (language, word). The table of all
words shows whether two of them share a symbol; if so the job starts again with
another seed, so counts are exact. Two tables of fixed size (one bit per hash)
tell frequent words and pairs; a false positive only lets a row through that the
exact count removes later."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiforge.llm.common import slices, stored, text_buffers

MIN_COUNT, TOP, COVER, SCALE = 30, 2000, 80, 2_000_000
SLICE = 1 << 22  # bytes of texts counted at once
BITS = 25  # of the tables of frequent words and pairs
SLOT_BITS = 16  # prefixes are packed by slots of their hash
BUDGET = 1 << 20  # leaves of a group
SALTS = 64  # parts of a language's candidates that are ranked apart
GROUPS = 1 << 12  # beyond this number of groups the budget grows with the table

H = ["h1", "h2", "h3", "h4"]

# Pieces end at these, words at space and tab.
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False

_U = np.uint64


# ------------------------------------------------------------------ symbols
def _folded(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """The words at these places, lower-cased."""
    from kpiforge.llm import tokens as T

    if not len(start):
        return []
    base = int(start.min())
    data = T.FOLD[raw[base:int(end.max())]].tobytes()
    return [data[s:e] for s, e in zip((start - base).tolist(), (end - base).tolist(), strict=True)]


def _symbols(raw: np.ndarray, offsets: np.ndarray, langs: list[str], seed: int):
    """(symbol, piece number, first byte, end byte, text) of every word."""
    from xxhash import xxh64_intdigest

    from kpiforge.llm import tokens as T

    start, end, h, first = T.words(raw, offsets, WORD)
    if seed:
        h = np.array([xxh64_intdigest(w, seed) for w in _folded(raw, start, end)], _U)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    base = int(offsets[0])
    breaks = np.cumsum(BREAK[raw[base:int(offsets[-1])]], dtype=np.int64)
    piece = (breaks[start - base] if len(start) else np.zeros(0, np.int64)) + text
    own = {lang: xxh64_intdigest(lang, seed) for lang in set(langs)}
    symbol = T.mix(h ^ np.array([own[lang] for lang in langs], _U)[text])
    symbol[symbol == 0] = _U(1)  # 0 stands for no word
    return symbol, piece, start, end, text


def _sliced(batches, seed: int):
    for batch in batches:
        langs = batch.column(0).to_pylist()
        raw, off = text_buffers(batch.column(1))
        for i, j in slices(off, SLICE):
            yield raw, langs[i:j], _symbols(raw, off[i:j + 1], langs[i:j], seed)


def _long(x: np.ndarray):
    import pyarrow as pa
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(h1, lang, word, f) of every word."""
    def run(batches):
        import pyarrow as pa

        for raw, langs, (symbol, _, start, end, text) in _sliced(batches, seed):
            h, at, n = np.unique(symbol, return_index=True, return_counts=True)
            words = _folded(raw, start[at], end[at])
            yield pa.RecordBatch.from_arrays(
                [_long(h), pa.array([langs[t] for t in text[at].tolist()], pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)],
                ["h1", "lang", "word", "n"])
    return texts.mapInArrow(run, "h1 long, lang string, word string, n long").groupBy("h1", "lang", "word").agg(F.sum("n").alias("f"))


# ------------------------------------------------------------------ frequent prefixes
def pair_hash(a, b):
    """Of two symbols, the same in Spark columns and numpy arrays."""
    if isinstance(a, Column):
        return a.bitwiseXOR(F.shiftleft(b, 1).bitwiseOR(F.shiftrightunsigned(b, 63)))
    return a ^ ((b << _U(1)) | (b >> _U(63)))


def bit_table(df: DataFrame, h: Column) -> np.ndarray:
    """One bit for the leading BITS bits of each hash; 2^BITS / 8 bytes at most
    come to the driver, whatever the rows."""
    place = F.shiftrightunsigned(h, 64 - BITS)
    words = (df.groupBy(F.shiftright(place, 6).alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow())
    table = np.zeros(1 << (BITS - 6), _U)
    table[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(_U)
    return table


def _in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> _U(64 - BITS)
    return (table[place >> _U(6)] >> (place & _U(63)) & _U(1)).astype(bool)


def pair_counts(texts: DataFrame, frequent, seed: int) -> DataFrame:
    """(h1, h2, f) of neighbouring words of a piece, both in the broadcast ``frequent``."""
    def run(batches):
        import pyarrow as pa

        for _, _, (symbol, piece, *_rest) in _sliced(batches, seed):
            ok = _in(frequent.value, symbol)
            at = np.flatnonzero(ok[:-1] & ok[1:] & (piece[:-1] == piece[1:]))
            names, number = np.unique(symbol, return_inverse=True)
            pairs, n = np.unique(number[at] * len(names) + number[at + 1], return_counts=True)
            if len(n):
                yield pa.RecordBatch.from_arrays([_long(names[pairs // len(names)]), _long(names[pairs % len(names)]), pa.array(n)], ["h1", "h2", "n"])
    return texts.mapInArrow(run, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("f"))


def packed_groups(pairs: DataFrame, budget: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(group of each hash slot, number of groups, hashes of the pairs over the
    budget): neighbouring slots share a group until the budget is full. At most
    2^SLOT_BITS totals and GROUPS hashes come to the driver."""
    h = pair_hash(F.col("h1"), F.col("h2"))
    slots = pairs.groupBy(F.shiftrightunsigned(h, 64 - SLOT_BITS).alias("slot")).agg(F.sum("f").alias("f")).toArrow()
    size = np.zeros(1 << SLOT_BITS, np.float64)
    size[slots.column("slot").to_numpy()] = slots.column("f").to_numpy()
    budget = max(budget, int(size.sum()) // GROUPS)
    over = pairs.where(F.col("f") > budget).select(h.alias("h"), "f").toArrow()
    hashes = np.sort(over.column("h").to_numpy().view(_U))
    loads = over.column("f").to_numpy()
    np.subtract.at(size, (over.column("h").to_numpy().view(_U) >> _U(64 - SLOT_BITS)).astype(np.int64), loads)
    size += loads.sum() / len(size)  # their leaves spread over all slots
    before = np.cumsum(size) - size
    group = (before // budget).astype(np.int32)
    return group, int(group[-1]) + 1, hashes


# ------------------------------------------------------------------ subtrees
def suffixes(texts: DataFrame, tables, seed: int) -> DataFrame:
    """(grp, split, h1..h4, n): the truncated suffixes below the kept prefixes
    (0: no word), equal ones of a slice counted; ``split`` marks prefixes over
    the budget. ``tables`` holds (pairs, group of slot, hashes over the budget)."""
    def run(batches):
        import pyarrow as pa

        from kpiforge.llm import tokens as T

        kept, group, over = tables.value
        for _, _, (symbol, piece, *_rest) in _sliced(batches, seed):
            n = len(symbol)
            if n < 2:
                continue
            two = np.zeros(n + 2, bool)
            h = pair_hash(symbol[:-1], symbol[1:])
            two[:n - 1] = _in(kept, h) & (piece[:-1] == piece[1:])
            at = np.flatnonzero(two)
            if not len(at):
                continue
            three = two[at + 1]
            four = three & two[at + 2]
            # exact numbers for words, pairs and whole suffixes of the slice
            names, number = np.unique(symbol, return_inverse=True)
            _, pair = np.unique(number[at] * len(names) + number[at + 1], return_inverse=True)
            n_pairs = int(pair.max()) + 1
            pair_at = np.zeros(n, np.int64)
            pair_at[at] = pair
            last = n - 1
            rest = np.where(four, 1 + len(names) + pair_at[np.minimum(at + 2, last)],
                            np.where(three, 1 + number[np.minimum(at + 2, last)], 0))
            _, where, count = np.unique(pair * (1 + len(names) + n_pairs) + rest, return_index=True, return_counts=True)
            at, three, four = at[where], three[where], four[where]
            h3 = np.where(three, symbol[np.minimum(at + 2, last)], _U(0))
            h4 = np.where(four, symbol[np.minimum(at + 3, last)], _U(0))
            h = h[at]
            split = np.isin(h, over)
            whole = T.mix(h ^ T.mix(h3 ^ T.mix(h4)))
            slot = np.where(split, whole, h) >> _U(64 - SLOT_BITS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[slot]), pa.array(split), _long(symbol[at]), _long(symbol[at + 1]), _long(h3), _long(h4), pa.array(count)],
                ["grp", "split", *H, "n"])
    return texts.mapInArrow(run, "grp int, split boolean, h1 long, h2 long, h3 long, h4 long, n long")


def subtree_counts(leaves: DataFrame, n_groups: int, min_count: int) -> DataFrame:
    """(h1..h4, f) of all phrases of 2 to 4 words with f >= ``min_count``: one
    task per group sorts its suffixes, and each inner node sums its leaves. A
    node at the edge of a batch, or split over groups, leaves with what is
    there; the sum over these is exact."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            split = batch.column(0).to_numpy(zero_copy_only=False)
            h = [batch.column(c).to_numpy() for c in range(1, 5)]
            n = batch.column(5).to_numpy()
            new = np.ones(rows, bool)
            new[1:] = h[0][1:] != h[0][:-1]
            for depth in (2, 3, 4):
                new[1:] |= h[depth - 1][1:] != h[depth - 1][:-1]
                first = np.flatnonzero(new)
                total = np.add.reduceat(n, first)
                open_ = np.zeros(len(first), bool)
                open_[[0, -1]] = True
                keep = (h[depth - 1][first] != 0) & (open_ | split[first] | (total >= min_count))
                first, total = first[keep], total[keep]
                none = pa.array(np.zeros(len(first), np.int64))
                yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in h[:depth]], *[none] * (4 - depth), pa.array(total)], [*H, "f"])
    sorted_rows = leaves.repartitionById(n_groups, "grp").sortWithinPartitions(*H).select("split", *H, "n")
    return (sorted_rows.mapInArrow(run, "h1 long, h2 long, h3 long, h4 long, f long")
            .groupBy(*H).agg(F.sum("f").alias("f")).where(F.col("f") >= min_count))


# ------------------------------------------------------------------ scores
def _phrase(*symbols: str) -> str:
    cells = [*symbols, *["0L"] * (4 - len(symbols))]
    return ", ".join(f"{c} AS {n}" for c, n in zip(cells, H, strict=True))


def scored(phrases: DataFrame, cover: int) -> DataFrame:
    """Candidates (h1..h4, a, l, r, score) that no longer one covers; ``phrases``
    is stored and holds every phrase of 1 to 4 words that is frequent enough."""
    candidates = phrases.where("h2 <> 0").withColumnRenamed("f", "a")
    cuts = candidates.selectExpr(*H, "a", f"""inline(array(
        named_struct('cut', 1, 'x', struct({_phrase('h1')}), 'y', struct({_phrase('h2', 'h3', 'h4')})),
        named_struct('cut', 2, 'x', struct({_phrase('h1', 'h2')}), 'y', struct({_phrase('h3', 'h4')})),
        named_struct('cut', 3, 'x', struct({_phrase('h1', 'h2', 'h3')}), 'y', struct({_phrase('h4')}))))""")
    cuts = cuts.where("y.h1 <> 0")

    def part(name, count):
        return phrases.select(*[F.col(c).alias(f"{name}{c}") for c in H], F.col("f").alias(count))
    both = (cuts.selectExpr(*H, "a", "cut", *[f"{s}.{c} AS {s}{c}" for s in "xy" for c in H])
            .join(part("x", "l"), [f"x{c}" for c in H]).join(part("y", "r"), [f"y{c}" for c in H]))
    score = F.expr(f"(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = (both.groupBy(*H, "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
              .select(*H, "a", "low.l", "low.r", "low.score"))
    inner = phrases.where("h3 <> 0").selectExpr("f", f"""inline(array(
        struct({_phrase('h1', 'h2')}), struct({_phrase('h2', 'h3')}),
        CASE WHEN h4 <> 0 THEN struct({_phrase('h3', 'h4')}) END,
        CASE WHEN h4 <> 0 THEN struct({_phrase('h1', 'h2', 'h3')}) END,
        CASE WHEN h4 <> 0 THEN struct({_phrase('h2', 'h3', 'h4')}) END))""").where("h1 IS NOT NULL")
    longest = inner.groupBy(*H).agg(F.max("f").alias("longer"))
    covered = F.expr(f"CAST(longer AS DECIMAL(20,0)) * 100 >= CAST(a AS DECIMAL(20,0)) * {int(cover)}")
    return lowest.join(longest, H, "left").where(F.col("longer").isNull() | ~covered).drop("longer")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, cover: int = COVER, budget: int = BUDGET,
                 seed: int = 0) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Texts of ``docs(lang, text)`` are lower-cased (A-Z) and split at
    ``[.,;:!?\\x0A-\\x0D]`` into pieces, these at space and tab into words. ``n``
    counts the words of a language, ``a`` the occurrences of a phrase of 2 to 4
    words within pieces, overlaps included; a candidate has a >= ``min_count``.
    Of its cuts into two parts, with ``l`` and ``r`` occurrences, the one of the
    lowest score floor(2000000 * a / (l + r)) counts (ties: the first). A
    candidate goes if a longer one holds it and 100 * f(longer) >= ``cover`` * a.
    The order is by score and a, both descending, then the phrase by its bytes.

    Null lang: ``und``. Null, empty or blank text: no words. Repeated rows count
    as often as they occur; an empty table, or no candidate, gives no rows;
    extra columns are ignored. A very long text is counted by one task, whose
    memory is some 40 times the text."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    while True:
        words = stored(word_counts(texts, seed), "words")
        if not words.groupBy("h1").count().where("count > 1").limit(1).count():
            break
        seed += 1
    common = words.where(F.col("f") >= min_count)
    share = spark.sparkContext.broadcast
    frequent = share(bit_table(common, F.col("h1")))
    pairs = stored(pair_counts(texts, frequent, seed).where(F.col("f") >= min_count), "pairs")
    group, n_groups, over = packed_groups(pairs, budget)
    tables = share((bit_table(pairs, pair_hash(F.col("h1"), F.col("h2"))), group, over))
    tree = subtree_counts(suffixes(texts, tables, seed), n_groups, min_count)
    zero = F.lit(0).cast("long")
    phrases = stored(common.select("h1", zero.alias("h2"), zero.alias("h3"), zero.alias("h4"), "f").unionByName(tree), "phrases")
    found = scored(phrases, cover)
    for place, h in enumerate(H, 1):
        name = common.select(F.col("h1").alias(h), F.col("word").alias(f"w{place}"), *(["lang"] if place == 1 else []))
        found = found.join(name, h, "inner" if place == 1 else "left")
    found = found.select("lang", F.concat_ws(" ", "w1", "w2", "w3", "w4").alias("phrase"), "a", "l", "r", "score")
    # the best of each of SALTS parts first: the last sort of a language sees SALTS * top rows, whatever the table
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_era_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, row_number() OVER () AS id, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS ws FROM pieces),
words AS (SELECT lang, id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
ahead AS (
  SELECT lang, w AS w1, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY id ORDER BY i)),
leaves AS MATERIALIZED (SELECT lang, w1, w2, w3, w4, count(*) AS f FROM ahead GROUP BY ALL),
grams AS (
  SELECT lang, k, CASE k WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3
                         ELSE w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END AS phrase, sum(f) AS f
  FROM leaves, (VALUES (1), (2), (3), (4)) AS v(k) WHERE CASE k WHEN 1 THEN w1 WHEN 2 THEN w2 WHEN 3 THEN w3 ELSE w4 END IS NOT NULL
  GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE f >= 30),
parts AS MATERIALIZED (
  SELECT lang, phrase, f, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM often JOIN (VALUES (1), (2), (3)) AS c(cut) ON cut < k),
cuts AS (
  SELECT p.lang, p.phrase, p.f AS a, p.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * p.f) // (x.f::HUGEINT + y.f) AS score
  FROM parts p JOIN often x ON x.lang = p.lang AND x.phrase = p.head JOIN often y ON y.lang = p.lang AND y.phrase = p.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM often JOIN (VALUES (2), (3)) AS v(m) ON m < k)
  GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
