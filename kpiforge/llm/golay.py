"""SimHash near-duplicates with Golay-code fuzzy keys.

1. Every text gets a 64-bit fingerprint: a bit is set where over half of the
   hashes of its word shingles (repeats included) have it. Equal fingerprints
   collapse to one row.
2. A fingerprint is cut into three segments of 22, 21 and 21 bits. Each segment
   is a word of the perfect binary Golay code [23, 12, 7]; its keys are the
   indices of all codewords within 4 bits. These are one (up to 2 bits from the
   nearest codeword) or six (3 bits from it), and two segments that differ in at
   most 2 bits always share one (any 4 places lie in exactly one codeword of
   weight 7).
3. Pigeonhole: with at most 4 differing bits, either some segment is equal and
   another differs in at most 2 bits, or every segment differs in at most 2.
   So rows meet on (equal segment, key of another segment), six tables of 33
   to 34 bits, or on the keys of all three segments, one table of 36 bits.
4. The keyed rows are sorted over the whole cluster by key (range partitions)
   and every run of one key is searched breadth first with exact distances; only
   the links that join something new leave the task.
5. A key that more than ``RUN`` fingerprints share is not compared by pairs: its
   fingerprints are exploded to all words within 2 bits, and rows that meet on
   such a word are chained. Two fingerprints within 4 bits share a word within 2
   bits of both, and two that share one are within 4 bits; no more than 2,081
   can share one. The same links come out, at a cost linear in the rows.

No link is lost: neither step has a cap or a chance in it."""

from __future__ import annotations

import functools
import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiforge.llm.common import stored, text_buffers
from kpiforge.llm.components import connected_components

WIDTHS = (22, 21, 21)
MOST = 4  # differing bits of a link
SEED = 42
RUN = 8192  # fingerprints of one key that one task compares
CHUNK = 1 << 15  # shingles hashed at a time
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the Golay code

_U = np.uint64


# ------------------------------------------------------------------ fingerprints
def fingerprint_of(words: list[bytes], k: int) -> bytes:
    """The 8 bytes, highest bit first; zero without words."""
    from xxhash import xxh64_digest

    if not words:
        return bytes(8)
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - k + 1, 1)
    starts, ends = starts[:n].tolist(), ends[min(k, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for c in range(0, n, CHUNK):
        digests = b"".join([xxh64_digest(text[s:e], SEED) for s, e in zip(starts[c:c + CHUNK], ends[c:c + CHUNK], strict=True)])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * ones > n).tobytes()


def fingerprints(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, fp) of every row of ``docs(doc_id, text)``; ``fp`` is the
    fingerprint as a signed long."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw, off = text_buffers(batch.column(1))
            data = memoryview(raw)
            # bytes.split() splits at space and 0x09 to 0x0D, bytes.lower() folds A to Z only
            fps = b"".join([fingerprint_of(bytes(data[s:e]).lower().split(), k) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.frombuffer(fps, ">i8").astype(np.int64))], ["doc_id", "fp"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ the code
@functools.cache
def code_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(check bits of each 12-bit index, nearest error of each syndrome, the
    other errors of weight 4 of each syndrome or -1)."""
    def remainder(word):
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    check = np.array([remainder(i << 11) for i in range(1 << 12)], np.int32)
    light = {0: 0}
    heavy: dict[int, list[int]] = {}
    places = [(1 << p, remainder(1 << p)) for p in range(23)]
    for weight in range(1, 5):
        for chosen in itertools.combinations(places, weight):
            error = sum(p for p, _ in chosen)
            syndrome = functools.reduce(lambda a, b: a ^ b, (r for _, r in chosen))
            if weight < 4:
                light[syndrome] = error
            else:
                heavy.setdefault(syndrome, []).append(error)
    near = np.array([light[s] for s in range(1 << 11)], np.int32)
    other = np.array([heavy.get(s, [-1] * 5) for s in range(1 << 11)], np.int32)
    return check, near, other


def segment_keys(segment: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each segment: 6 columns, -1
    where there is only one."""
    check, near, other = code_tables()
    syndrome = (segment & 0x7FF) ^ check[segment >> 11]
    keys = np.empty((len(segment), 6), np.int64)
    keys[:, 0] = (segment ^ near[syndrome]) >> 11
    more = other[syndrome]
    keys[:, 1:] = np.where(more < 0, -1, (segment[:, None] ^ more) >> 11)
    return keys


def keys_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, index into ``fp``) of every key of every fingerprint."""
    x = fp.view(_U)
    shift, parts = 64, []
    for width in WIDTHS:
        shift -= width
        parts.append(((x >> _U(shift)) & _U((1 << width) - 1)).astype(np.int64))
    codes = [segment_keys(p) for p in parts]
    keys, at = [], []
    for table, (i, j) in enumerate(itertools.permutations(range(3), 2)):
        row, col = np.nonzero(codes[j] >= 0)
        keys.append((table << 40) + (parts[i][row] << 12) + codes[j][row, col])
        at.append(row)
    # all three: combinations of the columns that hold a key
    for a, b, c in itertools.product(range(6), repeat=3):
        row = np.flatnonzero((codes[0][:, a] >= 0) & (codes[1][:, b] >= 0) & (codes[2][:, c] >= 0))
        keys.append((6 << 40) + (codes[0][row, a] << 24) + (codes[1][row, b] << 12) + codes[2][row, c])
        at.append(row)
    return np.concatenate(keys), np.concatenate(at)


def keyed_rows(reps: DataFrame) -> DataFrame:
    """(key, fp): one row per fingerprint and key, about 180 of a fingerprint."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for s in range(0, len(fps), 1 << 12):
                fp = np.ascontiguousarray(fps[s:s + (1 << 12)])
                key, at = keys_of(fp)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[at])], ["key", "fp"])
    return reps.select("fp").mapInArrow(run, "key long, fp long")


# ------------------------------------------------------------------ links
def linked(x: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices) of a spanning forest of the fingerprints ``x``: breadth
    first, each found row is compared once with the rows not yet found."""
    left = np.arange(len(x))
    a, b = [], []
    while len(left) > 1:
        front = [int(left[0])]
        left = left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(x[left] ^ x[at]) <= most
            if near.any():
                new = left[near]
                left = left[~near]
                front.extend(new.tolist())
                a.append(np.full(len(new), at))
                b.append(new)
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def links_in_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the rows (sorted by key) that share a key."""
    x = fp.view(_U)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    a, b = [], []
    short = np.repeat(size <= 4, size)
    for step in range(1, 4):
        at = np.flatnonzero((key[:-step] == key[step:]) & short[:-step])
        at = at[np.bitwise_count(x[at] ^ x[at + step]) <= MOST]
        a.append(at)
        b.append(at + step)
    for r in np.flatnonzero(size > 4):
        s, e = first[r], first[r] + size[r]
        p, q = linked(x[s:e])
        a.append(p + s)
        b.append(q + s)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(fp[a], fp[b]), np.maximum(fp[a], fp[b])


LINK, EDGE, LONG = 0, 1, 2


def scan_runs(keyed: DataFrame, most_rows: int = RUN) -> DataFrame:
    """Rows (kind, key, a, b) from the globally sorted ``keyed(key, fp)``.

    LINK: ``a`` and ``b`` are linked. EDGE: ``a`` lies in the first or last run
    of its partition, which may go on in the next one. LONG: ``a`` lies in a run
    of more than ``most_rows`` rows. At most ``most_rows`` rows and one batch
    are held."""
    def run(batches):
        import pyarrow as pa

        def out(kind, key, a, b):
            n = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, kind, np.int32)), pa.array(np.broadcast_to(key, n).astype(np.int64)), pa.array(a), pa.array(b)],
                ["kind", "key", "a", "b"])

        held_key, held = None, []  # the last run so far, as long as it may be short
        n_held, n_runs = 0, 0

        def close(is_last):
            fp = np.concatenate(held) if held else np.zeros(0, np.int64)
            if n_held > most_rows:
                return None  # already out, row by row
            if n_runs == 0 or is_last:
                return out(EDGE, held_key, fp, fp)
            a, b = links_in_runs(np.zeros(len(fp), np.int64), fp)
            return out(LINK, 0, a, b)

        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(key):
                continue
            if held_key is not None and key[0] != held_key:
                done = close(False)
                if done is not None and done.num_rows:
                    yield done
                held_key, held, n_held, n_runs = None, [], 0, n_runs + 1
            # rows of the run that is open at the batch's start, and of the one open at its end
            head = int(np.searchsorted(key, key[0], "right"))
            tail = int(np.searchsorted(key, key[-1], "left"))
            spans = [(0, head)] if tail == 0 else [(0, head), (tail, len(key))]
            for s, e in spans:
                if held_key is not None and key[s] != held_key:
                    done = close(False)
                    if done is not None and done.num_rows:
                        yield done
                    held, n_held, n_runs = [], 0, n_runs + 1
                    if head < tail:  # whole runs inside the batch
                        mk, mf = key[head:tail], fp[head:tail]
                        sizes = np.diff(np.append(np.flatnonzero(np.concatenate([[True], mk[1:] != mk[:-1]])), len(mk)))
                        big = np.repeat(sizes > most_rows, sizes)
                        if big.any():
                            yield out(LONG, mk[big], mf[big], mf[big])
                        a, b = links_in_runs(mk[~big], mf[~big])
                        if len(a):
                            yield out(LINK, 0, a, b)
                held_key = key[s]
                before = n_held
                n_held += e - s
                if n_held > most_rows:
                    rows = np.concatenate([*held, fp[s:e]]) if before <= most_rows else fp[s:e]
                    held = []
                    yield out(LONG, held_key, rows, rows)
                else:
                    held.append(fp[s:e])
        if held_key is not None:
            done = close(True)
            if done is not None and done.num_rows:
                yield done
    return keyed.mapInArrow(run, "kind int, key long, a long, b long")


def group_links(rows: DataFrame) -> DataFrame:
    """Links among the rows (key, a) of each key; no key has more than RUN rows."""
    def run(table):
        import pyarrow as pa

        fp = np.unique(table.column("a").to_numpy())
        a, b = links_in_runs(np.zeros(len(fp), np.int64), fp)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return rows.groupBy("key").applyInArrow(run, "a long, b long")


def ball_links(fps: DataFrame) -> DataFrame:
    """All links among ``fps(fp)`` without comparing pairs: chains of those that
    share a word within 2 bits."""
    bits = _U(1) << np.arange(64, dtype=_U)
    i, j = np.triu_indices(64, 1)
    masks = np.concatenate([np.zeros(1, _U), bits, bits[i] | bits[j]])

    def explode(batches):
        import pyarrow as pa

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(_U)
            for s in range(0, len(fp), 256):
                x = fp[s:s + 256]
                words = (x[:, None] ^ masks).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(np.repeat(x, len(masks)).view(np.int64))], ["word", "fp"])

    def chain(batches):
        import pyarrow as pa

        word = fp = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            word = np.concatenate([word[-1:], batch.column(0).to_numpy()])
            fp = np.concatenate([fp[-1:], batch.column(1).to_numpy()])
            at = np.flatnonzero(word[1:] == word[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(fp[at], fp[at + 1])), pa.array(np.maximum(fp[at], fp[at + 1]))], ["a", "b"])

    words = fps.select("fp").mapInArrow(explode, "word long, fp long")
    return words.repartition("word").sortWithinPartitions("word", "fp").mapInArrow(chain, "a long, b long").distinct()


def fingerprint_links(reps: DataFrame, most_rows: int = RUN) -> DataFrame:
    """(a, b): links between the distinct fingerprints of the stored ``reps(fp)``
    that connect all that are within MOST bits of one another."""
    found = stored(scan_runs(keyed_rows(reps).repartitionByRange("key", "fp").sortWithinPartitions("key", "fp"), most_rows), "runs")
    open_rows = found.where(F.col("kind") != LINK)
    keys = stored(open_rows.groupBy("key").agg(F.count("*").alias("n"), F.max("kind").alias("worst"))
                  .select("key", ((F.col("n") > most_rows) | (F.col("worst") == LONG)).alias("crowded")), "open_keys")
    crowded = open_rows.join(keys.where("crowded"), "key", "left_semi").select(F.col("a").alias("fp")).distinct()
    edges = open_rows.join(keys.where("not crowded"), "key", "left_semi")
    return (found.where(F.col("kind") == LINK).select("a", "b")
            .union(group_links(edges.select("key", "a")))
            .union(ball_links(crowded)).distinct())


def near_duplicates(docs: DataFrame, k: int = 5, most_rows: int = RUN) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs(doc_id, text)``.

    Words are runs of non-blank characters with A-Z lower-cased; h is the XXH64
    (seed 42) of a ``k``-word shingle, space-joined, repeats included (fewer
    words: the whole sequence). ``fingerprint`` is 16 lower-case hex digits;
    ``component_id`` is the smallest ``doc_id`` reachable over links of at most
    4 differing bits.

    Null, empty or blank text: fingerprint zero, linked like any other. A null
    ``doc_id`` links nothing and gets a null component. Repeated rows give
    repeated results. An empty table gives an empty table. Extra columns are
    ignored. A very long text is hashed in pieces by one task."""
    rows = stored(fingerprints(docs.select("doc_id", "text"), k), "fingerprints")
    reps = stored(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "reps")
    parts = connected_components(fingerprint_links(reps, most_rows))
    named = stored(reps.join(parts, F.col("fp") == F.col("node"), "left")
                   .select("fp", "id", F.coalesce("component", "fp").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    of = stored(named.join(least, "component").select(F.col("fp").alias("_fp"), "component_id"), "components")
    return (rows.join(of, F.col("fp") == F.col("_fp"), "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def op11_golay_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4)
