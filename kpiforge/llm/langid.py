"""Language identification with a byte convolutional network.

Windows of fixed length over the UTF-8 bytes; a byte embedding, filters of
several widths, max pooling, softmax. Trained in numpy on a bounded sample of
labelled texts; applied to every window of every text, in batches. A text's
language has the largest mean probability over its windows, by their bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiforge.llm.common import is_held_out, slices, text_buffers, unit_hash

WINDOW = 256
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4), 12
#: Bound on the labelled texts that training reads, per language, and the windows of each.
PER_LANGUAGE, WINDOWS_PER_TEXT = 700, 3
NO_LANGUAGE = "und"


@dataclass
class Network:
    """table: byte embedding (256, EMBED); kernel: (4 * EMBED, filters), zero
    beyond a filter's width; bias: (filters); out: (filters, languages)."""
    languages: list[str]
    table: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def __post_init__(self):
        # embedding of a byte and of the next one, by the pair of bytes
        self.pair = np.concatenate([np.repeat(self.table, 256, 0), np.tile(self.table, (256, 1))], 1)

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """(n, WINDOW - 3, 4 * EMBED): embeddings of four bytes from each position."""
        two = self.pair[windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]]
        return np.concatenate([two[:, :-2], two[:, 2:]], 2)

    def probabilities(self, windows: np.ndarray, batch: int = 32) -> np.ndarray:
        """Filters by lookup: what two bytes add to each filter, for the first
        and the second half of its four places, is in a table by the pair."""
        head, tail = self.pair @ self.kernel[:2 * EMBED], self.pair @ self.kernel[2 * EMBED:]
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), batch):
            w = np.ascontiguousarray(windows[i:i + batch].T).astype(np.int32)  # place, window
            pairs = w[:-1] * 256 + w[1:]
            y = np.take(head, pairs[:-2], axis=0)
            y += np.take(tail, pairs[2:], axis=0)
            z = np.maximum(y.max(0) + self.bias, 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out[i:i + batch] = z / z.sum(1, keepdims=True)
        return out


def cut(raw: np.ndarray, off: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, the last of each padded with zero bytes, and the
    first window of each text (and the end). A text without bytes has none."""
    lens = np.diff(off)
    first = np.concatenate([[0], np.cumsum(-(-lens // size))])
    flat = np.zeros(int(first[-1]) * size, np.uint8)
    src = np.arange(int(off[0]), int(off[-1]))
    flat[src + np.repeat(first[:-1] * size - off[:-1], lens)] = raw[int(off[0]):int(off[-1])]
    return flat.reshape(-1, size), first


def train(rows: list[tuple[str, str]], epochs: int = 6, seed: int = 7, rate: float = 3e-3) -> Network:
    """Fit a network to (text, language) rows: Adam on cross-entropy, windows
    drawn from each text and cut at random so that short texts are met too."""
    languages = sorted({lang for _, lang in rows})
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for text, lang in rows:
        b = np.frombuffer(text.encode(), np.uint8)
        w, _ = cut(b, np.array([0, len(b)]))
        for i in rng.permutation(len(w))[:WINDOWS_PER_TEXT]:
            full = w[i].copy()
            xs.append(full)
            ys.append(languages.index(lang))
            if rng.random() < 0.5:
                at, n = int(rng.integers(0, WINDOW - 16)), int(rng.integers(12, WINDOW // 2))
                piece = np.zeros(WINDOW, np.uint8)
                piece[:len(full[at:at + n])] = full[at:at + n]
                if piece.any():
                    xs.append(piece)
                    ys.append(languages.index(lang))
    n_filters, n_out = FILTERS * len(WIDTHS), max(1, len(languages))
    used = np.zeros((4 * EMBED, n_filters), np.float32)
    for i, w in enumerate(WIDTHS):
        used[:w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
    draw = lambda *s, by: rng.normal(0, by, s).astype(np.float32)
    p = [draw(256, EMBED, by=0.5), draw(4 * EMBED, n_filters, by=0.3) * used, np.zeros(n_filters, np.float32),
         draw(n_filters, n_out, by=0.2), np.zeros(n_out, np.float32)]
    p[0][0] = 0  # padding
    net = Network(languages or [NO_LANGUAGE], *p)
    if len(languages) < 2:
        return net
    x, y = np.array(xs), np.array(ys)
    weight = (1 / np.maximum(1, np.bincount(y, minlength=n_out)))[y]
    weight = (weight / weight.mean()).astype(np.float32)
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    turn = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 64):
            at = order[i:i + 64]
            turn += 1
            g = _gradients(net, x[at], y[at], weight[at], used)
            for k, (a, d) in enumerate(zip(p, g, strict=True)):
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                a -= rate * (m[k] / (1 - 0.9 ** turn)) / (np.sqrt(v[k] / (1 - 0.999 ** turn)) + 1e-7)
            net = Network(languages, *p)
    return net


def _gradients(net: Network, x, y, weight, used) -> list[np.ndarray]:
    n = len(x)
    patch = net.patches(x)
    act = (patch.reshape(-1, patch.shape[2]) @ net.kernel).reshape(n, patch.shape[1], -1)
    best = act.argmax(1)
    pool = np.maximum(np.take_along_axis(act, best[:, None], 1)[:, 0] + net.bias, 0)
    z = pool @ net.out + net.out_bias
    q = np.exp(z - z.max(1, keepdims=True))
    q /= q.sum(1, keepdims=True)
    q[np.arange(n), y] -= 1
    q *= (weight / n)[:, None]
    d_pool = (q @ net.out.T) * (pool > 0)
    top = patch[np.arange(n)[:, None], best]  # (n, filters, 4 * EMBED)
    d_kernel = np.einsum("nf,nfe->ef", d_pool, top) * used
    d_top = d_pool[:, :, None] * net.kernel.T[None]
    d_table = np.zeros_like(net.table)
    for j in range(4):
        np.add.at(d_table, x[np.arange(n)[:, None], best + j], d_top[:, :, j * EMBED:(j + 1) * EMBED])
    d_table[0] = 0
    return [d_table, d_kernel, d_pool.sum(0), pool.T @ q, q.sum(0)]


def labelled_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """About ``per_language`` (text, lang) rows of each language outside the
    held-out fold, drawn by a hash of the id."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where(
        "doc_id is not null and lang is not null and text is not null and text <> ''").where(~is_held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count().collect()
    if not counts:
        return []
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], per_language / max(per_language, r["count"])).otherwise(share)
    drawn = known.where(unit_hash(F.lit("lang"), F.col("doc_id")) < share).limit(2 * per_language * len(counts))
    return sorted((r["text"], r["lang"]) for r in drawn.select("text", "lang").collect())


def has_letter(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    part = raw[int(off[0]):int(off[-1])]
    at = off - off[0]
    total = np.zeros(len(part) + 1, np.int64)
    np.cumsum(((part | 0x20) >= 0x61) & ((part | 0x20) <= 0x7A), out=total[1:])
    out = total[at[1:]] > total[at[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in part[at[i]:at[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def identified(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) added. Null texts and
    texts without a letter: ``und``, score 1. Every window of a text counts.
    Repeated rows are treated alike; extra columns pass through (ones named
    like the added columns are replaced). Map-side: no shuffle."""
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast((net.languages, net.table, net.kernel, net.bias, net.out, net.out_bias))

    def run(batches):
        import pyarrow as pa

        model = Network(*held.value)
        names = np.array([*model.languages, NO_LANGUAGE], dtype=object)
        for batch in batches:
            raw, off = text_buffers(batch.column(batch.schema.get_field_index("text")))
            lang, score = np.full(len(off) - 1, len(names) - 1), np.ones(len(off) - 1)
            for i, j in slices(off, 1 << 20):
                part = off[i:j + 1]
                windows, first = cut(raw, part)
                if not len(windows):
                    continue
                size = np.full(len(windows), WINDOW, np.float64)
                some = np.flatnonzero(np.diff(part))
                size[first[some + 1] - 1] = (np.diff(part)[some] - 1) % WINDOW + 1
                mean = np.add.reduceat(model.probabilities(windows) * size[:, None], first[some]) / np.diff(part)[some, None]
                some_letter = has_letter(raw, part)[some]
                lang[i + some[some_letter]] = mean.argmax(1)[some_letter]
                score[i + some[some_letter]] = np.clip(mean.max(1)[some_letter], 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names[lang], pa.string()), pa.array(score)],
                                             [*batch.schema.names, "lang_pred", "score"])
    return docs.mapInArrow(run, schema)


def op2_byte_cnn_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = train(labelled_sample(docs))
    return identified(docs.select("doc_id", "text"), net).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
