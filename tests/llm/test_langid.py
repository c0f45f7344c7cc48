import numpy as np
import pytest

from kpiforge.llm import langid as X
from kpiforge.llm.common import is_held_out
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def net(spark):
    return X.train(X.labelled_sample(spark.read.parquet(f"{SF}/documents.parquet")))


def test_held_out_accuracy(spark, net):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = X.identified(docs, net).where(is_held_out(F.col("doc_id"))).select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_lookup_tables_equal_the_convolution(net):
    rng = np.random.default_rng(1)
    w = rng.integers(0, 256, (50, X.WINDOW)).astype(np.uint8)
    emb = net.table[w]
    want = np.full((50, X.FILTERS * len(X.WIDTHS)), -np.inf)
    for at in range(X.WINDOW - 3):
        want = np.maximum(want, emb[:, at:at + 4].reshape(50, -1) @ net.kernel)
    z = np.maximum(want + net.bias, 0) @ net.out + net.out_bias
    want = np.exp(z - z.max(1, keepdims=True))
    want /= want.sum(1, keepdims=True)
    assert np.allclose(net.probabilities(w), want, atol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(2)
    used = np.ones((4 * X.EMBED, 6), np.float32)
    p = [rng.normal(size=s) for s in ((256, X.EMBED), (4 * X.EMBED, 6), (6,), (6, 3), (3,))]
    x, y, weight = rng.integers(1, 256, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 1, 0]), np.ones(5)

    def loss():
        n = X.Network(list("abc"), *p)
        patch = n.patches(x)
        act = (patch.reshape(-1, patch.shape[2]) @ n.kernel).reshape(5, -1, 6).max(1)
        z = np.maximum(act + n.bias, 0) @ n.out + n.out_bias
        z = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -(z[np.arange(5), y]).mean()
    g = X._gradients(X.Network(list("abc"), *p), x, y, weight, used)
    for k, at in ((1, (3, 2)), (2, (4,)), (3, (1, 2)), (4, (0,)), (0, (int(x[0, 5]), 3))):
        keep, h = p[k][at], 1e-5
        p[k][at] = keep + h
        up = loss()
        p[k][at] = keep - h
        down = loss()
        p[k][at] = keep
        assert g[k][at] == pytest.approx((up - down) / (2 * h), abs=1e-4)


def test_windows_cover_whole_texts():
    texts = [b"a" * 600, b"", b"xyz", b"q" * 256]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    w, first = X.cut(raw, off)
    assert first.tolist() == [0, 3, 3, 4, 5]
    assert b"".join(w[first[0]:first[1]].tobytes().rstrip(b"\0").split(b"\0")) == texts[0] and w[4].tobytes() == texts[3]


def test_no_letters_null_long_and_clashes(spark, docs, net):
    rows = [(1, None), (2, ""), (3, "123 +-! 45"), (4, "the " * 100_000), (5, "日本語"), (None, "the and of the"), (4, "²³½"), (6, "9 é 9")]
    got = [(r.doc_id, r.lang_pred) for r in X.identified(docs(*rows), net).collect()]
    by = dict(got)
    assert by[1] == by[2] == by[3] == "und" and got[6] == (4, "und")
    assert by[5] in net.languages and by[6] in net.languages and got[3] == (4, "en")
    assert X.identified(docs(), net).count() == 0
    one = X.identified(spark.sql("select 1L doc_id, 'the' text, 'mine' score, 5 lang_pred, 'k' kernel"), net).first()
    assert one.kernel == "k" and isinstance(one.score, float) and one.lang_pred in net.languages


def test_training_reads_no_held_out_rows_and_any_labels(spark, docs):
    frame = docs(*[(i, "abc def" if i % 2 else "xyz uvw", "l1" if i % 2 else "l2") for i in range(40)])
    held = {r.doc_id for r in frame.where(is_held_out(F.col("doc_id"))).collect()}
    assert held and len(X.labelled_sample(frame)) == 40 - len(held)
    assert X.labelled_sample(docs((1, "a", None), (2, None, "en"), (None, "a", "en"))) == []
    lone = X.train([("abc", "l1")])
    assert X.identified(docs((1, "abc")), lone).first().lang_pred == "l1"
    assert X.identified(docs((1, "abc")), X.train([])).first().lang_pred == "und"
