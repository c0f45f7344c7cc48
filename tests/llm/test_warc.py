import hashlib
import io

import pytest
import zstandard

from kpiforge.llm import warc as X
from kpiforge.llm.common import work_path

PAGES = "page_id long, url string, html string"


def brute(rows):
    full = [(i, (h or "").encode()) for i, _, h in rows]
    top = {}
    for i, b in full:
        if len(b) >= 1000 and i is not None:
            top[b] = max(top.get(b, i), i)
    out = []
    for i, b in full:
        keep = top.get(b)
        again = keep is not None and i is not None and i != keep
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=repr)


def read(index):
    return sorted(map(tuple, X.read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.fixture
def written(spark):
    def make(rows, folder=None):
        return X.write_archives(spark.createDataFrame(rows, PAGES), folder or work_path(spark, "warc"))
    return make


def rows():
    big, other = "<p>" + "é" * 600, "x" * 1000
    return [(1, "http://a/", big), (2, None, big), (9, "http://b/\r\nEvil: 1", big), (3, "u", other), (4, "u", other[:-1]), (5, "u", other[:-1]),
            (6, "ü ", None), (7, "", ""), (8, "v", ""), (10, "w", "\r\n\r\nWARC/1.1\r\n\r\n" * 200), (11, "long", "y" * 3_000_000)]


def test_round_trip(written):
    assert read(written(rows())) == brute(rows())


def test_ties_repeats_nulls(written):
    big = "z" * 2000
    more = [(5, "a", big), (5, "a", big), (4, "b", big), (4, "b", big), (None, "c", big), (None, None, None), (7, "p", "q" * 1500), (7, "p", big)]
    assert read(written(more)) == brute(more)
    empty = written([])
    assert empty.count() == 0 and read(empty) == []


def test_large_group_of_equal_payloads(written):
    many = [(i, "u", "same " * 300) for i in range(400)] + [(1000 + i, "u", f"own {i} " * 300) for i in range(50)]
    assert read(written(many)) == brute(many)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, written, monkeypatch):
    monkeypatch.setattr(X, "FRAME_BYTES", 5000)
    index = written([(i, "u", f"{i} " * 700) for i in range(40)]).collect()
    for path in {r.bundle for r in index}:
        data = open(path.removeprefix("file://"), "rb").read()
        frames = X.read_seek_table(io.BytesIO(data), len(data))
        assert sum(c for _, c, _ in frames) + 8 + 8 * len(frames) + 9 == len(data)
        whole = b"".join(zstandard.ZstdDecompressor().decompress(data[a:a + c]) for a, c, _ in frames)
        # any reader that skips skippable frames gets the records
        assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == whole
        for r in (r for r in index if r.bundle == path):
            at, size, full = frames[r.frame]
            assert (at, size) == (r.frame_offset, r.frame_bytes)
            frame = zstandard.ZstdDecompressor().decompress(data[at:at + size])
            assert len(frame) == full
            (o, n, headers, _), = X.decode_records(frame[r.offset:r.offset + r.length])
            assert headers["WARC-Record-ID"] == f"<{r.record_id}>" and n == r.length


def test_fetch_single_records(spark, written):
    index = written(rows())
    got = {r.page_id: (r.record_type, bytes(r.payload)) for r in X.fetch(index, spark.createDataFrame([(1,), (10,), (9,), (77,)], "page_id long")).collect()}
    data = {i: (h or "").encode() for i, _, h in rows()}
    assert got == {1: ("revisit", b""), 10: ("response", data[10]), 9: ("response", data[9])}


def test_headers_are_not_injected():
    record = X.encode_record(1, "http://b/\r\nEvil: 1", b"", hashlib.sha1(b"").hexdigest(), None)
    (_, _, headers, _), = X.decode_records(record)
    assert "Evil" not in headers and headers["WARC-Target-URI"] == "http://b/%0D%0AEvil:%201"


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        X.read_seek_table(io.BytesIO(b"0" * 40), 40)
    with pytest.raises(ValueError):
        list(X.decode_records(b"nonsense\r\n\r\n"))


def test_clashing_columns(spark):
    pages = spark.sql("select 1L page_id, 'u' url, 'h' html, 'a' digest, 'b' refers_to, 'c' payload, 'd' n")
    assert read(X.write_archives(pages, work_path(spark, "warc"))) == brute([(1, "u", "h")])
