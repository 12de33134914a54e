"""The archive format by itself: what is written and what a reader refuses."""

import io

import pytest
import zstandard as zstd

from acctsentry.llm import warc as W


def sample(n=40):
    return [W.record(i, f"http://h/{i}", (f"<p>page {i} " * 30).encode(), "d" * 40, None) for i in range(n)]


def real(page, payload, original=None):
    import hashlib
    return W.record(page, "http://h", payload, hashlib.sha1(payload).hexdigest(), original)


def archive(records):
    return b"".join(W.packed(iter(records)))


def test_round_trip_and_dictionary():
    records = sample()
    data = archive(records)
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little") and data[8:12] == W.ZDICT_MAGIC
    assert list(W.frames(io.BytesIO(data))) == records


def test_compressed_dictionary():
    records = sample()
    data = archive(records)
    size = int.from_bytes(data[4:8], "little")
    again = W.skippable(zstd.ZstdCompressor().compress(data[8 : 8 + size])) + data[8 + size :]
    assert list(W.frames(io.BytesIO(again))) == records


def test_few_records_need_no_dictionary():
    records = sample(2)
    assert list(W.frames(io.BytesIO(archive(records)))) == records
    assert list(W.frames(io.BytesIO(archive([])))) == []


@pytest.mark.parametrize("damage", [lambda d: d[20:], lambda d: d[:100], lambda d: d[:-3], lambda d: b"", lambda d: d[:-40] + b"\x00" * 40])
def test_damaged_archives(damage):
    with pytest.raises(W.WarcError):
        list(W.frames(io.BytesIO(damage(archive(sample())))))


def test_records():
    ok = real(5, b"hello \r\n\r\n world")
    r = W.parsed(ok)
    assert (r["type"], W.page_of(r["id"]), r["payload"], r["length"]) == ("response", 5, b"hello \r\n\r\n world", 16)
    again = W.parsed(real(6, b"x" * 2000, 9))
    assert (again["type"], W.page_of(again["refers_to"]), again["payload"], again["length"]) == ("revisit", 9, None, 2000)
    for bad in (ok.replace(b"WARC/1.1", b"WARC/9"), ok.replace(b"Content-Length: ", b"Content-Length: 1", 1), ok[:-1], ok + b"x",
                ok.replace(b"hello", b"hullo"), ok.replace(b"WARC-Type: response", b"WARC-Typ: response"), b"", b"WARC/1.1\r\n",
                ok.replace(b"WARC-Date", b"WARC-Type", 1)):
        with pytest.raises(W.WarcError):
            W.parsed(bad)
