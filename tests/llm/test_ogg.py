"""Ogg files: round trips, checksums, and what a reader must refuse."""

import hashlib
import zlib

import pytest

from tessera.llm import ogg

from .conftest import ODD


def slow_checksum(data: bytes) -> int:
    c = 0
    for b in data:
        c ^= b << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
    return c


def test_checksum():
    for data in (b"", b"a", bytes(range(256)), b"OggS" * 100):
        assert ogg.checksum(data) == slow_checksum(data)


@pytest.mark.parametrize("n", [0, 1, 254, 255, 256, 510, 65025, 65026, 200_000])
def test_packets_of_any_size(n):
    packets = [(b"head", 0), (bytes(i % 251 for i in range(n)), n), (b"tail", n + 4)]
    data = b"".join(ogg.pages_of(7, packets))
    stream = ogg.demultiplex(data)[7]
    assert stream.packets == [p for p, _ in packets]
    assert stream.granules[-1] == n + 4 and stream.seconds(4)[-1] == (n + 4) / 4


def test_two_streams_interleaved():
    a, b = ogg.pages_of(1, [(b"a", 0), (b"x" * 70_000, 70_000)]), ogg.pages_of(2, [(b"b", 0), (b"y" * 70_000, 9)])
    mixed = b"".join([a[0], b[0], *(p for pair in zip(a[1:], b[1:], strict=True) for p in pair)])
    streams = ogg.demultiplex(mixed)
    assert streams[1].packets[1] == b"x" * 70_000 and streams[2].packets[1] == b"y" * 70_000


def test_refusals():
    good = ogg.encode(*ogg.pad("some text"))
    assert ogg.decode(good)[1] == 9
    for k in range(0, len(good), 7):
        bad = bytearray(good)
        bad[k] ^= 1
        with pytest.raises(ogg.OggError):
            ogg.decode(bytes(bad))
    for cut in (10, 30, len(good) - 1):
        with pytest.raises(ogg.OggError):
            ogg.demultiplex(good[:cut])


def test_digests(docs):
    df = docs(ODD, extra=("media",))
    rows = ogg.read_back(ogg.store(df)).collect()
    assert len(rows) == len(ODD)
    by = {(r.doc_id, r.n_bytes): r for r in rows}
    for i, t, *_ in ODD:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 or (192 if not raw else 0))
        r = by[i, len(raw)]
        assert r.payload_bytes == len(payload) and r.payload_bytes % 192 == 0 and r.payload_bytes > 0
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-16:])
    assert by[5, 33].media_sha256 == by[6, 33].media_sha256 and by[5, 33].feature == by[6, 33].feature
    assert ogg.read_back(ogg.store(df.limit(0))).count() == 0


def test_packet_rows(docs):
    df = docs([(1, "z" * 10_000, "en", "a")])
    rows = ogg.packets(ogg.store(df)).collect()
    data = b"".join(bytes(r.data) for r in sorted(rows, key=lambda r: r.packet) if r.stream == ogg.DATA_STREAM and r.packet)
    assert data.rstrip() == b"z" * 10_000
    assert max(r.seconds or 0 for r in rows) == pytest.approx(len(data) / ogg.SAMPLE_RATE)
