"""Ogg media columns: pages with checked sums, packets rebuilt from lacing values, logical streams told apart,
and timestamps from granule positions.

A stored file multiplexes two logical streams: the payload as packets of 8-bit samples, whose granule position is
the number of samples that end on the page, and a side stream of one packet that names the payload's true length.

Defined cases: a null text counts as empty; payloads are padded with spaces to a positive multiple of FRAME, so
none is empty; equal texts give equal files (serial numbers and headers hold nothing of the row); an empty table
gives an empty result; columns other than the id and text are ignored. A page that is cut short, has a wrong
checksum, or leaves a gap in its stream raises ``OggError``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_or_empty

#: Fixed values of the format (RFC 3533).
CAPTURE, VERSION, CONTINUED, FIRST, LAST = b"OggS", 0, 1, 2, 4
HEADER = struct.Struct("<4sBBqIIIB")
NO_PACKET_ENDS = -1

FRAME = 192
SAMPLE_RATE = 8_000
PACKET_FRAMES = 20
DATA_STREAM, SIDE_STREAM = 1, 2

_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


class OggError(ValueError):
    pass


def checksum(page: bytes) -> int:
    """The format's CRC-32: polynomial 04c11db7, most significant bit first, no inversion. It is the usual
    reflected CRC of the bit-reversed bytes, with the inversions undone and the result's bits reversed."""
    c = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(c.to_bytes(4, "little").translate(_REVERSED), "big")


def page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(CAPTURE, VERSION, flags, granule, serial, number, 0, len(lacing)) + lacing
    return head[:22] + checksum(head + body).to_bytes(4, "little") + head[26:] + body


def pages_of(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """The pages of one logical stream; each packet comes with the granule position at its end."""
    values, body = bytearray(), bytearray()
    out: list[tuple[int, int, bytes, bytes]] = []
    flags, granule, open_ = FIRST, NO_PACKET_ENDS, False
    for k, (packet, ends_at) in enumerate(packets):
        at, sizes = 0, [255] * (len(packet) // 255) + [len(packet) % 255]
        for j, n in enumerate(sizes):
            if len(values) == 255 or k == 1 and j == 0:
                out.append((flags, granule, bytes(values), bytes(body)))
                flags, granule, values, body = CONTINUED if j else 0, NO_PACKET_ENDS, bytearray(), bytearray()
            values.append(n)
            body += packet[at : at + n]
            at += n
        granule = ends_at
    out.append((flags, granule, bytes(values), bytes(body)))
    last = len(out) - 1
    return [page(f | LAST * (k == last), g, serial, k, v, b) for k, (f, g, v, b) in enumerate(out)]


@dataclass
class Stream:
    packets: list[bytes] = field(default_factory=list)
    #: Granule position at each packet's end; None where its page tells of a later packet only.
    granules: list[int | None] = field(default_factory=list)
    partial: bytearray | None = None
    next_page: int = 0
    ended: bool = False

    def seconds(self, rate: int) -> list[float | None]:
        return [None if g is None else g / rate for g in self.granules]


def demultiplex(data: bytes) -> dict[int, Stream]:
    """The logical streams of a physical one, by serial number."""
    streams: dict[int, Stream] = {}
    view, at = memoryview(data), 0
    while at < len(data):
        if len(data) - at < HEADER.size:
            raise OggError("a page's header is cut short")
        capture, version, flags, granule, serial, number, crc, count = HEADER.unpack_from(data, at)
        if capture != CAPTURE or version != VERSION:
            raise OggError(f"no page begins at byte {at}")
        lacing = bytes(view[at + 27 : at + 27 + count])
        begin = at + 27 + count
        end = begin + sum(lacing)
        if len(lacing) < count or end > len(data):
            raise OggError("a page is cut short")
        if checksum(b"".join((view[at : at + 22], b"\0\0\0\0", view[at + 26 : end]))) != crc:
            raise OggError(f"wrong checksum of the page at byte {at}")
        if flags & FIRST:
            if serial in streams:
                raise OggError("a stream begins twice")
            streams[serial] = Stream()
        s = streams.get(serial)
        if s is None or s.ended or number != s.next_page or bool(flags & CONTINUED) != (s.partial is not None):
            raise OggError(f"page {number} doesn't follow in stream {serial}")
        s.next_page += 1
        packet, closed = s.partial if s.partial is not None else bytearray(), True
        for n in lacing:
            packet += view[begin : begin + n]
            begin += n
            closed = n < 255
            if closed:
                s.packets.append(bytes(packet))
                s.granules.append(None)
                packet = bytearray()
        s.partial = None if closed else packet
        if granule != NO_PACKET_ENDS:
            if not s.granules:
                raise OggError("a granule position without a packet")
            s.granules[-1] = granule
        s.ended = bool(flags & LAST)
        at = end
    if any(not s.ended or s.partial is not None for s in streams.values()):
        raise OggError("a stream has no end")
    return streams


def encode(payload: bytes, n_bytes: int, rate: int = SAMPLE_RATE, frame: int = FRAME) -> bytes:
    """The payload as an Ogg file of 8-bit samples."""
    step = PACKET_FRAMES * frame
    head = b"\x01samples8" + struct.pack("<IIQ", rate, frame, len(payload))
    packets = [(head, 0)] + [(payload[a : a + step], min(a + step, len(payload))) for a in range(0, len(payload), step)]
    side = [(b"\x01length", 0), (n_bytes.to_bytes(8, "little"), len(payload))]
    data, other = pages_of(DATA_STREAM, packets), pages_of(SIDE_STREAM, side)
    # All first pages come before any other, then pages by the time at which they end.
    return b"".join([data[0], other[0], *data[1:], *other[1:]])


def decode(media: bytes) -> tuple[bytes, int, Stream]:
    """Payload, true length and payload stream of a stored file."""
    streams = demultiplex(media)
    data, side = streams[DATA_STREAM], streams[SIDE_STREAM]
    size = struct.unpack("<IIQ", data.packets[0][9:])[2]
    payload = b"".join(data.packets[1:])
    if len(payload) != size or data.granules[-1] != size:
        raise OggError("the samples don't add up to the header's count")
    return payload, int.from_bytes(side.packets[1], "little"), data


def pad(text: str, frame: int = FRAME) -> tuple[bytes, int]:
    raw = text.encode()
    return raw + b" " * (-len(raw) % frame or frame * (not raw)), len(raw)


def features(payload: bytes, stream: Stream, rate: int = SAMPLE_RATE) -> str:
    """Duration, packets, mean, deviation and mid-line crossings of the samples read back."""
    x = np.frombuffer(payload, np.uint8)
    total, squares = int(x.sum(dtype=np.int64)), int(np.bincount(x, minlength=256) @ (np.arange(256, dtype=np.int64) ** 2))
    mean = total / len(x)
    high = x >= 96
    return (
        f"seconds={stream.granules[-1] / rate:.3f};packets={len(stream.packets) - 1};mean={mean:.4f};"
        f"deviation={max(0.0, squares / len(x) - mean * mean) ** 0.5:.4f};crossings={int((high[1:] != high[:-1]).sum())}"
    )


STORE_SCHEMA = "doc_id long, media binary"


def store(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Each text as an Ogg file: the media column."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = [encode(*pad(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "media": pa.array(media, pa.binary())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, STORE_SCHEMA)


DIGEST_SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string"
)


def read_back(media: DataFrame) -> DataFrame:
    """What the stored files hold: sizes, digests of the payload read back and of the file, and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, stored in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                payload, n, stream = decode(stored)
                rows.append(
                    (doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored),
                     hashlib.sha256(stored).hexdigest(), features(payload, stream))
                )
            names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
            kinds = [pa.string() if c.endswith("string") else pa.int64() for c in DIGEST_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds, strict=True)], names)

    return media.mapInArrow(run, DIGEST_SCHEMA)


PACKET_SCHEMA = "doc_id long, stream long, packet long, seconds double, data binary"


def packets(media: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """One row per packet of every logical stream, with its time where a granule position tells it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, stored in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for serial, s in demultiplex(stored).items():
                    n = len(s.packets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * n, pa.int64()), pa.array([serial] * n, pa.int64()), pa.array(range(n), pa.int64()),
                         pa.array(s.seconds(rate), pa.float64()), pa.array(s.packets, pa.binary())],
                        [c.split()[0] for c in PACKET_SCHEMA.split(", ")],
                    )

    return media.mapInArrow(run, PACKET_SCHEMA)
