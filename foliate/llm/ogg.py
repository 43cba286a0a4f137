"""Ogg media columns: mux bytes into logical streams, and read them back with every check the format allows.

A file has two logical streams, interleaved page by page: the payload (packets of UNIT 8-bit samples; the granule position
counts samples) and a text stream (one packet that names the layout). Reading verifies each page's checksum, joins packets from
lacing values across pages, sorts pages by serial number, checks sequence numbers and the first and last page's flags, and
turns granule positions into seconds.

Nulls: a null payload or text counts as empty. Rows are handled one by one, whatever their ids; equal texts give equal bytes.
An empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

UNIT = 576
RATE = 8000
PACKETS_PER_PAGE = 60
PAYLOAD_SERIAL, TEXT_SERIAL = 1, 2
CONTINUED, FIRST, LAST = 1, 2, 4
_PAGE = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(page: bytes) -> int:
    """The format's CRC-32 (0x04C11DB7, most significant bit first, from 0): zlib's, which goes the other way, over mirrored bytes."""
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _PAGE.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    crc = checksum(head + lacing + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + lacing + body


def lacing(size: int) -> bytes:
    """Lacing values of a packet: 255 as often as it goes in, then the rest (0 too)."""
    return b"\xff" * (size // 255) + bytes([size % 255])


def pages(packets: list[tuple[bytes, int]], serial: int, per_page: int = PACKETS_PER_PAGE) -> Iterator[bytes]:
    """Pages of one logical stream from (packet, granule position at its end); packets may span pages."""
    segments, body, number, flags, granule, count = b"", [], 0, FIRST, -1, 0
    for k, (packet, end) in enumerate(packets):
        values, at = lacing(len(packet)), 0
        while values:
            room = 255 - len(segments)
            part, values = values[:room], values[room:]
            used = sum(part)
            body.append(packet[at : at + used])
            segments, at = segments + part, at + used
            if not values:
                granule, count = end, count + 1
            done = not values and k == len(packets) - 1
            if len(segments) == 255 or count == per_page or done:
                yield _page(flags | (LAST if done else 0), granule, serial, number, segments, b"".join(body))
                number, flags, granule, count = number + 1, CONTINUED if values else 0, -1, 0
                segments, body = b"", []


def mux(payload: bytes, unit: int = UNIT) -> bytes:
    """An Ogg file of a payload that is a positive multiple of unit."""
    packets = [(payload[i : i + unit], i + unit) for i in range(0, len(payload), unit)]
    text = [(f"samples=u8;unit={unit};rate={RATE}".encode(), 0)]
    own, other = list(pages(packets, PAYLOAD_SERIAL)), list(pages(text, TEXT_SERIAL))
    return b"".join([own[0], *other, *own[1:]])


class BadOgg(ValueError):
    """A file that breaks the format."""


@dataclass
class Stream:
    """One logical stream: packets, and (granule position, packets so far) of each page that ends a packet."""

    packets: list[bytes] = field(default_factory=list)
    marks: list[tuple[int, int]] = field(default_factory=list)
    pages: int = 0
    ended: bool = False
    open: bytes | None = None

    def seconds(self, rate: int = RATE) -> float:
        return max((g for g, _ in self.marks), default=0) / rate

    def times(self, rate: int = RATE) -> np.ndarray:
        """Seconds at the end of each packet of 8-bit samples. Raises BadOgg if a page's granule position isn't the samples so far."""
        ends = np.cumsum([0, *map(len, self.packets)])
        if any(g != ends[k] for g, k in self.marks):
            raise BadOgg("granule position")
        return ends[1:] / rate


def demux(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number. Raises BadOgg on a bad capture pattern, checksum, sequence, flag or a cut file."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(data):
        if len(data) - at < 27:
            raise BadOgg("cut page header")
        magic, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise BadOgg("no page here")
        values = data[at + 27 : at + 27 + n]
        size = sum(values)
        end = at + 27 + n + size
        if len(values) < n or end > len(data):
            raise BadOgg("cut page")
        if checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise BadOgg("checksum")
        first = serial not in streams
        s = streams.setdefault(serial, Stream())
        if first != bool(flags & FIRST) or s.ended or number != s.pages or bool(flags & CONTINUED) != (s.open is not None):
            raise BadOgg("page order")
        s.pages += 1
        body, begun, length, held, before = at + 27 + n, at + 27 + n, 0, s.open, len(s.packets)
        for v in values:
            length += v
            if v < 255:
                part = data[begun : begun + length]
                s.packets.append(part if held is None else held + part)
                begun, length, held = begun + length, 0, None
        s.open = ((held or b"") + data[begun : begun + length]) if values and values[-1] == 255 else held if not values else None
        if granule < -1 or (granule >= 0) != (len(s.packets) > before):  # -1: no packet ends here
            raise BadOgg("granule position")
        if granule >= 0:
            s.marks.append((granule, len(s.packets)))
        s.ended = bool(flags & LAST)
        at = body + size
    if any(s.open is not None or not s.ended for s in streams.values()):
        raise BadOgg("stream without its end")
    return streams


def store(docs: DataFrame, unit: int = UNIT) -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8, padded with 255 to a positive multiple of unit, as an Ogg file."""

    def run(batch: pa.RecordBatch):
        texts = common.texts(batch.column(1))
        media = [mux(t + b"\xff" * (-len(t) % unit if t else unit), unit) for t in texts]
        yield {"doc_id": batch.column(0), "n_bytes": list(map(len, texts)), "media": media}

    return common.arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_bytes long, media binary")


def inspect(media: bytes) -> tuple[bytes, str, list[float]]:
    """The payload read back, its features, and the seconds at the end of each page that ends a packet. Raises BadOgg."""
    streams = demux(media)
    if PAYLOAD_SERIAL not in streams or not streams[PAYLOAD_SERIAL].packets:
        raise BadOgg("no payload")
    own = streams[PAYLOAD_SERIAL]
    payload = b"".join(own.packets)
    times = own.times()
    x = np.frombuffer(payload, np.uint8)
    mean, power = (float(x.mean()), float(np.sqrt(np.mean((x - np.float64(128)) ** 2)))) if len(x) else (0.0, 0.0)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    text = streams[TEXT_SERIAL].packets[0].decode(errors="replace") if TEXT_SERIAL in streams else ""
    feature = f"{text};streams={len(streams)};pages={sum(s.pages for s in streams.values())};packets={len(own.packets)};seconds={times[-1]:.6f};mean={mean:.4f};rms={power:.4f};crossings={crossings}"
    return payload, feature, [float(times[k - 1]) for _, k in own.marks]


def digests(stored: DataFrame) -> DataFrame:
    """What reading each stored file(doc_id, n_bytes, media) gives: sizes, hashes, features and the times of its pages.

    A file that breaks the format is a row with its error and nulls for what can't be read.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, page_seconds array<double>, error string"

    def read(media: bytes | None) -> tuple:
        try:
            payload, feature, seconds = inspect(media or b"")
        except BadOgg as e:
            return None, None, None, None, None, str(e)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), feature, seconds, None

    def run(batch: pa.RecordBatch):
        media = batch.column(2).to_pylist()
        got = [read(m) for m in media]
        size, sha, tail, feature, seconds, error = map(list, zip(*got, strict=True))
        yield {
            "doc_id": batch.column(0), "n_bytes": batch.column(1), "payload_bytes": size, "payload_sha256": sha, "tail_crc32": tail, "media_bytes": [len(m or b"") for m in media],
            "media_sha256": [hashlib.sha256(m or b"").hexdigest() for m in media], "feature": feature, "page_seconds": seconds, "error": error,
        }

    return common.arrow_map(stored, run, schema)


def op8_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(common.stored(store(spark.read.parquet(f"{sf_dir}/documents.parquet"))))
