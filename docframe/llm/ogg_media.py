"""Media columns: the Ogg container.

Reading verifies every page checksum, demultiplexes logical streams by serial number, reassembles packets from lacing
values across pages and derives timestamps from granule positions. Writing stores 8-bit PCM losslessly in two
interleaved logical streams, which exercises all of it. Each row is handled alone, without a shuffle.

Defined results: a null text is stored as an empty one; an empty text gives 64 zero bytes of payload; texts of any length
are stored whole; repeated rows get equal media. Damaged media (bad checksum, lost or cut pages, an open packet, no last
page, uneven channels, a sampling rate of zero, no bytes at all) raise ``OggError`` in ``read_ogg`` or ``read_pcm`` and give
a null result in ``ogg_features``, like null media.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import read_table

RATE = 8000
PACKET = 2048
_HEAD = struct.Struct("<4sBBqIIIB")
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_CONTINUED, _FIRST, _LAST = 1, 2, 4


class OggError(ValueError):
    pass


def page_crc(page: bytes) -> int:
    """CRC-32 of the Ogg format (polynomial 04c11db7, most significant bit first, no inversion).

    zlib computes the mirrored CRC; mirroring bytes in and bits out gives this one at C speed.
    """
    mirrored = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_REVERSED), "big")


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: Granule position at the end of each packet; -1 where the page of its end gives none.
    granules: list[int] = field(default_factory=list)
    pages: int = 0

    @property
    def rate(self) -> int:
        head = self.packets[0] if self.packets else b""
        if head[:8] != b"PCM     ":
            return RATE
        if len(head) < 12 or head[8:12] == b"\0\0\0\0":
            raise OggError(f"stream {self.serial} has no sampling rate")
        return struct.unpack_from("<I", head, 8)[0]

    def seconds(self) -> list[float]:
        return [g / self.rate for g in self.granules]


def _page(serial: int, number: int, granule: int, flags: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEAD.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    crc = page_crc(head + lacing + body)
    return head[:22] + struct.pack("<I", crc) + head[26:] + lacing + body


def write_stream(serial: int, packets: list[tuple[bytes, int]], page_segments: int = 255) -> Iterator[bytes]:
    """Pages of one logical stream; packets come with their end granule and may span pages."""
    segments: list[tuple[int, bytes, int | None]] = []
    for data, granule in packets:
        whole, rest = divmod(len(data), 255)
        segments += [(255, data[255 * i : 255 * i + 255], None) for i in range(whole)] + [(rest, data[255 * whole :], granule)]
    number, continued = 0, False
    cuts = [0, 1, *range(1 + page_segments, len(segments), page_segments), len(segments)] if len(segments) > 1 else [0, len(segments)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        part = segments[a:b]
        ends = [g for _, _, g in part if g is not None]
        flags = _CONTINUED * continued | _FIRST * (number == 0) | _LAST * (b == len(segments))
        yield _page(serial, number, ends[-1] if ends else -1, flags, bytes(n for n, _, _ in part), b"".join(d for _, d, _ in part))
        number, continued = number + 1, part[-1][0] == 255


def write_ogg(payload: bytes, rate: int = RATE, packet: int = PACKET) -> bytes:
    """8-bit PCM of two channels, samples taking turns; each channel is a logical stream whose granules count its samples."""
    out: list[list[bytes]] = []
    for k in (0, 1):
        header = b"PCM     " + struct.pack("<IIIBB", rate, 1, k, 8, 1)
        channel = payload[k::2]
        out.append(list(write_stream(k + 1, [(header, 0), *((channel[i : i + packet], min(i + packet, len(channel))) for i in range(0, len(channel), packet))])))
    first = [pages[0] for pages in out]  # the first pages of all streams come before any other
    rest = [pages[i] for i in range(1, max(map(len, out))) for pages in out if i < len(pages)]
    return b"".join(first + rest)


def read_ogg(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number. Raises OggError on any damage."""
    streams: dict[int, Stream] = {}
    open_packets: dict[int, list[bytes]] = {}
    ended: set[int] = set()
    at = 0
    if not data:
        raise OggError("no pages")
    while at < len(data):
        if at + 27 > len(data):
            raise OggError("page header is cut off")
        magic, version, flags, granule, serial, number, crc, n = _HEAD.unpack_from(data, at)
        if magic != b"OggS" or version:
            raise OggError(f"no page at byte {at}")
        lacing = data[at + 27 : at + 27 + n]
        start = at + 27 + n
        end = start + sum(lacing)
        if len(lacing) < n or end > len(data):
            raise OggError("page is cut off")
        if page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            raise OggError(f"checksum of the page at byte {at} fails")
        if bool(flags & _FIRST) == (serial in streams):
            raise OggError(f"stream {serial} begins twice or without its first page")
        stream = streams.setdefault(serial, Stream(serial))
        if serial in ended:
            raise OggError(f"stream {serial} goes on after its last page")
        if flags & _LAST:
            ended.add(serial)
        if number != stream.pages:
            raise OggError(f"stream {serial} lacks page {stream.pages}")
        stream.pages += 1
        parts = open_packets.pop(serial, [])
        if bool(parts) != bool(flags & _CONTINUED):
            raise OggError(f"stream {serial} has an open packet")
        closed = 0
        for length in lacing:
            parts.append(data[start : start + length])
            start += length
            if length < 255:
                stream.packets.append(b"".join(parts))
                stream.granules.append(-1)
                parts, closed = [], closed + 1
        if closed:
            stream.granules[-1] = granule
        if parts:
            open_packets[serial] = parts
        at = end
    if open_packets:
        raise OggError("the last packet is open")
    if ended != streams.keys():
        raise OggError(f"streams without a last page: {sorted(streams.keys() - ended)}")
    return streams


def read_pcm(data: bytes) -> tuple[bytes, dict[int, Stream]]:
    """The samples of all channels, put in order by timestamp, and the streams they came from."""
    streams = read_ogg(data)
    for s in streams.values():
        for i in range(len(s.granules) - 2, 0, -1):  # packets that end inside a page: counted back from the page's granule
            if s.granules[i] < 0:
                s.granules[i] = s.granules[i + 1] - len(s.packets[i + 1])
        if len(s.packets) > 1 and s.granules[-1] != sum(map(len, s.packets[1:])):
            raise OggError(f"stream {s.serial} lacks samples")
    channels = [b"".join(streams[k].packets[1:]) for k in sorted(streams)]
    out = bytearray(sum(map(len, channels)))
    if any(len(channel) != len(range(k, len(out), len(channels))) for k, channel in enumerate(channels)):
        raise OggError("channels have uneven numbers of samples")
    for k, channel in enumerate(channels):
        out[k :: len(channels)] = channel
    return bytes(out), streams


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + b"\0" * (-len(raw) % 64 if raw else 64)


def feature_of(samples: bytes, streams: dict[int, Stream]) -> str:
    n = max(1, len(samples))
    pages, packets = sum(s.pages for s in streams.values()), sum(len(s.packets) for s in streams.values())
    seconds = max((t for s in streams.values() for t in s.seconds()), default=0.0)
    return f"streams={len(streams)};pages={pages};packets={packets};seconds={seconds:.6f};mean={sum(samples) / n:.4f};zeros={samples.count(0)}"


def media_row(text: str | None) -> tuple:
    n, payload = payload_of(text)
    media = write_ogg(payload)
    samples, streams = read_pcm(media)
    return (n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(samples, streams))


MEDIA_SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def to_ogg(text: Column) -> Column:
    """The media column of a text column."""

    @F.pandas_udf("binary")
    def write(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: write_ogg(payload_of(t)[1]))

    return write(text)


def ogg_features(media: Column) -> Column:
    """Samples and figures of a media column; null where the media are null or damaged."""

    @F.pandas_udf("samples binary, n_streams int, n_pages int, seconds double")
    def read(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for m in batch:
            try:
                if m is None:
                    raise OggError("no media")
                samples, streams = read_pcm(m)
                rows.append((samples, len(streams), sum(s.pages for s in streams.values()), max((t for s in streams.values() for t in s.seconds()), default=0.0)))
            except OggError:
                rows.append((None, None, None, None))
        return pd.DataFrame(rows, columns=["samples", "n_streams", "n_pages", "seconds"]).astype({"n_streams": "Int32", "n_pages": "Int32"})

    return read(media)


def media_digests(text: Column) -> Column:
    """Store the text, read it back and give digests of what was stored and read."""

    @F.pandas_udf(MEDIA_SCHEMA)
    def digests(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([media_row(t) for t in texts], columns=[c.split()[0] for c in MEDIA_SCHEMA.split(", ")])

    return digests(text)


def op4_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", media_digests(F.col("text")).alias("m"))
    return docs.select("doc_id", "m.*")


QUERIES = {"op4_ogg_media": op4_ogg_media}
ORACLE_SQL: dict[str, str] = {}
