"""Matroska media: payloads stored as 8-bit PCM tracks, and parsed back into packet tables.

The parser reads variable-length EBML elements, clusters, blocks with each kind of lacing (none,
Xiph, fixed-size, EBML) and cues, and lists packets with track, timestamp and byte range. The
writer uses all kinds of lacing in turn.

Defined results: a null text is stored like an empty one; a very long text is one file of many
clusters, within one row; an empty payload is padded to one unit;
equal texts give equal media; rows with equal ids are stored one by one; an empty table gives an
empty result; other columns are ignored. Bytes that aren't a Matroska file raise ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, texts

# Fixed values of the format: element ids.
EBML, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ = 0x1A45DFA3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, DURATION, MUXER, WRITER = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACKS, TRACK, NUMBER, UID, KIND, CODEC, AUDIO, RATE, CHANNELS, DEPTH = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE, CUE_TIME, CUE_AT, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE, CUE_AT}

UNIT = 576
SAMPLES_PER_MS = 8
#: Sizes of the packets of a block and its lacing (0 none, 1 Xiph, 2 fixed, 3 EBML), in turn.
PATTERNS = [((576,), 0), ((304, 848, 576), 1), ((576, 576, 576, 576), 2), ((400, 704, 624, 576), 3)]
BLOCKS_PER_CLUSTER = 16


class Packet(NamedTuple):
    track: int
    cluster: int
    block: int
    lacing: int
    timestamp_ms: float
    byte_start: int
    byte_size: int


class Media(NamedTuple):
    tracks: dict[int, dict]
    packets: list[Packet]
    clusters: list[tuple[int, int]]  # byte position, timestamp
    cues: list[tuple[int, int, int]]  # time, track, byte position of the cluster
    duration_ms: float


def _vint(n: int, width: int = 0) -> bytes:
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return ((1 << 7 * width) | n).to_bytes(width, "big")


def _element(id_: int, body: bytes) -> bytes:
    return id_.to_bytes((id_.bit_length() + 7) // 8, "big") + _vint(len(body)) + body


def _uint(id_: int, n: int) -> bytes:
    return _element(id_, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _laces(sizes: tuple[int, ...], lacing: int) -> bytes:
    if lacing == 0:
        return b""
    head = bytes([len(sizes) - 1])
    if lacing == 1:
        return head + b"".join(b"\xff" * (x // 255) + bytes([x % 255]) for x in sizes[:-1])
    if lacing == 2:
        return head
    out, last = head + _vint(sizes[0], 2), sizes[0]
    for x in sizes[1:-1]:  # differences, moved into the range of unsigned numbers
        out, last = out + _vint(x - last + (1 << 13) - 1, 2), x
    return out


def mux(payload: bytes) -> bytes:
    """A Matroska file of one 8-bit mono PCM track that holds `payload`, whole units of it."""
    if not payload or len(payload) % UNIT:
        raise ValueError("a payload has a positive multiple of the unit's bytes")
    head = _element(EBML, _element(DOC_TYPE, b"matroska") + _uint(DOC_TYPE_VERSION, 4) + _uint(DOC_TYPE_READ, 2))
    info = _element(INFO, _uint(SCALE, 1_000_000) + _element(DURATION, struct.pack(">d", len(payload) / SAMPLES_PER_MS)) + _element(MUXER, b"kinmatch") + _element(WRITER, b"kinmatch"))
    audio = _element(AUDIO, _element(RATE, struct.pack(">d", 1000.0 * SAMPLES_PER_MS)) + _uint(CHANNELS, 1) + _uint(DEPTH, 8))
    tracks = _element(TRACKS, _element(TRACK, _uint(NUMBER, 1) + _uint(UID, 1) + _uint(KIND, 2) + _element(CODEC, b"A_PCM/INT/LIT") + audio))
    parts, cues, at, done, k = [info, tracks], [], len(info) + len(tracks), 0, 0
    while done < len(payload):
        start = done // SAMPLES_PER_MS
        body = [_uint(TIMESTAMP, start)]
        for _ in range(BLOCKS_PER_CLUSTER):
            left = len(payload) - done
            if not left:
                break
            sizes, lacing = PATTERNS[k % len(PATTERNS)]
            if sum(sizes) > left:
                sizes, lacing = (UNIT,) * (left // UNIT), 2 if left > UNIT else 0
            when = struct.pack(">h", done // SAMPLES_PER_MS - start)
            body.append(_element(SIMPLE_BLOCK, b"\x81" + when + bytes([0x80 | lacing << 1]) + _laces(sizes, lacing) + payload[done : done + sum(sizes)]))
            done, k = done + sum(sizes), k + 1
        cluster = _element(CLUSTER, b"".join(body))
        cues.append(_element(CUE, _uint(CUE_TIME, start) + _element(CUE_AT, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    parts.append(_element(CUES, b"".join(cues)))
    return head + _element(SEGMENT, b"".join(parts))


def _read_vint(data: memoryview, at: int, keep_mark: bool = False) -> tuple[int, int]:
    """The number and the place after it; -1 for the size that means unknown."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length number at byte {at}")
    width = 9 - data[at].bit_length()
    n = int.from_bytes(data[at : at + width], "big")
    if keep_mark:
        return n, at + width
    n &= (1 << 7 * width) - 1
    return (-1 if n == (1 << 7 * width) - 1 else n), at + width


def _walk(data: memoryview, at: int, end: int, depth: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(id, place of the element, place of its body, its end), masters before their children."""
    while at < end:
        id_, p = _read_vint(data, at, keep_mark=True)
        size, body = _read_vint(data, p)
        stop = end if size < 0 else body + size
        if stop > end:
            raise ValueError(f"the element at byte {at} is longer than what holds it")
        if size < 0 and id_ == CLUSTER:  # of unknown size: up to the next element of the segment
            stop = body
            while stop < end:
                child, q = _read_vint(data, stop, keep_mark=True)
                if child in (CLUSTER, CUES, TRACKS, INFO):
                    break
                n, q = _read_vint(data, q)
                stop = q + n
        yield id_, at, body, stop
        if id_ in MASTERS:
            yield from _walk(data, body, stop, depth + 1)
        at = stop


def _lace_sizes(data: memoryview, at: int, end: int, lacing: int) -> tuple[list[int], int]:
    if lacing == 0:
        return [end - at], at
    n, at = data[at] + 1, at + 1
    if lacing == 2:
        if (end - at) % n:
            raise ValueError("fixed-size laces don't divide their block")
        return [(end - at) // n] * n, at
    sizes = []
    for k in range(n - 1):
        if lacing == 1:
            x = 0
            while data[at] == 255:
                x, at = x + 255, at + 1
            x, at = x + data[at], at + 1
        else:
            first = at
            x, at = _read_vint(data, at)
            if k:
                x += sizes[-1] - ((1 << 7 * (at - first) - 1) - 1)
        sizes.append(x)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laces are longer than their block")
    return sizes, at


def demux(media: bytes) -> Media:
    """The packet table of a Matroska file, its tracks, clusters and cues."""
    data = memoryview(media)
    if int.from_bytes(data[:4], "big") != EBML:
        raise ValueError("not an EBML file")
    tracks: dict[int, dict] = {}
    packets: list[Packet] = []
    clusters: list[tuple[int, int]] = []
    cues: list[tuple[int, int, int]] = []
    track: dict = {}
    segment, scale, duration, cue_time, cue_track, n_blocks = 0, 1_000_000, 0.0, 0, 0, 0
    number = lambda a, b: int.from_bytes(data[a:b], "big")
    real = lambda a, b: struct.unpack(">d" if b - a == 8 else ">f", data[a:b])[0]
    for id_, at, a, b in _walk(data, 0, len(data)):
        if id_ == SEGMENT:
            segment = a
        elif id_ == SCALE:
            scale = number(a, b)
        elif id_ == DURATION:
            duration = real(a, b)
        elif id_ == TRACK:
            track = {}
        elif id_ == NUMBER:
            track["number"] = number(a, b)
            tracks[track["number"]] = track
        elif id_ == CODEC:
            track["codec"] = bytes(data[a:b]).decode()
        elif id_ == RATE:
            track["rate"] = real(a, b)
        elif id_ in (CHANNELS, DEPTH, KIND):
            track[{CHANNELS: "channels", DEPTH: "depth", KIND: "kind"}[id_]] = number(a, b)
        elif id_ == CLUSTER:
            clusters.append((at, 0))
        elif id_ == TIMESTAMP and clusters:
            clusters[-1] = (clusters[-1][0], number(a, b))
        elif id_ in (SIMPLE_BLOCK, BLOCK):
            which, p = _read_vint(data, a)
            when = clusters[-1][1] + struct.unpack(">h", data[p : p + 2])[0]
            lacing = data[p + 2] >> 1 & 3
            sizes, p = _lace_sizes(data, p + 3, b, lacing)
            of = tracks.get(which, {})
            per_ms = of.get("rate", 0.0) * of.get("channels", 1) * of.get("depth", 8) / 8000.0
            t = when * scale / 1e6
            for x in sizes:
                packets.append(Packet(which, len(clusters) - 1, n_blocks, lacing, t, p, x))
                p, t = p + x, t + (x / per_ms if per_ms else 0.0)
            n_blocks += 1
        elif id_ == CUE_TIME:
            cue_time = number(a, b)
        elif id_ == CUE_TRACK:
            cue_track = number(a, b)
        elif id_ == CUE_CLUSTER:
            cues.append((cue_time, cue_track, segment + number(a, b)))
    return Media(tracks, packets, clusters, cues, duration * scale / 1e6)


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and those padded with 255 to a positive multiple of the unit."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + b"\xff" * (max(1, -(-len(raw) // UNIT)) * UNIT - len(raw))


def feature_of(media: bytes, parsed: Media, payload: bytes) -> str:
    import numpy as np

    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    lacings = [len({p.block for p in parsed.packets if p.lacing == k}) for k in range(4)]
    good = sum(any(c == (at, t) for c in parsed.clusters) for t, _, at in parsed.cues) if len(parsed.cues) < 64 else len(set(parsed.clusters) & {(at, t) for t, _, at in parsed.cues})
    return (
        f"packets={len(parsed.packets)};clusters={len(parsed.clusters)};cues={good}/{len(parsed.cues)};lacing={'/'.join(map(str, lacings))};"
        f"duration_ms={parsed.duration_ms:.3f};last_ms={parsed.packets[-1].timestamp_ms:.3f};sum={int(x.sum())};energy={int((x * x).sum())};crossings={int(np.count_nonzero(np.diff(x > 127)))}"
    )


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, and media: the Matroska file of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, max(1, b.num_rows), 256):
                part = b.slice(k, 256)
                made = [(n, mux(p)) for n, p in (payload_of(t.as_py()) for t in part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([m for _, m in made], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, "doc_id long, n_bytes long, media binary")


PACKETS = "doc_id long, track int, cluster int, block int, lacing int, timestamp_ms double, byte_start long, byte_size long"


def packet_table(stored: DataFrame) -> DataFrame:
    """One row per packet of each `media` of (doc_id, media)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *Packet._fields]
        kinds = [pa.int64(), *[pa.int32()] * 4, pa.float64(), pa.int64(), pa.int64()]
        for b in batches:
            for doc_id, media in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [(doc_id, *p) for p in demux(media.as_py()).packets]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return map_batches(stored.select("doc_id", "media"), run, PACKETS)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def digest(stored: DataFrame) -> DataFrame:
    """What was stored, read back through the packet table of each media."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, n, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                media = media.as_py()
                parsed = demux(media)
                payload = b"".join(media[p.byte_start : p.byte_start + p.byte_size] for p in parsed.packets)
                out.append((doc_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(media, parsed, payload)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = [x.split()[0] for x in DIGEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return map_batches(stored.select("doc_id", "n_bytes", "media"), run, DIGEST)


def op4_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(store(texts(spark, sf_dir)))
