"""Operator 1, media columns: Matroska files as binary columns, parsed into packet tables.

`parse` walks variable-length EBML elements (known and unknown sizes), clusters, simple blocks and block groups,
all three lacings and the cues, and gives one packet per frame with track, timestamp and byte range; frames of a lace
follow each other by the track's default duration. An element of unknown size ends where one begins that can't be its
child, at the latest with its parent; a child that reaches beyond its parent is an error. `mux` writes payloads
losslessly as 8-bit PCM.

Nulls are empty texts; very long ones are files of many clusters, read in one pass. A truncated or foreign file gives
the packets found before the damage and its `error`. Equal texts give equal files (ties), repeated rows repeated
results, an empty table an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, table
from .textvec import batches_of

# Element ids of the Matroska format.
EBML, SEGMENT, INFO, SCALE = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x2AD7B1
TRACKS, TRACK_ENTRY, TRACK_NUMBER, CODEC, DURATION = 0x1654AE6B, 0xAE, 0xD7, 0x86, 0x23E383
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS, VOID, CRC = 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469, 0xEC, 0xBF
CLUSTER_PARTS = (TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, 0xA7, 0xAB, 0x5854, 0xAF)  # also position, previous size, silent tracks, encrypted block
GROUP_PARTS = (BLOCK, REFERENCE, 0x9B, 0xFA, 0xFD, 0xA4, 0x75A1, 0x75A2, 0x8E, 0xA2)
TOP, SEGMENT_PARTS = (EBML, SEGMENT), (INFO, TRACKS, CLUSTER, CUES, SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS)

RATE = 8000  # samples a second of a written payload
SCALE_NS = 1_000_000_000 // RATE  # so that a tick is a sample
FRAME, LACE, BLOCKS = 512, 8, 7  # samples a frame, frames a block, blocks a cluster (fits the 16-bit offset)


@dataclass
class Media:
    packets: list[tuple[int, int, int, int, bool]] = field(default_factory=list)  # track, ns, offset, size, key
    clusters: list[tuple[int, int]] = field(default_factory=list)  # ticks, offset in the segment
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # ticks, track, cluster offset
    codecs: dict[int, str] = field(default_factory=dict)
    durations: dict[int, int] = field(default_factory=dict)  # of a track's frames, in ns
    scale: int = 1_000_000
    error: str | None = None


def read_id(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4 or at + width > len(data):
        raise ValueError(f"bad element id at {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def read_vint(data: bytes, at: int) -> tuple[int, int, int]:
    """(value or -1 if all its bits are set, next position, width)."""
    width = 9 - data[at].bit_length()
    if width > 8 or at + width > len(data):
        raise ValueError(f"bad vint at {at}")
    value = int.from_bytes(data[at : at + width], "big") & ((1 << 7 * width) - 1)
    return (-1 if value == (1 << 7 * width) - 1 else value), at + width, width


def _unsigned(data: bytes, lo: int, hi: int) -> int:
    return int.from_bytes(data[lo:hi], "big")


def _block(data: bytes, lo: int, hi: int, base: int, media: Media, key: bool | None) -> None:
    track, at, _ = read_vint(data, lo)
    (offset,) = struct.unpack_from(">h", data, at)
    flags, at = data[at + 2], at + 3
    lacing, sizes = flags >> 1 & 3, []
    if lacing:
        count, at = data[at] + 1, at + 1
        if lacing == 1:
            for _ in range(count - 1):
                size = 0
                while data[at] == 255:
                    size, at = size + 255, at + 1
                sizes.append(size + data[at])
                at += 1
        elif lacing == 3 and count > 1:
            size, at, _ = read_vint(data, at)
            sizes.append(size)
            for _ in range(count - 2):
                width = 9 - data[at].bit_length()
                raw = int.from_bytes(data[at : at + width], "big") & ((1 << 7 * width) - 1)
                size += raw - ((1 << 7 * width - 1) - 1)
                at += width
                sizes.append(size)
        elif lacing == 2:
            if (hi - at) % count:
                raise ValueError(f"uneven fixed lacing at {lo}")
            sizes = [(hi - at) // count] * (count - 1)
    sizes.append(hi - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError(f"bad lacing at {lo}")
    ns = (base + offset) * media.scale
    for k, size in enumerate(sizes):
        media.packets.append((track, ns + k * media.durations.get(track, 0), at, size, bool(flags & 0x80) if key is None else key))
        at += size


def parse(data: bytes) -> Media:
    """All packets of a file, and its error if it has one."""
    media = Media()
    try:
        _top(data, media)
    except (ValueError, IndexError, struct.error) as wrong:
        media.error = str(wrong)
    return media


def _head(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """(id, where the content begins, where it ends or -1 if that isn't known) of the element at a place."""
    begin = at
    name, at = read_id(data, at)
    size, at, _ = read_vint(data, at)
    if at > end or size >= 0 and at + size > end:
        raise ValueError(f"element at {begin} is cut short")
    return name, at, -1 if size < 0 else at + size


def _skip(data: bytes, name: int, at: int, end: int) -> int:
    """Where an element of unknown size ends that isn't read: at the next one of a level above its children's."""
    while at < end:
        inner, content, stop = _head(data, at, end)
        if inner in TOP or name != SEGMENT and inner in SEGMENT_PARTS:
            break
        at = _skip(data, inner, content, end) if stop < 0 else stop
    return at


def _top(data: bytes, media: Media) -> None:
    at = 0
    while at < len(data):
        name, content, stop = _head(data, at, len(data))
        if name == SEGMENT:
            at = _segment(data, content, stop if stop >= 0 else len(data), stop < 0, media)
        else:
            at = stop if stop >= 0 else _skip(data, name, content, len(data))


def _segment(data: bytes, at: int, end: int, open_: bool, media: Media) -> int:
    base = at
    while at < end:
        begin = at
        name, content, stop = _head(data, at, end)
        if open_ and name in TOP:
            break
        last = end if stop < 0 else stop
        if name == CLUSTER:
            at = _cluster(data, content, last, stop < 0, begin - base, media)
            continue
        if name in (INFO, TRACKS, CUES):
            if stop < 0:
                last = _skip(data, name, content, end)
            for child, lo, hi in _children(data, content, last):
                if child == SCALE:
                    media.scale = _unsigned(data, lo, hi)
                elif child == TRACK_ENTRY:
                    _track(data, lo, hi, media)
                elif child == CUE_POINT:
                    _cue(data, lo, hi, media)
            at = last
        else:
            at = stop if stop >= 0 else _skip(data, name, content, end)
    return at


def _cluster(data: bytes, at: int, end: int, open_: bool, place: int, media: Media) -> int:
    base = 0
    media.clusters.append((0, place))
    while at < end:
        name, content, stop = _head(data, at, end)
        if open_ and name not in CLUSTER_PARTS and name not in (VOID, CRC):
            break
        if name == BLOCK_GROUP:
            at = _group(data, content, end if stop < 0 else stop, stop < 0, base, media)
            continue
        if stop < 0:
            raise ValueError(f"element at {at} needs a size")
        if name == TIMESTAMP:
            base = _unsigned(data, content, stop)
            media.clusters[-1] = (base, place)
        elif name == SIMPLE_BLOCK:
            _block(data, content, stop, base, media, None)
        at = stop
    return at


def _group(data: bytes, at: int, end: int, open_: bool, base: int, media: Media) -> int:
    blocks, key = [], True
    while at < end:
        name, content, stop = _head(data, at, end)
        if open_ and name not in GROUP_PARTS and name not in (VOID, CRC):
            break
        if stop < 0:
            raise ValueError(f"element at {at} needs a size")
        if name == BLOCK:
            blocks.append((content, stop))
        key &= name != REFERENCE
        at = stop
    for lo, hi in blocks:
        _block(data, lo, hi, base, media, key)
    return at


def _children(data: bytes, at: int, end: int):
    """(id, begin, end) of the content of each child; one of unknown size reaches to its parent's end."""
    while at < end:
        name, at, stop = _head(data, at, end)
        yield name, at, end if stop < 0 else stop
        at = end if stop < 0 else stop


def _track(data: bytes, lo: int, hi: int, media: Media) -> None:
    found = {name: (a, b) for name, a, b in _children(data, lo, hi)}
    number = _unsigned(data, *found[TRACK_NUMBER]) if TRACK_NUMBER in found else 0
    media.codecs[number] = bytes(data[slice(*found[CODEC])]).decode("ascii", "replace") if CODEC in found else ""
    if DURATION in found:
        media.durations[number] = _unsigned(data, *found[DURATION])


def _cue(data: bytes, at: int, end: int, media: Media) -> None:
    time = 0
    for name, lo, hi in _children(data, at, end):
        if name == CUE_TIME:
            time = _unsigned(data, lo, hi)
        elif name == CUE_POSITIONS:
            inner = {k: _unsigned(data, a, b) for k, a, b in _children(data, lo, hi) if b - a <= 8}
            media.cues.append((time, inner.get(CUE_TRACK, 0), inner.get(CUE_CLUSTER, 0)))


def vint(value: int) -> bytes:
    width = max(1, -(-(value + 1).bit_length() // 7))
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(identity: int, *content: bytes) -> bytes:
    body = b"".join(content)
    return identity.to_bytes(-(-identity.bit_length() // 8), "big") + vint(len(body)) + body


def _number(identity: int, value: int) -> bytes:
    return element(identity, value.to_bytes(max(1, -(-value.bit_length() // 8)), "big"))


_HEADER = element(
    EBML, _number(0x4286, 1), _number(0x42F7, 1), _number(0x42F2, 4), _number(0x42F3, 8), element(0x4282, b"matroska"), _number(0x4287, 4), _number(0x4285, 2)
)
_SETUP = element(INFO, _number(SCALE, SCALE_NS)) + element(
    TRACKS,
    element(
        TRACK_ENTRY, _number(TRACK_NUMBER, 1), _number(0x73C5, 1), _number(0x83, 2), _number(DURATION, FRAME * SCALE_NS), element(CODEC, b"A_PCM/INT/LIT"),
        element(0xE1, element(0xB5, struct.pack(">d", RATE)), _number(0x9F, 1), _number(0x6264, 8)),
    ),
)


def mux(payload: bytes) -> bytes:
    """payload as 8-bit samples of one audio track: laced simple blocks in clusters, and a cue for each cluster."""
    parts, cues, at = [_SETUP], [], len(_SETUP)
    for lo in range(0, len(payload), FRAME * LACE * BLOCKS):
        blocks = []
        for begin in range(lo, min(len(payload), lo + FRAME * LACE * BLOCKS), FRAME * LACE):
            body = payload[begin : begin + FRAME * LACE]
            sizes = [min(FRAME, len(body) - k) for k in range(0, len(body), FRAME)]
            head = b"\x81" + struct.pack(">h", begin - lo)
            if len(sizes) == 1:
                lace = head + b"\x80"
            elif sizes[-1] == FRAME:
                lace = head + bytes([0x84, len(sizes) - 1])
            else:  # differences of the middle frames are 0: their one-byte form is 0xBF
                lace = head + bytes([0x86, len(sizes) - 1]) + vint(FRAME) + b"\xbf" * (len(sizes) - 2)
            blocks.append(element(SIMPLE_BLOCK, lace, body))
        cluster = element(CLUSTER, _number(TIMESTAMP, lo), *blocks)
        cues.append(element(CUE_POINT, _number(CUE_TIME, lo), element(CUE_POSITIONS, _number(CUE_TRACK, 1), _number(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    return _HEADER + element(SEGMENT, *parts, element(CUES, *cues))


def padded(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 or (0 if text else 64))


def features(media: Media, payload: bytes) -> str:
    """Of the samples read back: level, loudness, crossings of the middle, distinct values; and the file's shape."""
    if not payload:
        return "empty"
    x = np.frombuffer(payload, np.uint8)
    total, energy = int(x.sum(dtype=np.int64)), int(np.square(x.astype(np.int32) - 128).sum(dtype=np.int64))
    high = x >= 128
    crossings = int(np.count_nonzero(high[1:] != high[:-1]))
    there = set(media.clusters)
    seek = sum((time, at) in there for time, _, at in media.cues)
    return f"packets={len(media.packets)};clusters={len(media.clusters)};cues={seek};mean={total / len(x):.4f};rms={(energy / len(x)) ** 0.5:.4f};crossings={crossings};values={len(np.unique(x))}"


def packets(df: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """Packet table of a binary column: (key, packet, track, timestamp_ns, offset, size, keyframe, error).

    A file without packets gives one row with null packet fields; a null file counts as empty.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for one, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = parse(blob.as_py() or b"")
                rows = [(i, *p) for i, p in enumerate(found.packets)] or [(None,) * 6]
                cols = list(zip(*rows))
                yield pa.record_batch(
                    [pa.array([one] * len(rows), batch.schema.field(0).type), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5]), pa.array(cols[5], pa.bool_()), pa.array([found.error] * len(rows), pa.string())],
                    ["key", "packet", "track", "timestamp_ns", "offset", "size", "keyframe", "error"],
                )

    out = arrow_map(df.select(key, media), run, f"key {kind}, packet long, track int, timestamp_ns long, offset long, size long, keyframe boolean, error string")
    return out.withColumnRenamed("key", key)


def encode(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, media): every whole text, padded, as a Matroska file; n_bytes without the padding."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches_of(batches):
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([mux(padded(r)) for r in raw], pa.binary())], ["key", "n_bytes", "media"])

    return arrow_map(df.select(df[key].alias("key"), df[text].alias("text")), run, f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_packets long, duration_ns long"


def digests(stored: DataFrame) -> DataFrame:
    """Per row of stored (doc_id, n_bytes, media): the file parsed, and what the byte ranges of its packets hold. A
    damaged file fails the query."""

    def run(batches):
        for batch in batches:
            rows = []
            for doc, size, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                blob = blob.as_py()
                media = parse(blob)
                if media.error:
                    raise ValueError(media.error)
                payload = b"".join([blob[at : at + n] for _, _, at, n, _ in media.packets])
                end = max((ns + n * media.scale for _, ns, _, n, _ in media.packets), default=0)
                rows.append((doc, size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(blob), hashlib.sha256(blob).hexdigest(), features(media, payload), len(media.packets), end))
            if rows:
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in SCHEMA.split(", ")])

    return arrow_map(stored.select(stored["doc_id"].cast("long").alias("doc_id"), "n_bytes", "media"), run, SCHEMA)


def op1_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
