"""Media columns in Matroska (operator 9): bytes stored as 8-bit PCM, parsed into packet tables.

The writer makes whole files: EBML header, segment, info, one audio track (8-bit, mono), clusters of
simple blocks that use every kind of lacing, and cues.  The parser reads any file of this structure:
variable-length identifiers and sizes, sizes left unknown, blocks and block groups, no, Xiph, EBML
and fixed lacing, and cues; it returns a packet a frame with its track, time and byte range.

Edge cases: null and empty texts are one padding block of 64 zero bytes.  Texts of any length are
stored whole, and in frames of bounded size.  Equal bytes give equal files.  A file that breaks off
inside an element raises ValueError.  An empty table gives no rows; extra columns are ignored.
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

from folioql.llm._common import batches_of

# Element identifiers of the Matroska and EBML specifications.
EBML, EBML_VERSION, EBML_READ, EBML_IDS, EBML_SIZES, DOC_TYPE, DOC_VERSION, DOC_READ = 0x1A45DFA3, 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4282, 0x4287, 0x4285
SEGMENT, INFO, SCALE, TRACKS, TRACK, NUMBER, UID, KIND, LACING, CODEC, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86, 0x23E383
AUDIO, RATE, CHANNELS, DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIME, SIMPLE, GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE, CUE_TIME, CUE_PLACE, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {EBML, SEGMENT, INFO, TRACKS, TRACK, AUDIO, CLUSTER, GROUP, CUES, CUE, CUE_PLACE}
TOP = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1043A770, 0x1941A469, 0x1254C367}
NONE, XIPH, FIXED, EBML_LACE = 0, 1, 2, 3

SAMPLE_RATE, TICK_NS = 8000, 1_000_000
FRAME, LACE, BLOCKS = 2048, 8, 4  # bytes a frame, frames a block, blocks a cluster
UNIT = 64


def vint(value: int, width: int | None = None) -> bytes:
    """A size as a variable-length integer (all ones is kept for unknown sizes)."""
    n = width or next(k for k in range(1, 9) if value < (1 << 7 * k) - 1)
    return (value | 1 << 7 * n).to_bytes(n, "big")


def element(identifier: int, body: bytes) -> bytes:
    return identifier.to_bytes((identifier.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def unsigned(identifier: int, value: int) -> bytes:
    return element(identifier, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], kind: int) -> bytes:
    """The body of a block behind its flags."""
    if kind == NONE:
        return frames[0]
    head = bytes([len(frames) - 1])
    if kind == XIPH:
        head += b"".join(b"\xff" * (len(f) // 255) + bytes([len(f) % 255]) for f in frames[:-1])
    elif kind == EBML_LACE:
        head += vint(len(frames[0]))
        for before, f in zip(frames, frames[1:-1]):
            step = len(f) - len(before)
            n = next(k for k in range(1, 9) if abs(step) < 1 << 7 * k - 1)
            head += vint(step + (1 << 7 * n - 1) - 1, n)
    return head + b"".join(frames)


_HEAD = element(EBML, unsigned(EBML_VERSION, 1) + unsigned(EBML_READ, 1) + unsigned(EBML_IDS, 4) + unsigned(EBML_SIZES, 8) + element(DOC_TYPE, b"matroska") + unsigned(DOC_VERSION, 4) + unsigned(DOC_READ, 2))
_INFO = element(INFO, unsigned(SCALE, TICK_NS))
_TRACKS = element(
    TRACKS,
    element(
        TRACK,
        unsigned(NUMBER, 1) + unsigned(UID, 1) + unsigned(KIND, 2) + unsigned(LACING, 1) + element(CODEC, b"A_PCM/INT/LIT") + unsigned(DURATION, FRAME * 10**9 // SAMPLE_RATE)
        + element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)) + unsigned(CHANNELS, 1) + unsigned(DEPTH, 8)),
    ),
)


def mux(payload: bytes) -> bytes:
    """A Matroska file whose only track is `payload` as 8-bit samples."""
    body, at, cues = [_INFO, _TRACKS], len(_INFO) + len(_TRACKS), []
    for low in range(0, len(payload), FRAME * LACE * BLOCKS):
        start = low * 1000 // SAMPLE_RATE
        parts = [unsigned(TIME, start)]
        for nth, k in enumerate(range(low, min(len(payload), low + FRAME * LACE * BLOCKS), FRAME * LACE)):
            block = payload[k : k + FRAME * LACE]
            frames = [block[i : i + FRAME] for i in range(0, len(block), FRAME)]
            kind = NONE if len(frames) == 1 else FIXED if len(frames[-1]) == FRAME else (EBML_LACE, XIPH)[nth % 2]
            parts.append(element(SIMPLE, b"\x81" + struct.pack(">hB", k * 1000 // SAMPLE_RATE - start, 0x80 | kind << 1) + lace(frames, kind)))
        cluster = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE, unsigned(CUE_TIME, start) + element(CUE_PLACE, unsigned(CUE_TRACK, 1) + unsigned(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    return _HEAD + element(SEGMENT, b"".join(body) + element(CUES, b"".join(cues)))


# --- parsing ----------------------------------------------------------------------------------


@dataclass
class Packet:
    track: int
    time_ns: int
    offset: int
    length: int
    keyframe: bool
    lacing: int
    cluster: int


@dataclass
class Media:
    doc_type: str = ""
    tick_ns: int = TICK_NS
    tracks: dict[int, dict] = field(default_factory=dict)
    packets: list[Packet] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)  # time in ns, track, cluster's file offset
    clusters: list[int] = field(default_factory=list)


def read_vint(data: bytes, at: int, keep_marker: bool = False) -> tuple[int, int]:
    """Value and width of a variable-length integer; -1 for a size left unknown."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at {at}")
    n = 9 - data[at].bit_length()
    raw = data[at : at + n]
    if len(raw) < n:
        raise ValueError(f"the file breaks off at {at}")
    value = int.from_bytes(raw, "big")
    if keep_marker:
        return value, n
    value ^= 1 << 7 * n
    return (-1 if value == (1 << 7 * n) - 1 else value), n


def elements(data: bytes, at: int, end: int, inside: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """Identifier, start, body and end of the elements side by side in a range."""
    while at < end:
        start = at
        identifier, n = read_vint(data, at, True)
        size, m = read_vint(data, at + n)
        body = at + n + m
        if size < 0:  # unknown: a cluster lasts to the next top element, a segment to the end
            close = body
            if identifier == CLUSTER:
                while close < end and (inner := read_vint(data, close, True))[0] not in TOP:
                    inner_size, k = read_vint(data, close + inner[1])
                    close += inner[1] + k + inner_size
            else:
                close = end
        else:
            close = body + size
        if close > end:
            raise ValueError(f"the element at {start} breaks off")
        yield identifier, start, body, close
        at = close


def unlace(data: bytes, at: int, end: int, kind: int) -> list[int]:
    """Sizes of the frames of a block, the first of which starts where the returned list's head says."""
    if kind == NONE:
        return [at, end - at]
    count, at = data[at] + 1, at + 1
    sizes: list[int] = []
    if kind == FIXED:
        sizes = [(end - at) // count] * count
        if sum(sizes) != end - at:
            raise ValueError("fixed lacing does not divide the block")
        return [at, *sizes]
    for k in range(count - 1):
        if kind == XIPH:
            size = 0
            while data[at] == 255:
                size, at = size + 255, at + 1
            size, at = size + data[at], at + 1
        else:
            value, n = read_vint(data, at)
            value = (1 << 7 * n) - 1 if value < 0 else value
            size = value if k == 0 else sizes[-1] + value - ((1 << 7 * n - 1) - 1)
            at += n
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("lace sizes exceed the block")
    return [at, *sizes]


def demux(data: bytes) -> Media:
    media = Media()
    number = lambda body, close: int.from_bytes(data[body:close], "big")
    for top, _, body, close in elements(data, 0, len(data)):
        if top == EBML:
            media.doc_type = next((data[b:c].decode("ascii", "replace") for i, _, b, c in elements(data, body, close) if i == DOC_TYPE), "")
        elif top == SEGMENT:
            _segment(data, media, body, close, number)
    return media


def _segment(data: bytes, media: Media, first: int, end: int, number) -> None:
    for part, start, body, close in elements(data, first, end):
        if part == INFO:
            media.tick_ns = next((number(b, c) for i, _, b, c in elements(data, body, close) if i == SCALE), TICK_NS)
        elif part == TRACKS:
            for i, _, b, c in elements(data, body, close):
                if i == TRACK:
                    found = {j: (x, y) for j, _, x, y in elements(data, b, c)}
                    audio = {j: (x, y) for j, _, x, y in elements(data, *found[AUDIO])} if AUDIO in found else {}
                    rate = data[slice(*audio[RATE])] if RATE in audio else b""
                    media.tracks[number(*found[NUMBER])] = {
                        "kind": number(*found[KIND]), "codec": data[slice(*found[CODEC])].decode("ascii", "replace"), "frame_ns": number(*found[DURATION]) if DURATION in found else 0,
                        "rate": struct.unpack(">d" if len(rate) == 8 else ">f", rate)[0] if rate else 0.0, "bits": number(*audio[DEPTH]) if DEPTH in audio else 0,
                    }
        elif part == CLUSTER:
            media.clusters.append(start)
            base = 0
            for i, _, b, c in elements(data, body, close):
                if i == TIME:
                    base = number(b, c)
                elif i == SIMPLE:
                    _block(data, media, b, c, base, start, None)
                elif i == GROUP:
                    for j, _, x, y in elements(data, b, c):
                        if j == BLOCK:
                            _block(data, media, x, y, base, start, False)
        elif part == CUES:
            for i, _, b, c in elements(data, body, close):
                found = {j: (x, y) for j, _, x, y in elements(data, b, c)}
                place = {j: (x, y) for j, _, x, y in elements(data, *found[CUE_PLACE])}
                media.cues.append((number(*found[CUE_TIME]) * media.tick_ns, number(*place[CUE_TRACK]), first + number(*place[CUE_CLUSTER])))


def _block(data: bytes, media: Media, at: int, end: int, base: int, cluster: int, keyframe: bool | None) -> None:
    track, n = read_vint(data, at)
    ticks, flags = struct.unpack_from(">hB", data, at + n)
    kind = flags >> 1 & 3
    offset, *sizes = unlace(data, at + n + 3, end, kind)
    time, each = (base + ticks) * media.tick_ns, media.tracks.get(track, {}).get("frame_ns", 0)
    for k, size in enumerate(sizes):
        media.packets.append(Packet(track, time + k * each, offset, size, bool(flags & 0x80) if keyframe is None else keyframe, kind, cluster))
        offset += size


def samples(data: bytes, media: Media, track: int = 1) -> bytes:
    """The stored bytes of a track, from its byte ranges."""
    return b"".join([data[p.offset : p.offset + p.length] for p in media.packets if p.track == track])


# --- columns ----------------------------------------------------------------------------------


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8")
    return len(raw), raw + b"\0" * (UNIT - len(raw) % UNIT if len(raw) % UNIT or not raw else 0)


def features(payload: bytes, media: Media) -> str:
    """Packets, milliseconds, and level, power and sign changes of the samples about their middle."""
    x = np.frombuffer(payload, np.uint8).astype(np.float32) - 128
    changes = int(np.count_nonzero(np.diff(x >= 0)))
    return f"packets={len(media.packets)};ms={len(payload) * 1000 // SAMPLE_RATE};cues={len(media.cues)};mean={x.mean(dtype=np.float64):.3f};rms={np.sqrt(np.square(x).mean(dtype=np.float64)):.3f};zcr={changes / len(x):.4f}"


def encode_media(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id and `media`, the Matroska file of each text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([mux(padded(t)[1]) for t in batches_of(part, text)[0]], pa.binary())], names=[id_column, "media"])

    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, media binary")


def packet_table(files: DataFrame, id_column: str = "doc_id", media: str = "media") -> DataFrame:
    """A row per packet: id, nth, track, time_ns, cluster, offset, length, keyframe and lacing."""
    kind = files.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [demux(m).packets if m else [] for m in batches_of(part, media)[0]]
                rows = [(k, n, p) for k, ps in enumerate(found) for n, p in enumerate(ps)]
                keys = part.column(0).take(pa.array([k for k, _, _ in rows], pa.int64()))
                kinds = {"track": pa.int32(), "time_ns": pa.int64(), "cluster": pa.int64(), "offset": pa.int64(), "length": pa.int64(), "keyframe": pa.bool_(), "lacing": pa.int32()}
                yield pa.RecordBatch.from_arrays([keys, pa.array([n for _, n, _ in rows], pa.int32()), *(pa.array([getattr(p, c) for _, _, p in rows], t) for c, t in kinds.items())], names=[id_column, "nth", *kinds])

    return files.select(id_column, media).mapInArrow(run, f"`{id_column}` {kind}, nth int, track int, time_ns long, cluster long, offset long, length long, keyframe boolean, lacing int")


def media_digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Store each text, read it back by the packet table, and reduce to sizes, digests and features in the worker."""
    kind = docs.schema[id_column].dataType.simpleString()
    columns = {"n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def row(text):
        n, payload = padded(text)
        stored = mux(payload)
        media = demux(stored)
        read = samples(stored, media)
        if any(c not in media.clusters for _, _, c in media.cues):
            raise ValueError("a cue points beside the clusters")
        return n, len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), features(read, media)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = list(zip(*map(row, batches_of(part, text)[0])))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v, t) for v, t in zip(rows, columns.values()))], names=[id_column, *columns])

    return docs.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
