"""ISO media containers in a binary column: boxes are walked and sample tables decoded; payloads are not.

`scan_media` describes any container. `store_samples` keeps bytes losslessly as 8-bit audio samples in such a container,
and `read_samples` gets them back through the sample tables.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .arrow import append, pieces

#: Boxes that hold boxes, and bytes that stand before them inside some.
CONTAINERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"dinf": 0, b"edts": 0, b"udta": 0, b"moof": 0, b"traf": 0, b"mvex": 0, b"meta": 4}
#: The stored form: samples a second, samples in a packet (a sample of the tables), packets in a chunk, packets from one sync point to the next.
RATE, PACKET, CHUNK, SYNC = 8_000, 64, 64, 16
#: Boxes inside boxes, at most.
MOST_DEEP = 16
RANGES = ArrayType(StructType([StructField("offset", LongType()), StructField("length", LongType())]))
TRACK = StructType([
    StructField("track_id", LongType()), StructField("handler", StringType()), StructField("codec", StringType()), StructField("timescale", LongType()),
    StructField("duration", LongType()), StructField("samples", LongType()),
    StructField("keyframes", RANGES),
])


class BrokenMedia(ValueError):
    """The bytes are not a well-formed container."""


def _read(data: bytes, layout: str, at: int, end: int) -> tuple:
    """Numbers of a box, which must lie inside it."""
    if at + struct.calcsize(layout) > end:
        raise BrokenMedia("a box is too short for its fields")
    return struct.unpack_from(layout, data, at)


def boxes(data: bytes, start: int = 0, end: int | None = None) -> Iterator[tuple[bytes, int, int, int]]:
    """(type, first byte, first byte of the body, end) of the boxes in a range: 32-bit and 64-bit sizes, and 0 for 'to the end'."""
    end = len(data) if end is None else end
    while start < end:
        size, kind = _read(data, ">I4s", start, end)
        body = start + 8
        if size == 1:
            size, body = _read(data, ">Q", body, end)[0], body + 8
        elif size == 0:
            size = end - start
        if kind == b"uuid":
            body += 16
        if size < body - start or start + size > end:
            raise BrokenMedia("a box is larger than what holds it")
        yield kind, start, body, start + size
        start += size


def walk(data: bytes) -> Iterator[tuple[tuple[bytes, ...], int, int, int]]:
    """(path, first byte, body, end) of all boxes, a parent before its children, by an explicit stack."""
    stack = [(boxes(data), ())]
    while stack:
        level, path = stack[-1]
        box = next(level, None)
        if box is None:
            stack.pop()
            continue
        kind, start, body, end = box
        yield (*path, kind), start, body, end
        if kind in CONTAINERS and end - body >= CONTAINERS[kind]:
            if len(path) >= MOST_DEEP:
                raise BrokenMedia("boxes are nested too deep")
            stack.append((boxes(data, body + CONTAINERS[kind], end), (*path, kind)))


def _table(data: bytes, body: int, end: int, kind: str, columns: int = 1) -> np.ndarray:
    """The rows of a full box that starts with a count; all of them lie inside the box."""
    (count,) = _read(data, ">I", body + 4, end)
    if body + 8 + count * columns * np.dtype(kind).itemsize > end:
        raise BrokenMedia("a table is cut off")
    return np.frombuffer(data, kind, count * columns, body + 8).astype(np.int64).reshape(count, columns)


def _compact_sizes(data: bytes, body: int, end: int) -> np.ndarray:
    """Sample sizes of 4, 8 or 16 bits."""
    width, count = _read(data, ">3xBI", body + 4, end)
    if width not in (4, 8, 16) or body + 12 + (count * width + 7) // 8 > end:
        raise BrokenMedia("a table of compact sizes is wrong")
    if width == 16:
        return np.frombuffer(data, ">u2", count, body + 12).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, (count * width + 7) // 8, body + 12)
    if width == 4:
        raw = np.stack([raw >> 4, raw & 15], axis=1).reshape(-1)[:count]
    return raw.astype(np.int64)


class Track:
    """What the sample tables and the fragments of one track say."""

    def __init__(self, file_size: int):
        self.file_size = file_size
        self.id = self.timescale = self.duration = 0
        self.handler = self.codec = ""
        self.fixed, self.count = 0, 0
        self.sizes = self.sync = None
        self.to_chunk = np.empty((0, 3), np.int64)
        self.chunks = np.empty(0, np.int64)
        self.times = np.empty((0, 2), np.int64)
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # offsets, sizes and sync of each run of fragments
        self.run_time = 0

    def add(self, data: bytes, kind: bytes, body: int, end: int) -> None:
        version = data[body] if body < end else 0
        if kind == b"tkhd":
            (self.id,) = _read(data, ">I", body + (20 if version else 12), end)
        elif kind == b"mdhd":
            self.timescale, self.duration = _read(data, ">IQ", body + 20, end) if version else _read(data, ">II", body + 12, end)
            if self.duration >= 1 << 63:
                raise BrokenMedia("a duration is out of range")
        elif kind == b"hdlr" and not self.handler:
            self.handler = _read(data, "4s", body + 8, end)[0].decode("latin-1")
        elif kind == b"stsd":
            self.codec = data[body + 12 : body + 16].decode("latin-1") if end - body >= 16 else ""
        elif kind == b"stts":
            self.times = _table(data, body, end, ">u4", 2)
        elif kind == b"stsc":
            self.to_chunk = _table(data, body, end, ">u4", 3)
        elif kind == b"stsz":
            self.fixed, self.count = _read(data, ">II", body + 4, end)
            if not self.fixed:
                self.sizes = _table(data, body + 4, end, ">u4")[:, 0]
                self.count = len(self.sizes)
            elif self.fixed * self.count > self.file_size:
                raise BrokenMedia("more bytes of samples than the file has")
        elif kind == b"stz2":
            self.fixed, self.sizes = 0, _compact_sizes(data, body, end)
            self.count = len(self.sizes)
        elif kind == b"stco":
            self.chunks = _table(data, body, end, ">u4")[:, 0]
        elif kind == b"co64":
            self.chunks = _table(data, body, end, ">u8")[:, 0]
        elif kind == b"stss":
            self.sync = _table(data, body, end, ">u4")[:, 0] - 1

    def samples(self) -> int:
        return self.count + sum(len(sizes) for _, sizes, _ in self.runs)

    def layout(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offset and size of each sample, and whether it is a sync sample; all samples lie inside the file."""
        parts = [self._tables(), *self.runs]
        offsets, sizes, sync = (np.concatenate([p[k] for p in parts]) for k in range(3))
        if len(offsets) and (offsets.min() < 0 or (offsets + sizes).max() > self.file_size):
            raise BrokenMedia("a sample lies outside the file")
        return offsets, sizes, sync

    def _tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.full(self.count, self.fixed, np.int64) if self.fixed else self.sizes if self.sizes is not None else np.empty(0, np.int64)
        n = len(sizes)
        sync = np.ones(n, bool)
        if self.sync is not None:
            if len(self.sync) and (self.sync.min() < 0 or self.sync.max() >= n or (np.diff(self.sync) <= 0).any()):
                raise BrokenMedia("a sync sample isn't there or out of order")
            sync = np.zeros(n, bool)
            sync[self.sync] = True
        if not n:
            return np.empty(0, np.int64), sizes, sync
        if not len(self.to_chunk) or self.to_chunk[0, 0] != 1:
            raise BrokenMedia("samples have no chunks")
        runs = np.diff(np.append(self.to_chunk[:, 0], len(self.chunks) + 1))
        if (runs < 0).any():
            raise BrokenMedia("chunk runs are out of order")
        per_chunk = np.minimum(np.repeat(self.to_chunk[:, 1], runs), n)
        first = np.cumsum(per_chunk) - per_chunk
        if not len(per_chunk) or first[-1] + per_chunk[-1] < n:
            raise BrokenMedia("more samples than the chunks hold")
        chunk = np.searchsorted(first, np.arange(n), "right") - 1
        before = np.cumsum(sizes) - sizes
        return self.chunks[chunk] + before - before[first[chunk]], sizes, sync

    def keyframes(self) -> list[tuple[int, int]]:
        """Byte ranges of the sync samples (all, where the track has no table of them); touching ranges are one."""
        offsets, sizes, sync = self.layout()
        return [(int(a), int(n)) for a, n in _joined(offsets[sync], sizes[sync])]

    def length(self) -> int:
        """Duration in units of the timescale: the header's and that of the fragments."""
        return self.duration + self.run_time

    def seconds(self) -> float:
        return self.length() / self.timescale if self.timescale else 0.0


class _Fragments:
    """Defaults and positions while the fragments of a file are read."""

    def __init__(self, file_size: int):
        self.file_size = file_size
        self.defaults: dict[int, tuple[int, int, int]] = {}  # track -> duration, size, flags of a sample
        self.track = self.base = self.at = self.start = 0
        self.now = (0, 0, 0)

    def header(self, data: bytes, body: int, end: int) -> None:
        flags, self.track = _read(data, ">II", body, end)
        flags &= 0xFFFFFF
        at = body + 8
        self.base = self.start
        if flags & 1:
            (self.base,), at = _read(data, ">Q", at, end), at + 8
        at += 4 * bool(flags & 2)
        now = list(self.defaults.get(self.track, (0, 0, 0)))
        for k, bit in enumerate((8, 16, 32)):
            if flags & bit:
                (now[k],), at = _read(data, ">I", at, end), at + 4
        self.now, self.at = tuple(now), self.base

    def run(self, data: bytes, body: int, end: int, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Offsets, sizes, sync and the whole duration of a run of samples; `room` bounds how many there may be."""
        flags, count = _read(data, ">II", body, end)
        flags &= 0xFFFFFF
        at = body + 8
        if flags & 1:
            (shift,), at = _read(data, ">i", at, end), at + 4
            self.at = self.base + shift
        first = None
        if flags & 4:
            (first,), at = _read(data, ">I", at, end), at + 4
        columns = [k for k, bit in enumerate((0x100, 0x200, 0x400, 0x800)) if flags & bit]
        if count > room or at + 4 * count * len(columns) > end:
            raise BrokenMedia("a run of samples is cut off")
        table = np.frombuffer(data, ">u4", count * len(columns), at).astype(np.int64).reshape(count, len(columns))
        of = lambda k: table[:, columns.index(k)] if k in columns else np.full(count, self.now[k], np.int64)
        times, sizes, kinds = of(0), of(1), of(2).copy()
        if first is not None and count and 2 not in columns:
            kinds[0] = first
        if not 0 <= self.at <= self.file_size:
            raise BrokenMedia("a sample lies outside the file")
        offsets = self.at + np.cumsum(sizes) - sizes
        self.at = int(offsets[-1] + sizes[-1]) if count else self.at
        return offsets, sizes, kinds & 0x10000 == 0, int(times.sum())


def _joined(offsets: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    if len(offsets):
        new = np.flatnonzero(np.append(True, offsets[1:] != (offsets + sizes)[:-1]))
        totals = np.add.reduceat(sizes, new)
        yield from zip(offsets[new], totals, strict=True)


def tracks(data: bytes) -> list[Track]:
    """The tracks of a container, with the samples of its fragments. Raises BrokenMedia, and nothing else, for bytes of any kind.

    All tracks together have no more samples than the file has bytes, so that what is allocated follows the file's size.
    """
    found: list[Track] = []
    parts = _Fragments(len(data))
    for path, start, body, end in walk(data):
        if path == (b"moov", b"trak"):
            found.append(Track(len(data)))
        elif found and path[:2] == (b"moov", b"trak"):
            found[-1].add(data, path[-1], body, end)
        elif path == (b"moov", b"mvex", b"trex"):
            track, _, *default = _read(data, ">5I", body + 4, end)
            parts.defaults[track] = tuple(default)
        elif path == (b"moof",):
            parts.start = start
        elif path == (b"moof", b"traf", b"tfhd"):
            parts.header(data, body, end)
        elif path == (b"moof", b"traf", b"trun"):
            owner = next((t for t in found if t.id == parts.track), None)
            if owner is None:
                raise BrokenMedia("a fragment has no track")
            *run, time = parts.run(data, body, end, len(data) - sum(t.samples() for t in found))
            owner.runs.append(tuple(run))
            owner.run_time += time
    if sum(t.samples() for t in found) > len(data):
        raise BrokenMedia("more samples than the file has bytes")
    return found


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body if len(body) < 2**32 - 8 else struct.pack(">I4sQ", 1, kind, 16 + len(body)) + body


def _full(kind: bytes, *parts: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *parts)


def store_samples(payload: bytes) -> bytes:
    """A container with one track of 8-bit samples; the payload is a positive multiple of PACKET bytes."""
    if not payload or len(payload) % PACKET:
        raise ValueError(f"the payload must be a positive multiple of {PACKET} bytes")
    packets = len(payload) // PACKET
    chunks = -(-packets // CHUNK)
    unit = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = _box(b"raw ", bytes(6), struct.pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, RATE << 16))
    runs = [(1, min(CHUNK, packets), 1)] if chunks == 1 or packets % CHUNK == 0 else [(1, CHUNK, 1), (chunks, packets % CHUNK, 1)]
    sync = np.arange(1, packets + 1, SYNC, dtype=">u4")

    def moov(first: int) -> bytes:
        at = first + np.arange(chunks, dtype=np.int64) * (CHUNK * PACKET)
        wide = first + len(payload) >= 2**32
        table = _box(
            b"stbl", _full(b"stsd", struct.pack(">I", 1), entry), _full(b"stts", struct.pack(">III", 1, packets, PACKET)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)), _full(b"stsz", struct.pack(">II", PACKET, packets)),
            _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), at.astype(">u8" if wide else ">u4").tobytes()), _full(b"stss", struct.pack(">I", len(sync)), sync.tobytes()),
        )
        info = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), table)
        media = _box(b"mdia", _box(b"mdhd", struct.pack(">I", 1 << 24), bytes(16), struct.pack(">IQHH", RATE, len(payload), 0x55C4, 0)), _full(b"hdlr", bytes(4), b"soun", bytes(12), b"samples\0"), info)
        head = _box(b"tkhd", struct.pack(">I", 1 << 24 | 3), bytes(16), struct.pack(">IIQ", 1, 0, len(payload)), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), unit, bytes(8))
        movie = _box(b"mvhd", struct.pack(">I", 1 << 24), bytes(16), struct.pack(">IQ", RATE, len(payload)), struct.pack(">IH", 0x10000, 0x100), bytes(10), unit, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", movie, _box(b"trak", head, media))

    brand = _box(b"ftyp", b"qt  ", bytes(4), b"qt  ")
    gap = len(brand) + len(moov(0)) + (8 if len(payload) < 2**32 - 8 else 16)
    return brand + moov(gap) + _box(b"mdat", payload)


def read_samples(data: bytes) -> bytes:
    """All bytes of the first track's samples, in order, by its tables."""
    (track, *_) = tracks(data)
    return b"".join(data[a : a + n] for a, n in _joined(*track.layout()[:2]))


def pad(raw: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of PACKET."""
    return raw + bytes(-len(raw) % PACKET or (PACKET if not raw else 0))


def scan_media(df: DataFrame, media_col: str, keep: list[str] | None = None) -> DataFrame:
    """df plus `brand`, `tracks` (codec, duration, sample count and keyframe byte ranges of each) and `media_error`.

    A null or empty value has no brand, no tracks and no error; a broken container has an empty list of tracks and says why, and never ends the job. Fragments count with their tracks. Clashing columns are replaced; repeated rows are read each; an empty table gives an empty result.
    """

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for rows in pieces(batch, media_col, 8 << 20):
                brands, found, errors = [], [], []
                for data in rows.column(media_col).to_pylist():
                    brand, listed, error = None, [], None
                    if data:
                        try:
                            brand = next((data[b : b + 4].decode("latin-1") for k, _, b, _ in boxes(data) if k == b"ftyp"), None)
                            listed = [{"track_id": t.id, "handler": t.handler, "codec": t.codec, "timescale": t.timescale, "duration": t.length(), "samples": t.samples(), "keyframes": [{"offset": a, "length": n} for a, n in t.keyframes()]} for t in tracks(data)]
                        except BrokenMedia as broken:
                            listed, error = [], str(broken)
                    brands.append(brand)
                    found.append(listed)
                    errors.append(error)
                yield rows, [pa.array(brands, pa.string()), pa.array(found, ARROW_TRACKS), pa.array(errors, pa.string())]

    return append(df, [StructField("brand", StringType()), StructField("tracks", ArrayType(TRACK)), StructField("media_error", StringType())], compute, keep)


ARROW_RANGES = pa.list_(pa.struct([("offset", pa.int64()), ("length", pa.int64())]))
ARROW_TRACKS = pa.list_(pa.struct([("track_id", pa.int64()), ("handler", pa.string()), ("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("samples", pa.int64()), ("keyframes", ARROW_RANGES)]))


def feature(track: Track, ranges: list[tuple[int, int]]) -> str:
    """Codec, rate, duration, samples and keyframe ranges of a track, as JSON with sorted keys; the ranges as their number, bytes and a digest."""
    digest = hashlib.sha256(np.array(ranges, "<i8").tobytes()).hexdigest()
    return json.dumps({"codec": track.codec, "duration": track.length(), "handler": track.handler, "keyframe_bytes": sum(n for _, n in ranges), "keyframes": len(ranges), "keyframes_sha256": digest, "samples": track.samples(), "seconds": track.seconds(), "timescale": track.timescale}, sort_keys=True)


def _described(data: bytes) -> tuple[bytes, str, list[tuple[int, int]]]:
    """The samples of the first track, its feature and its keyframe ranges, from one walk of the boxes."""
    (track, *_) = tracks(data)
    offsets, sizes, sync = track.layout()
    ranges = [(int(a), int(n)) for a, n in _joined(offsets[sync], sizes[sync])]
    return b"".join(data[a : a + n] for a, n in _joined(offsets, sizes)), feature(track, ranges), ranges


def store_texts(df: DataFrame, text_col: str = "text", with_media: bool = True, digests: bool = True, keep: list[str] | None = None) -> DataFrame:
    """df plus each text's UTF-8 bytes kept in a container (`media`), read back, and/or the digests of both.

    A null text counts as empty; an empty one is stored as one packet of zeros. Texts are stored whole, of any length. Equal texts give equal values; an empty table gives an empty result; clashing columns are replaced.
    """

    def compute(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for rows in pieces(batch, text_col, 8 << 20):
                raws = [b"" if x is None else x for x in rows.column(text_col).cast(pa.binary()).to_pylist()]
                stored = [store_samples(pad(raw)) for raw in raws]
                out: list = [pa.array(stored, pa.binary())] if with_media else []
                if digests:
                    described = [_described(data) for data in stored]
                    back = [d[0] for d in described]
                    out += [
                        pa.array([len(raw) for raw in raws], pa.int64()), pa.array([len(x) for x in back], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                        pa.array([zlib.crc32(x[-PACKET:]) for x in back], pa.int64()), pa.array([len(x) for x in stored], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in stored], pa.string()),
                        pa.array([d[1] for d in described], pa.string()), pa.array([[{"offset": a, "length": n} for a, n in d[2]] for d in described], ARROW_RANGES),
                    ]
                yield rows, out

    fields = [StructField("media", BinaryType())] if with_media else []
    if digests:
        fields += [StructField("n_bytes", LongType()), StructField("payload_bytes", LongType()), StructField("payload_sha256", StringType()), StructField("tail_crc32", LongType()), StructField("media_bytes", LongType()), StructField("media_sha256", StringType()), StructField("feature", StringType()), StructField("keyframes", RANGES)]
    return append(df, fields, compute, keep)
