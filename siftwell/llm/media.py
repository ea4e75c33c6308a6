"""Media columns: ISO base media containers.

``store_samples`` lays a byte payload out as an ISO media file of one raw 8-bit
track; ``describe`` walks the nested boxes of any such file, decodes its sample
tables and gives codec, duration and keyframe byte ranges. Only box headers and
sample tables are read; payload bytes are never decoded.

Edge cases: null or empty content gives null description columns; content that
is not a well-formed container (cut off, nested too deeply, tables that the file
doesn't bear out) gives a null description and the reason in ``error``.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import map_batches, read_table, utf8

#: Box types whose content is again boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"}
#: Levels of nested boxes that are followed; the format itself needs seven.
DEEPEST = 32
UNIT = 576
TIMESCALE = 48_000
KEY_EVERY = 16
CHUNK_SAMPLES = 8
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(content: bytes, unit: int = UNIT) -> bytes:
    """``content`` with bytes 255 appended up to a positive multiple of ``unit``."""
    return content + b"\xff" * (max(1, -(-len(content) // unit)) * unit - len(content))


def store_samples(payload: bytes, unit: int = UNIT, key_every: int = KEY_EVERY) -> bytes:
    """An ISO media file that holds ``payload`` losslessly as raw 8-bit audio samples.

    ``payload`` must be a positive multiple of ``unit``; each access unit has
    ``unit`` samples, and every ``key_every``-th one is a sync sample.
    """
    if not payload or len(payload) % unit:
        raise ValueError("the payload must be a positive multiple of the unit")
    n = len(payload) // unit
    chunks = -(-n // CHUNK_SAMPLES)
    last = n - (chunks - 1) * CHUNK_SAMPLES
    runs = [(1, CHUNK_SAMPLES if chunks > 1 else last)] + ([(chunks, last)] if chunks > 1 and last != CHUNK_SAMPLES else [])
    keys = range(1, n + 1, key_every)
    large = len(payload) + (1 << 20) >= 1 << 32

    def moov(base: int) -> bytes:
        offsets = [base + i * CHUNK_SAMPLES * unit for i in range(chunks)]
        entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, (TIMESCALE << 16) & 0xFFFFFFFF))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, unit)),
            _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", first, per, 1) for first, per in runs)),
            _full(b"stsz", struct.pack(">II", unit, n)),
            _full(b"co64", struct.pack(f">I{chunks}Q", chunks, *offsets)) if large else _full(b"stco", struct.pack(f">I{chunks}I", chunks, *offsets)),
        )
        length = n * unit
        mdhd = _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, length, 0x55C4, 0), version=1)
        hdlr = _full(b"hdlr", struct.pack(">I4s", 0, b"soun"), bytes(12), b"samples\0")
        minf = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        tkhd = _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, length), bytes(8), struct.pack(">HHHH", 0, 0, 0x0100, 0), _MATRIX, bytes(8), version=1, flags=7)
        mvhd = _full(b"mvhd", struct.pack(">QQIQ", 0, 0, TIMESCALE, length), struct.pack(">IH", 0x10000, 0x0100), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isommp42")
    base = len(head) + len(moov(0)) + (16 if large else 8)
    return head + moov(base) + _box(b"mdat", payload)


def walk(buf: bytes, start: int = 0, end: int | None = None) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Every box of ``buf`` as (path of types, start and end of its content), parents first.

    Boxes still to be read are a stack of at most ``DEEPEST`` levels.
    """
    levels: list[tuple[tuple[bytes, ...], int, int]] = [((), start, len(buf) if end is None else end)]
    while levels:
        path, at, stop = levels.pop()
        if at >= stop:
            continue
        if stop - at < 8:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", buf, at)
        head = 8
        if size == 1:
            if stop - at < 16:
                raise ValueError("a box header is cut off")
            size, head = struct.unpack_from(">Q", buf, at + 8)[0], 16
        elif size == 0:
            size = stop - at
        if size < head or at + size > stop:
            raise ValueError("a box reaches past its parent")
        here = (*path, kind)
        yield here, at + head, at + size
        levels.append((path, at + size, stop))
        if kind in CONTAINERS:
            if len(here) > DEEPEST:
                raise ValueError("boxes are nested too deeply")
            levels.append((here, at + head, at + size))


@dataclass
class Track:
    codec: str
    timescale: int
    duration: int
    offsets: np.ndarray
    sizes: np.ndarray
    keyframes: np.ndarray


class Box:
    """Reads from the content of one box; what lies behind its end is an error."""

    def __init__(self, buf: bytes, kind: bytes, at: int, end: int) -> None:
        self.buf, self.kind, self.at, self.end = buf, kind, at, end

    def read(self, form: str, at: int) -> tuple:
        if self.at + at + struct.calcsize(form) > self.end:
            raise ValueError(f"a {self.kind.decode('latin-1')} box is cut off")
        return struct.unpack_from(form, self.buf, self.at + at)

    def table(self, count_at: int, width: int, dtype: str) -> np.ndarray:
        """``count`` rows of ``width`` numbers behind the count, which must lie within the box."""
        (count,) = self.read(">I", count_at)
        first = self.at + count_at + 4
        if first + count * width * np.dtype(dtype).itemsize > self.end:
            raise ValueError("a sample table is cut off")
        out = np.frombuffer(self.buf, dtype, count * width, first).astype(np.int64)
        return out.reshape(count, width) if width > 1 else out


def tracks(buf: bytes) -> list[Track]:
    """The tracks of a container with their decoded sample tables; a ValueError tells what is wrong with it.

    Nothing is allocated by a count that the file itself doesn't bear out.
    """
    found: list[dict[bytes, Box]] = []
    for path, at, end in walk(buf):
        if path[-1] == b"trak":
            found.append({})
        elif found and b"trak" in path:
            found[-1].setdefault(path[-1], Box(buf, path[-1], at, end))
    if not found:
        raise ValueError("no track")
    return [_track(buf, boxes) for boxes in found]


def _track(buf: bytes, boxes: dict[bytes, Box]) -> Track:
    need = [k for k in (b"mdhd", b"stsd", b"stts", b"stsc", b"stsz") if k not in boxes]
    if need or not (b"stco" in boxes or b"co64" in boxes):
        raise ValueError("a track has no " + (need[0].decode() if need else "chunk offsets"))
    (version,) = boxes[b"mdhd"].read(">B", 0)
    timescale, duration = boxes[b"mdhd"].read(">IQ", 20) if version else boxes[b"mdhd"].read(">II", 12)
    codec = boxes[b"stsd"].read(">4s", 12)[0].decode("latin-1")
    fixed, count = boxes[b"stsz"].read(">II", 4)
    if fixed and count * fixed > len(buf):
        raise ValueError("a sample lies outside the file")
    sizes = np.full(count, fixed, np.int64) if fixed else boxes[b"stsz"].table(8, 1, ">u4")
    chunk_at = boxes[b"co64"].table(4, 1, ">u8") if b"co64" in boxes else boxes[b"stco"].table(4, 1, ">u4")
    runs = boxes[b"stsc"].table(4, 3, ">u4")
    chunks = np.diff(np.append(runs[:, 0], len(chunk_at) + 1)) if len(runs) else np.zeros(0, np.int64)
    if (chunks < 0).any() or chunks.sum() != len(chunk_at) or int((chunks.astype(object) * runs[:, 1]).sum()) != count:
        raise ValueError("chunks and samples disagree")
    per = np.repeat(runs[:, 1], chunks)
    ends = np.cumsum(sizes)
    before = ends - sizes
    heads = np.cumsum(per) - per
    filled = per > 0  # a chunk without samples has no first one
    offsets = np.repeat(chunk_at[filled] - before[heads[filled]], per[filled]) + before
    keys = boxes[b"stss"].table(4, 1, ">u4") - 1 if b"stss" in boxes else np.arange(count)
    if len(keys) and not 0 <= keys.min() <= keys.max() < count:
        raise ValueError("a keyframe is no sample")
    if count and ((offsets < 0).any() or (offsets + sizes > len(buf)).any()):
        raise ValueError("a sample lies outside the file")
    return Track(codec, timescale, duration, offsets, sizes, keys)


def payload_of(buf: bytes, track: Track) -> bytes:
    """The track's stored bytes, gathered through its sample table, runs of adjacent samples at once."""
    if not len(track.offsets):
        return b""
    cuts = np.flatnonzero(track.offsets[1:] != track.offsets[:-1] + track.sizes[:-1]) + 1
    starts = track.offsets[np.append(0, cuts)]
    stops = (track.offsets + track.sizes)[np.append(cuts - 1, len(track.offsets) - 1)]
    return b"".join(buf[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True))


def keyframe_ranges(track: Track) -> list[tuple[int, int]]:
    """(offset, length) in the file of every sync sample."""
    return list(zip(track.offsets[track.keyframes].tolist(), track.sizes[track.keyframes].tolist(), strict=True))


DESCRIBED = "codec string, duration_s double, n_samples long, keyframes array<struct<offset:long,length:long>>, error string"


def media_columns(df: DataFrame, content: str, key: str) -> DataFrame:
    """(key, codec, duration_s, n_samples, keyframes, error) of the first track of each container in ``content``."""

    def make():
        def apply(batch):
            out = {k: [] for k in (key, "codec", "duration_s", "n_samples", "keyframes", "error")}
            out[key] = batch.column(0)
            for buf in batch.column(1).to_pylist():
                row = (None,) * 5
                if buf:
                    try:
                        t = tracks(buf)[0]
                        row = (t.codec, t.duration / max(1, t.timescale), len(t.sizes), [{"offset": a, "length": b} for a, b in keyframe_ranges(t)], None)
                    except (ValueError, struct.error) as e:
                        row = (None, None, None, None, str(e))
                for k, v in zip(list(out)[1:], row, strict=True):
                    out[k].append(v)
            return out

        return apply

    src = df.select(F.col(key), F.col(content).cast("binary"))
    return map_batches(src, make, f"`{key}` {src.schema[0].dataType.simpleString()}, {DESCRIBED}")


def media_digest(text: bytes) -> dict:
    """Store a text as a container, read it back through its sample tables and describe it."""
    buf = store_samples(pad(text))
    track = tracks(buf)[0]
    payload = payload_of(buf, track)
    ranges = keyframe_ranges(track)
    seconds = track.duration / track.timescale
    return {
        "n_bytes": len(text),
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(buf),
        "media_sha256": hashlib.sha256(buf).hexdigest(),
        "feature": f"codec={track.codec.strip()};duration={seconds:.6f};samples={len(track.sizes)};keyframes=" + ",".join(f"{a}+{b}" for a, b in ranges),
    }


def op4_media_columns(spark, sf_dir: str) -> DataFrame:
    """One row per document: its text stored as ISO media samples, read back and described.

    A null text counts as empty (one unit of bytes 255); equal texts give equal values.
    """

    def make():
        def apply(batch):
            rows = [media_digest(t) for t in utf8(batch.column(1))]
            return {"doc_id": batch.column(0)} | {k: [r[k] for r in rows] for k in rows[0]}

        return apply

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_batches(docs, make, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
