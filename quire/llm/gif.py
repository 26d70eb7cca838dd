"""GIF as a storage form for binary payloads: LZW code streams, palettes, disposal, transparency and timed frames.

encode_gif() writes a payload as the 8-bit samples of frames 64 pixels wide; parse_gif() reads any GIF87a/89a image;
render() applies palettes, interlacing, transparency and disposal and gives the timed canvases.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import small_batches, table

WIDTH = 64
#: Rows of a frame at most; longer payloads take more frames.
FRAME_ROWS = 4096
#: Hundredths of a second that each written frame is shown.
DELAY_CS = 10
#: Histogram bins of each colour channel.
BINS = 8
_ENTRIES = 4096
_SHIFTS = np.arange(12, dtype=np.uint16)
_GREYS = bytes(v for i in range(256) for v in (i, i, i))


class GifError(ValueError):
    """The bytes are not a readable GIF."""


@dataclass
class Frame:
    left: int
    top: int
    width: int
    height: int
    samples: bytes
    palette: np.ndarray
    transparent: int | None = None
    disposal: int = 0
    delay_cs: int = 0


@lru_cache(maxsize=16)
def _widths(first: int, clear: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits of 4096 codes from the number `first` after a clear code (numbers from 1), and where each code ends."""
    widths = np.minimum(12, np.frexp((np.arange(first, first + _ENTRIES) + clear).astype(np.float64))[1]).astype(np.int64)
    return widths, np.cumsum(widths)


def lzw_encode(data: bytes, depth: int = 8) -> bytes:
    """The LZW code stream of samples below 2**depth; the table is cleared whenever it is full."""
    clear = 1 << depth
    room = _ENTRIES - clear - 2
    codes: list[int] = []
    runs = []  # codes of each stretch between two clear codes
    if data:
        table: dict[int, int] = {}
        get, emit, free = table.get, codes.append, clear + 2
        prefix = data[0]
        for c in memoryview(data)[1:]:
            key = prefix << 8 | c
            known = get(key)
            if known is None:
                emit(prefix)
                if free < _ENTRIES:
                    table[key] = free
                    free += 1
                if len(codes) == room:
                    emit(clear)
                    runs.append(codes)
                    codes = []
                    emit, free = codes.append, clear + 2
                    table.clear()
                prefix = c
            else:
                prefix = known
        emit(prefix)
    codes.append(clear + 1)
    runs.append(codes)
    widths, _ = _widths(1, clear)
    values = np.concatenate([[clear], *runs]).astype(np.uint16)
    sizes = np.concatenate([[depth + 1], *(widths[: len(r)] for r in runs)])
    bits = (values[:, None] >> _SHIFTS) & 1
    return np.packbits(bits.astype(bool)[_SHIFTS < sizes[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, depth: int, size: int) -> bytes:
    """The first size samples of a code stream. A code names what an earlier code of its stretch gave and one sample more."""
    clear, stop = 1 << depth, (1 << depth) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    total = len(stream) * 8
    bit, out, ended = 0, bytearray(), False
    while not ended and len(out) < size:
        start, lengths, number, n = [], [], 1, len(out)  # a stretch begins
        while True:
            every, ends_at = _widths(1 if number == 1 else _ENTRIES, clear)
            fits = int(np.searchsorted(ends_at, total - bit, side="right"))
            widths = every[:fits]
            at = bit + ends_at[:fits] - widths
            byte = at >> 3
            codes = ((raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (at & 7).astype(np.uint32)) & ((1 << widths) - 1).astype(np.uint32)
            ends = np.flatnonzero((codes == clear) | (codes == stop))
            upto = int(ends[0]) if len(ends) else fits
            for c in codes[:upto].tolist():
                if c < clear:
                    out.append(c)
                    k = 1
                else:
                    e = c - clear - 2
                    if e >= len(start):
                        raise GifError("a code names an entry that does not exist yet")
                    p, k = start[e], lengths[e] + 1
                    if p + k <= n:
                        out += out[p : p + k]
                    else:  # the entry that this very code completes
                        out += out[p:n]
                        out.append(out[p])
                start.append(n)
                lengths.append(k)
                n += k
            if len(ends):
                bit = int(at[upto] + widths[upto])
                ended = int(codes[upto]) == stop
                break
            if fits < _ENTRIES or n >= size:
                ended = True
                break
            bit, number = int(at[-1] + widths[-1]), number + fits
    if len(out) < size:
        raise GifError("the code stream ends early")
    return bytes(out[:size])


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes((len(x),)) + x for x in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


def write_gif(size: tuple[int, int], palette: bytes | None, frames: list[Frame], interlaced: bool = False) -> bytes:
    """A GIF89a file. palette: 256 RGB triples for frames without their own; a frame's own palette is written beside it."""
    parts = [b"GIF89a", struct.pack("<HHBBB", *size, 0xF7 if palette else 0x70, 0, 0), palette or b""]
    for f in frames:
        own = f.palette is not None
        parts.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, f.disposal << 2 | (f.transparent is not None), f.delay_cs, f.transparent or 0, 0))
        parts.append(struct.pack("<BHHHHB", 0x2C, f.left, f.top, f.width, f.height, (0x87 if own else 0) | (0x40 if interlaced else 0)))
        if own:
            parts.append(f.palette.astype(np.uint8).tobytes())
        samples = f.samples
        if interlaced:
            samples = np.frombuffer(samples, np.uint8).reshape(f.height, f.width)[_row_order(f.height)].tobytes()
        parts += [b"\x08", _blocks(lzw_encode(samples))]
    return b"".join(parts) + b"\x3b"


def _row_order(height: int) -> np.ndarray:
    """Rows of an interlaced image in the order in which they are stored."""
    return np.concatenate([np.arange(a, height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])


def encode_gif(payload: bytes) -> bytes:
    """payload, a positive multiple of 64 bytes, as the samples of grey frames."""
    if not payload or len(payload) % WIDTH:
        raise ValueError("the payload's length must be a positive multiple of 64")
    step = WIDTH * FRAME_ROWS
    frames = [Frame(0, 0, WIDTH, len(x) // WIDTH, x, None, None, 1, DELAY_CS) for x in (payload[i : i + step] for i in range(0, len(payload), step))]
    return write_gif((WIDTH, frames[0].height), _GREYS, frames)


def parse_gif(data: bytes) -> tuple[int, int, list[Frame]]:
    """Canvas width and height, and the frames with decoded samples in row order."""
    try:
        return _parse(data)
    except (struct.error, IndexError) as e:
        raise GifError("the file ends early") from e


def _parse(data: bytes) -> tuple[int, int, list[Frame]]:
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise GifError("no GIF signature")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, common = 13, None

    def colours(flags: int) -> np.ndarray:
        nonlocal at
        n = 2 << (flags & 7)
        got = np.frombuffer(data, np.uint8, min(3 * n, len(data) - at), at)
        if len(got) < 3 * n:
            raise GifError("the palette ends early")
        at += 3 * n
        return got.reshape(n, 3)

    def joined() -> bytes:
        nonlocal at
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += n + 1
        at += 1
        return b"".join(parts)

    if flags & 0x80:
        common = colours(flags)
    frames, control = [], (0, 0, None)
    while (kind := data[at]) != 0x3B:
        at += 1
        if kind == 0x21:
            label = data[at]
            at += 1
            body = joined()
            if label == 0xF9 and len(body) >= 4:
                packed, delay, index = struct.unpack_from("<BHB", body)
                control = (packed >> 2 & 7, delay, index if packed & 1 else None)
        elif kind == 0x2C:
            left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at)
            at += 9
            palette = colours(flags) if flags & 0x80 else common
            if palette is None:
                raise GifError("a frame has no palette")
            depth = data[at]
            if not 1 <= depth <= 8:
                raise GifError("the code size is out of range")
            at += 1
            samples = lzw_decode(joined(), depth, w * h)
            if flags & 0x40:
                rows = np.empty((h, w), np.uint8)
                rows[_row_order(h)] = np.frombuffer(samples, np.uint8).reshape(h, w)
                samples = rows.tobytes()
            frames.append(Frame(left, top, w, h, samples, palette, control[2], control[0], control[1]))
            control = (0, 0, None)
        else:
            raise GifError("an unknown block")
    return width, height, frames


def render(width: int, height: int, frames: list[Frame]) -> Iterator[np.ndarray]:
    """The RGBA canvas (height, width, 4) as it is shown for each frame; the caller must copy what it keeps."""
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in frames:
        before = canvas.copy() if f.disposal == 3 else None
        area = (slice(f.top, min(f.top + f.height, height)), slice(f.left, min(f.left + f.width, width)))
        index = np.frombuffer(f.samples, np.uint8).reshape(f.height, f.width)[: max(0, height - f.top), : max(0, width - f.left)]
        lut = np.zeros((256, 4), np.uint8)
        lut[: len(f.palette), :3] = f.palette
        lut[:, 3] = 255
        if f.transparent is None:
            canvas[area] = lut[index]
        else:
            seen = index != f.transparent
            canvas[area][seen] = lut[index[seen]]
        yield canvas
        if f.disposal == 2:
            canvas[area] = 0
        elif f.disposal == 3:
            canvas = before


def colour_histogram(canvas: np.ndarray) -> np.ndarray:
    """Counts of the visible pixels in BINS bins of red, then green, then blue."""
    seen = canvas.reshape(-1, 4)
    if not (seen[:, 3] == 255).all():
        seen = seen[seen[:, 3] > 0]
    return np.concatenate([np.bincount(seen[:, c], minlength=256).reshape(BINS, -1).sum(axis=1) for c in range(3)])


def _rows(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def store_payload(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_bytes and media (the GIF that holds the text's UTF-8 bytes padded with zeros) for every row; null text counts as empty.

    Repeated rows and null keys are kept as they are, columns other than the two named are left out, an empty table gives
    an empty table. One pass over the rows, no shuffle.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [(x or "").encode() for x in _rows(part, "text")]
                media = [encode_gif(x.ljust(max(WIDTH, -(-len(x) // WIDTH) * WIDTH), b"\0")) for x in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], ["key", "n_bytes", "media"])

    small_batches(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    return df.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(pack, f"key {kind}, n_bytes bigint, media binary").withColumnRenamed("key", key)


def media_frames(df: DataFrame, key: str, media: str = "media") -> DataFrame:
    """One row per timed frame: key, frame (from 0), shown_ms (when it begins), delay_ms, width and height of the canvas,
    histogram (array of 3 * BINS counts). A null or unreadable image gives one row with frame null and error set."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "frame", "shown_ms", "delay_ms", "width", "height", "histogram", "error"]
        kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.string()]
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                out: list[list] = [[] for _ in names]
                for k, data in zip(_rows(part, "key"), _rows(part, "media"), strict=True):
                    try:
                        w, h, frames = parse_gif(data or b"")
                        shown = 0
                        for n, (f, canvas) in enumerate(zip(frames, render(w, h, frames), strict=False)):
                            for col, v in zip(out, (k, n, shown, f.delay_cs * 10, w, h, colour_histogram(canvas).tolist(), None), strict=True):
                                col.append(v)
                            shown += f.delay_cs * 10
                    except GifError as e:
                        for col, v in zip(out, (k, None, None, None, None, None, None, str(e)), strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t or part.schema.field(0).type) for c, t in zip(out, kinds, strict=True)], names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, frame int, shown_ms bigint, delay_ms bigint, width int, height int, histogram array<bigint>, error string"
    return df.selectExpr(f"`{key}` AS key", f"`{media}` AS media").mapInArrow(unpack, schema).withColumnRenamed("key", key)


def media_features(df: DataFrame, key: str, n_bytes: str = "n_bytes", media: str = "media") -> DataFrame:
    """Per stored image: key, n_bytes, payload_bytes, payload_sha256 and tail_crc32 of the samples read back, media_bytes
    and media_sha256 of the file, and feature: frames, shown milliseconds, canvas size and the colour histogram summed
    over the rendered frames. A row whose image is null or unreadable has nulls there."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                out: list[list] = [[] for _ in kinds]
                for data in _rows(part, "media"):
                    try:
                        w, h, frames = parse_gif(data or b"")
                        payload = b"".join(f.samples for f in frames)
                        total = sum(map(colour_histogram, render(w, h, frames)), np.zeros(3 * BINS, np.int64))
                        feature = f"{len(frames)}x{w}x{h}:{sum(f.delay_cs for f in frames) * 10}ms:{','.join(map(str, total.tolist()))}"
                        row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), feature)
                    except GifError:
                        row = (None,) * 6
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return df.selectExpr(f"`{key}` AS key", f"`{n_bytes}` AS n_bytes", f"`{media}` AS media").mapInArrow(read, schema).withColumnRenamed("key", key)


def op9_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(store_payload(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id")
