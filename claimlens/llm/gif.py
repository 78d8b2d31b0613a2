"""GIF media: LZW code streams, palettes, disposal and transparency, timed frames with colour histograms.

encode() writes 8-bit samples as a GIF of one or more timed frames, decode() reads any GIF87a / GIF89a
stream and yields composited RGBA frames. frames() turns a column of GIF bytes into one row per frame,
stored() turns texts into GIFs.

Code widths depend only on how many codes were read since the last clear code, so the codes of a stretch
are unpacked at once, and the table's strings are resolved as references into the stretch's own output.

Defined results: a null or empty text is stored as one row of blanks; null or unreadable media give one row
with a null frame number and the reason in `error`, after the frames before the fault; so do media whose headers ask
for more than MOST_PIXELS, which no executor is to hold; repeated rows are handled one by one; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import table

WIDTH = 192
FRAME_ROWS = 1024
DELAY_CS = 10
#: The format's own limit of a string table.
TABLE_SIZE = 4096
BINS = 16
#: Pixels of a canvas or an image that frames() decodes at most: four bytes each, in four copies.
MOST_PIXELS = 1 << 25


@functools.lru_cache(maxsize=64)
def _spans(min_size: int, full: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bits, first bit, bit after) of the next TABLE_SIZE codes after a clear code or, with a full table, later."""
    at = (1 << min_size) + 1 + np.arange(TABLE_SIZE)
    widths = np.full(TABLE_SIZE, 12) if full else np.minimum(12, np.floor(np.log2(at)).astype(np.int64) + 1)
    ends = np.cumsum(widths)
    return widths, ends - widths, ends


def lzw_encode(samples: bytes, min_size: int = 8) -> bytes:
    clear = 1 << min_size
    codes: list[int] = [clear]
    stretches: list[int] = []  # codes after each clear, the next clear included
    known: dict[int, int] = {}
    begun, free, emit = 1, clear + 2, codes.append
    now = -1
    for b in samples:
        if now < 0:
            now = b
            continue
        key = now << 8 | b
        longer = known.get(key)
        if longer is not None:
            now = longer
            continue
        emit(now)
        known[key] = free
        free += 1
        now = b
        if free == TABLE_SIZE:
            emit(clear)
            stretches.append(len(codes) - begun)
            begun, free, known = len(codes), clear + 2, {}
    if now >= 0:
        emit(now)
    emit(clear + 1)
    stretches.append(len(codes) - begun)
    longest = _spans(min_size, False)[0]
    widths = np.concatenate([[min_size + 1], *(longest[:n] for n in stretches)])
    ends = np.cumsum(widths)
    starts = ends - widths
    shifted = np.array(codes, np.int64) << (starts & 7)
    out = np.zeros(-(-int(ends[-1]) // 8) + 3, np.int64)
    for k in range(3):  # a code reaches into three bytes at most, and no two codes share a bit
        part = np.bincount((starts >> 3) + k, (shifted >> 8 * k) & 255)
        out[: len(part)] += part.astype(np.int64)
    return out[:-3].astype(np.uint8).tobytes()


def _strings(codes: np.ndarray, clear: int) -> np.ndarray:
    """The samples that the codes since a clear code stand for.

    Table entry number e is what code e stood for and the first sample after it, so a code above the
    literals copies len(code e) + 1 samples of the output from where code e began. Lengths, then samples,
    are found by following these references, the distance doubling each time."""
    refer = codes - (clear + 2)
    at = np.arange(len(codes))
    if (refer >= at).any():
        raise ValueError("bad LZW code")
    literal = refer < 0
    link, lengths = np.where(literal, at, refer), np.where(literal, 0, 1)
    while (lengths[link] > 0).any():
        lengths, link = lengths + lengths[link], link[link]
    lengths += 1
    starts = np.cumsum(lengths) - lengths
    own = np.repeat(at, lengths)
    place = np.arange(len(own))
    source = np.where(literal[own], place, starts[np.maximum(refer, 0)][own] + place - starts[own])
    while True:
        further = source[source]
        if (further == source).all():
            return codes[own[source]].astype(np.uint8)
        source = further


def lzw_decode(data: bytes, min_size: int, expected: int) -> bytes:
    """At most `expected` samples; a stream that ends early gives what it holds."""
    if not 1 <= min_size <= 8:
        raise ValueError("bad LZW code size")
    clear = 1 << min_size
    d = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.int64)
    total, bit, size = 8 * len(data), 0, 0
    parts: list[np.ndarray] = []
    while size < expected:
        stretch, full, stop = [], False, np.zeros(0, np.int64)
        while not len(stop):
            widths, starts, ends = _spans(min_size, full)
            n = int(np.searchsorted(ends, total - bit, side="right"))
            if not n:
                break
            starts = starts[:n] + bit
            at = starts >> 3
            codes = ((d[at] | d[at + 1] << 8 | d[at + 2] << 16) >> (starts & 7)) & ((1 << widths[:n]) - 1)
            stop = np.flatnonzero((codes == clear) | (codes == clear + 1))
            upto = int(stop[0]) if len(stop) else n
            stretch.append(codes[:upto])
            bit, full = bit + int(ends[min(upto, n - 1)]), True
        if not stretch:
            break
        if len(own := np.concatenate(stretch)):
            parts.append(_strings(own, clear))
            size += len(parts[-1])
        if not len(stop) or codes[upto] == clear + 1:
            break
    return b"".join(p.tobytes() for p in parts)[:expected]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


GREY = bytes(v for i in range(256) for v in (i, i, i))


def encode(samples: bytes, width: int = WIDTH, frame_rows: int = FRAME_ROWS, delay: int = DELAY_CS, palette: bytes = GREY) -> bytes:
    """Rows of `width` samples as a GIF; a frame holds up to frame_rows rows."""
    rows = len(samples) // width
    height = min(rows, frame_rows)
    out = [b"GIF89a", struct.pack("<HHBBB", width, height, 0xF7, 0, 0), palette]
    for top in range(0, rows, frame_rows):
        part = samples[top * width : (top + frame_rows) * width]
        out += [b"\x21\xf9\x04", struct.pack("<BHBB", 1 << 2, delay, 0, 0), b"\x2c", struct.pack("<HHHHB", 0, 0, width, len(part) // width, 0), b"\x08", _blocks(lzw_encode(part))]
    return b"".join(out) + b"\x3b"


def _colours(raw: bytes) -> np.ndarray:
    out = np.zeros((256, 4), np.uint8)
    rgb = np.frombuffer(raw, np.uint8).reshape(-1, 3)
    out[: len(rgb), :3] = rgb
    out[:, 3] = 255
    return out


def _gather(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def decode(data: bytes) -> Iterator[tuple[int, int, np.ndarray, tuple[int, int, int, int]]]:
    """(start, delay) in hundredths of a second, the composited RGBA canvas, the frame's (left, top, width,
    height). Disposal 2 clears the frame's area, 3 restores what was there; a transparent index leaves the
    canvas as it is."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    at, shared = 13, None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        shared, at = _colours(data[at : at + n]), at + n
    canvas = np.zeros((height, width, 4), np.uint8)
    clock = delay = disposal = 0
    transparent = -1
    while True:
        kind = data[at]
        if kind == 0x3B:
            return
        if kind == 0x21:
            body, after = _gather(data, at + 2)
            if data[at + 1] == 0xF9 and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, body[1] | body[2] << 8
                transparent = body[3] if body[0] & 1 else -1
            at = after
            continue
        if kind != 0x2C:
            raise ValueError("bad GIF block")
        left, top, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        colours = shared
        if flags & 0x80:
            n = 3 << (flags & 7) + 1
            colours, at = _colours(data[at : at + n]), at + n
        if colours is None:
            raise ValueError("GIF without a palette")
        body, after = _gather(data, at + 1)
        index = np.frombuffer(lzw_decode(body, data[at], w * h), np.uint8)
        at = after
        if len(index) < w * h:
            raise ValueError("GIF image data ends early")
        index = index.reshape(h, w)
        if flags & 0x40:  # interlaced: rows come in four passes
            order = np.concatenate([np.arange(s, h, k) for s, k in ((0, 8), (4, 8), (2, 4), (1, 2))])
            index = index[np.argsort(order)]
        h2, w2 = max(0, min(h, height - top)), max(0, min(w, width - left))
        area = canvas[top : top + h2, left : left + w2]
        kept = area.copy() if disposal == 3 else None
        np.copyto(area, colours[index[:h2, :w2]], where=(index[:h2, :w2] != transparent)[..., None] if transparent >= 0 else True)
        yield clock, delay, canvas.copy(), (left, top, w2, h2)
        clock += delay
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            area[:] = kept
        delay = disposal = 0
        transparent = -1


def pixels_asked(data: bytes) -> int:
    """The most pixels that the canvas or one of the images takes, by their headers alone."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    most, at = width * height, 13
    while True:
        at += 3 << (flags & 7) + 1 if flags & 0x80 else 0
        if data[at] == 0x2C:
            w, h, flags = struct.unpack_from("<HHB", data, at + 5)
            most = max(most, w * h)
            at += 10 + (3 << (flags & 7) + 1 if flags & 0x80 else 0) + 1
        elif data[at] == 0x21:
            at += 2
        else:
            return most
        while data[at]:
            at += 1 + data[at]
        at, flags = at + 1, 0


def histogram(pixels: np.ndarray, bins: int = BINS) -> list[list[int]]:
    """Counts of red, green and blue in `bins` equal ranges, over pixels that are not transparent."""
    flat = pixels.reshape(-1, 4)
    flat = flat[flat[:, 3] > 0]
    return [np.bincount(flat[:, c].astype(np.int64) * bins >> 8, minlength=bins).tolist() for c in range(3)]


def payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8, blanks appended to a positive multiple of WIDTH; and the bytes without them."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b" " * (max(1, -(-len(raw) // WIDTH)) * WIDTH - len(raw)), len(raw)


_FRAME = "frame int, start_cs int, delay_cs int, width int, height int, pixels binary, red array<int>, green array<int>, blue array<int>, error string"


def frames(df: DataFrame, key: str = "doc_id", media: str = "media", most_pixels: int = MOST_PIXELS) -> DataFrame:
    """One row per frame of the GIF in column `media`: its time, canvas (RGBA rows) and colour histograms."""
    kind = dict(df.dtypes)[key]
    names = [key, *[c.split()[0] for c in _FRAME.split(", ")]]
    types = [pa.int32()] * 5 + [pa.binary()] + [pa.list_(pa.int32())] * 3 + [pa.string()]

    def row(own: pa.Array, values: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([own, *(pa.array([v], t) for v, t in zip(values, types, strict=True))], names=names)

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                own, data = batch.column(0).slice(k, 1), batch.column(1)[k].as_py() or b""
                try:
                    if (asked := pixels_asked(data)) > most_pixels:
                        raise ValueError(f"GIF of {asked} pixels, more than {most_pixels}")
                    for i, (start, delay, canvas, _) in enumerate(decode(data)):
                        # frame by frame: a long animation isn't held as a whole
                        yield row(own, [i, start, delay, canvas.shape[1], canvas.shape[0], canvas.tobytes(), *histogram(canvas), None])
                except (ValueError, IndexError, struct.error) as e:
                    yield row(own, [None] * 9 + [str(e)])

    return df.select(key, media).mapInArrow(read, f"{key} {kind}, {_FRAME}")


def stored(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the text's GIF in column `media`, with what reading that GIF back gives: payload_bytes,
    payload_sha256, tail_crc32 (last 16 bytes) and its grey histogram."""

    def work(batches):
        for batch in batches:
            cols = [[] for _ in range(6)]
            for text in batch.column(1).to_pylist():
                samples, n = payload(text)
                media = encode(samples)
                back, counts = [], np.zeros(BINS, np.int64)
                for _, _, canvas, (left, top, w, h) in decode(media):
                    grey = np.ascontiguousarray(canvas[top : top + h, left : left + w, 0])
                    back.append(grey.tobytes())
                    counts += np.bincount(grey.reshape(-1) >> 4, minlength=BINS)
                data = b"".join(back)
                for c, v in zip(cols, (n, media, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), counts.tolist()), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=["doc_id", "n_bytes", "media", "payload_bytes", "payload_sha256", "tail_crc32", "grey"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_bytes bigint, media binary, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, grey array<bigint>")


def op8(spark, sf_dir: str) -> DataFrame:
    return stored(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(",", F.transform("grey", lambda v: v.cast("string"))).alias("feature"))
