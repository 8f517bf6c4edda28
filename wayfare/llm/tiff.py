"""Media columns: TIFF images in a binary column.

The reader walks the image directories of a file, decodes the strips or tiles of each
page (none, PackBits, LZW or deflate), undoes the horizontal predictor and gives one row a
page. The writer stores rows of samples as a gray page, for round trips and tests.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices

# Fixed values of the TIFF 6.0 format.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 322, 323, 324, 325, 339
TYPE_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
LZW_CLEAR, LZW_END, LZW_FIRST = 256, 257, 258

SLICE_BYTES = 4 << 20
#: Samples in a row of the pages that texts are stored in.
ROW = 64
STRIP_ROWS = 1024
TILE = (32, 64)
#: How texts are stored: (compression, predictor, tiles). A checksum of the text chooses, so
#: that texts of every length come in each form, and equal texts in one.
FORMS = [(code, predictor, tile) for code, predictor in ((PACKBITS, 1), (LZW, 1), (LZW, 2), (DEFLATE, 1), (DEFLATE, 2)) for tile in (None, TILE)]


class TiffError(ValueError):
    """The bytes are no TIFF file that this reader can decode."""


def packbits_decode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        head = data[i]
        i += 1
        if head < 128:
            out += data[i : i + head + 1]
            i += head + 1
        elif head > 128 and i < n:
            out += data[i : i + 1] * (257 - head)
            i += 1
    return bytes(out)


def packbits_encode(data: bytes) -> bytes:
    """Runs of 3 or more bytes as runs, all else as literals of at most 128."""
    a = np.frombuffer(data, np.uint8)
    edges = np.r_[0, np.flatnonzero(a[1:] != a[:-1]) + 1, len(a)] if len(a) else np.zeros(1, np.int64)
    long = np.flatnonzero(np.diff(edges) >= 3)
    out, done = bytearray(), 0

    def literal(upto: int) -> None:
        for k in range(done, upto, 128):
            part = data[k : min(k + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    for begin, end in zip(edges[long].tolist(), edges[long + 1].tolist(), strict=True):
        literal(begin)
        while end - begin > 1:
            step = min(end - begin, 128)
            out.extend((257 - step, data[begin]))
            begin += step
        done = begin
    literal(len(data))
    return bytes(out)


#: Bits of the n-th code after a clear code: widths change one code early.
LZW_WIDTHS = np.array([min((LZW_FIRST + n).bit_length(), 12) for n in range(3839)])


def lzw_decode(data: bytes) -> bytes:
    """Codes are cut out up to the next clear code at once, then their strings looked up."""
    raw = np.r_[np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)].astype(np.uint32)
    at, total, out = 0, 8 * len(data), []
    first = [bytes([b]) for b in range(256)] + [b"", b""]
    while at + 9 <= total:
        begins = at + np.cumsum(LZW_WIDTHS) - LZW_WIDTHS
        begins = begins[begins + LZW_WIDTHS <= total]
        widths, byte = LZW_WIDTHS[: len(begins)], begins >> 3
        window = raw[byte] << 24 | raw[byte + 1] << 16 | raw[byte + 2] << 8 | raw[byte + 3]
        codes = window >> (32 - (begins & 7) - widths).astype(np.uint32) & ((1 << widths) - 1).astype(np.uint32)
        stops = np.flatnonzero((codes == LZW_CLEAR) | (codes == LZW_END))
        n = int(stops[0]) if len(stops) else len(codes)
        table, before = list(first), b""
        for code in codes[:n].tolist():
            if code < len(table):
                entry = table[code]
            elif before and code == len(table):
                entry = before + before[:1]
            else:
                raise TiffError("LZW code out of range")
            if before and len(table) < 4096:
                table.append(before + entry[:1])
            out.append(entry)
            before = entry
        if not len(stops) and len(codes) == len(LZW_WIDTHS):
            raise TiffError("no LZW clear code in time")
        if not len(stops) or codes[n] == LZW_END:
            break
        at = int(begins[n] + widths[n])
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    codes, widths, table, prefix = [LZW_CLEAR], [np.array([9])], {}, -1
    for byte in data:
        key = prefix << 8 | byte
        code = byte if prefix < 0 else table.get(key)
        if code is None:
            codes.append(prefix)
            code, table[key] = byte, LZW_FIRST + len(table)
            if len(table) == 3836:
                codes.append(LZW_CLEAR)
                widths.append(LZW_WIDTHS[:3837])
                table = {}
        prefix = code
    rest = len(table) + (prefix >= 0) + 1
    codes += [prefix, LZW_END] if prefix >= 0 else [LZW_END]
    n = np.concatenate([*widths, LZW_WIDTHS[:rest]])
    ends = np.cumsum(n)
    shift = np.repeat(ends, n) - 1 - np.arange(ends[-1])
    return np.packbits((np.repeat(np.array(codes), n) >> shift & 1).astype(np.uint8)).tobytes()


def _unpack(data: bytes, compression: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return packbits_decode(data)
    if compression == LZW:
        return lzw_decode(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        try:
            return zlib.decompress(data)
        except zlib.error as error:
            raise TiffError(f"deflate: {error}") from None
    raise TiffError(f"compression {compression}")


def _pack(data: bytes, compression: int) -> bytes:
    return {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 3)}[compression](data)


@dataclass
class Page:
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    pixels: np.ndarray  # height x width x samples


def _directories(data: bytes) -> Iterator[tuple[str, dict[int, tuple]]]:
    """The byte order and the fields of each image directory, in the order of the chain."""
    if data[:4] not in (b"II*\0", b"MM\0*"):
        raise TiffError("no TIFF header")
    order = "<" if data[:2] == b"II" else ">"
    try:
        (at,), seen = struct.unpack_from(f"{order}I", data, 4), set()
        while at:
            if at in seen:
                raise TiffError("the chain of directories has a loop")
            seen.add(at)
            (n,) = struct.unpack_from(f"{order}H", data, at)
            fields = {}
            for k in range(n):
                tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
                size = TYPE_SIZES.get(kind, 0) * count
                place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(f"{order}I", data, at + 10 + 12 * k)[0]
                if kind in (1, 3, 4):
                    fields[tag] = struct.unpack_from(f"{order}{count}{'?B?HI'[kind]}", data, place)
            yield order, fields
            (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)
    except struct.error as error:
        raise TiffError(f"cut short: {error}") from None


def _decode_page(data: bytes, order: str, fields: dict[int, tuple]) -> Page:
    one = lambda tag, default=None: fields.get(tag, (default,))[0]
    width, height, samples, bits = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(BITS, 1)
    compression, predictor = one(COMPRESSION, NONE), one(PREDICTOR, 1)
    if width is None or height is None or bits not in (8, 16, 32) or one(PLANAR, 1) != 1 or predictor not in (1, 2):
        raise TiffError("a page of this kind is not supported")
    kind = np.dtype(f"{order}u{bits // 8}")
    tiled = TILE_OFFSETS in fields
    w, h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height) or 1)
    offsets, counts = (fields.get(TILE_OFFSETS), fields.get(TILE_COUNTS)) if tiled else (fields.get(STRIP_OFFSETS), fields.get(STRIP_COUNTS))
    if not offsets or not counts or not w or not h:
        raise TiffError("no strips or tiles")
    across = -(-width // w)
    pixels = np.zeros((height, width, samples), kind.newbyteorder("="))
    for k, (at, size) in enumerate(zip(offsets, counts, strict=True)):
        y, x = k // across * h, k % across * w
        rows = h if tiled else min(h, height - y)
        raw = _unpack(data[at : at + size], compression)
        if len(raw) < rows * w * samples * kind.itemsize:
            raise TiffError("a strip or tile is cut short")
        part = np.frombuffer(raw, kind, rows * w * samples).reshape(rows, w, samples).astype(kind.newbyteorder("="))
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=part.dtype)
        pixels[y : y + rows, x : x + w] = part[: height - y, : width - x]
    return Page(width, height, samples, bits, compression, pixels)


def read_pages(data: bytes) -> Iterator[Page]:
    """The pages of a TIFF file, in the order of its directories."""
    for order, fields in _directories(data):
        yield _decode_page(data, order, fields)


def write_tiff(pages: Sequence[np.ndarray], compression: int = DEFLATE, predictor: int = 1, rows_per_strip: int = STRIP_ROWS, tile: tuple[int, int] | None = None) -> bytes:
    """Pages, height x width (x samples) of unsigned integers, as a little-endian TIFF file
    of strips, or of tiles (width, height)."""
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for page in pages:
        page = page.reshape(*page.shape[:2], -1)
        height, width, samples = page.shape
        w, h = tile or (width, min(rows_per_strip, height))
        offsets, counts = [], []
        for y in range(0, height, h):
            for x in range(0, width, w):
                part = page[y : y + h, x : x + w]
                if tile and part.shape[:2] != (h, w):
                    part = np.pad(part, ((0, h - part.shape[0]), (0, w - part.shape[1]), (0, 0)))
                if predictor == 2:
                    part = np.diff(part, axis=1, prepend=np.zeros_like(part[:, :1]))
                packed = _pack(np.ascontiguousarray(part, part.dtype.newbyteorder("<")).tobytes(), compression)
                offsets.append(len(out))
                counts.append(len(packed))
                out += packed
        kind = {1: 3, 2: 3, 4: 3}[page.dtype.itemsize]
        bits = (8 * page.dtype.itemsize,) * samples
        fields = [(WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, kind, bits), (COMPRESSION, 3, (compression,)), (PHOTOMETRIC, 3, (2 if samples >= 3 else 1,)), (SAMPLES, 3, (samples,)), (PLANAR, 3, (1,)), (PREDICTOR, 3, (predictor,))]
        fields += [(TILE_WIDTH, 4, (w,)), (TILE_HEIGHT, 4, (h,)), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, counts)] if tile else [(STRIP_OFFSETS, 4, offsets), (ROWS_PER_STRIP, 4, (h,)), (STRIP_COUNTS, 4, counts)]
        entries = b""
        for tag, form, values in sorted(fields):
            raw = struct.pack(f"<{len(values)}{'?B?HI'[form]}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                place = struct.pack("<I", len(out))
                out += raw
            else:
                place = raw.ljust(4, b"\0")
            entries += struct.pack("<HHI", tag, form, len(values)) + place
        out += b"\0" * (len(out) % 2)
        out[link : link + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def text_to_tiff(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's bytes as one gray page of rows of 64 samples, filled
    up with bytes 0 to at least one full row, in one of FORMS. Null text: empty."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            media = []
            for i in range(len(texts.ids)):
                raw = texts.of(i)
                page = np.frombuffer(raw.ljust(max(ROW, -(-len(raw) // ROW) * ROW), b"\0"), np.uint8).reshape(-1, ROW)
                compression, predictor, tile = FORMS[zlib.crc32(raw) % len(FORMS)]
                media.append(write_tiff([page], compression, predictor, tile=tile))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(texts.starts), pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(store, f"`{id_col}` {kind}, n_bytes bigint, media binary")


#: One row a page; error names what is wrong with the file and comes instead of further pages.
PAGE_FIELDS = "page int, width long, height long, samples int, bits int, compression int, pixels binary, mean double, low long, high long, error string"


def tiff_pages(df: DataFrame, media: str = "media") -> DataFrame:
    """df without the media column, one row a page of it. A null or broken file gives one
    row with an error after the pages that could be read."""
    kept = [c for c in df.columns if c != media and c not in {f.split()[0] for f in PAGE_FIELDS.split(", ")}]
    head = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in head.schema], PAGE_FIELDS])

    def rows(data: bytes | None) -> Iterator[tuple]:
        number = 0
        try:
            if data is None:
                raise TiffError("null")
            for number, p in enumerate(read_pages(data)):
                values = p.pixels.astype(p.pixels.dtype.newbyteorder("<"), copy=False)
                some = values.size > 0
                yield number, p.width, p.height, p.samples, p.bits, p.compression, values.tobytes(), float(values.mean()) if some else None, int(values.min()) if some else None, int(values.max()) if some else None, None
                number += 1
        except TiffError as error:
            yield number, *[None] * 9, str(error)

    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in PAGE_FIELDS.split(", ")]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, out, held = [], [], 0
            for k, data in enumerate(batch.column(len(kept))):
                for row in rows(data.as_py()):
                    index.append(k)
                    out.append(row)
                    held += len(row[6] or b"")
                    if held > SLICE_BYTES:
                        yield emit(batch, index, out)
                        index, out, held = [], [], 0
            if out:
                yield emit(batch, index, out)

    def emit(batch: pa.RecordBatch, index: list[int], out: list[tuple]) -> pa.RecordBatch:
        at = pa.array(index, pa.int64())
        columns = [batch.column(c).take(at) for c in range(len(kept))]
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]], [*kept, *names])

    return df.select(*[F.col(f"`{c}`") for c in kept], media).mapInArrow(walk, schema)


def op2_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a TIFF file of one page, read back. Features are taken from the page."""
    stored = text_to_tiff(documents(spark, sf_dir)).withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    page = tiff_pages(stored)
    payload = F.col("pixels")
    tail = F.substring(payload, -64, 64)
    feature = F.format_string("page=%d;size=%dx%d;compression=%d;low=%d;high=%d;mean=%.6f", "page", "width", "height", "compression", "low", "high", "mean")
    return page.select("doc_id", "n_bytes", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_sha256"), F.crc32(tail).alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"))
