"""TIFF columns: a writer for lossless 8-bit pages, and a reader that emits one row per page.

The reader walks the image directories of either byte order, decodes PackBits, LZW, deflate or plain strips and tiles,
undoes the horizontal predictor and returns the samples.

Cases: a null or broken file gives one row with ``error`` set and no samples; a file without directories likewise; pages
decoded before a broken one are kept; repeated rows give repeated pages; an empty table gives an empty result; columns
other than the named ones are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.workers import tidy

# Fixed values of the TIFF 6.0 format.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_BYTES = 317, 322, 323, 324, 325
PLAIN, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
LZW_CLEAR, LZW_END, LZW_MAX_BITS = 256, 257, 12


def packbits_encode(data: bytes) -> bytes:
    a = np.frombuffer(data, np.uint8)
    edges = np.flatnonzero(np.diff(a)) + 1
    starts = np.concatenate(([0], edges)) if len(a) else edges
    lengths = np.diff(np.append(starts, len(a)))
    out, plain = bytearray(), 0

    def literal(lo: int, hi: int) -> None:
        for i in range(lo, hi, 128):
            piece = data[i : min(i + 128, hi)]
            out.append(len(piece) - 1)
            out.extend(piece)

    for k in np.flatnonzero(lengths >= 3):
        s, n = int(starts[k]), int(lengths[k])
        literal(plain, s)
        while n >= 2:
            m = min(n, 128)
            out.append(257 - m)
            out.append(data[s])
            s, n = s + m, n - m
        plain = s
    literal(plain, len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size:
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    acc = held = 0
    width, out = 9, bytearray()

    def put(code: int) -> None:
        nonlocal acc, held
        acc, held = acc << width | code, held + width
        while held >= 8:
            held -= 8
            out.append(acc >> held & 255)
        acc &= (1 << held) - 1

    fresh = {bytes((i,)): i for i in range(256)}
    table, free, w = dict(fresh), 258, b""
    put(LZW_CLEAR)
    for i in range(len(data)):
        longer = w + data[i : i + 1]
        if longer in table:
            w = longer
            continue
        put(table[w])
        table[longer] = free
        free += 1
        if free == (1 << width) and width < LZW_MAX_BITS:
            width += 1
        elif free == (1 << LZW_MAX_BITS) - 1:
            put(LZW_CLEAR)
            table, free, width = dict(fresh), 258, 9
        w = data[i : i + 1]
    if w:
        put(table[w])
        free += 1
        if free == (1 << width) and width < LZW_MAX_BITS:
            width += 1
    put(LZW_END)
    if held:
        put(0)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    """Codes are stored most significant bit first and widen one code early."""
    out, have = [], 0
    table: list[bytes] = []
    width, prev, acc, held = 9, None, 0, 0
    for byte in data:
        acc, held = acc << 8 | byte, held + 8
        if held < width:
            continue
        held -= width
        code = acc >> held
        acc &= (1 << held) - 1
        if code == LZW_CLEAR:
            table, width, prev = [bytes((i,)) for i in range(256)] + [b"", b""], 9, None
            continue
        if code == LZW_END:
            break
        if prev is None:
            s = table[code]
        else:
            s = table[code] if code < len(table) else prev + prev[:1]
            table.append(prev + s[:1])
            if len(table) >= (1 << width) - 1 and width < LZW_MAX_BITS:
                width += 1
        out.append(s)
        have += len(s)
        prev = s
        if have >= size:
            break
    return b"".join(out)


def _pack(kind: int, data: bytes) -> bytes:
    return {PLAIN: lambda d: d, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: packbits_encode}[kind](data)


def _unpack(kind: int, data: bytes, size: int) -> bytes:
    if kind in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    if kind not in (PLAIN, LZW, PACKBITS):
        raise ValueError(f"compression {kind}")
    return data if kind == PLAIN else (lzw_decode if kind == LZW else packbits_decode)(data, size)


def encode_tiff(pages: list[np.ndarray], compression: int, predictor: int = 1, rows_per_strip: int = 256, tile: tuple[int, int] | None = None) -> bytes:
    """8-bit grey pages to a little-endian TIFF; ``tile`` is (rows, columns)."""
    out = bytearray(b"II*\0" + bytes(4))
    link = 4
    for img in pages:
        h, w = img.shape
        th, tw = tile or (rows_per_strip, w)
        at, sizes = [], []
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = img[y : y + th, x : x + tw]
                if tile and part.shape != (th, tw):
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1])))
                if predictor == 2:
                    part = np.concatenate((part[:, :1], np.diff(part, axis=1)), axis=1)
                body = _pack(compression, part.tobytes())
                at.append(len(out))
                sizes.append(len(body))
                out += body
        where, counts = (TILE_OFFSETS, TILE_BYTES) if tile else (STRIP_OFFSETS, STRIP_BYTES)
        fields = {WIDTH: [w], HEIGHT: [h], BITS: [8], COMPRESSION: [compression], PHOTOMETRIC: [1], SAMPLES: [1], PREDICTOR: [predictor], where: at, counts: sizes}
        fields |= {TILE_WIDTH: [tw], TILE_LENGTH: [th]} if tile else {ROWS_PER_STRIP: [th]}
        out += bytes(len(out) % 2)
        heads = []
        for tag, values in sorted(fields.items()):
            body = struct.pack(f"<{len(values)}I", *values)
            if len(values) > 1:
                body, start = struct.pack("<I", len(out)), body
                out += start
            heads.append(struct.pack("<HHI", tag, 4, len(values)) + body)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(heads)) + b"".join(heads)
        link = len(out)
        out += bytes(4)
    return bytes(out)


def read_pages(data: bytes) -> Iterator[dict]:
    """One dict per image directory: width, height, bits, samples_per_pixel, compression, predictor, layout, samples."""
    order = {b"II": "<", b"MM": ">"}[bytes(data[:2])]
    if struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen = set()
    while at:
        if at in seen:
            raise ValueError("directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        f = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
            if kind not in (1, 3, 4):
                continue
            pos = at + 10 + 12 * k
            if FIELD_BYTES[kind] * count > 4:
                (pos,) = struct.unpack_from(order + "I", data, pos)
            f[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", data, pos)
        (following,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)
        yield _decode_page(data, f, order)
        at = following


def _decode_page(data: bytes, f: dict, order: str) -> dict:
    one = lambda tag, default=None: f.get(tag, (default,))[0]
    w, h, bits, spp = one(WIDTH), one(HEIGHT), one(BITS, 1), one(SAMPLES, 1)
    if bits not in (8, 16) or one(284, 1) != 1:
        raise ValueError("only chunky samples of 8 or 16 bits are read")
    kind, predictor, tiled = one(COMPRESSION, 1), one(PREDICTOR, 1), TILE_OFFSETS in f
    th, tw = (one(TILE_LENGTH), one(TILE_WIDTH)) if tiled else (min(one(ROWS_PER_STRIP, h), h), w)
    offsets, counts = (f[TILE_OFFSETS], f[TILE_BYTES]) if tiled else (f[STRIP_OFFSETS], f[STRIP_BYTES])
    kind_of = np.dtype(np.uint8 if bits == 8 else order + "u2")
    img = np.zeros((h, w, spp), kind_of.newbyteorder("="))
    across = -(-w // tw)
    for k, (at, size) in enumerate(zip(offsets, counts, strict=True)):
        y, x = k // across * th, k % across * tw
        rows = th if tiled else min(th, h - y)
        need = rows * tw * spp * bits // 8
        raw = _unpack(kind, data[at : at + size], need)
        if len(raw) < need:
            raise ValueError("a strip or tile ends early")
        part = np.frombuffer(raw[:need], kind_of).reshape(rows, tw, spp).astype(img.dtype)
        if predictor == 2:
            part = np.cumsum(part, axis=1, dtype=img.dtype)
        img[y : y + rows, x : x + tw] = part[: h - y, : w - x]
    return {"width": w, "height": h, "bits": bits, "samples_per_pixel": spp, "compression": kind, "predictor": predictor, "layout": "tiles" if tiled else "strips", "samples": img.tobytes()}


PAGE = pa.schema([
    ("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("bits", pa.int32()), ("samples_per_pixel", pa.int32()),
    ("compression", pa.int32()), ("predictor", pa.int32()), ("layout", pa.string()), ("mean", pa.float64()), ("stddev", pa.float64()),
    ("entropy", pa.float64()), ("samples", pa.binary()), ("error", pa.string()),
])
PAGE_DDL = "page int, width int, height int, bits int, samples_per_pixel int, compression int, predictor int, layout string, mean double, stddev double, entropy double, samples binary, error string"


def _measures(samples: bytes) -> dict:
    n = np.bincount(np.frombuffer(samples, np.uint8), minlength=256).astype(float)
    p, level = n / max(n.sum(), 1), np.arange(256)
    mean = float(p @ level)
    q = p[p > 0]
    return {"mean": mean, "stddev": float(np.sqrt(max(p @ level**2 - mean**2, 0))), "entropy": float(-(q * np.log2(q)).sum())}


def tiff_pages(media: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",), emit_bytes: int = 8 << 20) -> DataFrame:
    """One row per page, with the columns in ``keep``; rows go out as soon as ``emit_bytes`` of samples are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, src, held = [], [], 0

            def out():
                page = pa.RecordBatch.from_pylist(rows, schema=PAGE)
                kept = b.select(list(keep)).take(pa.array(src, pa.int64()))
                return pa.RecordBatch.from_arrays([*kept.columns, *page.columns], names=[*keep, *PAGE.names])

            for i, m in enumerate(b.column("_media")):
                page = -1
                try:
                    for page, p in enumerate(read_pages(m.as_py() or b"")):
                        rows.append({"page": page, **p, **_measures(p["samples"])})
                        src.append(i)
                        held += len(p["samples"])
                        if held >= emit_bytes:
                            yield out()
                            rows, src, held = [], [], 0
                    if page < 0:
                        raise ValueError("no image directory")
                except Exception as e:  # a broken file is data, not a reason to fail the job
                    rows.append({"page": page + 1, "error": f"{type(e).__name__}: {e}"[:200]})
                    src.append(i)
            if rows:
                yield out()

    src = media.select(*keep, F.col(media_col).alias("_media"))
    ddl = ", ".join(f"`{k}` {t}" for k, t in src.dtypes if k != "_media")
    return src.mapInArrow(tidy(run), f"{ddl}, {PAGE_DDL}")


def payload_image(payload: bytes) -> bytes:
    """A payload whose length is a multiple of 64 as one page of 64 columns; the coding goes by size.

    Short payloads use LZW, middling ones PackBits, long ones deflate with the predictor, in tiles beyond 64 KB.
    """
    img = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    n = len(payload)
    if n <= 512:
        return encode_tiff([img], LZW)
    if n <= 2048:
        return encode_tiff([img], PACKBITS)
    return encode_tiff([img], DEFLATE, predictor=2, tile=(128, 64) if n > 65536 else None)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts stored as TIFF: doc_id, n_bytes, media. The UTF-8 bytes are padded with 0 to a positive multiple of 64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                body = [x.as_py() for x in part.column("body")]
                media = [payload_image(x + bytes(max(64, -(-len(x) // 64) * 64) - len(x))) for x in body]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in body], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("body"))
    return src.mapInArrow(tidy(run), f"doc_id {src.dtypes[0][1]}, n_bytes long, media binary")
