"""Media in binary columns: what they are by their bytes, whatever they are declared as, and media inside of other bytes.

One Aho-Corasick automaton holds the magic bytes of all formats and finds them anywhere in a value. Each place is
handed to the format's validator, which follows the structure (chunks with their checksums, block chains, boxes, sizes
against sizes) and gives the medium's exact length, or refuses. What is valid at the first byte is the value's type; what
is valid elsewhere, behind that first byte or within its medium, is embedded and can be carved.

The other half is lossless storage of byte strings as samples of such formats, and reading them back from the files
alone.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches, free_name, scratch_path

# Magic bytes, their offset from the start of a medium, and the format whose validator decides.
MAGIC = [
    (b"\x89PNG\r\n\x1a\n", 0, "png"),
    (b"\xff\xd8\xff", 0, "jpeg"),
    (b"GIF87a", 0, "gif"),
    (b"GIF89a", 0, "gif"),
    (b"BM", 0, "bmp"),
    (b"RIFF", 0, "riff"),
    (b".snd", 0, "au"),
    (b"OggS", 0, "ogg"),
    (b"ftyp", 4, "mp4"),
]
# Media types by format.
MIME = {"png": "image/png", "jpeg": "image/jpeg", "gif": "image/gif", "bmp": "image/bmp", "wav": "audio/x-wav", "webp": "image/webp", "avi": "video/x-msvideo", "au": "audio/basic", "ogg": "application/ogg", "mp4": "video/mp4"}
UNKNOWN = "application/octet-stream"

#: Samples of a row of an image, and what payloads are padded with, to a multiple of ROW.
ROW = 192
PAD = 32
#: Samples per second of sounds.
RATE = 8000

Found = tuple[str, int]  # format, length in bytes


@lru_cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic, offset, kind in MAGIC:
        a.add_word(magic.decode("latin-1"), (len(magic) - 1 + offset, kind))
    a.make_automaton()
    return a


def _png(b: memoryview, at: int) -> Found | None:
    end, first = at + 8, True
    while end + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, end)
        close = end + 12 + size
        if close > len(b) or not kind.isalpha() or first != (kind == b"IHDR") or (first and size != 13):
            return None
        if zlib.crc32(b[end + 4 : close - 4]) != struct.unpack_from(">I", b, close - 4)[0]:
            return None
        if kind == b"IEND":
            return ("png", close - at) if size == 0 else None
        end, first = close, False
    return None


def _jpeg(b: memoryview, at: int) -> Found | None:
    i, frame, scan = at + 2, False, False
    while i + 2 <= len(b):
        if b[i] != 0xFF:
            return None
        mark = b[i + 1]
        if mark == 0xFF:  # a fill byte
            i += 1
            continue
        if mark == 0xD9:
            return ("jpeg", i + 2 - at) if frame and scan else None
        if mark == 0 or 0xD0 <= mark <= 0xD8 or i + 4 > len(b):
            return None
        size = struct.unpack_from(">H", b, i + 2)[0]
        if size < 2 or i + 2 + size > len(b):
            return None
        frame |= 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC)
        i += 2 + size
        if mark == 0xDA:
            if not frame:
                return None
            scan, body = True, np.frombuffer(b, np.uint8, offset=i)
            # The coded samples go on to the first mark that is neither a stuffed byte nor a restart.
            ends = body[1:][body[:-1] == 0xFF]
            ends_at = np.flatnonzero(body[:-1] == 0xFF)
            real = ends_at[(ends != 0) & (ends != 0xFF) & ~((ends >= 0xD0) & (ends <= 0xD7))]
            if not len(real):
                return None
            i += int(real[0])
    return None


def _gif_blocks(b: memoryview, i: int) -> int | None:
    while i < len(b):
        if b[i] == 0:
            return i + 1
        i += 1 + b[i]
    return None


def _gif(b: memoryview, at: int) -> Found | None:
    def palette(flags: int) -> int:
        return 3 << (flags & 7) + 1 if flags & 0x80 else 0

    if at + 13 > len(b):
        return None
    i, images = at + 13 + palette(b[at + 10]), 0
    while i is not None and i < len(b):
        if b[i] == 0x3B:
            return ("gif", i + 1 - at) if images else None
        if b[i] == 0x21:
            i = _gif_blocks(b, i + 2)
        elif b[i] == 0x2C and i + 10 < len(b):
            i, images = _gif_blocks(b, i + 11 + palette(b[i + 9])), images + 1
        else:
            return None
    return None


def _bmp(b: memoryview, at: int) -> Found | None:
    if at + 54 > len(b):
        return None
    size, start, head, width, height, planes, bits, packed = struct.unpack_from("<I4xIIiiHHI", b, at + 2)
    if head not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or packed not in (0, 3) or width <= 0 or height == 0:
        return None
    body = (width * bits + 31) // 32 * 4 * abs(height)
    return ("bmp", size) if 14 + head <= start and start + body <= size <= len(b) - at else None


def _riff(b: memoryview, at: int) -> Found | None:
    if at + 20 > len(b):
        return None
    size, kind = struct.unpack_from("<I4s", b, at + 4)
    end = at + 8 + size
    name = {b"WAVE": "wav", b"WEBP": "webp", b"AVI ": "avi"}.get(kind)
    if name is None or end > len(b):
        return None
    i, seen = at + 12, set()
    while i + 8 <= end:
        chunk, n = struct.unpack_from("<4sI", b, i)
        seen.add(chunk)
        i += 8 + n + (n & 1)
    needs = {"wav": [{b"fmt ", b"data"}], "webp": [{b"VP8 "}, {b"VP8L"}, {b"VP8X"}], "avi": [{b"LIST"}]}[name]
    return (name, end - at) if i == end and any(x <= seen for x in needs) else None


def _au(b: memoryview, at: int) -> Found | None:
    if at + 24 > len(b):
        return None
    start, size, coding, rate, channels = struct.unpack_from(">5I", b, at + 4)
    fits = 24 <= start <= 1 << 16 and size <= len(b) - at - start
    return ("au", start + size) if fits and 1 <= coding <= 27 and rate and 1 <= channels <= 64 else None


def _ogg_table() -> list[int]:
    table = []
    for x in range(256):
        x <<= 24
        for _ in range(8):
            x = (x << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if x & 0x80000000 else x << 1
        table.append(x)
    return table


_OGG_CRC = _ogg_table()


def _ogg_page(b: memoryview, at: int) -> tuple[int, int, int] | None:
    """(length, flags, serial) of a page whose checksum holds."""
    if at + 27 > len(b) or b[at : at + 4] != b"OggS" or b[at + 4] != 0:
        return None
    head = at + 27 + b[at + 26]
    end = head + sum(b[at + 27 : head])
    if head > len(b) or end > len(b):
        return None
    crc = 0
    for k, x in enumerate(b[at:end]):
        crc = crc << 8 & 0xFFFFFFFF ^ _OGG_CRC[crc >> 24 ^ (0 if 22 <= k < 26 else x)]
    return (end - at, b[at + 5], struct.unpack_from("<I", b, at + 14)[0]) if crc == struct.unpack_from("<I", b, at + 22)[0] else None


def _ogg(b: memoryview, at: int) -> Found | None:
    page = _ogg_page(b, at)
    if page is None or not page[1] & 2:
        return None
    end, serial = at + page[0], page[2]
    while not page[1] & 4:
        page = _ogg_page(b, end)
        if page is None or page[2] != serial:
            return None
        end += page[0]
    return "ogg", end - at


def _mp4(b: memoryview, at: int) -> Found | None:
    i, seen = at, set()
    while i + 8 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, i)
        if size == 1 and i + 16 <= len(b):
            size = struct.unpack_from(">Q", b, i + 8)[0]
        if kind not in _BOXES:
            break
        if size < 8 or i + size > len(b):
            return None
        seen.add(kind)
        i += size
    return ("mp4", i - at) if {b"ftyp", b"moov"} <= seen else None


# Boxes that may stand at the top of a file.
_BOXES = {b"ftyp", b"moov", b"mdat", b"free", b"skip", b"wide", b"moof", b"mfra", b"meta", b"uuid", b"pdin", b"sidx", b"styp"}

VALIDATORS: dict[str, Callable[[memoryview, int], Found | None]] = {"png": _png, "jpeg": _jpeg, "gif": _gif, "bmp": _bmp, "riff": _riff, "au": _au, "ogg": _ogg, "mp4": _mp4}


def located(value: bytes) -> tuple[list[tuple[str, int, int]], int]:
    """([(format, start, length)], magic strings seen): valid media in order of their starts.

    One at the first byte may hold others; those overlap no earlier one of their kind.
    """
    view = memoryview(value)
    places = sorted((end - back, kind) for end, (back, kind) in _automaton().iter(value.decode("latin-1")) if end >= back)
    found, free = [], 0
    for at, kind in places:
        if at >= free and (hit := VALIDATORS[kind](view, at)):
            found.append((hit[0], at, hit[1]))
            free = at + hit[1] if at else 1
    return found, len(places)


def _list_offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))


def sniff(df: DataFrame, value_col: str, declared_col: str | None = None) -> DataFrame:
    """df with what value_col is by its bytes. New columns (underscores are added where df has the name):

    `media_type` is the type of the medium at the first byte, else application/octet-stream, and null for a null value;
    `media_length` that medium's bytes; `declared_right` whether declared_col says the same (null without one);
    `magic_hits` how many magic strings stand anywhere; `embedded` (type, start, length) the other valid media.
    """
    df = bounded_batches(df)
    names = {n: free_name(df, n) for n in ("media_type", "media_length", "magic_hits", "embedded", "declared_right")}
    at = df.columns.index(value_col)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds, lengths, hits, inner = [], [], [], []
            for v in b.column(at):
                found, n = located(v.as_py()) if v.is_valid else ([], None)
                head = found[0] if found and found[0][1] == 0 else None
                kinds.append(None if not v.is_valid else MIME[head[0]] if head else UNKNOWN)
                lengths.append(head and head[2])
                hits.append(n)
                inner.append([(MIME[k], s, z) for k, s, z in found if s > 0])
            flat = [x for xs in inner for x in xs]
            parts = [pa.array([x[i] for x in flat], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            embedded = pa.ListArray.from_arrays(_list_offsets([len(x) for x in inner]), pa.StructArray.from_arrays(parts, ["type", "start", "length"]))
            columns = [*b.columns, pa.array(kinds, pa.string()), pa.array(lengths, pa.int64()), pa.array(hits, pa.int64()), embedded]
            yield pa.record_batch(columns, names=[str(i) for i in range(len(columns))])

    schema = ", ".join([f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema] + [f"{names['media_type']} string, {names['media_length']} long, {names['magic_hits']} long, {names['embedded']} array<struct<type:string,start:bigint,length:bigint>>"])
    right = F.col(names["media_type"]) == F.col(declared_col) if declared_col else F.lit(None).cast("boolean")
    return df.mapInArrow(look, schema).withColumn(names["declared_right"], right)


def carve(sniffed: DataFrame, key_col: str, value_col: str, embedded_col: str = "embedded") -> DataFrame:
    """(key, type, start, length, body): the embedded media of rows that sniff() has seen, one row each."""
    rows = sniffed.select(F.col(key_col).alias("key"), F.col(value_col).alias("value"), F.explode(embedded_col).alias("m"))
    return rows.select("key", "m.*", F.expr("substring(value, cast(m.start + 1 as int), cast(m.length as int))").alias("body"))


# --- byte strings as samples


def _wav_of(payload: bytes) -> bytes:
    body = payload + b"\0" * (len(payload) & 1)
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + body


def _of_wav(b: bytes) -> bytes:
    i = 12
    while b[i : i + 4] != b"data":
        n = struct.unpack_from("<I", b, i + 4)[0]
        i += 8 + n + (n & 1)
    return b[i + 8 : i + 8 + struct.unpack_from("<I", b, i + 4)[0]]


def _au_of(payload: bytes) -> bytes:
    return b".snd" + struct.pack(">5I", 24, len(payload), 2, RATE, 1) + payload


def _of_au(b: bytes) -> bytes:
    start, size = struct.unpack_from(">II", b, 4)
    return b[start : start + size]


def _bmp_of(payload: bytes) -> bytes:
    start = 14 + 40 + 1024
    grey = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4)
    grey[:, 3] = 0
    head = struct.pack("<2sI4xI", b"BM", start + len(payload), start) + struct.pack("<IiiHHIIiiII", 40, ROW, -(len(payload) // ROW), 1, 8, 0, len(payload), 0, 0, 256, 256)
    return head + grey.tobytes() + payload


def _of_bmp(b: bytes) -> bytes:
    start, width, height = (struct.unpack_from(f, b, at)[0] for f, at in (("<I", 10), ("<i", 18), ("<i", 22)))
    return b[start : start + width * -height]  # rows from the top, each a multiple of four bytes


def _png_of(payload: bytes) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(body, zlib.crc32(kind)))

    rows = len(payload) // ROW
    lines = np.zeros((rows, ROW + 1), np.uint8)  # a filter byte of 0 before each row
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _of_png(b: bytes) -> bytes:
    i, parts, width = 8, [], struct.unpack_from(">I", b, 16)[0]
    while i < len(b):
        size, kind = struct.unpack_from(">I4s", b, i)
        if kind == b"IDAT":
            parts.append(b[i + 8 : i + 8 + size])
        i += 12 + size
    return np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(-1, width + 1)[:, 1:].tobytes()


#: Formats that payloads are stored in: how to write and to read them.
CODECS: dict[str, tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]] = {"wav": (_wav_of, _of_wav), "au": (_au_of, _of_au), "bmp": (_bmp_of, _of_bmp), "png": (_png_of, _of_png)}


def padded(text: bytes) -> bytes:
    return text + bytes([PAD]) * (-len(text) % ROW if text else ROW)


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "media") -> DataFrame:
    """(doc_id, n_bytes, declared, media): texts as media, written as a table in the shared folder and read from it.

    The format is one of CODECS by the checksum of the payload; the declared type, by another one, is often wrong.
    """
    names = list(CODECS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, declared, media = [], [], []
            for v in b.column(1):
                text = v.as_buffer().to_pybytes() if v.is_valid else b""
                payload = padded(text)
                sizes.append(len(text))
                media.append(CODECS[names[zlib.crc32(payload) % len(names)]][0](payload))
                declared.append(MIME[names[zlib.adler32(payload) % len(names)]])
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), pa.array(declared, pa.string()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "declared", "media"])

    rows = bounded_batches(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")))
    stored = rows.mapInArrow(build, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, declared string, media binary")
    spark = docs.sparkSession
    path = scratch_path(spark, name)
    stored.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(stored.schema).parquet(path)


def media_features(stored: DataFrame) -> DataFrame:
    """Of rows (doc_id, n_bytes, declared, media): type by the bytes, the samples read back, and figures of them.

    `feature` says: type by signature, whether it was declared so, magic strings and embedded media in the stored bytes,
    samples, the rounded mean, and the changes of side of the middle (128).
    """
    sniffed = sniff(stored, "media", "declared")
    by_mime = {MIME[k]: k for k in CODECS}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for kind, length, media in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4), strict=True):
                body = media.as_buffer().to_pybytes()
                if kind not in by_mime or length != len(body):
                    raise ValueError(f"stored media of {len(body)} bytes are {kind} of {length} bytes")
                payload = CODECS[by_mime[kind]][1](body)
                samples = np.frombuffer(payload, np.uint8)
                turns = int(np.count_nonzero(np.diff(samples >= 128)))
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(body), hashlib.sha256(body).hexdigest(), f"samples={len(payload)};mean={(int(samples.sum(dtype=np.int64)) + len(payload) // 2) // len(payload)};turns={turns}"))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [b.column(0), b.column(1), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types)), *b.columns[5:]]
            yield pa.record_batch(columns, names=[str(i) for i in range(len(columns))])

    seen = F.format_string("%s;declared=%s;magic=%d;embedded=%d;", "media_type", F.when(F.col("declared_right"), "right").otherwise("wrong"), "magic_hits", F.size("embedded"))
    narrow = sniffed.select("doc_id", "n_bytes", "media_type", "media_length", "media", seen.alias("seen"))
    kinds = f"doc_id {stored.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, samples string, seen string"
    return narrow.mapInArrow(read, kinds).withColumn("feature", F.concat("seen", "samples")).drop("seen", "samples")


def media_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) per row of docs.

    A null text is empty; equal texts give equal values, whatever the id; repeated rows stay; other columns are ignored.
    """
    return media_features(store_media(docs, id_col, text_col))
