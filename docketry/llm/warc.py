"""WARC archives in Zstandard: one frame per record, with the dictionary in a leading skippable frame.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary, plain or itself
compressed; each record follows as one frame that uses it. Readers walk the frames by their headers, decode one
record at a time, and check version, header lines, Content-Length, the record's end, the HTTP length and, where
the payload is present, its digest.

Archives are written by the tasks that hold the pages and named anew for each attempt; a stored manifest lists
those that count. Payloads that occur again become revisit records: a narrow table of digests decides which,
and only page ids (which are even) key the shuffle that carries page bodies.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches, open_filesystem, scratch_path, stored

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
EXACT_URI = "X-Target-URI-Base64"
DIGESTS = {"sha1": 20, "sha256": 32, "sha512": 64, "md5": 16}
ARCHIVED_AT = "2024-01-01T00:00:00Z"

LEVEL = 3
DICTIONARY_BYTES = 32 << 10
#: Payload bytes from an archive's first pages that its dictionary is trained on.
TRAINING_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
#: Digests of so many rows at least, and so many digests at most, are told apart by a broadcast.
LEAST_HOT, MOST_HOT = 1000, 2000


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _one_line(value: str) -> str:
    """A header value on one line; all else, `%` included, stands as it is, so other readers see the same URI."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """A response record with the payload, or a revisit record with the HTTP head only."""
    digest = payload_digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_urn(page_id, digest)}", f"WARC-Date: {ARCHIVED_AT}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_one_line(url)}")
        if url != _one_line(url).strip():
            lines.append(f"{EXACT_URI}: {base64.b64encode(url.encode()).decode()}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_urn(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    kind: str
    """Any WARC-Type: response, revisit, warcinfo, request, metadata, resource, conversion, continuation or another."""
    page_id: int | None
    url: str | None
    payload: bytes | None
    """The body of an HTTP response, the block of any other record; None in a revisit record."""
    payload_bytes: int
    digest: str
    """As the record says, without the name of SHA-1; else that of the payload."""
    refers_to: int | None


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for x in lines:
        if x[:1] in (b" ", b"\t") and last:  # a folded line goes on
            out[last] += " " + x.decode(errors="replace").strip()
            continue
        name, colon, value = x.decode(errors="replace").partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {x[:60]!r}")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _check_digest(named: str, data: bytes) -> None:
    """Hold data against `algorithm:digest` in base 32 or hexadecimal; other algorithms are passed over."""
    kind, _, value = named.partition(":")
    if (size := DIGESTS.get(kind.lower())) is None:
        return
    own = hashlib.new(kind.lower(), data).digest()
    if value.rstrip("=").upper() not in (base64.b32encode(own).decode().rstrip("="), own.hex().upper()) or len(own) != size:
        raise ValueError("a payload differs from its digest")


def parse_record(data: bytes) -> Record:
    """A record from a frame's bytes; ValueError if a header, a length or a digest is wrong.

    HTTP responses give their body as payload, revisits none, and records of all other kinds their block. What only
    this library's own archives have (page ids, the exact URI) is null where it is missing.
    """
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS or not gap:
        raise ValueError(f"no record of WARC 1.0 or 1.1: {version[:20]!r}")
    h = _fields(lines)
    n = int(h["content-length"])
    if n < 0 or len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"a record of {len(rest)} bytes after its headers declares {n}")
    kind, block = h["warc-type"], rest[:n]
    if "warc-block-digest" in h:
        _check_digest(h["warc-block-digest"], block)
    payload, length = block, n
    if kind in ("response", "revisit") and h.get("content-type", "").replace(" ", "").lower().startswith("application/http") and (block or kind == "response"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        status, *lines = http.split(b"\r\n")
        if not status.startswith(b"HTTP/") or not gap:
            raise ValueError(f"no HTTP head: {status[:20]!r}")
        fields = _fields(lines)
        length = len(payload)
        if "content-length" in fields and "transfer-encoding" not in fields:
            length = int(fields["content-length"])
            if kind == "response" and len(payload) != length and "warc-truncated" not in h:
                raise ValueError(f"a payload of {len(payload)} bytes declares {length}")
    named = h.get("warc-payload-digest")
    if kind == "revisit":
        if payload and payload is not block and "x-page-id" in h:
            raise ValueError("a revisit record has a payload")
    elif named and kind == "response" and "warc-truncated" not in h:
        _check_digest(named, payload)
    page, other, exact = h.get("x-page-id"), h.get("x-refers-to-page-id"), h.get(EXACT_URI.lower())
    url = base64.b64decode(exact).decode() if exact else h.get("warc-target-uri")
    digest = named.removeprefix("sha1:") if named else payload_digest(payload)
    return Record(kind, int(page) if page else None, url, None if kind == "revisit" else payload, length, digest, int(other) if kind == "revisit" and other else None)


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of sample records; None if they are too few to train on."""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8)), samples, threads=0)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    def __init__(self, uri: str, dictionary: zstandard.ZstdCompressionDict | None) -> None:
        fs, path = open_filesystem(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.uri, self.out, self.size, self.records = uri, fs.open_output_stream(path, compression=None), 0, 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
        if dictionary:
            body = dictionary.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1

    def close(self) -> None:
        self.out.close()


class _Buffer:
    """Bytes of a stream from a position on, as many as asked for."""

    def __init__(self, stream) -> None:
        self.stream, self.data, self.at = stream, b"", 0

    def peek(self, n: int) -> memoryview:
        """The next n bytes, fewer at the end."""
        if len(self.data) - self.at < n:
            parts, have = [self.data[self.at :]], len(self.data) - self.at
            while have < n and (more := self.stream.read(max(READ_BYTES, n - have))):
                parts.append(more)
                have += len(more)
            self.data, self.at = b"".join(parts), 0
        return memoryview(self.data)[self.at : self.at + n]

    def take(self, n: int) -> memoryview:
        out = self.peek(n)
        if len(out) < n:
            raise ValueError("the archive is cut short")
        self.at += n
        return out


def _frame_size(buffer: _Buffer) -> int:
    """Bytes of the frame that comes next, from its header and its blocks' headers."""
    head = bytes(buffer.peek(18))
    try:
        n, checksum = zstandard.frame_header_size(head), zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        raise ValueError(f"bad frame: {e}") from e
    while True:
        block = bytes(buffer.peek(n + 3)[n:])
        if len(block) < 3:
            raise ValueError("the archive is cut short")
        word = int.from_bytes(block, "little")
        kind, size = word >> 1 & 3, word >> 3
        if kind == 3:
            raise ValueError("bad block")
        n += 3 + (1 if kind == 1 else size)
        if word & 1:
            return n + 4 * checksum


def read_archive(uri: str) -> Iterator[Record]:
    """The records of an archive in order, one decoded at a time; ValueError at the first that is not valid."""
    fs, path = open_filesystem(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        buffer = _Buffer(stream)
        dictionary = None
        first = buffer.peek(8)
        if len(first) == 8 and struct.unpack("<I", first[:4])[0] == DICTIONARY_MAGIC:
            n = struct.unpack("<I", buffer.take(8)[4:])[0]
            body = bytes(buffer.take(n))
            if body[:4] == struct.pack("<I", FRAME_MAGIC):
                body = zstandard.ZstdDecompressor().decompress(body)
            dictionary = zstandard.ZstdCompressionDict(body)
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
        k = 0
        while len(buffer.peek(4)):
            try:
                data = decoder.decompress(bytes(buffer.take(_frame_size(buffer))))
                yield parse_record(data)
            except (ValueError, KeyError, zstandard.ZstdError) as e:
                raise ValueError(f"record {k} of {uri}: {e}") from e
            k += 1


def with_references(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """pages with `__first`: the smallest page id of equal payloads where the row is not it, else null.

    Payloads below least_bytes, and those that occur once, have none. Equality is that of SHA-1 digests.
    """
    keyed = pages.withColumn("__digest", F.sha1(F.coalesce(F.col(payload_col), F.lit("")).cast("binary")))
    narrow = keyed.where(F.coalesce(F.octet_length(payload_col), F.lit(0)) >= least_bytes).select(id_col, "__digest")
    groups = stored(narrow.groupBy("__digest").agg(F.min(id_col).alias("__first"), F.count("*").alias("__n")).where("__n > 1"), "digests")
    total = groups.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    many = max(LEAST_HOT, total // MOST_HOT)  # so many rows have MOST_HOT digests at most, which are broadcast
    hot = groups.where(F.col("__n") >= many).select("__digest", F.col("__first").alias("__hot"))
    marked = narrow.join(F.broadcast(hot), "__digest", "left")
    rest = marked.where("__hot is null").drop("__hot").join(groups.where(F.col("__n") < many).select("__digest", "__first").hint("merge"), "__digest")
    led = rest.select(id_col, "__digest", "__first").unionByName(marked.where("__hot is not null").select(id_col, "__digest", F.col("__hot").alias("__first")))
    later = led.where(F.col(id_col) != F.col("__first")).dropDuplicates([id_col, "__digest"])
    return keyed.join(later, [id_col, "__digest"], "left").drop("__digest")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write a record per row of pages below `folder`; returns the stored manifest (uri, n_records, n_bytes).

    Of equal payloads of least_bytes or more, the row with the smallest id is a response and the others revisit
    it (repeated rows of that id are responses too); smaller payloads are all responses. A null payload is
    empty, a null url is left out, and a row with a null id is a response. An empty table gives no archive.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        held = 0
        writer, dictionary, trained = None, None, False
        closed: list[ArchiveWriter] = []

        def put(record: bytes) -> None:
            nonlocal writer
            writer = writer or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.warc.zst", dictionary)
            writer.add(record)
            if writer.size >= ARCHIVE_BYTES:
                writer.close()
                closed.append(writer)
                writer = None

        def start() -> None:
            nonlocal dictionary, trained, waiting
            dictionary, trained = train(waiting), True
            for r in waiting:
                put(r)
            waiting = []

        for b in batches:
            for page, url, html, first in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                record = build_record(page, url, (html or "").encode(), first, first is not None)
                if trained:
                    put(record)
                    continue
                waiting.append(record)
                held += len(record)
                if held >= TRAINING_BYTES:
                    start()
        if waiting:
            start()
        if writer:
            writer.close()
            closed.append(writer)
        yield pa.record_batch([pa.array([w.uri for w in closed], pa.string()), pa.array([w.records for w in closed], pa.int64()), pa.array([w.size for w in closed], pa.int64())], names=["uri", "n_records", "n_bytes"])

    rows = bounded_batches(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload")))
    rows = with_references(rows, "id", "payload", least_bytes).select(F.col("id").cast("long"), "url", "payload", F.col("__first").cast("long"))
    return stored(rows.mapInArrow(write, "uri string, n_records long, n_bytes long"), "warc-manifest")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """(uri, n_bytes) of the *.warc.zst files below a path, for :func:`read_archives`."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.warc.zst").load(path)
    return found.select(F.col("path").alias("uri"), F.col("length").alias("n_bytes"))


def read_archives(archives: DataFrame, payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to[, payload]) of all records.

    `archives` has a column uri; a task reads an archive at a time. An invalid record fails the read.
    """
    n = max(1, archives.sparkSession.sparkContext.defaultParallelism * 4)
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [*types, pa.binary()] if payload else types
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*names, "payload"][: len(kinds)])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for uri in b.column(0).to_pylist():
                for r in read_archive(uri):
                    rows.append((r.page_id, r.url, r.kind, r.payload_bytes, r.digest, r.refers_to, r.payload))
                    size += len(r.payload or b"") if payload else 0
                    if len(rows) >= 4096 or size >= 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        yield batch(rows)

    schema = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long" + ", payload binary" * payload
    return archives.select("uri").repartition(n, "uri").mapInArrow(read, schema)


def warc_report(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write archives of pages to the shared folder, read them back, and return a line per page."""
    manifest = write_archives(pages, scratch_path(spark, "warc"))
    return read_archives(manifest, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
