"""Token ids of documents in binary files of Simple-8b blocks.

Documents are dealt to shards by ranges of their id, so shard after shard, document after document, ids ascend.
Each shard is one file in a folder that all executors share:

    magic | words (64-bit little-endian, block after block) | escaped values | word offset of each block |
    document ids | tokens of each document | null flag of each document | lengths of these parts | magic

A shard's file gets a name of its own for each attempt, and a manifest (a table) lists the files of the attempts
that count. A lost executor therefore costs a rerun of its shards and leaves at most an unlisted file.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketry.llm import simple8b
from docketry.llm.shared import bounded_batches, open_filesystem, scratch_path, stored, tidy
from docketry.llm.textbytes import buffers, chunks, lanes, range_hashes

MAGIC = b"DKTOKEN1"
WRITE_BLOCKS = 512
#: Pieces that a worker keeps, of about 70 bytes each, before it forgets those that did not come again. A worker of
#: Spark serves all operators of a job in turn, and an executor has more workers than cores, so each holds little.
CACHE_PIECES = 500_000
#: Bytes of pieces that the tokenizer takes at once; what it returns is many times as large.
LEARN_BYTES = 1 << 16

#: White space other than single spaces and line feeds between other characters.
_UNEVEN = r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|^[ \n]|[ \n]$"
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[list(b".,;:!?*$%&#|)(")] = True


def _quoted(text: str) -> str:
    """The text as an RE2 pattern."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in text)


class CachedEncoder:
    """Byte-level BPE over whole texts, with the ids of recurring pieces kept.

    Pre-tokens never cross these places: before a space or a line feed between other characters, behind such a
    line feed, and between a letter and a mark of _MARK. So a text's ids are those of its pieces between them.
    Pieces are found, hashed and looked up by array operations, and every one is compared with the kept piece byte
    by byte; those not seen lately go to the tokenizer. Texts with any other white space, with the string of an
    added token, or with a piece whose hash is that of another, go to the tokenizer whole.

    The tokenizer is taken as its file says: the string of a special token becomes that token, unless
    `plain_specials` is set, which makes it ordinary text.
    """

    def __init__(self, path: str, most: int = CACHE_PIECES, plain_specials: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.tokenizer.model._resize_cache(0)  # the pieces that reach it are new
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for s, i in vocabulary.items() if s.startswith("Ġ")]] = True
        added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.uneven = "|".join([_UNEVEN, *map(_quoted, added)])
        self.most = most
        self._clear()

    def _clear(self) -> None:
        """Forget all pieces. keys ascend; row[i] is the entry of keys[i]; an entry's ids are flat[at[e] : at[e + 1]]."""
        self.keys, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.head = np.zeros((2, 0), np.uint64)  # the first 16 bytes of an entry, and in long_ the others
        self.long_: dict[int, bytes] = {}
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.again = np.zeros(0, bool)  # entries that a later call met

    def _sweep(self) -> None:
        """Forget the pieces that came in one call only; all, if that leaves more than half of the most."""
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > self.most:
            return self._clear()
        counts = self.at[kept + 1] - self.at[kept]
        ends = np.cumsum(counts)
        self.flat = self.flat[np.repeat(self.at[kept] - ends + counts, counts) + np.arange(counts.sum())]
        self.at = np.append(0, ends)
        self.length, self.head = self.length[kept], self.head[:, kept]
        self.long_ = {k: self.long_[i] for k, i in enumerate(kept.tolist()) if i in self.long_}
        own = self.again[self.row]
        place = np.cumsum(self.again) - 1
        self.keys, self.row = self.keys[own], place[self.row[own]]
        self.again = np.zeros(len(kept), bool)

    def _tokens(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, of which the tokenizer takes about LEARN_BYTES at once."""
        ids, lo, size = [], 0, 0
        for i, text in enumerate(texts, 1):
            size += len(text)
            if size >= LEARN_BYTES or i == len(texts):
                ids += [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo:i], add_special_tokens=False)]
                lo, size = i, 0
        return ids

    def _joined(self, pieces: list[bytes]) -> np.ndarray:
        """Ids of the pieces on end; each has a space in front, so cuts between them part no pre-token."""
        cuts = np.cumsum([len(p) for p in pieces]) // LEARN_BYTES
        parts = np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(cuts)) + 1)
        return np.concatenate([np.array(self._tokens([b"".join(pieces[i] for i in part).decode()])[0], np.int32) for part in parts])

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        """Add pieces with their (ascending) keys. Those with a space in front are encoded together."""
        spaced = np.array([p[0] == 0x20 for p in pieces], bool)
        joined = self._joined([p for p, s in zip(pieces, spaced, strict=True) if s])
        starts = np.flatnonzero(self.opens[joined])
        if len(starts) != spaced.sum():
            spaced[:], joined, starts = False, joined[:0], starts[:0]
        each = self._tokens([p.decode() for p, s in zip(pieces, spaced, strict=True) if not s])
        counts = np.zeros(len(pieces), np.int64)
        counts[spaced] = np.diff(np.append(starts, len(joined)))
        counts[~spaced] = [len(x) for x in each]
        order = np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])
        n = len(self.at) - 1
        self.flat = np.concatenate([self.flat, joined, np.array([i for x in each for i in x], np.int32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(counts[order])])
        self.length = np.concatenate([self.length, np.array([len(p) for p in pieces])[order]])
        heads = np.frombuffer(b"".join(pieces[i][:16].ljust(16, b"\0") for i in order.tolist()), "<u8").reshape(-1, 2).T
        self.head = np.concatenate([self.head, heads], axis=1)
        self.long_.update({n + k: pieces[i] for k, i in enumerate(order.tolist()) if len(pieces[i]) > 16})
        row = np.empty(len(pieces), np.int64)
        row[order] = np.arange(n, n + len(pieces))
        self.again = np.append(self.again, np.zeros(len(pieces), bool))
        where = np.searchsorted(self.keys, keys)
        self.keys, self.row = np.insert(self.keys, where, keys), np.insert(self.row, where, row)

    def _same(self, row: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether each piece is, byte by byte, that of its entry."""
        length = end - start
        same = self.length[row] == length
        same &= self.head[0][row] == lanes(data, start, length)
        two = np.flatnonzero(same & (length > 8))
        same[two] = self.head[1][row[two]] == lanes(data, start[two] + 8, length[two] - 8)
        for i in two[same[two] & (length[two] > 16)].tolist():
            same[i] = self.long_[int(row[i])] == data[start[i] : end[i]].tobytes()
        return same

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Token ids of each text; a null is empty."""
        if len(self.keys) > self.most:
            self._sweep()
        texts = texts.fill_null("")
        data, at = buffers(texts)
        whole = set(pc.indices_nonzero(pc.match_substring_regex(texts, self.uneven)).to_pylist())
        n = len(data)
        cut = np.zeros(n + 1, bool)
        feed = data == 0x0A
        cut[:n] = (data == 0x20) | feed
        cut[1:] |= feed
        cut[1:n] |= _MARK[data[1:]] & _LETTER[data[: n - 1]]
        cut[at] = True
        start = np.flatnonzero(cut[:n])
        end = np.append(start[1:], n)
        hashes = range_hashes(data, start, end)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == keys[inside]
        self.again[self.row[where[known]]] = True
        piece_text = np.searchsorted(at, start, "right") - 1
        if whole:
            even = np.ones(len(texts), bool)
            even[list(whole)] = False
            wanted = np.zeros(len(keys), bool)
            wanted[which[even[piece_text]]] = True
            first_even = np.full(len(keys), -1)
            own = np.flatnonzero(even[piece_text])[::-1]
            first_even[which[own]] = own
            first = np.where(wanted, first_even, first)
        else:
            wanted = np.ones(len(keys), bool)
        if (new := np.flatnonzero(wanted & ~known)).size:
            raw = data.tobytes()
            self._learn(keys[new], [raw[i:j] for i, j in zip(start[first[new]].tolist(), end[first[new]].tolist(), strict=True)])
            where = np.searchsorted(self.keys, keys)
        row = self.row[np.minimum(where, len(self.row) - 1)][which] if len(self.row) else which
        same = self._same(row, data, start, end) if len(self.row) else np.zeros(len(start), bool)
        whole |= set(np.unique(piece_text[~same]).tolist())  # equal hashes of unequal pieces
        if len(self.row):
            counts = self.at[row + 1] - self.at[row]
            if whole:
                skipped = np.zeros(len(texts), bool)
                skipped[list(whole)] = True
                counts[skipped[piece_text]] = 0
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.flat[np.repeat(self.at[row] - ends + counts, counts) + np.arange(total)]
            cuts = np.append(0, ends)[np.searchsorted(start, at)]
        else:
            ids, cuts = self.flat, np.zeros(len(at), np.int64)
        out = [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        rest = sorted(whole)
        for i, x in zip(rest, self._tokens([texts[i].as_py() for i in rest]), strict=True):
            out[i] = np.array(x, np.int32)
        return out


_ENCODERS: dict[tuple[str, bool], CachedEncoder] = {}


def _encoder(path: str, plain_specials: bool) -> CachedEncoder:
    """The worker's encoder of a vocabulary file; it serves all tasks of the worker."""
    key = (path, plain_specials)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = CachedEncoder(path, plain_specials=plain_specials)
    return _ENCODERS[key]


def encode_once(encoder: CachedEncoder, texts: pa.Array) -> list[np.ndarray]:
    """Token ids of each text, of which equal ones (a mix has documents twice, one behind the other) are encoded once."""
    own = texts.fill_null("").dictionary_encode()
    ids = encoder.encode(own.dictionary)
    return [ids[k] for k in own.indices.to_pylist()]


class ShardWriter:
    """Writes one file; ids go out in groups of WRITE_BLOCKS full blocks."""

    def __init__(self, uri: str) -> None:
        fs, path = open_filesystem(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path, compression=None)
        self.out.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_words = self.n_escaped = self.n_tokens = 0
        self.offsets: list[np.ndarray] = []
        self.escaped: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray, end: np.ndarray) -> None:
        """A document of ids and, after them, end."""
        n = len(ids) + len(end)
        self.docs.append((doc_id, n))
        self.n_tokens += n
        self.waiting += [ids, end]
        self.n_waiting += n
        if self.n_waiting >= WRITE_BLOCKS * simple8b.BLOCK:
            self._flush(self.n_waiting - self.n_waiting % simple8b.BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate([*self.waiting, np.zeros(0, np.int32)])
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n
        words, offsets, escaped = simple8b.encode(ids[:n])
        if len(escaped):
            own = np.flatnonzero(words >> np.uint64(60) == simple8b.ESCAPE)
            words[own] += np.uint64(self.n_escaped)
        self.out.write(words.astype("<u8").tobytes())
        self.offsets.append(offsets + self.n_words)
        self.escaped.append(escaped)
        self.n_words += len(words)
        self.n_escaped += len(escaped)

    def close(self) -> None:
        self._flush(self.n_waiting)
        ids = np.array([i or 0 for i, _ in self.docs], "<i8")
        tail = [
            np.concatenate([*self.escaped, np.zeros(0, np.uint64)]).astype("<u8"),
            np.concatenate([*self.offsets, np.zeros(0, np.int64)]).astype("<i8"),
            ids,
            np.array([n for _, n in self.docs], "<i8"),
            np.array([i is None for i, _ in self.docs], "u1"),
        ]
        for x in tail:
            self.out.write(x.tobytes())
        self.out.write(np.array([self.n_words, len(tail[0]), len(tail[1]), len(ids), self.n_tokens], "<i8").tobytes() + MAGIC)
        self.out.close()


def read_shard(uri: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, tokens of each, their token ids on end) of groups of whole documents of a file."""
    fs, path = open_filesystem(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        end = 5 * 8 + len(MAGIC)
        if size < len(MAGIC) + end or f.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{uri} is no token file")
        foot = f.read_at(end, size - end)
        n_words, n_escaped, n_blocks, n_docs, n_tokens = np.frombuffer(foot, "<i8", 5).tolist()
        at = len(MAGIC) + 8 * n_words
        if foot[-len(MAGIC) :] != MAGIC or size != at + 8 * (n_escaped + n_blocks) + 17 * n_docs + end:
            raise ValueError(f"{uri} is cut short")
        parts = []
        for n, kind in ((n_escaped, "<u8"), (n_blocks, "<i8"), (n_docs, "<i8"), (n_docs, "<i8"), (n_docs, "u1")):
            parts.append(np.frombuffer(f.read_at(n * np.dtype(kind).itemsize, at), kind))
            at += parts[-1].nbytes
        escaped, offsets, ids, counts, null = parts
        if counts.sum() != n_tokens or n_blocks != -(-n_tokens // simple8b.BLOCK):
            raise ValueError(f"{uri} has lengths that disagree")
        bounds = np.append(offsets, n_words)
        rest, doc = np.zeros(0, np.uint64), 0
        ends = np.cumsum(counts)
        for b in range(0, max(n_blocks, 1), WRITE_BLOCKS):
            hi = min(b + WRITE_BLOCKS, n_blocks)
            words = np.frombuffer(f.read_at(8 * int(bounds[hi] - bounds[b]), len(MAGIC) + 8 * int(bounds[b])), "<u8")
            upto = min(hi * simple8b.BLOCK, n_tokens)
            got = simple8b.decode(words, bounds[b:hi] - bounds[b], escaped, upto - b * simple8b.BLOCK)
            rest = np.concatenate([rest, got])
            to = int(np.searchsorted(ends, upto, "right"))
            n = int(counts[doc:to].sum())
            yield [None if z else i for i, z in zip(ids[doc:to].tolist(), null[doc:to].tolist(), strict=True)], counts[doc:to], rest[:n]
            rest, doc = rest[n:], to


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", plain_specials: bool = False) -> DataFrame:
    """Encode every text, append end_id, and write shards below `folder` in ascending id order.

    plain_specials makes the strings of special tokens in a text ordinary text; else they become these tokens.
    Returns the stored manifest (shard, uri, n_docs, n_tokens). A null text is empty; a null id comes first;
    rows of equal ids are ordered by a hash of their text. An empty table gives no file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        uri = f"{folder}/shard-{uuid.uuid4().hex}.tok"
        end = np.array([end_id], np.int32)
        for b in batches:
            texts = b.column(1)
            for lo, hi in chunks(texts):
                writer = writer or ShardWriter(uri)
                for i, ids in zip(b.column(0)[lo:hi].to_pylist(), encode_once(_encoder(tokenizer_path, plain_specials), texts[lo:hi]), strict=True):
                    writer.add(i, ids, end)
        if writer:
            writer.close()
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([uri]), pa.array([len(writer.docs)]), pa.array([writer.n_tokens])], names=["shard", "uri", "n_docs", "n_tokens"])

    rows = bounded_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")))
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    return stored(dealt.mapInArrow(tidy(write), "shard long, uri string, n_docs long, n_tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids array<int>) of every document of the files; digest: (.., ids_crc32) instead of ids.

    start counts the ids of all documents before; ids_crc32 is the CRC-32 of the ids as little-endian uint32.
    """
    # One row per file: the running sum needs one task, but never more rows than there are files.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("uri", before.alias("start"))
    n = max(1, files.sparkSession.sparkContext.defaultParallelism * 4)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for docs, counts, ids in read_shard(uri):
                    ends = np.cumsum(counts)
                    starts = start + ends - counts
                    start += int(counts.sum())
                    own = ids.astype("<u4")
                    if digest:
                        raw, cuts = memoryview(own.tobytes()), (4 * np.append(0, ends)).tolist()
                        last = pa.array([zlib.crc32(raw[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64())
                    else:
                        last = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(own.astype(np.int32)))
                    yield pa.record_batch([pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), last], names=["id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    return files.repartition(n, "uri").mapInArrow(tidy(read), f"id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids array<int>'}")


END_ID = 2


def token_report(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write token files of docs to the shared folder, read them back, and return a line per document."""
    manifest = write_token_files(docs, tokenizer_path, END_ID, scratch_path(spark, "tokens"))
    return read_token_files(manifest, digest=True).withColumnRenamed("id", "doc_id")
