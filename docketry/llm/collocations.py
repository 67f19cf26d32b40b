"""Phrases whose words stand together more often than apart, counted exactly per language.

Three passes, each linear in the text and bounded in memory:

1. Sketch. Every run of 1 to max_words words of a piece adds to a cell of a table of saturating counters, so a cell is
   an upper bound of each of its phrases. The table has about a cell per byte of text and is never in one place: tasks
   send sparse, sorted blocks of it, and reducers merge a block at a time. What is left of it is a bit per cell, folded
   to HOT_BITS at most: whether the bound reaches `least`. More phrases than the bits can tell apart only mean more
   candidates.
2. Count. A shard of text compiles the phrases whose bound is high enough into an Aho-Corasick automaton per language,
   each guarded by a space on either side, and counts all overlapping matches in its text, where words are one space
   apart and pieces two. The counts of the shards are summed, and only then `least` applies: no false candidate stays.
3. Score. Each candidate is cut wherever it can be; the parts of a frequent phrase are frequent, so their counts are there.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm import textbytes as tb
from docketry.llm.shared import bounded_batches, stored
from docketry.session import small

# What ends a piece, what stands between words, the name of no language.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
NO_LANGUAGE = "und"

#: Words of a phrase, its least occurrences, percentage of them within a longer one that drops it, phrases per language.
MAX_WORDS, LEAST, WITHIN_PERCENT, TOP = 3, 10, 50, 2000

#: Bits of the merged sketch that every worker holds (32 MB).
HOT_BITS = 28
#: Least and most cells of a block of the sketch, as powers of two; between them, a sketch has 2 ** BLOCKS_BITS blocks.
LEAST_BLOCK_BITS, MOST_BLOCK_BITS, BLOCKS_BITS = 16, 24, 12
#: Phrases that a task gathers before it sends their cells, and bytes of text that one automaton serves.
SKETCH_GRAMS = 5_000_000
SHARD_BYTES = 4 << 20
#: Parts of a language that are ranked apart first.
RANKED_PARTS = 32

_MARK = np.zeros(256, bool)
_MARK[list(PIECE_ENDS)] = True
_WORD = ~_MARK
_WORD[list(BLANKS)] = False
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _languages(langs: list[str]) -> np.ndarray:
    known = {x: xxhash.xxh3_64_intdigest(x.encode()) for x in set(langs)}
    return np.fromiter((known[x] for x in langs), np.uint64, len(langs))


class Shard:
    """Words of some texts, and the hashes of the phrases that start at each of them."""

    def __init__(self, texts: pa.Array, langs: list[str], max_words: int):
        self.words = w = tb.words(texts, _WORD)
        n = len(w.hash)
        text = np.repeat(np.arange(len(w.first) - 1), w.counts)
        marks = np.cumsum(_MARK[w.data], dtype=np.int32)[w.start] if n else np.zeros(0, np.int32)
        #: Whether a word and the next one are of one piece.
        self.joined = (marks[1:] == marks[:-1]) & (text[1:] == text[:-1])
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        h = tb.mix(w.hash ^ _languages(langs)[text])
        whole = np.ones(n, bool)
        for k in range(1, max_words + 1):
            if k > 1:
                whole = whole[:-1] & self.joined[k - 2 :]
                h = tb.mix(h[:-1] * _STEP + w.hash[k - 1 :])
            at = np.flatnonzero(whole)
            self.grams.append((at, h[at]))
            if n <= k:
                break

    def spaced(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end): the words, one space apart within a piece and two between pieces, and where they are."""
        w = self.words
        length = (w.end - w.start).astype(np.int32)
        gaps = np.cumsum(np.append(1, 2 - self.joined.astype(np.int32)), dtype=np.int32)
        end = np.cumsum(length, dtype=np.int32) + gaps
        out = np.full(int(end[-1]) + 1, 0x20, np.uint8)
        out[np.arange(int(length.sum()), dtype=np.int32) + np.repeat(gaps, length)] = w.data[_WORD[w.data]]
        return out, end - length, end


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """(texts, languages) of about `most` bytes, whatever the batches are; texts of a language stand together."""
    held: list[tuple[pa.Array, pa.Array]] = []
    size = 0

    def joined() -> tuple[pa.Array, list[str]]:
        texts, langs = pa.chunked_array([t for t, _ in held]), pa.chunked_array([x for _, x in held]).to_pylist()
        order = sorted(range(len(langs)), key=langs.__getitem__)
        return texts.take(pa.array(order)).combine_chunks(), [langs[i] for i in order]

    for b in batches:
        texts = b.column(1).cast(pa.large_string())
        for lo, hi in tb.chunks(texts, most):
            part = texts.slice(lo, hi - lo)
            held.append((part, b.column(0).slice(lo, hi - lo)))
            size += int(np.diff(tb.buffers(part)[1]).sum())
            if size >= most:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    at = (edges * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes())])


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))
    return bounded_batches(docs.select(lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))


def hot_cells(texts: DataFrame, cell_bits: int, least: int, max_words: int, hot_bits: int = HOT_BITS) -> np.ndarray:
    """One bit per cell, folded to 2 ** hot_bits: whether the sketch's bound reaches least. At most 2 ** hot_bits / 8 bytes."""
    block_bits = min(MOST_BLOCK_BITS, max(LEAST_BLOCK_BITS, cell_bits - BLOCKS_BITS))
    folds = 1 << (min(cell_bits, max(hot_bits, block_bits)) - block_bits)
    # Cells are sent as steps from one to the next; a step too long for its type is several, of no count.
    kind = np.uint16 if cell_bits <= 34 else np.uint32
    longest = np.iinfo(kind).max
    bound = min(least, 255)  # counters are of a byte; a bound that low lets more through, never less

    def send(cells: np.ndarray) -> pa.RecordBatch:
        cells, counts = np.unique(cells, return_counts=True)
        blocks = (cells >> cells.dtype.type(block_bits)).astype(np.int64)
        first = np.append(0, np.flatnonzero(np.diff(blocks)) + 1)
        steps = np.diff(cells, prepend=cells[:1]).astype(np.int64)
        steps[first] = cells[first] & cells.dtype.type((1 << block_bits) - 1)
        more = steps // longest
        end = np.cumsum(more + 1)
        sent = np.full(int(end[-1]), longest, kind)
        sent[end - 1] = steps - more * longest
        n = np.zeros(len(sent), np.uint8)
        n[end - 1] = np.minimum(counts, 255)
        edges = np.append((end - more - 1)[first], len(sent))
        names = blocks[first]
        columns = [pa.array((names % folds).astype(np.int32)), pa.array(names), _binary(sent, edges), _binary(n, edges)]
        return pa.record_batch(columns, names=["fold", "block", "steps", "counts"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        narrow = np.uint32 if cell_bits <= 32 else np.uint64
        for part, langs in _shards(batches, tb.CHUNK_BYTES):
            for _, h in Shard(part, langs, max_words).grams:
                held.append((h >> np.uint64(64 - cell_bits)).astype(narrow))
                n += len(h)
            if n >= SKETCH_GRAMS:
                yield send(np.concatenate(held))
                held, n = [], 0
        if n:
            yield send(np.concatenate(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, fold = None, None
        sums, hot = np.zeros(1 << block_bits, np.uint16), np.zeros(1 << block_bits, bool)

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([fold], pa.int32()), pa.array([np.packbits(hot).tobytes()], pa.binary())], names=["fold", "bits"])

        for b in batches:
            for f, block, steps, counts in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if block != at:
                    hot |= sums >= bound
                    sums[:] = 0
                    if f != fold and fold is not None:
                        if hot.any():
                            yield done()
                        hot[:] = False
                    at, fold = block, f
                n = np.frombuffer(counts, np.uint8)
                i = np.cumsum(np.frombuffer(steps, kind), dtype=np.int64)[n > 0]
                sums[i] = np.minimum(sums[i] + n[n > 0], 255)
        hot |= sums >= bound
        if hot.any():
            yield done()

    parts = texts.mapInArrow(sketch, "fold int, block long, steps binary, counts binary")
    merged = parts.repartition("fold").sortWithinPartitions("fold", "block").mapInArrow(merge, "fold int, bits binary")
    bits = np.zeros((folds, (1 << block_bits) // 8), np.uint8)
    for fold, row in merged.toLocalIterator():
        bits[fold] = np.frombuffer(row, np.uint8)
    return bits.reshape(-1)


def _counted(text: str, phrases: list[str]) -> np.ndarray:
    automaton = ahocorasick.Automaton()
    for i, p in enumerate(phrases):
        automaton.add_word(p, i)
    automaton.make_automaton()
    return np.bincount(np.fromiter(map(itemgetter(1), automaton.iter(text)), np.int32), minlength=len(phrases))


def shard_counts(texts: pa.Array, langs: list[str], hot, max_words: int) -> Iterator[tuple[str, int, list[bytes], np.ndarray]]:
    """(lang, words, phrases, counts) of a shard; hot(hashes) says which phrases to count. The phrase of no words stands for all words."""
    shard = Shard(texts, langs, max_words)
    first = shard.words.first
    grams = []
    for at, h in shard.grams:
        yes = hot(h)
        grams.append((at[yes], h[yes]))
    if not len(shard.words.hash):
        return
    spaced, start, end = shard.spaced()
    lo = 0
    while lo < len(langs):
        hi = lo
        while hi < len(langs) and langs[hi] == langs[lo]:
            hi += 1
        a, b = int(first[lo]), int(first[hi])
        if b > a:
            yield langs[lo], 0, [b""], np.array([b - a])
            base = int(start[a]) - 1
            text = spaced[base : int(end[b - 1]) + 1].tobytes().decode("latin-1")
            ranges = [(np.searchsorted(at, a), np.searchsorted(at, b)) for at, _ in grams]
            hashes = np.concatenate([h[x:y] for (_, h), (x, y) in zip(grams, ranges, strict=True)])
            at = np.concatenate([p[x:y] for (p, _), (x, y) in zip(grams, ranges, strict=True)])
            words = np.repeat(np.arange(1, len(grams) + 1), [y - x for x, y in ranges])
            _, one = np.unique(hashes, return_index=True)

            def spelled(i: np.ndarray) -> list[str]:
                return [text[x:y] for x, y in zip((start[at[i]] - 1 - base).tolist(), (end[at[i] + words[i] - 1] + 1 - base).tolist(), strict=True)]

            phrases, sizes = spelled(one), words[one]
            counts = _counted(text, phrases) if phrases else np.zeros(0, np.int64)
            if counts.sum() != len(hashes):  # two phrases of one hash: compile every phrase by its letters
                named = dict(zip(spelled(np.arange(len(at))), words.tolist(), strict=True))
                phrases, sizes = list(named), np.fromiter(named.values(), np.int64, len(named))
                counts = _counted(text, phrases)
            for k in range(1, len(grams) + 1):
                i = np.flatnonzero(sizes == k)
                if len(i):
                    yield langs[lo], k, [phrases[j][1:-1].encode("latin-1") for j in i.tolist()], counts[i]
        lo = hi


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, hot_bits: int = HOT_BITS) -> DataFrame:
    """(lang, words, phrase, n): every phrase of up to max_words words that occurs `least` times in its language, and per
    language a row of no words whose n counts all words."""
    texts = _texts(docs, text_col, lang_col)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cell_bits = max(LEAST_BLOCK_BITS, int(size).bit_length())
    bits = hot_cells(texts, cell_bits, least, max_words, hot_bits)
    sent = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    most = np.uint64(8 * len(bits) - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(sent.value, np.uint8)

        def hot(h: np.ndarray) -> np.ndarray:
            cell = h >> np.uint64(64 - cell_bits) & most
            return (flags[cell >> np.uint64(3)] >> (7 - (cell & np.uint64(7))).astype(np.uint8) & 1).astype(bool)

        for part, langs in _shards(batches, SHARD_BYTES):
            for lang, words, phrases, counts in shard_counts(part, langs, hot, max_words):
                n = len(phrases)
                columns = [pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, np.int32)), pa.array([lang])).cast(pa.string()), pa.array(np.full(n, words, np.int32)), pa.array(phrases, pa.binary()).view(pa.string()), pa.array(counts.astype(np.int64))]
                yield pa.record_batch(columns, names=["lang", "words", "phrase", "n"])

    parts = texts.mapInArrow(count, "lang string, words int, phrase string, n long")
    return parts.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(f"n >= {int(least)} or words = 0")


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored_phrases(counts: DataFrame, within_percent: int = WITHIN_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more that no longer one of the counts takes most of.

    counts come from phrase_counts(). Of a phrase's cuts the one of the lowest score counts, then the first. Products are
    decimals of 38 digits, exact up to 10 ** 15 occurrences.
    """
    cand = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    w = F.col("w")
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(k.alias("k"), _part(w, F.lit(1), k).alias("first"), _part(w, k + 1, F.col("words") - k).alias("rest"))))
    cuts = cand.select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.*")
    known = counts.where("words > 0")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    exact = F.expr("cast(a as decimal(15, 0)) * cast(a as decimal(15, 0)) * cast(1000000 as decimal(7, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = cuts.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: _part(w, i, m))))
    longer = cand.where("words > 2").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * within_percent))
    return kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, least: int = LEAST, within_percent: int = WITHIN_PERCENT, top: int = TOP, hot_bits: int = HOT_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language by score, occurrences and spelling.

    a phrase's occurrences, l and r those of its parts at the cut, n the words of its language. A null text is empty, a
    null language `und`. Repeated rows count each time; other columns are ignored; without a frequent phrase, no rows.
    """
    if max_words < 2 or least < 1 or top < 1:
        raise ValueError("phrases have two words or more, and occur once at least")
    counts = stored(phrase_counts(docs, text_col, lang_col, max_words, least, hot_bits), "collocation-counts")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # Parts of a language are ranked first, so the task that ranks the language gets RANKED_PARTS * top rows at most.
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))).orderBy(*order)
    first = scored_phrases(counts, within_percent).withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.where("words = 0").select("lang", F.col("n"))
    return ranked.join(small(words), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
