"""Benchmark decontamination by winnowing.

A fingerprint is the least hash of K-grams in each run of WINDOW - K + 1 consecutive K-grams. Two texts that
share WINDOW words share such a run, hence its fingerprint, so no shared window is missed. Every fingerprint
that a document and an item have in common is extended word by word to both sides; spans of WINDOW words or
more are hits. Items with fewer words than a window are one window each and are matched by their full hash.

A benchmark of up to `broadcast_words` words goes to every task as an index, and documents are scanned once
without a shuffle. A larger one is joined with the documents' fingerprints by a shuffle. Words are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches, free_name, tidy
from docketry.llm.textbytes import ALNUM, Words, chunks, ngrams, words

WINDOW = 13
K = 7
#: Words around a K-gram that a window with it can reach, to the left and to the right.
REACH = WINDOW - K
BROADCAST_WORDS = 2_000_000


def fingerprints(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the K-grams that winnowing selects, for texts of WINDOW words and more."""
    n = len(w.hash)
    at, h = ngrams(w, K)
    if n < WINDOW:
        return at[:0], h[:0]
    grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    grams[at] = h
    left = np.repeat(w.first[1:], w.counts) - np.arange(n)
    starts = np.flatnonzero(left >= WINDOW)
    runs = np.lib.stride_tricks.sliding_window_view(grams, REACH + 1)[starts]
    chosen = np.zeros(n, bool)
    chosen[starts + runs.argmin(axis=1)] = True
    pos = np.flatnonzero(chosen)
    return pos, grams[pos]


@dataclass
class Index:
    """Benchmark items as word hashes, with their fingerprints in order."""

    ids: list[str | None]
    hash: np.ndarray
    item: np.ndarray
    low: np.ndarray
    high: np.ndarray
    prints: np.ndarray
    print_at: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    """Words of an item below a window -> (hashes in order, items)."""


def build_index(ids: list[str | None], texts: pa.Array) -> Index:
    w = words(texts, ALNUM)
    counts = w.counts
    pos, h = fingerprints(w)
    order = np.argsort(h, kind="stable")
    short = {}
    for n in sorted({int(c) for c in counts if 0 < c < WINDOW}):
        at, g = ngrams(w, n)
        whole = np.isin(at, w.first[:-1][counts == n])
        g, item = g[whole], np.searchsorted(w.first, at[whole], "right") - 1
        o = np.argsort(g, kind="stable")
        short[n] = (g[o], item[o])
    item = np.repeat(np.arange(len(texts)), counts)
    return Index(ids, w.hash, item, w.first[:-1][item], w.first[1:][item], h[order], pos[order], short)


def matches(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with keys[i] == sorted_keys[j]."""
    lo = np.searchsorted(sorted_keys, keys, "left")
    n = np.searchsorted(sorted_keys, keys, "right") - lo
    i = np.repeat(np.arange(len(keys)), n)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)


def extend(same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of equality around a K-gram: words matched to its left and right, and whether that makes a window."""
    gram = same[:, REACH : REACH + K].all(axis=1)
    left = np.logical_and.accumulate(same[:, :REACH][:, ::-1], axis=1).sum(axis=1)
    right = np.logical_and.accumulate(same[:, REACH + K :], axis=1).sum(axis=1)
    return left, right, gram & (left + K + right >= WINDOW)


OFFSETS = np.arange(-REACH, K + REACH)


def context(w: Words, pos: np.ndarray) -> np.ndarray:
    """Hashes of the words around each position of a K-gram; 0 outside the text."""
    text = np.searchsorted(w.first, pos, "right") - 1
    at = pos[:, None] + OFFSETS
    inside = (at >= w.first[text][:, None]) & (at < w.first[text + 1][:, None])
    return np.where(inside, w.hash[np.where(inside, at, 0)], np.uint64(0))


def hits(w: Words, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, end, item) of spans of texts that occur in items, as word positions in w."""
    pos, h = fingerprints(w)
    i, j = matches(index.prints, h)
    p, b = pos[i], index.print_at[j]
    mine = context(w, p)
    at = b[:, None] + OFFSETS
    inside = (at >= index.low[b][:, None]) & (at < index.high[b][:, None])
    same = inside & (mine == index.hash[np.where(inside, at, 0)]) & (mine != 0) if len(p) else np.zeros((0, len(OFFSETS)), bool)
    left, right, ok = extend(same)
    found = [(p - left)[ok]], [(p + K + right)[ok]], [index.item[b][ok]]
    for n, (keys, items) in index.short.items():
        at, g = ngrams(w, n)
        i, j = matches(keys, g)
        for x, y in zip(found, (at[i], at[i] + n, items[j]), strict=True):
            x.append(y)
    return tuple(np.concatenate(x).astype(np.int64) for x in found)


def _covered(first: np.ndarray, n_words: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a span."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:-1] > 0)])
    return inside[first[1:]] - inside[first[:-1]]


_OUT = "n_words long, n_hit long, items array<string>"


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items) for every row of docs.

    n_words counts the document's words, n_hit those inside any occurrence of a window of an item, items lists
    the ids (as strings, ascending, distinct) of items with an occurring window. Null texts have no words; an
    item without words never occurs; a null item id counts hits but is not listed. Repeated rows each give a
    row. An empty benchmark hits nothing. Other columns are ignored.
    """
    rows = bounded_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    if _is_small(items, broadcast_words):
        out = _scanned(rows, items)
    else:
        out = _joined(rows, items).drop("text_hash")
    return out.withColumnRenamed("id", id_col)


def _is_small(items: DataFrame, broadcast_words: int) -> bool:
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    return size // 2 <= broadcast_words  # a word takes two bytes at least, with what parts it from the next


def _shared_index(items: DataFrame):
    """The index of a small benchmark, broadcast."""
    listed = items.toArrow()
    return items.sparkSession.sparkContext.broadcast(build_index(listed.column("id").to_pylist(), listed.column("text").combine_chunks()))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, of which less than a twentieth of the words is hit (or no word).

    Each row is judged by its own text, whether or not it has an id or shares it with other rows.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    if not _is_small(items, broadcast_words):
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        bad = _joined(rows, items).where(_contaminated()).select(F.col("id").alias("k"), F.col("text_hash").alias("h")).distinct()
        k, h = free_name(docs, "k"), free_name(docs, "h")
        bad = bad.withColumnsRenamed({"k": k, "h": h}).hint("merge")
        return docs.join(bad, F.col(id_col).eqNullSafe(F.col(k)) & F.xxhash64(text_col).eqNullSafe(F.col(h)), "left_anti")
    shared = _shared_index(items)
    at = docs.columns.index(text_col)
    # Columns go over under names of their own, so none of docs can clash.
    rows = bounded_batches(docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(at)):
                w = words(b.column(at)[lo:hi], ALNUM)
                start, end, _ = hits(w, shared.value)
                n_hit = _covered(w.first, len(w.hash), start, end)
                yield b.slice(lo, hi - lo).filter(pa.array((n_hit == 0) | (20 * n_hit < w.counts)))

    return rows.mapInArrow(tidy(keep), rows.schema).select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def _scanned(rows: DataFrame, items: DataFrame) -> DataFrame:
    shared = _shared_index(items)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                w = words(b.column(1)[lo:hi], ALNUM)
                start, end, item = hits(w, ix)
                n_hit = _covered(w.first, len(w.hash), start, end)
                named: list[list[str]] = [[] for _ in range(hi - lo)]
                doc = np.searchsorted(w.first, start, "right") - 1
                for d, i in np.unique(np.stack([doc, item], axis=1), axis=0).tolist():
                    if ix.ids[i] is not None:
                        named[d].append(ix.ids[i])
                yield pa.record_batch([b.column(0)[lo:hi], pa.array(w.counts, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(set(x)) for x in named], pa.list_(pa.string()))], names=["id", "n_words", "n_hit", "items"])

    return rows.mapInArrow(tidy(scan), f"id {rows.schema['id'].dataType.simpleString()}, {_OUT}")


def _joined(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The same by a shuffle join of fingerprints; `size` is 0 for winnowed ones, else the words of a short item."""
    kind = rows.schema["id"].dataType.simpleString()
    count = items.mapInArrow(tidy(_word_counts), "n int").where(f"n between 1 and {WINDOW - 1}").distinct()
    sizes = sorted(r["n"] for r in count.collect())  # WINDOW - 1 values at most

    def prints(short: list[int] | None):
        """Fingerprint rows of texts; short: also all n-grams of these sizes, or (None) whole texts below a window."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi in chunks(b.column(1)):
                    w = words(b.column(1)[lo:hi], ALNUM)
                    at, h = fingerprints(w)
                    parts = [(at, h, context(w, at), np.zeros(len(at), np.int32))]
                    for n in range(1, WINDOW) if short is None else short:
                        p, g = ngrams(w, n)
                        if short is None:
                            whole = np.isin(p, w.first[:-1][w.counts == n])
                            p, g = p[whole], g[whole]
                        parts.append((p, g, np.zeros((len(p), 0), np.uint64), np.full(len(p), n, np.int32)))
                    for p, h, around, n in parts:
                        text = np.searchsorted(w.first, p, "right") - 1
                        flat = pa.array(around.astype(np.int64).ravel())
                        ends = np.arange(len(p) + 1, dtype=np.int32) * around.shape[1]
                        yield pa.record_batch([b.column(0)[lo:hi].take(pa.array(text)), b.column(2)[lo:hi].take(pa.array(text)), pa.array(p - w.first[text], pa.int64()), pa.array(h.astype(np.int64)), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["id", "text_hash", "pos", "print", "size", "around"])

        return run

    hashed = rows.select("id", "text", F.xxhash64("text").alias("text_hash"))
    fields = "text_hash long, pos long, print long, size int, around array<long>"
    mine = hashed.mapInArrow(tidy(prints(sizes)), f"id {kind}, {fields}")
    theirs = items.select("id", "text", F.lit(0).cast("long").alias("text_hash")).mapInArrow(tidy(prints(None)), f"id string, {fields}")
    # What comes out of mapInArrow is estimated by what goes in, so the join says not to broadcast.
    pairs = mine.alias("d").join(theirs.alias("b").hint("merge"), ["print", "size"]).select("d.id", "d.text_hash", "d.pos", "size", F.col("d.around").alias("around"), F.col("b.around").alias("other"), F.col("b.id").alias("item"))

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column("size").to_numpy()
            pos = b.column("pos").to_numpy()
            start, end, ok = pos.copy(), pos + size, size > 0
            won = np.flatnonzero(size == 0)
            if len(won):
                pick = pa.array(won)
                x, y = (np.asarray(b.column(c).take(pick).flatten()).reshape(len(won), len(OFFSETS)) for c in ("around", "other"))
                left, right, full = extend((x == y) & (x != 0))
                start[won], end[won], ok[won] = pos[won] - left, pos[won] + K + right, full
            keep = pa.array(ok)
            yield pa.record_batch([b.column("id"), b.column("text_hash"), pa.array(start), pa.array(end), b.column("item")], names=["id", "text_hash", "start", "end", "item"]).filter(keep)

    spans = pairs.mapInArrow(tidy(extended), f"id {kind}, text_hash long, start long, end long, item string")
    step = F.aggregate(
        F.array_sort(F.col("spans")),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")),
        lambda a: a["n"],
    )
    found = spans.groupBy("id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.array_sort(F.collect_set("item")).alias("items")).select(F.col("id").alias("k"), F.col("text_hash").alias("h"), step.alias("n_hit"), "items")
    counted = hashed.mapInArrow(tidy(_counted), f"id {kind}, text_hash long, n_words long")
    return counted.join(found.hint("merge"), F.col("id").eqNullSafe(F.col("k")) & F.col("text_hash").eqNullSafe(F.col("h")), "left").select("id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in chunks(b.column(1)):
            yield pa.record_batch([pa.array(words(b.column(1)[lo:hi], ALNUM).counts, pa.int32())], names=["n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in chunks(b.column(1)):
            yield pa.record_batch([b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array(words(b.column(1)[lo:hi], ALNUM).counts, pa.int64())], names=["id", "text_hash", "n_words"])


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """:func:`contamination` with the items as a digest and the verdict: a twentieth of the words or more are hit."""
    return contamination(docs, benchmark, **how).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        _contaminated().alias("contaminated"),
    )
