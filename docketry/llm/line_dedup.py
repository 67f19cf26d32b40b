"""Fuzzy line dedup by MinHash: signatures of character shingles, banding, exact verification, components.

A line's shingles are its distinct runs of K characters. Its signature has BANDS * ROWS minima, each of another
permutation of the shingles' hashes, and every ROWS of them make a band's key: lines of similarity 0.8 share one of
the eight keys with a probability of 0.997. A signature does not depend on how often a shingle repeats, nor on
how long the line is, so all lines are sketched alike, from all their shingles.

Lines that share a key are candidates of the key's first line and of the one before them. Candidates are verified
by the exact Jaccard similarity of their shingles. Where that leaves the lines of a key in several components, all
lines of the key are compared across components, exactly: by the task that holds the key's lines, which returns only
the links that join components; or, for keys of more than GROUP_LINES lines, by an inverted index of the shingles that
come first when rare ones do (prefix filter). So any two similar lines that share a key are in one component; of each
component one line stays: the first of all documents.

Keys are dealt by ranges of (key, line), so a key of any number of lines spreads over as many tasks as it needs; a key
that lies on an edge counts as one whose lines were not all compared. How rows are dealt therefore decides what is
compared first, never which lines end up together.

Signatures, verification and prefixes run over Arrow batches in NumPy; a form in SQL functions took more than twice
the CPU time that the check tool allows (README). Everything between them is declared with DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm import line_native
from docketry.llm.components import connected_components
from docketry.llm.ngram_join import linked
from docketry.llm.shared import bounded_batches, stored
from docketry.llm.textbytes import buffers, chunks, mix, range_hashes

K = 8
BANDS, ROWS = 8, 3
PERCENT = 80
#: Characters that are hashed at once, so that arrays stay in a core's cache.
BLOCK_CHARS = 1 << 16
#: Lines whose keys a task remembers having given.
SEEN = 400_000
#: Buckets in which shingles are counted to put rare ones first.
BUCKETS = 1 << 16
#: A line's place is its document's id times this, plus its number.
PLACES = 1_000_000_000
#: Lines and characters of a key's group that one task compares; larger ones go by the prefix filter.
GROUP_LINES, GROUP_CHARS = 2048, 1 << 21
#: Groups of so many lines are compared pair by pair, larger ones by a token-group matrix.
FEW_LINES = 24
#: Lines, pairs of lines and about so many shingles that are compared at once; a number below AT_ONCE and 48 bits of a
#: hash share a word.
AT_ONCE, CHARS_AT_ONCE = 1 << 14, 1 << 21

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_PERMUTE = (mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _ODD[0]) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and how many of them start before each byte (and before the end)."""
    if not len(raw) or raw.max() < 0x80:
        return raw.astype(np.uint32), np.arange(len(raw) + 1)
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw & 0xC0 != 0x80, out=before[1:])
    return np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4"), before


def window_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of K characters; three code points of 21 bits are a word."""
    n = len(codes) - K + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64)
    three = c[:-2] | c[1:-1] << np.uint64(21) | c[2:] << np.uint64(42)
    h = three[:n] * _ODD[0]
    h ^= h >> np.uint64(32)
    h ^= three[3 : n + 3]
    h *= _ODD[1]
    h ^= h >> np.uint64(29)
    h ^= c[6 : n + 6] | c[7 : n + 7] << np.uint64(21)
    h *= _ODD[2]
    h ^= h >> np.uint64(32)
    return h


def split_lines(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number, first byte, end) of the lines that are not blank."""
    feeds = np.flatnonzero(raw == 0x0A)
    where = np.searchsorted(feeds, at[1:], "left")
    end = np.insert(feeds, where, at[1:])
    last = np.zeros(len(end), bool)
    last[where + np.arange(len(where))] = True
    text = np.cumsum(last) - last
    opens = np.append(True, last[:-1])[: len(end)]
    start = np.append(0, end[:-1] + 1)[: len(end)]
    start[opens] = at[:-1]
    number = np.arange(len(end)) - np.flatnonzero(opens)[text]
    full = np.append(0, np.cumsum(~_BLANK[raw]))
    keep = full[end] > full[start]
    return text[keep], number[keep], start[keep], end[keep]


def band_keys(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Keys (a row of BANDS for each line) of lines of K characters or more, as ranges in ascending order."""
    out = np.zeros((len(start), BANDS), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + BLOCK_CHARS, "right")))
        base = start[lo]
        h = window_hashes(codes[base : end[hi - 1]])
        low, high = h.astype(np.uint32), (h >> np.uint64(32)).astype(np.uint32)
        edges = np.empty(2 * (hi - lo), np.int64)
        edges[::2], edges[1::2] = start[lo:hi] - base, end[lo:hi] - base - K + 1
        edges = edges[:-1]  # between two lines' shingles lie those across their border
        least = [np.minimum.reduceat((low if k % 2 else high) * p, edges)[::2].astype(np.uint64) for k, p in enumerate(_PERMUTE)]
        for b in range(BANDS):
            x, y, z = least[ROWS * b : ROWS * (b + 1)]
            out[lo:hi, b] = mix(mix(x << np.uint64(32) | y) + (z << np.uint64(8) | np.uint64(b)) * _ODD[0])
        lo = hi
    return out


def described_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, number, node, keys): every line that is not blank, with its 64-bit hash as node; a task gives the keys
    of equal lines once, and lines of fewer than K characters have none."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                raw, at = buffers(batch.column(1)[lo:hi])
                text, number, start, end = split_lines(raw, at)
                node = range_hashes(raw, start, end).view(np.int64)
                codes, before = code_points(raw)
                first, last = before[start], before[end]
                fresh = np.zeros(len(node), bool)
                for i in np.flatnonzero(last - first >= K).tolist():
                    if (x := node[i].item()) not in seen:
                        seen.add(x)
                        fresh[i] = True
                if len(seen) > SEEN:
                    seen.clear()
                keys = band_keys(codes, first[fresh], last[fresh])
                ends = np.append(0, np.cumsum(fresh) * BANDS).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()))
                ids = batch.column(0)[lo:hi].take(pa.array(text))
                yield pa.record_batch([ids, pa.array(number.astype(np.int32)), pa.array(node), lists], names=["id", "number", "node", "keys"])

    rows = bounded_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null"))
    return rows.mapInArrow(describe, "id long, number int, node long, keys array<long>")


# What candidates() writes: pairs (a, b), lines (key, node) of keys whose lines were not all compared, and a
# partition's first line (key, node) of a key that may go on in another partition.
_PAIR, _CROWDED, _EDGE = 0, 1, 2


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates from rows in order of (key, node): each line with its key's first and with the one before it.

    Keys of more than three lines, and those on the edge of a batch or of the partition, may hold lines that
    were not compared.
    """
    key = lead = last = None
    edge: tuple[int, int] | None = None  # the last key so far, and its first node here
    for batch in batches:
        k, v = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if len(k):
            again = np.append((k[0], v[0]) == (key, last), (k[1:] == k[:-1]) & (v[1:] == v[:-1]))
            k, v = k[~again], v[~again]
        if not len(k):
            continue
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        size = np.diff(np.append(starts, len(k)))
        run = np.repeat(np.arange(len(starts)), size)
        goes_on = k[0] == key
        leads, before = v[starts].copy(), np.append(v[0], v[:-1])
        before[starts] = v[starts]
        if goes_on:
            leads[0], before[0] = lead, last
        a, b = np.concatenate([v, v]), np.concatenate([leads[run], before])
        pairs = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
        crowded = size > 3
        crowded[[0, -1]] = True
        own = crowded[run]
        edges = [] if key is not None else [(k[0], v[0])]
        kinds = np.repeat([_PAIR, _CROWDED, _EDGE], [len(pairs), own.sum(), len(edges)]).astype(np.int32)
        x = np.concatenate([pairs[:, 0], k[own], np.array([e[0] for e in edges], np.int64)])
        y = np.concatenate([pairs[:, 1], v[own], np.array([e[1] for e in edges], np.int64)])
        key, lead, last = k[-1].item(), leads[-1].item(), v[-1].item()
        edge = (key, lead)
        yield pa.record_batch([pa.array(kinds), pa.array(x), pa.array(y)], names=["kind", "x", "y"])
    if edge:
        yield pa.record_batch([pa.array([_EDGE], pa.int32()), pa.array([edge[0]], pa.int64()), pa.array([edge[1]], pa.int64())], names=["kind", "x", "y"])


def candidates(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (a, b) of lines to compare, and (key, node) of keys that may hold lines that were not compared."""
    keyed = lines.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "node")
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stored(keyed.repartitionByRange(n, "key", "node").sortWithinPartitions("key", "node").mapInArrow(_neighbours, "kind int, x long, y long"), "line-candidates")
    pairs = found.where(F.col("kind") == _PAIR).select(F.col("x").alias("a"), F.col("y").alias("b"))
    # Two rows for each partition at most: the parts of a key that spreads over partitions.
    edges = found.where(F.col("kind") == _EDGE).select(F.col("x").alias("key"), F.col("y").alias("a")).distinct()
    across = edges.join(edges.groupBy("key").agg(F.min("a").alias("b")), "key").where("a <> b").select("a", "b")
    return pairs.unionByName(across).distinct(), found.where(F.col("kind") == _CROWDED).select(F.col("x").alias("key"), F.col("y").alias("node"))


def unlinked(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root) of the crowded keys that hold lines of several roots; of keys with equal lines, one."""
    known = crowded.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    same = F.sum(F.xxhash64("node").cast("decimal(20,0)"))
    open_ = known.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"), same.alias("s")).where("x <> y")
    return known.join(open_.dropDuplicates(["n", "s"]).select("key").hint("merge"), "key").select("key", "node", "root")


def line_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, line) of the wanted (id, number, node): documents are shuffled whole, and cut where they arrive."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    places = wanted.groupBy("id").agg(F.collect_list("number").alias("numbers"), F.collect_list("node").alias("nodes"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                texts, numbers, nodes = (c[lo:hi] for c in batch.columns)
                raw, at = buffers(texts)
                text, number, start, end = split_lines(raw, at)
                of = np.repeat(np.arange(hi - lo), np.asarray(numbers.value_lengths()))
                asked = of << 32 | np.asarray(numbers.flatten())
                have = text << 32 | number
                i = np.minimum(np.searchsorted(have, asked), max(len(have) - 1, 0))
                node = np.asarray(nodes.flatten())
                ok = np.zeros(len(asked), bool)
                if len(have):
                    ok = have[i] == asked
                    ok &= range_hashes(raw, start[i], end[i]).view(np.int64) == node  # a repeated id may have other texts
                data = raw.tobytes()
                lines = [data[a:b].decode() for a, b in zip(start[i[ok]].tolist(), end[i[ok]].tolist(), strict=True)] if len(have) else []
                yield pa.record_batch([pa.array(node[ok]), pa.array(lines, pa.string())], names=["node", "line"])

    joined = rows.join(places.hint("merge"), "id").select("text", "numbers", "nodes")
    return bounded_batches(joined).mapInArrow(cut, "node long, line string").dropDuplicates(["node"])


def shingles(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of K characters on end, how many each line has)."""
    raw, at = buffers(lines)
    codes, before = code_points(raw)
    start, end = before[at[:-1]], before[at[1:]]
    n = np.maximum(end - start - K + 1, 0)
    h = window_hashes(codes)
    return h[np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())], n


@dataclass
class Sets:
    """Distinct shingles of lines, ascending, as 48-bit hashes; those of line i are flat[first[i] : first[i + 1]]."""

    flat: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, lines: pa.Array) -> Sets:
        flat, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for lo in range(0, len(lines), AT_ONCE):
            h, n = shingles(lines[lo : lo + AT_ONCE])
            x = np.repeat(np.arange(len(n), dtype=np.uint64) << np.uint64(48), n) | h >> np.uint64(16)
            x.sort()
            x = x[np.append(True, x[1:] != x[:-1])[: len(x)]]
            size.append(np.bincount((x >> np.uint64(48)).astype(np.int64), minlength=len(n)))
            flat.append(x & np.uint64((1 << 48) - 1))
        return cls(np.concatenate(flat), np.append(0, np.cumsum(np.concatenate(size))))

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.first)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.first[i] : self.first[i + 1]]

    def common(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many shingles the lines left[i] and right[i] share."""
        which = np.stack([left, right], axis=1).ravel()
        n = self.size[which]
        at = np.repeat(self.first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.repeat(np.arange(len(which), dtype=np.uint64) >> np.uint64(1) << np.uint64(48), n) | self.flat[at]
        both.sort()
        return np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(48)).astype(np.int64), minlength=len(left))


def similar(sets: Sets, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Whether the lines of each pair (left[i], right[i]) have a Jaccard similarity of percent or more."""
    x, y = sets.size[left], sets.size[right]
    out = (np.minimum(x, y) > 0) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
    rest = np.flatnonzero(out)
    loads = np.cumsum((x + y)[rest])
    cuts = np.searchsorted(loads, np.arange(CHARS_AT_ONCE, loads[-1] if len(loads) else 0, CHARS_AT_ONCE))
    for some in np.split(rest, cuts):
        for part in np.split(some, range(AT_ONCE, len(some), AT_ONCE)):
            common = sets.common(left[part], right[part])
            out[part] = 100 * common >= percent * ((x + y)[part] - common)
    return out


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose lines have a Jaccard similarity of percent or more; texts: node, line."""
    left = texts.select(F.col("node").alias("a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("node").alias("b"), F.col("line").alias("line_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "line_a", "line_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            _, at, which = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
            lines = pa.concat_arrays([batch.column(2), batch.column(3)]).take(pa.array(at))  # a line of several pairs is hashed once
            ok = similar(Sets.of(lines), which[: len(a)], which[len(a) :], percent)
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok))

    return bounded_batches(both).mapInArrow(compare, "a long, b long")


def links_of_groups(group: np.ndarray, root: np.ndarray, lines: pa.Array, percent: int) -> np.ndarray:
    """Distinct (a, b) of roots with similar lines in a group; rows of a group stand together."""
    sets = Sets.of(lines)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(starts, len(group)))
    links = [np.zeros((0, 2), np.int64)]
    for lo, n in zip(starts[size > FEW_LINES].tolist(), size[size > FEW_LINES].tolist(), strict=True):
        found = np.array(linked([sets[i] for i in range(lo, lo + n)], percent), np.int64).reshape(-1, 2)
        links.append(root[lo + found])
    few = np.where(size <= FEW_LINES, size, 0)
    later = np.arange(len(group)) - np.repeat(starts, size)  # rows of the group before this one
    later[np.repeat(few, size) == 0] = 0
    right = np.repeat(np.arange(len(group)), later)
    left = right - np.arange(len(right)) + np.repeat(np.cumsum(later) - later, later) - 1
    other = root[left] != root[right]
    left, right = left[other], right[other]
    ok = similar(sets, left, right, percent)
    links.append(np.stack([root[left[ok]], root[right[ok]]], axis=1))
    both = np.concatenate(links)
    both = np.unique(np.sort(both, axis=1), axis=0)
    return both[both[:, 0] != both[:, 1]]


def group_links(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the roots of similar lines of a group; groups: key, root, line."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            found = links_of_groups(np.asarray(t.column(0)), np.asarray(t.column(1)), t.column(2).combine_chunks(), percent)
            return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        for batch in batches:
            k = np.asarray(batch.column(0))
            if not len(k):
                continue
            cut = int(np.flatnonzero(np.append(True, k[1:] != k[:-1]))[-1])  # the last group may go on
            if cut or (held and held[-1].column(0)[0].as_py() != k[0]):
                if held and k[0] != held[-1].column(0)[0].as_py():
                    yield links(held)
                    held = []
                if cut:
                    yield links([*held, batch.slice(0, cut)])
                    held = []
            held.append(batch.slice(cut))
        if held:
            yield links(held)

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = groups.select("key", "root", "line").repartition(n, "key").sortWithinPartitions("key")
    return bounded_batches(rows).mapInArrow(compare, "a long, b long")


def prefix_pairs(rooted: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) of lines of different roots, with all those whose similarity is percent or more; rooted: node, root.

    In any one order of all shingles, two such lines share one of the first n - ceil(n * percent / 100) + 1 of
    their n shingles. The order puts first what few lines have, by counts in BUCKETS buckets: a template that
    many lines hold comes last, so lines meet by what is their own.
    """
    lines = bounded_batches(rooted.join(texts.hint("merge"), "node").select("node", "root", "line"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            n += np.bincount((shingles(batch.column(2))[0] % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        yield pa.record_batch([pa.array(np.flatnonzero(n).astype(np.int32)), pa.array(n[n > 0])], names=["i", "n"])

    counts = lines.mapInArrow(count, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    total = np.zeros(BUCKETS, np.int64)
    total[np.asarray(counts.column("i"))] = np.asarray(counts.column("n"))
    rank = np.empty(BUCKETS, np.uint64)
    rank[np.argsort(total, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    rank_table = rank.astype(np.uint16)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = shingles(batch.column(2))
            of = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((h, rank_table[(h % np.uint64(BUCKETS)).astype(np.int64)], of))
            h, of = h[order], of[order]
            new = np.append(True, (h[1:] != h[:-1]) | (of[1:] != of[:-1]))[: len(h)]
            h, of = h[new], of[new]
            size = np.bincount(of, minlength=len(n))
            at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            keep = at < (size + (-size * percent) // 100 + 1)[of]
            pick = pa.array(of[keep])
            columns = [batch.column(0).take(pick), batch.column(1).take(pick), pa.array(size[of[keep]].astype(np.int32)), pa.array(at[keep].astype(np.int32)), pa.array(h[keep].view(np.int64))]
            yield pa.record_batch(columns, names=["node", "root", "n", "i", "t"])

    firsts = stored(lines.mapInArrow(first, "node long, root long, n int, i int, t long"), "line-prefixes")
    shared = firsts.groupBy("t").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("t")
    met = stored(firsts.join(shared.hint("merge"), "t"), "shared-prefixes")
    l, r = met.alias("l"), met.alias("r")
    # What follows the shared shingle bounds the overlap.
    enough = (100 + percent) * F.least(F.col("l.n") - F.col("l.i"), F.col("r.n") - F.col("r.i")) >= percent * (F.col("l.n") + F.col("r.n"))
    return l.join(r.hint("merge"), (F.col("l.t") == F.col("r.t")) & (F.col("l.root") < F.col("r.root")) & enough).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def more_links(open_lines: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b) of roots that have similar lines in a key; open_lines: key, node, root, line."""
    large = stored(open_lines.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.char_length("line")).alias("chars")).where((F.col("n") > GROUP_LINES) | (F.col("chars") > GROUP_CHARS)).select("key"), "large-keys")
    if large.isEmpty():
        return stored(group_links(open_lines, percent), "group-links")
    links = group_links(open_lines.join(large.hint("merge"), "key", "left_anti"), percent)
    rooted = open_lines.join(large.hint("merge"), "key", "left_semi").select("node", "root").distinct()
    root = rooted.select("node", "root")
    near = verified(stored(prefix_pairs(rooted, texts, percent), "prefix-pairs"), texts, percent)
    near = near.join(root.withColumnsRenamed({"node": "a", "root": "x"}).hint("merge"), "a").join(root.withColumnsRenamed({"node": "b", "root": "y"}).hint("merge"), "b")
    return stored(links.unionByName(near.select(F.col("x").alias("a"), F.col("y").alias("b"))), "group-links")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, native: bool = False) -> DataFrame:
    """(id, number) of every line to drop: of each component of similar lines, all but the first place.

    native: in DataFrame functions only (line_native), for more than twice the time; otherwise by Arrow batches in Python tasks.
    """
    if native:
        return line_native.dropped_lines(docs, id_col, text_col, percent, GROUP_LINES)
    lines = stored(described_lines(docs, id_col, text_col), "lines")
    place = (F.col("id").cast("decimal(38,0)") * PLACES + F.col("number")).cast("decimal(38,0)")
    places = lines.select("id", "number", place.alias("place"), "node")
    first = stored(places.groupBy("node").agg(F.min("place").alias("place"), F.count("*").alias("n")), "line-nodes")
    pairs, crowded = candidates(lines)
    pairs = stored(pairs, "line-pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    id_of = F.floor(F.col("place") / PLACES).cast("decimal(38,0)")
    wanted = first.join(nodes.hint("merge"), "node").select(id_of.cast("long").alias("id"), (F.col("place") - id_of * PLACES).cast("int").alias("number"), "node")
    texts = stored(line_texts(docs, wanted, id_col, text_col), "line-texts")
    roots = stored(connected_components(verified(pairs, texts, percent)), "line-roots")
    more = more_links(stored(unlinked(crowded, roots).join(texts.hint("merge"), "node"), "open-lines"), texts, percent)
    if not more.isEmpty():
        later = connected_components(more).select(F.col("node").alias("root"), F.col("root").alias("last"))
        alone = later.join(roots.hint("merge"), "root", "left_anti").select(F.col("root").alias("node"), "root")
        roots = roots.unionByName(alone).join(later.hint("merge"), "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    # Lines without a link that stand in one place only stay as they are.
    of_node = first.join(roots.hint("merge"), "node", "left").where("n > 1 or root is not null").withColumn("root", F.coalesce("root", "node"))
    of_root = of_node.groupBy("root").agg(F.min("place").alias("kept"))
    decided = of_node.join(of_root.hint("merge"), "root").select("node", "kept")
    return places.join(decided.hint("merge"), "node").where("place <> kept").select("id", "number")


def line_count(text: Column) -> Column:
    """Lines of a text: one more than its line feeds; none if it is null."""
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return F.coalesce(feeds + 1, F.lit(0)).cast("long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, native: bool = False) -> DataFrame:
    """(id, n_lines, n_dropped, dropped, text) for every row of docs; dropped: line numbers (from 0) in order.

    Of lines that are equal or similar (Jaccard of K-character shingles of percent or more, found by MinHash,
    directly or through others) the first by document id and line number stays. Blank lines always stay and
    count as lines; lines of fewer than K characters are dropped only if equal. A null text has no lines and
    stays null. Rows with a null id keep all lines. Rows that repeat an id count as one document: equal lines
    at equal places of them count once. Ids are integers (or text of integers). Other columns are ignored.
    """
    gone = dropped_lines(docs, id_col, text_col, percent, native).groupBy("id").agg(F.array_sort(F.collect_set("number")).alias("dropped"))
    rows = docs.select(F.col(id_col).alias("own"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    j = rows.join(gone.hint("merge"), "id", "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("dropped", i)), "\n")
    return j.select(F.col("own").alias(id_col), line_count(F.col("text")).alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"), "dropped", kept.alias("text"))


def line_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: lines, dropped lines and their numbers, without the text."""
    gone = dropped_lines(docs, **how).groupBy("id").agg(F.array_sort(F.collect_set("number")).alias("dropped"))
    rows = docs.select("doc_id", F.col("doc_id").cast("long").alias("id"), line_count(F.col("text")).alias("n_lines"))
    j = rows.join(gone.hint("merge"), "id", "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    return j.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"))
