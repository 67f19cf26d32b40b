"""N-gram Jaccard self-join of whole documents, exact, by a token-group matrix.

A document's tokens are the 64-bit hashes of its distinct word n-grams; equal sets are one node.

Groups of similar documents. Two sets of sizes x and y with a Jaccard similarity of t or more differ in at most
(x + y)(1 - t)/(1 + t) tokens. Tokens are dealt to D + 1 + m parts by hash, where D is the most tokens in which
such sets of a size class can differ: then at least 1 + m parts are equal. The hash of each part is a key.
(Parts of fewer than LEAST_PART tokens, which unrelated sets may share, give no key while a set has at most m
of them.) Below a similarity of 0.9 such parts get so small that texts which share a passage share keys; `equal_parts`
then makes fewer and larger parts, of which so many are equal on average where the most tokens differ, so that a link at
the threshold is missed with a probability of exp(-equal_parts) at the worst. Sets also emit keys of the next lower class if a partner may be there. Sets that share keys, directly
or by others, form a cluster, so all links run within clusters, and clusters of unrelated texts are rare.

Token-group matrix. Sets are put into groups by similarity (size and least token), and the matrix records which
tokens occur in each group's union. A query's overlap with a group's union bounds its overlap with every member;
only groups whose bound reaches what the sizes demand are opened, and their members are verified exactly.
A cluster of one block is compared by one task. Blocks of larger clusters are written once to the shared folder, and
pairs of sides (some blocks) are compared by tasks that read just these: first each side with itself and with the
cluster's first, then those pairs only whose sets are not all in one component by then. In a cluster of near copies
that leaves few, so work grows with its size; a cluster of sets that share keys but no links takes all pairs. Tasks
return spanning forests of the links they verified, never a row per pair; components of all forests are the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.components import connected_components
from docketry.llm.shared import bounded_batches, open_filesystem, scratch_path, stored, tidy
from docketry.llm.textbytes import NOT_WHITE, chunks, mix, ngrams, words

N_WORDS = 3
PERCENT = 90
#: Lower over upper end of a size class.
CLASS_RATIO = 0.7
LEAST_PART = 3
#: Sets in a block of a large cluster, and in a group of the matrix.
BLOCK = 128
GROUP = 16
#: Blocks on each side of a comparison between blocks.
SIDE_BLOCKS = 4
#: Clusters of one block at least that are told apart by a broadcast.
MOST_LARGE = 10_000
#: Tokens of queries that are compared with a group at once.
QUERY_TOKENS = 200_000

_U64 = np.uint64


def token_sets(texts: pa.Array, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct tokens of all texts on end, first token of each text): n-grams, or the whole of a shorter text."""
    w = words(texts, NOT_WHITE)
    at, h = ngrams(w, n_words)
    text = np.searchsorted(w.first, at, "right") - 1
    counts = w.counts
    for n in range(1, n_words):
        p, g = ngrams(w, n)
        whole = np.isin(p, w.first[:-1][counts == n])
        text = np.concatenate([text, np.searchsorted(w.first, p[whole], "right") - 1])
        h = np.concatenate([h, mix(g[whole] + _U64(n))])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(texts) + 1))


def size_classes(most: int, percent: int, equal_parts: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least size, parts, slack m) of each class up to size `most`; no parts where only equal sets can link.

    With equal_parts there are fewer and larger parts: as few as leave so many equal on average, when the most tokens
    that may differ are dealt at random.
    """
    low, parts, slack = [], [], []
    lo = 1
    while not low or low[-1] <= most:
        hi = max(lo, int(lo / CLASS_RATIO))
        d = hi * (100 - percent) // percent
        m = d // 8
        n = d + 1 + m if d else 0
        if equal_parts and n:
            fewer = np.arange(1, n + 1)
            n = int(np.argmax(np.append(fewer * np.exp(-d / fewer) >= equal_parts, True))) + 1
            n, m = min(n, d + 1 + m), min(m, n // 8)
        low.append(lo)
        parts.append(n)
        slack.append(m)
        lo = hi + 1
    return np.array(low), np.array(parts), np.array(slack)


def part_keys(tokens: np.ndarray, first: np.ndarray, percent: int, equal_parts: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of all keys of all sets, in order of the sets."""
    sizes = np.diff(first)
    low, parts, slack = size_classes(int(sizes.max()) if len(sizes) else 1, percent, equal_parts)
    own = np.searchsorted(low, sizes, "right") - 1
    down = (own > 0) & (sizes * percent < low[np.maximum(own, 0)] * 100)  # a set of percent % of the size is in the class below
    which = np.concatenate([np.flatnonzero(sizes > 0), np.flatnonzero(down & (sizes > 0))])
    tag = np.concatenate([own[sizes > 0], own[down & (sizes > 0)] - 1])
    used = parts[tag] > 0
    which, tag = which[used], tag[used]
    if not len(which):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n, k = sizes[which], parts[tag]
    at = np.repeat(first[:-1][which] - np.cumsum(n) + n, n) + np.arange(n.sum())
    t = tokens[at]
    part = ((t >> _U64(32)) * np.repeat(k, n).astype(np.uint64) >> _U64(32)).astype(np.int64) + np.repeat(np.cumsum(k) - k, n)
    total = int(k.sum())
    count = np.bincount(part, minlength=total)
    filled = np.flatnonzero(count)
    sums = np.zeros(total, np.uint64)
    sums[filled] = np.add.reduceat(mix(t ^ _U64(0x5DEECE66D)), np.searchsorted(part, filled))
    row = np.repeat(np.arange(len(which)), k)
    number = np.arange(total) - np.repeat(np.cumsum(k) - k, k)
    key = mix(sums + mix(((tag[row] << 40) + number).astype(np.uint64) * _U64(0x9E3779B97F4A7C15)) + count.astype(np.uint64))
    thin = count < LEAST_PART
    keep = ~thin | (np.bincount(row, thin) > slack[tag])[row]
    owner, key = which[row[keep]], key[keep]
    order = np.argsort(owner, kind="stable")  # keys of the class below came after all others
    return owner[order], key[order]


def digests(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set."""
    sums = np.append(_U64(0), np.cumsum(mix(tokens + _U64(0x1234567))))
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64) * _U64(0x9E3779B97F4A7C15))


def _grouped(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), pa.array(values.view(np.int64)))


class Forest:
    """Union-find over indices; `edges` are the links that joined two trees."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def join(self, i: int, j: int) -> None:
        x, y = self.find(i), self.find(j)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((i, j))


def linked(tokens: list[np.ndarray], percent: int, split: int = 0) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; with a split, of those between the first `split` sets and the rest."""
    sizes = np.array([len(t) for t in tokens])
    # Members are grouped in order of size; tokens ascend, so the first of a set is its min-hash.
    order = np.lexsort((np.array([t[0] for t in tokens]), sizes, np.arange(len(tokens)) >= split))
    sizes = sizes[order]
    flat = np.concatenate([tokens[i] for i in order])
    first = np.append(0, np.cumsum(sizes))
    names, column = np.unique(flat, return_inverse=True)
    forest = Forest(len(sizes))
    for lo in range(split, len(sizes), GROUP):
        hi = min(lo + GROUP, len(sizes))
        upto = split or hi  # queries: the other side, or the members and all sets before them
        near = np.flatnonzero((100 * sizes[:upto] >= percent * sizes[lo]) & (100 * sizes[hi - 1] >= percent * sizes[:upto]))
        near = near[100 * np.minimum(sizes[near], sizes[hi - 1]) >= percent * np.maximum(sizes[near], sizes[lo])]
        if not len(near):
            continue
        # The group's row of the token-group matrix: a column for each token of its union.
        union = np.unique(column[first[lo] : first[hi]])
        place = np.full(len(names), len(union))
        place[union] = np.arange(len(union))

        def tokens_of(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            n = sizes[which]
            start = np.cumsum(n) - n
            return place[column[np.repeat(first[which] - start, n) + np.arange(n.sum())]], start

        members = np.zeros((hi - lo, len(union) + 1), np.float32)
        members[np.repeat(np.arange(hi - lo), sizes[lo:hi]), place[column[first[lo] : first[hi]]]] = 1
        loads = np.cumsum(sizes[near])
        for some in np.split(near, np.searchsorted(loads, np.arange(QUERY_TOKENS, loads[-1], QUERY_TOKENS))):
            if not len(some):
                continue
            at, start = tokens_of(some)
            overlap = np.add.reduceat((at < len(union)).astype(np.int64), start)
            demand = -(-percent * (sizes[some] + np.maximum(sizes[lo], -(-percent * sizes[some] // 100))) // (100 + percent))
            opened = some[overlap >= demand]
            if not len(opened):
                continue
            at, start = tokens_of(opened)
            common = np.add.reduceat(members[:, at], start, axis=1).astype(np.int64).T
            either = sizes[opened][:, None] + sizes[lo:hi] - common
            ok = (100 * common >= percent * either) & (opened[:, None] < np.arange(lo, hi))
            q, m = np.nonzero(ok)
            for i, j in zip(opened[q].tolist(), (m + lo).tolist(), strict=True):
                forest.join(i, j)
    return [(int(order[i]), int(order[j])) for i, j in forest.edges]


def _packed(ids: list[int], sets: list[np.ndarray]) -> bytes:
    """A block of sets as bytes: count, ids, sizes, tokens."""
    return b"".join([np.array([len(ids), *ids, *map(len, sets)], "<i8").tobytes(), *(x.astype("<u8").tobytes() for x in sets)])


def _unpacked(data: bytes) -> tuple[list[int], list[np.ndarray]]:
    head = np.frombuffer(data, "<i8")
    n = int(head[0])
    cuts = np.append(0, np.cumsum(head[n + 1 : 2 * n + 1])).tolist()
    tokens = head[2 * n + 1 :].view(np.uint64)
    return head[1 : n + 1].tolist(), [tokens[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


def _links(ids: list[int], sets: list[np.ndarray], percent: int, split: int = 0) -> list[tuple[int, int]]:
    if len(ids) - split < (1 if split else 2):
        return []
    return [(ids[i], ids[j]) for i, j in linked(sets, percent, split)]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by (key, node): a link of each further node of a key to the key's first node."""
    key = lead = last = None
    for b in batches:
        k, v = np.asarray(b.column(0)), np.asarray(b.column(1))
        if not len(k):
            continue
        starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(k))))
        leads = v[starts].copy()
        before = np.append(v[0], v[:-1])
        fresh = v != leads[run]
        fresh[1:] &= (v[1:] != v[:-1]) | (k[1:] != k[:-1])
        if k[0] == key:
            leads[0] = lead
            fresh[run == 0] = (v != lead)[run == 0] & (v != np.where(np.arange(len(v)) == 0, last, before))[run == 0]
        key, lead, last = k[-1], leads[-1], v[-1]
        pairs = np.unique(np.stack([v[fresh], leads[run][fresh]], axis=1), axis=0)
        yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _with_blocks(clusters: DataFrame) -> DataFrame:
    """(node, cluster) with the blocks of its cluster; a large cluster's rows are not brought together for that."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)))
    large = max(BLOCK, clusters.count() // MOST_LARGE)  # so many nodes are in MOST_LARGE clusters at most
    marked = clusters.join(F.broadcast(sizes.where(F.col("n") >= large).select("cluster", "blocks")), "cluster", "left")
    rest = marked.where("blocks is null").select("node", "cluster").join(sizes.where(F.col("n") < large).select("cluster", "blocks").hint("merge"), "cluster")
    return marked.where("blocks is not null").select("node", "cluster", "blocks").unionByName(rest.select("node", "cluster", "blocks"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = N_WORDS, percent: int = PERCENT, text_hash: bool = False, equal_parts: float | None = None) -> DataFrame:
    """(id, n_shingles, component_id) for every row of docs, and if asked for the text's xxhash64 as text_hash.

    n_shingles is the size of the row's set of word n-grams (a text of fewer words is one n-gram; a null or
    blank text has none and links with nothing). Sets link when 100 * intersection >= percent * union;
    component_id is the smallest id reachable by links, the own one included. Rows of equal texts link. Rows
    with a null id have a null component and link nothing. Sets are told apart by 64-bit digests of 64-bit
    token hashes. Other columns are ignored.
    """
    rows = bounded_batches(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                tokens, first = token_sets(b.column(1)[lo:hi], n_words)
                node = digests(tokens, first)
                owner, key = part_keys(tokens, first, percent, equal_parts)
                fresh = np.zeros(hi - lo, bool)  # copies within a task give their keys once
                for i, (x, named) in enumerate(zip(node.tolist(), b.column(0)[lo:hi].is_valid().to_pylist(), strict=True)):
                    if named and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                if len(seen) > 200_000:
                    seen.clear()
                keep = fresh[owner]
                yield pa.record_batch([b.column(0)[lo:hi], pa.array(np.diff(first), pa.int64()), pa.array(node.view(np.int64)), _grouped(key[keep], owner[keep], hi - lo), b.column(2)[lo:hi]], names=["id", "n", "node", "keys", "text_hash"])

    described = stored(rows.mapInArrow(tidy(describe), "id long, n long, node long, keys array<long>, text_hash long"), "shingle-keys")
    keyed = described.where("id is not null").select(F.explode("keys").alias("key"), "node")
    stars = keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tidy(_stars), "a long, b long")
    clusters = stored(connected_components(stars).select("node", F.col("root").alias("cluster")), "clusters")
    nodes = described.where("id is not null and n > 0").groupBy("node").agg(F.min("id").alias("least"))
    wanted = _with_blocks(clusters).join(nodes, "node").select(F.col("least").alias("id"), "node", "cluster", "blocks")

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(0)):
                tokens, first = token_sets(b.column(0)[lo:hi], n_words)
                own = np.flatnonzero(digests(tokens, first).view(np.int64) == np.asarray(b.column(1)[lo:hi]))  # a repeated id may have other texts
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(tokens.view(np.int64)))
                yield pa.record_batch([c[lo:hi].take(pa.array(own)) for c in b.columns[1:]] + [lists.take(pa.array(own))], names=["node", "cluster", "blocks", "tokens"])

    sets = rows.join(wanted, "id").select("text", "node", "cluster", "blocks").mapInArrow(tidy(tokenize), "node long, cluster long, blocks long, tokens array<long>")
    placed = sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).select("cluster", "block", "blocks", "node", "tokens")
    folder = scratch_path(docs.sparkSession, "set-blocks")

    def compare_or_keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links within clusters of one block; blocks of larger clusters go to a file, and where they are is returned."""
        unit, ids, sets_ = None, [], []
        uri, out, at = f"{folder}/{uuid.uuid4().hex}.sets", None, 0
        links: list[tuple[int, int]] = []
        kept: list[tuple] = []

        def flush() -> None:
            nonlocal out, at
            _, own = np.unique(np.array(ids, np.int64), return_index=True)  # repeated rows
            of, what = [ids[i] for i in own], [sets_[i] for i in own]
            if unit[2] == 1:
                links.extend(_links(of, what, percent))
                return
            if out is None:
                fs, path = open_filesystem(uri)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path, compression=None)
            data = _packed(of, what)
            out.write(data)
            kept.append((unit[0], unit[1], uri, at, len(data), of))
            at += len(data)

        for b in batches:
            cluster, block, blocks, node = (np.asarray(b.column(k)).tolist() for k in range(4))
            flat = np.asarray(b.column(4).flatten()).view(np.uint64)
            ends = np.append(0, np.cumsum(np.asarray(b.column(4).value_lengths(), np.int64)))
            for r in range(len(node)):
                if (cluster[r], block[r], blocks[r]) != unit:
                    if ids:
                        flush()
                    unit, ids, sets_ = (cluster[r], block[r], blocks[r]), [], []
                ids.append(node[r])
                sets_.append(flat[ends[r] : ends[r + 1]].copy())
        if ids:
            flush()
        if out is not None:
            out.close()
        n, m = len(links), len(kept)
        columns = [[x for x, _ in links] + [None] * m, [y for _, y in links] + [None] * m, *([None] * n + [x[i] for x in kept] for i in range(6))]
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 2 + [pa.list_(pa.int64())]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "cluster", "block", "uri", "at", "size", "nodes"])

    def compare_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for left, right in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sides = []
                for side in (left, right) if left != right else (left,):
                    ids: list[int] = []
                    sets_: list[np.ndarray] = []
                    for piece in side:
                        fs, path = open_filesystem(piece["uri"])
                        with fs.open_input_file(path) as f:
                            i, x = _unpacked(f.read_at(piece["size"], piece["at"]))
                        ids += i
                        sets_ += x
                    sides.append((ids, sets_))
                (ids, sets_), *rest = sides
                found = _links(ids + rest[0][0], sets_ + rest[0][1], percent, len(ids)) if rest else _links(ids, sets_, percent)
                yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], names=["a", "b"])

    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = placed.repartition(n_tasks, "cluster", "block").sortWithinPartitions("cluster", "block")
    done = stored(done.mapInArrow(tidy(compare_or_keep), "a long, b long, cluster long, block long, uri string, at long, size long, nodes array<long>"), "set-links")
    links = done.where("a is not null").select("a", "b")
    blocks = done.where("uri is not null").withColumn("side", F.expr(f"block div {SIDE_BLOCKS}"))
    if not blocks.isEmpty():
        side = stored(blocks.groupBy("cluster", "side").agg(F.array_sort(F.collect_list(F.struct("uri", "at", "size"))).alias("pieces")), "set-sides")
        other = side.select(F.col("cluster").alias("c"), F.col("side").alias("s"), F.col("pieces").alias("others"))
        # Sides are numbered from 0, but one may have no sets.
        leads = side.groupBy("cluster").agg(F.min("side").alias("lead")).withColumnRenamed("cluster", "lead_of")
        units = side.join(other.hint("merge"), (F.col("cluster") == F.col("c")) & (F.col("side") <= F.col("s")))
        units = units.join(leads.hint("merge"), F.col("cluster") == F.col("lead_of")).withColumn("first", (F.col("side") == F.col("s")) | (F.col("side") == F.col("lead")))

        def compared(some: DataFrame) -> DataFrame:
            return some.select("pieces", "others", "cluster", "side", "s").repartition(n_tasks, "cluster", "side", "s").select("pieces", "others").mapInArrow(tidy(compare_kept), "a long, b long")

        links = stored(links.unionByName(compared(units.where("first"))), "first-links")
        found = stored(connected_components(links), "first-roots")
        members = blocks.select("cluster", "side", F.explode("nodes").alias("node")).join(found.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        alike = stored(members.groupBy("cluster", "side").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x = y").select("cluster", "side", F.col("x").alias("root")), "whole-sides")
        one = alike.select(F.col("cluster").alias("c1"), F.col("side").alias("side1"), F.col("root").alias("root1"))
        two = alike.select(F.col("cluster").alias("c2"), F.col("side").alias("side2"), F.col("root").alias("root2"))
        left = units.where("not first").join(one.hint("merge"), (F.col("cluster") == F.col("c1")) & (F.col("side") == F.col("side1")), "left").join(two.hint("merge"), (F.col("cluster") == F.col("c2")) & (F.col("s") == F.col("side2")), "left")
        more = stored(compared(left.where("root1 is null or root2 is null or root1 <> root2")), "more-links")
        roots = found if more.isEmpty() else connected_components(links.unionByName(more))
    else:
        roots = connected_components(links)
    # Of each node its component's smallest id; nodes without links have their own.
    joined = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    smallest = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = joined.join(smallest, "root").select("node", "component_id")
    out = described.select("id", "n", "node", "text_hash").join(ids, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *(["text_hash"] if text_hash else []))
