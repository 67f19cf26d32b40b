"""Connected components of a table of links: trees within tasks, joined by shuffles.

A task replaces the links that it holds by a link of each node to the least node that they lead to, which keeps what is
connected. A round does so with links as they lie, again with all links of a node (dealt by their larger end), and
then points every link at the parent of its end. After a few rounds (logarithmic in the number of nodes) all
nodes point at the smallest node of their component. A task sends a node once, however many links it has; the links
to a hub meet in one task of a join only, which streams them and keeps none. Links never leave the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.shared import stored, tidy

MOST_ROUNDS = 60
#: Links that a task looks at at once; with more it gives several trees.
MOST_LINKS = 1 << 21


def trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that the links lead to) of every node that is not the least itself, by ascending node."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        p, q = root[x], root[y]
        apart = p != q
        if not apart.any():
            break
        x, y, p, q = x[apart], y[apart], p[apart], q[apart]
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while not np.array_equal(up := root[root], root):
            root = up
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[below], nodes[root[below]]


def contracted(links: DataFrame, ordered: bool = False) -> DataFrame:
    """(a, b, moved): what links of integers, none null, connect, with the links of a task replaced by trees.

    A task takes about MOST_LINKS at once; if they are ordered by a, all links of an a together. moved is whether a link
    was not among those that its tree is made of.
    """
    most = MOST_LINKS

    def replace(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        node, root = trees(a, b)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        # Where a node's link to its root is there, it is the first of the node's: none leads to less than the root.
        first = np.minimum(np.searchsorted(a, node), len(a) - 1)
        moved = (a[first] != node) | (b[first] != root)
        return pa.record_batch([pa.array(node), pa.array(root), pa.array(moved)], names=["a", "b", "moved"])

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append((np.asarray(batch.column(0)), np.asarray(batch.column(1))))
            n += len(batch)
            if n >= most:
                a, b = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(a, a[-1])) if ordered else n
                if cut:
                    yield replace(a[:cut], b[:cut])
                held, n = [(a[cut:], b[cut:])], n - cut
        if n:
            yield replace(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return links.select("a", "b").mapInArrow(tidy(contract), "a long, b long, moved boolean")


def _round(links: DataFrame) -> DataFrame:
    """links, each a link of a to a smaller b, after a round; moved is false everywhere if all point at their least."""
    n = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = contracted(contracted(links).repartition(n, "a").sortWithinPartitions("a"), ordered=True)
    parents = own.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("parent"))
    j = own.join(parents.hint("merge"), F.col("b") == F.col("of"), "left")
    return j.select("a", F.coalesce("parent", "b").alias("b"), (F.col("moved") | F.col("parent").isNotNull()).alias("moved"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of its component, for every node with a link to another node.

    Links may come in either direction and repeat; a link of a node with itself, or with a null, is passed over.
    Nodes are integers.
    """
    pairs = links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    current = stored(contracted(pairs), "links")
    for _ in range(MOST_ROUNDS):
        current = stored(_round(current), "links")
        if current.where("moved").isEmpty():
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


LEAST_HUB, MOST_HUBS = 200, 2000


def _large_star(links: DataFrame, n_links: int) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n"))
    # Links have two ends, so at most 2 * MOST_HUBS nodes have this many: those are broadcast, and leave the join.
    many = max(LEAST_HUB, n_links // MOST_HUBS)
    hubs = least.where(F.col("n") >= many).select("a", F.col("m").alias("hub"))
    marked = both.where("b > a").join(F.broadcast(hubs), "a", "left")
    rest = marked.where("hub is null").select("a", "b").join(least.where(F.col("n") < many).select("a", "m").hint("merge"), "a")
    led = rest.select("b", "m").unionByName(marked.where("hub is not null").select("b", F.col("hub").alias("m")))
    return led.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links with a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    onward = links.join(least.hint("merge"), "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return onward.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components_by_stars(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """What connected_components gives, in DataFrame functions only, by alternating large-star and small-star steps.

    Each step points nodes at the smallest id they know of. Minima are pre-aggregated, and the few nodes that hold many
    of the links are joined by a bounded broadcast, so no task gets a hub's links.
    """
    pairs = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).distinct()
    current, mark = stored(pairs, "links"), None
    for _ in range(MOST_ROUNDS):
        r = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if r["n"] == 0 or (r["n"], r["s"]) == mark:
            break
        mark = (r["n"], r["s"])
        current = stored(_small_star(_large_star(current, r["n"])), "links")
    else:
        raise RuntimeError("the components did not settle")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
