"""Merkle manifest of a table: a digest per row, a tree per group, a tree over the groups, and a proof per row.

Rows of a group stand in order; every `fanout` consecutive nodes (fewer at the end, even one) become the hash of
their digests, until one is left. The groups' roots, in order, do the same. Levels are windows by group and parent:
the ordered list of a full frame is both the parent's preimage and what each child needs as its siblings. Only the
first leaf below a node speaks for it, so every parent counts once.

A shuffle serves BLOCK_LEVELS levels: windows by parent need no other partitioning than that by block, and a block
has at most fanout ** BLOCK_LEVELS leaves. The heads of the blocks are written as a table of their own and climb in the
same way; what they find goes down to their block's rows by a join on that same partitioning. No proof is shuffled, and
no group, however large, is in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.shared import stored
from docketry.session import small

FANOUT = 2
BLOCK_LEVELS = 10

#: Columns of a row's leaf, in order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_ROW_BITS = 33  # of monotonically_increasing_id(): the partition is above them
_NO_PROOF = "array<struct<at:int,siblings:array<string>>>"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def framed(c: Column) -> Column:
    """A value that cannot be taken for another one or for two: `-` if null, else its bytes' number, a colon, itself."""
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(*(framed(c) for c in columns))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to. proof: array of (at, siblings), from the leaf's level upwards."""

    def step(node: Column, s: Column) -> Column:
        before = F.slice(s["siblings"], F.lit(1), s["at"])
        after = F.slice(s["siblings"], s["at"] + 1, F.size(s["siblings"]) - s["at"])
        return digest(F.array_join(before, ""), node, F.array_join(after, ""))

    return F.aggregate(proof, leaf, step)


def proof_digests(proof: Column) -> Column:
    """The siblings of a proof in one list, level by level, from left to right."""
    return F.flatten(F.transform(proof, lambda s: s["siblings"]))


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows (tree, ...) with `idx`, a row's place within its tree by `order`, and `n`, the tree's rows.

    Rows are dealt out by ranges of (tree, order), rows that are equal there too, so a large tree or a repeated row
    is spread over tasks. Each task's rows are numbered, and one number per tree and task is added.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    by = ["tree", *order, "salt"]
    dealt = stored(salted.repartitionByRange(*by).sortWithinPartitions(*by).drop("salt").withColumn("at", F.monotonically_increasing_id()), name)
    dealt = dealt.withColumn("part", F.shiftright("at", _ROW_BITS))
    runs = dealt.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    w = Window.partitionBy("tree")
    earlier = F.sum("rows").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(w).alias("n"))
    runs = stored(runs, f"{name}-runs")
    return dealt.join(small(runs), ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def depth_of(placed: DataFrame, fanout: int) -> int:
    """Levels above the leaves of the largest tree."""
    n = placed.agg(F.max("n")).first()[0] or 1
    depth = 0
    while n > 1:
        n, depth = -(-n // fanout), depth + 1
    return depth


def _div(c: Column, by: int) -> Column:
    return F.floor(c / F.lit(by)) if by > 1 else c


def block_levels(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """nodes (tree, idx, n, node, ...) after `levels` levels: `block`, `node` now its head's digest, and `proof`.

    A tree of one node stays as it is, so trees of any depth climb together.
    """
    size = fanout**levels
    idx = F.col("idx")
    out = nodes.withColumn("block", F.shiftright(idx, levels) if fanout == 2 else _div(idx, size)).repartition("tree", "block")
    for k in range(levels):
        width = fanout**k
        w = Window.partitionBy("tree", "block", F.expr(f"idx div {width * fanout}")).orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = out.withColumn("run", F.collect_list(F.when(idx % width == 0, F.col("node"))).over(w))
        at = F.expr(f"cast(idx div {width} % {fanout} as int)")
        others = F.concat(F.slice("run", F.lit(1), at), F.slice("run", at + 2, F.lit(fanout)))
        climbs = F.col("n") > width
        out = out.withColumns({f"step{k}": F.when(climbs, F.struct(at.alias("at"), others.alias("siblings"))), "node": F.when(climbs, digest(F.array_join("run", ""))).otherwise(F.col("node"))}).drop("run")
    steps = [f"step{k}" for k in range(levels)]
    return out.withColumn("proof", F.array_compact(F.array(*steps)) if steps else F.array().cast(_NO_PROOF)).drop(*steps)


def climb(nodes: DataFrame, depth: int, finish: Callable[[DataFrame], DataFrame], name: str, fanout: int = FANOUT, most_levels: int = BLOCK_LEVELS) -> DataFrame:
    """nodes (tree, idx, n, node, ...) with the `proof` that leads to what finish() says of the trees.

    finish takes (tree, node), a tree's root each, and returns (tree, above, ...): what goes behind the proofs.
    """
    levels = min(depth, most_levels)
    size = fanout**levels
    here = block_levels(nodes, levels, fanout)
    if levels == depth:  # no tree has more than one block
        upper, on = finish(stored(here.where("idx = 0").select("tree", "node"), f"{name}-roots")), ["tree"]
    else:
        heads = here.where(F.col("idx") % size == 0).select("tree", F.col("block").alias("idx"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), "node")
        upper = climb(stored(heads, f"{name}-heads"), depth - levels, finish, name, fanout, most_levels)
        upper, on = upper.drop("n", "node").withColumnsRenamed({"idx": "block", "proof": "above"}), ["tree", "block"]
    joined = here.join(upper.hint("merge"), on)
    return joined.withColumn("proof", F.concat("proof", "above")).drop("above", "block")


def manifest(leaves: DataFrame, order: list[str], fanout: int = FANOUT, most_levels: int = BLOCK_LEVELS) -> DataFrame:
    """leaves (group, leaf, order columns, ...) with `subroot`, `root` and `proof`, from leaf to root.

    Within a group leaves ascend by `order`, nulls first, then by digest; groups ascend by name, null first. Equal
    rows are leaves of their own. No leaves, no rows. Names that start with two underscores are not for leaves.
    """
    if fanout < 2 or most_levels < 1:
        raise ValueError("a tree needs a fanout of 2 and blocks of a level at least")
    tree = F.when(F.col("group").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("group").cast("string")))
    rows = stored(leaves.withColumns({"tree": tree, "node": F.col("leaf")}), "merkle-leaves")
    placed = positions(rows, [*order, "leaf"], "merkle-placed")

    def over_groups(roots: DataFrame) -> DataFrame:
        above = positions(roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), "node", F.col("node").alias("subroot")), ["name"], "merkle-groups")
        done = climb(above, depth_of(above, fanout), lambda top: top.select("tree", F.array().cast(_NO_PROOF).alias("above"), F.col("node").alias("root")), "merkle-top", fanout, most_levels)
        return done.select(F.col("name").alias("tree"), F.col("proof").alias("above"), "subroot", "root")

    return climb(placed, depth_of(placed, fanout), over_groups, "merkle", fanout, most_levels).select(*leaves.columns, "subroot", "root", "proof")


def changed_groups(old: DataFrame, new: DataFrame) -> DataFrame:
    """(group, old_subroot, new_subroot) of the groups whose roots differ between two manifests, or that one lacks."""

    def roots(m: DataFrame, name: str) -> DataFrame:
        return m.groupBy("group").agg(F.first("subroot").alias(name))

    a, b = roots(old, "old_subroot"), roots(new, "new_subroot").withColumnRenamed("group", "group_")
    both = a.join(b, F.col("group").eqNullSafe(F.col("group_")), "full_outer")
    differs = both.where(~F.col("old_subroot").eqNullSafe(F.col("new_subroot")))
    return differs.select(F.coalesce("group", "group_").alias("group"), "old_subroot", "new_subroot")


def tampered_chars(doc_id: Column, n_chars: Column) -> Column:
    """n_chars of a tampered copy: one more where 7 divides the CRC of the id; nulls stay."""
    return F.when(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, n_chars + 1).otherwise(n_chars)


def manifest_report(docs: DataFrame, fanout: int = FANOUT, most_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of docs.

    Nulls in any column are told from empty texts; a row of null id comes first in its language, and is never tampered.
    Repeated rows are leaves of their own. Other columns are ignored; an empty table gives no rows.
    """
    columns = {c: F.col(c) for c in LEAF_COLUMNS}
    changed = tampered_chars(F.col("doc_id"), F.col("n_chars"))
    tampered = leaf_digest(list((columns | {"n_chars": changed}).values()))
    leaves = docs.select("doc_id", F.col("lang").alias("group"), leaf_digest(list(columns.values())).alias("leaf"), F.when(~changed.eqNullSafe(F.col("n_chars")), tampered).alias("tampered"))
    done = manifest(leaves, ["doc_id"], fanout, most_levels)
    done = done.withColumns({"folded_root": fold(F.coalesce("tampered", "leaf"), F.col("proof")), "proof_sha256": digest(F.array_join(proof_digests(F.col("proof")), ""))})
    return done.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
