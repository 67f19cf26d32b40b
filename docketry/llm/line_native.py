"""Fuzzy line dedup in DataFrame functions only: the sketches, links and components of `line_dedup`, without Python tasks.

A line's shingles are its distinct runs of K characters, hashed to 64 bits. Its sketch is its LEAST least hashes in ascending
order; each three of them on end that begin with an even one make a key. Two lines share a key if the first three hashes of
such a run in their union are in both lines and none that only one line has stands between: for lines of similarity 0.8
with a probability of 0.997 (simulated: 0.0032 are missed among 400 shingles, fewer among less). Lines of up to LEAST
shingles give all runs, and of up to SHORT shingles runs of two as well: such lines share a key for certain, as the
hashes of which at most a fifth differ cannot be divided into shorter runs. Each line is sketched alike, from all
its shingles, however long it is and however often one repeats.

Lines that share a key are compared with the key's least line, exactly, by the hashes of all shingles. Where that leaves the
lines of a key in several components, all of its lines are compared across components: pair by pair, or for keys of many
lines by an inverted index of the shingles that come first when rare ones do (prefix filter). So any two similar lines
that share a key are in one component, however rows are dealt. No window or list holds the lines of a key: keys are
aggregated on the map side, and rows meet in joins, which may be divided where a key is very common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.components import components_by_stars
from docketry.llm.shared import stored

K = 8
#: Least hashes of a line that its keys are made of; up to which number of shingles all runs are keys, and runs of two are.
LEAST, SHORT = 24, 9
#: Buckets in which shingles are counted to put rare ones first; a rank of a bucket takes two bytes.
BUCKETS = 1 << 16
#: A line's place is its document's id times this, plus its number.
PLACES = 1_000_000_000


def hashes(line: Column) -> Column:
    """64-bit hashes of all runs of K characters of a line (of what there is, if it is shorter; as UTF-32, so that each takes four bytes)."""

    def of(u: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(u) - (4 * K - 1), F.lit(1)), F.lit(4))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(u, i, F.lit(4 * K))))

    # A one-element transform binds the code points once: what refers to them does not encode again.
    return F.flatten(F.transform(F.array(F.encode(line, "UTF-32")), of))


def described_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, number, node, n, keys): every line that is not blank, with its 64-bit hash as node, its number of distinct shingles,
    and the keys of its runs."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.posexplode(F.split(text_col, "\n")).alias("number", "line")).where("id is not null")
    full = rows.where(F.col("line").rlike(r"[^ \t\r]"))
    long_ = F.char_length("line") >= K
    sets = full.select("id", "number", F.xxhash64("line").alias("node"), long_.alias("long"), F.sort_array(F.array_distinct(hashes(F.col("line")))).alias("all"))
    size = F.when(F.col("long"), F.size("all")).otherwise(0)
    least = sets.select("id", "number", "node", size.alias("n"), F.slice("all", F.lit(1), F.lit(LEAST)).alias("least"))
    n, after = F.col("n"), lambda i, k: F.get("least", i + k)
    starts = lambda x: (n <= LEAST) | (x.bitwiseAND(F.lit(1).cast("long")) == 0)
    threes = F.transform("least", lambda x, i: F.when(after(i, 2).isNotNull() & starts(x), F.xxhash64(x, after(i, 1), after(i, 2))))
    twos = F.transform("least", lambda x, i: F.when(after(i, 1).isNotNull() | (n == 1), F.xxhash64(F.lit(2), x, after(i, 1))))
    keys = F.when(n > SHORT, threes).otherwise(F.concat(threes, twos))
    return least.select("id", "number", "node", "n", F.array_compact(keys).alias("keys"))


def candidates(lines: DataFrame) -> DataFrame:
    """Distinct (key, node, lead): lines of the keys of several lines, with the least of the key's lines."""
    keyed = lines.where("n > 0").select(F.explode("keys").alias("key"), "node")
    ends = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("key", "lead")
    return keyed.join(ends.hint("shuffle_hash"), "key").distinct()


def unlinked(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, lead, root) of the keys of three lines and more that hold lines of several roots; of keys with equal lines, one."""
    known = members.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    same = F.sum(F.xxhash64("node").cast("decimal(20,0)"))
    open_ = known.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"), same.alias("s")).where("x <> y and n > 2")
    return known.join(open_.dropDuplicates(["n", "s"]).select("key").hint("merge"), "key").select("key", "node", "lead", "root")


def line_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, n, line) of the wanted (id, number, node, n): documents are shuffled whole, and cut where they arrive."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    places = wanted.groupBy("id").agg(F.collect_list(F.struct("number", "node", "n")).alias("places"))
    parts = rows.join(places.hint("merge"), "id").select("places", F.split("text", "\n").alias("parts"))
    cut = parts.select(F.inline(F.transform("places", lambda p: F.struct(p.node.alias("node"), p.n.alias("n"), F.get("parts", p.number).alias("line")))))
    return cut.where(F.xxhash64("line") == F.col("node")).dropDuplicates(["node"])  # a repeated id may have other texts


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) whose lines have a Jaccard similarity of percent or more; texts: node, n, line."""
    left, right = (texts.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("line").alias(f"line_{x}")) for x in "ab")
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    common = F.size(F.array_intersect(hashes(F.col("line_a")), hashes(F.col("line_b"))))
    return both.where(sizes).where((100 + percent) * common >= percent * (F.col("n_a") + F.col("n_b"))).select(*pairs.columns)


def prefix_pairs(rooted: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b, x, y) of lines of different roots x < y, with all those whose similarity is percent or more; rooted: node, root.

    In any one order of all shingles, two such lines share one of the first n - ceil(n * percent / 100) + 1 of
    their n shingles. The order puts first what few lines have, by counts in BUCKETS buckets: a template that
    many lines hold comes last, so lines meet by what is their own.
    """
    lines = stored(rooted.join(texts.hint("merge"), "node").select("node", "root", "n", F.array_distinct(hashes(F.col("line"))).alias("s")), "line-shingles")
    counts = lines.select(F.explode("s").alias("t")).groupBy(F.pmod("t", F.lit(BUCKETS)).alias("i")).count()
    found = {r["i"]: r["count"] for r in counts.collect()}  # BUCKETS rows at most
    table = bytearray(2 * BUCKETS)
    for rank, i in enumerate(sorted(range(BUCKETS), key=lambda i: (found.get(i, 0), i))):
        table[2 * i : 2 * i + 2] = rank.to_bytes(2, "big")
    ranks = F.lit(bytes(table))
    ordered = F.sort_array(F.transform("s", lambda t: F.struct(F.substring(ranks, (2 * F.pmod(t, F.lit(BUCKETS)) + 1).cast("int"), F.lit(2)).alias("r"), t.alias("t"))))
    few = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)).cast("int") + 1
    firsts = lines.select("node", "root", "n", F.posexplode(F.slice(ordered, F.lit(1), few)).alias("i", "x")).select("node", "root", "n", "i", F.col("x.t").alias("t"))
    firsts = stored(firsts, "line-prefixes")
    shared = firsts.groupBy("t").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("t")
    met = stored(firsts.join(shared.hint("merge"), "t"), "shared-prefixes")
    l, r = met.alias("l"), met.alias("r")
    # What follows the shared shingle bounds the overlap.
    enough = (100 + percent) * F.least(F.col("l.n") - F.col("l.i"), F.col("r.n") - F.col("r.i")) >= percent * (F.col("l.n") + F.col("r.n"))
    met_by = l.join(r.hint("merge"), (F.col("l.t") == F.col("r.t")) & (F.col("l.root") < F.col("r.root")) & enough)
    return met_by.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("l.root").alias("x"), F.col("r.root").alias("y")).distinct()


def more_links(open_lines: DataFrame, texts: DataFrame, percent: int, group_lines: int) -> DataFrame:
    """(a, b) of roots that have similar lines in a key; open_lines: key, node, lead, root, n."""
    large = stored(open_lines.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > group_lines).select("key"), "large-keys")
    some = not large.isEmpty()
    # The least line of a key was compared with all others.
    small = (open_lines.join(large.hint("merge"), "key", "left_anti") if some else open_lines).where("node <> lead")
    l, r = small.alias("l"), small.alias("r")
    sizes = (100 * F.col("l.n") >= percent * F.col("r.n")) & (100 * F.col("r.n") >= percent * F.col("l.n"))
    met = l.join(r.hint("merge"), (F.col("l.key") == F.col("r.key")) & (F.col("l.root") < F.col("r.root")) & sizes)
    pairs = met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("l.root").alias("x"), F.col("r.root").alias("y")).distinct()
    if some:
        rooted = open_lines.join(large.hint("merge"), "key", "left_semi").select("node", "root").distinct()
        pairs = pairs.unionByName(prefix_pairs(rooted, texts, percent)).distinct()
    near = verified(stored(pairs, "more-pairs"), texts, percent)
    return stored(near.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "more-links")


def dropped_lines(docs: DataFrame, id_col: str, text_col: str, percent: int, group_lines: int) -> DataFrame:
    """(id, number) of every line to drop: of each component of similar lines, all but the first place."""
    lines = stored(described_lines(docs, id_col, text_col), "lines")
    place = (F.col("id").cast("decimal(38,0)") * PLACES + F.col("number")).cast("decimal(38,0)")
    places = lines.select("id", "number", place.alias("place"), "node", "n")
    first = stored(places.groupBy("node").agg(F.min("place").alias("place"), F.count("*").alias("times"), F.max("n").alias("n")), "line-nodes")
    members = stored(candidates(lines), "line-keys")
    pairs = stored(members.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct(), "line-pairs")
    id_of = F.floor(F.col("place") / PLACES).cast("decimal(38,0)")
    wanted = first.join(members.select("node").distinct().hint("merge"), "node")
    wanted = wanted.select(id_of.cast("long").alias("id"), (F.col("place") - id_of * PLACES).cast("int").alias("number"), "node", "n")
    texts = stored(line_texts(docs, wanted, id_col, text_col), "line-texts")
    roots = stored(components_by_stars(verified(pairs, texts, percent)), "line-roots")
    more = more_links(stored(unlinked(members, roots).join(texts.select("node", "n").hint("merge"), "node"), "open-lines"), texts, percent, group_lines)
    if not more.isEmpty():
        later = components_by_stars(more).select(F.col("node").alias("root"), F.col("root").alias("last"))
        alone = later.join(roots.hint("merge"), "root", "left_anti").select(F.col("root").alias("node"), "root")
        roots = roots.unionByName(alone).join(later.hint("merge"), "root", "left").select("node", F.coalesce("last", "root").alias("root"))
    # Lines without a link that stand in one place only stay as they are.
    of_node = first.join(roots.hint("merge"), "node", "left").where("times > 1 or root is not null").withColumn("root", F.coalesce("root", "node"))
    of_root = of_node.groupBy("root").agg(F.min("place").alias("kept"))
    decided = of_node.join(of_root.hint("merge"), "root").select("node", "kept")
    return places.join(decided.hint("merge"), "node").where("place <> kept").select("id", "number")
