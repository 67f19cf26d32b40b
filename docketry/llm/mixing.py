"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

Each source's documents, in an order shuffled by hash, form a stream of words that is cut into blocks of
BLOCK_WORDS; a stream goes on with its second pass where the first ends. Slot j of the mix has the van der
Corput point j (its binary digits mirrored) and belongs to the source whose share of the unit interval holds
that point, so every stretch of the schedule keeps the weights. The slots of a source, ranked by j, take its
blocks in order until the source's target is met; the few slots that a source lacks at the end follow after.

Running sums over a source go through two coarser levels of partial sums, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.shared import free_name, stored

BLOCK_WORDS = 256
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_PASSES = 2
BROADCAST_SOURCES = 100_000
_CHUNK = 4096

#: A word, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sum(df: DataFrame, part: str, order: list[str], fine: Column, coarse: Column, value: Column, name: str) -> DataFrame:
    """df with the sum of `value` over the rows of the same `part` that come before in `order`.

    fine and coarse must not fall along the order, and fine must determine coarse: sums within a fine group, of
    fine groups within a coarse one, and of coarse groups are added, so that each window stays small.
    """
    df = df.withColumn("__fine", fine).withColumn("__value", value.cast("long"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(c: str, parts: list[str], by: list[str]) -> Column:
        return F.coalesce(F.sum(c).over(before.partitionBy(*parts).orderBy(*by)), F.lit(0))

    small = df.withColumn("__coarse", coarse).groupBy(part, "__coarse", "__fine").agg(F.sum("__value").alias("__sum"))
    large = small.groupBy(part, "__coarse").agg(F.sum("__sum").alias("__sum"))
    small = small.select(part, "__coarse", "__fine", earlier("__sum", [part, "__coarse"], ["__fine"]).alias("__small"))
    large = large.select(part, "__coarse", earlier("__sum", [part], ["__coarse"]).alias("__large"))
    # The sizes of derived tables are underestimated, so the joins say not to broadcast.
    starts = small.join(large.hint("merge"), [part, "__coarse"]).select(part, "__fine", (F.col("__small") + F.col("__large")).alias("__start"))
    inner = df.withColumn("__inner", earlier("__value", [part, "__fine"], order))
    return inner.join(starts.hint("merge"), [part, "__fine"]).withColumn(name, F.col("__start") + F.col("__inner")).drop("__fine", "__value", "__inner", "__start")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source_id, source, source_size, target, budget) from (source, source_size), one row per source.

    Sources in code point order, null last, take the weights in turn. Targets are weight * level, but at most
    MOST_PASSES times the source, with the level at which they add up to share * all sizes. Of the sources by
    ascending cap per weight, those up to the level are capped: that needs running sums over the sources only
    (one row each), not a loop. budget is the target in whole words.
    """
    everything = Window.partitionBy()
    ids = sizes.withColumn("source_id", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_id") % len(weights) + 1).cast("int"))
    cap = (MOST_PASSES * F.col("source_size")).cast("double")
    rows = ids.withColumn("weight", turn).withColumn("cap", cap).withColumn("total", F.sum("source_size").over(everything) * share)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_id")
    spent = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("total") - spent) / open_weight).withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level)
    rows = rows.withColumn("target", target)
    return rows.select("source_id", "source", "source_size", "target", F.floor(F.col("target") + 0.5).alias("budget"))


def few(sources: DataFrame) -> bool:
    """Whether a table with a row for each source may be broadcast."""
    return sources.count() <= BROADCAST_SOURCES


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source_id, block): the schedule's slots, each with the block of its source's stream that it takes."""
    everything = Window.partitionBy()
    before = Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, -1)
    plan = sources.withColumn("blocks", F.ceil(F.col("budget") / F.lit(block_words)))
    plan = plan.withColumn("n", F.sum("blocks").over(everything)).withColumn("all", F.sum("budget").over(everything))
    plan = plan.where("budget > 0").withColumn("bits", F.greatest(F.lit(1), F.length(F.bin("n"))))
    cells = F.pow(F.lit(2.0), F.col("bits"))
    low = F.coalesce(F.sum("budget").over(before), F.lit(0))
    plan = plan.withColumn("lo", F.floor(low / F.col("all") * cells)).withColumn("hi", F.floor((low + F.col("budget")) / F.col("all") * cells))
    runs = plan.where("hi > lo").withColumn("at", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(_CHUNK).cast("long"))))
    points = runs.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source_id", "at").select("source_id", "n", "bits", F.explode(F.sequence("at", F.least(F.col("at") + _CHUNK, "hi") - 1)).alias("v"))
    mirrored = F.expr("cast(conv(reverse(lpad(bin(v), bits, '0')), 2, 10) as bigint)")
    points = points.select("source_id", "n", mirrored.alias("slot")).where("slot < n").drop("n")
    ranked = running_sum(points, "source_id", ["slot"], F.shiftright("slot", 8), F.shiftright("slot", 16), F.lit(1), "block")
    budgets = plan.select("source_id", "blocks", "n")
    used = ranked.join(F.broadcast(budgets) if few(sources) else budgets.hint("merge"), "source_id").where("block < blocks").select("slot", "source_id", "block")
    had = points.groupBy("source_id").agg(F.count("*").alias("had"))
    short = budgets.join(had, "source_id", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < blocks")
    rest = short.withColumn("block", F.explode(F.sequence("had", F.col("blocks") - 1)))
    return used.unionByName(rest.select((F.col("n") + F.col("block")).alias("slot"), "source_id", "block"))


def placed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> tuple[DataFrame, DataFrame]:
    """(documents, sources): each document's size and its first word's place in its source's stream; the targets."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    narrow = stored(narrow.withColumn("key", F.xxhash64(F.lit("order"), "doc_id", "size")), "mix-sizes")
    sources = stored(source_targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), **how), "mix-sources")
    small = sources.select("source_id", F.col("source").alias("__source"), "source_size")
    small = F.broadcast(small) if few(sources) else small.hint("merge")
    known = narrow.join(small, narrow["source"].eqNullSafe(small["__source"])).drop("__source")
    placed = running_sum(known, "source_id", ["key", "doc_id"], F.shiftright("key", 48), F.shiftright("key", 56), F.col("size"), "place")
    return stored(placed.drop("key"), "mix-placed"), sources


def mix_schedule(placed: DataFrame, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source_id, doc_id, size, place, pass, start, n_words): what each slot takes of which document.

    start counts words from the document's first. Blocks have block_words words, but for the last of a source.
    """
    budget = sources.select("source_id", "budget")
    budget = F.broadcast(budget) if few(sources) else budget.hint("merge")
    rows = placed.where("size > 0").join(budget, "source_id").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1))))
    rows = rows.withColumn("lo", F.col("place") + F.col("pass") * F.col("source_size")).withColumn("hi", F.least(F.col("lo") + F.col("size"), "budget")).where("hi > lo")
    block = F.lit(block_words).cast("long")
    rows = rows.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    taken = slots(sources, block_words).hint("merge").join(rows, ["source_id", "block"])
    start, end = F.greatest(F.col("block") * block, "lo"), F.least((F.col("block") + 1) * block, "hi")
    return taken.select("slot", "source_id", "doc_id", "size", "place", "pass", (start - F.col("lo")).alias("start"), (end - start).alias("n_words"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS, **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of docs.

    A null text has no words, and a text without words is never taken. A null source is a source of its own.
    Repeated rows each have a place in the stream. An empty table gives no rows; other columns are ignored.
    """
    placed, sources = placed_documents(docs, id_col, text_col, source_col, **how)
    taken = mix_schedule(placed, sources, block_words).groupBy("source_id", "place", "size", F.col("doc_id").alias("__doc")).agg(F.sum("n_words").alias("taken"))
    targets = sources.select("source_id", "target")
    targets = F.broadcast(targets) if few(sources) else targets.hint("merge")
    same = (placed["source_id"] == taken["source_id"]) & (placed["place"] == taken["place"]) & (placed["size"] == taken["size"]) & placed["doc_id"].eqNullSafe(taken["__doc"])
    rows = placed.join(taken.select("source_id", "place", "size", "__doc", "taken").hint("merge"), same, "left").select(placed["*"], "taken").join(targets, "source_id")
    return rows.select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, each as many times as the mix takes most of it (0 to MOST_PASSES).

    Rows that repeat an id, a source and a size share what is taken of them evenly, rounded.
    """
    taken = mix(docs, id_col, text_col, source_col, **how).where("taken > 0")
    i, o, n, m, k = (free_name(docs, x) for x in ("__id", "__source", "__size", "__copies", "__copy"))
    copies = taken.groupBy(F.col(id_col).alias(i), F.col("source").alias(o), F.col("size").alias(n)).agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias(m)).where(F.col(m) > 0)
    same = F.col(id_col).eqNullSafe(F.col(i)) & F.col(source_col).eqNullSafe(F.col(o)) & (word_count(F.col(text_col)) == F.col(n))
    rows = docs.join(copies.hint("merge"), same).withColumn(k, F.explode(F.sequence(F.lit(1), F.col(m))))
    return rows.select(*(docs[c] for c in docs.columns))
