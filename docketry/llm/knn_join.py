"""Exact top-k by inner product: a Voronoi join of queries with all vectors.

Vectors are grouped by their nearest pivot; pivots are the means of a bounded sample, and grow in number with the square
root of the vectors (LEAST_PIVOTS to MOST_PIVOTS), so that groups and the bounds on them stay small. Of each group a summary is kept: rows, the greatest distance from the pivot, the greatest norm. A query is first
solved within its own group, which gives a bound on its k-th best score. For a pivot p with radius r, a score in
the group is at most min(q.p + |q| r, |q| norm), so the query is replicated to just those groups whose bound
reaches its own, and solved there. Ties on the bound are replicated, so the result is exact.

Groups are dealt in blocks of rows by a hash of the id, so a group of any size (say, of one vector repeated)
spreads over many tasks; each task holds one block of vectors and one block of queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches, stored

LEAST_PIVOTS, MOST_PIVOTS = 64, 2048
#: Sampled rows for each pivot, and most components of them that pivots are made of.
SAMPLE_ROWS, SAMPLE_DIM = 16, 4096
LEAST_BLOCK, MOST_BLOCK = 256, 8192
QUERY_BLOCK = 4096
SCALE = 256.0


def _dense(column: pa.Array, dim: int) -> np.ndarray:
    """The first dim components of vectors as rows; shorter ones end in zeros."""
    n = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten(), float)
    row, at = np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    out = np.zeros((len(n), dim))
    out[row[at < dim], at[at < dim]] = flat[at < dim]
    return out


def _squares(column: pa.Array) -> np.ndarray:
    """Squared norms of whole vectors."""
    n = np.asarray(column.value_lengths(), np.int64)
    return np.bincount(np.repeat(np.arange(len(n)), n), np.asarray(column.flatten(), float) ** 2, minlength=len(n))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: in doubles while they hold, else in 64-bit integers, or where these may not
    hold in integers of any size, of which those beyond 64 bits become the nearest that has 64."""
    most = float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] if q.size and x.size else 0.0
    if most < 2**53:
        return q @ x.T
    if most < 2**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    whole = np.array([[int(v) for v in row] for row in q], object) @ np.array([[int(v) for v in row] for row in x], object).T
    return np.clip(whole, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def scores(q: list[np.ndarray], x: list[np.ndarray]) -> np.ndarray:
    """Products of lists of vectors of any lengths, a shorter one ending in zeros; memory follows the lengths there are."""
    def classes(v: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(z) for z in v], np.int64)
        return n, np.where(n > 0, np.ceil(np.log2(np.maximum(n, 1))), -1).astype(np.int64)

    (nq, cq), (nx, cx) = classes(q), classes(x)
    out = None
    for a in np.unique(cq).tolist():
        i = np.flatnonzero(cq == a)
        for b in np.unique(cx).tolist():
            j = np.flatnonzero(cx == b)
            dim = max(1, min(int(nq[i].max()), int(nx[j].max())))
            s = products(_padded([q[k] for k in i], dim), _padded([x[k] for k in j], dim))
            if len(i) == len(q) and len(j) == len(x):
                return s
            out = np.zeros((len(q), len(x)), np.int64) if out is None else out
            out[np.ix_(i, j)] = s.astype(np.int64)
    return np.zeros((len(q), len(x))) if out is None else out


def _padded(v: list[np.ndarray], dim: int) -> np.ndarray:
    if all(len(z) == dim for z in v):
        return np.array(v, float).reshape(len(v), dim)
    out = np.zeros((len(v), dim))
    for k, z in enumerate(v):
        out[k, : min(dim, len(z))] = z[:dim]
    return out


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, n = np.asarray(column.flatten(), float), np.asarray(column.value_lengths(), np.int64)
    ends = np.append(0, np.cumsum(n)).tolist()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def best(q_ids: np.ndarray, q: list[np.ndarray], ids: np.ndarray, x: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of each query's k highest among rows of another id; ties go to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], [x[i] for i in order.tolist()]
    out = []
    step = max(1, (4 << 20) // max(1, len(ids)))
    for lo in range(0, len(q_ids), step):
        s = scores(q[lo : lo + step], x)
        own = q_ids[lo : lo + step][:, None] == ids
        least = np.iinfo(np.int64).min if s.dtype == np.int64 else -np.inf
        s = np.where(own, least, s)
        at = max(0, len(ids) - k)
        floor = np.partition(s, at, axis=1)[:, at] if len(ids) else np.zeros(len(s))
        r, c = np.nonzero((s >= floor[:, None]) & ~own)
        v = s[r, c]
        o = np.lexsort((c, -v, r))
        r, c, v = r[o], c[o], v[o]
        first = np.searchsorted(r, r)
        keep = np.arange(len(r)) - first < k
        out.append((q_ids[lo : lo + step][r[keep]], ids[c[keep]], v[keep].astype(np.int64)))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def find_pivots(x: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Means of at most n groups of the sample, after a few rounds; one zero pivot if it is empty."""
    if not len(x):
        return np.zeros((1, 1))
    x = np.unique(x, axis=0)
    p = x[np.random.default_rng(seed).permutation(len(x))[:n]].copy()
    for _ in range(8):
        own = np.concatenate([np.argmin((p**2).sum(axis=1) - 2 * x[lo : lo + 2048] @ p.T, axis=1) for lo in range(0, len(x), 2048)])
        count = np.bincount(own, minlength=len(p))
        sums = np.zeros_like(p)
        np.add.at(sums, own, x)
        p[count > 0] = sums[count > 0] / count[count > 0][:, None]
    return p


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id long, vec array<double> of floor(scale * component)) of the rows that take part."""
    inf = float("inf")
    usable = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(vec_col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))
    return vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: F.floor(v.cast("double") * scale).cast("double")).alias("vec"))


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE, pivots: int | None = None) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of each query row with rows of other ids.

    Components count as floor(scale * component). Rows with a null id, or with a vector that is null or holds a
    null or non-finite component, take no part; a shorter vector counts as ending in zeros. Rows that repeat
    an id are candidates of their own, but not of queries with that id; of query rows that repeat an id, the
    least vector is the query. is_query is over the input's columns.
    """
    spark = vectors.sparkSession
    queries_of = vectors.where(is_query)
    rows = scaled(vectors, id_col, vec_col, scale)
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    dim = min(SAMPLE_DIM, max(1, shape["dim"] or 1))
    pivots = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(math.sqrt(shape["n"]))))
    wanted = SAMPLE_ROWS * pivots
    one_in = max(1, shape["n"] // (2 * wanted))
    # Of repeated rows one; what is left is bounded by the limit, in the order of a hash.
    some = rows.select(F.xxhash64("id", "vec").alias("h"), F.slice("vec", 1, dim).alias("vec")).where(F.pmod("h", F.lit(one_in)) == 0)
    sample = some.groupBy("h").agg(F.first("vec").alias("vec")).orderBy("h").limit(wanted).select("vec").toArrow()
    centres = find_pivots(_dense(sample.column("vec").combine_chunks(), dim) if sample.num_rows else np.zeros((0, dim)), pivots)

    width = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                ids, vec = b.column(0)[lo : lo + 4096], b.column(1)[lo : lo + 4096]
                x, whole = _dense(vec, width), _squares(vec)
                cell = np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)
                # Components beyond the pivots' add to the distance as they are.
                far = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1) + np.maximum(0, whole - (x**2).sum(axis=1)))
                yield pa.record_batch([ids, vec, pa.array(cell.astype(np.int32)), pa.array(far), pa.array(np.sqrt(whole))], names=["id", "vec", "cell", "far", "norm"])

    placed = "id long, vec array<double>, cell int, far double, norm double"
    data = stored(bounded_batches(rows).mapInArrow(assign, placed), "knn-data")
    asked = scaled(queries_of, id_col, vec_col, scale).groupBy("id").agg(F.min("vec").alias("vec"))
    queries = stored(asked.mapInArrow(assign, placed), "knn-queries")
    # A line per pivot.
    groups = data.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"), F.max("norm").alias("norm")).orderBy("cell").collect()
    cells = [g["cell"] for g in groups]
    radius, norm = np.array([g["radius"] for g in groups]), np.array([g["norm"] for g in groups])
    block = min(MOST_BLOCK, max(LEAST_BLOCK, math.ceil(shape["n"] / pivots)))
    blocks = {g["cell"]: math.ceil(g["n"] / block) for g in groups}

    def solve(left: DataFrame) -> DataFrame:
        """(q_id, id, score): of each row (q_id, vec, cell, floor) of left the k best within that cell that reach its floor."""
        load = {r["cell"]: r["n"] for r in left.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        if not load:
            return spark.createDataFrame([], "q_id long, id long, score long")
        # A row per pivot at most.
        plan = F.broadcast(spark.createDataFrame([(c, blocks[c], math.ceil(n / QUERY_BLOCK)) for c, n in load.items()], "cell int, blocks int, parts int"))
        q = left.join(plan, "cell").withColumn("part", F.pmod(F.xxhash64("q_id"), F.col("parts")).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        d = data.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

        def local(a: pa.Table, b: pa.Table) -> pa.Table:
            q_ids = np.asarray(a.column("q_id"))
            floors = a.column("floor").combine_chunks().fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            q_id, at, score = best(q_ids, _vectors(a.column("vec").combine_chunks()), np.asarray(b.column("id")), _vectors(b.column("vec").combine_chunks()), k)
            order = np.argsort(q_ids)
            keep = score >= floors[order][np.searchsorted(q_ids[order], q_id)]
            q_id, at, score = q_id[keep], at[keep], score[keep]
            return pa.table({"q_id": pa.array(q_id, pa.int64()), "id": pa.array(at, pa.int64()), "score": pa.array(score, pa.int64())})

        keys = ["cell", "block", "part"]
        return q.select("q_id", "vec", "floor", *keys).groupBy(*keys).cogroup(d.select("id", "vec", *keys).groupBy(*keys)).applyInArrow(local, "q_id long, id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("q_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = stored(ranked(solve(queries.select(F.col("id").alias("q_id"), "vec", "cell", F.lit(None).cast("long").alias("floor")))).drop("rank"), "knn-near")
    bound = near.groupBy(F.col("q_id").alias("__q")).agg(F.count("*").alias("had"), F.min("score").alias("floor"))
    known = queries.join(bound, queries["id"] == bound["__q"], "left").select("id", "vec", "cell", "norm", F.when(F.col("had") >= k, F.col("floor")).alias("floor"))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = np.array(cells, np.int32)
        for b in batches:
            q = _dense(b.column("vec"), width)
            size = np.asarray(b.column("norm"))[:, None]
            floor = np.asarray(b.column("floor").cast(pa.float64()).fill_null(-np.inf))[:, None]
            most = np.minimum(q @ centres[ids].T + size * radius, size * norm)
            slack = 1e-9 * (1 + np.abs(most) + size * norm)  # rounding must not lose a group
            go = (most + slack >= floor) & (np.asarray(b.column("cell"))[:, None] != ids)
            r, c = np.nonzero(go)
            yield pa.record_batch([b.column("id").take(pa.array(r)), b.column("vec").take(pa.array(r)), pa.array(ids[c]), b.column("floor").take(pa.array(r))], names=["q_id", "vec", "cell", "floor"])

    spread = known.mapInArrow(replicate, "q_id long, vec array<double>, cell int, floor long")
    found = near.unionByName(solve(stored(spread, "knn-spread")))
    return ranked(found).select(F.col("q_id").alias("query_id"), "rank", "id", "score")


def nearest_report(vectors: DataFrame) -> DataFrame:
    """The five best of each vector whose id is divisible by 50."""
    return top_k(vectors, F.col("vec_id") % 50 == 0, 5).withColumnRenamed("id", "vec_id")
