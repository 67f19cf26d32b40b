"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of PASSAGE words. Each passage is described by FEATURES (character classes, word
shapes, repetition) and encoded by a dense layer h. A gate softmax(w . (tanh(V h) * sigmoid(U h))) weighs the
passages, and a logistic layer scores the weighted sum of their codes. Encoder, gate and scorer are learned
together from document labels alone (Adam on the log loss).

The model is fitted on the driver from the features of at most about `sample_rows` labelled documents and MOST_PASSAGES
passages; every text is then scored where it is read, whole, with no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.language_id import remainder
from docketry.llm.shared import bounded_batches
from docketry.llm.textbytes import NOT_WHITE, buffers, chunks, words

PASSAGE = 64
SAMPLE_ROWS, MOST_PASSAGES = 6000, 400_000
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.01, 1e-4
THRESHOLD = 0.3

# Byte classes whose shares describe a passage; all other bytes are class 0.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "\n", " ", ".", ",", "|", "!?", "*#$%&", "<>{}[]()=/\\", "'\"-:;@_")
_CLASS = np.zeros(256, np.int64)
for _k, _c in enumerate(_CLASSES, 1):
    _CLASS[list(_c.encode())] = _k
_CLASS[128:] = len(_CLASSES) + 1
N_CLASSES = len(_CLASSES) + 2
FEATURES = N_CLASSES + 8


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, passages of each text); a text without words has one passage of zeros."""
    w = words(texts, NOT_WHITE)
    raw, at = buffers(texts)
    n_words = w.counts
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    first_pass = np.cumsum(n_pass) - n_pass
    total = int(n_pass.sum())
    x = np.zeros((total, FEATURES))
    n = len(w.hash)
    if not n:
        return x, n_pass
    text = np.repeat(np.arange(len(n_words)), n_words)
    own = first_pass[text] + (np.arange(n) - w.first[text]) // PASSAGE
    opens = np.flatnonzero(np.diff(own, prepend=-1))
    which = own[opens]
    last = np.append(opens[1:], n) - 1
    begin, end = w.start[opens], w.end[last]

    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, begin, which + 1)
    np.add.at(edge, end, -(which + 1))
    of_byte = np.cumsum(edge[:-1])  # 1 + passage, 0 between passages
    shares = np.bincount(of_byte * N_CLASSES + _CLASS[raw], minlength=(total + 1) * N_CLASSES)[N_CLASSES:].reshape(total, N_CLASSES)
    x[:, :N_CLASSES] = shares / np.maximum(1, shares.sum(axis=1, keepdims=True))

    count = np.bincount(own, minlength=total).astype(float)
    full = np.maximum(count, 1)
    length = np.minimum(w.end - w.start, 40).astype(float)
    mean = np.bincount(own, length, total) / full
    order = np.lexsort((w.hash, text))
    h, t, p = w.hash[order], text[order], own[order]
    new_word = np.ones(n, bool)
    new_word[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    new_here = new_word.copy()
    new_here[1:] |= p[1:] != p[:-1]
    f = N_CLASSES
    x[:, f] = mean / 10
    x[:, f + 1] = np.sqrt(np.maximum(0, np.bincount(own, length**2, total) / full - mean**2)) / 10
    x[:, f + 2] = np.bincount(p, new_here, total) / full
    x[:, f + 3] = np.bincount(p, new_word, total) / full
    x[:, f + 4] = np.bincount(own, length <= 3, total) / full
    x[:, f + 5] = np.bincount(own, length >= 20, total) / full
    x[:, f + 6] = np.log1p(count) / 4
    x[:, f + 7] = np.repeat(np.log1p(n_words), n_pass) / 8
    return x, n_pass


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class AttentionModel:
    """Weights: encoder w, b; gate v, u, g; scorer s, c; and the scaling of the features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Logit of each bag, and what backward() needs."""
        p = self.weights
        starts = np.cumsum(sizes) - sizes
        bag = np.repeat(np.arange(len(sizes)), sizes)
        h = np.tanh(x @ p["w"] + p["b"])
        a, b = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (a * b) @ p["g"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        weight = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(weight[:, None] * h, starts, axis=0)
        return z @ p["s"] + p["c"][0], {"x": x, "starts": starts, "bag": bag, "h": h, "a": a, "b": b, "weight": weight, "z": z}

    def backward(self, d_logit: np.ndarray, t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        p, bag, h, a, b, weight = self.weights, t["bag"], t["h"], t["a"], t["b"], t["weight"]
        d_z = d_logit[:, None] * p["s"]
        d_weight = (d_z[bag] * h).sum(axis=1)
        d_e = weight * (d_weight - np.add.reduceat(weight * d_weight, t["starts"])[bag])
        d_ab = d_e[:, None] * p["g"]
        d_a, d_b = d_ab * b * (1 - a**2), d_ab * a * b * (1 - b)
        d_h = (weight[:, None] * d_z[bag] + d_a @ p["v"].T + d_b @ p["u"].T) * (1 - h**2)
        return {"w": t["x"].T @ d_h, "b": d_h.sum(axis=0), "v": h.T @ d_a, "u": h.T @ d_b, "g": (a * b).T @ d_e, "s": t["z"].T @ d_logit, "c": np.array([d_logit.sum()])}

    @classmethod
    def fit(cls, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, seed: int = 7) -> AttentionModel:
        """Adam on the log loss of the bags' labels; without both labels, a constant score."""
        rng = np.random.default_rng(seed)
        n = x.shape[1]
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        weights = {"w": rng.normal(0, n**-0.5, (n, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "g": rng.normal(0, GATE**-0.5, GATE), "s": np.zeros(HIDDEN), "c": np.array([math.log(share / (1 - share))])}
        model = cls(x.mean(axis=0) if len(x) else np.zeros(n), np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(n), weights)
        if len(set(labels.tolist())) < 2:
            return model
        x = np.clip((x - model.mean) / model.scale, -8, 8)
        starts = np.cumsum(sizes) - sizes
        first = {k: np.zeros_like(v) for k, v in weights.items()}
        second = {k: np.zeros_like(v) for k, v in weights.items()}
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * 0.5 * (1 + math.cos(math.pi * epoch / EPOCHS))
            order = rng.permutation(len(sizes))
            for lo in range(0, len(order), BATCH):
                own = order[lo : lo + BATCH]
                rows = np.concatenate([np.arange(starts[i], starts[i] + sizes[i]) for i in own])
                logit, trace = model.forward(x[rows], sizes[own])
                grads = model.backward((_sigmoid(logit) - labels[own]) / len(own), trace)
                step += 1
                for k, g in grads.items():
                    g = g + DECAY * weights[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    weights[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return model

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each bag."""
        return _sigmoid(self.forward(np.clip((x - self.mean) / self.scale, -8, 8), sizes)[0])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi in chunks(b.column(0)):
            x, sizes = passages(b.column(0)[lo:hi])
            ends = pa.array(np.append(0, np.cumsum(sizes) * FEATURES), pa.int32())
            yield pa.record_batch([pa.ListArray.from_arrays(ends, pa.array(x.astype(np.float32).ravel())), b.column(1)[lo:hi], b.column(2)[lo:hi], pa.array(sizes, pa.int64())], names=["x", "label", "h", "n"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> AttentionModel:
    """A model of about sample_rows labelled documents (all, if fewer), chosen by a hash of their id.

    Rows with a null id or label are passed over; a document with several labels counts with the highest, and one of
    several texts with the first by their hash. In the order of a hash of the id, documents count while they have
    MOST_PASSAGES passages at most, and the first in any case.
    """
    labels = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(id_col, label_col)
    one_in = max(1, math.ceil(labels.count() / sample_rows))
    chosen = labels.where(F.pmod(F.xxhash64(id_col), F.lit(one_in)) == 0).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("double").alias("label"))
    # About sample_rows rows by construction (and as many with the same hash of an id, which is one), hence the broadcast.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    one = Window.partitionBy("id").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("rank", F.row_number().over(one)).where("rank = 1").select("text", "label", F.xxhash64("id").alias("h"))
    featured = bounded_batches(rows).mapInArrow(_featured, "x array<float>, label double, h long, n long")
    before = F.coalesce(F.sum("n").over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # of the sample only
    got = featured.withColumn("before", before).where((F.col("before") == 0) | (F.col("before") + F.col("n") <= MOST_PASSAGES)).select("x", "label").toArrow()
    lists = got.column("x").combine_chunks()
    x = np.asarray(lists.flatten(), float).reshape(-1, FEATURES)
    sizes = np.asarray(lists.value_lengths(), np.int64) // FEATURES
    return AttentionModel.fit(x, sizes, np.asarray(got.column("label"), float))


def score_quality(docs: DataFrame, model: AttentionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of docs; a null or empty text has the score of a passage without words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                yield pa.record_batch([b.column(0)[lo:hi], pa.array(m.score(*passages(b.column(1)[lo:hi])))], names=["id", "score"])

    return bounded_batches(rows).mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document by a model of the labels outside the held-out fifth (remainder 0)."""
    held_out = remainder("doc_id", 5) == 0
    model = fit_quality(docs, labels.where(~held_out))
    return score_quality(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
