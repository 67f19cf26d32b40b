"""Language identification: known words first, then ever shorter character n-grams.

A model holds, for each language, log frequencies of words and of character n-grams of LONGEST to 1 letters. A
word of a text that the model knows adds its log frequencies; any other word is cut from left to right into the
longest known n-grams and adds their mean. The language with the highest sum wins, and its share after a softmax
of the mean per word is the score.

The model is fitted on a bounded sample: of each language at most `rows_per_lang` rows and about `bytes_per_lang`
bytes of text, in the order of a hash of their id, for all languages there are. Words and n-grams are counted by
tasks, and only those that the model keeps reach the driver. The model goes to the executors once, and texts are scored
where they are read, with no shuffle: the distinct words of a batch are looked up once, and a text's sum is taken by
array operations.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.shared import bounded_batches, stored, tidy
from docketry.llm.textbytes import buffers, chunks, words
from docketry.session import small

UNKNOWN = "und"
ROWS_PER_LANG = 1000
BYTES_PER_LANG = 16 << 20
MOST_WORDS = 60_000
MOST_GRAMS = 40_000
LONGEST = 5
SHARPNESS = 4.0
#: Words a task remembers beside those of the model, and sums that are taken at once.
MEMO, SUMS = 300_000, 1 << 22
#: Bytes of a word's run: ASCII letters and all of other characters; what of the latter is no letter parts words.
_RUN = np.zeros(256, bool)
_RUN[0x61:0x7B] = _RUN[0x80:] = True

_WORD = re.compile(r"[^\W\d_]+")


def word_counts(text: str | None) -> Counter[str]:
    """The text's words (runs of letters, lower case); empty if it has no letter."""
    counts = Counter(_WORD.findall((text or "").lower()))
    return counts if any(c.isalpha() for w in counts for c in w) else Counter()


@dataclass
class LanguageModel:
    """Log frequencies of words and n-grams: their rows in two tables, a column per language."""

    langs: list[str]
    words: dict[str, int]
    word_logs: np.ndarray
    grams: dict[str, int]
    gram_logs: np.ndarray
    memo: dict[int, int] = field(default_factory=dict)
    sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    counts: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))

    def pieces(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of a word from left to right."""
        parts, i, n, get = [], 0, len(word), self.grams.get
        while i < n:
            for j in range(min(i + LONGEST, n), i, -1):
                if (k := get(word[i:j])) is not None:
                    parts.append(k)
                    i = j
                    break
            else:
                i += 1
        return parts

    def _learn(self, hashes: list[int], runs: list[bytes]) -> None:
        """Keep what runs of letters add to a text: the sum of their words' rows, how many words, and how many with a letter.

        A known word's row is its own; any other has the mean of its pieces, or zeros if none is known.
        """
        if len(self.memo) + len(hashes) > len(self.words) + MEMO:
            self.memo = {}
        n = len(self.memo)
        if n + len(hashes) > len(self.sums):
            grown = max(2 * len(self.sums), n + len(hashes))
            self.sums = np.resize(self.sums, (grown, len(self.langs))) if n else np.zeros((grown, len(self.langs)))
            self.counts = np.resize(self.counts, (grown, 2))
        known, of_known, parts, sizes, of_new = [], [], [], [], []
        self.counts[n : n + len(hashes)] = 0
        for i, (h, run) in enumerate(zip(hashes, runs, strict=True), n):
            self.memo[h] = i
            if run.isascii():
                found = [run.decode().lower()]
                self.counts[i] = 1
            else:
                found = _WORD.findall(run.decode().lower())
                self.counts[i] = len(found), sum(any(c.isalpha() for c in w) for w in found)
            for w in found:
                if (k := self.words.get(w)) is not None:
                    known.append(k)
                    of_known.append(i)
                elif p := self.pieces(w):
                    parts += p
                    sizes.append(len(p))
                    of_new.append(i)
        self.sums[n : n + len(hashes)] = 0
        np.add.at(self.sums, np.array(of_known, np.int64), self.word_logs[known])
        if of_new:
            size = np.array(sizes)
            means = np.add.reduceat(self.gram_logs[parts], np.cumsum(size) - size, axis=0) / size[:, None]
            np.add.at(self.sums, np.array(of_new, np.int64), means)

    def predict_all(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text; UNKNOWN and 0 for one without letters, or if no language was learned."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        w = words(texts, _RUN)
        hashes, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
        listed = hashes.tolist()
        if len(self.memo) + len(listed) > len(self.words) + MEMO:
            self.memo = {}
        if new := [i for i, h in enumerate(listed) if h not in self.memo]:
            raw, _ = buffers(texts)  # before lower-casing, which depends on the letters around
            at = first[new]
            self._learn([listed[i] for i in new], [raw[a:b].tobytes() for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)])
        row = np.array([self.memo[h] for h in listed], np.int64)[which] if listed else np.zeros(0, np.int64)
        sums, counts = np.zeros((len(texts), len(self.langs))), np.zeros((len(texts), 2), np.int64)
        full = np.flatnonzero(w.counts > 0)
        step = max(1, SUMS // len(self.langs))
        lo = 0
        while lo < len(full):  # texts of about `step` words; of a longer one, parts
            hi = max(lo + 1, int(np.searchsorted(w.first, w.first[full[lo]] + step, "right")))
            hi = min(int(np.searchsorted(full, hi)), len(full)) if hi > full[lo] + 1 else lo + 1
            hi = max(hi, lo + 1)
            a, b = w.first[full[lo]], w.first[full[hi - 1] + 1]
            if hi == lo + 1:
                for k in range(a, b, step):
                    sums[full[lo]] += self.sums[row[k : min(b, k + step)]].sum(axis=0)
                    counts[full[lo]] += self.counts[row[k : min(b, k + step)]].sum(axis=0)
            else:
                starts = w.first[full[lo:hi]] - a
                sums[full[lo:hi]] = np.add.reduceat(self.sums[row[a:b]], starts, axis=0)
                counts[full[lo:hi]] = np.add.reduceat(self.counts[row[a:b]], starts, axis=0)
            lo = hi
        mean = SHARPNESS * sums / np.maximum(counts[:, :1], 1)
        best = mean.argmax(axis=1)
        score = 1 / np.exp(mean - mean.max(axis=1, keepdims=True)).sum(axis=1)
        known = counts[:, 1] > 0
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, score, 0.0)

    def predict(self, text: str | None) -> tuple[str, float]:
        langs, scores = self.predict_all(pa.array([text], pa.string()))
        return langs[0], float(scores[0])


def remainder(id_col: str, n: int) -> Column:
    """CRC-32 of the id as text modulo n."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: Counter[tuple[str, str]] = Counter()
        for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for w, n in word_counts(text).items():
                counts[lang, w] += n
        yield pa.record_batch([pa.array([x for x, _ in counts], pa.string()), pa.array([x for _, x in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "key", "n"])


def _logs(counts: DataFrame, langs: list[str], most: int) -> tuple[dict[str, int], np.ndarray]:
    """Of each kind the `most` commonest keys, and their smoothed log frequencies: a row per key, a column per language.

    counts: kind, key, lang, n, dealt by kind and key, with repeated rows to be added. At most `most` rows of a kind reach
    the driver, each with its counts by language.
    """
    one = counts.groupBy("kind", "key", "lang").agg(F.sum("n").alias("n"))
    keyed = stored(one.groupBy("kind", "key").agg(F.sum("n").alias("total"), F.collect_list("lang").alias("langs"), F.collect_list("n").alias("counts")), "language-keys")
    sums = {(r["kind"], r["lang"]): r["n"] for r in keyed.select("kind", F.explode(F.arrays_zip("langs", "counts")).alias("x")).groupBy("kind", F.col("x.langs").alias("lang")).agg(F.sum("x.counts").alias("n")).collect()}
    order = Window.partitionBy("kind").orderBy(F.desc("total"), "key")
    got = keyed.where("total > 1").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("kind", "rank", "key", "langs", "counts").toArrow()
    got = got.sort_by([("kind", "ascending"), ("rank", "ascending")]).combine_chunks()
    at = {x: i for i, x in enumerate(langs)}
    table = np.zeros((got.num_rows, len(langs)))
    if got.num_rows:
        own, n = got.column("langs").combine_chunks(), got.column("counts").combine_chunks()
        row = np.repeat(np.arange(got.num_rows), np.asarray(own.value_lengths()))
        table[row, [at[x] for x in own.flatten().to_pylist()]] = np.asarray(n.flatten())
    of_kind = np.asarray(got.column("kind"))
    for k in np.unique(of_kind).tolist():
        own = of_kind == k
        whole = np.array([sums.get((k, x), 0) for x in langs], float)
        table[own] = np.log((table[own] + 0.5) / (whole + 0.5 * (own.sum() + 1)))
    return {x: i for i, x in enumerate(got.column("key").to_pylist())}, table


def fit_languages(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG, bytes_per_lang: int = BYTES_PER_LANG) -> LanguageModel:
    """A model of the rows of docs where `train` holds and a language and a text are given.

    All such rows are counted by language; of each, rows_per_lang at most are read (fewer once their texts have
    bytes_per_lang bytes, but one in any case), in the order of a hash of id and text. Rows that repeat count each.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    langs = sorted(r["lang"] for r in counts.select("lang").collect())  # a row per language, which the model holds anyway
    if not langs:
        return LanguageModel([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    # About the rows wanted, by their hash; then no more than these, however often an id repeats.
    some = rows.join(small(counts), "lang").where(F.pmod("h", F.ceil(F.col("n") / F.lit(rows_per_lang))) == 0).withColumn("t", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy("h", "t")
    ranked = some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows_per_lang)
    size = F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    sample = ranked.withColumn("size", size).where((F.col("rank") == 1) | (F.col("size") <= bytes_per_lang)).select("text", "lang")
    n = docs.sparkSession.sparkContext.defaultParallelism  # little data, but work enough for all cores
    counted = bounded_batches(sample.repartition(n, F.xxhash64("text"))).mapInArrow(tidy(_count_words), "lang string, key string, n long")
    of_words = stored(counted, "language-words")
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.char_length("key")))).alias("kind")
    of_words = of_words.withColumn("kind", F.lit(0)).repartition(n, "kind", "key")
    pieces = of_words.select("lang", "key", "n", lengths).select("lang", "kind", "n", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("key") - F.col("kind") + 1), lambda i: F.substring("key", i, F.col("kind")))).alias("key"))
    return LanguageModel(langs, *_logs(of_words, langs, MOST_WORDS), *_logs(pieces.repartition(n, "kind", "key"), langs, MOST_GRAMS))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """(id, columns to keep, language, score) for every row of docs; a null or letterless text is `und` with score 0.

    `names` are those of the last two columns; they must not be among the kept ones. Repeated rows each give a row.
    """
    kept = [id_col, *(c for c in keep or [] if c != id_col)]
    own = text_col in kept  # then the text goes over once
    at = kept.index(text_col) if own else len(kept)
    # Columns go over under names of their own, so none of docs can clash.
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), *([] if own else [F.col(text_col).alias(f"c{at}")]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for lo, hi in chunks(b.column(at)):
                langs, scores = m.predict_all(b.column(at)[lo:hi])
                yield pa.record_batch([*(c[lo:hi] for c in b.columns[: len(kept)]), pa.array(langs, pa.string()), pa.array(scores)], names=[*(f"c{i}" for i in range(len(kept))), "lang", "score"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(kept)])
    out = bounded_batches(rows).mapInArrow(tidy(predict), f"{fields}, lang string, score double")
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.col("lang").alias(names[0]), F.col("score").alias(names[1]))


def language_report(docs: DataFrame) -> DataFrame:
    """Prediction of every document by a model of those outside the held-out quarter (remainder 2)."""
    held_out = remainder("doc_id", 4) == 2
    model = fit_languages(docs, ~held_out)
    return identify(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")
