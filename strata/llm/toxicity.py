"""Toxicity by class-conditional Kneser-Ney models (operator 4).

A word's weight in a class is its Kneser-Ney continuation count: the number
of distinct words it follows in that class's labelled texts, less a discount.
Copies of a text repeat contexts and so add nothing. The discounted mass goes
to one shared backoff distribution (distinct contexts over both classes), and
a rare word, seen in fewer than ``RARE`` contexts, is left to it altogether.

A text's toxic and ordinary likelihoods are compared word by word, and the
ratios' power mean (exponent ``POWER``) is its length-normalised difference:
a few strongly toxic words in a long text still show, which a plain mean of
log-likelihoods buries. A logistic curve, fitted on labelled rows that the
counts leave out, turns the mean's logarithm into a probability.

Defined results: null and empty texts and texts of a single word are scored
like the others (no word: the weight of an unknown word); labels with a null
id or class are unused, several labels of one id count as their largest; rows
with a null id are scored, never learned from; without labelled rows of both
classes every score is the share of toxic labels (0 where there are none).
Only the text is an input of a score. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from strata.llm import words as W
from strata.llm.common import bitmap, bitmap_bits, id_fold, marked, saved

DISCOUNT = 0.75
RARE = 3                        # contexts a word needs for class counts of its own
POWER = 2.0                     # of the mean over a text's words
THRESHOLD = 0.3
CALIBRATION_ROWS = 20_000       # labelled rows that the curve is fitted on, at most
MODEL_WORDS = 5_000_000         # words (12 bytes each) sent to every worker, at most
MERGED_ROWS = 1 << 20           # pairs (17 bytes each) that a task merges before they move
BATCH_ROWS = 1 << 16
SENT_LABELS = 5_000_000         # labels (9 bytes each) sent to every worker, at most
Marks = Callable[[pa.RecordBatch], tuple[pa.Array, np.ndarray]]
_KIND, _VALUE = W.kinds("letters"), W.values(False)


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, data, offsets in W.slices(pc.utf8_lower(texts)):
        yield first, *W.words(data, offsets, _KIND, _VALUE)


def _text(df: DataFrame, text_col: str) -> Column:
    return F.col(f"`{text_col}`").cast("string")


# --- counts -----------------------------------------------------------------

def _merged(word: np.ndarray, pair: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each (word, pair) once with all its bits, in order."""
    order = np.lexsort((pair, word))
    word, pair, bits = word[order], pair[order], bits[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return word[at], pair[at], np.bitwise_or.reduceat(bits, at) if len(at) else bits


def _runs(parts: Iterable[tuple[np.ndarray, ...]], most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Merged runs of ``parts``; up to ``most`` rows (and a part) wait to be merged."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows > most:
            run = _merged(*map(np.concatenate, zip(*held)))
            held, rows = [run], len(run[0])
            if rows > most // 2:        # few copies among them: they go on
                yield run
                held, rows = [], 0
    if held:
        yield _merged(*map(np.concatenate, zip(*held)))


def _own_class(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """Texts and classes of a batch ``(text, class)``."""
    return batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)


def _pairs(labelled: Iterable[tuple[pa.Array, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    """``(word, pair, bits)`` of the words of each slice of texts with their classes."""
    for texts, toxic in labelled:
        for first, hashes, offsets in _words(texts):
            if not len(hashes):
                continue
            before = np.empty_like(hashes)
            before[0], before[1:] = 0, hashes[:-1]
            starts = offsets[:-1]
            before[starts[starts < len(hashes)]] = 0
            bits = np.repeat(1 << toxic[first:first + len(offsets) - 1], np.diff(offsets)).astype(np.int8)
            yield _merged(hashes.view(np.int64), (W.mixed(before) ^ hashes).view(np.int64), bits)


def contexts(labelled: DataFrame, marks: Marks = _own_class, most: int = MERGED_ROWS) -> DataFrame:
    """``(word, pair, classes)`` of ``labelled(text, class)``: each word after each other word once.

    Rows of other columns need ``marks``, which finds texts and classes in a
    batch. ``classes`` has bit 0 for ordinary, bit 1 for toxic. Pairs are merged in
    the task and move in order, by ranges of word and pair: equal words stand
    side by side, which compresses well, and lie in one partition or, where
    they follow very many words, in a few neighbouring ones. So the counts
    per word that move next are hardly more than the words.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for word, pair, bits in _runs(_pairs(map(marks, batches)), most):
            for a in range(0, len(word), BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(x[a:a + BATCH_ROWS]) for x in (word, pair, bits)],
                                                 ["word", "pair", "classes"])

    rows = labelled.mapInArrow(run, "word bigint, pair bigint, classes tinyint")
    return rows.repartitionByRange("word", "pair") \
        .groupBy("word", "pair").agg(F.bit_or("classes").alias("classes"))


@dataclass(frozen=True)
class Model:
    """Totals of the two classes and the weight of every word that is not rare."""
    weights: DataFrame      # (word, weight): log-likelihood difference
    unknown: float          # weight of any other word
    size: int


def fit_counts(labelled: DataFrame, marks: Marks = _own_class, discount: float = DISCOUNT,
               rare: int = RARE) -> Model | None:
    """Kneser-Ney over all rows of ``contexts(labelled, marks)``; None without words in both classes."""
    counts = saved(contexts(labelled, marks).groupBy("word").agg(
        F.sum(F.shiftright("classes", 1).cast("bigint")).alias("toxic"),
        F.sum(F.col("classes").bitwiseAND(F.lit(1)).cast("bigint")).alias("plain"),
        F.count(F.lit(1)).alias("both")))
    known = F.col("toxic") + F.col("plain") >= rare

    def kept(c: str) -> Column:
        return F.when(known, F.greatest(F.col(c) - F.lit(discount), F.lit(0.0))).otherwise(0.0)

    total = counts.agg(F.sum("toxic").alias("t"), F.sum("plain").alias("p"), F.sum("both").alias("b"),
                       F.sum(kept("toxic")).alias("kt"), F.sum(kept("plain")).alias("kp"),
                       F.count(F.lit(1)).alias("v")).first()
    if not total["t"] or not total["p"]:
        return None
    back_t, back_p = 1 - total["kt"] / total["t"], 1 - total["kp"] / total["p"]
    # one more context for every word, and one word never seen
    shared = (F.col("both") + 1) / F.lit(float(total["b"] + total["v"] + 1))
    weight = F.log(kept("toxic") / F.lit(float(total["t"])) + F.lit(back_t) * shared) \
        - F.log(kept("plain") / F.lit(float(total["p"])) + F.lit(back_p) * shared)
    weights = saved(counts.where(known).select("word", weight.alias("weight")))
    return Model(weights, math.log(back_t / back_p), weights.count())


# --- scores -----------------------------------------------------------------

def _mean(x: np.ndarray, offsets: np.ndarray, unknown: float, power: float) -> np.ndarray:
    """Logarithm of the power mean of the likelihood ratios ``exp(x)`` of each document."""
    n = np.diff(offsets)
    out = np.full(len(n), unknown)
    filled = n > 0
    if filled.any():
        out[filled] = np.log(np.add.reduceat(np.exp(power * x), offsets[:-1][filled])
                             / n[filled]) / power
    return out


def text_scores(docs: DataFrame, model: Model, id_col: str, text_col: str,
                power: float = POWER, model_words: int = MODEL_WORDS) -> DataFrame:
    """``(doc_id, raw)`` of every row: the length-normalised log-likelihood difference.

    Up to ``model_words`` weights go to every worker as two arrays; a larger
    model stays distributed and words are joined to it, with equal results.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _text(docs, text_col).alias("text"))
    spark, unknown = docs.sparkSession, model.unknown
    if model.size > model_words:
        return _joined_scores(rows, model, power)
    table = model.weights.orderBy("word").toArrow()
    sent = spark.sparkContext.broadcast((table["word"].to_numpy(), table["weight"].to_numpy()))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weight = sent.value
        for batch in batches:
            out = []
            for _, hashes, offsets in _words(batch.column(1)):
                one, which = np.unique(hashes.view(np.int64), return_inverse=True)
                spot = np.minimum(np.searchsorted(known, one), max(0, len(known) - 1))
                w = np.where(known[spot] == one, weight[spot], unknown) if len(known) \
                    else np.full(len(one), unknown)
                out.append(_mean(w[which], offsets, unknown, power))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out))],
                                                 ["doc_id", "raw"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, raw double")


def _joined_scores(rows: DataFrame, model: Model, power: float) -> DataFrame:
    """Scores with the weights joined to the words; rows alike in id and text share a score.

    A text's words are counted in the task; partial sums meet by text.
    """
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for first, hashes, offsets in _words(batch.column(1)):
                for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    one, n = np.unique(hashes[a:b], return_counts=True)
                    if len(one):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(one), keys[first + i])),
                             pa.array(one.view(np.int64)), pa.array(n)], ["key", "word", "n"])

    keyed = rows.withColumn("key", F.xxhash64("text"))
    counts = keyed.select("key", "text").mapInArrow(count, "key bigint, word bigint, n bigint") \
        .distinct()
    ratio = F.exp(F.lit(power) * F.coalesce("weight", F.lit(model.unknown)))
    means = counts.join(model.weights, "word", "left").groupBy("key").agg(
        (F.log(F.sum(ratio * F.col("n")) / F.sum("n")) / F.lit(power)).alias("mean"))
    return keyed.select("doc_id", "key").join(means, "key", "left").select(
        "doc_id", F.coalesce("mean", F.lit(model.unknown)).alias("raw"))


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and intercept of a logistic curve (Newton steps, a weak pull towards 1 and the base rate)."""
    base = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    a, b = 1.0, base - x.mean()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        w = np.maximum(p * (1 - p), 1e-9)
        pull = 0.1
        g = np.array([(x * (p - y)).sum() + pull * (a - 1), (p - y).sum() + pull * (b - base)])
        h = np.array([[(w * x * x).sum() + pull, (w * x).sum()], [(w * x).sum(), w.sum() + pull]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def labelled_texts(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str,
                   sent_labels: int = SENT_LABELS) -> tuple[DataFrame, Marks]:
    """Rows of ``docs`` whose id is in ``classes(lid, class)``, as ``contexts`` takes them.

    Up to ``sent_labels`` labels of whole-number ids go to every worker as two
    arrays, and no text moves. Of more labels, or other ids, the texts that a
    bitmap lets through move to the labels, with equal results.
    """
    own = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("lid"), _text(docs, text_col).alias("text"))
    size, spark = classes.count(), docs.sparkSession
    whole = all(isinstance(df.schema["lid"].dataType, IntegralType) for df in (own, classes))
    if whole and size <= sent_labels:
        table = classes.select(F.col("lid").cast("bigint"), F.col("class").cast("tinyint")).orderBy("lid").toArrow()
        arrays = spark.sparkContext.broadcast((table["lid"].to_numpy(), table["class"].to_numpy()))

        def found(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
            ids, values = arrays.value
            lid = batch.column(0).to_numpy()
            at = np.searchsorted(ids, lid)
            near = np.flatnonzero(at < len(ids))
            hit = near[ids[at[near]] == lid[near]]
            return batch.column(1).take(pa.array(hit)), values[at[hit]]

        return own.select(F.col("lid").cast("bigint"), "text"), found

    sent = spark.sparkContext.broadcast(
        bitmap(classes.select(F.xxhash64("lid").alias("h")), "h", bitmap_bits(size)))

    def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(marked(sent.value, batch.column(0).to_numpy())))

    # only rows that may be labelled move to the labels
    hashed = own.select(F.xxhash64("lid").alias("h"), "lid", "text")
    return hashed.mapInArrow(labelled, hashed.schema).join(classes, "lid").select("text", "class"), _own_class


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column],
                   calibrate: Callable[[Column], Column], id_col: str = "doc_id",
                   text_col: str = "text", class_col: str = "toxic", sent_labels: int = SENT_LABELS,
                   **model_options) -> DataFrame:
    """``(doc_id, score)`` per row of ``docs``.

    ``learn`` and ``calibrate`` say by id which labelled rows give counts and
    which fit the curve. All of the former are counted; the latter are at most
    ``CALIBRATION_ROWS``, those whose id hashes lowest.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("lid"), F.col(f"`{class_col}`").cast("int").alias("class")) \
        .where("lid is not null and class in (0, 1)").groupBy("lid").agg(F.max("class").alias("class"))
    for_counts = marks.where(learn(F.col("lid")))
    near, found = labelled_texts(docs, for_counts, id_col, text_col, sent_labels)
    model = fit_counts(near, found, **model_options)
    rate = marks.where(learn(F.col("lid")) | calibrate(F.col("lid"))).agg(F.avg("class")).first()[0]
    if model is None:
        return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.lit(float(rate or 0)).alias("score"))
    raw = saved(text_scores(docs, model, id_col, text_col))
    fit = raw.join(marks.where(calibrate(F.col("lid"))), F.col("doc_id") == F.col("lid")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id", "raw").limit(CALIBRATION_ROWS) \
        .select("raw", "class").toPandas()
    x, y = fit["raw"].to_numpy(float), fit["class"].to_numpy(float)
    if len(y) == 0 or y.sum() in (0, len(y)):
        a, b = 4.0, -4.0        # too few rows for a curve: even odds at a difference of 1
    else:
        a, b = fit_curve(x, y)
    return raw.select("doc_id", (1 / (1 + F.exp(-(F.lit(a) * F.col("raw") + F.lit(b))))).alias("score"))


def predicted(score: str = "score", threshold: float = THRESHOLD) -> Column:
    return (F.col(score) >= threshold).cast("int")
