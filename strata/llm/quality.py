"""Quality classifier on random-indexing word vectors (operator 7).

Every word (hashed to one of ``ROWS`` rows) owns a sparse random index
vector; its context vector is the sum of its neighbours' index vectors over
the whole corpus. A text is pooled to the mean context vector of its words,
with four numbers on how its index vectors repeat, and a two-layer network,
fitted with NumPy on labelled rows and calibrated by a temperature, turns
this into a probability.

The context matrix has a fixed size (``ROWS`` x ``WIDTH``), so what tasks add
up, the driver holds and workers receive does not grow with the corpus.

Defined results: null and empty texts pool to zeros and are scored like the
others; labels with a null id or class are unused, several labels of one id
count as their smallest; without labelled rows of both classes every score
is the share of good labels (1 where there are none). Only the text is an
input of a score. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import bitmap, in_batches, marked, saved

ROWS = 1 << 14          # of the context matrix; words that share a row share a vector
WIDTH = 64              # of a vector
MARKS = 4               # non-zero places of an index vector
REACH = 2               # neighbours on each side
PARTS = 64              # pieces of the matrix that are added up side by side
TRAIN_ROWS = 20_000     # labelled rows that the network is fitted on, at most
HIDDEN = 32
THRESHOLD = 0.3
_EXTRA = 4
_KIND, _VALUE = W.kinds("runs"), W.values(False)


@cache
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every row's index vector."""
    rng = np.random.default_rng(5)
    places = np.argsort(rng.random((ROWS, WIDTH)), axis=1)[:, :MARKS].astype(np.int64)
    return places, rng.choice(np.array([-1.0, 1.0], np.float32), (ROWS, MARKS))


@cache
def index_matrix() -> np.ndarray:
    places, signs = index_vectors()
    out = np.zeros((ROWS, WIDTH), np.float32)
    np.put_along_axis(out, places, signs, axis=1)
    return out


def _rows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, data, offsets in W.slices(texts):
        hashes, at = W.words(data, offsets, _KIND, _VALUE)
        yield (hashes % np.uint64(ROWS)).astype(np.int64), at


def context_matrix(texts: DataFrame) -> np.ndarray:
    """Sum of neighbours' index vectors per row, over all of ``texts(text)``.

    A task adds up its own matrix; pieces of all tasks are summed as a stream
    by piece, and only the finished matrix reaches the driver.
    """
    cells = ROWS * WIDTH // PARTS

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(ROWS * WIDTH)
        for batch in batches:
            for rows, offsets in _rows(batch.column(0)):
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
                for d in range(1, REACH + 1):
                    a, b = rows[:-d], rows[d:]
                    near = doc[:-d] == doc[d:]
                    a, b = a[near], b[near]
                    for word, other in ((a, b), (b, a)):
                        for k in range(MARKS):
                            total += np.bincount(word * WIDTH + places[other, k],
                                                 signs[other, k], ROWS * WIDTH)
        pieces = total.astype(np.float32).reshape(PARTS, cells)
        used = [i for i in range(PARTS) if pieces[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([pieces[i].tobytes() for i in used], pa.binary())],
            ["part", "cells"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                piece = np.frombuffer(data.as_buffer(), np.float32)
                sums[part] = sums[part] + piece if part in sums else piece.astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()),
             pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["part", "cells"])

    schema = "part int, cells binary"
    out = np.zeros((PARTS, cells))
    # tasks are first summed in a few lanes each, then the lanes: no reducer
    # reads one piece of every task
    lanes = in_batches(texts, gather, schema).withColumn("lane", F.spark_partition_id() % 64)
    halves = lanes.repartition(PARTS, "part", "lane").select("part", "cells") \
        .mapInArrow(lambda b: _narrow(add(b)), schema)
    for r in halves.repartition(PARTS, "part").mapInArrow(add, schema).collect():
        out[r["part"]] += np.frombuffer(r["cells"], np.float64)
    return out.reshape(ROWS, WIDTH)


def _narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cells = [np.frombuffer(x.as_buffer(), np.float64).astype(np.float32).tobytes()
                 for x in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cells, pa.binary())],
                                         ["part", "cells"])


def word_vectors(contexts: np.ndarray) -> np.ndarray:
    """Unit vectors of the words' contexts, with the direction common to all words taken out."""
    size = np.linalg.norm(contexts, axis=1, keepdims=True)
    unit = contexts / np.maximum(size, 1e-9)
    unit = unit - unit[size[:, 0] > 0].mean(axis=0) if (size > 0).any() else unit
    unit[size[:, 0] == 0] = 0
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(rows: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """One feature vector per document: mean context vector and how its words repeat."""
    n = np.diff(offsets)
    out = np.zeros((len(n), WIDTH + _EXTRA), np.float32)
    filled = n > 0
    starts = offsets[:-1][filled]
    if not len(starts):
        return out
    count = n[filled][:, None].astype(np.float32)
    out[filled, :WIDTH] = np.add.reduceat(vectors[rows], starts, axis=0) / count
    # mean index vector: its squared length is the chance that two words agree
    mean = np.add.reduceat(index_matrix()[rows], starts, axis=0) / count
    out[filled, WIDTH] = np.sqrt((mean * mean).sum(axis=1) / MARKS)
    same = np.zeros(len(rows), np.float32)
    same[1:] = rows[1:] == rows[:-1]
    same[starts] = 0
    out[filled, WIDTH + 1] = np.add.reduceat(same, starts) / count[:, 0]
    skip = np.zeros(len(rows), np.float32)
    skip[2:] = rows[2:] == rows[:-2]
    skip[starts] = 0
    skip[np.minimum(starts + 1, len(rows) - 1)] *= (n[filled] == 1)
    out[filled, WIDTH + 2] = np.add.reduceat(skip, starts) / count[:, 0]
    out[filled, WIDTH + 3] = np.log1p(count[:, 0]) / 10
    return out


def _features(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    parts = [pool(r, o, vectors) for r, o in _rows(column)]
    return np.concatenate(parts) if parts else np.zeros((0, WIDTH + _EXTRA), np.float32)


class Network:
    """Two layers, probabilities at a fitted temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60,
                 seed: int = 3):
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(y))
        held = order[:max(1, len(y) // 5)]          # for the temperature
        fit = order[len(held):] if len(y) > len(held) else order
        self.mean, self.scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        base = np.log((y[fit].sum() + 0.5) / (len(fit) - y[fit].sum() + 0.5))
        self.w = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, (1 / hidden) ** 0.5, hidden), np.array(base)]
        m, v, step = [0.0] * 4, [0.0] * 4, 0
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
                step += 1
                h = np.maximum(z[part] @ self.w[0] + self.w[1], 0)
                p = 1 / (1 + np.exp(-np.clip(h @ self.w[2] + self.w[3], -30, 30)))
                d = (p - y[part]) / len(part)
                back = np.outer(d, self.w[2]) * (h > 0)
                grads = [z[part].T @ back + 1e-4 * self.w[0], back.sum(axis=0),
                         h.T @ d + 1e-4 * self.w[2], d.sum()]
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - 0.003 * (m[i] / (1 - 0.9 ** step)) \
                        / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        self.temperature = 1.0
        logit, t = self.logit(x[held]), y[held]
        loss = {k: np.logaddexp(0, np.where(t > 0, -logit, logit) / k).mean()
                for k in np.exp(np.linspace(np.log(0.5), np.log(8), 57))}
        self.temperature = min(loss, key=loss.get)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -20, 20)
        return np.maximum(z @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))


class Classifier:
    """A fitted network with its word vectors: an object of fixed size that is sent to the workers."""

    def __init__(self, vectors: np.ndarray, network: Network | None, rate: float):
        self.vectors, self.network, self.rate = vectors, network, rate

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(column), self.rate)
        return self.network.probability(_features(column, self.vectors).astype(np.float64))


def fit(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column],
        id_col: str = "doc_id", text_col: str = "text", class_col: str = "quality") -> Classifier:
    """Word vectors from all of ``docs``, a network from labelled rows that ``learn`` takes by id.

    At most ``TRAIN_ROWS`` labelled rows, those whose id hashes lowest, reach
    the driver, as pooled features.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    vectors = word_vectors(context_matrix(texts))
    marks = labels.select(F.col(f"`{id_col}`").alias("lid"),
                          F.col(f"`{class_col}`").cast("int").alias("class")) \
        .where("lid is not null and class in (0, 1)").groupBy("lid").agg(F.min("class").alias("class")) \
        .where(learn(F.col("lid"))).withColumn("h", F.xxhash64("lid"))
    chosen = saved(marks.orderBy("h", "lid").limit(TRAIN_ROWS))
    if not chosen.where("class = 0").limit(1).count() or not chosen.where("class = 1").limit(1).count():
        return Classifier(vectors, None, float(chosen.agg(F.avg("class")).first()[0] or 0)
                          if not chosen.isEmpty() else 1.0)
    sent = spark.sparkContext.broadcast((bitmap(chosen, "h", 1 << 23), vectors))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, known = sent.value
        for batch in batches:
            batch = batch.filter(pa.array(marked(near, batch.column(0).to_numpy())))
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _features(part.column(1), known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([v.tobytes() for v in x], pa.binary())], ["key", "x"])

    keyed = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.xxhash64(F.col(f"`{id_col}`")).alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pooled = in_batches(keyed, run, "key bigint, x binary")
    # rows that repeat an id count once, the least of them
    rows = pooled.join(chosen, F.col("key") == F.col("h")).groupBy("lid").agg(
        F.min("x").alias("x"), F.min("class").alias("class")).orderBy("lid").toArrow()
    y = rows["class"].to_numpy().astype(float)
    if not len(y) or y.sum() in (0, len(y)):
        return Classifier(vectors, None, float(y.mean()) if len(y) else 1.0)
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), "<f4").reshape(len(y), -1).astype(np.float64)
    return Classifier(vectors, Network(x, y), float(y.mean()))


def score_quality(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` per row of ``docs``; nothing moves."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sent.value.scores(batch.column(1)))], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_batches(rows, run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, classifier: Classifier, text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they were."""
    sent = docs.sparkSession.sparkContext.broadcast(classifier)
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(sent.value.scores(batch.column(at)) >= threshold))

    return in_batches(docs, run, docs.schema)
