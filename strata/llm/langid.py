"""Language identification by prediction by partial matching (operator 11).

For every language a variable-order tree of byte contexts (orders 0 to 3, A-Z
and the capitals of Latin-1 lower-cased) holds frozen statistics of all its
labelled texts. A byte that a context knows costs ``-log2 n / (T + D)`` bits
(``n`` of the context's ``T`` bytes, ``D`` different ones); an unknown one
escapes to the context a byte shorter, which leaves out the bytes known to the
longer (exclusion), down to 256 equal bytes. The escape costs what the known
bytes leave, divided by what they leave there, so the probabilities of each
context sum to one and a text's code length is exact. The language with the
shortest code wins, ties by name.

1. Tasks count the four-byte grams of their texts per language; Spark sums
   them up and derives the shorter grams. Nothing is sampled.
2. A tree keeps the grams that make up at least ``langs ** 2 / CELLS`` of
   their language's bytes; the rest goes into the escapes. So whatever the
   input, at most ``CELLS`` costs per order (gram times language, 4 MiB) reach
   the driver and the workers.
3. Workers look up each byte's longest known gram in one hash table for all
   languages: one pass over the text, in numpy. Costs are integers (2**-16
   bits), so equal texts have equal lengths however they are sliced.

Defined results: a text that is null or has no letter (Unicode) is ``und`` with
score 0, and so is every text where no language was learned; other texts get a
learned language. ``score`` is the share that the best language gets among all
when each is weighed by 2 to the power of minus its bits for ``SPAN`` bytes at
the text's mean rate (shorter texts: for the text). Rows with a null id or a
null language teach nothing; a null id is not held out. Repeated rows count as
often as they stand. Other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.common import saved

ORDER = 3                   # bytes of the longest context
CELLS = 1 << 20             # costs per order, over all languages
UNIT = 1 << 16              # costs are in this part of a bit
SPAN = 64
UNKNOWN = "und"
_HELD = 1 << 21             # different grams that a task holds before it hands them on
_MIX = np.uint32(0x9E3779B1)


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals after 0xC3 lower-cased."""
    low = np.arange(256, dtype=np.uint8)
    low[ord("A"):ord("Z") + 1] += 32
    out = low[data]
    if len(data) > 1:
        b = data[1:]
        capital = (data[:-1] == 0xC3) & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)
        out[1:][capital] += 32
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of every byte: itself and the three before it, zeros before a document's first."""
    b = folded(data).astype(np.uint32)
    out = b.copy()
    first = offsets[:-1][offsets[:-1] < len(b)]
    for k in range(1, ORDER + 1):
        back = np.zeros_like(b)
        back[k:] = b[:-k] if k < len(b) else b[:0]
        for i in range(k):      # a shorter document lets this fall on the next one's beginning
            back[np.minimum(first + i, len(b) - 1)] *= (first + i >= len(b)).astype(np.uint32)
        out |= back << np.uint32(8 * k)
    return out


def gram_counts(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of ``(lang, text)``: partial counts of four-byte grams."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang, (g, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            langs = batch.column(0)
            for lang in langs.unique().to_pylist():
                texts = batch.column(1).filter(pa.compute.equal(langs, lang))
                for _, data, offsets in W.slices(texts):
                    if not len(data):
                        continue
                    g, n = np.unique(grams(data, offsets), return_counts=True)
                    if lang in held:
                        g0, n0 = held[lang]
                        g, back = np.unique(np.concatenate([g0, g]), return_inverse=True)
                        n = np.bincount(back, np.concatenate([n0, n]), len(g)).astype(np.int64)
                    held[lang] = (g, n.astype(np.int64))
            if sum(len(g) for g, _ in held.values()) > _HELD:
                yield from out()
                held = {}
        yield from out()

    return docs.mapInArrow(run, "lang string, gram bigint, n bigint")


def kept_grams(docs: DataFrame, cells: int = CELLS) -> tuple[list[str], DataFrame]:
    """``(languages, (lang, k, gram, n, t, d))`` of ``(lang, text)``.

    ``t`` and ``d``: bytes and different bytes after the gram's context.
    """
    counts = saved(gram_counts(docs).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang")
    # more languages than cells: nothing could be kept, so no more names are fetched
    langs = {r["lang"]: r["total"] for r in totals.limit(cells).collect()}
    shorter = F.explode(F.array(*[F.struct(
        F.lit(k).alias("k"), F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")) for k in range(ORDER + 1)]))
    every = counts.select("lang", "n", shorter.alias("x")).groupBy("lang", "x.k", "x.gram").agg(F.sum("n").alias("n"))
    context = Window.partitionBy("lang", "k", F.shiftright("gram", 8))         # 256 rows at most
    sized = every.withColumns({"t": F.sum("n").over(context), "d": F.count(F.lit(1)).over(context)})
    kept = sized.join(totals, "lang").where(
        F.col("n").cast("decimal(38,0)") * F.lit(cells) >= F.col("total").cast("decimal(38,0)") * F.lit(len(langs) ** 2))
    return list(langs), kept.select("lang", "k", "gram", "n", "t", "d")


# --- tables ---------------------------------------------------------------------

@dataclass
class Table:
    """Rows of integer costs (one per language) by key; ``slots`` and ``rows`` are the hash table."""
    keys: np.ndarray
    costs: np.ndarray
    slots: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)
    probes: int = field(init=False, default=0)

    def __post_init__(self):
        bits = max(4, int(len(self.keys) * 4 - 1).bit_length()) if len(self.keys) else 4
        self.shift = np.uint32(32 - bits)
        self.slots = np.zeros(1 << bits, np.uint32)
        self.rows = np.full(1 << bits, -1, np.int32)
        at, left = self.place(self.keys), np.arange(len(self.keys))
        while len(left):
            free = self.rows[at[left]] < 0
            spot, first = np.unique(at[left[free]], return_index=True)
            won = left[free][first]
            self.rows[spot], self.slots[spot] = won, self.keys[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & (len(self.rows) - 1)
            self.probes += 1

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is unknown."""
        at = self.place(keys)
        row = self.rows[at]
        hit = self.slots[at] == keys
        out = np.where(hit, row, np.int32(-1))
        todo = np.flatnonzero(~hit & (row >= 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & (len(self.rows) - 1)
            row = self.rows[at[todo]]
            hit = self.slots[at[todo]] == keys[todo]
            out[todo[hit & (row >= 0)]] = row[hit & (row >= 0)]
            todo = todo[~hit & (row >= 0)]
        return out


@dataclass
class Model:
    """Frozen trees: per order the costs of known grams and of escapes from known contexts."""
    langs: list[str]
    known: list[Table]
    escapes: list[Table]

    def lengths(self, g: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each document in every language, in ``UNIT`` parts of a bit."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.langs)), np.int64)
        filled = np.flatnonzero(np.diff(offsets) > 0)
        if not len(filled):
            return out
        row = self.known[ORDER].find(g)
        missing = np.flatnonzero(row < 0)
        table = self.known[ORDER].costs
        if len(self.known[ORDER].keys):
            for k in range(len(self.langs)):
                cost = table[k][row]
                cost[missing] = 0
                out[filled, k] = np.add.reduceat(cost, offsets[filled], dtype=np.int64)
        if len(missing):
            cost = self._shorter(g[missing], ORDER)
            doc = np.searchsorted(offsets, missing, "right") - 1
            for k in range(len(self.langs)):
                out[:, k] += np.bincount(doc, cost[k], n).astype(np.int64)
        return out

    def _shorter(self, g: np.ndarray, order: int) -> np.ndarray:
        """Costs of grams that no tree knows at this order: the escape and the shorter gram."""
        cost = np.zeros((len(self.langs), len(g)), np.int64)
        if order < 0:
            cost[:] = 8 * UNIT
            return cost
        row = self.escapes[order].find(g >> np.uint32(8))
        has = row >= 0
        cost[:, has] = self.escapes[order].costs[:, row[has]]
        if order == 0:
            return cost + 8 * UNIT
        low = g & np.uint32((1 << 8 * order) - 1)
        row = self.known[order - 1].find(low)
        has = row >= 0
        cost[:, has] += self.known[order - 1].costs[:, row[has]]
        if not has.all():
            cost[:, ~has] += self._shorter(low[~has], order - 1)
        return cost

    def costs(self, g: np.ndarray, order: int) -> np.ndarray:
        """Costs of any grams of ``order + 1`` bytes."""
        if order < 0:
            return np.full((len(self.langs), len(g)), 8 * UNIT, np.int64)
        row = self.known[order].find(g)
        out = np.empty((len(self.langs), len(g)), np.int64)
        has = row >= 0
        out[:, has] = self.known[order].costs[:, row[has]]
        out[:, ~has] = self._shorter(g[~has], order)
        return out


def trees(langs: list[str], rows: pa.Table) -> Model:
    """The model of the kept grams, order by order."""
    lang = np.searchsorted(np.array(langs, dtype=object), np.array(rows.column("lang").to_pylist(), dtype=object)) \
        if langs else np.empty(0, np.int64)
    order, gram, n, t, d = (rows.column(c).to_numpy() for c in ("k", "gram", "n", "t", "d"))
    model = Model(langs, [], [])
    for k in range(ORDER + 1):
        here = order == k
        l, g = lang[here], gram[here].astype(np.uint32)
        share = n[here] / (t[here] + d[here])
        below = 2.0 ** (-model.costs(g & np.uint32((1 << 8 * k) - 1) if k else g, k - 1)[l, np.arange(len(g))] / UNIT)
        # what the known bytes of a context leave: to the escape, and of the shorter context
        context, at = np.unique(g >> np.uint32(8), return_inverse=True)
        cell = l * len(context) + at
        size = len(langs) * len(context)
        left = 1.0 - np.bincount(cell, share, size)
        less = 1.0 - np.bincount(cell, below, size)
        known = np.bincount(cell, minlength=size) > 0
        escape = np.where(known, -np.log2(np.maximum(left, 1e-12)) + np.log2(np.maximum(less, 1e-12)), 0.0)
        model.escapes.append(Table(context, np.round(escape * UNIT).astype(np.int32)
                                   .reshape(len(langs), len(context))))
        keys, spot = np.unique(g, return_inverse=True)
        # a tree that does not know a gram of the table pays its own escape
        costs = model._shorter(keys, k).astype(np.int32)
        costs[l, spot] = np.round(-np.log2(share) * UNIT).astype(np.int32)
        model.known.append(Table(keys, np.ascontiguousarray(costs)))
    return model


def fit(docs: DataFrame, learn: Callable[[Column], Column], id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", cells: int = CELLS) -> Model:
    """Trees of the languages of the rows whose id ``learn`` accepts."""
    labelled = docs.where(learn(F.col(f"`{id_col}`"))).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .where("lang IS NOT NULL AND text IS NOT NULL")
    langs, kept = kept_grams(labelled, cells)
    return trees(langs, kept.toArrow())


def scores(lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(best language, score)`` from code lengths and bytes."""
    best = np.argmin(lengths, axis=1)
    more = (lengths - lengths[np.arange(len(best)), best][:, None]) / UNIT
    mean = np.maximum(1.0, sizes / SPAN)[:, None]
    return best, 1.0 / np.sum(2.0 ** -(more / mean), axis=1)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits`` per row; ``bits`` is the code length in that language."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in batches:
            speaks = batch.column(2).to_numpy(zero_copy_only=False)
            for first, data, offsets in W.slices(batch.column(1)):
                n = len(offsets) - 1
                ok = speaks[first:first + n].astype(bool) & bool(m.langs)
                best, score, bits = np.full(n, len(m.langs)), np.zeros(n), np.zeros(n)
                if ok.any():
                    sizes = np.diff(offsets)
                    length = m.lengths(grams(data, offsets), offsets)
                    top, share = scores(length, sizes)
                    best = np.where(ok, top, best)
                    score = np.where(ok, share, 0.0)
                    bits = np.where(ok, length[np.arange(n), top] / UNIT, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(names[best], pa.string()), pa.array(score),
                     pa.array(bits)], ["doc_id", "lang_pred", "score", "bits"])

    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("speaks")) \
        .mapInArrow(run, "doc_id bigint, lang_pred string, score double, bits double")
