"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.config import ensure_checkpoint_dir

# White space of every word rule here: space and \x09-\x0D (Java regex classes).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written once to the session's shared checkpoint folder.

    Later reads see fixed files and partitions, so a lost executor repeats
    neither the work above nor a different split of the rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BATCH_BYTES = 1 << 20
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(rows: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` over batches of ``BATCH_BYTES`` and a row at most.

    Spark's own batches hold up to 10,000 rows and 64 MiB, which executor and
    worker have in memory several times over. The bound is read when the job
    runs, so it stays in the session; a bound that the session has is kept.
    """
    conf = rows.sparkSession.conf
    if conf.get(_BATCHES, None) is None:
        conf.set(_BATCHES, str(BATCH_BYTES))
    return rows.mapInArrow(run, schema)


def whole(text: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def boxed(df: DataFrame) -> Column:
    """All columns as one struct, ``select("doc.*")`` restores: names of the input can't clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also where a lambda needs it again and again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def id_fold(id_col: Column, folds: int) -> Column:
    """``crc32`` of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))


BITMAP_BITS = 1 << 26       # 8 MiB
BITMAP_MOST = 1 << 29       # 64 MiB, whatever the input


def bitmap_bits(n: int) -> int:
    """Bits of a bitmap of ``n`` values that lets one other value in sixteen pass, up to the bound."""
    return max(1 << 20, min(BITMAP_MOST, 1 << (16 * n).bit_length()))


def bitmap(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """Marks for the 64-bit values of a column: a filter of fixed size for a join's large side.

    A value that is not in the column may pass, a value that is always does.
    """
    bit = F.pmod(F.col(column), F.lit(bits)) + 1        # Spark's bitmaps count from 1
    rows = keys.groupBy(F.bitmap_bucket_number(bit).alias("k")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(r["m"], np.uint8)
        at = (r["k"] - 1) * len(part)
        out[at:at + len(part)] = part[:len(out) - at]
    return out


def marked(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values (int64) the bitmap lets through."""
    bit = np.mod(values, len(marks) * 8)
    return (marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def native_marks(keys: DataFrame, column: str, bits: int = BITMAP_BITS) -> DataFrame:
    """The bitmap of a column's 64-bit values as rows ``(marks_at, marks)`` of 4 KiB, for ``passes``.

    At most ``bits / 32768`` rows (2048, 8 MiB) whatever the input.
    """
    bit = F.pmod(F.col(column), F.lit(bits)) + 1
    return keys.groupBy(F.bitmap_bucket_number(bit).alias("marks_at")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("marks"))


def passes(rows: DataFrame, marks: DataFrame, column: str, bits: int = BITMAP_BITS,
           others: bool = False) -> DataFrame:
    """``rows`` whose value is marked, and a few that only share a bit; with ``others`` the rest.

    The marks are sent to every task (their size is bounded), nothing else moves.
    """
    bit = F.pmod(F.col(column), F.lit(bits)) + 1
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    own = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (at % 8).cast("int") + 1)
    hit = F.coalesce(byte.bitwiseAND(own) != 0, F.lit(False))
    found = rows.withColumn("marks_at", F.bitmap_bucket_number(bit)).join(F.broadcast(marks), "marks_at", "left")
    return found.where(~hit if others else hit).drop("marks_at", "marks")


def dealt_join(rows: DataFrame, grouped: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Joins ``rows`` with an aggregate ``grouped`` by ``on`` so that hot keys can be split.

    A join on the aggregate's own keys would run on its partitions, which
    adaptive execution must leave whole. One key more (a hash of the others)
    deals both sides anew; copies are merged in the aggregate before that.
    """
    key = F.xxhash64(*on).alias("_dealt")
    return rows.select("*", key).join(grouped.select("*", key), [*on, "_dealt"], how).drop("_dealt")


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id reachable from every end of ``edges(a, b)``.

    Alternating large-star and small-star steps (Kiveris et al., 2014): each
    is one partial aggregate and one join on the smallest neighbour, so a
    node with very many neighbours ships one row per task and its join
    partition can be split. Every round is checkpointed, and the job that
    writes it counts what tells whether the round changed anything (tasks run
    again may count twice, which costs a round, no result); the number of rounds
    grows with the logarithm of the longest path. No edges: no rows.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        # large: neighbours above the node; small: those at or below it
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
            else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")) \
            .select("a", F.least("m", "a").alias("m"))
        out = dealt_join(both, low, ["a"])
        if large:
            out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("m").alias("b")) \
                .unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def marked_round(e: DataFrame) -> tuple[DataFrame, dict]:
        """The edges written once, and their number and sum of hashes."""
        seen = Observation()
        return saved(e.observe(seen, F.count(F.lit(1)).alias("n"),
                               F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))), seen.get

    e, seen = marked_round(edges.select("a", "b").where("a <> b")
                           .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        e, now = marked_round(star(star(e, True), False))
        if now == seen:
            break
        seen = now
    members = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component"))
                               .distinct())
