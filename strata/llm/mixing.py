"""Mixing sources to target weights by balanced sampling (operator 8).

Every source gets a target in words. A document's expected number of copies
is target / source size: its whole part is taken for certain, its fraction is
an inclusion probability. The cube method moves these probabilities through
the null space of two constraints (words and documents of the source), so
both totals stay as they are while units reach 0 or 1. Blocks of one source
run side by side and hand on at most two open units each; open units of up to
``FAN_IN`` blocks meet again in the next round, until one block per source is
left. Its last open units (at most two) are taken in part, which closes the
word total.

Defined results: null text has size 0; the null source is a source of its
own, last in order; rows that agree in id, source and size are alike, and
their copies are dealt out among them; empty documents are never needed for a
target and take 0 words; an empty table gives an empty result; a mix of no
words has targets 0. Other columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, boxed, saved, whole, word_count
from strata.llm.ordered import in_order, positions
from strata.sources.memory import local_relation

WEIGHTS = (5, 2, 1)     # by rank of the source, repeating
SHARE = 1.5             # of all sizes
LIMIT = 2.0             # times a source's size
BLOCK = 4096            # units in a block, about
FAN_IN = 1024           # blocks whose open units meet in one block of the next round


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            limit: float = LIMIT) -> list[float]:
    """Words per source: ``share`` of all sizes by weight, none above ``limit`` times its size.

    What a full source can't take is shared again by weight among the others.
    """
    left, full = share * sum(sizes), set()
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    while len(full) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in full]
        unit = left / sum(w[i] for i in open_)
        over = [i for i in open_ if unit * w[i] > limit * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * w[i]
            break
        for i in over:
            out[i] = limit * sizes[i]
            left -= out[i]
            full.add(i)
    return out


def _move(units: list, rng: random.Random) -> list:
    """One step along a null-space direction of (words, documents); the units still open."""
    if len(units) == 3:
        (_, a, _), (_, b, _), (_, c, _) = units
        u = (b - c, c - a, a - b)
        if u == (0, 0, 0):
            u = (1, -1, 0)
    else:
        u = (1, -1)
    up = min(((1 - p) if d > 0 else p) / abs(d) for (_, _, p), d in zip(units, u) if d)
    down = min((p if d > 0 else (1 - p)) / abs(d) for (_, _, p), d in zip(units, u) if d)
    step = up if rng.random() * (up + down) < down else -down
    out = []
    for (k, s, p), d in zip(units, u):
        p = p + step * d
        out.append((k, s, 0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p))
    return out


def flight(sizes: Sequence[int], probs: Sequence[float], seed: str) -> list[float]:
    """Cube flight phase over one block: words and documents balanced, at most two units open.

    Holds three open units at a time, so a step costs the same in any block.
    """
    rng, active, out = random.Random(seed), [], list(probs)
    for k, (s, p) in enumerate(zip(sizes, probs)):
        if not 0 < p < 1:
            continue
        active.append((k, s, p))
        while len(active) == 3 or (len(active) == 2 and active[0][1] == active[1][1]):
            active = _move(active, rng)
            for j, _, q in active:
                out[j] = q
            active = [x for x in active if 0 < x[2] < 1]
    return out


def _round(units: DataFrame, level: int, seed: int) -> DataFrame:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["h", "unit", "size"], kind="stable")
        key = f"{seed}:{level}:{block['src'].iloc[0]}:{block['block'].iloc[0]}"
        return block.assign(p=flight(block["size"].tolist(), block["p"].tolist(), key))

    return units.groupBy("src", "block").applyInPandas(run, units.schema)


def mix_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", size: Column | None = None, seed: int = 7,
              weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
              block: int = BLOCK) -> DataFrame:
    """``(doc_id, source, size, n, source_size, target, whole, rest)`` per distinct (id, source, size).

    Of the ``n`` alike rows each is taken ``whole`` times, and ``rest`` (0 to
    n) more copies are dealt out among them; only a landing unit has a
    fraction in ``rest``. The result depends on the rows alone, not on their
    order or partitions.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                       (word_count(whole(text_col)) if size is None else size).alias("size"))
    units = saved(rows.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    # one row per source; sources are named by the mix, documents never reach the driver
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"),
                                         F.count(F.lit(1)).alias("units")).collect()
    totals.sort(key=lambda r: (r["source"] is None, r["source"]))   # str order: code points
    goal = targets([r["words"] for r in totals], weights, share, limit)
    table = [(r["source"], i, r["words"], t, t / r["words"] if r["words"] else 0.0,
              -(-r["units"] // block)) for i, (r, t) in enumerate(zip(totals, goal))]
    schema = "s string, src int, source_size bigint, target double, ratio double, blocks bigint"
    per_source = local_relation(spark, table, schema)
    h = F.xxhash64(F.lit(seed), "doc_id", "size")
    # copies beyond the whole ones: all of n alike rows but one are sure or out
    more = F.col("n") * (F.col("ratio") - F.col("whole"))
    units = units.join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s") \
        .withColumn("whole", F.floor("ratio").cast("bigint")) \
        .withColumn("sure", F.floor(more).cast("bigint")).withColumn("p", more - F.col("sure"))
    moving = units.select(F.col("doc_id").alias("unit"), "size", "src", h.alias("h"), "p",
                          F.pmod(h, F.col("blocks")).alias("block"), "blocks")
    done, level, most = None, 0, max([r[5] for r in table], default=0)
    while most:
        out = saved(_round(moving, level, seed))
        last = most == 1
        settled = out if last else out.where("p = 0 or p = 1")
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        moving = out.where("p > 0 and p < 1").withColumn("block", F.expr(f"block div {FAN_IN}"))
        level, most = level + 1, -(-most // FAN_IN)
    if done is None:
        done = moving
    done = done.select(F.col("unit").alias("_u"), F.col("size").alias("_z"),
                       F.col("src").alias("_s"), F.col("p").alias("_p"))
    return units.join(done, F.col("doc_id").eqNullSafe(F.col("_u")) & (F.col("src") == F.col("_s"))
                      & (F.col("size") == F.col("_z"))) \
        .select("doc_id", "source", "size", "n", "source_size", "target", "whole",
                (F.col("sure") + F.col("_p")).alias("rest"))


def _taken(j: Column) -> Column:
    """Copies (with the landing fraction) of the j-th of a unit's alike rows."""
    return F.col("whole") + F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("rest") - j))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken, source``; options as ``mix_units``."""
    return mix_units(docs, **options) \
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("j")) \
        .select("doc_id", "size", "source_size", "target",
                F.floor(F.col("size") * _taken(F.col("j")) + 0.5).cast("bigint").alias("taken"),
                "source")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns as they were.

    A landing unit's last copy holds the words it is still to give, joined
    by spaces.
    """
    units = mix_units(docs, id_col, text_col, source_col, **options).select(
        F.col("doc_id").alias("u_id"), F.col("source").alias("u_source"),
        F.col("size").alias("u_size"), "n", "whole", "rest")
    many = units.where("n > 1")
    sized = docs.select(boxed(docs), F.col(f"`{id_col}`").alias("id"),
                        F.col(f"`{source_col}`").alias("source"), whole(text_col).alias("text")) \
        .withColumn("size", word_count(F.col("text")))
    match = F.col("id").eqNullSafe(F.col("u_id")) & F.col("source").eqNullSafe(F.col("u_source")) \
        & (F.col("size") == F.col("u_size"))
    out = sized.join(units.where("n = 1"), match).withColumn("j", F.lit(0).cast("bigint"))
    if not many.isEmpty():      # alike rows get a number each, however many there are
        alike = sized.withColumn("tie", F.monotonically_increasing_id()) \
            .join(many.withColumn("unit", F.monotonically_increasing_id()), match)
        numbered = positions(in_order(alike, ["unit"], [F.xxhash64("text").asc(), F.col("tie").asc()]), ["unit"])
        out = out.unionByName(numbered.withColumn("j", F.col("pos") - 1).select(*out.columns))
    times = _taken(F.col("j"))
    out = out.withColumn("full", F.floor(times).cast("int")).withColumn(
        "part", F.when(times > F.floor(times), F.floor(F.col("size") * times + 0.5)
                       - F.floor(times) * F.col("size")).otherwise(0).cast("int"))
    # a copy that rounds to no word or to all of them is none or a whole one
    out = out.withColumn("copies", F.col("full") + (F.col("part") > 0).cast("int")) \
        .where("copies > 0") \
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, 1, F.col("part")), " ")
    return out.withColumn("doc", F.when(F.col("copy") > F.col("full"), F.col("doc").withField(
        f"`{text_col}`", cut)).otherwise(F.col("doc"))).select("doc.*")
