"""Integer k-means over category vectors and the per-cluster report
(M1 M2 J2 A8-A12 I1-I6 O3 K2).

Points are ``(x bigint, y bigint)`` rows, optionally weighted by ``n``
(the number of identical raw points). Centers are ``(x, y)`` integer pairs
kept on the driver: there are k of them, a parameter of the call.

Semantics kept from the reference
* distance is the *squared* Euclidean distance (as double);
* a point goes to the nearest center, ties to the lowest index;
* a new center is the integer mean, long sums divided with truncation
  toward zero; an empty cluster keeps its old center;
* the loop stops when the summed squared center movement is below eta,
  or after ``max_iterations`` updates, and returns the *new* centers.

Scale notes
* ``fit`` checkpoints the raw vectors once (reliable, in the session's
  checkpoint folder); ``weighted_points`` compacts them (map-side partial
  aggregate) and is checkpointed too, so each iteration scans distinct
  points, not rows, and a lost executor never sends the loop back to the
  source tables.
* One iteration is one job: assign + partial aggregate, at most k rows
  per task through the shuffle and k rows back to the driver.
* The work per point and center is the same at every k: up to
  ``EXPRESSION_CENTERS`` centers are one generated expression, more are
  compared in NumPy on Arrow batches (the generated code of 45 centers is
  beyond what the JVM compiles). Both forms give the same cluster.
* Seeding keeps the k lowest hash keys per (category, salt), then per
  category, so a dominant category spreads over many tasks.
* The report's median is found by narrowing value ranges: every pass is a
  partial sum per (cluster, range), no task holds a cluster's values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.config import ensure_checkpoint_dir
from strata.functions.ordering import sort_bounded
from strata.sources.memory import local_relation

# Below this spread the categories overlap and seeds are drawn globally.
GLOBAL_SAMPLE_SPREAD = 500
# Centers up to this many are compared in one generated expression.
EXPRESSION_CENTERS = 24
# Distances held at a time by the batch form (rows x centers).
BATCH_DISTANCES = 1 << 20
# Parts that a category is seeded in before the parts are merged.
SEED_SALTS = 256
# Ranges that a median search divides an interval into.
MEDIAN_RANGES = 4096
# The report's line format and heading.
REPORT_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"
REPORT_HEADER = ("Resulting clusters:",
                 "  Score  Dominant language (%percent)  Questions",
                 "================================================")

Center = tuple[int, int]


@dataclass(frozen=True)
class KMeansParams:
    """Parameters of the clustering run."""
    categories: tuple[str, ...]
    spread: int = 50000
    kernels: int = 45
    eta: float = 20.0
    max_iterations: int = 120
    seed: int = 42

    def __post_init__(self):
        if self.spread <= 0:
            raise ValueError("spread must be positive, or categories cannot be recovered")
        if self.kernels <= 0 or self.max_iterations <= 0:
            raise ValueError("kernels and max_iterations must be positive")
        if not self.categories:
            raise ValueError("categories must not be empty")


@dataclass
class KMeansResult:
    centers: list[Center]
    iterations: int
    converged: bool
    distance: float
    # (iter, cluster, old_x, old_y, new_x, new_y, dist) per cluster and update
    history: list[tuple[int, int, int, int, int, int, float]] = field(default_factory=list)


# --- points ---------------------------------------------------------------

def weighted_points(vectors: DataFrame) -> DataFrame:
    """``(x, y, n)``: identical raw points merged with their count.

    Mean, median, mode, size and share are exact on weights, so every
    later step runs on distinct points. Worst case no reduction, still exact.
    """
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def _weight(points: DataFrame) -> Column:
    return F.col("n") if "n" in points.columns else F.lit(1).cast("bigint")


def reliable(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the session's reliable checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def one_partition(points: DataFrame) -> DataFrame:
    """``points``, known to the planner as one partition if they are: grouping then needs no exchange.

    A compacted category space is often small; each update is then a single stage.
    """
    return points.coalesce(1) if points.rdd.getNumPartitions() == 1 else points


# --- seeding (M1, M2) ------------------------------------------------------

def sample_key(id_col: str, seed: int) -> Column:
    """Reproducible pseudo-random order: ``md5(id || '#' || seed)``."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))


def seed_points_per_category(vectors: DataFrame, per_category: int, seed: int,
                             salts: int = SEED_SALTS) -> DataFrame:
    """M2: the ``per_category`` points of lowest sample key in every category.

    The lowest of a category are among the lowest of its salts, so each
    (category, salt) is cut first and a category meets as at most
    ``salts * per_category`` rows, whatever its size. Result: ``(x, y, id, rank)``.
    """
    key = sample_key("id", seed)
    salted = vectors.select("x", "y", "id", F.pmod(F.xxhash64("id", "y"), F.lit(salts)).alias("_salt"))
    part = Window.partitionBy("x", "_salt").orderBy(key, "id", "y")
    whole = Window.partitionBy("x").orderBy(key, "id", "y")
    return salted.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= per_category) \
        .select("x", "y", "id", F.row_number().over(whole).alias("rank")) \
        .where(F.col("rank") <= per_category)


def seed_points_global(vectors: DataFrame, k: int, seed: int) -> DataFrame:
    """M1: the k points of lowest sample key overall (top-k, no full sort)."""
    return vectors.orderBy(sample_key("id", seed), "id", "x", "y").limit(k) \
        .select("x", "y", "id")


def sample_seeds(vectors: DataFrame, params: KMeansParams) -> list[Center]:
    """Initial centers, checked like the reference: exactly k of them and,
    per category, k / #categories points. Ordered by (x, rank)."""
    k = params.kernels
    ncat = len(params.categories)
    if k % ncat:
        raise ValueError("kernels must be a multiple of the number of categories")
    if params.spread < GLOBAL_SAMPLE_SPREAD:
        rows = seed_points_global(vectors, k, params.seed).collect()
        if len(rows) != k:
            raise ValueError(f"need {k} points to seed, found {len(rows)}")
        return [(r["x"], r["y"]) for r in rows]
    per = k // ncat
    rows = sort_bounded(seed_points_per_category(vectors, per, params.seed), "x", "rank").collect()
    found = [sum(1 for r in rows if r["x"] == i * params.spread) for i in range(ncat)]
    short = [params.categories[i] for i in range(ncat) if found[i] < per]
    if short or len(rows) != k:
        raise ValueError(f"every category needs {per} points; short: {short}")
    return [(r["x"], r["y"]) for r in rows]


# --- assignment and update (J2, A8, I2, I3) --------------------------------

def squared_distance_sql(x: str, y: str, center: Center) -> str:
    """Squared Euclidean distance as double (the reference's 'euclidean')."""
    dx = f"CAST(`{x}` - ({int(center[0])}) AS DOUBLE)"
    dy = f"CAST(`{y}` - ({int(center[1])}) AS DOUBLE)"
    return f"{dx} * {dx} + {dy} * {dy}"


def nearest_center(centers: Sequence[Center], x: str = "x", y: str = "y") -> Column:
    """Index of the closest center; on equal distance the lowest index.

    ``least`` over ``named_struct(distance, index)`` orders by distance,
    then index: one code-generated expression, no join, no UDF. It is
    written as one SQL expression so building it costs one call into the
    JVM, not one per sub-expression (it is rebuilt every iteration).
    """
    if not centers:
        raise ValueError("no centers")
    if len(centers) == 1:
        return F.lit(0)
    cands = ", ".join(f"named_struct('d', {squared_distance_sql(x, y, c)}, 'i', {i})"
                      for i, c in enumerate(centers))
    return F.expr(f"least({cands}).i")


def batch_nearest(centers: Sequence[Center]):
    """J2 for any number of centers: a vectorized UDF of ``(x, y)``; ties to the lowest index."""
    cx = np.array([c[0] for c in centers], np.int64)
    cy = np.array([c[1] for c in centers], np.int64)
    step = max(1, BATCH_DISTANCES // len(cx))

    def nearest(x: pd.Series, y: pd.Series) -> pd.Series:
        px, py = x.to_numpy(np.int64), y.to_numpy(np.int64)
        out = np.empty(len(px), np.int32)
        for i in range(0, len(px), step):
            dx = (px[i:i + step, None] - cx).astype(np.float64)
            dy = (py[i:i + step, None] - cy).astype(np.float64)
            out[i:i + step] = (dx * dx + dy * dy).argmin(axis=1)
        return pd.Series(out)

    return F.pandas_udf(nearest, "int")


def assign(points: DataFrame, centers: Sequence[Center]) -> DataFrame:
    """``points`` with the ``cluster`` of each, in the form that suits the number of centers."""
    if len(centers) <= EXPRESSION_CENTERS:
        return points.withColumn("cluster", nearest_center(centers))
    return points.withColumn("cluster", batch_nearest(centers)("x", "y"))


def integer_means(points: DataFrame, centers: Sequence[Center]) -> DataFrame:
    """A8 after J2: ``(cluster, x, y)`` integer means of the non-empty clusters."""
    weighted = assign(points, centers).select("cluster", "x", "y", _weight(points).alias("_w"))
    return weighted.groupBy("cluster").agg(F.expr("sum(x * _w) div sum(_w) AS x"),
                                           F.expr("sum(y * _w) div sum(_w) AS y"))


def point_distance(a: Center, b: Center) -> float:
    dx, dy = float(a[0] - b[0]), float(a[1] - b[1])
    return dx * dx + dy * dy


def centers_distance(a: Sequence[Center], b: Sequence[Center]) -> float:
    """Sum of squared distances between matching centers."""
    if len(a) != len(b):
        raise ValueError("center lists differ in length")
    return sum(point_distance(p, q) for p, q in zip(a, b))


def converged(distance: float, eta: float) -> bool:
    """I4."""
    return distance < eta


def kmeans_step(points: DataFrame, centers: Sequence[Center]) -> list[Center]:
    """One Lloyd update; an empty cluster keeps its old center."""
    new = list(centers)
    for r in integer_means(points, centers).collect():
        new[r["cluster"]] = (r["x"], r["y"])
    return new


def kmeans(points: DataFrame, seeds: Sequence[Center], eta: float = 20.0,
           max_iterations: int = 120) -> KMeansResult:
    """Lloyd iterations from ``seeds`` until movement < eta or the cap.

    ``points`` should be compact and reliable (see ``weighted_points`` and
    ``reliable``); each update is one job returning at most k rows.
    """
    means = list(seeds)
    history: list[tuple[int, int, int, int, int, int, float]] = []
    it = 0
    while True:
        it += 1
        new = kmeans_step(points, means)
        for c, (old, cur) in enumerate(zip(means, new)):
            history.append((it, c, old[0], old[1], cur[0], cur[1], point_distance(old, cur)))
        dist = centers_distance(means, new)
        if converged(dist, eta) or it >= max_iterations:
            return KMeansResult(new, it, converged(dist, eta), dist, history)
        means = new


def centers_frame(spark: SparkSession, centers: Sequence[Center]) -> DataFrame:
    return local_relation(spark, [(i, int(x), int(y)) for i, (x, y) in enumerate(centers)],
                          "cluster int, x bigint, y bigint")


def history_frame(spark: SparkSession, result: KMeansResult) -> DataFrame:
    return local_relation(
        spark, result.history,
        "iter int, cluster int, old_x bigint, old_y bigint, new_x bigint, new_y bigint, "
        "dist double")


# --- report (A9-A12, O3, K2) -----------------------------------------------

def _middle(a: int, b: int) -> int:
    """Mean of two values, truncated toward zero."""
    s = a + b
    return s // 2 if s >= 0 else -(-s // 2)


def _median_pass(assigned: DataFrame, todo: Sequence[tuple], clusters: int) -> DataFrame:
    """``(c, k, part, below, w)``: the part of each open interval that holds its rank.

    ``todo``: ``(cluster, which middle, rank within the interval, lowest and
    highest value, width of a part)``. The intervals are a literal, looked up
    by cluster, so a pass is one aggregate with one window over its parts.
    """
    of = [[] for _ in range(clusters)]
    for c, *interval in todo:
        of[c].append("named_struct({})".format(", ".join(
            f"'{n}', {int(v)}L" for n, v in zip(("k", "rank", "lo", "hi", "width"), interval))))
    empty = "array_remove(array(named_struct({0})), named_struct({0}))".format(
        ", ".join(f"'{n}', 0L" for n in ("k", "rank", "lo", "hi", "width")))
    table = "array({})".format(", ".join(f"array({', '.join(x)})" if x else empty for x in of))
    open_ = assigned.select("cluster", "y", "_w", F.explode(F.expr(f"element_at({table}, cluster + 1)")).alias("t")) \
        .where(F.col("y").between(F.col("t.lo"), F.col("t.hi")))
    sums = open_.groupBy(F.col("cluster").alias("c"), F.col("t.k").alias("k"), F.col("t.rank").alias("rank"),
                         F.expr("(y - t.lo) div t.width").alias("part")).agg(F.sum("_w").alias("w"))
    upto = Window.partitionBy("c", "k").orderBy("part")
    return sums.withColumn("below", F.sum("w").over(upto) - F.col("w")) \
        .where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("w")))


def weighted_medians(assigned: DataFrame, ranges: int = MEDIAN_RANGES) -> DataFrame:
    """``(cluster, median_score)`` of ``assigned(cluster, y, _w)``, see ``medians``."""
    return local_relation(assigned.sparkSession, list(medians(assigned, ranges).items()),
                          "cluster int, median_score bigint")


def medians(assigned: DataFrame, ranges: int = MEDIAN_RANGES,
            stats: Sequence[tuple[int, int, int, int]] | None = None) -> dict[int, int]:
    """The median of each cluster of ``assigned(cluster, y, _w)``: the mean of the two middle
    values, truncated toward zero.

    The interval of each middle value is divided into ``ranges``; a partial
    sum per range tells which one holds its rank, and the search goes on
    there until it is one value: two rows per cluster reach the driver each
    time, and the number of passes is the logarithm of the value range.
    ``stats``: ``(cluster, weight, lowest, highest value)``, where known.
    """
    if stats is None:
        stats = [tuple(r) for r in assigned.groupBy("cluster").agg(
            F.sum("_w"), F.min("y"), F.max("y")).collect()]
    # (cluster, which middle, rank from 0 within the interval, lowest, highest value)
    open_ = [(c, k, (n - 1 + k) // 2, lo, hi) for c, n, lo, hi in stats for k in (0, 1)]
    found: dict[int, list[int]] = {c: [0, 0] for c, *_ in stats}
    clusters = max(found, default=-1) + 1
    while open_:
        todo = []
        for c, k, rank, lo, hi in open_:
            if lo == hi:
                found[c][k] = lo
            else:
                todo.append((c, k, rank, lo, hi, -(-(hi - lo + 1) // ranges)))
        if not todo:
            break
        bounds = {(c, k): (lo, hi, width) for c, k, _, lo, hi, width in todo}
        open_ = []
        for r in _median_pass(assigned, todo, clusters).collect():
            lo, hi, width = bounds[r["c"], r["k"]]
            open_.append((r["c"], r["k"], r["rank"] - r["below"], lo + r["part"] * width,
                          min(hi, lo + (r["part"] + 1) * width - 1)))
    return {c: _middle(*v) for c, v in found.items()}


def cluster_report(points: DataFrame, centers: Sequence[Center],
                   categories: Sequence[str], spread: int) -> DataFrame:
    """``(label, percent, size, median_score)`` per non-empty cluster,
    ascending by median (ties: label, size).

    * A9 median: exact weighted median (mean of the two middle values on
      even counts), truncated toward zero;
    * A10 mode: category with most points, lowest on ties;
    * A11 size and the mode's share in percent.
    One job gives sizes, modes and value ranges, one per pass the medians:
    partial aggregates over the compact points, a few rows per cluster each.
    """
    assigned = assign(points, centers).select("cluster", "x", "y", _weight(points).alias("_w"))
    stats = assigned.groupBy("cluster", "x").agg(
        F.sum("_w").alias("cnt"), F.min("y").alias("lo"), F.max("y").alias("hi")) \
        .groupBy("cluster").agg(
            F.sum("cnt").alias("size"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.max_by(F.struct("x", "cnt"), F.struct(F.col("cnt"), -F.col("x"))).alias("mode")).collect()
    middle = medians(assigned, stats=[(r["cluster"], r["size"], r["lo"], r["hi"]) for r in stats])
    rows = [(categories[r["mode"]["x"] // int(spread)], r["mode"]["cnt"] * 100.0 / r["size"], r["size"],
             middle[r["cluster"]]) for r in stats]
    report = local_relation(points.sparkSession, rows,
                            "label string, percent double, size bigint, median_score bigint")
    return sort_bounded(report, "median_score", "label", "size")


def report_line() -> Column:
    """K2: the line of one report row."""
    return F.format_string(REPORT_FORMAT, "median_score", "label", "percent", "size").alias("line")


def report_lines(report: DataFrame) -> DataFrame:
    """K2: one formatted ``line`` per cluster, in report order."""
    lines = report.select(report_line(), "median_score", "label", "size")
    # a report from cluster_report is already in one partition, which
    # satisfies this ordering without another exchange
    return lines.orderBy("median_score", "label", "size").select("line")


# --- fitting (E2 from the vectors on) -----------------------------------------

@dataclass
class Clustering:
    points: DataFrame
    seeds: list[Center]
    result: KMeansResult


def fit(vectors: DataFrame, params: KMeansParams) -> Clustering:
    """Seeds, compact reliable points and the k-means loop.

    The raw vectors (the output of the question/answer join) are written
    once as a reliable checkpoint: seeding and compaction read them without
    re-running the join, a lost executor does not send them back to the
    source tables, and adaptive execution sizes their partitions (a cached
    plan would keep every shuffle partition of its last stage, however
    small). The compact points are checkpointed before the loop starts.
    """
    return fit_reliable(reliable(vectors.select("id", "x", "y")), params)


def fit_reliable(raw: DataFrame, params: KMeansParams) -> Clustering:
    """``fit`` on vectors ``(id, x, y)`` that are reliable already."""
    seeds = sample_seeds(raw, params)
    points = one_partition(reliable(weighted_points(raw)))
    result = kmeans(points, seeds, params.eta, params.max_iterations)
    return Clustering(points, seeds, result)
