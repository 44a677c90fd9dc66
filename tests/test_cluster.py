"""Seeding, nearest center, integer means, k-means loop and report."""

import pytest
from pyspark.sql import functions as F

from strata.operators import cluster as C

CATS = ("A", "B", "C")


def vectors(spark, pts):
    """(id, x, y) from (x, y) pairs, ids in order."""
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)],
                                 "id bigint, x bigint, y bigint")


def test_nearest_ties_go_to_lowest_index(spark):
    df = vectors(spark, [(0, 0), (3, 0), (10, 10)])
    got = C.assign(df, [(5, 5), (1, 0), (-1, 0), (1, 0)]).orderBy("id").collect()
    assert [r["cluster"] for r in got] == [1, 1, 0]


def test_integer_mean_truncates_toward_zero(spark):
    df = vectors(spark, [(0, -3), (0, -2), (1, 4)])
    got = {r["cluster"]: (r["x"], r["y"]) for r in C.integer_means(df, [(0, 0)]).collect()}
    assert got == {0: (0, 0)}            # x: 1 div 3 = 0, y: -1 div 3 = 0
    df = vectors(spark, [(0, -3), (0, -2)])
    assert C.integer_means(df, [(0, 0)]).first()["y"] == -2   # -5 div 2


def test_empty_cluster_keeps_center(spark):
    df = vectors(spark, [(0, 1), (0, 3)])
    assert C.kmeans_step(df, [(0, 0), (1000, 1000)]) == [(0, 2), (1000, 1000)]


def test_loop_stops_on_eta_and_on_cap(spark):
    df = vectors(spark, [(0, 0), (0, 10), (100, 0), (100, 10)])
    res = C.kmeans(df, [(0, 0), (100, 0)], eta=20.0, max_iterations=120)
    assert res.converged and res.centers == [(0, 5), (100, 5)]
    assert res.iterations == 2 and res.distance == 0.0
    capped = C.kmeans(df, [(0, 0), (1, 0)], eta=0.0, max_iterations=1)
    assert capped.iterations == 1 and not capped.converged
    assert len(capped.history) == 2 and capped.history[0][:2] == (1, 0)


def test_weighted_equals_unweighted(spark):
    import random
    rnd = random.Random(3)
    pts = [(50000 * rnd.randint(0, 2), rnd.randint(-30, 60)) for _ in range(400)]
    raw = vectors(spark, pts)
    seeds = [(0, 0), (0, 40), (50000, 10), (50000, 30), (100000, 0), (100000, 50)]
    a = C.kmeans(raw, seeds, 1.0, 50)
    b = C.kmeans(C.weighted_points(raw), seeds, 1.0, 50)
    assert a.centers == b.centers and a.history == b.history
    ra = sorted(tuple(r) for r in C.cluster_report(raw, a.centers, CATS, 50000).collect())
    rb = sorted(tuple(r) for r in C.cluster_report(C.weighted_points(raw), b.centers, CATS,
                                                   50000).collect())
    assert ra == rb


def test_report_median_mode_and_share(spark):
    # one cluster: y = -3, -2 (even -> -2), categories A (x=0) twice, B once
    df = vectors(spark, [(0, -3), (0, -2), (50000, 8), (0, 9)])
    row = C.cluster_report(df, [(0, 0)], CATS, 50000).first()
    assert row["label"] == "A" and row["size"] == 4
    assert row["percent"] == 75.0 and row["median_score"] == 3   # (-2 + 8) / 2
    tie = vectors(spark, [(50000, 1), (0, 2)])
    row = C.cluster_report(tie, [(0, 0)], CATS, 50000).first()
    assert row["label"] == "A" and row["percent"] == 50.0 and row["median_score"] == 1


def test_report_line_format(spark):
    df = vectors(spark, [(0, 7), (0, 9), (50000, 8)])
    line = C.report_lines(C.cluster_report(df, [(0, 0)], CATS, 50000)).first()["line"]
    assert line == "      8  A                 (66.7 %)            3"


def test_seeds_are_reproducible_under_any_partitioning(spark):
    pts = [(50000 * (i % 3), i) for i in range(300)]
    params = C.KMeansParams(categories=CATS, spread=50000, kernels=6, seed=42)
    base = vectors(spark, pts)
    a = C.sample_seeds(base.repartition(1), params)
    b = C.sample_seeds(base.repartition(7), params)
    assert a == b and len(a) == 6
    assert [x for x, _ in a] == [0, 0, 50000, 50000, 100000, 100000]
    g1 = [tuple(r) for r in C.seed_points_global(base.repartition(1), 5, 1).collect()]
    g2 = [tuple(r) for r in C.seed_points_global(base.repartition(5), 5, 1).collect()]
    assert g1 == g2 and len(g1) == 5


def test_seeding_preconditions(spark):
    df = vectors(spark, [(0, 1), (0, 2), (50000, 3)])
    with pytest.raises(ValueError):
        C.sample_seeds(df, C.KMeansParams(categories=CATS, kernels=4))
    with pytest.raises(ValueError, match="short"):
        C.sample_seeds(df, C.KMeansParams(categories=CATS, kernels=3))
    with pytest.raises(ValueError):
        C.KMeansParams(categories=CATS, spread=0)
    small = C.KMeansParams(categories=CATS, spread=100, kernels=3)
    assert len(C.sample_seeds(df, small)) == 3
    with pytest.raises(ValueError, match="multiple"):       # also where seeds are drawn over all
        C.sample_seeds(df, C.KMeansParams(categories=CATS[:2], spread=100, kernels=3))
    with pytest.raises(ValueError):
        C.sample_seeds(df, C.KMeansParams(categories=CATS, spread=100, kernels=4))


def test_fit_checkpoints_compact_points(spark):
    pts = [(50000 * (i % 3), i % 17) for i in range(200)]
    fitted = C.fit(vectors(spark, pts), C.KMeansParams(categories=CATS, kernels=3, eta=1.0))
    assert fitted.points.count() == len(set(pts))
    assert len(fitted.result.centers) == 3


@pytest.mark.parametrize("k", [45, 500])
def test_many_centers_agree_with_the_expression(spark, k):
    import random
    rnd = random.Random(k)
    pts = [(rnd.randint(0, 40), rnd.randint(-40, 40)) for _ in range(700)]
    centers = [(rnd.randint(0, 40), rnd.randint(-40, 40)) for _ in range(k)]     # many ties
    df = vectors(spark, pts)
    got = [r["cluster"] for r in C.assign(df, centers).orderBy("id").collect()]
    want = [min(range(k), key=lambda i: ((x - centers[i][0]) ** 2 + (y - centers[i][1]) ** 2, i))
            for x, y in pts]
    assert got == want
    few = centers[:C.EXPRESSION_CENTERS]
    a = [r[0] for r in df.orderBy("id").select(C.nearest_center(few)).collect()]
    b = [r[0] for r in df.orderBy("id").select(C.batch_nearest(few)("x", "y")).collect()]
    assert a == b


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_centers_beyond_32_bits(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = 3_000_000_000
        df = vectors(spark, [(0, big), (0, big + 2), (0, -big)])
        assert C.kmeans_step(df, [(0, big), (0, -big)]) == [(0, big + 1), (0, -big)]
        row = C.cluster_report(df.where("y > 0"), [(0, big)], CATS, 50000).first()
        assert row["median_score"] == big + 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_medians_of_weighted_values(spark, ranges):
    import random
    rnd = random.Random(ranges)
    rows = [(c, rnd.choice([rnd.randint(-9, 9), rnd.randint(-10 ** 6, 10 ** 12)]), rnd.randint(1, 4))
            for c in range(6) for _ in range(rnd.randint(1, 60))] + [(9, -3, 1), (9, -2, 1), (8, 5, 3)]
    got = dict(C.weighted_medians(spark.createDataFrame(rows, "cluster int, y bigint, _w bigint"),
                                  ranges).collect())
    for c in {r[0] for r in rows}:
        ys = sorted(y for k, y, w in rows if k == c for _ in range(w))
        s = ys[(len(ys) - 1) // 2] + ys[len(ys) // 2]
        assert got[c] == (s // 2 if s >= 0 else -(-s // 2))


def test_seeding_many_per_category(spark):
    """5000 a category, one category dominant: each salt is cut before a category meets."""
    df = spark.range(60000).select("id", F.when(F.col("id") % 10 == 0, 50000).otherwise(0)
                                   .cast("bigint").alias("x"), (F.col("id") % 97).alias("y"))
    out = C.seed_points_per_category(df, 5000, 1)
    got = {(r["x"], r["rank"]): r["id"] for r in out.collect()}
    import hashlib
    for x in (0, 50000):
        ids = [i for i in range(60000) if (50000 if i % 10 == 0 else 0) == x]
        want = sorted(ids, key=lambda i: (hashlib.md5(f"{i}#1".encode()).hexdigest(), i))[:5000]
        assert [got[x, k + 1] for k in range(5000)] == want
    assert "_salt" in out._jdf.queryExecution().executedPlan().toString()
