"""Hot keys: one question holds a third of all answers, one term is in
every article, one category holds most points. Results must stay whole
and exact; joins are forced to sort-merge with low skew thresholds so AQE's
skew handling is exercised."""

import pytest
from pyspark.sql import functions as F

from strata.operators import cluster as C
from strata.operators import postings as PO
from strata.operators import terms as T

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
}
N_Q, N_A, HOT = 2000, 90000, 7
# answers of the hot question: every third one, plus its share of the rest
HOT_ANSWERS = sum(1 for i in range(N_A) if i % 3 == 0 or i % N_Q == HOT)


@pytest.fixture
def skew_spark(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_postings(spark):
    q = spark.range(N_Q).select(
        F.lit(1).alias("posting_type"), "id", F.lit(None).cast("bigint").alias("accepted_answer"),
        F.lit(None).cast("bigint").alias("parent_id"), (F.col("id") % 10).cast("int").alias("score"),
        F.element_at(F.array(*[F.lit(t) for t in "ABC"]), (F.col("id") % 3 + 1).cast("int"))
        .alias("tags"))
    a = spark.range(N_A).select(
        F.lit(2).alias("posting_type"), (F.col("id") + 1_000_000).alias("id"),
        F.lit(None).cast("bigint").alias("accepted_answer"),
        F.when(F.col("id") % 3 == 0, F.lit(HOT)).otherwise(F.col("id") % N_Q).alias("parent_id"),
        (F.col("id") % 997 - 400).cast("int").alias("score"),
        F.lit(None).cast("string").alias("tags"))
    return q.unionByName(a)


def test_hot_question_join_is_split_and_whole(skew_spark):
    joined = PO.answered_questions(hot_postings(skew_spark)).select("id", "a_id")
    rows = joined.collect()
    assert len(rows) == N_A
    assert sum(1 for r in rows if r["id"] == HOT) == HOT_ANSWERS
    final = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in final, final


def test_hot_question_best_answer_and_blocks(skew_spark):
    p = hot_postings(skew_spark)
    eager = sorted(tuple(r) for r in PO.best_answer(p).collect())
    plain = sorted(tuple(r) for r in PO.best_answer_plain(p).collect())
    assert eager == plain and len(eager) == N_Q
    nested = PO.nested_answers(p, block_size=512).where(F.col("id") == HOT)
    stats = nested.agg(F.sum("n").alias("total"), F.max(F.size("pairs")).alias("widest"),
                       F.count(F.lit(1)).alias("rows")).first()
    assert stats["total"] == HOT_ANSWERS and stats["widest"] <= 512 and stats["rows"] > 50


def test_copies_of_one_answer_widen_no_block(skew_spark):
    """One answer row is a third of all rows; n still counts every copy."""
    q = hot_postings(skew_spark).where("posting_type = 1")
    a = hot_postings(skew_spark).where("posting_type = 2")
    hot = a.where("id = 1000001").crossJoin(skew_spark.range(N_A // 2)
                                             .select(F.col("id").alias("k"))).drop("k")
    nested = PO.nested_answers(q.unionByName(a).unionByName(hot), block_size=512)
    got = nested.agg(F.sum("n").alias("n"), F.max(F.size("pairs")).alias("widest")).first()
    assert got["n"] == N_A + N_A // 2 and got["widest"] <= 512
    pairs = nested.select(F.explode("pairs").alias("p")).select("p.copies", "p.answer.id")
    assert pairs.where("copies > 1").collect() == [(N_A // 2 + 1, 1000001)]


def test_dominant_cluster_with_many_scores(skew_spark):
    df = skew_spark.range(60000).select("id", F.lit(0).cast("bigint").alias("x"),
                                        (F.col("id") * 7919 % 1000003).alias("y"))
    row = C.cluster_report(df, [(0, 0), (0, 10 ** 9)], ["A"], 50000).first()
    ys = sorted(i * 7919 % 1000003 for i in range(60000))
    assert (row["size"], row["median_score"]) == (60000, (ys[29999] + ys[30000]) // 2)


def test_term_in_every_article(spark):
    arts = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("the "), F.when(F.col("id") % 100 == 0, F.lit("rare ")).otherwise(F.lit("")),
                 F.lit("end")).alias("text"))
    got = [(r["term"], r["n"]) for r in T.rank_terms_all(arts, ["the", "rare", "none"]).collect()]
    assert got == [("the", 5000), ("rare", 50), ("none", 0)]
    lists = T.posting_lists(T.inverted_index(arts, ["the"]), block_size=256)
    assert lists.agg(F.max("n")).first()[0] <= 256 and lists.agg(F.sum("n")).first()[0] == 5000


def test_dominant_category_seeding(spark):
    pts = spark.range(20000).select(
        "id", (F.when(F.col("id") % 10 == 0, F.lit(50000)).otherwise(F.lit(0))).alias("x"),
        (F.col("id") % 301).alias("y"))
    params = C.KMeansParams(categories=("A", "B"), spread=50000, kernels=4, seed=1)
    seeds = C.sample_seeds(pts.repartition(9), params)
    assert [x for x, _ in seeds] == [0, 0, 50000, 50000]
    assert seeds == C.sample_seeds(pts.repartition(2), params)
