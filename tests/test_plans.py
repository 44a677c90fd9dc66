"""Plan shape: pruning and pushdown reach the scans, aggregates are partial
before their shuffle, the seeding limit runs before its shuffle, and no
Python evaluation appears in any registered query."""

import contextlib
import io

import pytest

from strata.operators import postings as PO
from strata.operators import terms as T
from strata.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonUDF", "AggregateInPandas")
# queries whose callable runs Spark jobs before returning (seeding, loop)
EAGER = {"nearest_center", "kmeans_step", "kmeans_centers", "kmeans_history",
         "kmeans_global_sample", "kmeans_capped", "kmeans_signed", "cluster_report",
         "cluster_report_lines"}


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(q(spark, SF)) for k, q in QUERIES.items() if k not in EAGER}


def test_no_python_in_any_plan(plans):
    for k, text in plans.items():
        assert not any(n in text for n in PYTHON_NODES), k


def test_text_only_scan_for_ranking(plans):
    for k in ("term_rank", "term_rank_all", "term_count"):
        assert "ReadSchema: struct<text:string>" in plans[k], k
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plans["inverted_index"]


def test_partial_aggregates(plans):
    assert "partial_count" in plans["term_rank"]
    assert "partial_max(score" in plans["best_answer"]
    assert "partial_avg" in plans["time_use_grouped"]


def test_survey_scan_prunes_and_filters_early(plans):
    text = plans["time_use_grouped"]
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    # the labour-force filter only needs the user id: it runs before the pivot
    first_filter = text.index("Condition :")
    assert "% 5) + 1) as double) <= 4.0" in text[first_filter:first_filter + 200]


def test_answers_aggregated_before_join(plans):
    text = plans["best_answer"].split("\n\n")[0]
    join = text.index("Join")
    assert text.count("HashAggregate") >= 4 and join < text.rindex("HashAggregate")


def test_seed_limit_before_shuffle(plans):
    text = plans["seed_points_per_category"]
    salted = text.index("hashpartitioning(x") if "_salt" not in text else text.index("_salt")
    assert "row_number(), 3, Partial" in text and "row_number(), 3, Final" in text
    assert salted > 0 and text.index("Partial") < text.index("hashpartitioning(x")


def test_global_seeds_are_top_k(plans):
    assert "TakeOrderedAndProject" in plans["seed_points_global"]


def test_eager_queries_have_python_free_plans(spark):
    for k in ("nearest_center", "cluster_report"):
        text = plan(QUERIES[k](spark, SF))
        assert "percentile" not in text
        assert not any(n in text for n in PYTHON_NODES), k


def test_long_lists_count_before_they_move(spark):
    """With broadcasts off and 2000 terms, tokens are counted before any exchange."""
    words = [f"w{i}" for i in range(2000)]
    articles = spark.createDataFrame([(0, "w1 w2 w2"), (1, "w2 x")], "doc_id bigint, text string")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, off):
        for rank in (T.rank_terms, T.rank_terms_all):
            df = rank(articles, words)
            tree = plan(df).split("\n\n")[0]
            assert "Broadcast" not in tree, tree
            lines = [x for x in tree.splitlines() if "Aggregate" in x or "Exchange" in x or "Generate" in x]
            at = next(i for i, x in enumerate(lines) if "Generate" in x)
            assert "HashAggregate" in lines[at - 1] and "Exchange" in lines[at - 2], tree
            got = {r["term"]: r["n"] for r in df.collect() if r["n"]}
            assert got == {"w1": 1, "w2": 2}
        scored = spark.createDataFrame([(1, "c70", 5), (2, "none", 6)],
                                       "id bigint, tags string, high_score int")
        vectors = PO.category_vectors(scored, [f"c{i}" for i in range(100)], 10)
        assert "Broadcast" not in plan(vectors).split("\n\n")[0]
        assert [tuple(r) for r in vectors.collect()] == [(1, 700, 5)]


@contextlib.contextmanager
def settings(spark, conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_bounded_results_sort_without_sampling(plans):
    for k in ("term_rank", "rank_from_index", "time_use_grouped", "term_rank_vocabulary"):
        tree = plans[k].split("\n\n")[0]
        assert "rangepartitioning" not in tree, k
    single_pass = plans["term_rank_all"].split("\n\n")[0]
    assert single_pass.count("Exchange") == 1      # the global aggregate's only


def test_index_payload_is_narrow(plans):
    tree = plans["indexed_articles"].split("\n\n")[0]
    assert "Exchange" not in tree and "Join" not in tree
