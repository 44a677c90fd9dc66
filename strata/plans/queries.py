"""Registered queries: the operators applied to the driver's tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables.
Column names match the oracle SQL in ``strata.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import cluster as C
from strata.operators import postings as PO
from strata.operators import terms as T
from strata.operators import timeuse as TU
from strata.plans import params as P
from strata.sources.tables import (articles_from_documents, postings_from_tables, read_table,
                                  survey_from_events)

Query = Callable[[SparkSession, str], DataFrame]


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(read_table(spark, sf_dir, "documents"))


# --- term ranking and indexing ------------------------------------------

def term_count(spark, sf_dir):
    return T.count_term(_articles(spark, sf_dir), P.COUNT_TERM)


def term_rank(spark, sf_dir):
    return T.rank_terms(_articles(spark, sf_dir), P.DOC_TERMS)


def term_rank_all(spark, sf_dir):
    return T.rank_terms_all(_articles(spark, sf_dir), P.DOC_TERMS)


def term_rank_vocabulary(spark, sf_dir):
    """A2 over a 676-term vocabulary: distinct tokens joined to the terms."""
    return T.rank_terms_all(_articles(spark, sf_dir), P.VOCABULARY)


def term_rank_per_term(spark, sf_dir):
    return T.rank_terms_per_term(_articles(spark, sf_dir), P.DOC_TERMS)


def inverted_index(spark, sf_dir):
    return T.inverted_index(_articles(spark, sf_dir), P.DOC_TERMS)


def indexed_articles(spark, sf_dir):
    """A3 with its payload: article columns carried through the explode."""
    return T.inverted_index(read_table(spark, sf_dir, "documents"), P.DOC_TERMS,
                            payload=("text", "lang", "source", "n_chars"))


def posting_lists(spark, sf_dir):
    lists = T.posting_lists(T.inverted_index(_articles(spark, sf_dir), P.DOC_TERMS),
                            block_size=P.POSTING_BLOCK)
    return lists.select("term", "block", "n",
                        F.array_join("ids", ",").alias("doc_ids"))


def rank_from_index(spark, sf_dir):
    return T.rank_from_index(T.inverted_index(_articles(spark, sf_dir), P.DOC_TERMS))


def rank_from_posting_lists(spark, sf_dir):
    index = T.inverted_index(_articles(spark, sf_dir), P.DOC_TERMS)
    return T.rank_from_index(T.posting_lists(index, block_size=P.POSTING_BLOCK))


# --- survey time use ------------------------------------------------------

def _summary(spark, sf_dir):
    return TU.summarize(survey_from_events(read_table(spark, sf_dir, "events")))


def time_use_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def typed_rows(spark, sf_dir):
    return TU.time_use_summary_typed(_summary(spark, sf_dir))


def time_use_grouped(spark, sf_dir):
    return TU.time_use_grouped(_summary(spark, sf_dir))


def time_use_grouped_sql(spark, sf_dir):
    return TU.time_use_grouped_sql(_summary(spark, sf_dir))


def time_use_grouped_typed(spark, sf_dir):
    return TU.time_use_grouped_typed(TU.time_use_summary_typed(_summary(spark, sf_dir)))


# --- questions and answers ---------------------------------------------------

def _postings(spark, sf_dir):
    return postings_from_tables(read_table(spark, sf_dir, "orders"),
                                read_table(spark, sf_dir, "lineitem"))


def answered_questions(spark, sf_dir):
    return PO.answered_questions(_postings(spark, sf_dir)).select(
        "id", "score", "tags", "a_id", "a_score")


def nested_answers(spark, sf_dir):
    nested = PO.nested_answers(_postings(spark, sf_dir), block_size=P.ANSWER_BLOCK)
    text = F.array_join(F.transform(
        "pairs", lambda p: F.array_join(F.array_repeat(
            F.concat_ws(":", p["answer"]["id"], p["answer"]["score"]), p["copies"].cast("int")),
            ",")), ",")
    return nested.select("id", "block", "n", text.alias("answers"))


def best_answer(spark, sf_dir):
    return PO.best_answer(_postings(spark, sf_dir))


def best_answer_plain(spark, sf_dir):
    return PO.best_answer_plain(_postings(spark, sf_dir))


# --- clustering ------------------------------------------------------------

PARAMS = C.KMeansParams(categories=P.CATEGORIES, spread=P.SPREAD, kernels=P.KERNELS,
                        eta=P.ETA, max_iterations=P.MAX_ITERATIONS, seed=P.SEED)


def _vectors(spark, sf_dir):
    return PO.category_vectors(PO.best_answer(_postings(spark, sf_dir)), P.CATEGORIES, P.SPREAD)


def category_vectors(spark, sf_dir):
    """P7 with one tag that the list does not know."""
    return PO.category_vectors(PO.best_answer(_postings(spark, sf_dir)), P.KNOWN_CATEGORIES, P.SPREAD)


def weighted_points(spark, sf_dir):
    return C.weighted_points(_vectors(spark, sf_dir))


def seed_points_per_category(spark, sf_dir):
    return C.seed_points_per_category(_vectors(spark, sf_dir),
                                      P.KERNELS // len(P.CATEGORIES), P.SEED)


def seed_points_global(spark, sf_dir):
    return C.seed_points_global(_vectors(spark, sf_dir), P.KERNELS, P.SEED)


def nearest_center(spark, sf_dir):
    vectors = C.reliable(_vectors(spark, sf_dir))
    return C.assign(vectors, C.sample_seeds(vectors, PARAMS)).select("id", "x", "y", "cluster")


def kmeans_step(spark, sf_dir):
    vectors = C.reliable(_vectors(spark, sf_dir))
    seeds = C.sample_seeds(vectors, PARAMS)
    return C.centers_frame(spark, C.kmeans_step(C.weighted_points(vectors), seeds))


def kmeans_global_sample(spark, sf_dir):
    """I1 from seeds drawn over all categories (M1): a spread below the limit."""
    params = replace(PARAMS, spread=P.NARROW_SPREAD)
    vectors = PO.category_vectors(PO.best_answer(_postings(spark, sf_dir)), P.CATEGORIES,
                                  P.NARROW_SPREAD)
    return C.centers_frame(spark, C.fit(vectors, params).result.centers)


def kmeans_capped(spark, sf_dir):
    """I1 ended by the iteration cap."""
    params = replace(PARAMS, max_iterations=P.FEW_ITERATIONS)
    return C.history_frame(spark, C.fit(_vectors(spark, sf_dir), params).result)


def kmeans_signed(spark, sf_dir):
    """I1 on every answer's own score: negative values and means."""
    pairs = PO.answered_questions(_postings(spark, sf_dir)).select(
        F.col("a_id").alias("id"), "tags", F.col("a_score").alias("high_score"))
    vectors = PO.category_vectors(pairs, P.CATEGORIES, P.SPREAD)
    return C.centers_frame(spark, C.fit(vectors, PARAMS).result.centers)


def _fit(spark, sf_dir):
    return C.fit(_vectors(spark, sf_dir), PARAMS)


def kmeans_centers(spark, sf_dir):
    return C.centers_frame(spark, _fit(spark, sf_dir).result.centers)


def kmeans_history(spark, sf_dir):
    return C.history_frame(spark, _fit(spark, sf_dir).result)


def cluster_report(spark, sf_dir):
    fitted = _fit(spark, sf_dir)
    return C.cluster_report(fitted.points, fitted.result.centers, P.CATEGORIES, P.SPREAD)


def cluster_report_lines(spark, sf_dir):
    return C.report_lines(cluster_report(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "term_count": term_count,
    "term_rank": term_rank,
    "term_rank_all": term_rank_all,
    "term_rank_vocabulary": term_rank_vocabulary,
    "inverted_index": inverted_index,
    "indexed_articles": indexed_articles,
    "posting_lists": posting_lists,
    "rank_from_index": rank_from_index,
    "rank_from_posting_lists": rank_from_posting_lists,
    "answered_questions": answered_questions,
    "nested_answers": nested_answers,
    "best_answer": best_answer,
    "category_vectors": category_vectors,
    "weighted_points": weighted_points,
    "seed_points_per_category": seed_points_per_category,
    "seed_points_global": seed_points_global,
    "nearest_center": nearest_center,
    "kmeans_step": kmeans_step,
    "kmeans_centers": kmeans_centers,
    "kmeans_history": kmeans_history,
    "kmeans_global_sample": kmeans_global_sample,
    "kmeans_capped": kmeans_capped,
    "kmeans_signed": kmeans_signed,
    "cluster_report": cluster_report,
    "cluster_report_lines": cluster_report_lines,
    "time_use_summary": time_use_summary,
    "typed_rows": typed_rows,
    "time_use_grouped": time_use_grouped,
    "time_use_grouped_sql": time_use_grouped_sql,
    "time_use_grouped_typed": time_use_grouped_typed,
}
