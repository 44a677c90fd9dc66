"""End-to-end runs from the reference's text formats.

Each run composes the sources and operators; nothing here adds logic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.checks import Observed, persisted
from strata.functions.ordering import sort_bounded
from strata.operators import cluster as C
from strata.operators import postings as PO
from strata.operators import terms as T
from strata.operators import timeuse as TU
from strata.sources.articles import read_articles
from strata.sources.memory import local_relation
from strata.sources.postings import read_postings
from strata.sources.survey import read_survey


@dataclass
class TermPopularity:
    ranked: DataFrame                 # A2: every term, zero counts kept
    ranked_from_index: DataFrame      # A3 -> A4
    ranked_by_reduction: DataFrame    # A5


def term_popularity(spark: SparkSession, path: str, terms: Sequence[str]) -> TermPopularity:
    """S1 -> A2 / (A3 -> A4) / A5 -> O1.

    The articles are pinned while the three rankings are computed, so the
    text is read and parsed once; a ranking has one row per listed term.
    """
    def done(ranking: DataFrame) -> DataFrame:
        return local_relation(spark, [tuple(r) for r in ranking.select("term", "n").collect()],
                              "term string, n bigint")

    with persisted(read_articles(spark, path, id_col="doc_id")) as articles:
        return TermPopularity(done(T.rank_terms_all(articles, terms)),
                              done(T.rank_from_index(T.inverted_index(articles, terms))),
                              done(T.rank_terms(articles, terms)))


def score_clusters(spark: SparkSession, path: str, params: C.KMeansParams,
                   expected_vectors: int | None = None,
                   id_type: str = "int") -> tuple[DataFrame, C.Clustering]:
    """S2 -> P3 -> J1 -> A7 -> P7 -> A16 -> M2 -> I1 -> A12 -> O3.

    The text is read once; the vectors are made once and kept reliably. Their
    number and their nulls are counted by the job that writes them (A16, S4).
    Returns the report (K2 via ``strata.sinks.report_text``) and the fit.
    """
    with persisted(read_postings(spark, path, True, id_type)) as postings:    # both sides of the join
        seen = Observed(PO.category_vectors(PO.best_answer(postings), params.categories,
                                            params.spread).select("id", "x", "y"),
                        rows=expected_vectors, not_null=("id", "x", "y"), what="vectors")
        vectors = C.reliable(seen.df)
        seen.verify()
    fitted = C.fit_reliable(vectors, params)
    report = C.cluster_report(fitted.points, fitted.result.centers, params.categories,
                              params.spread)
    return report, fitted


def time_use_by_life_period(spark: SparkSession, path: str) -> DataFrame:
    """S3 -> P8 -> P9/P10/P12 -> P13 -> A15 -> O2 (show with ``df.show()``)."""
    columns, survey = read_survey(spark, path)
    primary, work, other = TU.classify_columns(columns)
    summary = TU.time_use_summary(survey, primary, work, other)
    return TU.time_use_grouped_typed(TU.time_use_summary_typed(summary))


def checked_time_use(spark: SparkSession, path: str, expected_rows: int) -> DataFrame:
    """E3 with its checks (A16, S4): how many respondents there are, and no null in any column.

    The counts are taken by the job that groups the survey; the result, one
    row per group (12 at most), is handed over once they hold.
    """
    columns, survey = read_survey(spark, path)
    seen = Observed(survey, rows=expected_rows, not_null=columns, what="respondents")
    grouped = TU.time_use_grouped_typed(TU.time_use_summary_typed(
        TU.time_use_summary(seen.df, *TU.classify_columns(columns))))
    rows = [tuple(r) for r in grouped.collect()]
    seen.verify()
    return sort_bounded(local_relation(spark, rows, grouped.schema), *TU.KEYS)
