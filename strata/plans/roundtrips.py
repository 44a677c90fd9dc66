"""Registered queries through files: the text formats, a stored index, written results.

Each query writes what it needs below the session's checkpoint folder (a new
folder per call) and answers from the files. Column names match the oracle SQL
in ``strata.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import ensure_checkpoint_dir, find_package
from strata.operators import cluster as C
from strata.operators import postings as PO
from strata.operators import stored_index as SI
from strata.operators import terms as T
from strata.operators import timeuse as TU
from strata.plans import endtoend as E
from strata.plans import params as P
from strata.plans import queries as Q
from strata.sinks import read_lines, write_ranking, write_report
from strata.sources import articles as SA
from strata.sources import postings as SP
from strata.sources import survey as SV
from strata.sources.lines import file_name
from strata.sources.memory import local_relation
from strata.sources.tables import read_table, survey_from_events


def folder(spark: SparkSession, name: str) -> str:
    find_package(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _bad_lines(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A file of lines that are no article, posting or row of a survey: the nations' names."""
    read_table(spark, sf_dir, "nation").select(F.concat(F.lit("no line: "), "n_name").alias("value")) \
        .write.text(path)


# --- articles (S1, E1) -----------------------------------------------------------

def _article_files(spark: SparkSession, sf_dir: str) -> str:
    path = folder(spark, "articles")
    SA.write_articles(read_table(spark, sf_dir, "documents").withColumn("title", F.col("doc_id").cast("string")), path)
    return path


def articles_from_text(spark, sf_dir):
    """Documents written as lines and parsed again, line breaks and nulls included."""
    read = SA.read_articles(spark, _article_files(spark, sf_dir), escaped=True)
    return read.select(F.col("title").cast("bigint").alias("doc_id"), "text")


def article_positions(spark, sf_dir):
    """Ids that follow file and line: dense over all files, and dense in every file."""
    read = SA.read_articles(spark, _article_files(spark, sf_dir), id_col="id", escaped=True, located=True)
    per_file = read.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("at").alias("lines"),
                                        F.max("at").alias("last"), F.min("id").alias("low"), F.max("id").alias("high"))
    return per_file.agg(
        F.sum("n").alias("articles"), F.sum("lines").alias("lines"), (F.max("high") + 1).alias("ids"),
        F.count_if(F.col("last") + 1 != F.col("n")).alias("gaps"),
        F.count_if(F.col("high") - F.col("low") + 1 != F.col("n")).alias("scattered"))


def article_rejects(spark, sf_dir):
    """S1, lenient: the malformed lines among the articles, with their place."""
    good, bad = _article_files(spark, sf_dir), folder(spark, "no-articles")
    _bad_lines(spark, sf_dir, bad)
    articles, rejects = SA.read_articles(spark, [good, bad], strict=False, escaped=True, located=True)
    named = F.element_at(F.split("file", "/"), -2).startswith("no-articles")
    total = articles.agg(F.count(F.lit(1)).cast("string").alias("line"))
    return rejects.select("line", named.alias("in_bad_file")).unionByName(
        total.select("line", F.lit(False).alias("in_bad_file")))


def _flat_article_files(spark: SparkSession, sf_dir: str) -> str:
    """Articles as the reference's files hold them: not escaped, a line break read as a blank."""
    path = folder(spark, "flat-articles")
    docs = read_table(spark, sf_dir, "documents").where("text IS NOT NULL").select(
        F.col("doc_id").cast("string").alias("title"), F.translate("text", "\r\n<", "   ").alias("text"))
    SA.write_articles(docs, path)
    return path


def term_popularity_from_text(spark, sf_dir):
    """The three rankings of the articles in text files."""
    found = E.term_popularity(spark, _flat_article_files(spark, sf_dir), P.DOC_TERMS)
    return found.ranked.select(F.lit("all").alias("ranking"), "term", "n") \
        .unionByName(found.ranked_from_index.select(F.lit("index").alias("ranking"), "term", "n")) \
        .unionByName(found.ranked_by_reduction.select(F.lit("reduction").alias("ranking"), "term", "n"))


# --- a stored index (A3, A4), a written ranking (K1) ---------------------------------

def _stored_index(spark: SparkSession, sf_dir: str) -> str:
    path = folder(spark, "index")
    SI.write_index(SI.token_index(read_table(spark, sf_dir, "documents")), path, buckets=P.INDEX_BUCKETS)
    return path


def stored_index_lookup(spark, sf_dir):
    """A3: postings of the terms from an index of all tokens in files."""
    return SI.lookup(spark, _stored_index(spark, sf_dir), P.DOC_TERMS)


def stored_index_rank(spark, sf_dir):
    """A4: the ranking from the stored lengths of the posting lists."""
    return SI.stored_rank(spark, _stored_index(spark, sf_dir), P.DOC_TERMS)


def stored_index_vocabulary(spark, sf_dir):
    """A4 for a long list of terms."""
    return SI.stored_rank(spark, _stored_index(spark, sf_dir), P.VOCABULARY)


def ranking_file(spark, sf_dir):
    """K1: the ranking written through Spark's committer and read back in order."""
    path = folder(spark, "ranking")
    write_ranking(Q.term_rank(spark, sf_dir), path)
    return read_lines(spark, path)


# --- postings (S2, E2), a written report (K2) ----------------------------------------

def _posting_files(spark: SparkSession, sf_dir: str) -> str:
    path = folder(spark, "postings")
    SP.write_postings(Q._postings(spark, sf_dir), path)
    return path


def answered_questions_from_text(spark, sf_dir):
    """Questions and answers written unquoted, parsed and joined."""
    read = SP.read_postings(spark, _posting_files(spark, sf_dir), id_type="bigint")
    return PO.answered_questions(read).select("id", "score", "tags", "a_id", "a_score")


def posting_rejects(spark, sf_dir):
    """S2, lenient: the bad lines named by file, and how many postings are good."""
    good, bad = _posting_files(spark, sf_dir), folder(spark, "no-postings")
    _bad_lines(spark, sf_dir, bad)
    postings, rejects = SP.read_postings(spark, [good, bad], strict=False, id_type="bigint", located=True)
    named = F.regexp_replace(F.element_at(F.split("file", "/"), -2), "-[0-9a-f]+$", "")
    return rejects.select("line", named.alias("folder")).unionByName(
        postings.groupBy(named.alias("folder")).agg(F.count(F.lit(1)).cast("string").alias("line")))


def _clusters_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    # how many vectors there must be: answered orders of a listed priority, counted from the tables
    answered = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    expected = orders.where(F.col("o_orderpriority").isin(list(P.CATEGORIES))).select("o_orderkey") \
        .join(answered, "o_orderkey", "left_semi").distinct().count()
    return E.score_clusters(spark, _posting_files(spark, sf_dir), Q.PARAMS, expected, id_type="bigint")[0]


def cluster_report_from_text(spark, sf_dir):
    """The report from postings in text files, its vectors counted on their way."""
    return _clusters_from_text(spark, sf_dir)


def cluster_report_file(spark, sf_dir):
    """K2: E2's report written with its heading and read back in order."""
    path = folder(spark, "report")
    write_report(_clusters_from_text(spark, sf_dir), path)
    return read_lines(spark, path)


# --- survey (S3, S4, S5, S7, E3) ---------------------------------------------------------

def _survey_files(spark: SparkSession, sf_dir: str) -> str:
    path = folder(spark, "survey")
    SV.write_survey(survey_from_events(read_table(spark, sf_dir, "events")), path)
    return path


def survey_rows_from_files(spark, sf_dir):
    """The typed rows of many headed files."""
    return SV.read_survey(spark, _survey_files(spark, sf_dir))[1]


def survey_schema(spark, sf_dir):
    """The schema that the files' header gives."""
    schema = SV.survey_schema(SV.header_columns(spark, _survey_files(spark, sf_dir)))
    return local_relation(spark, [(i, f.name, f.dataType.simpleString(), f.nullable)
                                  for i, f in enumerate(schema.fields)],
                          "pos int, name string, type string, nullable boolean")


def time_use_summary_from_files(spark, sf_dir):
    """The summary of the survey in files."""
    return TU.summarize(SV.read_survey(spark, _survey_files(spark, sf_dir))[1])


def time_use_from_files(spark, sf_dir):
    """The grouped means of the survey in files."""
    return E.time_use_by_life_period(spark, _survey_files(spark, sf_dir))


def time_use_checked(spark, sf_dir):
    """E3 whose job counts respondents and nulls of the survey."""
    users = read_table(spark, sf_dir, "events").select("user_id").distinct().count()
    return E.checked_time_use(spark, _survey_files(spark, sf_dir), users)


def survey_rejects(spark, sf_dir):
    """S5, lenient: rows whose minutes are no numbers, and headers in mid-file, by file."""
    path = _survey_files(spark, sf_dir)
    header = ",".join(SV.header_columns(spark, path))
    n = header.count(",")
    bad = read_table(spark, sf_dir, "nation").select(F.explode(F.array(
        F.lit(header), F.concat("n_name", F.lit("," + ",".join(["x"] * n))),
        F.concat("n_name", F.lit(",1.5")))).alias("value"))
    # the first line of the one file is a header, the others are rejects
    more = folder(spark, "bad-survey")
    bad.coalesce(1).write.text(more)
    _, rows, rejects = SV.read_survey(spark, [path, more], strict=False)
    return rejects.select("line", file_name(F.col("file")).startswith("part-").alias("named")) \
        .unionByName(rows.agg(F.count(F.lit(1)).cast("string").alias("line")).select("line", F.lit(True).alias("named")))


# --- the reference's number of clusters (J2, I1) --------------------------------------------

_MANY = replace(Q.PARAMS, kernels=P.MANY_KERNELS)


def nearest_center_many(spark, sf_dir):
    """J2 at 45 centers."""
    vectors = C.reliable(Q._vectors(spark, sf_dir))
    find_package(spark)
    return C.assign(vectors, C.sample_seeds(vectors, _MANY)).select("id", "x", "y", "cluster")


def kmeans_centers_many(spark, sf_dir):
    """I1 at 45 centers."""
    find_package(spark)
    return C.centers_frame(spark, C.fit(Q._vectors(spark, sf_dir), _MANY).result.centers)


def cluster_report_many(spark, sf_dir):
    """A12 at 45 centers."""
    find_package(spark)
    fitted = C.fit(Q._vectors(spark, sf_dir), _MANY)
    return C.cluster_report(fitted.points, fitted.result.centers, P.CATEGORIES, P.SPREAD)


# --- a user-defined aggregate (A15) -----------------------------------------------------------

def time_use_grouped_aggregated(spark, sf_dir):
    """A15 in user code with partial states."""
    return TU.time_use_grouped_aggregated(TU.time_use_summary_typed(Q._summary(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    time_use_grouped_aggregated, cluster_report_from_text, stored_index_lookup, stored_index_rank,
    stored_index_vocabulary, articles_from_text, article_positions, article_rejects,
    term_popularity_from_text, survey_rows_from_files, time_use_summary_from_files, time_use_from_files,
    time_use_checked,
    answered_questions_from_text, posting_rejects, ranking_file, cluster_report_file, survey_schema,
    survey_rejects, nearest_center_many, kmeans_centers_many, cluster_report_many)}
