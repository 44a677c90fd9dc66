"""Term ranking and inverted indexing over article text.

Articles are any DataFrame with a text column (and an id column where an
index is built). A term counts once per article however often it occurs
(document frequency). All variants read only the text (and id) column,
so the parquet scan prunes the rest.

Scale notes
* Every ranking is a partial (map-side) aggregate: each task ships at most
  one row per term to the shuffle, so a term present in every article costs
  no more than a rare one, and skew in the data cannot reach one task.
* Posting lists are cut into blocks of bounded width over the id range,
  so no list of unbounded length is ever gathered into one row or task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.ordering import id_block, sort_bounded
from strata.functions.text import contains_token, matched_terms, tokens
from strata.sources.memory import local_relation

# Up to this many terms the list is inlined as a literal array and matched
# per row with a hash set; longer lists are joined as a relation instead.
LITERAL_TERMS_MAX = 64
# Up to this many terms tokens pass through a set in the generated code; of a
# longer list the tokens are counted before they meet it.
SET_TERMS_MAX = 1024
# Default width of the id range of one posting-list block.
POSTING_BLOCK = 1024


def _check_terms(terms: Sequence[str]) -> list[str]:
    terms = list(terms)
    if not terms:
        raise ValueError("term list is empty")
    if len(set(terms)) != len(terms):
        raise ValueError("term list holds duplicates")
    return terms


def term_frame(spark: SparkSession, terms: Sequence[str]) -> DataFrame:
    """``(term string, pos int)``: the term list with its positions."""
    terms = _check_terms(terms)
    return local_relation(spark, list(zip(terms, range(len(terms)))), "term string, pos int")


def count_term(articles: DataFrame, term: str, text: str = "text") -> DataFrame:
    """A1: number of articles whose text holds ``term`` -> ``(term, n bigint)``."""
    return articles.agg(F.count_if(contains_token(text, term)).alias("n")) \
        .select(F.lit(term).alias("term"), "n")


def matching_terms(articles: DataFrame, terms: Sequence[str], text: str = "text",
                   id_col: str | None = None, payload: Sequence[str] = ()) -> DataFrame:
    """One row per (article, matching term) -> ``([id_col,] [payload,] term)``.

    Short lists: ``explode(array_intersect(tokens, literal))``, a single
    narrow stage. Long lists: distinct tokens joined to the term relation, a
    local relation of exact size, which Spark broadcasts below its threshold.
    """
    terms = _check_terms(terms)
    keep = ([id_col] if id_col else []) + list(payload)
    if len(terms) <= LITERAL_TERMS_MAX:
        return articles.select(*keep, F.explode(matched_terms(text, terms)).alias("term"))
    distinct_tokens = articles.select(
        *keep, F.explode(F.array_distinct(tokens(text))).alias("term"))
    relation = term_frame(articles.sparkSession, terms).select("term")
    return distinct_tokens.join(relation, "term") \
        .select(*keep, "term")


def rank_order(ranking: DataFrame) -> DataFrame:
    """O1: descending count; ties broken by ascending term (a total order).

    A ranking has at most one row per listed term, so it is sorted in one
    partition (no range-partition sampling job).
    """
    return sort_bounded(ranking, F.desc("n"), F.asc("term"))


def token_counts(articles: DataFrame, text: str = "text",
                 terms: Sequence[str] | None = None) -> DataFrame:
    """``(term, n)``: articles per token, of the listed terms or of every token of the collection.

    Tokens are counted in the task before they move, so a token of every
    article ships one row per task. A list that fits a set drops other tokens
    before they are counted; of a longer one the counts meet the list.
    """
    found = articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"))
    if terms and len(terms) <= SET_TERMS_MAX:
        found = found.where(F.col("term").isin(list(terms)))
    counts = found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    if terms and len(terms) > SET_TERMS_MAX:
        counts = counts.join(term_frame(articles.sparkSession, terms).select("term"), "term")
    return counts


def rank_terms(articles: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """A5: rank by reduction -> ``(term, n bigint)``; terms never seen are absent."""
    terms = _check_terms(terms)
    if len(terms) > LITERAL_TERMS_MAX:
        return rank_order(token_counts(articles, text, terms))
    return rank_order(matching_terms(articles, terms, text).groupBy("term")
                      .agg(F.count(F.lit(1)).alias("n")))


def rank_terms_all(articles: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """A2: every term of the list with its count, zero counts kept.

    Short lists: one global aggregate of conditional counts over the
    matched terms (each task ships one row), unpivoted afterwards. Long
    lists: counted tokens joined to the term relation, whatever its length.
    """
    terms = _check_terms(terms)
    if len(terms) <= LITERAL_TERMS_MAX:
        # hash-intersect once (one pass over the tokens), then test the at
        # most k matched terms instead of scanning all tokens k times
        tok = articles.select(matched_terms(text, terms).alias("_tok"))
        counts = tok.agg(*[F.count_if(F.array_contains("_tok", F.lit(t))).alias(f"_n{i}")
                           for i, t in enumerate(terms)])
        rows = F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"_n{i}").alias("n"))
                         for i, t in enumerate(terms)])
        # the global aggregate already yields one partition, which satisfies
        # the ordering directly (no exchange)
        return counts.select(F.inline(rows)).orderBy(F.desc("n"), F.asc("term"))
    relation = term_frame(articles.sparkSession, terms).select("term")
    ranked = token_counts(articles, text, terms).join(relation, "term", "right") \
        .select("term", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    return rank_order(ranked)


def rank_terms_per_term(articles: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """A2 as the reference runs it: one scan and aggregate per term.

    Kept as the comparison point for the bench; ``rank_terms_all`` is the
    form to use (one scan whatever the number of terms).
    """
    terms = _check_terms(terms)
    parts = [count_term(articles, t, text) for t in terms]
    return rank_order(reduce(DataFrame.unionAll, parts))


def inverted_index(articles: DataFrame, terms: Sequence[str], text: str = "text",
                   id_col: str = "doc_id", payload: Sequence[str] = ()) -> DataFrame:
    """A3 (long form): ``(term, id_col, *payload)`` for every article
    holding the term; absent terms are absent.

    ``payload`` article columns ride along through the explode (narrow, no
    join, no shuffle). For an index stored apart from its articles,
    ``index_articles`` joins them back by id.
    """
    return matching_terms(articles, terms, text, id_col, payload) \
        .select("term", id_col, *payload)


def index_articles(index: DataFrame, articles: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The reference's index payload: every indexed article joined back by id."""
    return index.join(articles, id_col)


def posting_lists(index: DataFrame, id_col: str = "doc_id",
                  block_size: int = POSTING_BLOCK) -> DataFrame:
    """A3 (nested form): ``(term, block, n, ids array)`` sorted id lists.

    A block holds the distinct ids of one term in
    ``[block*size, (block+1)*size)``, at most ``block_size`` of them, so a
    term present in every article spreads over many tasks. Ids are merged in
    the task before they move; ``n`` counts every copy of an id.
    """
    block = id_block(index, id_col, block_size)
    return index.groupBy("term", block.alias("block")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_set(id_col)).alias("ids"))


def rank_from_index(index: DataFrame) -> DataFrame:
    """A4: posting-list length per term, from either index form."""
    if "ids" in index.columns:
        counts = index.groupBy("term").agg(F.sum("n").cast("bigint").alias("n"))
    else:
        counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return rank_order(counts)
