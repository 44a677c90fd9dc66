"""Questions and answers: joining, grouping, scoring and vectorizing
(P3-P7, J1, A6, A7).

Postings follow the reference schema ``(posting_type int, id, accepted_answer,
parent_id, score int, tags string)``: type 1 is a question, type 2 an answer
whose ``parent_id`` is its question's ``id``.

Scale notes
* ``best_answer`` aggregates answers per question *before* the join (max
  is insensitive to duplicates) and de-duplicates questions with a
  map-side partial aggregate, so a question with a third of all answers, or
  a question row repeated a million times, reaches the join as one row.
  The plain form (join, then group) is kept as the reference semantics.
* ``nested_answers`` never gathers an unbounded list: answers are grouped
  per question *and* per block of answer ids of bounded width, below the
  join, so a hot question spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.ordering import id_block
from strata.sources.memory import local_relation

POSTING_COLUMNS = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")
QUESTION, ANSWER = 1, 2
ANSWER_PREFIX = "a_"
# Category lists up to this length are matched as a literal array per row;
# longer ones are joined as a local relation, whose exact size lets Spark
# decide on a broadcast.
LITERAL_CATEGORIES_MAX = 64
ANSWER_BLOCK = 1024


def questions(postings: DataFrame) -> DataFrame:
    """Questions only."""
    return postings.where(F.col("posting_type") == QUESTION)


def answers(postings: DataFrame) -> DataFrame:
    """P3 + P4: answers that name a parent."""
    return postings.where((F.col("posting_type") == ANSWER) & F.col("parent_id").isNotNull())


def _prefixed_answers(postings: DataFrame) -> DataFrame:
    return answers(postings).select(*[F.col(c).alias(ANSWER_PREFIX + c) for c in POSTING_COLUMNS])


def answered_questions(postings: DataFrame) -> DataFrame:
    """Inner equi-join question x answer, one flat row per pair.

    Question columns keep their names, answer columns get the ``a_`` prefix.
    Unanswered questions and orphan answers vanish; duplicate ids multiply.
    The planner picks broadcast or sort-merge at run time (AQE), and AQE
    splits a skewed partition of a question with very many answers.
    """
    q = questions(postings)
    a = _prefixed_answers(postings)
    return q.join(a, q["id"] == a[ANSWER_PREFIX + "parent_id"], "inner")


def nested_answers(postings: DataFrame, block_size: int = ANSWER_BLOCK) -> DataFrame:
    """(question, answer) pairs grouped under the question id.

    Returns ``(id, block, n, pairs)``: ``pairs`` is an array of
    ``struct(answer, question, copies)`` sorted by answer, for the answers
    whose id lies in ``[block*size, (block+1)*size)``; ``copies`` says how
    often an answer row occurs, ``n`` counts every copy.

    Copies of an answer row are counted in a map-side aggregate before lists
    are collected, so they widen neither a list nor a task. Answers are
    grouped into blocks *before* the join, on (parent, block): a question
    holding a third of all answers spreads over many tasks, and the join is
    the last shuffle, so AQE can still split a skewed partition. A question
    row meets each of its answer blocks once; when several question rows
    share an id, each gets its own rows with its pairs.
    """
    a = answers(postings)
    varying = ["id", "accepted_answer", "score", "tags"]     # type and parent are those of the group
    counted = a.groupBy("parent_id", id_block(a, "id", block_size).alias("block"), *varying) \
        .agg(F.count(F.lit(1)).alias("copies"))
    blocks = counted.groupBy(F.col("parent_id").alias("_qid"), "block").agg(
        F.sum("copies").alias("_n"),
        F.sort_array(F.collect_list(F.struct(*varying, "copies"))).alias("_answers"))
    q = questions(postings).select(*POSTING_COLUMNS)
    joined = q.join(blocks, F.col("id") == F.col("_qid"), "inner")
    question = F.struct(*POSTING_COLUMNS)
    fixed = {"posting_type": F.lit(ANSWER), "parent_id": F.col("_qid")}

    def pair(x):
        answer = F.struct(*[(fixed[c] if c in fixed else x[c]).alias(c) for c in POSTING_COLUMNS])
        return F.struct(answer.alias("answer"), question.alias("question"), x["copies"].alias("copies"))

    return joined.select("id", "block", F.col("_n").alias("n"),
                         F.transform("_answers", pair).alias("pairs"))


def best_answer_plain(postings: DataFrame) -> DataFrame:
    """A7 as the reference computes it: join, then group by the whole
    question row; ``high_score`` = max answer score floored at 0."""
    joined = answered_questions(postings)
    return joined.groupBy(*POSTING_COLUMNS).agg(
        F.greatest(F.max(ANSWER_PREFIX + "score"), F.lit(0)).alias("high_score"))


def best_answer(postings: DataFrame) -> DataFrame:
    """A7, aggregation pushed below the join (same rows as the plain form).

    Identical question rows collapse (whole-row grouping key); rows sharing
    an id but differing elsewhere stay apart, each with the best score of
    all answers of that id.
    """
    top = answers(postings).groupBy(F.col("parent_id").alias("_qid")) \
        .agg(F.max("score").alias("_top"))
    distinct_questions = questions(postings).select(*POSTING_COLUMNS).dropDuplicates()
    return distinct_questions.join(top, F.col("id") == F.col("_qid"), "inner") \
        .select(*POSTING_COLUMNS, F.greatest("_top", F.lit(0)).alias("high_score"))


def category_index(tags: str, categories: Sequence[str]):
    """0-based position of the *whole* tag in ``categories``; null when absent."""
    lits = F.array(*[F.lit(c) for c in categories]).cast("array<string>")
    pos = F.array_position(lits, F.col(tags))
    return F.when(pos > 0, pos - 1)


def category_vectors(scored: DataFrame, categories: Sequence[str], spread: int,
                     tags: str = "tags", score: str = "high_score",
                     id_col: str = "id") -> DataFrame:
    """``(id, x, y)`` with ``x = spread * category index``, ``y = score``.

    Rows whose tag is null or not in the list are dropped; duplicates kept.
    ``id`` is carried along only to give sampling a reproducible order.
    """
    categories = list(categories)
    if spread <= 0:
        raise ValueError("spread must be positive")
    if not categories or len(set(categories)) != len(categories):
        raise ValueError("categories must be a non-empty list without duplicates")
    if len(categories) <= LITERAL_CATEGORIES_MAX:
        indexed = scored.select(F.col(id_col).alias("id"),
                                category_index(tags, categories).alias("_cat"),
                                F.col(score).alias("_y"))
    else:
        relation = local_relation(scored.sparkSession,
                                  list(zip(categories, range(len(categories)))),
                                  "_tag string, _cat int")
        indexed = scored.join(relation, F.col(tags) == F.col("_tag")) \
            .select(F.col(id_col).alias("id"), "_cat", F.col(score).alias("_y"))
    return indexed.where(F.col("_cat").isNotNull()).select(
        "id",
        (F.col("_cat").cast("bigint") * F.lit(spread)).alias("x"),
        F.col("_y").cast("bigint").alias("y"))
