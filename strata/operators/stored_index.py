"""A stored inverted index: postings and counts in files by term (A3, A4).

``write_index`` lays an index out once, below one folder:

* ``postings/bucket=b``: ``(term, id, ...)``, sorted by term and id in each file;
* ``terms/bucket=b``: ``(term, n)``, the length of each posting list;
* ``layout``: the number of buckets.

A term's bucket is a hash of the term, so looking terms up or ranking them
reads the files of their buckets only, skips row groups by the terms' bounds
and moves nothing between tasks. A term of every article fills several files of
its bucket: the write divides large buckets instead of sending them to one task
(adaptive execution's rebalancing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.text import tokens
from strata.operators.terms import _check_terms

BUCKETS = 256


def token_index(articles: DataFrame, text: str = "text", id_col: str = "doc_id",
                payload: Sequence[str] = ()) -> DataFrame:
    """A3 over every token of the collection: ``(term, id_col, *payload)``, once per article."""
    return articles.select(F.explode(F.array_distinct(tokens(text))).alias("term"), id_col, *payload)


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(index: DataFrame, path: str, id_col: str = "doc_id", buckets: int = BUCKETS) -> None:
    """Stores ``index(term, id_col, ...)`` below ``path``, in place of an index that is there."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    spark, path = index.sparkSession, path.rstrip("/")
    placed = index.withColumn("bucket", term_bucket(F.col("term"), buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions("bucket", "term", id_col) \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    counts = stored.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("n"))
    counts.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term") \
        .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/terms")
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/layout")


def _of_terms(spark: SparkSession, path: str, table: str, terms: Sequence[str]) -> DataFrame:
    """Rows of the listed terms, from the files of their buckets."""
    terms, path = _check_terms(terms), path.rstrip("/")
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    # constants once the plan is optimized, so that other buckets' files are not even listed
    where = F.col("bucket").isin([term_bucket(F.lit(t), buckets) for t in terms])
    return spark.read.parquet(f"{path}/{table}").where(where & F.col("term").isin(terms)).drop("bucket")


def lookup(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """A3 from the stored index: the postings of the listed terms, with all their columns."""
    return _of_terms(spark, path, "postings", terms)


def stored_rank(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """A4 from the stored index: ``(term, n)``, ranked; terms of no article are absent.

    As many rows as terms at most, so the order is a top-k, not a sort.
    """
    counts = _of_terms(spark, path, "terms", terms).select("term", "n")
    return counts.orderBy(F.desc("n"), F.asc("term")).limit(len(list(terms)))
