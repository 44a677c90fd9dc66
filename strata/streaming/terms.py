"""Running term counts over article files as they arrive.

State is one count per term (bounded by the term list); the query's
progress and state live in a folder the caller names, so a query restarted
in another session resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.terms import matching_terms
from strata.sources.articles import parse_articles


def article_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(title, text)`` from article files dropped into ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_articles(reader.load(path), strict=True)


def rank_terms_stream(articles: DataFrame, terms: Sequence[str], text: str = "text") -> DataFrame:
    """A5 on a stream: running ``(term, n)``, most frequent first (complete mode)."""
    counts = matching_terms(articles, terms, text).groupBy("term") \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("term"))


def start_ranking(spark: SparkSession, path: str, terms: Sequence[str], name: str,
                  checkpoint: str, sink: str = "memory",
                  options: dict[str, str] | None = None) -> StreamingQuery:
    """Start the running ranking; progress and state are kept in the folder ``checkpoint``.

    The folder must outlive the session (a shared one on a cluster) and belong
    to this query alone: any later session that names it resumes the query.
    """
    writer = (rank_terms_stream(article_stream(spark, path), terms).writeStream
              .outputMode("complete").format(sink).queryName(name)
              .option("checkpointLocation", checkpoint))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    return writer.start()
