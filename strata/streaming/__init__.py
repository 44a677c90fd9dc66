"""Streaming use of the batch operators.

The reference has no streaming; nothing here adds an operator. The term
ranking operators are plain DataFrame transformations, so they run
unchanged on a Structured Streaming source of article files.
"""

from strata.streaming.terms import article_stream, rank_terms_stream, start_ranking

__all__ = ["article_stream", "rank_terms_stream", "start_ranking"]
