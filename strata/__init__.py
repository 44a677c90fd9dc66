"""strata: PySpark DataFrame operators for term ranking, question/answer
scoring with integer k-means, and survey time-use aggregation.

Every operator takes and returns DataFrames built from built-in Spark
expressions, so Catalyst and adaptive execution plan the work::

    from strata import terms, postings, cluster, timeuse
"""

from strata.config import ensure_checkpoint_dir, local_session
from strata.operators import cluster, postings, terms, timeuse

__all__ = ["cluster", "ensure_checkpoint_dir", "local_session", "postings", "terms", "timeuse"]
