"""Bench: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: the sum of per-query medians (seconds) and each
query's median. Every result is forced in full through the ``noop`` sink
(no driver collect); iterative queries run their loop while being built.

ranking from the index vs by reduction, best answer aggregated below vs
above the join, k-means on weighted vs raw points and at k = 45.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.config import ensure_checkpoint_dir, local_session  # noqa: E402
from strata.operators import cluster as C  # noqa: E402
from strata.plans import queries as Q  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def kmeans_raw_points(spark, sf_dir):
    """I1 on raw vectors (no compaction): the comparison point for weighting."""
    vectors = Q._vectors(spark, sf_dir)
    seeds = C.sample_seeds(vectors, Q.PARAMS)
    raw = C.reliable(vectors.select("x", "y"))
    res = C.kmeans(raw, seeds, Q.PARAMS.eta, Q.PARAMS.max_iterations)
    return C.centers_frame(spark, res.centers)


def kmeans_45(spark, sf_dir):
    """I1 at the reference's own number of clusters."""
    fitted = C.fit(Q._vectors(spark, sf_dir), replace(Q.PARAMS, kernels=45))
    return C.centers_frame(spark, fitted.result.centers)


HEADLINE = {
    "term_rank": Q.term_rank,
    "term_rank_all": Q.term_rank_all,
    "term_rank_per_term": Q.term_rank_per_term,
    "term_rank_vocabulary": Q.term_rank_vocabulary,
    "rank_from_index": Q.rank_from_index,
    "posting_lists": Q.posting_lists,
    "answered_questions": Q.answered_questions,
    "nested_answers": Q.nested_answers,
    "best_answer": Q.best_answer,
    "best_answer_plain": Q.best_answer_plain,
    "seed_points_per_category": Q.seed_points_per_category,
    "kmeans_centers": Q.kmeans_centers,
    "kmeans_centers_raw_points": kmeans_raw_points,
    "kmeans_centers_45": kmeans_45,
    "cluster_report": Q.cluster_report,
    "time_use_grouped": Q.time_use_grouped,
    "time_use_grouped_sql": Q.time_use_grouped_sql,
}


def run_once(spark, query) -> float:
    t0 = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = local_session(cores=CPUS, shuffle_partitions=2 * CPUS, app="strata-bench",
                          driver_memory="12g")
    ensure_checkpoint_dir(spark)
    times: dict[str, float] = {}
    for name, query in HEADLINE.items():
        run_once(spark, query)                       # warm-up: class loading, JIT
        samples = [run_once(spark, query) for _ in range(RUNS)]
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": CPUS, "runs": RUNS}))


if __name__ == "__main__":
    main()
