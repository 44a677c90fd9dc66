"""User-defined aggregates with partial states, against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from strata.operators import aggregators as A
from strata.operators import timeuse as TU
from strata.plans import queries as Q


def spread(a, b):
    """User code with a state of two: greatest less least value of two columns' sum."""
    class Spread(A.Aggregator):         # a local class travels with the plan
        columns, state, result = (a, b), (pa.float64(), pa.float64()), pa.float64()

        def partial(self, groups, n, *values):
            total = np.array([math.nan if x is None or y is None else x + y
                              for x, y in zip(*(v.to_pylist() for v in values))], float)
            return self.merge(groups, n, total, total)

        def merge(self, groups, n, *states):
            low, high = np.full(n, np.nan), np.full(n, np.nan)
            np.fmin.at(low, groups, states[0])
            np.fmax.at(high, groups, states[1])
            return low, high

        def finish(self, *states):
            return pa.array(states[1] - states[0], mask=np.isnan(states[0]))

    return Spread()


def rows(n=3000, seed=1):
    r = random.Random(seed)
    keys = [None, "hot", "a", "b", ""]
    return [("hot" if r.random() < 0.4 else r.choice(keys), r.choice([None, 1, 2]),
             r.choice([None, r.uniform(-5, 5)]), float(r.randint(-9, 9))) for _ in range(n)]


def brute(data):
    groups = defaultdict(list)
    for k, j, x, y in data:
        groups[k, j].append((x, y))
    out = {}
    for key, v in groups.items():
        xs, sums = [x for x, _ in v if x is not None], [x + y for x, y in v if x is not None]
        out[key] = (len(v), sum(xs) / len(xs) if xs else None, max(sums) - min(sums) if sums else None)
    return out


AGGS = {"n": A.Count(), "mean": A.Mean("x"), "spread": spread("x", "y")}


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows(), "k string, j int, x double, y double").repartition(5)


def check(got, data):
    want = brute(data)
    got = {(r["k"], r["j"]): r for r in got.collect()}
    assert got.keys() == want.keys()
    for key, (n, mean, width) in want.items():
        assert got[key]["n"] == n
        for value, name in ((mean, "mean"), (width, "spread")):
            assert got[key][name] == (None if value is None else pytest.approx(value))


def test_matches_plain_python(frame):
    check(A.aggregate(frame, ["k", "j"], AGGS), rows())


def test_small_batches_and_full_tables(spark, frame, monkeypatch):
    # states are handed on again and again, a key stretches over many batches
    monkeypatch.setattr(A, "HELD_STATES", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(A.aggregate(frame, ["k", "j"], AGGS), rows())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_group_ships_one_state_per_task(spark):
    # one key holds nine rows of ten
    data = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise("rare").alias("k"),
                                      F.col("id").cast("double").alias("x")).repartition(6)
    states = A.partial_states(data, ["k"], [A.Mean("x")])
    per_task = states.groupBy(F.spark_partition_id().alias("task"), "k0").count().collect()
    assert len(per_task) == 12 and all(r["count"] == 1 for r in per_task)
    got = {r["k"]: r["m"] for r in A.aggregate(data, ["k"], {"m": A.Mean("x")}).collect()}
    assert got["hot"] == pytest.approx(10000.0) and got["rare"] == pytest.approx(9995.0)


def test_keys_may_be_inputs_and_empty_input(spark):
    data = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "x double")
    assert sorted(((r["x"], r["m"]) for r in A.aggregate(data, ["x"], {"m": A.Mean("x")}).collect()),
                  key=str) == [(1.0, 1.0), (2.0, 2.0), (None, None)]
    assert A.aggregate(data.limit(0), ["x"], {"n": A.Count()}).count() == 0
    with pytest.raises(ValueError, match="no keys"):
        A.aggregate(data, [], {"n": A.Count()})


def test_time_use_ships_at_most_twelve_states_per_task(spark):
    typed = TU.time_use_summary_typed(Q._summary(spark, "/root/testdata/sf0.001")).repartition(4)
    states = A.partial_states(typed, TU.KEYS, [A.Mean(m) for m in TU.MEASURES])
    counts = Counter(r[0] for r in states.select(F.spark_partition_id()).collect())
    assert 1 <= len(counts) <= 4 and max(counts.values()) <= 12
    assert TU.time_use_grouped_aggregated(typed).collect() == TU.time_use_grouped(typed).collect()


def test_plan_ships_states_alone(spark):
    typed = TU.time_use_summary_typed(Q._summary(spark, "/root/testdata/sf0.001"))
    plan = TU.time_use_grouped_aggregated(typed)._jdf.queryExecution().toString()
    below = plan[plan.index("== Physical Plan =="):].split("MapInArrow")
    # the exchange between the two maps carries states: s0 to s5 and the keys
    assert len(below) == 3 and "Exchange hashpartitioning(k0" in below[1] and "s5" in below[2]
