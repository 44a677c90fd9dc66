import pytest

from strata.checks import (DataCheckError, Observed, check_not_null, check_schema, expect_count,
                           guard_not_null, null_counts, persisted)


def test_expect_count(spark):
    df = spark.range(5)
    assert expect_count(df, 5) == 5
    with pytest.raises(DataCheckError, match="4 vectors expected, 5 found"):
        expect_count(df, 4, "vectors")


def test_null_checks(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert null_counts(df) == {"a": 0, "b": 1}
    check_not_null(df, ["a"])
    with pytest.raises(DataCheckError):
        check_not_null(df)
    assert guard_not_null(df, ["a"]).count() == 2
    with pytest.raises(Exception, match="null value in non-null column b"):
        guard_not_null(df).collect()


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    check_schema(df, df.schema)
    with pytest.raises(DataCheckError):
        check_schema(df.select("b", "a"), df.schema)


def test_persisted_releases(spark):
    df = spark.range(10)
    with persisted(df) as p:
        assert p.count() == 10 and p.is_cached
    assert not df.is_cached


def jobs_of(spark, action):
    """Jobs that an action runs."""
    sc = spark.sparkContext
    sc.setJobGroup("observed-jobs", "count the jobs of one action")
    before = len(sc.statusTracker().getJobIdsForGroup("observed-jobs"))
    try:
        action()
        return len(sc.statusTracker().getJobIdsForGroup("observed-jobs")) - before
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("action", ["write", "checkpoint", "collect"])
def test_observed_counts_ride_on_the_action(spark, scratch, action):
    df = spark.range(100).selectExpr("id", "if(id < 3, null, id) AS x").repartition(3)
    run = {"write": lambda d: d.write.parquet(f"{scratch}/{d is df}"),
           "checkpoint": lambda d: d.checkpoint(eager=True), "collect": lambda d: d.collect()}[action]
    plain = jobs_of(spark, lambda: run(df))
    seen = Observed(df, rows=100, not_null=["id"])
    assert jobs_of(spark, lambda: (run(seen.df), seen.verify())) == plain
    assert seen.counts() == (100, {"id": 0})


def test_observed_expectations_fail(spark):
    df = spark.range(10).selectExpr("id", "if(id < 3, null, id) AS x")
    short = Observed(df, rows=9, what="vectors")
    short.df.collect()
    with pytest.raises(DataCheckError, match="9 vectors expected, 10 found"):
        short.verify()
    nulls = Observed(df, not_null=["id", "x"])
    nulls.df.collect()
    assert nulls.counts() == (10, {"id": 0, "x": 3})
    with pytest.raises(DataCheckError, match="{'x': 3}"):
        nulls.verify()


def test_observed_counts_whole_input_below_an_aggregate(spark):
    seen = Observed(spark.range(1000).repartition(4), rows=1000)
    assert seen.df.groupBy((seen.df.id % 3).alias("k")).count().count() == 3
    assert seen.verify() == 1000
