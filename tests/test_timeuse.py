"""Survey classification, labels, summary and the three grouped routes."""

import pytest

from strata.checks import check_schema
from strata.operators import timeuse as TU

HEADER = ["id", "telfs", "tesex", "teage", "t010101", "t030101", "t110101", "t180101",
          "t180301", "t050101", "t180501", "t020101", "t180201", "t170101"]


def test_classification_order_and_reversal():
    primary, work, other = TU.classify_columns(HEADER)
    assert primary == ["t180301", "t180101", "t110101", "t030101", "t010101"]
    assert work == ["t180501", "t050101"]
    assert other == ["t180201", "t020101"]


def test_classification_edge_prefixes():
    cols = ["t1801x", "t1803x", "t1805x", "t1809x", "t17x", "x01", "t0401", "t1601", "t19"]
    primary, work, other = TU.classify_columns(cols)
    assert primary == ["t1803x", "t1801x"]
    assert work == ["t1805x"]
    assert other == ["t1601", "t0401", "t1809x"]


def survey(spark, rows):
    schema = ", ".join([f"{HEADER[0]} string"] + [f"{c} double" for c in HEADER[1:]])
    return spark.createDataFrame(rows, schema)


def row(i, telfs, tesex, teage, minutes=0.0):
    return (str(i), float(telfs), float(tesex), float(teage)) + (minutes,) * 10


def test_label_boundaries(spark):
    ages = [14, 15, 22, 22.5, 23, 55, 56]
    codes = [-1, 2, 3, 4, 5]
    rows = [row(i, 1, 1, a) for i, a in enumerate(ages)] + \
           [row(100 + i, c, 2, 30) for i, c in enumerate(codes)]
    s = TU.summarize(survey(spark, rows)).collect()
    assert [r["age"] for r in s[:7]] == ["elder", "young", "young", "elder", "active",
                                         "active", "elder"]
    assert [r["working"] for r in s[7:]] == ["working", "working", "not working",
                                             "not working"]          # telfs 5 filtered out
    assert {r["sex"] for r in s[:7]} == {"male"} and {r["sex"] for r in s[7:]} == {"female"}


def test_hours_sum_order_null_and_empty(spark):
    df = survey(spark, [row(1, 1, 1, 30, 60.0)])
    r = TU.time_use_summary(df, ["t010101", "t030101"], [], ["t170101"]).first()
    assert r["primaryNeeds"] == 2.0 and r["work"] == 0.0 and r["other"] == 1.0
    nulls = spark.createDataFrame([("1", 1.0, 1.0, 30.0, None, 60.0)],
                                  "id string, telfs double, tesex double, teage double, "
                                  "t010101 double, t030101 double")
    assert TU.summarize(nulls).first()["primaryNeeds"] is None


def test_three_routes_agree(spark):
    import random
    rnd = random.Random(11)
    rows = [(str(i), float(rnd.randint(1, 5)), float(rnd.randint(1, 2)),
             float(rnd.randint(15, 80))) + tuple(float(rnd.randint(0, 600)) for _ in range(10))
            for i in range(300)]
    summary = TU.summarize(survey(spark, rows))
    a = [tuple(r) for r in TU.time_use_grouped(summary).collect()]
    b = [tuple(r) for r in TU.time_use_grouped_sql(summary).collect()]
    c = [tuple(r) for r in TU.time_use_grouped_typed(TU.time_use_summary_typed(summary)).collect()]
    assert a == b == c and len(a) > 6
    assert [x[:3] for x in a] == sorted(x[:3] for x in a)


def test_typed_rows_schema_and_null_guard(spark):
    summary = TU.summarize(survey(spark, [row(1, 1, 1, 30, 6.0)]))
    typed = TU.time_use_summary_typed(summary)
    check_schema(typed, TU.SUMMARY_SCHEMA)
    nulls = spark.createDataFrame([("working", "male", "young", None, 1.0, 1.0)],
                                  "working string, sex string, age string, "
                                  "primaryNeeds double, work double, other double")
    with pytest.raises(Exception, match="null primaryNeeds"):
        TU.time_use_summary_typed(nulls).collect()
