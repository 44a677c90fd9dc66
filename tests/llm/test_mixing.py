import pytest
from llm_cases import (  # noqa: F401
    clashing_docs, edge_docs, edge_rows, no_docs, prose, rows_of)

from strata.llm import mixing as M


def test_targets_share_by_weight_and_stop_at_the_limit():
    sizes = [100, 100, 1000, 10, 500]
    t = M.targets(sizes)
    assert sum(t) == pytest.approx(1.5 * sum(sizes))
    assert all(x <= 2 * s + 1e-9 for x, s in zip(t, sizes))
    free = [i for i, (x, s) in enumerate(zip(t, sizes)) if x < 2 * s - 1e-9]
    w = [5, 2, 1, 5, 2]
    assert len({round(t[i] / w[i], 6) for i in free}) == 1
    assert all(t[i] / w[i] <= t[free[0]] / w[free[0]] + 1e-9 for i in range(5))
    assert M.targets([]) == [] and M.targets([0, 0]) == [0, 0]


@pytest.mark.parametrize("p", [0.1, 0.5, 0.93])
def test_flight_balances_words_and_documents(p):
    sizes = [(i * 7919) % 400 + 1 for i in range(500)]
    q = M.flight(sizes, [p] * 500, "x")
    assert sum(0 < x < 1 for x in q) <= 2
    assert sum(q) == pytest.approx(500 * p)
    assert sum(a * b for a, b in zip(q, sizes)) == pytest.approx(p * sum(sizes))
    assert M.flight([5] * 9, [p] * 9, "x") == M.flight([5] * 9, [p] * 9, "x")


def test_flight_keeps_inclusion_probabilities():
    # over many seeds every unit, whatever its size, is in as often as its probability says
    sizes, probs = [1, 3, 400, 20, 20, 7, 90], [0.2, 0.5, 0.35, 0.8, 0.6, 0.05, 0.5]
    runs = 4000
    mean = [sum(x) / runs for x in zip(*(M.flight(sizes, probs, f"s{k}") for k in range(runs)))]
    for got, p in zip(mean, probs):
        assert abs(got - p) < 5 * (p * (1 - p) / runs) ** 0.5


def docs_of(spark, n=900):
    rows = [(i, prose(i, i % 37 + 1), ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_mix_meets_targets_and_does_not_depend_on_partitions(spark):
    docs = docs_of(spark)
    out = M.mix(docs.repartition(5), block=40).toPandas()
    by = out.groupby("source", dropna=False)
    assert (abs(by["taken"].sum() - by["target"].first()) <= 2).all()
    assert (by["size"].sum() == by["source_size"].first()).all()
    assert (out["taken"] <= 2 * out["size"]).all()
    assert abs(out["taken"].sum() - 1.5 * out["size"].sum()) <= 8
    again = M.mix(docs.repartition(2), block=40)
    assert rows_of(again) == sorted((tuple(None if x != x else x for x in r) for r in
                                     out.itertuples(index=False)),
                                    key=lambda r: [(x is not None, str(type(x)), x) for x in r]) \
        or rows_of(again, "doc_id", "taken") == sorted(zip(out["doc_id"], out["taken"]))


def test_edge_rows_and_alike_rows(spark, clashing_docs, no_docs):
    out = M.mix(clashing_docs)
    assert out.count() == len(edge_rows())
    assert M.mix(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0
    alike = spark.createDataFrame([(1, "a b c", "x")] * 10 + [(2, "a", "y")],
                                  "doc_id bigint, text string, source string")
    t = M.mix(alike, share=0.5, limit=0.5).where("source = 'x'").toPandas()
    assert abs(t["taken"].sum() - t["target"][0]) <= 1 and len(t) == 10


def test_mixed_documents_hold_the_taken_words(spark, clashing_docs):
    docs = docs_of(spark, 300)
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert words == M.mix(docs).agg({"taken": "sum"}).first()[0]
    out = M.mixed_documents(clashing_docs)
    assert out.columns == clashing_docs.columns and out.count() > 0


def test_alike_rows_of_a_hot_unit(spark):
    # a third of all rows share a null id, a source and a size; some are equal altogether
    rows = [(None, f"w{i % 40} x y", "s") for i in range(300)] + [(i, "a b c d", "s" if i % 2 else "t") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    units = M.mix(docs)
    mixed = M.mixed_documents(docs)
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert words == units.agg({"taken": "sum"}).first()[0]
    hot = sum(len(r["text"].split()) for r in mixed.where("doc_id IS NULL").collect())
    assert hot == units.where("doc_id IS NULL").agg({"taken": "sum"}).first()[0]
    # every row is taken as often as its like, but for one copy
    times = [r["n"] for r in mixed.where("doc_id IS NULL").groupBy("text").agg({"*": "count"})
             .withColumnRenamed("count(1)", "n").collect()]
    assert len(times) in (40, 41)
