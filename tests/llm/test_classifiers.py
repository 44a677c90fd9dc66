import math
import random
import re

import numpy as np
import pytest
from llm_cases import WORDS, clashing_docs, edge_docs, edge_rows, no_docs, prose  # noqa: F401, F811

from pyspark.sql import functions as F
from strata.llm import quality as Q
from strata.llm import toxicity as T
from strata.llm.common import bitmap, id_fold, marked

BAD = ["grubber", "snarf", "wretchling", "dolt"]


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(y))
    rank[order] = np.arange(1, len(y) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.fixture(scope="module")
def corpus(spark):
    """600 texts: a fifth toxic, a fifth junk of three kinds."""
    r, docs, labels = random.Random(9), [], []
    for i in range(600):
        w = prose(i, r.randint(30, 90)).split()
        toxic, junk = r.random() < 0.2, r.random() < 0.2
        if toxic:
            for _ in range(r.randint(1, 5)):
                w.insert(r.randrange(len(w)), r.choice(BAD))
        if junk:
            kind = i % 3
            w = [x + "###" for x in w] if kind == 0 else [x.upper() + "!!" for x in w] if kind == 1 \
                else sorted(w[:6] * 9)
        docs.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def scored(out, labels, column):
    rows = out.join(labels, "doc_id").where(id_fold(F.col("doc_id"), 4) == 2) \
        .select("score", column).toPandas()
    return rows["score"].to_numpy(), rows[column].to_numpy()


def toxic_scores(corpus, **options):
    docs, labels = corpus
    return T.score_toxicity(docs, labels, learn=lambda i: id_fold(i, 4) < 2,
                            calibrate=lambda i: id_fold(i, 4) == 3, **options)


def test_toxicity_on_held_out_rows(corpus):
    score, y = scored(toxic_scores(corpus), corpus[1], "toxic")
    assert auc(score, y) > 0.95 and ((score >= 0) & (score <= 1)).all()


def test_joined_and_sent_models_agree(corpus):
    docs, labels = corpus
    near = docs.join(labels.withColumnRenamed("toxic", "class"), "doc_id").select("text", "class")
    model = T.fit_counts(near)
    own = docs.unionByName(docs.sparkSession.createDataFrame(
        [(1000, None), (1001, ""), (1002, "snarf"), (1003, "two words"), (None, "snarf snarf"),
         (1002, "snarf")], "doc_id bigint, text string"))
    a = T.text_scores(own, model, "doc_id", "text").collect()
    b = T.text_scores(own, model, "doc_id", "text", model_words=0).collect()
    key = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0, round(r["raw"], 9)) for r in rows)
    assert key(a) == key(b)


def test_continuation_counts_are_distinct_contexts(spark):
    rows = [("a x b x", 1), ("a x b x", 1), ("a x c", 0), ("", 0), (None, 1)]
    out = T.contexts(spark.createDataFrame(rows, "text string, class int"))
    by = out.groupBy("word").agg(F.sum(F.shiftright("classes", 1)).alias("t"),
                                 F.sum(F.col("classes").bitwiseAND(F.lit(1))).alias("p"))
    # a, x (after a, after b), b toxic; a, x, c ordinary
    assert sorted((r["t"], r["p"]) for r in by.collect()) == [(0, 1), (1, 0), (1, 1), (2, 1)]


def test_power_mean_matches_a_loop():
    r = np.random.default_rng(4)
    n = np.array([0, 1, 2, 7, 0, 3, 1])
    x = r.normal(size=n.sum())
    offsets = np.concatenate([[0], np.cumsum(n)])
    got = T._mean(x, offsets, -9.0, 2.0)
    for i in range(len(n)):
        w = x[offsets[i]:offsets[i + 1]]
        assert got[i] == pytest.approx(np.log(np.mean(np.exp(w) ** 2)) / 2 if len(w) else -9.0)


def test_quality_on_held_out_rows(corpus):
    docs, labels = corpus
    fitted = Q.fit(docs, labels, learn=lambda i: id_fold(i, 4) != 2)
    score, y = scored(Q.score_quality(docs, fitted), labels, "quality")
    assert auc(score, y) > 0.97 and ((score >= 0) & (score <= 1)).all()
    kept = Q.keep_good(docs, fitted)
    assert kept.columns == docs.columns and 0.7 < kept.count() / docs.count() < 0.9
    again = Q.fit(docs, labels, learn=lambda i: id_fold(i, 4) != 2)
    assert np.allclose(fitted.network.w[0], again.network.w[0])


def test_context_matrix_matches_a_loop(spark):
    texts = ["a b c a", "c ##b", "", "solo"]
    got = Q.context_matrix(spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
                           .repartition(3))
    import pyarrow as pa
    want, index = np.zeros((Q.ROWS, Q.WIDTH)), Q.index_matrix()
    for t in texts:
        for rows, _ in Q._rows(pa.array([t])):
            for i in range(len(rows)):
                for j in range(max(0, i - Q.REACH), min(len(rows), i + Q.REACH + 1)):
                    if i != j:
                        want[rows[i]] += index[rows[j]]
    assert np.allclose(got, want)


def test_edge_rows_and_missing_labels(spark, clashing_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 1), (12, 1, 1), (None, 0, 1), (8, None, None),
                                    (1, 1, 1), (10, 0, 0)], "doc_id bigint, quality int, toxic int")
    everyone = lambda i: F.lit(True)
    for some in (labels, labels.limit(0), labels.where("doc_id = 1")):
        out = T.score_toxicity(clashing_docs, some, everyone, everyone)
        fitted = Q.fit(clashing_docs, some, everyone)
        for scores in (out, Q.score_quality(clashing_docs, fitted)):
            got = [r["score"] for r in scores.collect()]
            assert len(got) == len(edge_rows()) and all(0 <= s <= 1 for s in got)
        assert Q.keep_good(clashing_docs, fitted).columns == clashing_docs.columns
    assert T.score_toxicity(no_docs, labels, everyone, everyone).count() == 0
    assert Q.score_quality(no_docs, Q.fit(no_docs, labels, everyone)).count() == 0


def test_bitmap_lets_every_value_through(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"))
    values = np.array([r["h"] for r in df.collect()])
    marks = bitmap(df, "h", 1 << 18)
    assert marked(marks, values).all()
    others = np.array([r["h"] for r in spark.range(10 ** 6, 10 ** 6 + 5000)
                       .select(F.xxhash64("id").alias("h")).collect()])
    assert marked(marks, others).mean() < 0.05


def test_contexts_of_a_word_lie_together(spark):
    """Counts per word that move are hardly more than the words, yet a word's many contexts are split."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        r = random.Random(5)
        texts = [" ".join(f"{r.choice(WORDS)}{r.randint(0, 9)} hub" for _ in range(200)) for _ in range(60)]
        texts += [" ".join(r.choice(WORDS) for _ in range(400)) for _ in range(60)]
        rows = [(t, i % 2) for i, t in enumerate(texts)]
        out = T.contexts(spark.createDataFrame(rows, "text string, class int").repartition(3))
        parts = out.groupBy("word", F.spark_partition_id().alias("p")).count().groupBy("word") \
            .agg(F.count("p").alias("parts"), F.sum("count").alias("contexts")).toPandas()
    finally:
        spark.conf.set(setting, held)
    assert len(parts) > 200 and parts["parts"].sum() < len(parts) + 8
    want = {}
    for t in texts:
        w = t.split()
        for before, x in zip([None, *w], w):
            want.setdefault(x, set()).add(before)
    assert sorted(parts["contexts"]) == sorted(map(len, want.values()))
    hub = parts[parts["contexts"] > 250]
    assert len(hub) == 1 and hub["parts"].iloc[0] > 1


@pytest.mark.parametrize("most", [0, 10, 64, 10 ** 6])
def test_pairs_merged_in_runs_match_a_loop(most):
    r = np.random.default_rng(6)
    parts = [(r.integers(-3, 3, n), r.integers(-2, 2, n), r.integers(1, 3, n).astype(np.int8)) for n in (40, 0, 1, 30, 25)]
    want, got = {}, {}
    for w, p, b in parts:
        for key, bit in zip(zip(w.tolist(), p.tolist()), b.tolist()):
            want[key] = want.get(key, 0) | bit
    runs = list(T._runs(iter(parts), most))
    for w, p, b in runs:
        keys = list(zip(w.tolist(), p.tolist()))
        assert keys == sorted(set(keys))
        for key, bit in zip(keys, b.tolist()):
            got[key] = got.get(key, 0) | bit
    assert got == want and (len(runs) == 1 or most < 64)


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_sent_and_joined_labels_agree(spark, corpus, kind):
    """Labels that fit are sent and no text moves; others meet the texts in a join, with equal scores."""
    docs, labels = (df.withColumn("doc_id", F.col("doc_id").cast(kind)) for df in corpus)
    more = [(1, "snarf snarf"), (1, None), (2, ""), (None, "dolt"), (9999, "no label here")]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string")
                            .withColumn("doc_id", F.col("doc_id").cast(kind)))
    labels = labels.unionByName(spark.createDataFrame(
        [(1, 1, 1), (7777, 1, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
        .withColumn("doc_id", F.col("doc_id").cast(kind)))

    def scores(**options):
        rows = T.score_toxicity(docs, labels, learn=lambda i: id_fold(i, 4) < 2,
                                calibrate=lambda i: id_fold(i, 4) == 3, **options).collect()
        return sorted((str(r["doc_id"]), round(r["score"], 9)) for r in rows)

    assert scores() == scores(sent_labels=0)
    classes = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("lid")) \
        .agg(F.max("toxic").alias("class"))
    rows, _ = T.labelled_texts(docs, classes, "doc_id", "text")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join" in plan) == (kind == "string")


def brute_toxicity(labelled, texts):
    """Power means of likelihood ratios from dictionaries of contexts."""
    words = lambda t: re.findall("[0-9a-z\u0080-\U0010ffff]+", (t or "").lower())
    after = [{}, {}]
    for text, c in labelled:
        w = words(text)
        for before, x in zip([None, *w], w):
            after[c].setdefault(x, set()).add(before)
    vocabulary = set(after[0]) | set(after[1])
    n = [{x: len(after[c].get(x, ())) for x in vocabulary} for c in (0, 1)]
    both = {x: len(after[0].get(x, set()) | after[1].get(x, set())) for x in vocabulary}
    known = {x for x in vocabulary if n[0][x] + n[1][x] >= T.RARE}
    total = [sum(n[c].values()) for c in (0, 1)]
    held = [{x: max(n[c][x] - T.DISCOUNT, 0) for x in known} for c in (0, 1)]
    back = [1 - sum(held[c].values()) / total[c] for c in (0, 1)]
    every = sum(both.values()) + len(vocabulary) + 1

    def ratio(x):
        if x not in known:
            return back[1] / back[0]
        shared = (both[x] + 1) / every
        return (held[1][x] / total[1] + back[1] * shared) / (held[0][x] / total[0] + back[0] * shared)

    out = []
    for w in map(words, texts):
        mean = sum(ratio(x) ** T.POWER for x in w) / len(w) if w else (back[1] / back[0]) ** T.POWER
        out.append(math.log(mean) / T.POWER)
    return out


@pytest.mark.parametrize("model_words", [T.MODEL_WORDS, 0])
def test_toxicity_scores_match_brute_force(spark, corpus, model_words):
    docs, labels = corpus
    rows = [(r["text"], r["toxic"]) for r in docs.join(labels, "doc_id").where("doc_id < 200").collect()]
    rows += [("Élan ÉLAN 7x7 élan-7x7", 1), (None, 0), ("", 1), ("snarf", 0)] + rows[:3]
    model = T.fit_counts(spark.createDataFrame(rows, "text string, class int").repartition(3))
    texts = [t for t, _ in rows[:40]] + ["", None, "ÉLAN", "nowhere", "snarf dolt " * 300]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["raw"] for r in T.text_scores(frame, model, "doc_id", "text", model_words=model_words).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(brute_toxicity(rows, texts), abs=1e-9)


def test_pooled_features_match_a_loop():
    r = np.random.default_rng(8)
    n = np.array([0, 1, 2, 3, 40, 0, 5])
    rows, offsets = r.integers(0, 6, n.sum()), np.concatenate([[0], np.cumsum(n)])
    vectors = r.normal(size=(Q.ROWS, Q.WIDTH)).astype(np.float32)
    got = Q.pool(rows, offsets, vectors)
    for i, k in enumerate(n):
        w = rows[offsets[i]:offsets[i + 1]].tolist()
        if not w:
            assert not got[i].any()
            continue
        assert np.allclose(got[i, :Q.WIDTH], np.mean([vectors[x] for x in w], axis=0), atol=1e-5)
        marks = np.mean([Q.index_matrix()[x] for x in w], axis=0)
        assert got[i, Q.WIDTH] == pytest.approx(np.sqrt((marks ** 2).sum() / Q.MARKS), abs=1e-5)
        assert got[i, Q.WIDTH + 1] == pytest.approx(sum(a == b for a, b in zip(w, w[1:])) / k)
        assert got[i, Q.WIDTH + 2] == pytest.approx(sum(a == b for a, b in zip(w, w[2:])) / k)
        assert got[i, Q.WIDTH + 3] == pytest.approx(math.log1p(k) / 10)


def test_network_probabilities_are_calibrated_layers():
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    net = Q.Network(x, y)
    for row in x[:20]:
        z = (row - net.mean) / net.scale
        hidden = [max(0.0, sum(a * b for a, b in zip(z, w)) + c) for w, c in zip(net.w[0].T, net.w[1])]
        logit = sum(a * b for a, b in zip(hidden, net.w[2])) + net.w[3]
        assert net.probability(row[None])[0] == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)))
    # the temperature is the best of its grid on the rows set aside for it
    held = np.random.default_rng(3).permutation(400)[:80]
    loss = lambda t: np.logaddexp(0, np.where(y[held] > 0, -1, 1) * net.logit(x[held]) / t).mean()
    assert loss(net.temperature) <= min(loss(t) for t in (0.5, 0.7, 1.0, 1.5, 2.0, 4.0, 8.0)) + 1e-4
