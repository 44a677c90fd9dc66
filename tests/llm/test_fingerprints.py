import hashlib
import re

import numpy as np
from llm_cases import (  # noqa: F401
    clashing_docs, edge_docs, edge_rows, no_docs, prose, rows_of)

from pyspark.sql import functions as F
from strata.llm import fingerprints as P


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_edited_texts_and_likeness(spark):
    texts = {i: prose(i, 20 + 17 * i) for i in range(1, 40)}
    texts |= {40: texts[39] + " tail", 41: texts[39], 42: texts[39], 43: "é漢 x", 44: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in P.edited_fingerprints(df).collect()}
    ids, errors = sorted(texts, reverse=True), []
    for k, i in enumerate(ids):
        t, nxt = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = got[i]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r["near_edited"] - jaccard(shingles(t), shingles(edited)))
        errors.append(r["near_next"] - jaccard(shingles(t), shingles(nxt)))
    # 256 bins: a standard error of 0.031 at worst
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.13
    assert got[41]["fingerprint"] == got[42]["fingerprint"] and got[42]["near_next"] == 1.0
    assert {len(r["fingerprint"]) for r in got.values()} == {512}


def test_estimate_is_unbiased_on_short_sets(spark):
    # few shingles in many bins: nearly every bin is filled by densification
    pairs = [(f"{prose(k, 14)} {prose(k + 500, 5)}", f"{prose(k, 14)} {prose(k + 900, 5)}")
             for k in range(150)]
    df = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b"))).alias("e"))
    errors = [r["e"] - jaccard(shingles(r["a"]), shingles(r["b"])) for r in df.collect()]
    assert abs(np.mean(errors)) < 0.03


def test_edge_rows(spark, clashing_docs, no_docs):
    out = P.edited_fingerprints(clashing_docs)
    assert rows_of(out, "doc_id", "n_chars") == sorted(
        ((r[0], len(r[1] or "")) for r in edge_rows()), key=lambda r: (r[0] is not None, r))
    assert P.edited_fingerprints(no_docs).count() == 0
    alone = P.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id bigint, text string"))
    r = alone.first()
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest()
    zero = P.fingerprints(spark.createDataFrame([(1, None), (2, "  ")], "doc_id bigint, text string"))
    assert {tuple(x["packed"]) for x in zero.collect()} == {()}
    assert "Python" not in alone._jdf.queryExecution().optimizedPlan().toString()
