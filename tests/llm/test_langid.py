import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SCHEMA, clashing_docs, edge_docs, edge_rows, no_docs, rows_of  # noqa: F401, F811

from pyspark.sql import functions as F
from strata.llm import langid as L
from strata.llm import words as W
from strata.llm.common import id_fold

SYLLABLES = {"aa": "ba ke mi lo tu ra ne so".split(), "bb": "ché ñu ßa gré öl ix up".split(),
             "cc": "zor vak quil throm jex wib".split()}


def prose(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, prose(lang, i, 3 + i % 60), lang, "s", 0) for i in range(150)
            for lang in [sorted(SYLLABLES)[i % 3]]]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def learn(i):
    return id_fold(i, 5) != 0


def brute_lengths(training, texts, cells):
    """Code lengths by dictionaries of contexts, one byte at a time."""
    fold = lambda t: bytes(L.folded(np.frombuffer(t.encode(), np.uint8)))
    langs, trees = sorted({x for x, _ in training}), {}
    for lang in langs:
        seen = [defaultdict(Counter) for _ in range(L.ORDER + 1)]
        total = 0
        for t in (fold(t) for x, t in training if x == lang):
            total += len(t)
            padded = b"\0" * L.ORDER + t
            for i in range(L.ORDER, len(padded)):
                for k in range(L.ORDER + 1):
                    seen[k][padded[i - k:i]][padded[i]] += 1
        trees[lang] = [{c: ({b: n / (sum(s.values()) + len(s)) for b, n in s.items()
                             if n * cells >= total * len(langs) ** 2}) for c, s in level.items()} for level in seen]

    def probability(tree, context, b):
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        known = tree[len(context)].get(context)
        if not known:
            return probability(tree, shorter, b)
        if b in known:
            return known[b]
        left = 1 - sum(known.values())
        return left * probability(tree, shorter, b) / (1 - sum(probability(tree, shorter, x) for x in known))

    out = []
    for t in (fold(t) for t in texts):
        padded = b"\0" * L.ORDER + t
        out.append([sum(-math.log2(probability(trees[x], padded[i - L.ORDER:i], padded[i]))
                        for i in range(L.ORDER, len(padded))) for x in langs])
    return np.array(out)


@pytest.mark.parametrize("cells", [L.CELLS, 2000])
def test_code_lengths_match_brute_force(corpus, cells):
    # few cells: most grams go to the escapes
    training = [(r["lang"], r["text"]) for r in corpus.where(learn(F.col("doc_id"))).collect()]
    model = L.fit(corpus, learn, cells=cells)
    texts = ["", "ba", prose("aa", 900, 20), prose("bb", 901, 9), "ÉCHÑ xyz 123 漢字", "\x00q"]
    import pyarrow as pa
    got = [model.lengths(L.grams(d, o), o) for _, d, o in W.slices(pa.array(texts))]
    want = brute_lengths(training, texts, cells)
    # costs are rounded to 2**-16 bits, every byte pays four at most
    assert np.allclose(np.concatenate(got) / L.UNIT, want, atol=1e-3, rtol=1e-4)


def test_held_out_accuracy(corpus):
    out = L.identify(corpus, L.fit(corpus, learn)).join(corpus.select("doc_id", "lang"), "doc_id")
    rows = out.where(~learn(F.col("doc_id"))).collect()
    assert len(rows) > 20 and all(r["lang"] == r["lang_pred"] for r in rows)
    assert all(0 < r["score"] <= 1 for r in rows)


def test_slices_do_not_matter(corpus, monkeypatch):
    model = L.fit(corpus, learn)
    one = rows_of(L.identify(corpus, model))
    assert one == rows_of(L.identify(corpus.repartition(1), model))
    assert sum(len(t.keys) for t in model.known) == sum(
        len(t.keys) for t in L.fit(corpus.repartition(1), learn).known)


def test_edge_rows(edge_docs, clashing_docs, no_docs):
    model = L.fit(clashing_docs, learn)
    assert model.langs == ["en"]
    got = L.identify(clashing_docs, model)
    assert got.columns == ["doc_id", "lang_pred", "score", "bits"]
    want = sorted((r[0] is not None, r[0] or 0, any(c.isalpha() for c in r[1] or "")) for r in edge_rows())
    assert want == sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["lang_pred"] == "en") for r in got.collect())
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) for r in got.collect())
    nothing = L.fit(no_docs, learn)
    assert {r["lang_pred"] for r in L.identify(edge_docs, nothing).collect()} == {"und"}
    assert L.identify(no_docs, nothing).count() == 0
