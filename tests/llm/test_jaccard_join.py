import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import (  # noqa: F401
    clashing_docs, colliding_words, edge_docs, edge_rows, no_docs, prose, rows_of, shingle_set)

from strata.llm import jaccard_join as J
from strata.llm.common import components


def brute(rows, k=4, share=(85, 100)):
    """(doc_id, n, component, links): all pairs of rows; a null id names nothing."""
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            o = len(a & b)
            if a and b and share[1] * o >= share[0] * (len(a) + len(b) - o):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    out = [(d, len(s), low.get(root(i)) if s else d, n)
           for i, ((d, _), s, n) in enumerate(zip(rows, sets, links))]
    return sorted(out, key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def copies(seed, n, words, changes):
    """A family: one text and versions with some words changed."""
    r = np.random.default_rng(seed)
    base = prose(seed, words).split()
    out = []
    for k in range(n):
        t = list(base)
        for at in r.integers(0, words, r.integers(0, changes + 1)):
            t[at] = f"v{k}x{at}"
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("tile", [J.TILE, 400])
def test_classes_match_brute_force(spark, tile):
    shared = prose(77, 30)
    texts = copies(1, 25, 90, 5) + copies(2, 20, 200, 8) + copies(3, 10, 9, 1) \
        + [f"{shared} {prose(k, 60)}" for k in range(300, 320)] + [prose(k, 3) for k in range(12)] \
        + [prose(5, 50)] * 9 + [prose(5, 50).upper()]
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert rows_of(J.jaccard_classes(df, tile=tile)) == brute(rows)
    got = J.jaccard_classes(df, tile=tile, count=False, words=5, share=(80, 100))
    assert rows_of(got) == [r[:3] for r in brute(rows, 5, (80, 100))]


def test_links_count_once_beside_an_empty_tile(spark):
    # families of two in two tiles each: in about half of them both sets are in one tile
    rows = [(10 * k + i, t) for k in range(1, 13) for i, t in enumerate(
        [prose(900 + k, 100), prose(900 + k, 100) + " end"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    assert rows_of(J.jaccard_classes(df, tile=120)) == brute(rows)


def test_null_and_repeated_ids_link_like_others(spark):
    a, b, c, d = ([*copies(60 + k, 1, 100, 0), prose(60 + k, 100) + " x", prose(60 + k, 100) + " x y"]
                  for k in range(4))
    rows = [(None, a[0]), (5, a[1]), (4, a[2]),             # a row without an id, in the middle too
            (7, b[0]), (None, b[1]), (8, b[2] + " z q r s t u v w"),
            (9, c[0]), (9, c[1]), (9, c[2]), (9, prose(70, 90)), (3, prose(70, 90) + " x"),
            (None, d[0]), (None, d[1]), (None, d[1]), (None, ""), (None, prose(71, 40))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(J.jaccard_classes(df)) == brute(rows)
    out = rows_of(J.drop_near_copies(df, words=4, share=(85, 100)))
    sets = [shingle_set(t, 4) for _, t in out]
    assert not any(x and y and 100 * len(x & y) >= 85 * len(x | y)
                   for i, x in enumerate(sets) for y in sets[:i])
    want = {(4, a[2]), (7, b[0]), (3, prose(70, 90) + " x"), (None, ""), (None, prose(71, 40))}
    assert want <= set(out) and len([x for x in out if x[0] == 9]) == 1
    # of each group one row: a, b, c, the texts of 70, d, the empty text and 71, and 8 if apart
    groups = {(x[2] if x[2] is not None else i) for i, x in enumerate(brute(rows)) if x[0] is not None}
    assert len([x for x in out if x[0] is not None]) == len(groups)


def test_edge_rows(spark, clashing_docs, no_docs):
    # the null id's text equals that of 12 and 13, which name the component
    want = brute([r[:2] for r in edge_rows()])
    assert rows_of(J.jaccard_classes(clashing_docs)) == want
    assert J.jaccard_classes(no_docs).count() == 0
    out = J.drop_near_copies(clashing_docs, words=5, share=(80, 100))
    assert out.columns == clashing_docs.columns
    assert J.drop_near_copies(no_docs).count() == 0
    stay = {r["doc_id"] for r in out.select("doc_id").collect()}
    gone = {r[0] for r in edge_rows()} - stay
    comps = {r[0]: r[2] for r in brute([r[:2] for r in edge_rows()], 5, (80, 100)) if r[0] is not None}
    assert gone == {d for d, c in comps.items() if c < d}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=14), min_size=2, max_size=12),
       st.booleans(), st.integers(5, 9))
def test_verify_counts_and_classes(sets, two, tenths):
    arrays = [np.array(sorted(x), np.uint64) for x in sets]
    side = np.arange(len(sets)) % 2 if two else np.zeros(len(sets), int)
    weight = np.arange(1, len(sets) + 1)
    linked = [[i != j and 10 * len(a & b) >= tenths * len(a | b) for j, b in enumerate(sets)]
              for i, a in enumerate(sets)]
    roots, links = J.verify(arrays, side, weight, (tenths, 10), True)
    both = len(set(side)) > 1
    for i in range(len(sets)):
        assert links[i] == sum(weight[j] for j in range(len(sets))
                               if linked[i][j] and (not both or side[i] != side[j]))
    roots, _ = J.verify(arrays, side, weight, (tenths, 10), False)
    reach = np.array(linked) | np.eye(len(sets), dtype=bool)
    for _ in sets:
        reach = reach @ reach
    assert ((roots[:, None] == roots[None, :]) == reach).all()


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    ring = [(k, k % 7 + 900) for k in range(900, 907)]
    df = spark.createDataFrame(path + star + ring + [(5, 5)], "a bigint, b bigint").repartition(3)
    got = dict(rows_of(components(df)))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(500, 560)} == {500}
    assert {got[i] for i in range(900, 907)} == {900}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_colliding_words_are_different(spark, n):
    # sets that differ in such a word alone share a name if its hash does
    rows = [(i, f"one two three {w} five") for i, w in enumerate(colliding_words(n))] \
        + [(9, f"one two three {colliding_words(n)[0].upper()} five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = rows_of(J.jaccard_classes(docs), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == brute(rows) == [(0, 2, 0, 1), (1, 2, 1, 0), (9, 2, 0, 1)]


def template(n, pool, tail=""):
    """Texts that differ in one word of eleven (``pool`` choices) and in a last word, 7 or 8 shingles."""
    return [f"a b c d e f g h i j w{k % pool}{tail and f' {tail}{k // pool}'}" for k in range(n)]


@pytest.mark.parametrize("work", [1 << 32, 3000])
def test_template_classes_match_brute_force(spark, monkeypatch, work):
    # one shingle shared by all, links between few; little work in a tile: many tiles
    monkeypatch.setattr(J, "WORK", work)
    texts = template(40, 40) + template(60, 12, "x") + ["a b c d e f g h i j"] * 2 \
        + [f"{prose(3, 40)} {k}" for k in range(20)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(J.jaccard_classes(df)) == brute(rows)
    assert rows_of(J.jaccard_classes(df, count=False)) == [r[:3] for r in brute(rows)]


def test_a_shared_template_shingle_makes_no_pairs():
    # 7 of 8 shingles are shared by all 20,000 sets: 7/9 is no link, and none is compared
    shared = np.arange(7, dtype=np.uint64)
    for own in (range(100, 20_100), [100 + k // 100 for k in range(20_000)]):
        sets = [np.append(shared, np.uint64(k)) for k in own]
        n = np.full(len(sets), 8)
        _, token, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(df), np.int64)
        rare = np.argsort(df, kind="stable")
        rank[rare] = np.arange(len(df))
        owner = np.repeat(np.arange(len(n)), n)
        token = np.sort(owner * len(df) + rank[token]) - owner * len(df)
        later = J._candidates(token, np.arange(len(n)) * 8, n, df[rare], (85, 100))
        found = sum(len(later(i, len(n))) for i in range(0, len(n), 997))
        assert found == (0 if len(df) > 20_000 else sum(99 - i % 100 for i in range(0, 20_000, 997)))
