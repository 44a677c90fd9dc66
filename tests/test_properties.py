"""Property tests: operators against plain-Python brute force on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import cluster as C
from strata.operators import postings as PO
from strata.operators import terms as T
from strata.sources.memory import articles, local_relation

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

WORDS = ["Java", "java", "Java,", "Scala", "JavaScript", "", "x\tJava", "Java\nx"]
texts = st.lists(st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join), max_size=12)
term_lists = st.lists(st.sampled_from(["Java", "Scala", "JavaScript", "Python", "java"]),
                      min_size=1, max_size=5, unique=True)


@SETTINGS
@given(texts, term_lists)
def test_rankings_match_brute_force(spark, docs, terms):
    arts = articles(spark, [(str(i), t) for i, t in enumerate(docs)])
    want = {t: sum(1 for d in docs if t in d.split(" ")) for t in terms}
    got_all = {r["term"]: r["n"] for r in T.rank_terms_all(arts, terms).collect()}
    got_red = {r["term"]: r["n"] for r in T.rank_terms(arts, terms).collect()}
    got_idx = {r["term"]: r["n"] for r in
               T.rank_from_index(T.posting_lists(T.inverted_index(arts, terms), block_size=3))
               .collect()}
    assert got_all == want
    assert got_red == got_idx == {t: n for t, n in want.items() if n}


postings_rows = st.lists(
    st.tuples(st.sampled_from([1, 2, 3]), st.integers(0, 6), st.one_of(st.none(), st.integers(0, 6)),
              st.integers(-20, 20), st.sampled_from(["A", "B", None])),
    max_size=30)


@SETTINGS
@given(postings_rows)
def test_best_answer_matches_brute_force(spark, rows):
    data = [(kind, pid, None, parent if kind == 2 else None, score, tag if kind == 1 else None)
            for kind, pid, parent, score, tag in rows]
    df = local_relation(spark, data, "posting_type int, id int, accepted_answer int, "
                                     "parent_id int, score int, tags string")
    qs = {r for r in data if r[0] == 1}
    want = set()
    for q in qs:
        scores = [a[4] for a in data if a[0] == 2 and a[3] is not None and a[3] == q[1]]
        if scores:
            want.add(q + (max(0, max(scores)),))
    assert {tuple(r) for r in PO.best_answer(df).collect()} == want
    assert sorted(tuple(r) for r in PO.best_answer_plain(df).collect()) == sorted(want)


points = st.lists(st.tuples(st.sampled_from([0, 50000, 100000]), st.integers(-50, 80)),
                  min_size=1, max_size=40)


@SETTINGS
@given(points, st.lists(st.tuples(st.integers(0, 100000), st.integers(-50, 80)),
                        min_size=1, max_size=5))
def test_assignment_and_means_match_brute_force(spark, pts, centers):
    df = local_relation(spark, [(i, x, y) for i, (x, y) in enumerate(pts)],
                        "id bigint, x bigint, y bigint")

    def closest(x, y):
        return min(range(len(centers)),
                   key=lambda i: (float(x - centers[i][0]) ** 2 + float(y - centers[i][1]) ** 2, i))

    got = {r["id"]: r["cluster"] for r in C.assign(df, centers).collect()}
    assert got == {i: closest(x, y) for i, (x, y) in enumerate(pts)}

    def tdiv(a, b):
        return abs(a) // b * (1 if a >= 0 else -1)

    groups = {}
    for x, y in pts:
        groups.setdefault(closest(x, y), []).append((x, y))
    want = list(centers)
    for c, g in groups.items():
        want[c] = (tdiv(sum(p[0] for p in g), len(g)), tdiv(sum(p[1] for p in g), len(g)))
    assert C.kmeans_step(df, centers) == want
    assert C.kmeans_step(C.weighted_points(df), centers) == want


# --- S2 line parsing ----------------------------------------------------------

FIELDS = ["1", "2", "10", "-3", "0", "", "x", "1.5", "3000000000", "C#", 'Ja"va']
lines = st.lists(st.sampled_from(FIELDS), min_size=1, max_size=8).map(",".join)


def reference_parse(line):
    """The reference's parse: Java split (trailing empty fields dropped),
    then strict integer parsing; None when it would throw."""
    arr = line.split(",")
    while len(arr) > 1 and arr[-1] == "":
        arr.pop()

    def to_int(s):
        if not s.lstrip("-").isdigit() or not -2**31 <= int(s) < 2**31:
            raise ValueError(s)
        return int(s)

    try:
        return (to_int(arr[0]), to_int(arr[1]),
                None if arr[2] == "" else to_int(arr[2]),
                None if arr[3] == "" else to_int(arr[3]),
                to_int(arr[4]), arr[5] if len(arr) >= 6 else None)
    except (IndexError, ValueError):
        return None


@SETTINGS
@given(st.lists(lines, min_size=1, max_size=25))
def test_postings_parser_matches_reference_parse(spark, raw):
    from strata.sources.postings import parse_postings
    df = local_relation(spark, [(v,) for v in raw], "value string")
    good, rejects = parse_postings(df, strict=False)
    want = [reference_parse(v) for v in raw]
    assert sorted(map(tuple, good.collect()), key=repr) == \
        sorted((w for w in want if w is not None), key=repr)
    assert sorted(r["line"] for r in rejects.collect()) == \
        sorted(v for v, w in zip(raw, want) if w is None)


# --- S1 line parsing ----------------------------------------------------------

SEP = "</title><text>"
pieces = st.sampled_from(["a", "Java", " ", "<p>", SEP, "x" * 14, "</text></page>", "\t"])
article_lines = st.lists(pieces, max_size=10).map("".join)


def reference_article(line):
    """title = chars 14 up to the separator, text = after it up to 16
    chars before the end; None where the reference would throw."""
    i = line.find(SEP)
    start, end = i + len(SEP), len(line) - 16
    if i < 14 or end < start:
        return None
    return line[14:i], line[start:end]


@SETTINGS
@given(st.lists(article_lines, min_size=1, max_size=25))
def test_article_parser_matches_reference_parse(spark, raw):
    from strata.sources.articles import parse_articles
    df = local_relation(spark, [(v,) for v in raw], "value string")
    good, rejects = parse_articles(df, strict=False)
    want = [reference_article(v) for v in raw]
    assert sorted(map(tuple, good.collect())) == sorted(w for w in want if w is not None)
    assert sorted(r["line"] for r in rejects.collect()) == \
        sorted(v for v, w in zip(raw, want) if w is None)
