"""Question/answer join, grouping, best-answer scoring and vectorizing."""

from strata.operators import postings as PO

SCHEMA = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string"

# Own sample (FIXTURES.md section 2): best answers 10 -> 7, 20 -> 0 (floor).
SAMPLE = [
    (1, 10, None, None, 5, "C#"),
    (2, 11, None, 10, -3, None),
    (2, 12, None, 10, 7, None),
    (1, 20, None, None, 1, 'Ja"va'),
    (2, 21, None, 20, -4, None),
]


def postings(spark, rows=SAMPLE):
    return spark.createDataFrame(rows, SCHEMA)


def best(df):
    return sorted((r["id"], r["tags"], r["high_score"]) for r in df.collect())


def test_join_is_inner(spark):
    rows = SAMPLE + [(1, 30, None, None, 2, "Java"),      # unanswered question
                     (2, 31, None, 99, 5, None),          # orphan answer
                     (2, 32, None, None, 5, None)]        # answer without parent
    j = PO.answered_questions(postings(spark, rows))
    assert sorted((r["id"], r["a_id"]) for r in j.collect()) == [(10, 11), (10, 12), (20, 21)]


def test_best_answer_floor_at_zero(spark):
    assert best(PO.best_answer(postings(spark))) == [(10, "C#", 7), (20, 'Ja"va', 0)]


def test_best_answer_whole_row_key(spark):
    rows = SAMPLE + [(1, 10, None, None, 5, "C#"),        # identical row: collapses
                     (1, 20, None, None, 9, "Scala")]     # same id, other row: stays
    want = [(10, "C#", 7), (20, 'Ja"va', 0), (20, "Scala", 0)]
    df = postings(spark, rows)
    assert best(PO.best_answer(df)) == want
    assert best(PO.best_answer_plain(df)) == want


def test_eager_equals_plain_on_random_rows(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for q in range(60):
        rows.append((1, q, None, None, rnd.randint(-5, 5), rnd.choice(["A", "B", None])))
        if q % 7 == 0:
            rows.append(rows[-1])
        for a in range(rnd.randint(0, 4)):
            rows.append((2, 1000 + q * 10 + a, None, q, rnd.randint(-50, 50), None))
    df = postings(spark, rows)
    assert best(PO.best_answer(df)) == best(PO.best_answer_plain(df))


def test_nested_answers_blocks(spark):
    rows = [(1, 1, None, None, 0, "A")] + [(2, 100 + i, None, 1, i, None) for i in range(5)]
    nested = PO.nested_answers(postings(spark, rows), block_size=2).orderBy("block").collect()
    assert [(r["block"], r["n"]) for r in nested] == [(50, 2), (51, 2), (52, 1)]
    assert [p["answer"]["id"] for p in nested[0]["pairs"]] == [100, 101]
    assert nested[0]["pairs"][0]["question"]["tags"] == "A"


def test_vectors_drop_unknown_and_null_tags(spark):
    scored = spark.createDataFrame(
        [(1, "Java", 3), (2, "JavaScript", 4), (3, None, 5), (4, "Cobol", 6), (5, "Java", 7),
         (6, "Java,Scala", 1)],
        "id int, tags string, high_score int")
    v = PO.category_vectors(scored, ["JavaScript", "Java", "Scala"], 50000)
    assert sorted((r["id"], r["x"], r["y"]) for r in v.collect()) == \
        [(1, 50000, 3), (2, 0, 4), (5, 50000, 7)]


def test_vectors_long_category_list(spark, monkeypatch):
    scored = spark.createDataFrame([(1, "Java", 3), (2, "Cobol", 4), (3, None, 5)],
                                   "id int, tags string, high_score int")
    monkeypatch.setattr(PO, "LITERAL_CATEGORIES_MAX", 1)
    v = PO.category_vectors(scored, ["JavaScript", "Java"], 10)
    assert [(r["id"], r["x"], r["y"]) for r in v.collect()] == [(1, 10, 3)]
