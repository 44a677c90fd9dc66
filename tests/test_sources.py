"""Text sources written to scratch folders, and sinks."""

import os

import pytest

from strata.operators import postings as PO
from strata.operators import terms as T
from strata.operators import timeuse as TU
from strata.sinks import ranking_lines, report_text, sql_on, write_report, write_table
from strata.sources.articles import read_articles, store_articles
from strata.sources.postings import read_postings
from strata.sources.survey import header_columns, read_survey, survey_schema


def write(folder, name, lines):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def article_line(title, text):
    return "<page><title>" + "x" + title + "</title><text>" + text + "</text></page>xx"


def test_article_layout(scratch):
    # prefix is exactly 14 characters, suffix exactly 16
    line = article_line("T", "body")
    assert line.index("T") == 14 and len("</text></page>xx") == 16


def test_read_articles(spark, scratch):
    lines = [("Herbs", "fresh basil leaf"), ("Stew", "mace and basil"), ("E", "")]
    write(scratch, "a.dat", [article_line(*x) for x in lines])
    arts = read_articles(spark, scratch)
    assert arts.columns == ["title", "text"]
    assert sorted((r["title"], r["text"]) for r in arts.collect()) == sorted(lines)
    ranked = T.rank_terms_all(arts, ["mace", "basil"]).collect()
    assert [(r["term"], r["n"]) for r in ranked] == [("basil", 2), ("mace", 1)]
    numbered = read_articles(spark, scratch, id_col="doc_id")
    assert numbered.select("doc_id").distinct().count() == 3


def test_stored_ids_outlive_splits_and_new_files(spark, scratch):
    src, table, index = (os.path.join(scratch, x) for x in ("in", "table", "index"))
    os.makedirs(src)
    for k in range(3):
        write(src, f"{k}.dat", [article_line(f"t{k}.{i}", "basil" if i % 3 else "mace of basil")
                                for i in range(400)])
    arts = store_articles(read_articles(spark, src), table)
    terms = ["basil", "mace"]
    T.inverted_index(arts, terms, payload=("title",)).write.parquet(index)
    more = os.path.join(scratch, "more")
    os.makedirs(more)
    write(more, "0.dat", [article_line("new", "mace")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        again = store_articles(read_articles(spark, more), table)
        joined = T.index_articles(spark.read.parquet(index),
                                  again.select("doc_id", again["title"].alias("now"), "text"))
        rows = joined.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 1200 + 402 and all(r["title"] == r["now"] for r in rows)
    assert all(r["term"] in r["text"].split(" ") for r in rows)
    ids = [r["doc_id"] for r in again.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) == 1201


def test_malformed_article_lines(spark, scratch):
    write(scratch, "a.dat", [article_line("ok", "fine"), "no separator here at all....",
                             "<p></title><text>short"])
    with pytest.raises(Exception, match="malformed article line"):
        read_articles(spark, scratch).collect()
    with pytest.raises(Exception, match="malformed article line"):
        read_articles(spark, scratch).select("text").collect()
    good, rejects = read_articles(spark, scratch, strict=False)
    assert [r["title"] for r in good.collect()] == ["ok"]
    assert rejects.count() == 2


SAMPLE = ["1,10,,,5,C#", "2,11,,10,-3", "2,12,,10,7,", '1,20,,,1,Ja"va', "2,21,,20,-4"]


def test_read_postings_sample(spark, scratch):
    write(scratch, "p.csv", SAMPLE)
    p = read_postings(spark, scratch)
    rows = sorted(tuple(r) for r in p.collect())
    assert rows == [(1, 10, None, None, 5, "C#"), (1, 20, None, None, 1, 'Ja"va'),
                    (2, 11, None, 10, -3, None), (2, 12, None, 10, 7, None),
                    (2, 21, None, 20, -4, None)]
    best = sorted((r["id"], r["high_score"]) for r in PO.best_answer(p).collect())
    assert best == [(10, 7), (20, 0)]


def test_postings_trailing_empty_fields(spark, scratch):
    write(scratch, "p.csv", ["1,1,,,5,,", "1,2,,,5,,x", "1,3,7,,5,A,B"])
    rows = sorted(tuple(r) for r in read_postings(spark, scratch).collect())
    assert rows == [(1, 1, None, None, 5, None), (1, 2, None, None, 5, ""),
                    (1, 3, 7, None, 5, "A")]


def test_malformed_postings(spark, scratch):
    write(scratch, "p.csv", SAMPLE + ["1,x,,,5,C#", "2,13"])
    with pytest.raises(Exception, match="malformed posting line"):
        read_postings(spark, scratch).collect()
    with pytest.raises(Exception, match="malformed posting line"):
        read_postings(spark, scratch).select("tags").collect()
    good, rejects = read_postings(spark, scratch, strict=False)
    assert good.count() == 5
    assert sorted(r["line"] for r in rejects.collect()) == ["1,x,,,5,C#", "2,13"]


HEADER = "id,telfs,tesex,teage,t010101,t050101,t170101"


def test_read_survey(spark, scratch):
    write(scratch, "s1.csv", [HEADER, "a,1,1,20,60,120,30", "b,5,2,40,60,0,0"])
    write(scratch, "s2.csv", [HEADER, "c,3,2,60,0,60,0"])
    assert header_columns(spark, scratch) == HEADER.split(",")
    cols, df = read_survey(spark, scratch)
    assert cols == HEADER.split(",") and df.count() == 3
    assert [f.dataType.simpleString() for f in df.schema.fields] == \
        ["string"] + ["double"] * 6
    grouped = TU.time_use_grouped(TU.summarize(df)).collect()
    assert [(r["working"], r["age"], r["primaryNeeds"], r["work"]) for r in grouped] == \
        [("not working", "elder", 0.0, 1.0), ("working", "young", 1.0, 2.0)]


def test_survey_lenient_returns_rejects(spark, scratch):
    write(scratch, "s1.csv", [HEADER, "a,1,1,20,60,120,30", "b,1,1,20,60,x,30", "c,1,1,20,60,,30"])
    write(scratch, "s2.csv", [HEADER, "d,3,2,60,0,60,0", "e,3,2"])
    cols, good, rejects = read_survey(spark, scratch, strict=False)
    assert cols == HEADER.split(",")
    assert sorted(r[cols[0]] for r in good.collect()) == ["a", "d"]
    assert sorted(r["line"] for r in rejects.collect()) == \
        ["b,1,1,20,60,x,30", "c,1,1,20,60,,30", "e,3,2"]
    assert [f.dataType.simpleString() for f in good.schema.fields] == ["string"] + ["double"] * 6


def test_survey_schema():
    s = survey_schema(["k", "a", "b"])
    assert [f.dataType.simpleString() for f in s.fields] == ["string", "double", "double"]
    assert not any(f.nullable for f in s.fields)
    with pytest.raises(ValueError):
        survey_schema(["k", "a", "a"])


def test_survey_strict_errors(spark, scratch):
    write(scratch, "s.csv", [HEADER, "a,1,1,20,60,x,30"])
    with pytest.raises(Exception):
        read_survey(spark, scratch)[1].collect()
    other = os.path.join(scratch, "empty")
    os.makedirs(other)
    write(other, "s.csv", [HEADER, "a,1,1,20,60,,30"])
    with pytest.raises(Exception, match="malformed survey line"):
        read_survey(spark, other)[1].collect()
    mixed = os.path.join(scratch, "mixed")
    os.makedirs(mixed)
    write(mixed, "s1.csv", [HEADER, "a,1,1,20,60,1,30"])
    write(mixed, "s2.csv", [HEADER.replace("t050101", "t060101"), "b,1,1,20,60,1,30"])
    with pytest.raises(Exception):
        read_survey(spark, mixed)[1].collect()


@pytest.mark.parametrize("odd", ["", HEADER, " ", "x"])
def test_no_survey_line_is_lost(spark, scratch, odd):
    """A blank line, a header in mid-file or any other odd line: a reject, or an error."""
    rows = [f"r{i},1,1,20,60,0,{i}" for i in range(300)]
    write(scratch, "s1.csv", [HEADER, *rows[:150], odd, *rows[150:]])
    write(scratch, "s2.csv", [HEADER, "z,3,2,60,0,60,0"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")       # blocks that start in mid-file
    try:
        cols, good, rejects = read_survey(spark, scratch, strict=False)
        assert sorted(r["id"] for r in good.collect()) == sorted([r.split(",")[0] for r in rows] + ["z"])
        assert [r["line"] for r in rejects.collect()] == [odd]
        with pytest.raises(Exception, match="malformed survey line"):
            read_survey(spark, scratch)[1].select("telfs").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sinks(spark, scratch):
    from strata.operators.cluster import cluster_report
    ranking = spark.createDataFrame([("basil", 3), ("mace", 2)], "term string, n bigint")
    assert ranking_lines(ranking) == ["(basil,3)", "(mace,2)"]
    write_table(ranking, os.path.join(scratch, "table"))
    assert spark.read.parquet(os.path.join(scratch, "table")).count() == 2
    v = spark.createDataFrame([(0, 0, 7), (1, 0, 9), (2, 50000, 8)], "id bigint, x bigint, y bigint")
    report = cluster_report(v, [(0, 0)], ["A", "B"], 50000)
    text = report_text(report)
    assert text[0] == "Resulting clusters:" and text[3].endswith("3") and len(text) == 4
    out = os.path.join(scratch, "report")
    write_report(report, out)
    written = open([os.path.join(out, f) for f in os.listdir(out) if f.startswith("part")][0]).read()
    assert written.splitlines() == text
    assert sql_on(ranking, "SELECT sum(n) AS s FROM {r}", "r").first()["s"] == 5
