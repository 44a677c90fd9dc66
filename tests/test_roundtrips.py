"""Text sources, sinks and the stored index written and read again."""

import os
import random
import re

import pytest

from pyspark.sql import functions as F
from strata.operators import stored_index as SI
from strata.operators import terms as T
from strata.plans import params as P
from strata.plans import queries as Q
from strata.plans import roundtrips as R
from strata.sinks import read_lines, write_ranking, write_report
from strata.sources import articles as SA
from strata.sources import postings as SP
from strata.sources import survey as SV
from strata.sources.lines import escaped, numbered_lines, unescaped

SF = "/root/testdata/sf0.001"
NASTY = ["", "plain", "two\nlines", "\r\n", "\\", "\\n", "\\\\s\\l\\0", "\\0", "</title><text>", "<\\<\n\\", None,
         "tab\tand\u2028separator\x85\x0b", "é漢字", " ends with \\"]


def with_splits(spark, size, action):
    """The action under another division of files."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        return action()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# --- lines ---------------------------------------------------------------------

def test_escapes_give_back_every_text(spark):
    r = random.Random(3)
    texts = NASTY + ["".join(r.choice("\\snrl0<\n\r a") for _ in range(r.randint(0, 12))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("t", escaped(F.col("t")).alias("e")).select("t", "e", unescaped(F.col("e")).alias("u")).collect()
    assert all(x["u"] == x["t"] for x in rows)
    assert all(not re.search(r"[\n\r<]", x["e"]) for x in rows)


def test_lines_are_numbered_by_file_whatever_the_splits(spark, scratch):
    r = random.Random(4)
    want, position = [], 0
    for name, n in (("a", 300), ("b", 0), ("c", 1), ("d", 77)):
        lines = [f"{name}{i} " + "x" * r.randint(0, 60) for i in range(n)]
        with open(os.path.join(scratch, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
        want += [(x, name, i, position + i) for i, x in enumerate(lines)]
        position += n

    def read():
        df = numbered_lines(spark, scratch).withColumn("file", F.element_at(F.split("file", "/"), -1))
        return sorted(tuple(x) for x in df.collect())

    for size in ("128m", "4k", "300"):
        assert with_splits(spark, size, read) == sorted(want)


def test_many_blocks_are_joined(spark, scratch, monkeypatch):
    from strata.sources import lines as L
    spark.range(500).select(F.col("id").cast("string")).repartition(3, "id").write.text(scratch + "/t")
    sent = sorted(tuple(x) for x in numbered_lines(spark, scratch + "/t").collect())
    monkeypatch.setattr(L, "SENT_BLOCKS", 0)
    assert sorted(tuple(x) for x in numbered_lines(spark, scratch + "/t").collect()) == sent
    assert [x[3] for x in sorted(sent, key=lambda x: x[3])] == list(range(500))


# --- articles ------------------------------------------------------------------

def test_nasty_articles_come_back(spark, scratch):
    rows = [(t, x) for t in NASTY for x in NASTY]
    df = spark.createDataFrame(rows, "title string, text string").repartition(3)
    SA.write_articles(df, scratch + "/a")
    got = SA.read_articles(spark, scratch + "/a", escaped=True)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    # written again: one result
    SA.write_articles(df, scratch + "/a")
    assert SA.read_articles(spark, scratch + "/a", escaped=True).count() == len(rows)


def test_article_ids_follow_file_and_line(spark, scratch):
    df = spark.range(400).select(F.col("id").cast("string").alias("title"), F.repeat(F.lit("w "), 30).alias("text"))
    SA.write_articles(df.repartition(3, "title"), scratch + "/a")

    def read():
        return {x["title"]: x["id"] for x in SA.read_articles(spark, scratch + "/a", id_col="id").collect()}

    first = read()
    assert sorted(first.values()) == list(range(400))
    assert with_splits(spark, "2k", read) == first


def test_rejected_articles_name_their_place(spark, scratch):
    for name, lines in (("x", ["bad 0", "<page> <title>T</title><text>ok</text>  </page>"]), ("y", ["bad 1"])):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    good, rejects = SA.read_articles(spark, scratch, strict=False, located=True)
    place = lambda df: sorted((x[0], x["file"].rsplit("/", 1)[1], x["at"]) for x in df.collect())
    assert place(good) == [("T", "x", 1)] and place(rejects) == [("bad 0", "x", 0), ("bad 1", "y", 0)]


# --- postings -------------------------------------------------------------------

POSTINGS = [(1, 10, None, None, 5, "C#"), (1, 11, 20, None, -3, None), (2, 2 ** 40, None, 10, 0, None),
            (2, 21, None, 11, 7, "a \"b\" ;")]
SCHEMA = "posting_type int, id bigint, accepted_answer bigint, parent_id bigint, score int, tags string"


def test_postings_come_back(spark, scratch):
    SP.write_postings(spark.createDataFrame(POSTINGS, SCHEMA), scratch + "/p")
    lines = sorted(r[0] for r in spark.read.text(scratch + "/p").collect())
    assert "1,11,20,,-3," in lines and "2,1099511627776,,10,0," in lines
    got = SP.read_postings(spark, scratch + "/p", id_type="bigint")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(POSTINGS, key=str)
    with pytest.raises(Exception, match="malformed posting line"):
        SP.read_postings(spark, scratch + "/p").collect()          # an id beyond int


@pytest.mark.parametrize("tag", ["a,b", "a\nb", ""])
def test_tags_that_a_file_cannot_hold_fail(spark, scratch, tag):
    with pytest.raises(Exception, match="can't hold the tag"):
        SP.write_postings(spark.createDataFrame([(1, 1, None, None, 0, tag)], SCHEMA), scratch + "/p")


def test_rejected_postings_name_their_place(spark, scratch):
    for name, lines in (("x", ["1,1,,,5,a", "1,x,,,5,a"]), ("y", ["", "2,2"])):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    good, rejects = SP.read_postings(spark, scratch, strict=False, located=True)
    assert [(r["id"], r["at"]) for r in good.collect()] == [(1, 0)]
    assert sorted((r["line"], r["file"].rsplit("/", 1)[1], r["at"]) for r in rejects.collect()) == [
        ("", "y", 0), ("1,x,,,5,a", "x", 1), ("2,2", "y", 1)]


# --- survey ----------------------------------------------------------------------

def survey_frame(spark, rows=40):
    return spark.range(rows).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") / 3).alias("telfs"),
                                    (F.col("id") * 1e9).alias("t01"))


def test_survey_files_each_have_a_header(spark, scratch):
    df = survey_frame(spark)
    SV.write_survey(df, scratch + "/s", files=5)
    names = [x for x in os.listdir(scratch + "/s") if x.startswith("part-")]
    assert len(names) == 5
    for name in names:
        assert open(os.path.join(scratch, "s", name)).readline() == "key,telfs,t01\n"
    columns, back = SV.read_survey(spark, scratch + "/s")
    assert columns == df.columns and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_a_file_with_another_column_order_raises(spark, scratch):
    df = survey_frame(spark)
    SV.write_survey(df, scratch + "/s/one", files=2)
    SV.write_survey(df.select("key", "t01", "telfs"), scratch + "/s/two", files=2)
    paths = [scratch + "/s/one", scratch + "/s/two"]
    with pytest.raises(Exception, match="malformed survey line"):
        SV.read_survey(spark, paths)[1].select("key").collect()
    _, rows, rejects = SV.read_survey(spark, paths, strict=False)
    assert {(r["line"], "two" in r["file"]) for r in rejects.collect()} == {("key,t01,telfs", True)}


@pytest.mark.parametrize("row", ["('a,b', 1.0D)", "('a', null)", "(null, 1.0D)", "('', 1.0D)"])
def test_rows_that_a_survey_cannot_hold_fail(spark, scratch, row):
    with pytest.raises(Exception, match="can't hold the row"):
        SV.write_survey(spark.sql(f"SELECT * FROM VALUES {row} AS t(key, t01)"), scratch + "/s")


def test_bad_numbers_fail_strictly_and_are_rejected_leniently(spark, scratch):
    with open(os.path.join(scratch, "s.csv"), "w") as f:
        f.write("key,t01\na,1.5\nb,x\n")
    with pytest.raises(Exception, match="malformed survey line"):
        SV.read_survey(spark, scratch)[1].collect()
    _, rows, rejects = SV.read_survey(spark, scratch, strict=False)
    assert [tuple(r) for r in rows.collect()] == [("a", 1.5)]
    assert [(r["line"], r["file"].endswith("/s.csv")) for r in rejects.collect()] == [("b,x", True)]


# --- written results ----------------------------------------------------------------

def test_a_repeated_write_leaves_one_ranking(spark, scratch):
    ranking = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "term string, n bigint")
    for _ in range(2):
        write_ranking(ranking, scratch + "/r")
    assert os.path.exists(scratch + "/r/_SUCCESS")
    assert sorted(map(tuple, read_lines(spark, scratch + "/r").collect())) == [
        (0, "(c,9)"), (1, "(a,2)"), (2, "(b,2)")]


def test_a_repeated_write_leaves_one_report(spark, scratch):
    report = spark.createDataFrame([("x", 50.0, 4, 7), ("y", 100.0, 2, 3)],
                                   "label string, percent double, size bigint, median_score bigint")
    for _ in range(2):
        write_report(report, scratch + "/r")
    lines = [r["line"] for r in read_lines(spark, scratch + "/r").orderBy("pos").collect()]
    assert len(lines) == 5 and lines[0] == "Resulting clusters:" and " y " in lines[3] and " x " in lines[4]


# --- stored index -------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    SI.write_index(SI.token_index(Q._articles(spark, SF)), path, buckets=16)
    return path


def test_lookup_and_rank_read_pruned_files_without_a_shuffle(spark, index):
    for df in (SI.lookup(spark, index, ["the", "of"]), SI.stored_rank(spark, index, ["the", "of", "nowhere"])):
        plan = plan_of(df)
        assert "Exchange" not in plan and "Join" not in plan
        pruned = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
        assert re.search(r"bucket#\d+ (IN|INSET|=) ?\(?\d+", pruned), pruned
        assert "In(term" in plan


def test_lookup_opens_the_files_of_its_buckets_alone(spark, index):
    read = SI.lookup(spark, index, ["the", "of"]).select(F.input_file_name()).distinct().collect()
    assert 1 <= len({r[0].split("bucket=")[1].split("/")[0] for r in read}) <= 2


def test_rank_and_lookup_equal_the_index_in_memory(spark, index):
    arts = Q._articles(spark, SF)
    memory = T.inverted_index(arts, P.DOC_TERMS)
    assert sorted(map(tuple, SI.lookup(spark, index, P.DOC_TERMS).collect())) == sorted(map(tuple, memory.collect()))
    assert SI.stored_rank(spark, index, P.DOC_TERMS).collect() == T.rank_from_index(memory).collect()
    long = SI.stored_rank(spark, index, P.VOCABULARY).collect()
    assert long == T.rank_terms(arts, P.VOCABULARY).collect()


def test_a_hot_term_fills_several_files(spark, scratch):
    # a third of all postings belong to one term
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500))
                                    .alias("term"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("note"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        SI.write_index(df, scratch + "/i", buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    stored = spark.read.parquet(scratch + "/i/postings")
    bucket = stored.where("term = 'hot'").select("bucket").distinct().collect()
    assert len(bucket) == 1
    hot_files = stored.where("term = 'hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot_files > 1
    assert [tuple(r) for r in SI.stored_rank(spark, scratch + "/i", ["hot", "t7"]).collect()] == [
        ("hot", 20_000), ("t7", df.where("term = 't7'").count())]
    got = SI.lookup(spark, scratch + "/i", ["t7"])
    assert got.columns == ["term", "doc_id", "note"] and got.count() == df.where("term = 't7'").count()


def test_an_index_is_replaced(spark, scratch):
    first = spark.createDataFrame([("a", 1), ("b", 2)], "term string, doc_id bigint")
    SI.write_index(first, scratch + "/i", buckets=8)
    SI.write_index(first.where("term = 'b'"), scratch + "/i", buckets=2)
    assert [tuple(r) for r in SI.stored_rank(spark, scratch + "/i", ["a", "b"]).collect()] == [("b", 1)]
    with pytest.raises(ValueError, match="empty"):
        SI.lookup(spark, scratch + "/i", [])


def test_file_queries_leave_earlier_results_alone(spark):
    one, two = R.ranking_file(spark, SF), R.ranking_file(spark, SF)
    assert sorted(one.collect()) == sorted(two.collect())
